"""Language mixtures, quality trees and sharding: brute force, held-out accuracy, odd rows."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from reviewlab.llm import boosting, language_id, quality, queries, sharding

BLANKS = " \t\n\x0b\f\r"


def test_language_accuracy_on_held_out_documents(spark, sf):
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op5_language_id(spark, sf).collect()
    assert {r.doc_id for r in rows} == set(langs)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1
    unseen = [r.lang_pred == langs[r.doc_id] for r in rows if r.held_out]
    assert len(unseen) > 20 and np.mean(unseen) >= 0.95


def mixture_by_hand(words, allowed):
    shares = np.array(allowed, float) / sum(allowed)
    p = np.exp(words - words.max(axis=1, keepdims=True))
    for _ in range(language_id.ITERATIONS):
        weight = p * shares
        shares = (weight / weight.sum(axis=1, keepdims=True)).mean(axis=0)
    return shares, (np.log((p * shares).sum(axis=1)) + words.max(axis=1)).sum()


def test_language_sets_equal_one_document_at_a_time():
    rng = np.random.default_rng(2)
    documents = []
    for n in (1, 5, 60, 200, 300):
        words = rng.normal(-12, 1, (n, 4))
        words[: n // 3 + 1, 1] += 8
        words[n // 3 + 1:, 2] += 8
        documents.append(words)
    found = language_id.language_shares(np.concatenate(documents), np.array([len(d) for d in documents]))
    for words, shares in zip(documents, found):
        full, _ = mixture_by_hand(words, [1] * 4)
        order = np.argsort(-full, kind="stable")
        allowed = np.zeros(4, bool)
        allowed[order[0]] = True
        best, value = mixture_by_hand(words, allowed)
        for language in order[1:]:
            if full[language] * len(words) < 0.5:
                break
            wider = allowed.copy()
            wider[language] = True
            mixed, reached = mixture_by_hand(words, wider)
            if reached - value <= language_id.PENALTY * 0.5 * np.log(len(words) + 1):
                break
            allowed, best, value = wider, mixed, reached
        assert np.allclose(best, shares, atol=1e-6)
    assert np.count_nonzero(found[-1]) == 2


def test_long_text_is_read_whole():
    text = "ab cd. " * 5000
    whole = language_id.word_trigrams(text)
    parts = [language_id.word_trigrams(p) for p in language_id._pieces(text, 997)]
    assert np.array_equal(whole[0], np.concatenate([p[0] for p in parts]))
    assert len(whole[1]) == sum(len(p[1]) for p in parts)


def test_language_of_odd_rows(spark):
    schema = "doc_id long, text string, lang string, score string, _text string"
    rows = [(i, "der hund und die katze sind im garten", "de", "s", "t") for i in range(40)]
    rows += [(i, "the dog and the cat are in the garden", "en", "s", "t") for i in range(40, 80)]
    odd = [(100, None, "de", None, "t"), (101, "", None, "s", "t"), (102, "12 !? 😀", "en", "s", "t"), (None, "und der hund", None, "s", "t"),
           (103, "der hund " * 200 + "the cat " * 200, None, "s", "t"), (104, "the garden " * 50_000, None, "s", "t")]
    docs = spark.createDataFrame(rows + odd + odd[-1:], schema)
    model = language_id.fit(docs)
    found = language_id.identify(docs, model).collect()
    assert len(found) == len(rows) + 7
    by = {r.doc_id: r for r in found}
    assert [by[i].lang_pred for i in (100, 101, 102, None, 104)] == ["und", "und", "und", "de", "en"]
    assert by[100].score == 0.0 and by[104].score > 0.99 and by[104]["_text"] == "t"
    assert {x.lang for x in by[103].languages} == {"de", "en"} and 0.4 < by[103].score < 0.6
    empty = docs.limit(0)
    nothing = language_id.fit(empty)
    assert nothing.languages == [] and language_id.identify(empty, model).count() == 0
    assert {r.lang_pred for r in language_id.identify(docs, nothing).collect()} == {"und"}


def counts_by_hand(text):
    text = text or ""
    words = [w for w in "".join("\n" if c in BLANKS else c for c in text).split("\n") if w]
    times = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    repeated = {at + j for at in range(len(words) - 2) if times[tuple(words[at:at + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if any(c not in BLANKS for c in line)]
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            sum(line in lines[:i] for i, line in enumerate(lines)), len(repeated))


def test_quality_query(spark, sf):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = queries.op8_quality_rules(spark, sf).collect()
    assert len(rows) == len(texts)
    for r in rows:
        n_words, *_, repeated = own = counts_by_hand(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == own
        assert r.base_failed == (n_words < 50 or 100 * repeated > 50 * n_words)
        assert not (r.base_failed and r.kept)
    judged = [r.kept == bool(labels[r.doc_id]) for r in rows if r.doc_id in labels and not r.base_failed]
    assert not judged or np.mean(judged) > 0.9


def test_trees_generalise_and_keep_their_constraints():
    rng = np.random.default_rng(0)
    rows = rng.uniform(0, 1, (4000, 4))
    labels = ((np.sin(6 * rows[:, 0]) + 2 * rows[:, 1] - 2 * rows[:, 2] + rng.normal(0, 0.3, 4000)) > 0).astype(float)
    signs = np.array([0, 1, -1, 1])
    forest = boosting.fit(rows[:2000], labels[:2000], signs)
    assert np.mean((forest.score(rows[2000:]) > 0.5) == labels[2000:]) > 0.88
    grid = np.linspace(0, 1, 60)
    for feature, sign in enumerate(signs):
        for row in rows[:40] if sign else []:
            line = np.tile(row, (60, 1))
            line[:, feature] = grid
            assert np.all(sign * np.diff(forest.score(line)) >= -1e-12)


def test_flat_trees_equal_a_walk():
    rng = np.random.default_rng(1)
    rows = rng.normal(size=(500, 3))
    forest = boosting.fit(rows, (rows[:, 0] > rows[:, 1]).astype(float), np.zeros(3, int), trees=10)
    for row, score in zip(rows[:50], forest.score(rows[:50])):
        total = forest.base
        for node in forest.roots:
            while forest.feature[node] >= 0:
                low = row[forest.feature[node]] <= forest.threshold[node]
                node = forest.low[node] if low else forest.high[node]
            total += forest.value[node]
        assert score == pytest.approx(1 / (1 + np.exp(-total)))


def test_quality_of_odd_rows(spark):
    schema = "doc_id long, text string, kept string, _good int"
    fine = " ".join(f"word{i}" for i in range(80))
    rows = [(1, None, "k", 1), (2, "", "k", 1), (3, " \t\n", None, None), (4, fine, "k", 1), (4, fine, "k", 1), (None, fine, "k", 1),
            (5, "a b c " * 100_000, "k", 1), (6, "x y " * 3 + "z\x85", "k", 1)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(1, 1), (1, 0), (None, 1), (4, None)], "doc_id long, quality int")
    assert quality.fit_quality(docs, labels) is None
    found = quality.judge_quality(docs, None).collect()
    assert len(found) == len(rows)
    for r in found:
        text = next(t for i, t, *_ in rows if i == r.doc_id)
        if r.doc_id != 5:
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts_by_hand(text)
        assert r.kept == (r.doc_id in (4, None))
    assert quality.judge_quality(docs.limit(0), None).count() == 0


def test_sharding_equals_plain_scheduling(spark, sf):
    """Few rows: every group is large, so the result is that of one heap over all groups."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    rows = queries.op7_sharding(spark, sf).collect()
    text = {d.doc_id: d.text for d in docs}
    groups, loads = Counter(), Counter()
    for r in rows:
        assert r["size"] == len(text[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode())
        groups[text[r.doc_id]] += r["size"]
        loads[r.shard] += r["size"]
    plain = [0] * 24
    for size in sorted(groups.values(), reverse=True):
        plain[plain.index(min(plain))] += size
    assert sorted(loads.values()) == sorted(plain)
    for shard in loads:
        assert sorted(r.slot for r in rows if r.shard == shard) == list(range(sum(r.shard == shard for r in rows)))
    assert len({(text[r.doc_id], r.shard) for r in rows}) == len(groups)


def test_sharding_of_small_groups_is_even(spark):
    docs = spark.range(30_000).select(F.col("id").alias("doc_id"), F.expr("repeat('x', cast(id % 700 as int)) || id").alias("text"))
    loads = sharding.shard_documents(docs, shards=3).groupBy("shard").agg(F.sum("size").alias("s"), F.max("slot").alias("m"), F.count("*").alias("n")).collect()
    sizes = [r.s for r in loads]
    assert len(sizes) == 3 and max(sizes) - min(sizes) < 0.002 * max(sizes)
    assert all(r.m == r.n - 1 for r in loads)


def test_sharding_of_odd_rows(spark):
    schema = "doc_id long, text string, size string, a string, shard string"
    rows = [(1, None, "s", "a", "x"), (2, "", "s", "a", "x"), (3, "t", None, None, None), (3, "t", "s", "a", "x"), (None, "t", "s", "a", "x"),
            (4, "é" * 100_000, "s", "a", "x")]
    found = sharding.shard_documents(spark.createDataFrame(rows, schema), shards=2).collect()
    assert sorted((r["size"], r.slot >= 0) for r in found) == [(8, True), (8, True), (9, True), (9, True), (9, True), (200_008, True)]
    by = {}
    for r in found:
        by.setdefault(r.text_crc32, set()).add(r.shard)
    assert all(len(s) == 1 for s in by.values())
    assert sharding.shard_documents(spark.createDataFrame([], schema)).count() == 0


def test_sharding_of_many_equal_rows(spark):
    """Two thirds of the rows are one row: it fills a shard, and slots stay gapless."""
    n = 200_000
    docs = spark.range(n).selectExpr("CASE WHEN id % 3 < 2 THEN 7 ELSE id END AS doc_id", "CASE WHEN id % 3 < 2 THEN 'one' ELSE concat('t', id) END AS text")
    rows = sharding.shard_documents(docs, shards=4).groupBy("shard").agg(
        F.count("*").alias("n"), F.countDistinct("slot").alias("slots"), F.max("slot").alias("last"), F.count_if(F.col("doc_id") == 7).alias("same")
    ).collect()
    assert sum(r.n for r in rows) == n and all(r.n == r.slots == r.last + 1 for r in rows)
    assert [r.same for r in rows if r.same] == [n - n // 3]
