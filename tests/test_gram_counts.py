"""N-grams counted in Arrow batches against plain counting."""

import random
from collections import Counter

import pytest

from reviewlab.operators import gram_counts, vectors
from reviewlab.operators.counting_filter import repeated_counts

WORDS = [f"w{i}" for i in range(30)] + ["é", "", "a b", "b", "a", "b c"]


def grams_of(words, low, high):
    return [" ".join(words[i:i + n]) for n in range(low, high + 1) for i in range(len(words) - n + 1)]


def texts(seed, vocabulary=WORDS):
    rng = random.Random(seed)
    return [rng.choices(vocabulary, k=rng.choice([0, 1, 2, 3, 40])) for _ in range(50)] + [None, []]


def frame(spark, docs, parts=3):
    return spark.createDataFrame(list(enumerate(docs)), "doc_id long, words array<string>").repartition(parts)


@pytest.mark.parametrize("sizes", [(1, 1), (1, 3), (2, 3)])
@pytest.mark.parametrize("run_words", [7, 1 << 20])
def test_frequencies(spark, monkeypatch, sizes, run_words):
    docs = [d for d in texts(1)]
    monkeypatch.setattr(gram_counts, "RUN_WORDS", run_words)
    own = [grams_of(d, *sizes) for d in docs if d]
    tf, df = Counter(g for d in own for g in d), Counter(g for d in own for g in set(d))
    found = vectors.term_statistics(frame(spark, docs), sizes).collect()
    assert {r["term"]: (r["df"], r["tf"]) for r in found} == {g: (df[g], tf[g]) for g in tf}
    again = vectors.term_statistics(frame(spark, docs), sizes, repeated_only=True).where("df > 1").collect()
    assert {r["term"]: (r["df"], r["tf"]) for r in again} == {g: (df[g], tf[g]) for g in tf if df[g] > 1}


def test_one_row_per_term_and_run_not_per_occurrence(spark):
    docs = [["a", "b"] * 500] * 20
    rows = gram_counts.counted(frame(spark, docs, 1), (1, 2)).collect()
    assert sorted((r["term"], r["df"], r["tf"]) for r in rows) == [
        ("a", 20, 10_000), ("a b", 20, 10_000), ("b", 20, 10_000), ("b a", 20, 9_980),
    ]


def test_a_term_has_one_hash(spark):
    """A word with a blank and the bigram that spells the same are one term for the filter too."""
    rows = repeated_counts(frame(spark, [["a b"], ["a", "b"], ["x", "a b c"], ["x", "a", "b c"]], 4), (1, 3)).collect()
    found = Counter()
    for r in rows:
        found[r["term"]] += r["df"]
    assert {"a b", "a b c", "x", "x a b c"} <= {t for t, n in found.items() if n == 2}


def test_null_words(spark):
    rows = vectors.term_statistics(frame(spark, [["a", None, "b", "c"], [None]]), (1, 2)).collect()
    assert {r["term"]: r["df"] for r in rows} == {"a": 1, "b": 1, "c": 1, None: 2, "b c": 1}


@pytest.mark.parametrize("places", [16, 1 << 12, 1 << 21])
@pytest.mark.parametrize("n", [3, 40])
def test_most_frequent_terms_by_bounds(spark, monkeypatch, places, n):
    """Whatever hides in a place, the vocabulary is the exact one, ties by term."""
    docs = texts(2, [f"w{min(i, 300 // (i + 1))}" for i in range(60)] + ["a b", "a", "b"])
    monkeypatch.setattr(gram_counts.frequency_bounds, "__defaults__", (places,))
    own = [grams_of(d, 1, 3) for d in docs if d]
    tf, df = Counter(g for d in own for g in d), Counter(g for d in own for g in set(d))
    allowed = [g for g in tf if 2 <= df[g] <= 0.3 * len(docs)]
    best = sorted(allowed, key=lambda g: (-tf[g], g))[:n]
    found = vectors.fit_terms(frame(spark, docs), (1, 3), n, 2, 0.3).collect()
    assert {r["term"]: (r["idx"], r["df"], r["tf"]) for r in found} == {g: (i, df[g], tf[g]) for i, g in enumerate(sorted(best))}


def test_only_frequent_terms_are_shuffled(spark):
    docs = [["the", "best", f"x{i}", f"y{i}"] * 3 for i in range(400)]
    documents = frame(spark, docs)
    bounds = gram_counts.frequency_bounds(documents, (1, 2))
    assert bounds.sum() == sum(len(grams_of(d, 1, 2)) for d in docs)
    kept = vectors.term_statistics(documents, (1, 2), False, gram_counts.on_places(documents, bounds >= 1200)).collect()
    assert {"the", "best", "the best"} <= {r["term"] for r in kept} and len(kept) < 20


def test_counts_of_known_terms_keep_repeated_and_null_ids(spark):
    documents = spark.createDataFrame(
        [(1, ["a", "b", "a"]), (1, ["a"]), (None, ["a b", "b"]), (2, None), (3, ["z"])], "doc_id long, words array<string>"
    )
    terms = spark.createDataFrame([("a", 0), ("a b", 1), ("b", 2), ("z z", 3), ("b", 4)], "term string, idx long")
    found = vectors.count_vectors(documents, terms, (1, 2), 5).collect()
    assert {tuple(r) for r in found} == {(1, 0, 3.0), (1, 1, 1.0), (1, 2, 1.0), (1, 4, 1.0), (None, 1, 1.0), (None, 2, 1.0), (None, 4, 1.0)}


def test_vectors_are_put_together_in_all_partitions(spark):
    """Few partitions, as the optimizer makes of small rows, would each hold the entries of many documents."""
    documents = frame(spark, [["a", "b", "a"]] * 40, 2)
    terms = spark.createDataFrame([("a", 0, 1.0), ("b", 1, 1.0)], "term string, idx long, idf double")
    found = vectors.tfidf_vectors(documents, terms, (1, 1), 2)
    assert found.rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert found.count() == 80
