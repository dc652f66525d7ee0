"""The pipeline's stages against brute force on their own inputs."""

import importlib.util
import os
import sys

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import corpus_pipeline  # noqa: E402
from reviewlab.session import materialize  # noqa: E402
from test_packing import check_packing, tokenizer  # noqa: E402, F401
from test_simhash import fingerprint, roots  # noqa: E402

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@pytest.fixture(scope="module")
def stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        out.append(materialize(stage(spark, out[-1], sf), name))
        if name != "packing":
            assert out[-1].dtypes == docs.dtypes
    return [{r.doc_id: r for r in table.collect()} for table in out[:-1]] + [out[-1].collect()]


def test_languages(stages):
    before, after = stages[0], stages[1]
    assert after == {i: r for i, r in before.items() if any(c.isalpha() for c in r.text or "")}


def test_lines(stages):
    before, after = stages[1], stages[2]
    holders = {}
    for i, r in before.items():
        for line in r.text.split("\n"):
            key = line.strip(" \t\n\x0b\f\r").translate(UPPER)
            if len(key) >= 40:
                holders.setdefault(key, set()).add(i)
    assert set(after) == set(before)
    for i, r in before.items():
        kept = [
            line for line in r.text.split("\n")
            if len(own := holders.get(line.strip(" \t\n\x0b\f\r").translate(UPPER), ())) < 5 or max(own) == i
        ]
        assert after[i].text == "\n".join(kept)
        assert after[i].n_chars == (r.n_chars if after[i].text == r.text else len(after[i].text))


def test_near_copies(stages):
    before, after = stages[2], stages[3]
    ids = sorted(before)
    label = roots([fingerprint(before[i].text) for i in ids])
    assert set(after) == {ids[root] for root in label}


def test_contamination(stages, spark, sf):
    before, after = stages[3], stages[4]

    def words(text):
        return "".join(c if c in "0123456789abcdefghijklmnopqrstuvwxyz" or ord(c) >= 128 else " " for c in (text or "").translate(UPPER)).split(" ")

    windows = set()
    for item in spark.read.parquet(f"{sf}/benchmark.parquet").collect():
        own = [w for w in words(item.text) if w]
        size = min(10, len(own))
        windows |= {tuple(own[i:i + size]) for i in range(len(own) - size + 1)} if own else set()
    for i, r in before.items():
        own = [w for w in words(r.text) if w]
        sizes = {len(w) for w in windows}
        hit = any(tuple(own[at:at + n]) in windows for n in sizes for at in range(len(own) - n + 1))
        assert (i in after) != hit


def test_packing(stages, tokenizer):  # noqa: F811
    check_packing(stages[5], {i: r.text for i, r in stages[4].items()}, tokenizer, 4096)


def test_odd_rows_pass_every_stage(spark, sf):
    prose = "Der Hund und die Katze sind im Garten unter dem alten Baum"
    schema = "doc_id long, text string, lang string, kept_text string, n_words int, _row string, contaminated string, n_chars long"
    rest = (7, "x", "y", 3)
    rows = [
        (i, f"{prose} {w} {w}", "de", *[rest[1], rest[0], rest[2], "z", 5])
        for i, w in enumerate("eins zwei drei vier fünf sechs sieben acht neun zehn".split())
    ]
    rows += [(None, None, None, None, None, None, None, None), (20, "", "de", None, None, None, None, None),
             (21, "12 34", "de", "k", 1, "r", "c", 1), (None, prose * 3, "de", None, None, None, None, None),
             (None, prose * 3, "de", None, None, None, None, None), (30, "wort " * 40_000, "de", "k", 1, "r", "c", 200_000)]
    docs = spark.createDataFrame(rows, schema)
    for table in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            before, table = table, materialize(stage(spark, table, sf), name)
            if name != "packing":
                assert table.columns == docs.columns
                assert before.where("doc_id = 30").count() == table.where("doc_id = 30").count()
    langs = corpus_pipeline.keep_known_languages(spark, docs, sf)
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in langs.collect()) == [-1, -1, *range(10), 30]
    assert corpus_pipeline.keep_one_of_near_copies(spark, langs, sf).where("doc_id is null").count() == 1
