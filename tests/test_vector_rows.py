"""Vectors with one row per document against their long form, for ids that repeat or are null as well."""

import pytest
from pyspark.sql import functions as F

from reviewlab.operators import models, vectors

IDS = [(1, ["a", "b", "a", "c"]), (2, ["c", "a b"]), (3, None), (4, ["z"]), (5, ["b", None, "b", "a", "b"])]
ODD = [(1, ["a"]), (None, ["a", "b"]), (None, ["b", "c", "c"]), (6, ["b"]), (6, []), (7, ["c", "b"])]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, words array<string>").repartition(3)


@pytest.fixture(scope="module")
def terms(spark):
    table = [("a", 0, 1.5), ("a b", 1, 2.0), ("b", 2, 1.25), ("b a", 3, 3.0), ("c", 4, 1.0)]
    return spark.createDataFrame(table, "term string, idx long, idf double")


def as_dict(df, *keys):
    rows = df.collect()
    found = {tuple(r[k] for k in keys): r["value"] for r in rows}
    assert len(found) == len(rows)
    return found


@pytest.mark.parametrize("rows", [IDS, IDS + ODD])
@pytest.mark.parametrize("sizes", [(1, 1), (1, 2)])
def test_rows_hold_the_long_form(spark, terms, rows, sizes):
    documents = frame(spark, rows)
    held = vectors.tfidf_rows(documents, terms, sizes, 5)
    wanted = as_dict(vectors.tfidf_vectors(documents, terms, sizes, 5), "doc_id", "idx")
    assert as_dict(vectors.unfolded(held), "doc_id", "idx") == pytest.approx(wanted)
    assert all(r["idx"] == sorted(r["idx"]) for r in held.collect())
    assert len(held.collect()) == held.select("doc_id").distinct().count()


def test_own_ids_need_no_exchange(spark, terms):
    plan = vectors.tfidf_rows(frame(spark, IDS).coalesce(2), terms, (1, 2), 5)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "MapInArrow" in plan


def test_rows_of_a_large_vocabulary(spark, terms, monkeypatch):
    documents = frame(spark, IDS + ODD)
    wanted = as_dict(vectors.unfolded(vectors.tfidf_rows(documents, terms)), "doc_id", "idx")
    monkeypatch.setattr(vectors, "is_small", lambda table: False)
    assert as_dict(vectors.unfolded(vectors.tfidf_rows(documents, terms)), "doc_id", "idx") == pytest.approx(wanted)


@pytest.mark.parametrize("rows", [IDS, IDS + [r for r in ODD if r[0] is not None]])
def test_copies_take_the_row_of_their_document(spark, terms, rows):
    documents = frame(spark, rows)
    draws = spark.createDataFrame([(1, 0), (1, 7), (2, 3), (5, 3), (6, 1), (7, 0), (7, 1)], "doc_id long, draw long")
    drawn = documents.join(draws, "doc_id")
    found = vectors.unfolded(vectors.drawn_tfidf_rows(documents, drawn, terms, (1, 1), 5))
    wanted = as_dict(vectors.tfidf_vectors(drawn, terms, (1, 1), 5), "doc_id", "draw", "idx")
    assert as_dict(found, "doc_id", "draw", "idx") == pytest.approx(wanted)


def test_models_read_both_forms(spark):
    cells = [(1, 0, 0.5), (1, 2, 0.0), (2, 1, -1.0), (2, 0, 2.0), (1, 4, 3.0)]
    long = spark.createDataFrame(cells, "doc_id long, idx long, value double")
    documents = spark.createDataFrame([(1,), (2,), (3,), (1,)], "doc_id long")
    left, right = long.where("idx < 2"), long.where("idx >= 2").withColumn("idx", F.col("idx") - 2)
    stacked = vectors.combine_rows((vectors.folded(left), 2), (vectors.folded(right), 3))
    wanted = {(r["doc_id"], str(r["features"])) for r in models.sparse_features(long, documents, 5).collect()}
    found = [(r["doc_id"], str(r["features"])) for r in models.sparse_features(stacked, documents, 5).collect()]
    assert set(found) == wanted and len(found) == 4


def test_a_block_holds_each_entry_once(spark):
    from reviewlab.operators import linear_svm

    rows = spark.createDataFrame([(i, i % 2, 0, list(range(40)), [1.0] * 40) for i in range(50)], "doc_id long, y int, fold int, idx array<int>, value array<double>")
    blocks = linear_svm.document_blocks(rows, 40, ["doc_id"]).drop("carried")
    parts = [F.length(c) for c, kind in blocks.dtypes if kind == "binary"]
    held = blocks.agg(F.sum(sum(parts, F.lit(0)))).first()[0]
    # an index of 4 and a value of 8 bytes an entry; labels, folds and bounds are a few numbers a document
    assert held <= 50 * 41 * 12 + 50 * 32
