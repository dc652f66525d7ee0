"""Annotations in one row per document give what annotations in one row per token give."""

import json

import pytest
from pyspark.sql import functions as F

from reviewlab.operators import annotations, lookup, normalization

ROWS = [
    (1, "The old dice are not very good. No dice!"), (2, ""), (3, None), (None, "Not the end. Very good"),
    (4, "The red dice"), (4, "A much longer text than the other. It is not short"), (5, "no"), (None, "red"),
]


@pytest.fixture(scope="module")
def texts(spark):
    return spark.createDataFrame(ROWS, "doc_id bigint, text string")


def pos_of(token):
    return F.when(F.lower(token) == "the", "DT").when(F.lower(token).isin("old", "red"), "JJ").when(F.length(token) > 2, "NNS")


def both(texts):
    return annotations.annotate_by_rules(texts, pos_of=pos_of), annotations.document_annotations(texts, pos_of=pos_of)


def rows(df):
    return sorted((json.dumps(r.asDict(), sort_keys=True) for r in df.collect()))


def test_same_annotations(texts):
    flat, documents = both(texts)
    taken_apart = annotations.token_rows(documents)
    assert taken_apart.dtypes == flat.dtypes and rows(taken_apart) == rows(flat)


def test_same_phrases(texts):
    flat, documents = both(texts)
    assert rows(annotations.noun_phrases(documents)) == rows(annotations.noun_phrases(flat))


def test_same_heads(texts):
    flat, documents = (df.withColumn("head_idx", moved) for df, moved in zip(both(texts), (
        F.when(F.col("head_idx") > 0, F.col("head_idx") + 4).otherwise(F.col("head_idx")),
        F.transform("head_idx", lambda s: F.transform(s, lambda i: F.when(i > 0, i + 4).otherwise(i))),
    )))
    assert rows(annotations.fill_heads(documents)) == rows(annotations.fill_heads(flat))


def test_same_tags(texts):
    flat, documents = both(texts)
    # a document without annotations, one whose tokens are fewer than its tags, and one that is annotated twice
    cut = texts.withColumn("text", F.expr("CASE WHEN doc_id = 1 THEN left(text, 20) ELSE text END"))
    expected = annotations.token_pos_join(annotations.token_table(texts), annotations.annotate_by_rules(cut.where("doc_id <> 5"), pos_of=pos_of))
    found = annotations.token_pos_join(annotations.document_tokens(texts), annotations.document_annotations(cut.where("doc_id <> 5"), pos_of=pos_of))
    assert rows(found) == rows(expected)


MAPPING = [("dice", "n", "die"), ("dice", "a", "x"), ("good", "n", None), ("red", "a", "ruddy"), (None, "n", "y"), ("no", None, "z")]


@pytest.mark.parametrize("limit", [20_000, 2])
def test_same_normal_forms(spark, texts, monkeypatch, limit):
    monkeypatch.setattr(lookup, "CONSTANT_ROW_LIMIT", limit)
    flat, documents = both(texts)
    mapping = spark.createDataFrame(MAPPING, "term string, pos_class string, normal_form string")
    expected, found = (normalization.normalize_terms_pos(texts, a, mapping) for a in (flat, documents))
    assert rows(found) == rows(expected)


def test_single_documents_keep_their_tokens_in_the_row(spark, texts):
    once, repeated = lookup.by_repetition(annotations.document_annotations(texts), "doc_id")
    assert sorted(r[0] for r in once.select("doc_id").collect()) == [1, 2, 3, 5]
    assert repeated.count() == 4
    assert "Exchange hashpartitioning" not in once._jdf.queryExecution().executedPlan().toString()


def test_lookup_within_the_row(spark):
    table = spark.createDataFrame([(f"w{i}", f"v{i}" if i else None) for i in range(50)], "name string, value string")
    find = lookup.row_lookup(table, "name", "value")
    asked = spark.createDataFrame([("w7",), ("w0",), ("w50",), (None,), ('"',)], "c string")
    assert [r[0] for r in asked.select(find(F.col("c"))).collect()] == ["v7", None, None, None, None]
