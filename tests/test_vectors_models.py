"""Vocabulary, vectors, naive Bayes, Spark ML models and metrics."""

import math
from collections import Counter

import pytest
from pyspark.ml.classification import NaiveBayes
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.operators import evaluation, models, naive_bayes, vectors
from reviewlab.plans import experiment, fixtures as fx, queries

TEXTS = ["good game good fun", "bad game", "café game fun fun", "", "unseen"]


@pytest.fixture(scope="module")
def words(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    return vectors.document_words(frame)


def terms_of(frame):
    return [(r["term"], r["idx"], r["df"], r["tf"]) for r in frame.orderBy("idx").collect()]


def test_vocabulary_by_hand(words):
    terms = vectors.fit_terms(words, min_df=2)
    assert terms_of(terms) == [("fun", 0, 2, 3), ("game", 1, 3, 3)]
    idf = {r["term"]: r["idf"] for r in terms.collect()}
    assert idf["game"] == pytest.approx(math.log(6 / 4) + 1)


def test_limits_and_ties(words):
    # good and bad... : ties in frequency go by term
    assert terms_of(vectors.fit_terms(words, max_features=2)) == [("fun", 0, 2, 3), ("game", 1, 3, 3)]
    assert [t[0] for t in terms_of(vectors.fit_terms(words, max_features=4))] == ["bad", "fun", "game", "good"]
    assert [t[0] for t in terms_of(vectors.fit_terms(words, max_df=1))] == ["bad", "cafe", "good", "unseen"]
    assert [t[0] for t in terms_of(vectors.fit_terms(words, max_df=0.4, min_df=0.4))] == ["fun"]
    assert [t[0] for t in terms_of(vectors.fit_terms(words, (2, 2), min_df=2))] == []


def test_unlimited_vocabulary_equals_limited(words):
    assert terms_of(vectors.fit_terms(words, (1, 3))) == terms_of(vectors.fit_terms(words, (1, 3), max_features=10_000))


def test_large_max_features_uses_the_distributed_way(words, monkeypatch):
    expected = terms_of(vectors.fit_terms(words, (1, 2), max_features=5))
    monkeypatch.setattr(vectors, "BROADCAST_ROW_LIMIT", 1)
    assert terms_of(vectors.fit_terms(words, (1, 2), max_features=5)) == expected


def test_transform(words, monkeypatch):
    terms = vectors.fit_terms(words, (1, 2))
    found = vectors.tfidf_vectors(words, terms, (1, 2))
    norms = found.groupBy("doc_id").agg(F.sum(F.col("value") ** 2).alias("n")).collect()
    assert sorted(r["doc_id"] for r in norms) == [0, 1, 2, 4]
    assert all(r["n"] == pytest.approx(1.0) for r in norms)
    monkeypatch.setattr(vectors, "is_small", lambda table: False)
    salted = vectors.tfidf_vectors(words, terms, (1, 2))
    both = found.join(salted.withColumnRenamed("value", "other"), ["doc_id", "idx"])
    assert both.count() == found.count() == salted.count()
    assert both.where(F.abs(F.col("value") - F.col("other")) > 1e-12).isEmpty()


def test_counts_equal_spark_ml(spark, sf):
    tokens = vectors.document_words(fx.table(spark, sf, "documents"))
    terms = vectors.fit_counts(tokens, min_df=2)
    ours = vectors.count_vectors(tokens, terms).join(terms, "idx").select("doc_id", "term", "value")
    model = CountVectorizer(inputCol="words", outputCol="v", minDF=2).fit(tokens)
    vocabulary = model.vocabulary
    theirs = Counter()
    for row in model.transform(tokens).select("doc_id", "v").collect():
        for i, x in zip(row["v"].indices, row["v"].values):
            theirs[row["doc_id"], vocabulary[i]] = float(x)
    assert {(r["doc_id"], r["term"]): r["value"] for r in ours.collect()} == dict(theirs)


def test_transform_needs_one_exchange_for_documents(spark, sf):
    tokens = vectors.document_words(fx.table(spark, sf, "documents"))
    terms = vectors.fit_terms(tokens, (1, 2), 100)
    found = vectors.tfidf_vectors(tokens, terms, (1, 2), 100)
    plan = found._jdf.queryExecution().executedPlan().toString()
    documents_side = plan.split("BroadcastExchange")[0]
    assert documents_side.count("Exchange hashpartitioning") == 1
    assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_combine_and_top(words):
    terms = vectors.fit_terms(words)
    tfidf = vectors.tfidf_vectors(words, terms)
    stacked = vectors.combine((tfidf, vectors.width_of(terms)), (tfidf, 3))
    n = terms.count()
    assert stacked.count() == 2 * tfidf.count()
    assert stacked.agg(F.max("idx")).first()[0] == 2 * n - 1
    best = vectors.top_terms(tfidf, terms, 1).where("doc_id = 0").first()
    assert best["term"] == "good" and best["rank"] == 1


def test_minmax(spark):
    cells = [(1, 0, -1.0), (2, 0, 3.0), (1, 1, 5.0), (2, 1, 5.0), (1, 2, 4.0)]
    table = spark.createDataFrame(cells, "doc_id bigint, idx bigint, value double")
    scaled = vectors.minmax_scale(table, vectors.minmax_limits(table, F.lit(2)))
    assert {(r["doc_id"], r["idx"]): r["value"] for r in scaled.collect()} == {
        (1, 0): 0.0, (2, 0): 1.0, (1, 1): 0.0, (2, 1): 0.0, (1, 2): 1.0,
    }


def test_sparse_features(spark):
    table = spark.createDataFrame([(1, 4, 2.5), (1, 0, 1.0), (1, 2, 0.0)], "doc_id bigint, idx bigint, value double")
    documents = spark.createDataFrame([(1,), (2,)], "doc_id bigint")
    rows = {r["doc_id"]: r["features"] for r in models.sparse_features(table, documents, 6).collect()}
    assert rows[1].toArray().tolist() == [1.0, 0, 0, 0, 2.5, 0]
    assert rows[2].size == 6 and rows[2].numNonzeros() == 0


def test_naive_bayes_equals_spark_ml(spark, sf):
    documents, terms, counts = queries._quality_vectors(spark, sf)
    train = documents.where("set = 'train'").select("doc_id", "label")
    model = naive_bayes.fit(counts, train, terms, ["0", "1"], alpha=1.0)
    ours = naive_bayes.predict(counts, documents, model, naive_bayes.log_priors(train, ["0", "1"]), ["0", "1"])
    rows = models.sparse_features(counts, documents, terms.count()).withColumn("y", F.col("label").cast("double"))
    fitted = NaiveBayes(labelCol="y", smoothing=1.0).fit(rows.where("set = 'train'"))
    theirs = fitted.transform(rows).select("doc_id", "prediction")
    pairs = ours.select("doc_id", F.col("prediction").alias("p")).join(theirs, "doc_id").collect()
    assert len(pairs) == documents.count()
    known = {r["doc_id"] for r in counts.select("doc_id").distinct().collect()}
    differing = [r for r in pairs if float(r["p"]) != r["prediction"] and r["doc_id"] in known]
    assert not differing


def test_unknown_words_get_the_prior(spark):
    vec = spark.createDataFrame([(1, 0, 2.0), (2, 1, 1.0), (3, 1, 1.0)], "doc_id bigint, idx bigint, value double")
    labels = spark.createDataFrame([(1, "negative"), (2, "positive"), (3, "positive")], "doc_id bigint, label string")
    documents = labels.select("doc_id").unionByName(spark.createDataFrame([(9,)], "doc_id bigint"))
    classes = ["negative", "positive"]
    model = naive_bayes.fit(vec, labels, spark.range(3).toDF("idx"), classes)
    assert model.count() == 3
    total = model.agg(*[F.sum(F.exp(c)).alias(c) for c in classes]).first()
    assert total["negative"] == pytest.approx(1.0) and total["positive"] == pytest.approx(1.0)
    for fit_prior, expected in [(True, "positive"), (False, "negative")]:
        priors = naive_bayes.log_priors(labels, classes, fit_prior)
        found = naive_bayes.predict(vec, documents, model, priors, classes)
        assert {r["doc_id"]: r["prediction"] for r in found.collect()}[9] == expected


def test_bayes_search_equals_separate_fits(spark, sf):
    """The one-pass search against a model fitted for each fold and setting."""
    _, terms, counts = queries._quality_vectors(spark, sf)
    representation, folds = queries._quality_folds(spark, sf)
    classes = ["0", "1"]
    features = spark.range(queries._QUALITY_TERMS).toDF("idx")
    together = naive_bayes.cross_validate(counts, folds, features, classes, [0.1, 2.0], [True])
    for fold, alpha in [(0, 0.1), (3, 2.0)]:
        others = folds.where(F.col("fold") != fold)
        judged = folds.where(F.col("fold") == fold)
        model = naive_bayes.fit(counts, others, features, classes, alpha)
        alone = naive_bayes.predict(counts, judged, model, naive_bayes.log_priors(others, classes), classes)
        same = together.where((F.col("fold") == fold) & (F.col("alpha") == alpha)).select("doc_id", "prediction")
        assert same.exceptAll(alone.select("doc_id", "prediction")).isEmpty()
        assert same.count() == judged.count()


def test_grids():
    grids = models.parameter_grids()
    assert [len(models.combinations(grids[m])) for m in (models.NAIVE_BAYES, models.SVM, models.FOREST)] == [10, 16, 81]
    assert len(models.search_settings(models.FOREST)) == 20
    assert models.search_settings(models.FOREST) == models.search_settings(models.FOREST)
    assert len(models.search_settings(models.SVM)) == 16
    assert models.forest(max_depth=None, min_samples_split=10).getMinInstancesPerNode() == 5


@pytest.mark.parametrize("model, params", [(models.SVM, {"max_iter": 20}), (models.FOREST, {"n_estimators": 5, "max_depth": 4})])
def test_separable_classes_are_learned(spark, model, params):
    documents = spark.range(60).select(
        F.col("id").alias("doc_id"), F.element_at(F.array(*[F.lit(c) for c in fv.CLASS_ORDER]), (F.col("id") % 3 + 1).cast("int")).alias("label"),
        F.when(F.col("id") % 5 == 0, "test").when(F.col("id") % 5 == 1, "validation").otherwise("train").alias("set"),
    )
    cells = documents.select("doc_id", (F.col("doc_id") % 3).alias("idx"), F.lit(1.0).alias("value"))
    run = models.evaluate(model, models.Representation("r", cells, 3), documents, **params)
    again = models.evaluate(model, models.Representation("r", cells, 3), documents, **params)
    assert run.metrics["test"]["f1_score"] == 1.0 == run.metrics["validation"]["accuracy"]
    assert run.predictions.exceptAll(again.predictions).isEmpty()
    assert set(run.record()) == {c.split()[0] for c in experiment.RESULT_SCHEMA.split(", ")}


def test_unknown_models_are_refused(spark):
    empty = spark.createDataFrame([], "doc_id long, label string, set string")
    with pytest.raises(ValueError, match="Unknown model"):
        models.evaluate("Oracle", models.Representation("r", empty, 1), empty)


def judged(spark, pairs):
    return spark.createDataFrame([(i, *p) for i, p in enumerate(pairs)], "doc_id int, label string, prediction string")


def test_metrics_with_an_absent_class(spark):
    table = judged(spark, [("negative", "negative"), ("neutral", "negative"), ("positive", "neutral"), ("neutral", "neutral")])
    rows = {r["label"]: r for r in evaluation.per_class_metrics(table).collect()}
    assert rows["positive"]["precision"] == 0.0 and rows["positive"]["f1"] == 0.0
    assert rows["negative"]["precision"] == 0.5 and rows["negative"]["recall"] == 1.0
    overall = evaluation.weighted_metrics(table).first()
    assert overall["accuracy"] == 0.5
    matrix = [tuple(r)[1:] for r in evaluation.confusion_matrix(table).collect()]
    assert matrix == [("negative", 1, 0, 0), ("neutral", 1, 1, 0), ("positive", 0, 1, 0)]
    report = {r["label"] for r in evaluation.classification_report(table).collect()}
    assert report == {*fv.CLASS_ORDER, "accuracy", "macro avg", "weighted avg"}


def test_a_class_that_never_occurs(spark):
    table = judged(spark, [("negative", "negative")])
    assert evaluation.weighted_metrics(table).first()["f1_score"] == 1.0
    assert evaluation.confusion_matrix(table).count() == 3


def test_ranking_ties(spark):
    table = spark.createDataFrame([("b", "x", 0.5), ("a", "x", 0.5), ("c", "x", 0.9)], "model string, representation string, f1_score double")
    assert [r["model"] for r in evaluation.rank_models(table).collect()] == ["c", "a", "b"]
    assert evaluation.rank_models(table, top=1).count() == 1


def test_whole_route(spark, sf):
    """Documents to tuned models on small vocabularies: every model on every representation."""
    documents, named = queries._experiment(spark, sf)
    assert list(named) == [
        "tfidf_1gram", "tfidf_2gram", "tfidf_3gram", "linguistic", "combined_1gram", "combined_2gram", "combined_3gram",
    ]
    assert named["combined_2gram"].width == fv.NGRAM_FEATURES[2] + 22
    few = {k: named[k] for k in ("tfidf_1gram", "combined_1gram")}
    keys = documents.select("doc_id", "label", "set")
    runs = experiment.model_matrix(few, keys, {models.NAIVE_BAYES: {}, models.FOREST: {"n_estimators": 3, "max_depth": 3}})
    assert len(runs) == 4
    settings = {models.NAIVE_BAYES: [{"alpha": a, "fit_prior": True} for a in (0.1, 1.0)],
                models.FOREST: [{"n_estimators": 3, "max_depth": d} for d in (2, 3)]}
    tuned = experiment.tune(runs, few, keys, top=4, settings=settings)
    assert len(tuned) == 4 and all(0 <= f1 <= 1 for _, f1 in tuned)
    assert all(run.params for run, _ in tuned)


def test_metrics_without_rows_and_with_other_labels(spark):
    schema = "label string, prediction string, set string"
    empty = spark.createDataFrame([], schema)
    assert tuple(evaluation.weighted_metrics(empty, ["a", "b"]).first()) == (0.0, 0.0, 0.0, 0.0)
    assert evaluation.metrics_by_set(empty, ["a", "b"]).isEmpty()
    assert evaluation.classification_report(empty, ["a", "b"]).where("f1 > 0").isEmpty()
    odd = spark.createDataFrame([("a", "a", "x"), ("z", "z", "x"), ("z", "a", "x"), (None, "a", "x"), ("z", "z", "y")], schema)
    found = {r["set"]: r for r in evaluation.metrics_by_set(odd, ["a", "b"]).collect()}
    assert found["x"]["accuracy"] == 2 / 3 and found["x"]["recall"] == 1.0
    assert found["y"]["accuracy"] == 1.0 and found["y"]["f1_score"] == 0.0


def test_facts_of_a_model_are_given_for_every_set_and_label(spark):
    from reviewlab.plans.queries import _judged

    rows = [(i, s, str(i % 2)) for i, s in enumerate(["train"] * 6 + ["test"] * 4)]
    documents = spark.createDataFrame(rows, "doc_id long, set string, label string")
    run = models.Evaluation("m", "r", documents.withColumn("prediction", F.col("label")), {s: {"f1_score": 1.0} for s in ("train", "test")}, 1.0, 1.0)
    found = {(r["set"], r.label): (r.n, r.n_ids, r.known_classes, r.recomputed_f1, r.beats_majority) for r in _judged(run, documents, ("set", "label")).collect()}
    assert found == {(s, x): (n, n, True, True, True) for s, n in (("train", 3), ("test", 2)) for x in "01"}
