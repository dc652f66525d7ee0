"""Classifiers on Spark ML, their grids, cross-validation and timed evaluation."""

from __future__ import annotations

import itertools
import math
import random
import time
from dataclasses import dataclass, field

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reviewlab.functions import fixed_values as fv
from reviewlab.operators import evaluation, forests, linear_svm, naive_bayes
from reviewlab.operators.vectors import minmax_limits, minmax_scale
from reviewlab.session import materialize

NAIVE_BAYES, SVM, FOREST = "Naive Bayes", "SVM", "Random Forest"
#: Relative duality gap of support vector machines while a grid is searched; final fits use the operator's own.
SEARCH_TOLERANCE = 1e-2
_UNLIMITED_DEPTH = 30  # the deepest tree Spark ML grows


# --- the edge between long-form vectors and Spark ML -------------------------------------------


def document_entries(vectors: DataFrame, documents: DataFrame) -> DataFrame:
    """`documents` with `_e`, their entries `(idx, value)` in order; a document's are bounded by its length.

    `vectors` is in long form, or has arrays `idx` and `value` in one or more rows per document.
    """
    if dict(vectors.dtypes)["idx"].startswith("array"):
        held = vectors.select("doc_id", F.filter(F.arrays_zip("idx", "value"), lambda e: e["value"] != 0).alias("_e"))
        entries = held.groupBy("doc_id").agg(F.array_sort(F.flatten(F.collect_list("_e"))).alias("_e"))
    else:
        entries = vectors.where(F.col("value") != 0).groupBy("doc_id").agg(
            F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("_e")
        )
    return documents.join(entries, "doc_id", "left")


def sparse_features(vectors: DataFrame, documents: DataFrame, width: int | Column) -> DataFrame:
    """`documents` with a sparse `features` column; documents without entries get the zero vector.

    The vector is spelled as JSON and read back with the vector type, which keeps the conversion in
    the JVM.
    """
    parts = F.struct(
        F.struct(
            F.lit(0).alias("type"),
            (width if isinstance(width, Column) else F.lit(width)).cast("int").alias("size"),
            F.coalesce(F.col("_e.idx").cast("array<int>"), F.array().cast("array<int>")).alias("indices"),
            F.coalesce(F.col("_e.value"), F.array().cast("array<double>")).alias("values"),
        ).alias("features")
    )
    schema = T.StructType([T.StructField("features", VectorUDT())])
    return (
        document_entries(vectors, documents)
        .withColumn("features", F.from_json(F.to_json(parts), schema)["features"])
        .drop("_e")
    )


def label_index(label: Column, classes: list[str]) -> Column:
    return (F.array_position(F.array(*[F.lit(c) for c in classes]), label) - 1).cast("double")


def class_name(index: Column, classes: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in classes]), index.cast("int") + 1)


# --- estimators --------------------------------------------------------------------------------


def forest(
    n_estimators: int = 100,
    max_depth: int | None = None,
    min_samples_split: int = 2,
    min_samples_leaf: int = 1,
    seed: int = fv.SEED,
) -> RandomForestClassifier:
    """A plain Spark ML forest, for saving and loading. A split minimum has no counterpart there; half of it is
    folded into the leaf minimum. `forests` honours it as it is."""
    return RandomForestClassifier(
        numTrees=n_estimators,
        maxDepth=_UNLIMITED_DEPTH if max_depth is None else max_depth,
        minInstancesPerNode=max(min_samples_leaf, math.ceil(min_samples_split / 2)),
        seed=seed,
    )


# --- grids -------------------------------------------------------------------------------------


def parameter_grids() -> dict[str, dict[str, list]]:
    return {
        NAIVE_BAYES: dict(fv.NAIVE_BAYES_GRID), SVM: dict(fv.SVM_GRID), FOREST: dict(fv.FOREST_GRID),
    }


def combinations(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def search_settings(name: str, grid: dict[str, list] | None = None, seed: int = fv.SEED) -> list[dict]:
    """The full grid, or a seeded draw from it for forests, without settings that collapse into one."""
    settings = combinations(grid or parameter_grids()[name])
    if name == FOREST and len(settings) > fv.RANDOM_SEARCH_DRAWS:
        settings = random.Random(seed).sample(settings, fv.RANDOM_SEARCH_DRAWS)
    return settings


# --- training and evaluation ---------------------------------------------------------------------


@dataclass(frozen=True)
class Representation:
    """Document vectors with their width, an upper bound that is known before any job runs.

    `rows` holds the same entries as arrays, for models that take documents whole.
    """

    name: str
    vectors: DataFrame
    width: int
    may_be_negative: bool = False
    rows: DataFrame | None = None

    @property
    def entries(self) -> DataFrame:
        return self.vectors if self.rows is None else self.rows


@dataclass(frozen=True)
class Evaluation:
    model: str
    representation: str
    predictions: DataFrame
    metrics: dict[str, dict[str, float]]
    train_seconds: float
    predict_seconds: float
    params: dict = field(default_factory=dict)

    def record(self, subset: str = "test") -> dict:
        return {
            "model": self.model, "representation": self.representation, **self.metrics[subset],
            "train_time": self.train_seconds, "predict_time": self.predict_seconds,
        }


def evaluate(
    name: str,
    representation: Representation,
    documents: DataFrame,
    classes: list[str] = fv.CLASS_ORDER,
    **params,
) -> Evaluation:
    """Fit on `set = 'train'` of `documents(doc_id, label, set)`, predict and score every set."""
    runs = {NAIVE_BAYES: _run_naive_bayes, SVM: _run_svm, FOREST: _run_forest}
    if name not in runs:
        raise ValueError(f"Unknown model: {name}")
    run = runs[name]
    predictions, train_seconds, predict_seconds = run(name, representation, documents, classes, params)
    rows = evaluation.metrics_by_set(predictions, classes).collect()  # one row per set
    metrics = {r["set"]: {k: v for k, v in r.asDict().items() if k != "set"} for r in rows}
    return Evaluation(
        name, representation.name, predictions, metrics, train_seconds, predict_seconds, params
    )


def _learnt(classes: list[str]) -> Column:
    """Fold 0 holds the training rows whose label is one of `classes`, fold 1 all others."""
    return F.when((F.col("set") == "train") & F.col("label").isin(*classes), 0).otherwise(1)


def _run_forest(name, representation, documents, classes, params):
    del name
    carry = ["doc_id", "set", "label"]
    rows = _numbered_rows(representation, documents.select(*carry), classes, _learnt(classes))
    blocks = linear_svm.document_blocks(rows, representation.width, carry)
    trees = params.get("n_estimators", fv.FOREST_TREES)
    start = time.perf_counter()
    fit = forests.Fit(trees, params.get("max_depth"), params.get("min_samples_leaf", 1), only=0)
    judged, clock = forests.grow_and_judge(
        blocks, [forests.Search(fit, [("", trees, forests.forest_rule(params))])], classes,
        [rows.schema[c] for c in carry], representation.width, params.get("seed", fv.SEED),
    )
    coded = time.perf_counter()
    predictions = materialize(judged.drop("params"))
    # trees vote where they were grown: the time of that job is divided as that of its tasks
    job = time.perf_counter() - coded
    return predictions, coded - start + clock.share * job, (1 - clock.share) * job


def _numbered_rows(representation: Representation, documents: DataFrame, classes: list[str], fold: Column) -> DataFrame:
    """Rows for `linear_svm.document_blocks`: class number (-1 beyond `classes`), fold, and entries."""
    rows = document_entries(representation.entries, documents.withColumn("_fold", fold.cast("int")))
    return rows.select(
        *[c for c in documents.columns if c != "fold"], F.col("_fold").alias("fold"),
        F.coalesce(label_index(F.col("label"), classes), F.lit(-1.0)).cast("int").alias("y"),
        F.col("_e.idx").cast("array<int>").alias("idx"), F.col("_e.value").alias("value"),
    )


def _run_svm(name, representation, documents, classes, params):
    del name
    carry = ["doc_id", "set", "label"]
    rows = _numbered_rows(representation, documents.select(*carry), classes, _learnt(classes))
    blocks = linear_svm.document_blocks(rows, representation.width, carry)
    limit = params.get("max_iter", fv.SVM_ITERATIONS)
    start = time.perf_counter()
    problems = linear_svm.class_problems(len(classes), params.get("C", 1.0), params.get("loss", linear_svm.SQUARED_HINGE), 1)
    weights = linear_svm.fit(blocks, problems, representation.width, (limit,))[0][limit]
    trained = time.perf_counter()
    judged = linear_svm.predict(
        blocks, linear_svm.class_weights(weights, len(classes)), [linear_svm.NOWHERE], classes, [documents.schema[c] for c in carry]
    )
    predictions = materialize(judged)
    return predictions, trained - start, time.perf_counter() - trained


def _run_naive_bayes(name, representation, documents, classes, params):
    del name
    alpha, fit_prior = params.get("alpha", 1.0), params.get("fit_prior", True)
    train = documents.where(F.col("set") == "train")
    start = time.perf_counter()
    vectors = representation.vectors
    of_train = vectors.join(train.select("doc_id"), "doc_id", "left_semi")
    if representation.may_be_negative:
        limits = materialize(minmax_limits(of_train, train.agg(F.count("*")).scalar()))
        vectors = minmax_scale(vectors, limits, representation.width)
        # unseen documents may fall below the training range: no negative counts
        vectors = vectors.withColumn("value", F.greatest("value", F.lit(0.0)))
        of_train = vectors.join(train.select("doc_id"), "doc_id", "left_semi")
    features = documents.sparkSession.range(representation.width).select(F.col("id").alias("idx"))
    model = materialize(naive_bayes.fit(of_train, train, features, classes, alpha))
    priors = materialize(naive_bayes.log_priors(train, classes, fit_prior))
    trained = time.perf_counter()
    scored = naive_bayes.predict(
        vectors, documents, model, priors, classes, representation.width
    )
    predictions = materialize(scored.select("doc_id", "set", "label", "prediction"))
    return predictions, trained - start, time.perf_counter() - trained


def cross_validate(
    name: str,
    representation: Representation,
    folds: DataFrame,
    settings: list[dict] | None = None,
    classes: list[str] = fv.CLASS_ORDER,
) -> DataFrame:
    """Mean weighted F1 over the folds of `folds(doc_id, label, fold)` for each setting."""
    spark = folds.sparkSession
    settings = settings or search_settings(name)
    if name == NAIVE_BAYES:
        features = spark.range(representation.width).select(F.col("id").alias("idx"))
        judged = naive_bayes.cross_validate(
            representation.vectors, folds, features, classes,
            sorted({s["alpha"] for s in settings}), sorted({s["fit_prior"] for s in settings}),
            representation.width,
        )
        by_fold = evaluation.weighted_metrics(judged, classes, ["alpha", "fit_prior", "fold"])
        # one pass fits the whole grid; only the settings asked for may be chosen
        offered = [F.struct(F.lit(float(s["alpha"])), F.lit(bool(s["fit_prior"]))) for s in settings]
        means = by_fold.groupBy("alpha", "fit_prior").agg(F.avg("f1_score").alias("f1_cv")).where(
            F.struct("alpha", "fit_prior").isin(offered)
        )
        return means.select(
            F.lit(name).alias("model"), F.to_json(F.struct("alpha", "fit_prior")).alias("params"), "f1_cv"
        )
    if name == SVM:
        return _cross_validate_svm(representation, folds, settings, classes)
    return _cross_validate_forest(representation, folds, settings, classes)


def _mean_f1(name: str, judged: DataFrame, classes: list[str]) -> DataFrame:
    """`(model, params, f1_cv)` from `(params, fold, label, prediction)`."""
    by_fold = evaluation.weighted_metrics(materialize(judged, "judged"), classes, ["params", "fold"])
    means = by_fold.groupBy("params").agg(F.avg("f1_score").alias("f1_cv"))
    return means.select(F.lit(name).alias("model"), "params", "f1_cv")


def _fold_numbers(folds: DataFrame) -> list[int]:
    return sorted(r["fold"] for r in folds.select(F.col("fold").cast("int").alias("fold")).distinct().collect())


def _cross_validate_forest(representation: Representation, folds: DataFrame, settings: list[dict], classes: list[str]) -> DataFrame:
    carry = ["doc_id", "label", "fold"]
    known = folds.select(*carry).where(F.col("label").isin(*classes))
    rows = _numbered_rows(representation, known, classes, F.col("fold"))
    blocks = linear_svm.document_blocks(rows, representation.width, carry)
    settings = [{"n_estimators": fv.FOREST_TREES, **s} for s in settings]
    judged = forests.cross_validated(
        None, blocks, settings, classes, _fold_numbers(folds), [rows.schema[c] for c in carry], width=representation.width
    )
    return _mean_f1(FOREST, judged, classes)


def _cross_validate_svm(representation: Representation, folds: DataFrame, settings: list[dict], classes: list[str]) -> DataFrame:
    carry = ["doc_id", "label", "fold"]
    settings = [{"C": 1.0, "loss": linear_svm.SQUARED_HINGE, "max_iter": fv.SVM_ITERATIONS, **s} for s in settings]
    rows = _numbered_rows(representation, folds.select(*carry).where(F.col("label").isin(*classes)), classes, F.col("fold"))
    blocks = linear_svm.document_blocks(rows, representation.width, carry)
    judged = linear_svm.cross_validated(
        blocks, settings, classes, _fold_numbers(folds), representation.width, [rows.schema[c] for c in carry], SEARCH_TOLERANCE
    )
    return _mean_f1(SVM, judged, classes)
