"""Corpus statistics. Everything starts from aggregates that combine on the map side."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.operators.corpus import bounded_ratio
from reviewlab.session import materialize


def corpus_counts(documents: DataFrame) -> DataFrame:
    return documents.agg(
        F.count("*").alias("total_documents"), F.count("label").alias("labeled_documents")
    )


def label_distribution(documents: DataFrame) -> DataFrame:
    """Documents per label and their percentage of all labelled ones (a window over few rows)."""
    counts = documents.where(F.col("label").isNotNull()).groupBy("label").agg(F.count("*").alias("n"))
    total = F.sum("n").over(Window.partitionBy(F.lit(1)))
    return counts.withColumn("percentage", F.col("n") * 100.0 / total)


def rating_distribution(documents: DataFrame) -> DataFrame:
    return documents.groupBy("rating").agg(F.count("*").alias("n")).orderBy("rating")


def text_length_stats(documents: DataFrame, text: str = "text") -> DataFrame:
    """Mean, median, extremes and population deviation.

    The histogram of lengths is at most as long as the longest text, so the exact median needs no
    sort of the documents.
    """
    lengths = documents.groupBy(F.length(text).alias("value")).agg(F.count("*").alias("n"))
    return _weighted_summary(lengths)


def _weighted_summary(histogram: DataFrame) -> DataFrame:
    """Summary of a histogram `(value, n)`; deviations are taken from the mean, so no digits are lost."""
    value, n = F.col("value").cast("double"), F.col("n")
    # the histogram is at most as long as the longest text
    whole = Window.partitionBy(F.lit(1))
    centred = histogram.where(F.col("value").isNotNull()).withColumn("_mean", F.sum(value * n).over(whole) / F.sum(n).over(whole))
    return centred.agg(
        F.max("_mean").alias("mean"),
        F.expr("percentile(value, 0.5D, n)").alias("median"),
        F.min("value").cast("double").alias("min"),
        F.max("value").cast("double").alias("max"),
        F.sqrt(F.sum(n * F.pow(value - F.col("_mean"), F.lit(2.0))) / F.sum(n)).alias("std"),
    )


def avg_rating_per_label(documents: DataFrame) -> DataFrame:
    labelled = documents.where(F.col("label").isNotNull())
    return labelled.groupBy("label").agg(F.avg("rating").alias("avg_rating"))


def reviews_per_game(documents: DataFrame) -> DataFrame:
    per_game = documents.groupBy("game_id").agg(F.count("*").alias("n"))
    return per_game.agg(
        F.count("*").alias("unique_games"),
        F.avg("n").alias("mean"),
        F.median("n").alias("median"),
        F.min("n").cast("double").alias("min"),
        F.max("n").cast("double").alias("max"),
    )


def corpus_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """All statistics as `(metric, key, value)` from a single scan of the documents.

    One grouping-sets aggregate counts labels, ratings, games and text lengths side by side. Its
    result, one row per distinct value, is kept and all metrics are read from it.
    """
    measured = documents.select("label", "rating", "game_id", F.length(text).alias("text_length"))
    dimensions = ["label", "rating", "game_id", "text_length"]
    cells = measured.groupingSets([[d] for d in dimensions], *dimensions).agg(
        F.count("*").alias("n"),
        F.sum("rating").alias("rating_sum"),
        F.grouping_id().alias("_set"),
    )
    # grouping_id has one bit per dimension, set when the dimension is not grouped by
    all_bits = (1 << len(dimensions)) - 1
    names = {d: all_bits ^ (1 << (len(dimensions) - 1 - i)) for i, d in enumerate(dimensions)}
    cells = materialize(cells)

    def cells_of(name: str) -> DataFrame:
        return cells.where(F.col("_set") == names[name])

    def rows(df: DataFrame, metric: str, key, value) -> DataFrame:
        return df.select(
            F.lit(metric).alias("metric"),
            key.cast("string").alias("key"),
            value.cast("double").alias("value"),
        )

    labels = cells_of("label").where(F.col("label").isNotNull())
    ratings, games = cells_of("rating"), cells_of("game_id")
    length_summary = _weighted_summary(cells_of("text_length").withColumn("value", F.col("text_length")))
    game_summary = games.agg(
        F.count("*").alias("unique_games"), F.avg("n").alias("mean"), F.median("n").alias("median"),
        F.min("n").alias("min"), F.max("n").alias("max"),
    )
    totals = cells_of("label").agg(
        F.sum("n").alias("total_documents"),
        F.coalesce(F.sum(F.when(F.col("label").isNotNull(), F.col("n"))), F.lit(0)).alias("labeled_documents"),
    )
    parts = [
        rows(labels, "label_distribution", F.col("label"), F.col("n")),
        rows(labels, "avg_rating_per_label", F.col("label"), F.col("rating_sum") / F.col("n")),
        rows(ratings, "rating_distribution", F.col("rating"), F.col("n")),
        _unfold(totals, "documents"),
        _unfold(length_summary, "text_length"),
        _unfold(game_summary, "reviews_per_game"),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _unfold(one_row: DataFrame, metric: str) -> DataFrame:
    """A one-row summary as `(metric, key, value)` rows."""
    values = [F.struct(F.lit(c).alias("key"), F.col(c).cast("double").alias("value")) for c in one_row.columns]
    return one_row.select(F.explode(F.array(*values)).alias("e")).select(
        F.lit(metric).alias("metric"), F.col("e.key").alias("key"), F.col("e.value").alias("value")
    )


AVERAGED_FEATURES = [
    "positive_word_count", "negative_word_count", "negation_count", "intensifier_count",
    "domain_word_count", "vader_compound",
]
AVERAGED_BY_LABEL = [
    "positive_word_count", "negative_word_count", "vader_compound", "negation_count",
]


def feature_averages(features: DataFrame) -> DataFrame:
    return features.agg(*[F.avg(c).alias(f"avg_{c}") for c in AVERAGED_FEATURES])


def feature_averages_by_label(features: DataFrame) -> DataFrame:
    """Averages per label; `features` carries the label, so no join is needed."""
    labelled = features.where(F.col("label").isNotNull())
    return labelled.groupBy("label").agg(
        F.count("*").alias("n"), *[F.avg(c).alias(f"avg_{c}") for c in AVERAGED_BY_LABEL]
    )


def feature_ratios(features: DataFrame) -> DataFrame:
    tokens = F.col("token_count")
    return features.select(
        "doc_id",
        bounded_ratio(F.col("negation_count"), tokens).alias("negation_ratio"),
        bounded_ratio(F.col("intensifier_count"), tokens).alias("intensifier_ratio"),
    )


def split_distribution(splits: DataFrame) -> DataFrame:
    """Rows per set and class with class shares, and one subtotal row per set (`label = 'all'`)."""
    counts = splits.groupBy("set", "label").agg(F.count("*").alias("n"))
    subtotals = (
        counts.rollup("set", "label")
        .agg(F.sum("n").alias("n"), F.grouping_id().alias("_level"))
        .where(F.col("_level") < 3)
        .withColumn("label", F.when(F.col("_level") == 0, F.col("label")).otherwise("all"))
    )
    whole = F.max(F.when(F.col("_level") == 1, F.col("n"))).over(Window.partitionBy("set"))
    return subtotals.withColumn("percentage", F.col("n") * 100.0 / whole).drop("_level")


def matrix_sparsity(
    vectors: DataFrame, n_documents: int | Column, n_features: int | Column
) -> DataFrame:
    """Share of zero cells in percent, from the stored non-zero entries."""
    sizes = [n if isinstance(n, Column) else F.lit(n) for n in (n_documents, n_features)]
    cells = sizes[0].cast("double") * sizes[1].cast("double")
    return vectors.agg(F.count("*").alias("nnz")).select(
        "nnz", ((1.0 - F.col("nnz") / cells) * 100.0).alias("sparsity")
    )
