"""Corpus statistics that grow with a stream: a small mergeable state per batch, merged when it is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Size parameters of the sketches: quantiles within about 1.33 / 400 of rank, distinct counts within about 2 %.
KLL_K, HLL_LG_K = 400, 12


def batch_state(documents: DataFrame, text: str = "text") -> DataFrame:
    """One row per label of `documents(label, rating, game_id, text)`: everything the statistics need.

    Counts, sums, mean and squared deviations of the text length, its extremes, a quantile sketch of the
    lengths and a distinct sketch of the games. A null label is a group; null texts, ratings and games are
    left out of what they would measure.
    """
    length = F.length(text)
    return documents.groupBy("label").agg(
        F.count("*").alias("n"), F.count("rating").alias("n_rated"), F.coalesce(F.sum("rating"), F.lit(0.0)).alias("rating_sum"),
        F.count(length).alias("n_texts"), F.coalesce(F.avg(length), F.lit(0.0)).alias("length_mean"),
        F.coalesce(F.var_pop(length) * F.count(length), F.lit(0.0)).alias("length_m2"),
        F.min(length).alias("length_min"), F.max(length).alias("length_max"),
        F.kll_sketch_agg_bigint(length.cast("bigint"), KLL_K).alias("lengths"), F.hll_sketch_agg("game_id", HLL_LG_K).alias("games"),
    )


def write_statistics(documents: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the state of every new batch of a stream below `path`, then stop; a later call continues from there.

    A batch that is run again replaces its own state, so nothing counts twice.
    """
    def keep(batch: DataFrame, number: int) -> None:
        batch_state(batch).write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={number}")

    query = documents.writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def read_state(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path).drop("batch")


def merged(state: DataFrame) -> DataFrame:
    """One row per label, and one for all with `label = 'all'` and `level = 'all'`, from any number of states.

    Counts, sums, means, deviations and extremes are exact whatever the batches and their order (up to the
    rounding of sums); `median_length` and `unique_games` are estimates. Deviations are added around the
    common mean, so no digits are lost. A few rows per batch move, never a document.
    """
    levels = state.select(F.explode(F.array(F.lit("label"), F.lit("all"))).alias("level"), "*")
    levels = levels.withColumn("label", F.when(F.col("level") == "all", "all").otherwise(F.col("label")))
    group = Window.partitionBy("level", "label")
    mean = F.try_divide(F.sum(F.col("length_mean") * F.col("n_texts")).over(group), F.sum("n_texts").over(group))
    around = levels.withColumn("_mean", mean)
    shifted = F.col("length_m2") + F.col("n_texts") * F.pow(F.col("length_mean") - F.col("_mean"), F.lit(2.0))
    texts = F.sum("n_texts")
    return around.groupBy("level", "label").agg(
        F.sum("n").alias("n"), F.try_divide(F.sum("rating_sum"), F.sum("n_rated")).alias("avg_rating"),
        F.max("_mean").alias("mean_length"), F.sqrt(F.try_divide(F.sum(shifted), texts)).alias("std_length"),
        F.min("length_min").alias("min_length"), F.max("length_max").alias("max_length"),
        F.when(texts > 0, F.kll_sketch_get_quantile_bigint(F.kll_merge_agg_bigint("lengths"), F.lit(0.5))).alias("median_length"),
        F.hll_sketch_estimate(F.hll_union_agg("games")).alias("unique_games"),
    )
