"""Reviews to labelled documents: load filter, ids, metadata, labels and simple selections."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.functions.cleaning import strip
from reviewlab.operators.lookup import lookup_join
from reviewlab.operators.ranking import counts_before, numbered_within

Bands = list[tuple[str, float, float]]
_CORE = ["text", "rating", "game_id", "user", "username"]


def load_filter(reviews: DataFrame, min_text_length: int = fv.MIN_TEXT_LENGTH) -> DataFrame:
    """Strip the text; keep rows with enough text and a rating."""
    return (
        reviews.withColumn("rating", F.expr("try_cast(rating AS double)"))
        .where(F.col("rating").isNotNull())
        .withColumn("text", strip(F.col("text")))
        .where(F.length("text") >= max(min_text_length, 1))
    )


def with_row_key(reviews: DataFrame, name: str = "row_key") -> DataFrame:
    """A stable unique key for raw rows that have none: a hash of all columns and an occurrence number.

    It depends on the rows alone, not on files or partitions. Equal rows are numbered from 0.
    """
    shown = [F.concat(F.lit("="), F.col(f"`{c}`").cast("string")) for c in sorted(reviews.columns)]
    content = F.md5(F.concat_ws("|", *[F.coalesce(c, F.lit("-")) for c in shown]))
    numbered = numbered_within(reviews.withColumn("_content", content), "_content", "_n")
    return numbered.withColumn(name, F.concat_ws("-", "_content", F.col("_n").cast("string"))).drop("_content", "_n")


def with_doc_ids(
    reviews: DataFrame, order_key: str, max_documents: int | None = None
) -> DataFrame:
    """Add `doc_id` = game, user and position among the rows in the order of `order_key`.

    With `max_documents` only the first rows of that order stay. The key should be unique; rows that
    share one, or have none (first in the order), keep positions of their own in arbitrary order. Missing
    columns or values of game and user are named as unknown and anonymous.
    """
    rows = numbered_within(reviews, order_key, "_of_key")
    keys = reviews.groupBy(F.col(order_key).alias("_key")).agg(F.count("*").alias("_rows"))
    before = counts_before(keys, "_key", "_rows", "_before")
    numbered = rows.join(before, F.col(order_key).eqNullSafe(F.col("_key"))).withColumn("ordinal", F.col("_before") + F.col("_of_key"))
    if max_documents is not None:
        numbered = numbered.where(F.col("ordinal") < max_documents)

    def named(columns: tuple[str, ...], default: str) -> Column:
        present = [F.nullif(F.col(c).cast("string"), F.lit("")) for c in columns if c in reviews.columns]
        return F.coalesce(*present, F.lit(default))

    return numbered.withColumn(
        "doc_id",
        F.concat_ws(
            "_", named(("game_id",), fv.UNKNOWN_GAME), named(("user", "username"), fv.ANONYMOUS_USER),
            F.col("ordinal").cast("string"),
        ),
    ).drop("ordinal", "_key", "_rows", "_before", "_of_key")


def metadata_json(reviews: DataFrame, column: str = "metadata") -> DataFrame:
    """All columns beside text and rating as one JSON object (nulls left out)."""
    extras = [c for c in reviews.columns if c not in ("text", "rating")]
    return reviews.withColumn(column, F.to_json(F.struct(*extras)))


def extra_columns(reviews: DataFrame) -> list[str]:
    return [c for c in reviews.columns if c not in _CORE]


def documents_from_reviews(
    reviews: DataFrame,
    order_key: str,
    min_text_length: int = fv.MIN_TEXT_LENGTH,
    max_documents: int | None = None,
    bands: Bands | None = None,
) -> DataFrame:
    """Raw reviews to documents: filter, optional limit, ids, label."""
    kept = load_filter(reviews, min_text_length)
    documents = with_doc_ids(kept, order_key, max_documents).withColumnRenamed("text", "raw_text")
    return with_label(documents, bands or fv.TWO_CLASS_BANDS)


def label_of(rating: Column, bands: Bands) -> Column:
    """First band that holds the rating; null when there is none."""
    (name, low, high), *rest = bands
    start = F.when(rating.between(float(low), float(high)), F.lit(name))
    return reduce(
        lambda acc, band: acc.when(rating.between(float(band[1]), float(band[2])), F.lit(band[0])),
        rest,
        start,
    )


def with_label(df: DataFrame, bands: Bands = fv.TWO_CLASS_BANDS) -> DataFrame:
    return df.withColumn("label", label_of(F.col("rating"), bands))


def label_by_band_table(df: DataFrame, bands: DataFrame) -> DataFrame:
    """Label through a table `(position, label, low, high)`: a range join made equi-joins.

    A band lies on the grid whose cells are as wide as the next power of two above its own width, so
    it covers two cells at most, however wide it is. A row meets only the bands of its cell on each
    grid in use (a few, one per magnitude of widths), as arrays, so it stays one row. Suits long band
    lists, where a chain of conditions does not.
    """
    def cell(value: Column, level: Column) -> Column:
        return F.floor(value / F.pow(F.lit(2.0), level)).cast("decimal(38,0)")

    width = F.greatest(F.col("high") - F.col("low"), F.lit(1e-6))
    levelled = bands.where(F.col("low") <= F.col("high")).withColumn("_level", F.ceil(F.log2(width)).cast("int"))
    levels = sorted(r["_level"] for r in levelled.select("_level").distinct().collect())
    by_cell = (
        levelled.withColumn("_cell", F.explode(F.array_distinct(F.array(
            cell(F.col("low"), F.col("_level")), cell(F.col("high"), F.col("_level"))
        ))))
        .groupBy("_level", "_cell")
        .agg(F.array_sort(F.collect_list(F.struct("position", "low", "high", "label"))).alias("_bands"))
    )
    rating, joined, found = F.col("rating"), df, []
    for n, level in enumerate(levels):
        of_level = by_cell.where(F.col("_level") == level).select("_cell", F.col("_bands").alias(f"_bands{n}"))
        celled = joined.withColumn("_cell", cell(rating, F.lit(level)))
        joined = lookup_join(celled, of_level, ["_cell"], spread=F.xxhash64(*df.columns)).drop("_cell")
        found.append(F.filter(f"_bands{n}", lambda b: rating.between(b["low"], b["high"])))
    if not found:
        return df.withColumn("label", F.lit(None).cast("string"))
    none = F.array().cast("array<struct<position:int,low:double,high:double,label:string>>")
    hits = F.array_sort(F.concat(*[F.coalesce(f, none) for f in found]))
    return joined.withColumn("label", F.get(hits, F.lit(0))["label"]).drop(*[f"_bands{n}" for n in range(len(levels))])


def band_table(spark: SparkSession, bands: Bands) -> DataFrame:
    rows = [(i, name, float(low), float(high)) for i, (name, low, high) in enumerate(bands)]
    return spark.createDataFrame(rows, "position int, label string, low double, high double")


def filter_by_game_ids(df: DataFrame, game_ids: list[str] | DataFrame) -> DataFrame:
    """A short list becomes a pushed-down filter, a table of ids a semi join."""
    if isinstance(game_ids, DataFrame):
        ids = game_ids.select("game_id").distinct()
        return lookup_join(df, ids, ["game_id"], spread=F.xxhash64(*df.columns), how="left_semi")
    return df.where(F.col("game_id").isin(list(game_ids)))


def with_parsed_timestamp(df: DataFrame, column: str = "timestamp") -> DataFrame:
    """ISO text to timestamp; null where it cannot be read."""
    if dict(df.dtypes)[column].startswith("timestamp"):
        return df
    return df.withColumn(column, F.try_to_timestamp(F.col(column)))


def text_preview(text: Column, length: int = 300) -> Column:
    return F.substring(text, 1, length)


def json_field(column: Column, path: str) -> Column:
    return F.get_json_object(column, path)


def bounded_ratio(part: Column, whole: Column) -> Column:
    """`part / max(whole, 1)`"""
    return part / F.greatest(whole, F.lit(1))


def whole_share(n: Column, share: float) -> Column:
    """`int(n * share)` in double arithmetic"""
    if not math.isfinite(share) or not 0 <= share <= 1:
        raise ValueError(f"share must lie in [0, 1]: {share}")
    return F.floor(n.cast("double") * F.lit(float(share))).cast("bigint")
