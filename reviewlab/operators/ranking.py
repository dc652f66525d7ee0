"""Exact ranks, samples and cuts without a window over a whole class or a whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from reviewlab.functions.keys import leading_bits, seeded_hash
from reviewlab.operators.lookup import lookup_join
from reviewlab.session import materialize

# 65,536 hash buckets per class: about 500,000 of 33 billion rows in each.
BUCKET_HEX_DIGITS = 4

#: Up to so many first rows, a top-n over all tasks costs less than sorting the keys.
FEW_ROWS = 1000

Cuts = Callable[[Column, Column, Column], list[Column]]


#: Segment ends are spelled out in the projection for so many groups; beyond it they are joined as a table.
LISTED_GROUPS = 50


def hash_segments(
    df: DataFrame, group: str, key: str, seed: int | str, cuts: Cuts, column: str = "segment"
) -> DataFrame:
    """Number each row's segment after ordering its group by a seeded hash of `key`.

    `cuts(size, smallest, largest)` returns the segment ends as row counts, from the size of the
    own group and of the smallest and largest group. A row gets segment `i` when exactly `i` ends
    lie before it. Rows without a group are dropped.

    Two small jobs over (group, key) find the hash at which each segment ends: the first counts rows
    per group and hash bucket, the second ranks the few buckets that hold an end. For up to fifty
    groups the driver gets one row per end and the result is a plain projection that compares hashes;
    for more, the ends are a table of one row per group that is joined. Either way the rows are not
    ranked as a whole, so groups may be of any size and skew. Rows with equal key always share a
    segment.
    """
    keyed = df.where(F.col(group).isNotNull()).select(
        F.col(group), F.col(key).cast("string").alias("_k"), seeded_hash(seed, F.col(key)).alias("_h")
    )
    keyed = keyed.withColumn("_b", leading_bits(F.col("_h"), BUCKET_HEX_DIGITS))
    table, n_ends = _segment_ends(keyed, group, cuts)
    ends = table.limit(LISTED_GROUPS * n_ends + 1).collect()
    if not ends:
        return df.where(F.lit(False)).withColumn(column, F.lit(0))
    hashed, name = seeded_hash(seed, F.col(key)), F.col(key).cast("string")
    if len(ends) > LISTED_GROUPS * n_ends:
        limits = _limit_table(keyed, group, materialize(table, "ends"))
        rows = lookup_join(df.where(F.col(group).isNotNull()), limits, [group], spread=hashed, how="inner")
        passed_ends = F.filter("_limits", lambda e: (hashed > e["_h"]) | ((hashed == e["_h"]) & (name > e["_k"])))
        return rows.withColumn(column, F.size(passed_ends)).select(*df.columns, column)
    limits = {(e[group], e["_i"]): ("", "") for e in ends if e["_end"] <= 0}
    limits.update(_last_rows(keyed, group, [e for e in ends if e["_end"] > 0]))
    groups = sorted({g for g, _ in limits}, key=str)

    def passed(g) -> Column:
        after = [
            ((hashed > h) | ((hashed == h) & (name > k))).cast("int")
            for (own, _), (h, k) in limits.items() if own == g
        ]
        return reduce(lambda x, y: x + y, after)

    segment = F.when(F.col(group) == groups[0], passed(groups[0]))
    for g in groups[1:]:
        segment = segment.when(F.col(group) == g, passed(g))
    return df.where(F.col(group).isNotNull()).withColumn(column, segment)


def _bucket_spans(keyed: DataFrame, group: str) -> DataFrame:
    """Rows before and up to the end of each bucket; at most groups x 65,536 rows."""
    running = Window.partitionBy(group).orderBy("_b")
    whole = Window.partitionBy(group)
    return (
        keyed.groupBy(group, "_b")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_stop", F.sum("_rows").over(running))
        .withColumn("_start", F.col("_stop") - F.col("_rows"))
        .withColumn("_size", F.sum("_rows").over(whole))
    )


def _segment_ends(keyed: DataFrame, group: str, cuts: Cuts) -> tuple[DataFrame, int]:
    """`(group, _b, _start, _i, _end)` for each end, with the bucket that holds its last row; ends per group."""
    # sizes of the smallest and largest group come from one small aggregate, not from a window over all
    sizes = keyed.groupBy(group).agg(F.count("*").alias("_rows"))
    extremes = sizes.agg(F.struct(F.min("_rows").alias("low"), F.max("_rows").alias("high"))).scalar()
    size = F.col("_size")
    spans = _bucket_spans(keyed, group).withColumn("_extremes", extremes)
    wanted = cuts(size, F.col("_extremes.low"), F.col("_extremes.high"))
    ends = F.array(*[F.least(c.cast("bigint"), size) for c in wanted])
    table = (
        spans.withColumn("_ends", ends)
        .select(group, "_b", "_start", "_stop", F.posexplode("_ends").alias("_i", "_end"))
        .where(
            F.col("_end").between(F.col("_start") + 1, F.col("_stop"))
            | ((F.col("_end") <= 0) & (F.col("_start") == 0))
        )
        .drop("_stop")
    )
    return table, len(wanted)


def _limit_table(keyed: DataFrame, group: str, ends: DataFrame) -> DataFrame:
    """`(group, _limits)`: hash and key of the last row before each end, for any number of groups."""
    real = ends.where(F.col("_end") > 0)
    buckets = real.select(group, "_b", "_start").distinct()
    one_bucket = Window.partitionBy(group, "_b").orderBy("_h", "_k")
    ranked = (
        lookup_join(keyed, buckets, [group, "_b"], spread=F.col("_k"), how="inner")
        .groupBy(group, "_b", "_start", "_h", "_k").agg(F.count("*").alias("_rows"))
        .withColumn("_upto", F.col("_start") + F.sum("_rows").over(one_bucket))
    )
    first = F.min(F.when(F.col("_upto") >= F.col("_end"), F.struct("_h", "_k"))).alias("_limit")
    placed = real.drop("_start").join(ranked, [group, "_b"]).groupBy(group, "_i").agg(first)
    before_all = ends.where(F.col("_end") <= 0).select(
        group, "_i", F.struct(F.lit("").alias("_h"), F.lit("").alias("_k")).alias("_limit")
    )
    return materialize(
        placed.unionByName(before_all).groupBy(group).agg(F.collect_list("_limit").alias("_limits")), "limits"
    )


def _last_rows(keyed: DataFrame, group: str, ends: list[Row]) -> dict:
    """Hash and key of the last row before each end, by ranking the buckets of the ends."""
    if not ends:
        return {}
    held = {(e[group], e["_b"], e["_start"]) for e in ends}
    chosen = reduce(
        lambda x, y: x | y, [(F.col(group) == g) & (F.col("_b") == b) for g, b, _ in held]
    )
    start = reduce(
        lambda c, h: c.when((F.col(group) == h[0]) & (F.col("_b") == h[1]), F.lit(h[2])), held, F
    )
    one_bucket = Window.partitionBy(group, "_b").orderBy("_h", "_k")
    ranked = (
        keyed.where(chosen)
        .groupBy(group, "_b", "_h", "_k")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_upto", start + F.sum("_rows").over(one_bucket))
    )
    firsts = [
        F.min(
            F.when(
                (F.col(group) == e[group]) & (F.col("_b") == e["_b"]) & (F.col("_upto") >= e["_end"]),
                F.struct("_h", "_k"),
            )
        ).alias(f"_{n}")
        for n, e in enumerate(ends)
    ]
    found = ranked.agg(*firsts).first()
    return {(e[group], e["_i"]): tuple(found[f"_{n}"]) for n, e in enumerate(ends)}


def hash_rank(df: DataFrame, group: str, key: str, seed: int | str, column: str = "rank") -> DataFrame:
    """0-based exact rank of every row within its group, in seeded hash order of a unique `key`.

    Two levels: counters per (group, bucket) give the offset, a window per bucket the rest, so no
    task sees a whole group. Every row is shuffled once, by (group, bucket), and stays there for the
    join with the counters. Pass narrow rows.
    """
    keyed = (
        df.where(F.col(group).isNotNull())
        .withColumn("_h", seeded_hash(seed, F.col(key)))
        .withColumn("_b", leading_bits(F.col("_h"), BUCKET_HEX_DIGITS))
    )
    spans = _bucket_spans(keyed, group).select(group, "_b", "_start", "_size")
    one_bucket = Window.partitionBy(group, "_b").orderBy("_h", F.col(key).cast("string"))
    return (
        keyed.withColumn("_in_bucket", F.row_number().over(one_bucket) - 1)
        .join(spans, [group, "_b"])
        .withColumn(column, (F.col("_start") + F.col("_in_bucket")).cast("bigint"))
        .withColumnRenamed("_size", "group_size")
        .drop("_h", "_b", "_start", "_in_bucket")
    )


_ROW_BITS = 33  # monotonically_increasing_id keeps the row number of a partition in 33 bits


def ordinals(keys: DataFrame, order: list[str], column: str = "ordinal") -> DataFrame:
    """0-based position of each row in the global order of `order`, which must be unique.

    A range-partitioned sort numbers the rows of each partition; the partition sizes, one row
    each, become offsets. The sorted keys are written once, so both readers see the same
    partitions even when a task is run again. Pass only the key columns.
    """
    placed = materialize(
        keys.orderBy(*order).withColumn("_place", F.monotonically_increasing_id())
    )
    partition = F.shiftright("_place", _ROW_BITS)
    earlier = Window.partitionBy(F.lit(1)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(partition.alias("_p"))
        .agg(F.count("*").alias("_rows"))
        .select("_p", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    )
    in_partition = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        placed.withColumn("_p", partition)
        .join(F.broadcast(offsets), "_p")
        .withColumn(column, (F.col("_offset") + in_partition).cast("bigint"))
        .drop("_p", "_place", "_offset")
    )


def numbered_within(df: DataFrame, key: str, column: str) -> DataFrame:
    """`df` with the 0-based number of each row among the rows of its `key` (null is a key too), in no given order.

    The rows are written once and counted per key and written part, so that a key may hold any share of
    them: no task numbers more rows of a key than one part has. Only keys and places are numbered, and only
    numbers other than 0 come back to the rows; while these are few, the rows themselves stay where they are.
    """
    placed = materialize(df.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    keys = placed.select(F.col(key).alias("_key"), "_place", F.shiftright("_place", _ROW_BITS).alias("_part"))
    counts = keys.groupBy("_key", "_part").agg(F.count("*").alias("_rows"))
    earlier = Window.partitionBy("_key").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("_key").alias("_own"), F.col("_part").alias("_of"), F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("_key", "_part").orderBy("_place")
    numbered = keys.withColumn("_within", F.row_number().over(within) - 1)
    joined = numbered.join(offsets, F.col("_key").eqNullSafe(F.col("_own")) & (F.col("_part") == F.col("_of")))
    repeated = joined.select("_place", (F.col("_before") + F.col("_within")).alias(column)).where(F.col(column) > 0)
    rows = lookup_join(placed, materialize(repeated, "repeated"), ["_place"], spread=F.col("_place"))
    return rows.select(*[f"`{c}`" for c in df.columns], F.coalesce(column, F.lit(0)).cast("bigint").alias(column))


def counts_before(counts: DataFrame, key: str, number: str, column: str) -> DataFrame:
    """`counts(key, number)`, one row per key, with the sum of `number` over all smaller keys (null is the smallest)."""
    placed = materialize(counts.orderBy(F.col(key).asc_nulls_first()).withColumn("_place", F.monotonically_increasing_id()))
    placed = placed.withColumn("_part", F.shiftright("_place", _ROW_BITS))
    parts = placed.groupBy("_part").agg(F.sum(number).alias("_rows"))
    # one row per range of the sorted keys
    earlier = Window.partitionBy(F.lit(1)).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed.withColumn("_within", F.coalesce(F.sum(number).over(within), F.lit(0))).join(F.broadcast(offsets), "_part")
    return rows.withColumn(column, F.col("_offset") + F.col("_within")).select(*counts.columns, column)


def first_rows(df: DataFrame, key: str, n: int) -> DataFrame:
    """The `n` rows with the smallest `key`, nulls first; of equal keys at the end any, but exactly `n` in all.

    A few rows come from every task's own smallest ones. For many, one count finds the rows with a null
    key and the positions of the sorted keys the last key that stays; only rows that share it compete.
    """
    if n <= 0:
        return df.limit(0)
    if n <= FEW_ROWS:
        return df.orderBy(F.col(key).asc_nulls_first()).limit(n)
    known, unknown = df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())
    left = n - unknown.count()
    if left <= 0:
        return _any_rows(unknown, n)
    last = ordinals(known.select(key), [key]).where(F.col("ordinal") == left - 1).select(key).first()
    if last is None:
        return df
    limit = F.lit(last[key])
    places = left - known.where(F.col(key) < limit).count()
    below = df.where(F.col(key).isNull() | (F.col(key) < limit))
    return below.unionByName(_any_rows(df.where(F.col(key) == limit), places))


def _any_rows(df: DataFrame, n: int) -> DataFrame:
    """`n` of the rows, numbered by their content; equal rows are told apart by their position."""
    columns = df.columns
    placed = ordinals(df.withColumn("_content", F.xxhash64(*[f"`{c}`" for c in columns])), ["_content"], "_position")
    return placed.where(F.col("_position") < n).select(*[f"`{c}`" for c in columns])
