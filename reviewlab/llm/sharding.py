"""Sharding by longest-processing-time scheduling of groups that must stay together."""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.rows import hash128
from reviewlab.session import materialize

SHARDS = 24
ROW_OVERHEAD = 8
#: A group above 1/256 of a shard is scheduled by itself; all others in 1024 bundles per shard.
LARGE_PER_SHARD, BUNDLES_PER_SHARD = 256, 1024
#: Rows that one task numbers within a shard, about; and the least number of such parts.
ROWS_PER_PART, LEAST_PARTS = 20_000, 16
#: Copies of one row that are unfolded together.
COPIES_AT_ONCE = 1 << 16


def longest_first(sizes: dict, shards: int) -> dict:
    """`{item: shard}`: the largest item first, each to the shard with the least load so far.

    Equal sizes go in the order of the items, equal loads to the lower shard.
    """
    heap = [(0, shard) for shard in range(shards)]
    placed = {}
    for item in sorted(sizes, key=lambda item: (-sizes[item], item)):
        load, shard = heapq.heappop(heap)
        placed[item] = shard
        heapq.heappush(heap, (load + sizes[item], shard))
    return placed


def shard_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", shards: int = SHARDS) -> DataFrame:
    """`(key, size, text_crc32, shard, slot)`: shards of nearly equal size in bytes.

    A row's size is the UTF-8 length of its text plus 8. Equal texts, also repeated rows, share a
    shard; null and empty text are equal. `slot` numbers a shard's rows gaplessly from 0, in the order
    of a hash of key and text; null keys are numbered like others. An empty table gives an empty table.
    Other columns are not carried, so clashing names do not matter.

    Group sizes are partial sums by a 128-bit hash of the text. The scheduler sees at most 256 large
    groups per shard (they are larger than 1/256 of a shard, so there cannot be more) and 1024 bundles
    of small groups per shard; these bounds hold for any input, and so do those of the two broadcast
    tables. Slots come from one count per part of a shard, so no task numbers a whole shard.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    rows = materialize(
        docs.select(
            F.col(key), (F.octet_length(body) + ROW_OVERHEAD).cast("long").alias("size"),
            F.crc32(body).alias("text_crc32"), hash128(body).alias("_g"),
        ).select(key, "size", "text_crc32", "_g.a", "_g.b"), "sizes",
    )
    groups = materialize(rows.groupBy("a", "b").agg(F.sum("size").alias("size")), "groups")
    total = groups.agg(F.sum("size")).first()[0] or 0
    least = total // (shards * LARGE_PER_SHARD)
    n_bundles = shards * BUNDLES_PER_SHARD
    bundle = F.pmod(F.col("b"), F.lit(n_bundles))
    large = {("large", r.a, r.b): r.size for r in groups.where(F.col("size") > least).collect()}
    small = groups.where(F.col("size") <= least).groupBy(bundle.alias("n")).agg(F.sum("size").alias("size"))
    placed = longest_first({**large, **{("small", r.n, 0): r.size for r in small.collect()}}, shards)
    spark = docs.sparkSession
    of_large = spark.createDataFrame(
        [(a, b, s) for (kind, a, b), s in placed.items() if kind == "large"], "a long, b long, _large int"
    )
    of_small = spark.createDataFrame(
        [(n, s) for (kind, n, _), s in placed.items() if kind == "small"], "_bundle long, _small int"
    )
    # repeated rows are one row with a number until the slots are known, so that they are no hot key
    distinct = rows.groupBy(key, "size", "text_crc32", "a", "b").agg(F.count("*").alias("_copies"))
    assigned = (
        distinct.join(F.broadcast(of_large), ["a", "b"], "left")
        .withColumn("_bundle", bundle)
        .join(F.broadcast(of_small), "_bundle", "left")
        .select(key, "size", "text_crc32", "_copies", F.coalesce("_large", "_small").alias("shard"), F.xxhash64(key, "a").alias("_h"))
    )
    return _with_slots(materialize(assigned, "assigned"), key, shards)


def _with_slots(assigned: DataFrame, key: str, shards: int) -> DataFrame:
    parts = max(LEAST_PARTS, -(-assigned.count() // (shards * ROWS_PER_PART)))
    assigned = assigned.withColumn("_part", F.pmod("_h", F.lit(parts)))
    counts = assigned.groupBy("shard", "_part").agg(F.sum("_copies").alias("_n"))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = Window.partitionBy("shard", "_part").orderBy("_h", key, "text_crc32").rowsBetween(Window.unboundedPreceding, -1)
    placed = (
        assigned.withColumn("_within", F.coalesce(F.sum("_copies").over(within), F.lit(0)))
        .join(offsets, ["shard", "_part"])
        .withColumn("_first", F.col("_before") + F.col("_within"))
    )
    # copies are unfolded in runs of bounded length
    run = F.lit(COPIES_AT_ONCE)
    runs = placed.withColumn("_run", F.explode(F.sequence(F.lit(0).cast("long"), F.floor((F.col("_copies") - 1) / run))))
    copy = F.explode(F.sequence(F.col("_run") * run, F.least(F.col("_copies"), (F.col("_run") + 1) * run) - 1))
    return runs.withColumn("_copy", copy).select(
        key, "size", "text_crc32", "shard", (F.col("_first") + F.col("_copy")).cast("long").alias("slot")
    )
