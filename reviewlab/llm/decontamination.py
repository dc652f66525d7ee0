"""Benchmark decontamination: a prefix-filtered join of word shingles with exact verification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.rows import ascii_lower, join_by_row, narrowed, split_words, widened, with_row_hash
from reviewlab.operators.lookup import lookup_join
from reviewlab.session import materialize

WINDOW_WORDS = 10
SHINGLE_WORDS = 3
#: A table of so many 64-bit hashes takes about 50 MB; beyond it the join is salted instead.
BROADCAST_HASHES = 2_000_000
#: Everything below U+0080 that is neither a digit nor a lower-case letter.
BREAKS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    return split_words(ascii_lower(text), BREAKS)


def _shingles(words: Column, width: int) -> Column:
    """The hash of every run of `width` words; equal hashes are only candidates."""
    last = F.size(words) - width
    starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(width)]))


def item_windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """`(window, size, items)`: each distinct window once, with the ids that contain it."""
    worded = items.select(F.col(item_id).cast("string").alias("item"), words_of(F.col(text)).alias("w"))
    size = F.least(F.size("w"), F.lit(window))
    starts = F.sequence(F.lit(0), F.size("w") - size)
    windows = worded.where(F.size("w") > 0).select(
        "item",
        size.alias("size"),
        F.explode(F.transform(starts, lambda i: F.array_join(F.slice(F.col("w"), i + 1, size), " "))).alias("window"),
    )
    return windows.groupBy("window", "size").agg(F.collect_set("item").alias("items"))


def mark_contamination(
    docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text",
    item_id: str = "item_id", item_text: str = "text",
    window: int = WINDOW_WORDS, shingle: int = SHINGLE_WORDS,
) -> DataFrame:
    """Find every occurrence of an item window in every document.

    Adds `n_words`, `n_hit` (words inside any occurrence), `n_items`, `item_ids` (sorted as strings)
    and `contaminated`; input columns of these names give way, all others stay. A window is `window`
    consecutive item words, or the whole item if it has fewer.

    Null and empty text has no words and no hits; an item without words has no window, an item with a
    null id marks words but is not counted. Repeated items count once by id; repeated rows each get
    the same result. Empty tables give no hits or no rows.

    A window is a set of shingles that must all occur, so its necessary prefix is its rarest one, by
    counts over all documents. Only positions that hold some item shingle leave the scan, as
    fixed-width rows; the rarest shingle of a window fetches it, length and position bounds discard
    candidates that cannot fit, and the words themselves are compared in the document.
    """
    whole, docs = docs, with_row_hash(narrowed(docs, key, text), text)
    windows = materialize(item_windows(items, item_id, item_text, window), "windows")
    words, width = F.split("window", " "), F.least("size", F.lit(shingle))
    by_width = F.coalesce(*[F.when(width == k, _shingles(words, k)) for k in range(1, shingle + 1)])
    parts = windows.select(
        "window", "size", "items", width.alias("width"), F.posexplode(by_width).alias("within", "hash")
    )
    parts = materialize(parts, "window-shingles")
    widths = [r.width for r in parts.select("width").distinct().collect()]  # at most `shingle` values
    hits = materialize(_hits(docs, parts, key, text, sorted(widths)), "shingle-hits")
    counts = hits.groupBy("hash", "width").agg(F.count("*").alias("n"))
    # a shingle that no document holds is the rarest of all: its window cannot occur
    rarest = (
        parts.join(counts, ["hash", "width"], "left")
        .groupBy("window", "size", "items")
        .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "hash", "within", "width")).alias("r"))
        .where(F.col("r.n") > 0)
        .select("window", "size", "items", "r.hash", "r.within", "r.width")
    )
    start = F.col("at") - F.col("within")
    candidates = (
        lookup_join(hits, materialize(rarest, "prefixes"), ["hash", "width"], F.col("_row"), "inner")
        .where((start >= 0) & (start + F.col("size") <= F.col("n_words")))
        .groupBy("_id", "_row")
        .agg(F.collect_list(F.struct(start.alias("start"), "size", "window", "items")).alias("_cand"))
    )
    marked = _verified(join_by_row(docs, candidates, key, ["_cand"]), text)
    return widened(marked, whole, [key, text], ["n_words", "n_hit", "n_items", "item_ids", "contaminated"])


def _hits(docs: DataFrame, parts: DataFrame, key: str, text: str, widths: list[int]) -> DataFrame:
    """`(_id, _row, n_words, at, hash, width)` of the document positions that hold an item shingle."""
    worded = docs.select(F.col(key).alias("_id"), "_row", words_of(F.col(text)).alias("w"))
    found = None
    for width in widths or [1]:
        places = worded.select(
            "_id", "_row", F.size("w").alias("n_words"), F.lit(width).alias("width"),
            F.posexplode(_shingles(F.col("w"), width)).alias("at", "hash"),
        )
        wanted = parts.where(F.col("width") == width).select("hash").distinct()
        own = lookup_join(places, wanted, ["hash"], F.col("at"), "inner", limit=BROADCAST_HASHES)
        found = own if found is None else found.unionByName(own)
    return found


def _verified(docs: DataFrame, text: str) -> DataFrame:
    words = F.col("_w")
    true_ones = F.filter(
        F.coalesce(F.col("_cand"), F.array().cast("array<struct<start:int,size:int,window:string,items:array<string>>>")),
        lambda c: F.array_join(F.slice(words, c["start"] + 1, c["size"]), " ") == c["window"],
    )
    spans = F.transform(
        F.col("_true"), lambda c: F.sequence(c["start"], c["start"] + c["size"] - 1)
    )
    ids = F.array_sort(F.array_distinct(F.flatten(F.transform(F.col("_true"), lambda c: c["items"]))))
    return (
        docs.withColumn("_w", words_of(F.col(text)))
        .withColumn("_true", true_ones)
        .withColumn("n_words", F.size("_w").cast("long"))
        .withColumn("n_hit", F.size(F.array_distinct(F.flatten(spans))).cast("long"))
        .withColumn("item_ids", ids)
        .withColumn("n_items", F.size("item_ids").cast("long"))
        .withColumn("contaminated", F.col("n_hit") > 0)
    )
