"""Line deduplication across documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.rows import BLANKS, ascii_lower, hash128, join_by_row, narrowed, same, widened, with_row_hash
from reviewlab.session import materialize

MIN_LENGTH = 40
MIN_DOCUMENTS = 5


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANKS)))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def repeated_lines(lines: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """`(hash, keeper)` of the keys that at least `min_documents` ids hold.

    The first aggregate is by key and id, the second by key with partial counts, so the most
    frequent line reaches a task as one number per map task.
    """
    return (
        lines.groupBy("hash")
        .agg(F.count_distinct(F.struct("_id")).alias("n"), F.max("_id").alias("keeper"))
        .where(F.col("n") >= min_documents)
        .select("hash", "keeper")
    )


def dedup_lines(
    docs: DataFrame, key: str = "doc_id", text: str = "text",
    min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS,
) -> DataFrame:
    """Drop lines that many documents share, except in the document with the largest id.

    Adds `n_lines`, `n_dropped` and `kept_text`; input columns of these names give way, all others
    stay. Lines end at newlines and are compared without blanks at their ends and with A-Z
    lower-cased; keys below `min_length` code points never go.

    Null and empty text is one empty line, which stays. Rows of one id count as one document, and a
    null id is a document of its own that never keeps a line. Repeated rows all get the same result.
    An empty table gives an empty table.

    The lines' 128-bit hashes are shuffled twice, the whole texts once, by row. A frequent line is a
    frequent join key: its many rows meet a single row on the other side, which adaptive execution
    splits (or broadcasts when the repeated lines turn out small).
    """
    whole, docs = docs, with_row_hash(narrowed(docs, key, text), text)
    keys = F.transform(_lines(F.col(text)), line_key)
    numbered = F.transform(keys, lambda k, i: F.struct(i.alias("at"), k.alias("k")))
    long_ones = F.filter(numbered, lambda x: F.length(x["k"]) >= min_length)
    hashed = F.transform(long_ones, lambda x: F.struct(x["at"].alias("at"), hash128(x["k"]).alias("hash")))
    lines = docs.select(F.col(key).alias("_id"), "_row", F.explode(hashed).alias("line")).select(
        "_id", "_row", "line.at", "line.hash"
    )
    # a table of its own, so that both sides of the join are plain exchanges, which can be split
    repeated = materialize(repeated_lines(lines, min_documents), "repeated-lines")
    dropped = (
        lines.join(repeated, "hash")
        .where(~same(F.col("_id"), F.col("keeper")))
        .groupBy("_id", "_row")
        .agg(F.collect_set("at").alias("_gone"))
    )
    gone = F.coalesce(F.col("_gone"), F.array().cast("array<int>"))
    all_lines = _lines(F.col(text))
    places = F.array_except(F.sequence(F.lit(0), F.size(all_lines) - 1), gone)
    kept = F.transform(places, lambda at: F.get(F.col("_lines"), at))
    kept_rows = (
        join_by_row(docs, dropped, key, ["_gone"])
        .withColumn("_lines", all_lines)
        .withColumn("n_lines", F.size("_lines").cast("long"))
        .withColumn("n_dropped", F.size(gone).cast("long"))
        .withColumn(
            "kept_text",
            F.when(F.size(gone) == 0, F.coalesce(F.col(text), F.lit(""))).otherwise(F.array_join(kept, "\n")),
        )
    )
    return widened(kept_rows, whole, [key, text], ["n_lines", "n_dropped", "kept_text"])
