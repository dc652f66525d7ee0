"""Quoted CSV with line breaks inside fields, read in parallel: many tasks share one file.

Quotes may only enclose fields and are doubled inside (RFC 4180). A line break is inside a field exactly
when an odd number of quotes precedes it in the file. The quotes of each split are counted first; the
counts of the splits before tell each split whether it starts inside a field.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlab.session import materialize

_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}
_WHOLE, _START, _MIDDLE, _END = range(4)
_PARTS = "path string, block long, kind int, record string, first boolean"


def split_lines(spark: SparkSession, path: str) -> DataFrame:
    """`(value, path, block)`: the lines of the files, cut at line feeds only, with the split they lie in.

    A task reads its splits one after the other and each from top to bottom, so lines are in file order.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("block"))


def split_starts(lines: DataFrame) -> DataFrame:
    """`(path, block, inside)`: whether each split starts inside a quoted field. One row per split."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    counted = lines.groupBy("path", "block").agg(F.sum(quotes).alias("quotes"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return counted.select("path", "block", (F.coalesce(F.sum("quotes").over(before), F.lit(0)) % 2 == 1).alias("inside"))


def _pieces(lines: DataFrame) -> DataFrame:
    """Whole records of each split, and its parts of records that reach over its borders."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, inside, open_lines, first, begun = None, False, [], False, False
        out: list[tuple] = []

        def piece(last: bool) -> None:
            """Close what is open, at the end of a record or (`last`) of the split."""
            if not open_lines:
                return
            reaches_over = last and inside
            kind = (_START if reaches_over else _WHOLE) if begun else (_MIDDLE if reaches_over else _END)
            out.append((*split, kind, "\n".join(open_lines), first))
            open_lines.clear()

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.int32(), pa.string(), pa.bool_())
            names = ["path", "block", "kind", "record", "first"]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

        for batch in batches:
            odd = pc.bit_wise_and(pc.count_substring(batch.column("value"), '"'), 1)
            columns = (batch.column("value").to_pylist(), odd.to_pylist(), batch.column("path").to_pylist(),
                       batch.column("block").to_pylist(), batch.column("inside").to_pylist())
            for value, odd_quotes, path, block, starts_inside in zip(*columns):
                if (path, block) != split:
                    piece(True)
                    split, inside, begun, first = (path, block), starts_inside, not starts_inside, block == 0
                open_lines.append(value)
                inside ^= bool(odd_quotes)
                if not inside:
                    piece(False)
                    begun, first = True, False
            if out:
                yield batch_of(out)
                out = []
        piece(True)
        if out:
            yield batch_of(out)

    return lines.mapInArrow(of_batches, _PARTS)


def records(spark: SparkSession, path: str) -> DataFrame:
    """`(record, first)`: the records of all files as text; `first` marks the first one of a file."""
    lines = split_lines(spark, path)
    # one short row per split of the scan (128 MB of text by default)
    starts = F.broadcast(materialize(split_starts(lines), "csv-splits"))
    pieces = materialize(_pieces(lines.join(starts, ["path", "block"]).select("value", "path", "block", "inside")), "csv-records")
    whole = pieces.where(F.col("kind") == _WHOLE).select("record", "first")
    # at most two parts per split; a record is the start in one split, whole splits inside it, and its end
    parts = pieces.where(F.col("kind") != _WHOLE)
    place = F.struct("block", F.when(F.col("kind") == _START, 1).otherwise(0).alias("after"))
    upto = Window.partitionBy("path").orderBy(place)
    numbered = parts.withColumn("_at", place).withColumn("_record", F.sum((F.col("kind") == _START).cast("int")).over(upto))
    joined = numbered.groupBy("path", "_record").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "record"))), lambda p: p["record"]), "\n").alias("record"),
        F.max("first").alias("first"),
    )
    return whole.unionByName(joined.select("record", "first"))


def read_quoted_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as text, named by the header of the files.

    As with Spark's own reader, empty lines are no records, missing and empty fields are null, and fields
    beyond the header are dropped. Files whose header differs from that of the
    first are read by position. A file with an odd number of quotes ends inside a field: its last record
    reaches to its end.
    """
    header = spark.read.option("header", True).options(**_OPTIONS).csv(path).columns
    text = F.regexp_replace("record", "\r$", "")
    found = records(spark, path).where(~F.col("first") & (F.length(text) > 0))
    spelled = ", ".join(f"_{i} string" for i in range(len(header)))
    parsed = found.select(F.from_csv(text, spelled, _OPTIONS).alias("r"))
    return parsed.select(*[F.col(f"r._{i}").alias(name) for i, name in enumerate(header)])
