"""Helpers shared by the operators: row keys, ASCII folding, words, exact hashes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLANKS = " \t\n\x0b\f\r"
WORD_BREAK = r"[\x20\x09-\x0D]+"


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; every other character stays."""
    return F.translate(text, UPPER, LOWER)


def hash128(text: Column) -> Column:
    """Two independently seeded 64-bit hashes, which stand for the text itself."""
    return F.struct(F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"))


def split_words(text: Column, breaks: str = WORD_BREAK) -> Column:
    """The runs between `breaks`; null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), breaks), "")


def same(left: Column, right: Column) -> Column:
    return left.eqNullSafe(right)


def with_row_hash(docs: DataFrame, text: str, name: str = "_row") -> DataFrame:
    """Tell rows of one id apart by their text, so that a join by id and hash never mixes texts."""
    return docs.withColumn(name, F.xxhash64(F.col(text)))


def join_by_row(docs: DataFrame, facts: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Left join of `facts(_id, _row, *columns)`, one per id and text, to rows with `_row`."""
    matched = docs.join(
        facts.withColumnRenamed("_row", "_of_row"),
        same(F.col(key), F.col("_id")) & (F.col("_row") == F.col("_of_row")),
        "left",
    )
    return matched.select(*[F.col(c) for c in docs.columns], *columns)


def narrowed(rows: DataFrame, *used: str) -> DataFrame:
    """`used` and all other columns as the single column `_rest`, so that no internal name clashes."""
    rest = [F.col(f"`{c}`") for c in rows.columns if c not in used]
    return rows.select(*used, F.struct(*(rest or [F.lit(0).alias("_")])).alias("_rest"))


def widened(rows: DataFrame, like: DataFrame, used: list[str], added: list[str]) -> DataFrame:
    """The columns of `like` again, without those of the same name as `added`, and `added`."""
    kept = [c for c in like.columns if c not in added]
    return rows.select(*[F.col(c) if c in used else F.col(f"_rest.`{c}`") for c in kept], *added)


def text_first(docs: DataFrame, text: str, carried: list[str]) -> DataFrame:
    """The text under a name of its own, then `carried`: the input of a Python step."""
    name = "_text"
    while name in carried:
        name += "_"
    return docs.select(F.col(text).alias(name), *carried)


def schema_with(rows: DataFrame, columns: list[str], more: str) -> T.StructType:
    """The fields of `columns`, whatever their names, and those spelled in `more`."""
    return T.StructType([*[rows.schema[c] for c in columns], *T.StructType.fromDDL(more).fields])
