"""Seeded hash keys: a reproducible random order that does not depend on partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def seeded_hash(seed: int | str, *parts: Column) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[p.cast("string") for p in parts]))


def leading_bits(hash_text: Column, hex_digits: int) -> Column:
    """The first hex digits of a hash as a number."""
    return F.conv(F.substring(hash_text, 1, hex_digits), 16, 10).cast("bigint")


def row_keys(df: DataFrame) -> list[str]:
    """The id, and the number of the draw where a document was drawn several times."""
    return [c for c in ("doc_id", "draw") if c in df.columns]
