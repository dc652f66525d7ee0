"""Joins of large row sets against lookup tables of unknown size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.session import materialize

# A broadcast table may take so many rows and, by the width of its columns, so many bytes.
BROADCAST_ROW_LIMIT = 200_000
BROADCAST_BYTE_LIMIT = 64 << 20
#: A table that becomes a constant of the plan.
CONSTANT_ROW_LIMIT, CONSTANT_BYTE_LIMIT = 20_000, 2 << 20
#: Salted joins: rows of one key that a task may get, and the bounds of the salt count.
ROWS_PER_SALT, LEAST_SALTS, MOST_SALTS = 5_000_000, 4, 4096


def is_small(table: DataFrame, limit: int = BROADCAST_ROW_LIMIT, byte_limit: int = BROADCAST_BYTE_LIMIT) -> bool:
    """Whether `table` has at most `limit` rows of at most `byte_limit` bytes together.

    At most `limit + 1` rows are looked at, so the check stays cheap on a large table. Fixed-width
    columns count 16 bytes; strings and nested values count the length of their text.
    """
    fixed = {"boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp"}
    open_ended = [F.coalesce(F.length(F.to_json(F.struct(f"`{c}`"))), F.lit(0)) for c, kind in table.dtypes if kind not in fixed]
    width = sum(open_ended, F.lit(16 * (len(table.columns) - len(open_ended) + 1)))
    seen = table.limit(limit + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).first()
    return seen["n"] <= limit and seen["bytes"] <= byte_limit


def salts_for(rows: DataFrame) -> int:
    """As many salts as keep even a key that holds all rows at `ROWS_PER_SALT` rows a task."""
    return _salts(rows.count())


def _salts(rows: int) -> int:
    return min(MOST_SALTS, max(LEAST_SALTS, -(-rows // ROWS_PER_SALT)))


def lookup_join(
    rows: DataFrame,
    table: DataFrame,
    on: list[str],
    spread: Column,
    how: str = "left",
    known_rows: int | None = None,
    limit: int = BROADCAST_ROW_LIMIT,
    of_a_key: Callable[[], int] | None = None,
) -> DataFrame:
    """Join `rows` with `table` on `on`: broadcast below the checked limit, salted above it.

    `known_rows` is an upper bound the caller can prove (then nothing is counted). Above the
    limit one hot key, such as a very frequent word, is spread over many tasks by `spread`; the
    number of salts follows the number of rows, or `of_a_key`, a bound of the rows of any one key that the caller
    can prove: the table is copied for every salt, and the rows then need not be counted.
    """
    small = known_rows <= limit if known_rows is not None else is_small(table, limit)
    if small:
        return rows.join(F.broadcast(table), on, how)
    salts = salts_for(rows) if of_a_key is None else _salts(of_a_key())
    salted_rows = rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)).cast("int"))
    # the optimizer takes the exploded table for as small as the table and would broadcast it: a merge join, always
    salted_table = table.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).hint("merge")
    return salted_rows.join(salted_table, [*on, "_salt"], how).drop("_salt")


def _complete(key: tuple[str, ...]) -> Column:
    held = F.lit(True)
    for c in key:
        held &= F.col(c).isNotNull()
    return held


def repeated_keys(rows: DataFrame, *key: str) -> DataFrame:
    """The keys, null aside, that more than one row has, written; only keys move."""
    return materialize(rows.where(_complete(key)).groupBy(*key).agg(F.count("*").alias("_n")).where("_n > 1").select(*key), "repeated-keys")


def by_repetition(rows: DataFrame, *key: str, keys: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """The rows whose key no other row has, and all others, those without a key (or a part of it) included."""
    keys = repeated_keys(rows, *key) if keys is None else keys
    spread = F.struct(*key) if len(key) > 1 else F.col(key[0])
    once = lookup_join(rows, keys, [*key], spread, "left_anti").where(_complete(key))
    again = lookup_join(rows, keys, [*key], spread, "left_semi")
    return once.select(*rows.columns), again.select(*rows.columns).unionByName(rows.where(~_complete(key)))


def only_once(rows: DataFrame, *key: str) -> tuple[DataFrame, DataFrame | None]:
    """`by_repetition`, without second rows (and a scan for them) where every row has a key of its own."""
    keys = repeated_keys(rows, *key)
    if keys.isEmpty() and rows.where(~_complete(key)).select(*key).isEmpty():
        return rows, None
    return by_repetition(rows, *key, keys=keys)


def row_lookup(table: DataFrame, name: str, value: str) -> Callable[[Column], Column] | None:
    """A function that gives the `value` of a string (null without one) within the row, or None for a large table.

    `name` must be unique and not null. The table becomes a constant of as many buckets as it has rows, so that a
    search does not go through all of it; the driver holds it once.
    """
    if not is_small(table, CONSTANT_ROW_LIMIT, CONSTANT_BYTE_LIMIT):
        return None
    size = max(1, table.count())

    def place(c: Column) -> Column:
        return F.pmod(F.xxhash64(c), F.lit(size)).cast("int")

    entries = F.collect_list(F.struct(F.col(name).alias("k"), F.col(value).alias("v")))
    held = table.where(F.col(value).isNotNull()).groupBy(place(F.col(name)).alias("at")).agg(F.to_json(F.map_from_entries(entries)).alias("json"))
    buckets = ["{}"] * size
    for row in held.collect():
        buckets[row["at"]] = row["json"]
    constant = F.from_json(F.lit("[" + ",".join(buckets) + "]"), "array<map<string,string>>")
    return lambda c: F.try_element_at(F.get(constant, place(c)), c)


#: Maps of few entries in place of a large one, since a map is searched from its first entry on.
_BUCKETS = 64


def in_buckets(entries: Column) -> Column:
    """An aggregate: entries of `bucket_entry`, each word with one value, as an array of maps for `bucket_value`."""
    return F.transform(
        F.sequence(F.lit(0), F.lit(_BUCKETS - 1)),
        lambda at: F.map_from_entries(F.transform(F.filter(entries, lambda e: e["at"] == at), lambda e: F.struct(e["k"], e["v"]))),
    )


def bucket_entry(word: Column, value: Column) -> Column:
    return F.struct(_bucket(word).alias("at"), word.alias("k"), value.alias("v"))


def _bucket(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(_BUCKETS)).cast("int")


def bucket_value(buckets: Column, word: Column) -> Column:
    """The value of a word, null without one."""
    return F.try_element_at(F.get(buckets, _bucket(word)), word)
