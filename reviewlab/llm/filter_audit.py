"""Filter interaction audit: what each filter removes, in every order of the filters."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.rows import hash128, schema_with, split_words
from reviewlab.session import materialize

LEAST_WORDS, LEAST_DISTINCT_PERCENT, MOST_UPPER_PERCENT = 100, 80, 10
SYMBOLS = "#$%&*|"
_CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: The filter that looks at the whole table, not at one text.
COPIES = "E"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
#: All orders of so many filters are listed.
MOST_FILTERS = 7


def text_failures(text: Column) -> dict[str, Column]:
    """The conditions under which a text fails a filter, by the filter's letter."""
    text = F.coalesce(text, F.lit(""))
    words = split_words(text)
    capitals = F.length(text) - F.length(F.translate(text, _CAPITALS, ""))
    return {
        "A": F.size(words) < LEAST_WORDS,
        "B": 100 * F.size(F.array_distinct(words)) < LEAST_DISTINCT_PERCENT * F.size(words),
        "C": 100 * capitals > MOST_UPPER_PERCENT * F.length(text),
        "D": F.translate(text, SYMBOLS, "") != text,
    }


def failure_masks(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
    failures: dict[str, Column] | None = None,
) -> DataFrame:
    """`(part, mask, n, good, toxic)`: documents by the set of filters they fail.

    Bit i of `mask` is the i-th filter in the order of the letters; the last one is `E`, identical to the
    text of a smaller key. Copies count as identical by 128 hash bits. A few numbers per document move, the
    texts do not; equal rows become one before they move, and a group of copies only ever meets its least key.
    """
    tests = text_failures(F.col(f"`{text}`")) if failures is None else failures
    mask = sum((F.when(test, 1 << bit).otherwise(0) for bit, (_, test) in enumerate(sorted(tests.items()))), F.lit(0))
    rows = docs.select(
        F.col(f"`{key}`").alias("id"), F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        mask.alias("mask"), hash128(F.coalesce(F.col(f"`{text}`"), F.lit(""))).alias("h"),
    ).select("id", "part", "mask", "h.a", "h.b")
    # one row for all rows of one key and text; null keys are told apart by their text
    rows = materialize(rows.groupBy("id", "part", "mask", "a", "b").agg(F.count("*").alias("n")), "failing-rows")
    own = labels.where(F.col(f"`{key}`").isNotNull()).groupBy(F.col(f"`{key}`").alias("id")).agg(
        *[F.coalesce(F.max(F.when(F.col(c) == 1, 1)), F.lit(0)).alias(f"is_{c}") for c in ("quality", "toxic")]
    )
    spread = F.when(F.col("id").isNull(), F.col("a")).otherwise(F.lit(0))
    rows = rows.withColumn("spread", spread).join(own.withColumn("spread", F.lit(0).cast("long")), ["id", "spread"], "left")
    # the first of its copies: a join by text and key, so that no group of copies is one join key
    least = rows.groupBy("a", "b").agg(F.min("id").alias("id")).where(F.col("id").isNotNull())
    rows = rows.join(least.withColumn("first", F.lit(True)), ["a", "b", "id"], "left")
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    full = F.col("mask") + F.when(copy, 1 << len(tests)).otherwise(0)
    weights = [F.sum("n"), *[F.sum(F.col("n") * F.coalesce(f"is_{c}", F.lit(0))) for c in ("quality", "toxic")]]
    return rows.groupBy("part", full.alias("mask")).agg(
        *[w.alias(name) for w, name in zip(weights, ("n", "good", "toxic"))]
    )


def removal_steps(fails: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Min-plus product: the step at which each mask goes in each order, `filters` where it stays.

    `fails` (masks x filters) is 0 where a mask fails a filter and `filters` elsewhere; `places`
    (filters x orders) says at which step an order applies a filter.
    """
    steps = np.full((fails.shape[0], places.shape[1]), fails.shape[1])
    for filter_ in range(fails.shape[1]):
        np.minimum(steps, fails[:, filter_, None] + places[filter_], out=steps)
    return steps


class OrderTables:
    """What depends on the number of filters alone: for every mask and order the step of removal."""

    def __init__(self, letters: str):
        k = len(letters)
        self.letters, self.size = letters, k
        self.orders = np.array(list(permutations(range(k))))
        self.names = ["".join(letters[f] for f in order) for order in self.orders]
        masks = np.arange(1 << k)
        self.fails = (masks[:, None] >> np.arange(k)) & 1
        places = np.argsort(self.orders, axis=1).T
        self.steps = removal_steps(np.where(self.fails == 1, 0, k), places)
        # at step s of order o: does a mask fail the filter of that step, though it went before?
        of_step = self.fails[:, self.orders]
        self.again = (of_step == 1) & (self.steps[:, :, None] < np.arange(k))
        self.alone = (of_step == 1) & (self.fails.sum(1) == 1)[:, None, None]

    def audit(self, weights: np.ndarray) -> dict[str, np.ndarray]:
        """`COUNTS` as (orders x filters) from `weights` (masks x n, good, toxic) of one part."""
        k, orders = self.size, len(self.orders)
        cell = np.arange(orders) * (k + 1) + self.steps
        gone = np.zeros((3, orders * (k + 1)), np.int64)
        for of_weight, weight in zip(gone, weights.T):
            np.add.at(of_weight, cell, np.broadcast_to(weight[:, None], cell.shape))
        removed, good, toxic = gone.reshape(3, orders, k + 1)[:, :, :k]
        n = weights[:, 0]
        totals = np.zeros(k, np.int64)
        np.add.at(totals, self.orders, removed)
        return {
            "kept": n.sum() - np.cumsum(removed, axis=1), "removed": removed,
            "redundant": np.tensordot(n, self.again, 1), "unique_fails": np.tensordot(n, self.alone, 1),
            "good_lost": good, "toxic_lost": toxic, "shapley": totals[self.orders],
        }


def interaction_audit(masks: DataFrame, letters: str = "ABCDE") -> DataFrame:
    """`(part, filter_order, step, *COUNTS)` for all orders of the filters, zeros included.

    `masks` is `(part, mask, n, good, toxic)`; only this table, at most 2^filters rows a part, is grouped,
    one part per row. No parts give an empty table.
    """
    if not 1 <= len(letters) <= MOST_FILTERS or len(set(letters)) < len(letters):
        raise ValueError(f"one to {MOST_FILTERS} different filters, not {letters!r}")
    cells = masks.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "good", "toxic")).alias("cells"))
    schema = schema_with(cells, ["part"], "filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = OrderTables(letters)
        k, orders = tables.size, len(tables.orders)
        names = pa.array(np.repeat(tables.names, k))
        steps = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), orders))
        for batch in batches:
            for part, cells in zip(batch.column(0), batch.column(1)):
                weights = np.zeros((1 << k, 3), np.int64)
                for cell in cells.as_py():
                    weights[cell["mask"]] += (cell["n"], cell["good"], cell["toxic"])
                found = tables.audit(weights)
                columns = [pa.repeat(part, k * orders), names, steps]
                columns += [pa.array(found[c].ravel().astype(np.int64)) for c in COUNTS]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "filter_order", "step", *COUNTS])

    return cells.mapInArrow(of_batches, schema)


def audit_filters(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", part: str = "lang",
) -> DataFrame:
    """Filters A to E over `docs`, in all 120 orders, per value of `part`.

    Null text is empty (it fails A), a null part is the empty string. A null key is neither smaller nor
    larger than another: such rows are no copies of anything and carry no labels. Repeated rows count as
    often as they occur; rows of one key and text are no copies of each other. A key with several labels
    has each label that one of its rows gives. Empty tables give an empty table. Texts are read whole;
    other columns are not carried, so clashing names do not matter.
    """
    return interaction_audit(failure_masks(docs, labels, key, text, part))
