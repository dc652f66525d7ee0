"""Class balancing, stratified splits and folds: exact sizes, reproducible for any partitioning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.functions.keys import leading_bits, seeded_hash
from reviewlab.operators.corpus import whole_share
from reviewlab.operators.ranking import hash_rank, hash_segments

_CHUNK = 65_536
# 60 bits: a class would need 10^15 rows before any of them became noticeably rarer
_DRAW_HEX_DIGITS = 15


def balance_subsample(
    df: DataFrame, label: str = "label", key: str = "doc_id", seed: int = fv.SEED
) -> DataFrame:
    """Every class cut to the size of the smallest one, without replacement."""
    kept = hash_segments(df, label, key, seed, lambda n, smallest, largest: [smallest], "_segment")
    return kept.where(F.col("_segment") == 0).drop("_segment")


def balance_oversample(
    df: DataFrame, label: str = "label", key: str = "doc_id", seed: int = fv.SEED
) -> DataFrame:
    """Smaller classes redrawn with replacement to the size of the largest one.

    The largest class (or classes) is kept as it is. The added `draw` counts the draws of a class,
    so copies of one document can be told apart.
    """
    ranked = hash_rank(df.select(label, key), label, key, seed, "_rank")
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").alias("_size"))
    chosen = draws(sizes, label, seed).join(
        ranked.select(label, key, "_rank"), [label, "_rank"]
    ).select(key, "draw")
    return df.join(chosen, key)


def draws(sizes: DataFrame, label: str, seed: int | str) -> DataFrame:
    """`(label, draw, _rank)`: as many draws per class as the largest class has rows.

    Draw numbers are unfolded in two steps with an exchange between them, so that no task
    produces a whole class. A class that is already largest draws each of its rows once.
    """
    target = sizes.agg(F.max("_size")).scalar()
    chunks = (
        sizes.withColumn("_target", target)
        .withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_target - 1) div {_CHUNK})")))
        .repartition(label, "_chunk")
    )
    numbered = chunks.withColumn(
        "draw",
        F.explode(
            F.expr(f"sequence(_chunk * {_CHUNK}, least((_chunk + 1) * {_CHUNK}, _target) - 1)")
        ),
    )
    drawn = leading_bits(seeded_hash(seed, F.col(label), F.col("draw")), _DRAW_HEX_DIGITS)
    rank = F.when(F.col("_size") == F.col("_target"), F.col("draw")).otherwise(
        F.pmod(drawn, F.col("_size"))
    )
    return numbered.select(label, "draw", rank.alias("_rank"))


def balance(df: DataFrame, strategy: str = "subsample", **options) -> DataFrame:
    strategies = {"subsample": balance_subsample, "oversample": balance_oversample}
    if strategy not in strategies:
        raise ValueError(f"Unknown balancing strategy: {strategy}")
    if df.where(F.col(options.get("label", "label")).isNotNull()).isEmpty():
        raise ValueError("No labelled documents to balance")
    return strategies[strategy](df, **options)


def stratified_split(
    df: DataFrame,
    test_size: float = 0.2,
    validation_size: float = 0.0,
    label: str = "label",
    key: str = "doc_id",
    seed: int = fv.SEED,
) -> DataFrame:
    """Add `set`: per class `int(n * test_size)` test rows, then validation, the rest is train."""
    def ends(n: Column, smallest: Column, largest: Column) -> list[Column]:
        test = whole_share(n, test_size)
        return [test, test + whole_share(n, validation_size)]

    return _named_sets(hash_segments(df, label, key, seed, ends, "_segment"))


def two_step_split(
    df: DataFrame,
    test_size: float = 0.2,
    validation_size: float = 0.2,
    label: str = "label",
    key: str = "doc_id",
    seed: int = fv.SEED,
) -> DataFrame:
    """Test first, then `validation_size` of what is left.

    The rows left over are still in random order, so both steps can share one ranking.
    """
    def ends(n: Column, smallest: Column, largest: Column) -> list[Column]:
        test = whole_share(n, test_size)
        return [test, test + whole_share(n - test, validation_size)]

    return _named_sets(hash_segments(df, label, key, seed, ends, "_segment"))


def stratified_folds(
    df: DataFrame,
    folds: int = fv.CROSS_VALIDATION_FOLDS,
    label: str = "label",
    key: str = "doc_id",
    seed: int = fv.SEED,
) -> DataFrame:
    """Add `fold`: per class `folds` parts whose sizes differ by one row at most."""
    def ends(n: Column, smallest: Column, largest: Column) -> list[Column]:
        base, extra = F.floor(n / folds).cast("bigint"), F.pmod(n, F.lit(folds))
        return [base * i + F.least(extra, F.lit(i)) for i in range(1, folds)]

    return hash_segments(df, label, key, seed, ends, "fold")


def _named_sets(df: DataFrame) -> DataFrame:
    name = F.when(F.col("_segment") == 0, "test").when(F.col("_segment") == 1, "validation")
    return df.withColumn("set", name.otherwise("train")).drop("_segment")
