"""SimHash near-duplicates with bit-sliced comparison of fingerprints."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.components import connected_components
from reviewlab.llm.rows import ascii_lower, schema_with, split_words
from reviewlab.session import materialize

BITS = 64
SHINGLE_WORDS = 4
RADIUS = 4
#: Above it the choices of agreeing parts become too many.
MOST_RADIUS = 16
#: Fingerprints per comparison block; larger buckets are compared block against block.
BLOCK = 4096
#: Bits that are counted at once, and (fingerprint, word of lanes) pairs compared at once.
_CHUNK_HASHES, _CHUNK_PAIRS = 1 << 18, 1 << 15
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: Column, width: int = SHINGLE_WORDS) -> Column:
    """XXH64 (seed 42) of each run of `width` words; of the whole sequence if it is shorter."""
    def joined(words: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.greatest(F.size(words) - width, F.lit(0))),
            lambda i: F.xxhash64(F.concat_ws(" ", *[F.get(words, i + j) for j in range(width)])),
        )

    words = F.filter(F.array(split_words(ascii_lower(text))), lambda w: F.size(w) > 0)
    return F.coalesce(F.get(F.transform(words, joined), 0), F.array().cast("array<bigint>"))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """`(key, fp)`: bit i of `fp` is set if it is set in more than half of the shingle hashes."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            hashes = batch.column(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(_majority(hashes).view(np.int64))], names=[key, "fp"]
            )

    hashed = docs.select(key, shingle_hashes(F.col(text)).alias("_h"))
    return hashed.mapInArrow(of_batches, schema_with(docs, [key], "fp long"))


def _majority(hashes: pa.ListArray) -> np.ndarray:
    values = np.ascontiguousarray(hashes.values.to_numpy(zero_copy_only=False)).view(np.uint8).reshape(-1, 8)
    bounds = hashes.offsets.to_numpy().astype(np.int64)
    counts = np.zeros((len(hashes), BITS), np.int64)
    for low in range(int(bounds[0]), int(bounds[-1]), _CHUNK_HASHES):
        high = min(low + _CHUNK_HASHES, int(bounds[-1]))
        first, last = np.clip(bounds[:-1], low, high), np.clip(bounds[1:], low, high)
        held = np.flatnonzero(last > first)
        bits = np.unpackbits(values[low:high], axis=1, bitorder="little")
        counts[held] += np.add.reduceat(bits, first[held] - low, axis=0, dtype=np.int64)
    major = 2 * counts > np.diff(bounds)[:, None]
    return np.packbits(major, axis=1, bitorder="little").view(np.uint64).ravel()


def similar_fingerprints(fps: DataFrame, radius: int = RADIUS, block: int = BLOCK) -> DataFrame:
    """Links `(u, v)` that connect all distinct `fp` within `radius` bits, directly or by chains.

    The bits are cut into `radius + k` parts, so similar fingerprints agree in some `k` of them and
    meet in the bucket of that choice; `k` grows with the number of fingerprints so that buckets stay
    small. A bucket above `block` is cut into blocks, and each pair of blocks is a task of its own.
    Within a task all fingerprints are compared, but only a spanning set of the links leaves it.
    """
    if not 0 <= radius <= MOST_RADIUS:
        raise ValueError(f"a radius from 0 to {MOST_RADIUS}, not {radius}")
    total = fps.count()
    keep = 2
    while keep < 8 and total > 16 * 2 ** (BITS * keep / (radius + keep)):
        keep += 1
    buckets = [F.xxhash64(F.lit(n), F.col("fp").bitwiseAND(F.lit(m))) for n, m in enumerate(bucket_masks(radius, keep))]
    keyed = fps.select("fp", F.explode(F.array(*buckets)).alias("bucket"))
    hot = materialize(
        keyed.groupBy("bucket").agg(F.count("*").alias("n")).where(F.col("n") > block)
        .select("bucket", F.ceil(F.col("n") / block).cast("int").alias("parts")), "hot-buckets",
    )
    # few buckets are above the block size; adaptive execution broadcasts them when they are small
    placed = keyed.join(hot, "bucket", "left").withColumn("parts", F.coalesce("parts", F.lit(1)))
    own = F.pmod(F.xxhash64(F.lit(7), F.col("fp")), F.col("parts")).cast("int")
    tasks = placed.withColumn("own", own).select(
        "fp", "bucket", "own", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("other")
    )
    tasks = tasks.select(
        "fp", F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("task")
    )
    dealt = tasks.repartition("task").sortWithinPartitions("task", "fp")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, fp = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            task = np.concatenate([task, batch.column(1).to_numpy()])
            fp = np.concatenate([fp, batch.column(0).to_numpy().view(np.uint64)])
            whole = int(np.searchsorted(task, task[-1])) if len(task) else 0
            yield from _linked(task[:whole], fp[:whole], radius)
            task, fp = task[whole:], fp[whole:]
        yield from _linked(task, fp, radius)

    return dealt.mapInArrow(of_batches, "u long, v long")


def bucket_masks(radius: int, keep: int) -> list[int]:
    """Masks (as signed 64-bit numbers) of every choice of `keep` out of `radius + keep` parts."""
    cuts = [BITS * i // (radius + keep) for i in range(radius + keep + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(chosen) for chosen in combinations(parts, keep)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _linked(task: np.ndarray, fp: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    if len(task):
        again = task[1:] == task[:-1]
        shared = np.r_[again, False] | np.r_[False, again]
        task, fp = task[shared], fp[shared]
    for a, b in bit_sliced_links(task, fp, radius):
        u, v = spanning_links(fp[a], fp[b])
        yield pa.RecordBatch.from_arrays(
            [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"]
        )


def bit_sliced_links(task: np.ndarray, fp: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs `(i, j)` of rows of one task whose `fp` differ in at most `radius` bits.

    `task` is sorted. 64 rows of a task share a machine word per bit plane; carry-save adders count
    the differing planes of all 64 at once, and words whose rows all exceed the radius are left.
    """
    n = len(task)
    if n < 2:
        return
    starts = np.flatnonzero(np.r_[True, task[1:] != task[:-1]])
    sizes = np.diff(np.r_[starts, n])
    rank = np.arange(n) - np.repeat(starts, sizes)
    words = -(-sizes // BITS)
    first_word = np.r_[0, np.cumsum(words)[:-1]]
    lane = (rank % BITS).astype(np.uint64)
    word = np.repeat(first_word, sizes) + rank // BITS
    word_start = np.flatnonzero(lane == 0)
    one = np.uint64(1)
    planes = np.stack([
        np.bitwise_or.reduceat(((fp >> np.uint64(b)) & one) << lane, word_start) for b in range(BITS)
    ])
    filled = np.bitwise_or.reduceat(one << lane, word_start)
    later = np.where(lane == 63, np.uint64(0), _ALL << ((lane + one) % np.uint64(64)))
    reach = np.repeat(first_word + words, sizes) - word
    reach[np.repeat(sizes, sizes) == 1] = 0
    ends = np.cumsum(reach)
    for low in range(0, int(ends[-1]), _CHUNK_PAIRS):
        pairs = np.arange(low, min(low + _CHUNK_PAIRS, int(ends[-1])))
        row = np.searchsorted(ends, pairs, side="right")
        at = word[row] + pairs - (ends[row] - reach[row])
        valid = filled[at] & np.where(at == word[row], later[row], _ALL)
        row, at, near = _near_lanes(planes, fp, row, at, valid, radius)
        hit, lanes = np.nonzero(np.unpackbits(near.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        if len(hit):
            yield row[hit], word_start[at[hit]] + lanes


def _near_lanes(planes, fp, row, at, valid, radius):
    over = ~valid
    # as many counter bits as the radius needs; a lane that counts beyond them is over for good
    counter = np.zeros((max(3, radius.bit_length()), len(row)), np.uint64)
    value = fp[row]

    def differing(bit: int) -> np.ndarray:
        wanted = np.uint64(0) - ((value >> np.uint64(bit)) & np.uint64(1))
        return planes[bit][at] ^ wanted

    for bit in range(0, BITS, 4):
        counter[0], carry = _carry_save(counter[0], differing(bit), differing(bit + 1))
        counter[0], carry2 = _carry_save(counter[0], differing(bit + 2), differing(bit + 3))
        counter[1], carry = _carry_save(counter[1], carry, carry2)
        for plane in counter[2:]:
            plane ^= carry
            carry &= ~plane
        over = over | carry
        beyond = over | _exceeds(counter, radius)
        alive = beyond != _ALL
        if np.count_nonzero(alive) < 0.7 * len(alive):
            row, at, value = row[alive], at[alive], value[alive]
            over, counter = over[alive], counter[:, alive]
    near = ~(over | _exceeds(counter, radius))
    found = near != 0
    return row[found], at[found], near[found]


def _carry_save(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def _exceeds(counter: np.ndarray, radius: int) -> np.ndarray:
    """Lanes whose count, lowest bit first, is above `radius`."""
    above, equal = np.zeros_like(counter[0]), np.full_like(counter[0], _ALL)
    for bit in reversed(range(len(counter))):
        if radius >> bit & 1:
            equal = equal & counter[bit]
        else:
            above, equal = above | (equal & counter[bit]), equal & ~counter[bit]
    return above


def spanning_links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fewest links with the same connected parts: each value with the smallest one of its part."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    left, right = ends[: len(a)], ends[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if np.array_equal(new, label):
            break
        label = new
    moved = label != np.arange(len(nodes))
    return nodes[moved], nodes[label[moved]]


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", radius: int = RADIUS) -> DataFrame:
    """`(key, fp, component_id)`, one row per input row: the smallest id reachable over links.

    A null, empty or blank text has fingerprint zero and is linked like any other; a text of fewer
    than four words is one shingle. Equal fingerprints (exact copies, ties, repeated rows) are one
    node of the graph, so copies never meet as pairs. A null id gets its component's smallest id, or
    null if there is none. An empty table gives an empty table. Other columns are not carried, so
    clashing names do not matter.
    """
    prints = materialize(fingerprints(docs.select(key, text), key, text), "fingerprints")
    distinct = materialize(prints.groupBy("fp").agg(F.min(key).alias("least_id")), "distinct-fingerprints")
    parts = connected_components(similar_fingerprints(distinct.select("fp"), radius))
    rooted = distinct.join(parts, F.col("fp") == F.col("node"), "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    roots = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    labels = rooted.join(roots, "root").select("fp", "component_id")
    return prints.join(labels, "fp").select(key, "fp", "component_id")
