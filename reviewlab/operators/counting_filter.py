"""A mergeable counting filter: which n-grams may occur in two documents, before any of them is shuffled."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.functions.text import ngram_range
from reviewlab.operators import gram_counts

#: Places of the filter (2 MB as bits); with many more n-grams than places it lets more of them through.
BITS, CHUNKS = 1 << 24, 16


def seen_twice(hashes: DataFrame, bits: int = BITS) -> np.ndarray:
    """The places (packed bits) that the distinct 64-bit hashes of two or more rows of `hashes(_h)` fall on.

    A task keeps one bit for "seen" and one for "seen again" per place. Two such pairs merge: what both
    have seen was seen again. Only these bits move, so their size does not depend on the corpus.
    """
    def of_batch(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        held = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        yield held, np.ones(len(held), np.int64)

    return _seen_twice(hashes, of_batch, bits)


def _seen_twice(rows: DataFrame, of_batch: Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray]]], bits: int) -> np.ndarray:
    """`seen_twice` for the hashes that `of_batch` finds, each with the number of rows that have it."""
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once, twice = np.zeros(bits, bool), np.zeros(bits, bool)
        for batch in batches:
            for held, documents in of_batch(batch):
                places, at, times = np.unique(held & (bits - 1), return_inverse=True, return_counts=True)
                twice[places[times > 1]] = True
                twice[places[at[documents > 1]]] = True
                twice[places[once[places]]] = True
                once[places] = True
        if once.any():
            yield _chunks(range(CHUNKS), *(np.split(np.packbits(x, bitorder="little"), CHUNKS) for x in (once, twice)))

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for number, *parts in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                once, twice = (np.frombuffer(p.as_buffer(), np.uint8) for p in parts)
                if number in held:
                    before, again = held[number]
                    once, twice = before | once, again | twice | (before & once)
                held[number] = once, twice
        if held:
            yield _chunks(list(held), *zip(*held.values()))

    schema = "number int, once binary, twice binary"
    found = rows.mapInArrow(of_task, schema).repartition(CHUNKS, "number").mapInArrow(merged, schema).select("number", "twice").toArrow()
    out = np.zeros(bits // 8, np.uint8)
    size = bits // 8 // CHUNKS
    for number, part in zip(found.column(0).to_pylist(), found.column(1)):
        out[number * size:(number + 1) * size] = np.frombuffer(part.as_buffer(), np.uint8)
    return out


def _chunks(numbers, once, twice) -> pa.RecordBatch:
    columns = [pa.array([p.tobytes() for p in parts], pa.binary()) for parts in (once, twice)]
    return pa.RecordBatch.from_arrays([pa.array(list(numbers), pa.int32()), *columns], names=["number", "once", "twice"])


def repeated_grams(documents: DataFrame, ngram_sizes: tuple[int, int], bits: int = BITS) -> DataFrame:
    """`(_grams)`: the n-grams of `(words)`, one row per document, without those that surely occur in one only.

    Every n-gram of two documents stays; of the others few do, by hashes that share a place. `bits` is a
    power of two, 128 at least.
    """
    if bits < 8 * CHUNKS or bits & (bits - 1):
        raise ValueError(f"a power of two from {8 * CHUNKS} on, not {bits}")
    rows = documents.select(ngram_range(F.col("words"), *ngram_sizes).alias("_grams")).where(F.col("_grams").isNotNull())
    rows = rows.withColumn("_h", F.transform("_grams", lambda g: F.xxhash64(g)))
    shared = documents.sparkSession.sparkContext.broadcast(seen_twice(rows.select(F.array_distinct("_h").alias("_h")), bits))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = shared.value
        for batch in batches:
            grams, hashes = batch.column("_grams"), batch.column("_h").flatten().to_numpy(zero_copy_only=False).astype(np.int64)
            place = hashes & (bits - 1)
            kept = (seen[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
            row = np.repeat(np.arange(batch.num_rows), grams.value_lengths().to_numpy(zero_copy_only=False))
            offsets = np.r_[0, np.cumsum(np.bincount(row[kept], minlength=batch.num_rows))]
            left = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), grams.flatten().filter(pa.array(kept)))
            yield pa.RecordBatch.from_arrays([left], names=["_grams"])

    return rows.mapInArrow(of_batches, "_grams array<string>")


def repeated_counts(documents: DataFrame, ngram_sizes: tuple[int, int], *keep: gram_counts.Keep, bits: int = BITS) -> DataFrame:
    """`gram_counts.counted` for the n-grams that `repeated_grams` keeps, of those that every `keep` wants."""
    wanted = gram_counts.both(*keep)

    def of_batch(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        for _, words in gram_counts.runs(batch.column(0)):
            for found in gram_counts.grams(words, ngram_sizes, wanted):
                yield gram_counts.place_of(found.distinct_hashes(), bits), found.documents()

    seen = np.unpackbits(_seen_twice(documents.select("words"), of_batch, bits), bitorder="little").astype(bool)
    return gram_counts.counted(documents, ngram_sizes, *keep, gram_counts.on_places(documents, seen))
