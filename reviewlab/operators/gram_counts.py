"""N-grams counted where their document lies: Arrow batches of words in, one row per distinct n-gram of a run out."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Words that are counted at once; whole documents, so that a longer one is a run of its own.
RUN_WORDS = 1 << 20
_BASE = np.uint64(0x9E3779B97F4A7C15)


#: Places of the table of frequencies (16 MB), and the pieces in which it moves.
PLACES, PIECES = 1 << 21, 16
Keep = Callable[[np.ndarray], np.ndarray]


@dataclass(frozen=True)
class Grams:
    """The n-grams of a run: per occurrence its document, its hash and its number among the distinct terms."""

    row: np.ndarray
    hashes: np.ndarray
    number: np.ndarray
    distinct: int
    terms: pa.Array

    def documents(self) -> np.ndarray:
        """Per distinct n-gram the documents that hold it."""
        rows = int(self.row.max()) + 1
        pairs = pa.array(self.number * rows + self.row).unique().to_numpy()
        return np.bincount(pairs // rows, minlength=self.distinct)

    def distinct_hashes(self) -> np.ndarray:
        out = np.zeros(self.distinct, np.uint64)
        out[self.number] = self.hashes
        return out


def runs(words: pa.ListArray) -> Iterator[tuple[int, pa.ListArray]]:
    """Slices of whole rows with about `RUN_WORDS` words, and the row that each starts at."""
    ends = np.cumsum(words.value_lengths().fill_null(0).to_numpy().astype(np.int64))
    low = 0
    while low < len(words):
        before = ends[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(ends, before + RUN_WORDS, side="right")))
        if ends[high - 1] > before:
            yield low, words.slice(low, high - low)
        low = high


class _Run:
    """The words of a run as numbers of its distinct words."""

    def __init__(self, words: pa.ListArray):
        length = words.value_lengths().fill_null(0).to_numpy().astype(np.int64)
        self.row = np.repeat(np.arange(len(length)), length)
        self.left = np.repeat(np.cumsum(length), length) - np.arange(length.sum())
        coded = words.flatten().dictionary_encode("encode")
        self.code, self.own = coded.indices.to_numpy().astype(np.int64), coded.dictionary.cast(pa.string())
        self.blank = pc.any(pc.match_substring(self.own, " ")).as_py()
        self.null = self.own.is_null().to_numpy(zero_copy_only=False)[self.code] if self.own.null_count else None

    def occurrences(self, sizes: tuple[int, int]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """Per length the positions that n-grams start at, and their hashes; no longer one holds a null word."""
        value, power = (x[self.code] for x in _word_hashes(self.own))
        at, hashes = np.arange(len(self.code)), value
        for n in range(1, sizes[1] + 1):
            if n > 1:
                held = self.left[at] >= n
                if self.null is not None:
                    held &= ~self.null[at]
                    held[held] &= ~self.null[at[held] + n - 1]
                at, hashes = at[held], hashes[held]
                last = at + n - 1
                hashes = hashes * power[last] + value[last]
            if n >= sizes[0] and len(at):
                yield n, at, hashes


def grams(words: pa.ListArray, sizes: tuple[int, int], keep: Keep | None = None) -> list[Grams]:
    """The n-grams of a run by their length, those alone that `keep` wants by their hashes.

    Words hold no blank as a rule. Where one does, an n-gram may spell the same term as a longer one, so that
    all lengths are then numbered together.
    """
    run, out = _Run(words), []
    for n, at, hashes in run.occurrences(sizes):
        if keep is not None:
            wanted = keep(hashes)
            at, hashes = at[wanted], hashes[wanted]
            if not len(at):
                continue
        coded = pa.array(run.code[at]).dictionary_encode()
        terms = run.own.take(coded.dictionary)
        for shift in range(1, n):
            number = coded.indices.to_numpy().astype(np.int64)
            coded = pa.array(number * len(run.own) + run.code[at + shift]).dictionary_encode()
            before, last = (pa.array(x) for x in np.divmod(coded.dictionary.to_numpy(), len(run.own)))
            terms = pc.binary_join_element_wise(terms.take(before), run.own.take(last), " ")
        out.append(Grams(run.row[at], hashes, coded.indices.to_numpy().astype(np.int64), len(terms), terms))
    return [_together(out)] if run.blank and len(out) > 1 else out


def _word_hashes(own: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Per word a hash of its blank-separated parts and the factor of what comes before it.

    A term has one hash, however it is put together: hash(a b) = hash(a) * factor(b) + hash(b).
    """
    value, power = pd.util.hash_array(own.to_numpy(zero_copy_only=False), categorize=False), np.full(len(own), _BASE)
    with_blank = np.flatnonzero(pc.match_substring(own, " ").fill_null(False).to_numpy(zero_copy_only=False))
    if len(with_blank):
        parts = pc.split_pattern(own.take(pa.array(with_blank)), " ")
        hashes = pd.util.hash_array(parts.flatten().to_numpy(zero_copy_only=False), categorize=False)
        length = parts.value_lengths().to_numpy()
        start = np.cumsum(length) - length
        value[with_blank] = hashes[start]
        for shift in range(1, int(length.max())):
            longer = length > shift
            value[with_blank[longer]] = value[with_blank[longer]] * _BASE + hashes[start[longer] + shift]
            power[with_blank[longer]] *= _BASE
    return value, power


def _together(parts: list[Grams]) -> Grams:
    """Grams of several lengths under numbers of their terms."""
    coded = pa.concat_arrays([p.terms for p in parts]).dictionary_encode("encode")
    renumbered, offset, number = coded.indices.to_numpy().astype(np.int64), 0, []
    for p in parts:
        number.append(renumbered[p.number + offset])
        offset += p.distinct
    row, hashes = (np.concatenate([getattr(p, c) for p in parts]) for c in ("row", "hashes"))
    return Grams(row, hashes, np.concatenate(number), len(coded.dictionary), coded.dictionary)


def place_of(hashes: np.ndarray, places: int) -> np.ndarray:
    """One of `places` (a power of two): the upper bits are folded into the lower ones, which decide."""
    folded = (hashes ^ (hashes >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return ((folded ^ (folded >> np.uint64(32))) & np.uint64(places - 1)).astype(np.int64)


def frequency_bounds(documents: DataFrame, sizes: tuple[int, int], places: int = PLACES) -> np.ndarray:
    """Per place the occurrences of all n-grams that fall on it: at least those of each of them.

    A task keeps one table, and tables add up, so what moves does not depend on the corpus.
    """
    def of_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(places, np.int64)
        for batch in batches:
            for _, words in runs(batch.column(0)):
                for _, _, hashes in _Run(words).occurrences(sizes):
                    total += np.bincount(place_of(hashes, places), minlength=places)
        if total.any():
            yield _pieces(range(PIECES), np.split(total, PIECES))

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for number, part in zip(batch.column(0).to_pylist(), batch.column(1)):
                counts = np.frombuffer(part.as_buffer(), np.int64)
                held[number] = held[number] + counts if number in held else counts
        if held:
            yield _pieces(list(held), list(held.values()))

    schema = "number int, counts binary"
    found = documents.select("words").mapInArrow(of_task, schema).repartition(PIECES, "number").mapInArrow(added, schema).toArrow()
    out = np.zeros((PIECES, places // PIECES), np.int64)
    for number, part in zip(found.column(0).to_pylist(), found.column(1)):
        out[number] = np.frombuffer(part.as_buffer(), np.int64)
    return out.ravel()


def _pieces(numbers, parts) -> pa.RecordBatch:
    columns = [pa.array(list(numbers), pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["number", "counts"])


def on_places(documents: DataFrame, chosen: np.ndarray) -> Keep:
    """A test for n-grams that fall on a chosen place (one boolean each), as a table for all tasks."""
    places = len(chosen)
    shared = documents.sparkSession.sparkContext.broadcast(np.packbits(chosen, bitorder="little"))

    def keep(hashes: np.ndarray) -> np.ndarray:
        place = place_of(hashes, places)
        return (shared.value[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1

    return keep


def counted(documents: DataFrame, sizes: tuple[int, int], *keep: Keep) -> DataFrame:
    """`(term, df, tf)` per run of documents, to be added up by term; of n-grams that every `keep` wants."""
    wanted = both(*keep)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, words in runs(batch.column(0)):
                for found in grams(words, sizes, wanted):
                    table = [found.terms, pa.array(found.documents()), pa.array(np.bincount(found.number, minlength=found.distinct))]
                    yield pa.RecordBatch.from_arrays(table, names=["term", "df", "tf"])

    return documents.select("words").mapInArrow(of_batches, "term string, df bigint, tf bigint")


def both(*keep: Keep) -> Keep | None:
    """What all of them want; without any, everything."""
    if len(keep) < 2:
        return keep[0] if keep else None

    def of_all(hashes: np.ndarray) -> np.ndarray:
        wanted = keep[0](hashes)
        for more in keep[1:]:
            wanted[wanted] = more(hashes[wanted])
        return wanted

    return of_all


def counted_known(documents: DataFrame, terms: DataFrame, sizes: tuple[int, int], keys: list[str]) -> DataFrame:
    """`(*keys, <columns of terms>, count)` per row of `documents` for its n-grams in `terms`.

    The vocabulary goes to every task: one of bounded size only.
    """
    columns = [c for c in terms.columns if c != "term"]
    shared = _shared_terms(documents, terms)
    schema = T.StructType([*[documents.schema[k] for k in keys], *[terms.schema[c] for c in columns], T.StructField("count", T.LongType())])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        for batch, hits in _known_runs(batches, vocabulary, sizes):
            for row, at, count in hits:
                rows, own = pa.array(row), vocabulary.take(pa.array(at))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(k).take(rows) for k in keys], *[pa.concat_arrays(own[c].chunks) for c in columns], pa.array(count)],
                    schema=pa.schema([*[batch.schema.field(k) for k in keys], *[vocabulary.schema.field(c) for c in columns], ("count", pa.int64())]),
                )

    return documents.select(*[F.col(k) for k in keys], "words").mapInArrow(of_batches, schema)


def weighted_known(documents: DataFrame, terms: DataFrame, sizes: tuple[int, int], keys: list[str]) -> DataFrame:
    """`(*keys, idx, value)` with arrays: each row of `documents` with its n-grams in `terms(term, idx, idf)`.

    A value is (1 + ln count) * idf, scaled to length 1 per row; entries lie in the order of `idx`. Rows without
    a known n-gram have none. The vocabulary goes to every task.
    """
    shared = _shared_terms(documents, terms.select("term", F.col("idx").cast("bigint").alias("idx"), F.col("idf").cast("double").alias("idf")))
    schema = T.StructType([*[documents.schema[k] for k in keys], T.StructField("idx", T.ArrayType(T.LongType())), T.StructField("value", T.ArrayType(T.DoubleType()))])

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        idx, idf = (shared.value[c].to_numpy() for c in ("idx", "idf"))
        for batch, hits in _known_runs(batches, shared.value, sizes):
            parts = list(hits)
            if not parts:
                continue
            row, at, count = (np.concatenate(x) for x in zip(*parts))
            order = np.lexsort((idx[at], row))
            row, at, count = row[order], at[order], count[order]
            weight = (1.0 + np.log(count)) * idf[at]
            begin = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            length = np.sqrt(np.add.reduceat(weight * weight, begin))
            value = weight / np.repeat(length, np.diff(np.r_[begin, len(row)]))
            offsets, rows = pa.array(np.r_[begin, len(row)], pa.int32()), pa.array(row[begin])
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(rows) for k in keys], *[pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (idx[at], value)]],
                names=schema.names,
            )

    return documents.select(*[F.col(k) for k in keys], "words").mapInArrow(of_batches, schema)


def _shared_terms(documents: DataFrame, terms: DataFrame):
    return documents.sparkSession.sparkContext.broadcast(terms.where("term is not null").orderBy("term").toArrow().combine_chunks())


def _known_runs(
    batches: Iterator[pa.RecordBatch], vocabulary: pa.Table, sizes: tuple[int, int]
) -> Iterator[tuple[pa.RecordBatch, Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]]:
    """Per run its batch and, by length, row in the batch, row in `vocabulary` (ordered by term) and count of n-grams."""
    coded = pa.concat_arrays([pa.array([], pa.string()), *vocabulary["term"].cast(pa.string()).chunks]).dictionary_encode()
    # equal terms lie side by side
    first = np.flatnonzero(np.diff(coded.indices.to_numpy(), prepend=-1))
    each = np.diff(np.r_[first, len(coded)])
    chosen = np.zeros(PLACES, bool)
    chosen[place_of(_word_hashes(coded.dictionary)[0], PLACES)] = True

    def hits(start: int, words: pa.ListArray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        for found in grams(words, sizes, lambda hashes: chosen[place_of(hashes, PLACES)]):
            place = pc.index_in(found.terms, coded.dictionary, skip_nulls=True).fill_null(-1).to_numpy()[found.number]
            known = place >= 0
            if not known.any():
                continue
            pairs, count = np.unique(found.row[known] * len(first) + place[known], return_counts=True)
            row, place = pairs // len(first), pairs % len(first)
            copies = each[place]
            at = np.repeat(first[place], copies) + np.arange(copies.sum()) - np.repeat(np.cumsum(copies) - copies, copies)
            yield start + np.repeat(row, copies), at, np.repeat(count, copies)

    for batch in batches:
        for start, words in runs(batch.column("words")):
            yield batch, hits(start, words)
