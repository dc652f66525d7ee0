"""Packing documents into fixed-length sequences: first-fit decreasing with a tournament tree."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.rows import schema_with
from reviewlab.llm.tokens import END_OF_DOCUMENT, default_tokenizer, document_ids
from reviewlab.session import materialize

CAPACITY = 4096
#: Pieces packed together, and pieces per task (a task packs one group after another).
GROUP, PIECES_PER_TASK = 8192, 65_536
_TASK_BITS = 33
_PIECE = "start long, length long, ids_crc32 long, doc_tokens long"


def token_pieces(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    tokenizer: str | None = None, end: int = END_OF_DOCUMENT, with_ids: bool = False,
) -> DataFrame:
    """`(key, start, length, ids_crc32, doc_tokens[, ids])`: every document cut at multiples of `capacity`."""
    path = tokenizer or default_tokenizer()
    schema = schema_with(docs, [key], _PIECE + ", ids binary" * with_ids)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, starts, lengths, crcs, totals, parts = [], [], [], [], [], []
            for row, value in enumerate(batch.column(1)):
                ids = document_ids(path, value.as_py(), end)
                for start in range(0, len(ids), capacity):
                    piece = ids[start:start + capacity]
                    rows.append(row)
                    starts.append(start)
                    lengths.append(len(piece))
                    crcs.append(zlib.crc32(piece))
                    totals.append(len(ids))
                    if with_ids:
                        parts.append(piece.tobytes())
            columns = [batch.column(0).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(c, pa.int64()) for c in (starts, lengths, crcs, totals)]
            names = [key, "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return docs.select(key, text).mapInArrow(of_batches, schema)


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """`(bin, offset)` of each size: longest first, each into the first bin that still has room.

    The leaves of the tournament tree are the bins' free room and every inner node holds the larger
    of its children, so the first bin with room is found by one walk from the root.
    """
    leaves = 1 << max(0, int(len(sizes) - 1).bit_length())
    room = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        size, node = int(sizes[i]), 1
        while node < leaves:
            node *= 2
            if room[node] < size:
                node += 1
        bins[i], offsets[i] = node - leaves, capacity - room[node]
        room[node] -= size
        while node > 1:
            node //= 2
            larger = max(room[2 * node], room[2 * node + 1])
            if room[node] == larger:
                break
            room[node] = larger
    return bins, offsets


def pack(pieces: DataFrame, capacity: int = CAPACITY, group: int = GROUP, tasks: int = 1) -> DataFrame:
    """Add `sequence_id` and `offset` to `pieces`, whose first column is the document's key.

    Pieces are dealt to tasks and groups in the order of a hash of the whole piece, so a group is a
    random mix of documents and the same one on every run. A group never exceeds `group` pieces.
    """
    columns = [c for c in pieces.columns if c != "ids"]
    mixed = F.xxhash64(*columns)
    dealt = pieces.withColumn("_mix", mixed).repartition(tasks, "_mix").sortWithinPartitions("_mix", *columns)
    schema = schema_with(pieces, pieces.columns, "sequence_id long, offset long")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_id = TaskContext.get().partitionId() << _TASK_BITS
        waiting: list[pa.RecordBatch] = []

        def packed(rows: pa.Table) -> pa.RecordBatch:
            nonlocal next_id
            bins, offsets = first_fit_decreasing(rows.column("length").to_numpy(), capacity)
            rows = rows.drop_columns("_mix")
            rows = rows.append_column("sequence_id", pa.array(next_id + bins)).append_column("offset", pa.array(offsets))
            next_id += int(bins.max()) + 1
            return rows.combine_chunks().to_batches()[0]

        for batch in batches:
            waiting.append(batch)
            if sum(b.num_rows for b in waiting) >= group:
                rows = pa.Table.from_batches(waiting)
                while rows.num_rows >= group:
                    yield packed(rows.slice(0, group))
                    rows = rows.slice(group)
                waiting = rows.to_batches()
        rows = pa.Table.from_batches(waiting) if waiting else None
        if rows is not None and rows.num_rows:
            yield packed(rows)

    return dealt.mapInArrow(of_batches, schema)


def pack_documents(
    docs: DataFrame, key: str = "doc_id", text: str = "text", capacity: int = CAPACITY,
    tokenizer: str | None = None, end: int = END_OF_DOCUMENT, with_ids: bool = False,
) -> DataFrame:
    """One row per piece: key, `start`, `length`, `ids_crc32`, `doc_tokens`, `sequence_id`, `offset`.

    A document's ids are those of its text and one `end`. Null and empty text is the single id `end`.
    Documents longer than a sequence are cut; every id lies in one piece and every sequence is filled
    from 0 without gaps. Repeated rows, equal texts and null keys are documents like any other and are
    packed as often as they occur. An empty table gives an empty table. Other columns are not carried,
    so clashing names do not matter.

    Only piece lengths are shuffled (with `with_ids`, the ids too); the texts stay where they are.
    """
    pieces = materialize(token_pieces(docs, key, text, capacity, tokenizer, end, with_ids), "pieces")
    return pack(pieces, capacity, tasks=max(1, math.ceil(pieces.count() / PIECES_PER_TASK)))
