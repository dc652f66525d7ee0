"""Training-order materialisation: permuted, fixed-stride shards of token sequences."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from reviewlab.llm.tokens import END_OF_DOCUMENT, default_tokenizer, document_ids
from reviewlab.session import materialize, scratch_path

SEQUENCE_IDS = 2048
SHARD_SEQUENCES = 4096
PAD = 0
ROUNDS = 6
_PIECES = "array<struct<doc:{key}, start:long, offset:int, length:int, ids_crc32:long>>"


def id_type(tokenizer: str | None = None) -> str:
    """The smallest unsigned width that holds every id of the tokenizer: 16 bits for 49,408 entries."""
    from tokenizers import Tokenizer

    largest = max(Tokenizer.from_file(tokenizer or default_tokenizer()).get_vocab(with_added_tokens=True).values())
    return "<u2" if largest < 1 << 16 else "<u4"


def feistel(values: np.ndarray, size: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0..size-1, applied to `values`.

    A balanced Feistel network permutes the next power of four; values that fall outside the range go
    through it again (cycle-walking), less than four times on average.
    """
    half = np.uint64(max(1, ((size - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)

    def mixed(right: np.ndarray, turn: int) -> np.ndarray:
        x = right + np.uint64(((key + turn + 1) * 0x9E3779B97F4A7C15) % 2**64)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))

    def once(x: np.ndarray) -> np.ndarray:
        left, right = x >> half, x & mask
        for turn in range(rounds):
            left, right = right, left ^ (mixed(right, turn) & mask)
        return (left << half) | right

    out = once(np.asarray(values, np.uint64))
    while len(outside := np.flatnonzero(out >= size)):
        out[outside] = once(out[outside])
    return out.astype(np.int64)


def token_sequences(
    docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = SEQUENCE_IDS,
    tokenizer: str | None = None, end: int = END_OF_DOCUMENT,
) -> DataFrame:
    """`(part, number, ids, pieces)`: documents joined end to end within a task and cut every `length` ids.

    Only the last sequence of a task may be shorter. `pieces` says which ids of which documents a
    sequence holds.
    """
    path, kind = tokenizer or default_tokenizer(), id_type(tokenizer)
    key_type = docs.schema[key].dataType.simpleString()
    schema = f"part int, number long, ids binary, pieces {_PIECES.format(key=key_type)}"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        ids, filled = [], 0
        rows, ends, columns = [], [0], ([], [], [], [], [])  # pieces by column, and their end in each row

        def close() -> None:
            nonlocal ids, filled
            rows.append(np.concatenate(ids).astype(kind).tobytes())
            ends.append(len(columns[0]))
            ids, filled = [], 0

        def made() -> pa.RecordBatch:
            """The closed rows; the pieces of an open one stay behind."""
            nonlocal number
            types = [key_arrow, pa.int64(), pa.int32(), pa.int32(), pa.int64()]
            values = [pa.array(c[:ends[-1]], t) for c, t in zip(columns, types)]
            pieces = pa.StructArray.from_arrays(values, names=["doc", "start", "offset", "length", "ids_crc32"])
            batch = pa.RecordBatch.from_arrays(
                [
                    pa.array([part] * len(rows), pa.int32()), pa.array(range(number, number + len(rows)), pa.int64()),
                    pa.array(rows, pa.binary()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pieces),
                ],
                names=["part", "number", "ids", "pieces"],
            )
            number += len(rows)
            for c in columns:
                del c[:ends[-1]]
            rows.clear()
            ends[:] = [0]
            return batch

        for batch in batches:
            for doc, value in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = document_ids(path, value.as_py(), end)
                start = 0
                while start < len(own):
                    take = own[start:start + length - filled]
                    ids.append(take)
                    for c, v in zip(columns, (doc, start, filled, len(take), zlib.crc32(take))):
                        c.append(v)
                    start, filled = start + len(take), filled + len(take)
                    if filled == length:
                        close()
                    if len(rows) >= 512:
                        yield made()
        if filled:
            close()
        if rows:
            yield made()

    from pyspark.sql.pandas.types import to_arrow_type

    key_arrow = to_arrow_type(docs.schema[key].dataType)
    return docs.select(key, text).mapInArrow(of_batches, schema)


def with_slots(sequences: DataFrame, key: int) -> tuple[DataFrame, int]:
    """`(slot, ids, pieces)` with compressed ids; `slot` permutes the row numbers 0..n-1. Also returns n.

    Row numbers follow from one count per writing task; the rows themselves are not ordered for it.
    """
    counts = sequences.groupBy("part").agg(F.count("*").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    size = sequences.count()
    pieces_type = sequences.schema["pieces"].dataType.simpleString()

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        squeeze = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            slots = feistel(batch.column("ordinal").to_numpy(), size, key)
            packed = pa.array([squeeze(v.as_buffer()) for v in batch.column("ids")], pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array(slots), packed, batch.column("pieces")], names=["slot", "ids", "pieces"]
            )

    # one row per task that wrote sequences, whatever the size of the corpus
    numbered = sequences.join(F.broadcast(offsets), "part").select(
        (F.col("_before") + F.col("number")).alias("ordinal"), "ids", "pieces"
    )
    return numbered.mapInArrow(of_batches, f"slot long, ids binary, pieces {pieces_type}"), size


def write_shards(
    docs: DataFrame, path: str | None = None, key: str = "doc_id", text: str = "text", seed: int = 0,
    length: int = SEQUENCE_IDS, shard: int = SHARD_SEQUENCES, tokenizer: str | None = None,
) -> tuple[str, DataFrame]:
    """Write all documents as binary shards in training order; returns the folder and its index.

    Every sequence of `length` ids has a global `slot`; shard s is one file with the slots from
    s * `shard` on, each `length` ids wide, so slot n starts at byte (n mod `shard`) * stride. The last
    sequence of a writing task is filled up with id 0. The index has a row per piece of a document:
    `doc_id` (the key), `start`, `length`, `ids_crc32`, `slot`, `shard`, `byte_offset`, `offset`,
    `record_crc32` (of the whole record) and `held_crc32` (of the same bytes, read from the finished file).
    Ids are as wide as the tokenizer's largest one needs (`id_type`).

    Null and empty text is the single end id; repeated rows, ties and null keys are written as often as
    they occur; an empty table gives an empty index and no shard. Other columns are not carried. `path`
    lies on a file system that all executors share (default: below the shared folder). A task writes one
    shard under a name of its own and then renames it, so repeated attempts leave whole files. Very long
    texts span as many sequences as they need.
    """
    spark = docs.sparkSession
    path = path or scratch_path(spark, "shards")
    sequences = materialize(token_sequences(docs, key, text, length, tokenizer), "sequences", compression="zstd")
    placed, total = with_slots(sequences, seed)
    placed = placed.withColumn("shard", F.expr(f"cast(slot div {shard} as int)"))
    tasks = max(1, math.ceil(total / shard))
    ordered = placed.repartitionById(tasks, F.col("shard")).sortWithinPartitions("slot").select("slot", "shard", "ids", "pieces")
    pieces_type, kind = ordered.schema["pieces"].dataType.simpleString(), id_type(tokenizer)
    stride = length * np.dtype(kind).itemsize

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyarrow import fs

        store, base = fs.FileSystem.from_uri(path)
        own = f"{base}/_attempt-{TaskContext.get().taskAttemptId()}"
        rows: list[pa.RecordBatch] = []
        number, out, crcs = None, None, []
        for batch in batches:
            if batch.num_rows and out is None:
                number = batch.column("shard")[0].as_py()
                store.create_dir(own, recursive=True)
                out = store.open_output_stream(f"{own}/shard.bin")
            for packed in batch.column("ids"):
                record = _record(packed.as_py(), length, kind)
                out.write(record)
                crcs.append(zlib.crc32(record))
            rows.append(batch.drop_columns(["ids"]))
        if out is None:
            return
        out.close()
        name = f"{base}/shard-{number:08d}.bin"
        store.move(f"{own}/shard.bin", name)
        store.delete_dir(own)
        with store.open_input_stream(name) as held:
            for batch in rows:
                again = [zlib.crc32(held.read(stride)) for _ in range(batch.num_rows)]
                written, crcs = crcs[:batch.num_rows], crcs[batch.num_rows:]
                batch = batch.append_column("record_crc32", pa.array(written, pa.int64()))
                yield batch.append_column("held_crc32", pa.array(again, pa.int64()))

    schema = f"slot long, shard int, pieces {pieces_type}, record_crc32 long, held_crc32 long"
    written = materialize(ordered.mapInArrow(of_batches, schema), "index")
    index = written.select(
        "slot", "shard", "record_crc32", "held_crc32", (F.pmod("slot", F.lit(shard)) * stride).alias("byte_offset"), F.explode("pieces").alias("p")
    )
    return path, index.select(
        F.col("p.doc").alias(key), "p.start", F.col("p.length").cast("long").alias("length"), "p.ids_crc32",
        "slot", "shard", "byte_offset", F.col("p.offset").cast("long").alias("offset"), "record_crc32", "held_crc32",
    )


def _record(packed: bytes, length: int, kind: str) -> bytes:
    import zstandard

    ids = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed), kind)
    return np.pad(ids, (0, length - len(ids)), constant_values=PAD).tobytes()


def read_shards(
    spark: SparkSession, path: str, first: int = 0, last: int | None = None,
    length: int = SEQUENCE_IDS, shard: int = SHARD_SEQUENCES, tokenizer: str | None = None,
) -> DataFrame:
    """`(slot, ids)` of the slots from `first` up to (not including) `last`, from the files alone.

    Reading can be taken up at any slot: whole shards outside the range are not opened.
    """
    stride = length * np.dtype(id_type(tokenizer)).itemsize
    number = F.regexp_extract("path", r"shard-(\d+)\.bin$", 1).cast("long")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(path)
    files = files.withColumn("_shard", number).where(F.col("_shard") >= first // shard)
    if last is not None:
        files = files.where(F.col("_shard") * shard < last)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                data, base = content.as_buffer(), number * shard
                low = max(first, base)
                high = base + len(data) // stride if last is None else min(last, base + len(data) // stride)
                for start in range(low, high, 256):
                    slots = range(start, min(start + 256, high))
                    records = [data.slice((s - base) * stride, stride).to_pybytes() for s in slots]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(slots, pa.int64()), pa.array(records, pa.binary())], names=["slot", "ids"]
                    )

    return files.select("_shard", "content").mapInArrow(of_batches, "slot long, ids binary")
