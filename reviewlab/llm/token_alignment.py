"""Alignment of two tokenizers over the bytes of whole texts: common groups, linked tokens, frequent links."""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reviewlab.llm.rows import schema_with, text_first
from reviewlab.llm.tokens import byte_letters
from reviewlab.session import materialize

BYTE_FILE, PIECE_FILE = "byte_bpe_50k.json", "piece_bpe_32k.model"
#: Texts of more characters are cut where both tokenizers must cut; characters aligned and rows given out at once.
SEGMENT_CHARACTERS, CHARACTERS_AT_ONCE, ROWS_AT_ONCE = 1 << 16, 1 << 18, 64
#: Distinct links that a task adds up before it gives them out.
LINKS_AT_ONCE = 1 << 20
#: Linked id pairs, the most frequent ones, that every task holds in memory (17 bytes each).
HOT_PAIRS = 500_000
#: Neither tokenizer joins a character other than white space to a following blank and letter.
_CUT = re.compile(r"(?<=\S) (?=[A-Za-z])")
# Fixed value: how a byte-level vocabulary of this kind cuts a text before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Characters whose class no version of Unicode has changed; other texts go through the tokenizer file's own rules.
_SETTLED = re.compile("[\x00-\u017F\u2010-\u2027\u20AC]*")
_WORKERS: dict[tuple[str, str], Aligner] = {}


def default_files() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path(BYTE_FILE), public_tokenizers.path(PIECE_FILE)


def segments(text: str, size: int = SEGMENT_CHARACTERS) -> Iterator[str]:
    """The text in pieces of about `size` characters, without the blank between two pieces.

    Where no cut is safe the piece is longer; nothing is left out.
    """
    start = 0
    while len(text) - start > size and (cut := _CUT.search(text, start + size)):
        yield text[start:cut.start()]
        start = cut.end()
    yield text[start:]


class Aligner:
    """Both tokenizers, the bytes of their entries, and the decimal spelling of their ids."""

    def __init__(self, byte_file: str, piece_file: str):
        import sentencepiece
        import tiktoken

        self.byte_file, self._library = byte_file, None
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_file)
        of_letter = {letter: byte for byte, letter in enumerate(byte_letters())}
        with open(byte_file, encoding="utf-8") as file:
            described = json.load(file)
        special = {t["id"]: t["content"].encode() for t in described["added_tokens"]}
        entries = {i: bytes(of_letter[letter] for letter in e) for e, i in described["model"]["vocab"].items() if i not in special}
        self.a_bytes = [special.get(i) or entries.get(i, b"") for i in range(1 + max([*special, *entries]))]
        # the same merges in a faster library: an entry's number is the rank of its merge
        ranks = {e: i for i, e in entries.items()}
        self.fast = tiktoken.Encoding("ranks", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.b_bytes = [
            bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode()
            for i in range(self.b.vocab_size()) for piece in [self.b.id_to_piece(i)]
        ]
        self.a_lengths, self.b_lengths = (np.array([len(e) for e in b], np.int64) for b in (self.a_bytes, self.b_bytes))
        # an id after each separator: `,` inside a run, `;` before a group, `|` between its two runs
        self.spelled = pa.array(
            [f"{s}{i}" for s, n in ((",", len(self.a_bytes)), (";", len(self.a_bytes)), (",", len(self.b_bytes)), ("|", len(self.b_bytes)))
             for i in range(n)]
        )

    def encode(self, parts: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both tokenizers for each part."""
        a = [self.fast.encode_ordinary(" " + p) if _SETTLED.fullmatch(p) else self._encode_any(p) for p in parts]
        return a, self.b.encode(parts, num_threads=1)

    def _encode_any(self, part: str) -> list[int]:
        return self.a.encode(" " + part, add_special_tokens=False).ids

    @property
    def a(self):
        """The byte-level tokenizer as its own library reads it; special tokens are plain text."""
        if self._library is None:
            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            from tokenizers import Tokenizer

            self._library = Tokenizer.from_file(self.byte_file)
            self._library.encode_special_tokens = True
        return self._library

    def whole(self, parts: list[str], a: list[list[int]], b: list[list[int]]) -> np.ndarray:
        """Whether the tokens of each part spell exactly a blank and the part, for both tokenizers."""
        wanted = [(" " + p).encode("utf-8", "surrogatepass") for p in parts]
        return np.array([
            w == b"".join(map(self.a_bytes.__getitem__, x)) == b"".join(map(self.b_bytes.__getitem__, y))
            for w, x, y in zip(wanted, a, b)
        ], bool)


def common_groups(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """`(group of each A token, group of each B token, last A token of each group)`.

    Every token points to the token that overlaps it and reaches farthest to the right; a token of B that
    ends with one of A points to that one, which points to itself. Doubling the pointers until nothing
    changes takes each token to the last one of its group, in as many rounds as the logarithm of the
    longest chain.
    """
    n = len(a_ends)
    over_b = np.searchsorted(b_ends, a_ends)
    last = b_ends[over_b] == a_ends
    successor = np.concatenate([np.where(last, np.arange(n), n + over_b), np.searchsorted(a_ends, b_ends)])
    while True:
        farther = successor[successor]
        if np.array_equal(farther, successor):
            break
        successor = farther
    number = np.cumsum(last) - 1
    groups = number[successor]
    return groups[:n], groups[n:], np.flatnonzero(last)


def _spell(aligner: Aligner, a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, starts: np.ndarray):
    """The groups' decimal spelling as bytes, and where that of each part's first group begins."""
    first_a, first_b = (np.r_[True, g[1:] != g[:-1]] for g in (of_a, of_b))
    entry = np.concatenate([a + len(aligner.a_bytes) * first_a, 2 * len(aligner.a_bytes) + b + len(aligner.b_bytes) * first_b])
    place = np.argsort(np.concatenate([2 * of_a, 2 * of_b + 1]), kind="stable")
    spelled = aligner.spelled.take(pa.array(entry[place]))
    offsets = np.frombuffer(spelled.buffers()[1], np.int32, len(spelled) + 1)
    return memoryview(spelled.buffers()[2] or b""), offsets[np.r_[starts, len(spelled)]]


class _Document:
    """What has been found of one text so far."""

    def __init__(self):
        self.whole, self.n_a, self.n_b, self.n_groups = True, 0, 0, 0
        self.digest, self.keys, self.times = hashlib.sha256(), [], []

    def add(self, n_a: int, n_b: int, n_groups: int, spelled: memoryview, keys: np.ndarray, times: np.ndarray) -> None:
        self.digest.update(spelled if self.n_groups else spelled[1:])
        self.n_a, self.n_b, self.n_groups = self.n_a + n_a, self.n_b + n_b, self.n_groups + n_groups
        self.keys.append(keys)
        self.times.append(times)

    def row(self) -> tuple:
        if not self.whole or not self.n_groups:
            return 0, 0, 0, "", np.empty(0, np.int64), np.empty(0, np.int64)
        keys, times = self.keys[0], self.times[0]
        if len(self.keys) > 1:
            keys, at = np.unique(np.concatenate(self.keys), return_inverse=True)
            times = np.bincount(at, np.concatenate(self.times), len(keys)).astype(np.int64)
        return self.n_a, self.n_b, self.n_groups, self.digest.hexdigest(), keys, times


def _align(aligner: Aligner, parts: list[tuple[_Document, str]]) -> None:
    """Add what the parts hold to their documents; a document with a part that does not fit loses all."""
    a, b = aligner.encode([p for _, p in parts])
    fits = aligner.whole([p for _, p in parts], a, b)
    for (document, _), fit in zip(parts, fits):
        document.whole &= bool(fit)
    used = [i for i in range(len(parts)) if parts[i][0].whole and fits[i]]
    if not used:
        return
    documents = [parts[i][0] for i in used]
    counts_a, counts_b = (np.array([len(x[i]) for i in used]) for x in (a, b))
    ids_a, ids_b = (np.concatenate([np.array(x[i], np.int64) for i in used]) for x in (a, b))
    of_a, of_b, last = common_groups(np.cumsum(aligner.a_lengths[ids_a]), np.cumsum(aligner.b_lengths[ids_b]))
    ends_a, ends_b = np.cumsum(counts_a), np.cumsum(counts_b)
    starts = np.r_[0, (ends_a + ends_b)[:-1]]
    spelled, cuts = _spell(aligner, ids_a, ids_b, of_a, of_b, starts)
    group_ends = of_a[ends_a - 1] + 1
    group_counts = np.diff(np.r_[0, group_ends])
    pairs = ids_a[last] * len(aligner.b_bytes) + ids_b[np.searchsorted(of_b, np.arange(len(last)), side="right") - 1]
    room = len(aligner.a_bytes) * len(aligner.b_bytes)
    of_part = np.repeat(np.arange(len(used)), group_counts)
    keys, times = np.unique(of_part * room + pairs, return_counts=True)
    bounds = np.searchsorted(keys, np.arange(len(used) + 1) * room)
    for i, document in enumerate(documents):
        held = slice(bounds[i], bounds[i + 1])
        document.add(
            int(counts_a[i]), int(counts_b[i]), int(group_counts[i]), spelled[cuts[i]:cuts[i + 1]],
            keys[held] - i * room, times[held],
        )


def _pack(keys: np.ndarray, times: np.ndarray) -> bytes:
    """Ascending keys and their numbers as compressed bytes."""
    import zstandard

    return zstandard.ZstdCompressor(level=1).compress(np.diff(keys, prepend=0).tobytes() + times.astype("<i8").tobytes())


def _unpack(packed: pa.Scalar) -> tuple[np.ndarray, np.ndarray]:
    import zstandard

    both = np.frombuffer(zstandard.ZstdDecompressor().decompress(packed.as_buffer()), "<i8")
    return np.cumsum(both[:len(both) // 2]), both[len(both) // 2:]


def aligned_texts(docs: DataFrame, text: str, carry: list[str], files: tuple[str, str] | None = None) -> DataFrame:
    """`carry`, `n_a`, `n_b`, `n_groups`, `groups_sha256` and `links`, a text's distinct links and their numbers.

    A link is written as `A id * size of B + B id`; `_unpack` reads the column.
    """
    paths = files or default_files()
    more = "n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
    schema = schema_with(docs, carry, more)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _WORKERS.setdefault(paths, None) or Aligner(*paths)
        _WORKERS[paths] = aligner
        for batch in batches:
            documents, waiting, size, done = [], [], 0, 0

            def rows(upto: int, at: int, batch=batch, documents=documents) -> pa.RecordBatch:
                found = [d.row() for d in documents[at:upto]]
                documents[at:upto] = [None] * (upto - at)
                n_a, n_b, n_groups, digests, keys, times = zip(*found)
                links = pa.array([_pack(k, t) for k, t in zip(keys, times)], pa.binary())
                numbers = [pa.array(c, pa.int64()) for c in (n_a, n_b, n_groups)]
                own = [c.slice(at, upto - at) for c in batch.columns[1:]]
                columns = [*own, *numbers, pa.array(digests, pa.string()), links]
                return pa.RecordBatch.from_arrays(columns, names=schema.names)

            for value in batch.column(0):
                text = value.as_py() or ""
                documents.append(_Document())
                for part in segments(text) if text else ():
                    waiting.append((documents[-1], part))
                    size += len(part)
                    if size >= CHARACTERS_AT_ONCE:
                        _align(aligner, waiting)
                        waiting, size = [], 0
                if not waiting and len(documents) - done >= ROWS_AT_ONCE:
                    yield rows(len(documents), done)
                    done = len(documents)
            if waiting:
                _align(aligner, waiting)
            if len(documents) > done:
                yield rows(len(documents), done)

    return text_first(docs, text, carry).mapInArrow(of_batches, schema)


def link_totals(aligned: DataFrame, size_b: int) -> DataFrame:
    """`(pair, total, best)`: links of each id pair over all texts, and whether no other A id has more
    links with the same B id. The best totals are one row per entry of B's vocabulary."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, times = np.empty(0, np.int64), np.empty(0, np.int64)

        def added(more: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
            all_keys = np.concatenate([keys, *[k for k, _ in more]])
            found, at = np.unique(all_keys, return_inverse=True)
            return found, np.bincount(at, np.concatenate([times, *[t for _, t in more]]), len(found)).astype(np.int64)

        waiting, size = [], 0
        for batch in batches:
            for packed in batch.column(0):
                waiting.append(_unpack(packed))
                size += len(waiting[-1][0])
                if size >= LINKS_AT_ONCE:
                    keys, times = added(waiting)
                    waiting, size = [], 0
                if len(keys) >= LINKS_AT_ONCE:
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], names=["pair", "n"])
                    keys, times = keys[:0], times[:0]
        keys, times = added(waiting)
        yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(times)], names=["pair", "n"])

    links = aligned.select("links").mapInArrow(of_batches, "pair long, n long").groupBy("pair")
    totals = materialize(links.agg(F.sum("n").alias("total")), "link-totals")
    of_b = F.pmod(F.col("pair"), F.lit(size_b)).alias("b")
    most = totals.groupBy(of_b).agg(F.max("total").alias("most"))
    joined = totals.withColumn("b", of_b).join(F.broadcast(most), "b")
    return materialize(joined.select("pair", "total", (F.col("total") == F.col("most")).alias("best")), "links")


def _hot_cut(totals: DataFrame, most: int) -> int:
    """The least total such that at most `most` pairs have it or more."""
    # a few thousand steps on a logarithmic scale, whatever the table; small totals have steps of their own
    by_total = totals.groupBy(F.floor(F.log2("total") * 64).alias("step")).agg(
        F.count("*").alias("n"), F.max("total").alias("top")
    ).orderBy(F.desc("step")).collect()
    taken = 0
    for row in by_total:
        taken += row["n"]
        if taken > most:
            return row["top"] + 1
    return 0


def align_tokenizers(
    docs: DataFrame, key: str = "doc_id", text: str = "text", files: tuple[str, str] | None = None,
    hot_pairs: int = HOT_PAIRS,
) -> DataFrame:
    """`(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)`, one row per input row.

    A text's tokens are those of a blank and the text by a byte-level tokenizer (A) and of the text by a
    piece tokenizer that adds the blank (B). Groups end where tokens of both end; the A and the B token
    that end there are a link. `n_best` counts links whose pair is the most frequent one of its B id in
    the whole table, ties included, and `count_sum` adds the table-wide numbers of the links' pairs.

    Null and empty texts, and texts whose tokens do not spell them (a literal U+2581), have zeros and an
    empty digest. Repeated rows, equal texts and null keys are documents like any other and count as often
    as they occur. An empty table gives an empty table. Other columns are not carried, so clashing names
    do not matter. Very long texts are aligned in segments that end where both tokenizers must cut.

    Texts are read once and never move. Every task holds the `hot_pairs` most frequent pairs; the rest,
    none of which is frequent, are joined by pair.
    """
    paths = files or default_files()
    size_b = _vocabulary_size(paths[1])
    found = aligned_texts(docs.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")), "_text", ["_key"], paths)
    aligned = materialize(found.withColumn("_row", F.monotonically_increasing_id()), "aligned", "none")
    totals = link_totals(aligned, size_b)
    cut = _hot_cut(totals, hot_pairs)
    counted = _count_hot(aligned, totals.where(F.col("total") >= cut))
    own = ["_key", "n_a", "n_b", "n_groups", "groups_sha256"]
    if cut:
        counted = materialize(counted, "counted", "none")
        rare = _unfolded(counted)
        rest = rare.join(totals.where(F.col("total") < cut), "pair").groupBy("_row").agg(
            F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("more_best"),
            F.sum(F.col("times") * F.col("total")).alias("more_sum"),
        )
        counted = counted.join(rest, "_row", "left").select(
            *own, (F.col("n_best") + F.coalesce("more_best", F.lit(0))).alias("n_best"),
            (F.col("count_sum") + F.coalesce("more_sum", F.lit(0))).alias("count_sum"),
        )
    return counted.select(
        F.col("_key").alias(key), "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )


def _vocabulary_size(piece_file: str) -> int:
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=piece_file).vocab_size()


def _count_hot(aligned: DataFrame, hot: DataFrame) -> DataFrame:
    """`n_best` and `count_sum` of the links in `hot` (bounded); `links` keeps the others."""
    table = hot.orderBy("pair").toArrow()
    keys, totals, best = (table.column(c).to_numpy() for c in ("pair", "total", "best"))
    shared = aligned.sparkSession.sparkContext.broadcast((keys, totals, best.astype(np.int64)))
    carried = ["_key", "_row", "n_a", "n_b", "n_groups", "groups_sha256"]
    schema = schema_with(aligned, carried, "n_best long, count_sum long, links binary")

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, totals, best = shared.value
        for batch in batches:
            n_best, count_sum, rest = [], [], []
            for packed in batch.column("links"):
                pairs, times = _unpack(packed)
                at = np.minimum(np.searchsorted(keys, pairs), max(0, len(keys) - 1))
                known = keys[at] == pairs if len(keys) else np.zeros(len(pairs), bool)
                n_best.append(int(times[known] @ best[at[known]]))
                count_sum.append(int(times[known] @ totals[at[known]]))
                rest.append(None if known.all() else _pack(pairs[~known], times[~known]))
            columns = [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64()), pa.array(rest, pa.binary())]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in carried], *columns], names=schema.names)

    return aligned.select(*carried, "links").mapInArrow(of_batches, schema)


def _unfolded(counted: DataFrame) -> DataFrame:
    """`(_row, pair, times)` of the links that are left."""
    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, packed in zip(batch.column(0), batch.column(1)):
                pairs, times = _unpack(packed)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(row, len(pairs)), pa.array(pairs), pa.array(times)], names=["_row", "pair", "times"]
                )

    left = counted.where(F.col("links").isNotNull()).select("_row", "links")
    return left.mapInArrow(of_batches, "_row long, pair long, times long")
