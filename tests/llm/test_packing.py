"""Token ids, packing and shards: exact round trips and brute force."""

import collections
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from reviewlab.llm import packing, queries, token_output, tokens

SCHEMA = "doc_id long, text string, length int, ids string"
ODD_TEXTS = [
    "don't. I'LL, x're it's", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|> A", "a b c\x1cd", "Å B́, ΟΔΟΣ. İstanbul",
    "é.,", "É. ß, ÿ×÷", "x" * 5000, "123.45, 7.", "\x00a b", "'s. 's 'S,", "日本語。テスト 😀.", "re, 've, a.b, a,.", "ab<|",
    "", None, ",. .", "ﬁ, ǅ.", "́a b́.", "a\x85b　c", " \n\t",
]
ODD_ROWS = [(1, None, 1, "x"), (2, "", None, None), (3, "same text", 1, "x"), (3, "same text", 1, "x"),
            (None, "no id", 1, "x"), (4, "long " * 30_000, 1, "x"), (5, "same text", 1, "x")]


def library_ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(tokens.default_tokenizer())


def test_ids_equal_the_library(spark, sf, tokenizer):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    for text in [*ODD_TEXTS, *texts]:
        assert tokens.document_ids(tokens.default_tokenizer(), text).tolist() == library_ids(tokenizer, text)


def test_first_fit_decreasing():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 300):
        sizes = rng.integers(1, 101, n)
        bins, offsets = packing.first_fit_decreasing(sizes, 100)
        room, expected = [], {}
        for i in sorted(range(n), key=lambda i: (-sizes[i], i)):
            at = next((b for b, free in enumerate(room) if free >= sizes[i]), len(room))
            if at == len(room):
                room.append(100)
            expected[i] = (at, 100 - room[at])
            room[at] -= sizes[i]
        assert expected == {i: (int(bins[i]), int(offsets[i])) for i in range(n)}


def check_packing(rows, texts, tokenizer, capacity):
    """Whole documents in gapless pieces, sequences filled gaplessly; returns the padding."""
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    assert set(pieces) == set(texts)
    for doc, own in pieces.items():
        ids = library_ids(tokenizer, texts[doc])
        at = 0
        for r in sorted(own, key=lambda r: r["start"]):
            assert r["start"] == at and r["doc_tokens"] == len(ids)
            piece = np.array(ids[at:at + r["length"]], "<u4")
            assert r["ids_crc32"] == zlib.crc32(piece.tobytes())
            at += r["length"]
        assert at == len(ids)
    for spans in sequences.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences) * capacity - sum(r["length"] for r in rows)


def test_query(spark, sf, tokenizer):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = queries.op3_packing(spark, sf).collect()
    assert check_packing(rows, texts, tokenizer, 4096) < 2 * 4096


def test_small_groups(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    pieces = packing.token_pieces(docs, capacity=1000, with_ids=True)
    rows = packing.pack(pieces, capacity=1000, group=16, tasks=3).collect()
    check_packing(rows, {r.doc_id: r.text for r in docs.collect()}, tokenizer, 1000)
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_odd_rows(spark):
    docs = spark.createDataFrame(ODD_ROWS, SCHEMA)
    rows = packing.pack_documents(docs).collect()
    assert sum(r.start == 0 for r in rows) == len(ODD_ROWS)
    assert {r.doc_tokens for r in rows if r.doc_id in (1, 2)} == {1}
    assert packing.pack_documents(docs.limit(0)).count() == 0


@pytest.mark.parametrize("size", [1, 2, 3, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(size):
    slots = token_output.feistel(np.arange(size), size, key=9)
    assert sorted(slots.tolist()) == list(range(size))
    assert size < 100 or slots.tolist() != token_output.feistel(np.arange(size), size, key=10).tolist()


def test_shards_hold_every_id(spark, sf, tokenizer):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path, index = token_output.write_shards(docs, seed=4, length=64, shard=50)
    ids = {
        r.slot: np.frombuffer(r.ids, token_output.id_type())
        for r in token_output.read_shards(spark, path, length=64, shard=50).collect()
    }
    assert sorted(ids) == list(range(len(ids)))
    found = collections.defaultdict(dict)
    for r in index.collect():
        assert (r.shard, r.byte_offset) == (r.slot // 50, r.slot % 50 * 128)
        found[r.doc_id][r.start] = ids[r.slot][r.offset:r.offset + r.length].tolist()
    for doc in docs.collect():
        assert sum((found[doc.doc_id][s] for s in sorted(found[doc.doc_id])), []) == library_ids(tokenizer, doc.text)
    some = token_output.read_shards(spark, path, 30, 120, length=64, shard=50).collect()
    assert sorted(r.slot for r in some) == list(range(30, 120))


def test_records_are_read_back_as_written(spark, sf):
    rows = queries.op10_training_order(spark, sf).collect()
    assert rows and all(r.record_crc32 == r.held_crc32 for r in rows)
    assert len({r.slot for r in rows}) == 1 + max(r.slot for r in rows)


def test_each_shard_is_one_file_and_one_task(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    path, index = token_output.write_shards(docs, length=64, shard=50)
    shards = {r.shard for r in index.select("shard").distinct().collect()}
    files = spark.read.format("binaryFile").load(path).select("path").collect()
    assert shards == set(range(len(files))) and len(files) > 8
    assert all("/shard-" in f.path for f in files)


def test_ids_above_sixteen_bits(spark, tmp_path):
    """A tokenizer of 70,000 words: ids keep their value."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    wide = Tokenizer(models.WordLevel({f"ж{i}": i for i in range(70_000)}, unk_token="ж0"))
    wide.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
    file = str(tmp_path / "wide.json")
    wide.save(file)
    assert token_output.id_type(file) == "<u4" and token_output.id_type() == "<u2"
    docs = spark.createDataFrame([(1, "ж69999 ж3")], "doc_id long, text string")
    path, index = token_output.write_shards(docs, length=8, shard=4, tokenizer=file)
    record = token_output.read_shards(spark, path, length=8, shard=4, tokenizer=file).first()
    assert np.frombuffer(record.ids, "<u4").tolist() == [69_999, 3, 2, 0, 0, 0, 0, 0]
    assert [(r.length, r.record_crc32) for r in index.collect()] == [(3, zlib.crc32(record.ids))]


def test_words_survive_the_change_of_generations(monkeypatch):
    monkeypatch.setattr(tokens, "GENERATION_WORDS", 3)
    small, text = tokens.WordEncoder(tokens.default_tokenizer()), "one two, three. four five six two seven, one"
    assert small.encode(text) == tokens.encoder(tokens.default_tokenizer()).encode(text) and len(small) <= 3


def test_shards_of_odd_rows(spark):
    docs = spark.createDataFrame(ODD_ROWS, SCHEMA)
    _, index = token_output.write_shards(docs, length=32, shard=8)
    assert index.where("start = 0").count() == len(ODD_ROWS)
    assert token_output.write_shards(docs.limit(0))[1].count() == 0
