"""Alignment of two tokenizers against sets of token ends in plain Python."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from reviewlab.llm import token_alignment

ODD = [
    None, "", " ", "a", "two  blanks", "line\nbreak\ttab \n", "<|endoftext|> <s> </s> <unk> <0x41>", "piece ▁ mark", "naïve café ñandú",
    "漢字かな交じり文", "😀 emoji 👩‍👩‍👧 end", " no break", "don't we'll it's", "1234567 3.14", "x" * 3000, "\x00nul", "é å",
    "wort " * 40_000, "ohne blank, " * 3 + "ü" * 70_000 + " dann weiter " * 9000, " führt", "<0x0A>", "a\r\nb",
]


@pytest.fixture(scope="module")
def aligner():
    return token_alignment.Aligner(*token_alignment.default_files())


def tokens(aligner, text):
    """Ids of both tokenizers of the uncut text, or none."""
    if not text:
        return [], []
    a = aligner.a.encode(" " + text, add_special_tokens=False).ids
    b = aligner.b.encode(text)
    wanted = (" " + text).encode()
    if b"".join(aligner.a_bytes[i] for i in a) != wanted or b"".join(aligner.b_bytes[i] for i in b) != wanted:
        return [], []
    return a, b


def groups(aligner, a, b):
    """Lists of (A ids, B ids) cut at every offset at which tokens of both end."""
    ends_a = np.cumsum([len(aligner.a_bytes[i]) for i in a]).tolist()
    ends_b = np.cumsum([len(aligner.b_bytes[i]) for i in b]).tolist()
    common = sorted(set(ends_a) & set(ends_b))
    found, x, y = [], 0, 0
    for end in common:
        p, q = ends_a.index(end, x) + 1, ends_b.index(end, y) + 1
        found.append((a[x:p], b[y:q]))
        x, y = p, q
    assert (x, y) == (len(a), len(b))
    return found


def expected_rows(aligner, rows):
    parts = [groups(aligner, *tokens(aligner, text)) for _, text in rows]
    links = [[(a[-1], b[-1]) for a, b in part] for part in parts]
    total = Counter(pair for own in links for pair in own)
    best = {}
    for (_, b), n in total.items():
        best[b] = max(best.get(b, 0), n)
    found = []
    for (key, _), part, own in zip(rows, parts, links):
        spelled = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in part)
        found.append((
            key, sum(len(a) for a, _ in part), sum(len(b) for _, b in part), len(part), len(own),
            sum(total[p] == best[p[1]] for p in own), sum(total[p] for p in own),
            hashlib.sha256(spelled.encode()).hexdigest() if part else "",
        ))
    return sorted(found, key=repr)


@pytest.mark.parametrize("hot_pairs", [500_000, 40, 0])
def test_equals_brute_force(spark, sf, aligner, hot_pairs):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = token_alignment.align_tokenizers(docs, hot_pairs=hot_pairs)
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(map(tuple, found.collect()), key=repr) == expected_rows(aligner, rows)


def test_odd_rows(spark, aligner):
    rows = [*enumerate(ODD), (None, "a null key"), (3, ODD[3]), (3, ODD[3]), (None, None)]
    schema = "doc_id long, text string, pairs string, _row string, n_a string, total int, _key int"
    docs = spark.createDataFrame([(*r, "x", "y", "z", 1, 2) for r in rows], schema)
    for hot_pairs in (500_000, 20):
        found = token_alignment.align_tokenizers(docs, hot_pairs=hot_pairs).collect()
        assert sorted(map(tuple, found), key=repr) == expected_rows(aligner, rows)
    by = {r.doc_id: r for r in found}
    assert by[0].n_a == by[1].n_a == by[7].n_a == 0 and by[7].groups_sha256 == ""
    assert by[2].n_a > 0 and by[17].n_a > 40_000
    assert token_alignment.align_tokenizers(docs.limit(0)).count() == 0


@settings(max_examples=60, deadline=None)
@given(text=st.text(alphabet=st.sampled_from("ab é  \n'1.漢😀x"), max_size=120), size=st.integers(1, 30))
def test_segments_give_the_tokens_of_the_whole(aligner, text, size):
    parts = list(token_alignment.segments(text, size))
    assert " ".join(parts) == text
    a, b = aligner.encode(parts)
    assert sum(a, []) == aligner.a.encode(" " + text, add_special_tokens=False).ids
    assert sum(b, []) == aligner.b.encode(text) or not text


@settings(max_examples=300, deadline=None)
@given(st.one_of(
    st.text(alphabet=st.characters(max_codepoint=0x17F), max_size=60),
    st.text(alphabet=st.sampled_from("aZé0 \n\t'.,-#\x85\xa0²¼ªſŉ—…€‘’”"), max_size=60),
    st.lists(st.sampled_from([" word", "'s", "'LL", "<|endoftext|>", " 12", "  ", "\n\n", "étude", "x" * 40]), max_size=20).map("".join),
))
def test_ranks_give_the_tokens_of_the_file(aligner, text):
    assert token_alignment._SETTLED.fullmatch(text)
    assert aligner.encode([text])[0][0] == aligner._encode_any(text)


def test_ranks_give_the_tokens_of_the_given_texts(aligner, spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect() if r.text]
    assert aligner.encode(texts)[0] == [aligner._encode_any(t) for t in texts]
    assert sum(token_alignment._SETTLED.fullmatch(t) is not None for t in texts) > len(texts) // 2


@settings(max_examples=80, deadline=None)
@given(st.data())
def test_pointer_jumping_equals_common_ends(data):
    size = data.draw(st.integers(1, 60))
    cuts = [sorted({*data.draw(st.lists(st.integers(1, size))), size}) for _ in range(2)]
    of_a, of_b, last = token_alignment.common_groups(*(np.array(c) for c in cuts))
    common = sorted(set(cuts[0]) & set(cuts[1]))
    for ends, groups_ in zip(cuts, (of_a, of_b)):
        assert groups_.tolist() == [sum(c < end for c in common) for end in ends]
    assert [cuts[0][i] for i in last] == common
