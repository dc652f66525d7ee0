"""Learnt abbreviations and sentence ends against the published scores computed in plain Python."""

import math
import random
import re
from collections import Counter

from reviewlab.operators import sentence_ends

NAMES = ["Smith", "Jones", "Miller", "Brown"]
WORDS = "game board rules player turn card dice table win lose play long short night friends evening again quickly".split()


def corpus(n=400):
    """Texts with planted abbreviations, and their true sentences."""
    rng = random.Random(6)
    docs = []
    for _ in range(n):
        out = []
        for _ in range(rng.randint(1, 5)):
            words = [rng.choice(["The", "It", "We", "This"])] + rng.choices(WORDS, k=rng.randint(3, 9))
            for special in ("Dr.", "e.g.", "etc."):
                if rng.random() < 0.25:
                    at = rng.randint(1, len(words) - 1)
                    words[at:at] = [special, rng.choice(NAMES)] if special == "Dr." else [special]
            if words[-1].endswith("."):
                words.append("here")
            out.append(" ".join(words) + rng.choice([".", ".", "!", "?"]))
        docs.append(out)
    return docs


def plain_scores(texts):
    words = [w for t in texts for w in t.split()]
    kind = lambda w: re.sub(r"^[-+]?[0-9][0-9.,]*$", "##number##", re.sub(r"\.$", "", w).lower())
    closed, total = Counter(kind(w) for w in words if w.endswith(".")), Counter(map(kind, words))
    p = sum(closed.values()) / len(words)
    ll = lambda k, n, q: k * math.log(q) + (n - k) * math.log(1 - q)
    out = {}
    for t, k in closed.items():
        if re.search(r"[^\W\d_]", t) and t != "##number##":
            n, inner = total[t], t.count(".")
            size = len(t) - inner + 1
            score = 2 * (ll(k, n, 0.99) - ll(k, n, p)) * math.exp(-size) * (inner + 1) * size ** -(n - k)
            if score >= 0.3:
                out[t] = score
    return out


def frame(spark, docs):
    return spark.createDataFrame([(i, " ".join(d)) for i, d in enumerate(docs)], "doc_id long, text string")


def test_scores_equal_the_published_formula(spark):
    docs = corpus()
    found = {r.type: r.score for r in sentence_ends.abbreviations(frame(spark, docs)).collect()}
    expected = plain_scores([" ".join(d) for d in docs])
    assert found.keys() == expected.keys() and {"dr", "e.g", "etc"} <= found.keys()
    assert all(abs(found[t] - expected[t]) < 1e-9 * max(1, expected[t]) for t in found)


def test_planted_abbreviations_do_not_end_sentences(spark):
    docs = corpus()
    df = frame(spark, docs)
    known = sentence_ends.abbreviations(df)
    first = sentence_ends.starters(df, known)
    assert {"the", "it", "we", "this"} <= {r.word for r in first.collect()}
    found = {r.doc_id: r.sentences for r in sentence_ends.split_sentences(df, known, first).collect()}
    right = sum(found[i] == d for i, d in enumerate(docs))
    by_marks = sum(re.split(r"(?<=[.!?])\s+", " ".join(d)) == d for d in docs)
    assert right / len(docs) > 0.97 > 0.6 > by_marks / len(docs)


def test_odd_rows(spark):
    rows = [(1, None, 7), (2, "", 7), (3, "Dr. A. Smith came.\n\nIt rained.  12. May", 7), (3, "Dr. A. Smith came.\n\nIt rained.  12. May", 7),
            (None, "one. " * 3000 + "dr. The end", 7), (5, "no end", 7), (6, " . ! ", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _first int")
    known = spark.createDataFrame([("dr",)], "type string")
    first = spark.createDataFrame([("the",)], "word string")
    found = sentence_ends.split_sentences(df.withColumnRenamed("_first", "other"), known, first)
    assert found.columns == ["doc_id", "text", "other", "sentences"] and found.count() == len(rows)
    by = {r.doc_id: r.sentences for r in found.collect()}
    assert by[1] == by[2] == [] and by[5] == ["no end"]
    assert by[3] == ["Dr. A. Smith came.", "It rained.", "12. May"]
    assert len(by[None]) == 3002 and by[None][-2:] == ["dr.", "The end"]
    assert sentence_ends.abbreviations(df.limit(0)).count() == 0
    assert sentence_ends.split_sentences(df.limit(0), known).count() == 0


def test_long_tables_of_abbreviations_are_joined(spark, monkeypatch):
    """A short table is searched in the row, a longer one joined: both cut alike, also where ids repeat or are null."""
    texts = ["See Fig. 3 there. It is 5. dice of A. Smith", "Fig. a  ", " no. No. x 1.5. y", "", None, "ends.\nnext! so? ."]
    rows = [(i // 2 if i else None, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    known = spark.createDataFrame([("fig", 1.0), ("no", 2.0), ("no", 3.0), (None, 1.0)], "type string, score double")
    short = [r["sentences"] for r in sentence_ends.split_sentences(df, known).orderBy("doc_id", "text").collect()]
    monkeypatch.setattr(sentence_ends, "row_lookup", lambda *_: None)
    joined = [r["sentences"] for r in sentence_ends.split_sentences(df, known).orderBy("doc_id", "text").collect()]
    assert short == joined
    assert ["See Fig. 3 there.", "It is 5. dice of A. Smith"] in short and ["ends.", "next!", "so?", "."] in short


def test_split_moves_no_texts_for_a_short_table(spark):
    df = spark.createDataFrame([(1, "See Fig. 3 there. Yes")], "doc_id bigint, text string")
    known = spark.createDataFrame([("fig", 1.0)], "type string, score double")
    found = sentence_ends.split_sentences(df, known)
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
