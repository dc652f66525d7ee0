"""Word-order rules of valence against a plain reading of the published rules, one word at a time."""

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.operators import features

LEXICON = {
    "good": 1.9, "great": 3.1, "bad": -2.5, "terrible": -2.1, "smart": 1.7, "funny": 1.9, "happy": 2.7, "no": -1.2, "ass": -2.5,
    "shit": -2.6, "best": 3.2, "kind": 2.4, "death": -2.9, ":)": 2.0, "most": 0.5,
}
MARKS = [".", "!", "?", ",", ";", ":", "-", "'", '"', "!!", "!!!", "??", "???", "?!?", "!?!", "?!?!", "!?!?"]


def words_of(text):
    bare = {w for w in re.sub(f"[{re.escape(string.punctuation)}]", "", text).split() if len(w) > 1}
    marked = {m + w: w for m in MARKS for w in bare} | {w + m: w for m in MARKS for w in bare}
    return [marked.get(w, w) for w in text.split() if len(w) > 1]


def plain(text):
    words = words_of(text)
    lows = [w.lower() for w in words]
    boost = {**{w: 0.293 for w in fv.BOOSTERS}, **{w: -0.293 for w in fv.DAMPENERS + fv.DAMPENER_PAIRS}}
    n_caps = sum(w.isupper() for w in words)
    mixed = 0 < n_caps < len(words)
    negated = lambda w: w.lower() in fv.VALENCE_NEGATIONS or "n't" in w.lower()
    sentiments = []
    for i, w in enumerate(words):
        if lows[i] in boost or (lows[i] == "kind" and lows[i + 1:i + 2] == ["of"]) or lows[i] not in LEXICON:
            sentiments.append(0.0)
            continue
        v = LEXICON[lows[i]]
        if w.isupper() and mixed:
            v += 0.733 if v > 0 else -0.733
        for k in range(3):
            if i <= k or lows[i - k - 1] in LEXICON:
                continue
            other = words[i - k - 1]
            s = 0.0
            if other.lower() in boost:
                s = boost[other.lower()] * (-1 if v < 0 else 1)
                if other.isupper() and mixed:
                    s += 0.733 if v > 0 else -0.733
            v += s * (1, 0.95, 0.9)[k]
            if k == 0:
                v *= -0.74 if negated(other) else 1
            elif k == 1:
                v *= 1.5 if words[i - 2] == "never" and words[i - 1] in ("so", "this") else -0.74 if negated(other) else 1
            else:
                strong = words[i - 3] == "never" and words[i - 2] in ("so", "this") or words[i - 1] in ("so", "this")
                v *= 1.25 if strong else -0.74 if negated(other) else 1
                for a, b in ((i - 1, i + 1), (i - 2, i + 1), (i - 2, i), (i - 3, i), (i - 3, i - 1)):
                    if " ".join(words[a:b]) in fv.VALENCE_IDIOMS:
                        v = fv.VALENCE_IDIOMS[" ".join(words[a:b])]
                        break
                for ahead in (2, 3):
                    if i + ahead <= len(words) and " ".join(words[i:i + ahead]) in fv.VALENCE_IDIOMS:
                        v = fv.VALENCE_IDIOMS[" ".join(words[i:i + ahead])]
                if " ".join(words[i - 3:i - 1]) in boost or " ".join(words[i - 2:i]) in boost:
                    v -= 0.293
        if i > 0 and lows[i - 1] == "least" and not (i > 1 and lows[i - 2] in ("at", "very")):
            v *= -0.74
        sentiments.append(v)
    if "but" in lows:
        at = lows.index("but")
        sentiments = [v * (0.5 if i < at else 1.5 if i > at else 1) for i, v in enumerate(sentiments)]
    if not sentiments:
        return 0.0, 0.0, 0.0, 0.0
    asked = text.count("?")
    loud = min(text.count("!"), 4) * 0.292 + (0 if asked < 2 else asked * 0.18 if asked <= 3 else 0.96)
    total = sum(sentiments)
    total += loud * ((total > 0) - (total < 0))
    up, down = sum(v + 1 for v in sentiments if v > 0), sum(1 - v for v in sentiments if v < 0)
    if up > down:
        up += loud
    elif up < down:
        down += loud
    flat = sum(v == 0 for v in sentiments)
    whole = up + down + flat
    return total / (total * total + 15) ** 0.5, up / whole, down / whole, flat / whole


KNOWN = [  # published examples of the scorer
    ("VADER is smart, handsome, and funny.", None), ("", None), ("good but terrible", None), ("The book was kind of good.", None),
    ("At least it isn't a bad book.", None), ("never so good", None), ("never this GREAT!!", None), ("a bad ass car", None),
]


def scored(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lexicon = spark.createDataFrame(list(LEXICON.items()), "term string, valence double")
    rows = features.rule_valence_scores(df, lexicon).collect()
    return {r.doc_id: (r.vader_compound, r.vader_positive, r.vader_negative, r.vader_neutral) for r in rows}


def test_equals_plain_reading(spark):
    rng = random.Random(5)
    bits = [*LEXICON, "GOOD", "Bad", "VERY", "very", "slightly", "kind", "of", "sort", "not", "isn't", "never", "so", "this", "but", "BUT",
            "least", "at", "just", "enough", "book", "THE", "the", "kiss", "cut", "mustard", "yeah", "right", "good!", "'bad'", "(great)", "a"]
    texts = [t for t, _ in KNOWN] + [
        " ".join(rng.choices(bits, k=rng.randint(1, 9))) + rng.choice(["", "", "!", "??", "!!!!!", "????", "\n", " ..."]) for _ in range(1500)
    ]
    found = scored(spark, texts)
    for i, text in enumerate(texts):
        assert found[i] == pytest.approx(plain(text), abs=6e-4), text
        assert found[i][0] == pytest.approx(plain(text)[0], abs=6e-5), text


def test_published_directions(spark):
    texts = ["the book was good", "the book was very good", "the book was VERY good", "the book was not good", "the book was good!!!",
             "the book was kind of good", "the book was good but terrible", "the book was GOOD"]
    compound = [scored(spark, texts)[i][0] for i in range(len(texts))]
    assert compound[0] == 0.4404 and compound[1] == 0.4927 and compound[3] == -0.3412
    assert compound[2] > compound[1] > compound[0] > compound[5] > 0 > compound[6]
    assert compound[4] > compound[0] and compound[7] > compound[0]


def test_odd_rows(spark):
    found = scored(spark, [None, "", " \n ", "word " * 20_000 + "good", "a b c"])
    assert found[0] == found[1] == found[2] == found[4] == (0.0, 0.0, 0.0, 0.0)
    assert found[3][0] == 0.4404


def test_words_of_a_text_are_computed_once(spark):
    from reviewlab.functions.valence import rule_scores, rule_words

    text = F.col("text")
    own = F.create_map(F.lit("good"), F.lit(1.5))
    scored = spark.createDataFrame([("Good day!",)], "text string").select(rule_scores(text, rule_words(text), own).alias("s"))
    assert scored._jdf.queryExecution().analyzed().toString().lower().count("regexp_replace(") == 2
