"""Lemmas by rules, exceptions and a lexicon against a plain loop, and tagged tokens in their rows."""

import random

import pytest

from reviewlab.operators import normalization

LEXICON = {
    "n": ["dog", "church", "box", "wolf", "man", "woman", "city", "bus", "child", "glass", "s", "axis"],
    "v": ["be", "go", "make", "stop", "study", "watch", "sing", "use"], "a": ["large", "fast", "good", "nice"], "r": ["well"],
}
EXCEPTIONS = {("children", "n"): ["child"], ("better", "a"): ["good", "well"], ("went", "v"): ["go"], ("mice", "n"): ["mouse"], ("axes", "n"): ["ax", "axis"]}


def plain(word, pos):
    def detached(forms):
        return [f[:len(f) - len(cut)] + put for f in forms for cut, put in normalization.LEMMA_RULES[pos] if f.endswith(cut)]

    def shortest(forms):
        known = [f for f in forms if f in LEXICON[pos]]
        return min(known, key=len) if known else None

    if (word, pos) in EXCEPTIONS:
        return shortest([word, *sorted(EXCEPTIONS[word, pos])])
    forms = detached([word])
    found = shortest([word, *forms])
    while found is None and forms:
        forms = detached(forms)
        found = shortest(forms)
    return found


def tables(spark):
    lemmas = [(w, pos) for pos, words in LEXICON.items() for w in words]
    special = [(*k, f) for k, forms in EXCEPTIONS.items() for f in forms]
    return (spark.createDataFrame(lemmas, "lemma string, pos_class string"),
            spark.createDataFrame(special, "term string, pos_class string, normal_form string"))


def test_equals_plain_loop(spark):
    rng = random.Random(2)
    ends = ["", "s", "es", "ses", "ies", "ves", "men", "ing", "ed", "er", "est", "sing", "eds", "ss"]
    words = {(w[:len(w) - rng.randint(0, 1)] + rng.choice(ends) + rng.choice(ends), pos) for _ in range(900) for pos in "nvar" for w in [rng.choice(LEXICON[pos])]}
    words |= set(EXCEPTIONS) | {("dogs", "n"), ("churches", "n"), ("women", "n"), ("making", "v"), ("nicest", "a"), ("better", "a"), ("", "n"), ("dogs", "x")}
    lemmas, special = tables(spark)
    rows = spark.createDataFrame([*words, *words, (None, "n"), ("dog", None)], "term string, pos_class string")
    found = {(r.term, r.pos_class): r.normal_form for r in normalization.lemma_terms(rows, lemmas, special).collect()}
    assert found == {(w, p): f for w, p in words if p != "x" and (f := plain(w, p)) is not None}
    assert found["women", "n"] == "woman" and found["making", "v"] == "make" and ("mice", "n") not in found
    without = {(r.term, r.pos_class): r.normal_form for r in normalization.lemma_terms(rows, lemmas).collect()}
    assert without["axes", "n"] != found["axes", "n"] if ("axes", "n") in without else True


def test_empty_tables(spark):
    lemmas, special = tables(spark)
    none = spark.createDataFrame([], "term string, pos_class string")
    assert normalization.lemma_terms(none, lemmas, special).count() == 0
    assert normalization.lemma_terms(spark.createDataFrame([("dogs", "n")], "term string, pos_class string"), lemmas.limit(0)).count() == 0


def test_tagged_tokens_stay_in_their_rows(spark):
    schema = "doc_id long, words array<string>, pos array<string>, other int"
    rows = [(1, ["Dogs", "went", "fast", "Dogs"], ["NNS", "VBD", "RB", "VB"], 7), (2, [], [], 8), (None, ["x"], ["NN"], 9)]
    mapping = spark.createDataFrame([("dogs", "n", "dog"), ("went", "v", "go"), ("fast", "a", "no")], "term string, pos_class string, normal_form string")
    found = normalization.normalize_tagged(spark.createDataFrame(rows, schema), mapping, "words", "pos").collect()
    assert sorted((r.other, list(r.words)) for r in found) == [(7, ["dog", "go", "fast", "Dogs"]), (8, []), (9, ["x"])]
    assert found[0].asDict().keys() == {"doc_id", "words", "pos", "other"}


def test_lemmas_and_exceptions_are_read_once_whatever_the_rounds(spark):
    def counted(frame, counter):
        def of_batches(batches):
            for batch in batches:
                counter.add(batch.num_rows)
                yield batch

        return frame.mapInArrow(of_batches, frame.schema)

    seen = [spark.sparkContext.accumulator(0) for _ in range(2)]
    words = spark.createDataFrame([("runs", "n"), ("oxen", "n"), ("glassess", "n")], "term string, pos_class string")
    lemmas = counted(spark.createDataFrame([("run", "n"), ("glass", "n"), ("ox", "n")], "lemma string, pos_class string"), seen[0])
    exceptions = counted(spark.createDataFrame([("oxen", "n", "ox")], "term string, pos_class string, normal_form string"), seen[1])
    found = {r.term: r.normal_form for r in normalization.lemma_terms(words, lemmas, exceptions).collect()}
    assert found["runs"] == "run" and found["oxen"] == "ox"
    assert [s.value for s in seen] == [3, 1]


def test_words_found_in_parts_of_a_map_and_salts_by_the_rows_of_a_key(spark, monkeypatch):
    """Long and repeated rows get the same stems and opinion words by a salted join; its rows are not counted for it."""
    from reviewlab.operators import features, lookup, normalization

    words = [f"runn{chr(97 + i % 26)}{chr(97 + i // 26)}ings" for i in range(400)]
    rows = [(1, " ".join(words)), (1, " ".join(words)), (2, None), (3, "Nothing here"), (None, "relational cats"), (4, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    lexicon = spark.createDataFrame([(w, (i % 7) - 3.0) for i, w in enumerate(words)], "term string, valence double")
    monkeypatch.setattr(features, "INLINE_WORD_LIMIT", 10)
    stems = sorted(map(str, normalization.stem_texts(df).collect()))
    opinions = sorted(map(str, features.opinion_words(df, lexicon).collect()))
    monkeypatch.setattr(lookup, "is_small", lambda *_: False)
    monkeypatch.setattr(lookup, "salts_for", lambda rows: pytest.fail("the rows were counted"))
    assert sorted(map(str, normalization.stem_texts(df).collect())) == stems
    assert sorted(map(str, features.opinion_words(df, lexicon).collect())) == opinions
    positive = sum((i % 7) > 3 for i in range(400))
    assert sum(f"positive_word_count={positive}" in r for r in opinions) == 2
    assert any("text='relat cat'" in r for r in stems) or any("relational cats" in r for r in stems)
