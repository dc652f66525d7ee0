"""Edge rows of cleaning, tokens and n-grams."""

import pytest
from pyspark.sql import functions as F

from reviewlab.functions import cleaning, fixed_values as fv, text
from reviewlab.plans.cleaning_plan import CleaningPlan


def value(spark, make, given):
    frame = spark.createDataFrame([(given,)], "t string")
    return frame.select(make(F.col("t")).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "step, given, expected",
    [
        (cleaning.remove_html, "a<br/>b", "ab"),
        (cleaning.remove_html, "1 < 2 & <b >x</b>", "1 x"),
        (cleaning.remove_urls, "see https://a.b/c?d=1#frag and HTTP://X.y", "see #frag and HTTP://X.y"),
        (cleaning.expand_contractions, "DON'T", "DO not"),
        (cleaning.expand_contractions, "Can't", "Cannot"),
        (cleaning.expand_contractions, "WON'T stop", "Will not stop"),
        (cleaning.expand_contractions, "let's go", "let us go"),
        (cleaning.expand_contractions, "he's", "he is"),
        (cleaning.expand_contractions, "'more'", " amore'"),
        (cleaning.expand_contractions, "they've we'll I'd you're", "they have we will I would you are"),
        (cleaning.remove_stopwords, "this is not the best", "not best"),
        (cleaning.collapse_whitespace, "  a  b \n", "a b"),
        (cleaning.strip, "  \ta b \n", "a b"),
        (cleaning.strip, "", ""),
        (cleaning.remove_numbers, "7 wonders 2٣x", " wonders x"),
        (cleaning.remove_punctuation, "a-b, (c)!", "ab c"),
        (cleaning.separate_punctuation, "a,b", "a , b"),
        (cleaning.lowercase, "ÜNÏ", "ünï"),
        (text.strip_accents, "Ünï café ﬁ", "Uni cafe fi"),
    ],
)
def test_cleaning_edges(spark, step, given, expected):
    assert value(spark, step, given) == expected


def test_options(spark):
    assert value(spark, lambda t: cleaning.remove_numbers(t, "$1"), "a 12") == "a $1"
    assert value(spark, lambda t: cleaning.remove_punctuation(t, keep="-"), "a-b!") == "a-b"
    assert value(spark, lambda t: cleaning.remove_stopwords(t, custom=["game"]), "the game not fun") == "not fun"


def test_negation_words_stay(spark):
    assert not cleaning.stopwords() & set(fv.KEPT_STOPWORDS)


@pytest.mark.parametrize(
    "make, given, expected",
    [
        (text.tokens, "don't it's 7-card", ["do", "n't", "it", "'s", "7", "-", "card"]),
        (text.tokens, "   ", []),
        (text.tokens, "Ünï_1, ok.", ["Ünï_1", ",", "ok", "."]),
        (text.sentences, "One. Two!  Three? four", ["One.", "Two!", "Three?", "four"]),
        (text.sentences, "", []),
        (text.sentences, "v1.2 is out.", ["v1.2 is out."]),
        (text.words, "Ünï café_1", ["uni", "cafe_1"]),
        (text.sentence_tokens, "A b. C", [["A", "b", "."], ["C"]]),
        (lambda t: text.ngrams(text.words(t), 3), "one", []),
        (lambda t: text.ngrams(text.words(t), 3), "a b c d", ["a b c", "b c d"]),
        (lambda t: text.ngrams(text.words(t), 2), "", []),
        (lambda t: text.ngram_range(text.words(t), 1, 2), "a b", ["a", "b", "a b"]),
    ],
)
def test_tokens(spark, make, given, expected):
    assert value(spark, make, given) == expected


def test_plan_edits():
    plan = CleaningPlan(("lowercase",))
    longer = plan.add_step("remove_html", 0).add_step("remove_numbers")
    assert longer.steps == ("remove_html", "lowercase", "remove_numbers")
    assert longer.remove_step("lowercase").steps == ("remove_html", "remove_numbers")
    assert longer.remove_step("stem").steps == longer.steps
    assert plan.steps == ("lowercase",)
    assert CleaningPlan().steps == tuple(fv.DEFAULT_STEPS)
    with pytest.raises(ValueError, match="Unknown preprocessing step"):
        CleaningPlan(("spin",))
    with pytest.raises(ValueError, match="Unknown preprocessing step"):
        plan.add_step("spin")


def test_plan_with_tables(spark):
    frame = spark.createDataFrame([(1, "The <b>Cards</b> were GOOD 7 http://x.y"), (2, "")], "doc_id int, text string")
    stems = spark.createDataFrame([("cards", "card"), ("were", "be")], "term string, normal_form string")
    plan = CleaningPlan(forms={"stem": stems})
    rows = {r["doc_id"]: r["text"] for r in plan.apply(frame).collect()}
    assert rows == {1: "card good", 2: ""}


def test_cleaning_is_one_projection_without_python(spark, sf):
    frame = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    steps = [s for s in fv.DEFAULT_STEPS if s not in ("stem", "lemmatize_simple")]
    plan = CleaningPlan(steps).apply(frame)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
