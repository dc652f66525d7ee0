"""Annotations, lexicon features and their plans on small, hand-checked texts."""

import pytest
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.operators import annotations, features, normalization


@pytest.fixture(scope="module")
def reviews(spark):
    rows = [
        (1, "This is not good. Very fun game, fairly complex!", 7.5, "positive"),
        (2, "Awful dice. I don't recommend it", 3.0, "negative"),
        (3, "   ", 5.0, None),
    ]
    return spark.createDataFrame(rows, "doc_id bigint, text string, rating double, label string")


def by_id(frame):
    return {r["doc_id"]: r for r in frame.collect()}


@pytest.mark.parametrize("annotated", [False, True])
def test_all_features(spark, reviews, annotated):
    notes = annotations.annotate_by_rules(reviews) if annotated else None
    table = features.linguistic_features(reviews, features.basic_lexicon(spark), annotations=notes)
    assert table.columns == ["doc_id", "label", *fv.FEATURE_COLUMNS]
    rows = by_id(table)
    first, second, blank = rows[1], rows[2], rows[3]
    assert (first["positive_word_count"], first["negative_word_count"]) == (2, 0)
    assert (first["negation_count"], first["negated_opinion_words"], first["has_negation"]) == (1, 1, True)
    assert (first["intensifier_count"], first["mitigator_count"]) == (1, 1)
    assert first["has_intensifier"] and first["has_mitigator"]
    assert (first["sentence_count"], first["token_count"]) == (2, 12)
    assert first["avg_sentence_length"] == 6.0
    assert first["opinion_word_ratio"] == pytest.approx(2 / 12)
    assert first["vader_compound"] == pytest.approx(2 / (4 + 15) ** 0.5)
    assert (second["positive_word_count"], second["negative_word_count"]) == (1, 1)
    assert second["negated_opinion_words"] == 1 and second["vader_compound"] == 0.0
    assert second["domain_word_count"] == 1 and second["domain_opinion_overlap"]
    assert second["rating"] == 3.0
    zeros = [c for c in fv.FEATURE_COLUMNS if c not in ("rating", "text_length", "sentence_count")]
    assert all(not blank[c] for c in zeros) and blank["label"] is None


def test_rating_can_be_left_out(spark, reviews):
    table = features.linguistic_features(reviews, features.basic_lexicon(spark), include_rating=False)
    assert "rating" not in table.columns and len(table.columns) == 24


def test_large_lexicon_takes_the_other_way(spark, reviews, monkeypatch):
    lexicon = features.basic_lexicon(spark)
    listed = features.linguistic_features(reviews, lexicon)
    monkeypatch.setattr(features, "INLINE_WORD_LIMIT", 3)
    unlisted = features.linguistic_features(reviews, lexicon)
    assert listed.exceptAll(unlisted).isEmpty() and unlisted.exceptAll(listed).isEmpty()


def test_repeated_lexicon_terms_do_not_multiply_counts(spark, reviews):
    lexicon = features.basic_lexicon(spark)
    twice = features.opinion_words(reviews, lexicon.unionByName(lexicon))
    assert twice.exceptAll(features.opinion_words(reviews, lexicon)).isEmpty()


def test_no_lexicon_gives_zero_scores(reviews):
    assert features.valence_scores(reviews, None).where("vader_compound <> 0 OR vader_neutral <> 0").isEmpty()


def test_listed_lexicon_needs_no_shuffle(spark, reviews):
    lexicon = features.basic_lexicon(spark)
    tables = [
        features.opinion_words(reviews, lexicon), features.domain_vocabulary(reviews, lexicon),
        features.valence_scores(reviews, lexicon), features.linguistic_features(reviews, lexicon),
    ]
    for table in tables:
        plan = table._jdf.queryExecution().executedPlan().toString()
        assert not any(node in plan for node in ("Exchange", "Python", "Aggregate", "Join")), plan


@pytest.mark.parametrize("limit", [20_000, 3])
def test_drawn_copies_keep_their_own_rows(spark, reviews, monkeypatch, limit):
    monkeypatch.setattr(features, "INLINE_WORD_LIMIT", limit)
    lexicon = features.basic_lexicon(spark)
    drawn = reviews.crossJoin(spark.range(3).withColumnRenamed("id", "draw"))
    once = features.linguistic_features(reviews, lexicon)
    copies = features.linguistic_features(drawn, lexicon)
    assert copies.count() == 3 * once.count()
    assert copies.drop("draw").distinct().exceptAll(once).isEmpty()


def test_degree_phrases_never_match_one_token(spark):
    frame = spark.createDataFrame([(1, "sort of nice, quite nice")], "doc_id bigint, text string")
    row = features.intensifiers(annotations.annotate_by_rules(frame)).first()
    assert (row["intensifier_count"], row["mitigator_count"]) == (0, 1)


def parsed(spark):
    rows = [
        (1, 0, 0, "The", "DT", "det", 2, None), (1, 0, 1, "old", "JJ", "amod", 2, None),
        (1, 0, 2, "dice", "NNS", "nsubj", 3, None), (1, 0, 3, "are", "VBP", "ROOT", -1, None),
        (1, 0, 4, "not", "RB", "neg", 5, None), (1, 0, 5, "fun", "NN", "attr", 3, None),
        (1, 1, 0, "no", "DT", "neg", 9, None),
    ]
    return spark.createDataFrame(
        rows, "doc_id bigint, sentence_idx int, token_idx int, token string, pos string, "
        "dep_label string, head_idx int, head string",
    )


def test_parser_output(spark):
    notes = annotations.fill_heads(parsed(spark))
    row = features.negations(notes, features.basic_lexicon(spark)).first()
    # a head outside the sentence counts as a negation, but hits nothing
    assert (row["negation_count"], row["negated_opinion_words"]) == (2, 1)
    stored = annotations.dependency_table(parsed(spark)).where("head <> ''")
    assert stored.isEmpty()


def test_noun_phrases(spark):
    phrases = annotations.noun_phrases(parsed(spark)).orderBy("phrase_idx").collect()
    assert [r["phrase"] for r in phrases] == ["The old dice", "fun"]


def test_long_runs_of_nouns(spark):
    text = " ".join(["noun"] * 20_000)
    frame = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    notes = annotations.annotate_by_rules(frame, pos_of=lambda t: F.lit("NN"))
    assert annotations.noun_phrases(notes).first()["phrase"] == text


def test_normal_forms(spark):
    frame = spark.createDataFrame([(1, "Dice were good", "x"), (2, "", "y")], "doc_id bigint, text string, other string")
    forms = spark.createDataFrame([("dice", "die"), ("dice", "dye"), ("were", "be")], "term string, normal_form string")
    rows = by_id(normalization.normalize_terms(frame, forms))
    assert rows[1]["text"] == "die be good" and rows[2]["text"] == "" and rows[1]["other"] == "x"
    tags = spark.createDataFrame([("JJR",), ("VB",), ("NNS",), ("RB",), ("IN",)], "t string")
    classes = [r[0] for r in tags.select(normalization.pos_class(F.col("t"))).collect()]
    assert classes == ["a", "v", "n", "r", "n"]
