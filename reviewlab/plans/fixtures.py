"""Views that give the test tables the shape of rated reviews.

The synthetic prose has hardly any English opinion words, so the word lists here are made of words
that do occur in it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.functions import fixed_values as fv
from reviewlab.functions.text import tokens
from reviewlab.operators.annotations import annotate_by_rules, document_annotations
from reviewlab.operators.corpus import load_filter, with_label
from reviewlab.sources.reviews import spread_small_input

LEXICON = [("the", 1.5), ("best", 3.0), ("and", 0.5), ("no", -1.25), ("of", -0.5), ("de", -0.75)]
DOMAIN = ["is", "to", "est"]
CUES, STRONG, WEAK = ["no"], ["and"], ["or"]
DETERMINERS = ["the", "le", "la", "der", "el"]

RATING_SQL = (
    "CASE WHEN doc_id % 97 = 3 THEN NULL WHEN doc_id % 50 = 7 THEN CAST(4.995 AS DOUBLE) "
    "ELSE CAST((doc_id * 7919) % 1001 AS DOUBLE) / CAST(100 AS DOUBLE) END"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents for work that costs much per row."""
    return spread_small_input(table(spark, sf_dir, "documents"), "doc_id")


def reviews_of(documents: DataFrame) -> DataFrame:
    return documents.select(
        F.col("doc_id").alias("row_id"), F.col("source").alias("game_id"),
        F.col("lang").alias("user"), "text", F.expr(RATING_SQL).alias("rating"),
    )


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reviews_of(table(spark, sf_dir, "documents"))


def corpus(spark: SparkSession, sf_dir: str, spread: bool = False) -> DataFrame:
    """Loaded and labelled documents; the row id serves as document id."""
    return labelled(reviews_of(texts(spark, sf_dir) if spread else table(spark, sf_dir, "documents")))


def labelled(reviews: DataFrame) -> DataFrame:
    kept = with_label(load_filter(reviews), fv.THREE_CLASS_BANDS)
    return kept.withColumnRenamed("row_id", "doc_id")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("row_id"), F.col("event_type").alias("game_id"),
        F.col("user_id").cast("string").alias("user"), "ts",
        (F.expr("CAST(event_id % 21 AS DOUBLE)") / F.lit(2.0)).alias("rating"),
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    doc = F.col("doc_id")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(doc % 5 == 0, "test").when(doc % 5 == 1, "validation").otherwise("train").alias("set"),
        _third(doc).alias("label"),
        _third(doc + F.when(doc % 7 == 0, 1).otherwise(0)).alias("prediction"),
    )


def _third(number: Column) -> Column:
    return F.when(number % 3 == 0, "negative").when(number % 3 == 1, "neutral").otherwise("positive")


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "term string, valence double")


def derived_lexicon(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A lexicon as large as the vocabulary of the documents."""
    words = texts(spark, sf_dir).select(F.explode(tokens(F.lower("text"))).alias("term")).distinct()
    return words.select("term", (F.length("term") % 3 - 1).cast("double").alias("valence"))


def normal_forms(spark: SparkSession, sf_dir: str, by_class: bool = False) -> DataFrame:
    """Words of the benchmark texts, cut by two characters (four for adjectives)."""
    words = (
        table(spark, sf_dir, "benchmark").select(F.explode(tokens(F.lower("text"))).alias("term"))
        .distinct().where(F.length("term") >= 5)
    )
    cut = words.select("term", F.expr("left(term, length(term) - 2)").alias("normal_form"))
    if not by_class:
        return cut
    nouns = cut.select("term", F.lit("n").alias("pos_class"), "normal_form")
    adjectives = words.select(
        "term", F.lit("a").alias("pos_class"), F.expr("left(term, length(term) - 4)").alias("normal_form")
    )
    return nouns.unionByName(adjectives)


def abbreviated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The texts with the word "the" as "Th." throughout: an abbreviation that nothing but its use tells."""
    return texts(spark, sf_dir).select("doc_id", F.regexp_replace("text", r"\b[Tt]he ", "Th. ").alias("text"))


def lemma_tables(words: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Words of an even number of letters as lemmas; words that start with "th" have an exception."""
    lemmas = words.where("length(term) % 2 = 0").select(F.col("term").alias("lemma"), "pos_class")
    cut = words.where("term LIKE 'th%' AND pos_class = 'v'")
    return lemmas, cut.select("term", "pos_class", F.expr("left(term, 2)").alias("normal_form"))


def pos_of(token: Column) -> Column:
    return (
        F.when(F.lower(token).isin(DETERMINERS), "DT")
        .when(F.endswith(token, F.lit("e")), "JJ")
        .when((F.length(token) >= 4) & token.rlike(r"^\p{L}"), "NN")
        .otherwise("X")
    )


def annotate(df: DataFrame, text: str = "text") -> DataFrame:
    return annotate_by_rules(df, text, CUES, [*STRONG, *WEAK], pos_of)


def annotate_documents(df: DataFrame, text: str = "text") -> DataFrame:
    """The same annotations in one row per document."""
    return document_annotations(df, text, CUES, [*STRONG, *WEAK], pos_of)


def annotations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate(texts(spark, sf_dir))


def two_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a known quality, as `(doc_id, text, label, set)`."""
    labels = table(spark, sf_dir, "labels").select(
        "doc_id", F.col("quality").cast("string").alias("label")
    )
    joined = texts(spark, sf_dir).select("doc_id", "text").join(labels, "doc_id")
    return joined.withColumn("set", F.when(F.col("doc_id") % 5 == 0, "test").otherwise("train"))
