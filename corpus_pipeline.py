"""A corpus pipeline: language, repeated lines, near copies, benchmark passages, packing.

Each stage takes (spark, docs, sf_dir); all but the last return the columns of `docs`. Stages handle
nulls, empty texts, repeated rows, empty tables and extra columns as their operators say.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.llm import decontamination, language_id, line_dedup, packing, simhash
from reviewlab.llm.rows import narrowed, widened
from reviewlab.operators.lookup import lookup_join
from reviewlab.session import materialize


def _narrowed(docs: DataFrame) -> DataFrame:
    """The operators' output columns give way to none of `docs` this way."""
    return narrowed(docs, "doc_id", "text")


def _widened(rows: DataFrame, docs: DataFrame) -> DataFrame:
    return widened(rows, docs, ["doc_id", "text"], [])


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose text has letters of a learnt language; the others (`und`) go.

    The languages are learnt from the documents that carry one; where none does, all documents stay.
    """
    model = language_id.fit(docs)
    if not model.languages:
        return docs
    named = language_id.identify(_narrowed(docs), model)
    return _widened(named.where(F.col("lang_pred") != language_id.UNKNOWN), docs)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the lines that many documents share; `n_chars` follows a changed text."""
    kept = line_dedup.dedup_lines(_narrowed(docs))
    changed = F.col("n_dropped") > 0
    kept = kept.withColumn("text", F.when(changed, F.col("kept_text")).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        length = F.when(changed, F.length("text").cast("long")).otherwise(F.col("_rest.n_chars"))
        kept = kept.withColumn("_rest", F.col("_rest").withField("n_chars", length))
    return _widened(kept, docs)


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one row stays: smallest id (null last), then smallest text hash.

    Near copies are those of the SimHash operator: fingerprints of four-word shingles within four bits,
    directly or by chains.
    """
    own = F.struct(F.col("doc_id").isNull().alias("_null"), "doc_id", F.xxhash64("text").alias("_hash"))
    groups = simhash.near_duplicates(docs.select(own.alias("_own"), "text"), key="_own", radius=simhash.RADIUS)
    keepers = groups.where(F.col("_own") == F.col("component_id")).groupBy("_own").agg(F.count("*").alias("_copies"))
    keepers = materialize(
        keepers.select(_id_text(F.col("_own.doc_id")).alias("_id"), F.col("_own._hash").alias("_row"), "_copies"), "keepers"
    )
    rows = _narrowed(docs).withColumn("_row", F.xxhash64("text")).withColumn("_id", _id_text(F.col("doc_id")))
    single = rows.join(keepers.where(F.col("_copies") == 1), ["_id", "_row"])
    # repeated rows cannot be told apart by id and text: of these few, any one
    repeated = lookup_join(rows, keepers.where(F.col("_copies") > 1), ["_id", "_row"], F.col("_row"), "inner")
    return _widened(single.unionByName(repeated.dropDuplicates(["_id", "_row"])), docs)


def _id_text(key: Column) -> Column:
    """An id that joins also where it is null."""
    return F.coalesce(F.concat(F.lit("="), key.cast("string")), F.lit("-"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark window."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = decontamination.mark_contamination(_narrowed(docs), items)
    return _widened(marked.where(~F.col("contaminated")), docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a training sequence."""
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("benchmark_decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: Language ID, fingerprints and packing are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over `documents`, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
