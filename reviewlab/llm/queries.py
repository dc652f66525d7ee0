"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from reviewlab.llm import (
    decontamination, filter_audit, html_extraction, language_id, line_dedup, packing, pii, quality, sharding, simhash,
    token_alignment, token_output, url_filters,
)


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_pii(spark: SparkSession, sf: str) -> DataFrame:
    """Counts and digest are those of the base spans; `spans` also has the identifiers found by context."""
    found = pii.find_pii(_table(spark, sf, "documents"))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [
        (F.size("base") - F.size(F.array_remove(kinds, n))).cast("long").alias(f"n_{kind}")
        for n, kind in enumerate(pii.KINDS)
    ]
    return found.select(
        "doc_id", *counts, _sha256(pii.span_list(F.col("base"))).alias("base_sha256"),
        pii.span_list(F.concat("base", "found")).alias("spans"), F.size("found").cast("long").alias("n_found"),
    )


def op2_line_dedup(spark: SparkSession, sf: str) -> DataFrame:
    kept = line_dedup.dedup_lines(_table(spark, sf, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", _sha256(F.col("kept_text")).alias("kept_sha256"))


def op3_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf, "documents"))


def op4_url_filters(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages").select("page_id", "url")
    return url_filters.filter_urls(pages, url_filters.default_rules(spark)).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    found = language_id.identify(docs, language_id.fit(docs), carry=["doc_id"])
    return found.select("doc_id", language_id.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op6_simhash_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op7_sharding(spark: SparkSession, sf: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op8_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    docs = _table(spark, sf, "documents")
    trees = quality.fit_quality(docs, _table(spark, sf, "labels"))
    return quality.judge_quality(docs, trees, carry=["doc_id"]).select(
        "doc_id", *quality.COUNTS, "base_failed", "kept", "score"
    )


def op9_benchmark_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    marked = decontamination.mark_contamination(
        _table(spark, sf, "documents").select("doc_id", "text"), _table(spark, sf, "benchmark")
    )
    return marked.select(
        "doc_id", "n_words", "n_hit", "n_items",
        _sha256(F.array_join("item_ids", ",")).alias("items_sha256"), "contaminated",
    )


def op10_training_order(spark: SparkSession, sf: str) -> DataFrame:
    """All documents written as shards in training order; a row for each piece says where it lies."""
    return token_output.write_shards(_table(spark, sf, "documents"))[1]


def op11_filter_audit(spark: SparkSession, sf: str) -> DataFrame:
    return filter_audit.audit_filters(_table(spark, sf, "documents"), _table(spark, sf, "labels"))


def op12_token_alignment(spark: SparkSession, sf: str) -> DataFrame:
    return token_alignment.align_tokenizers(_table(spark, sf, "documents"))


def op13_html_extraction(spark: SparkSession, sf: str) -> DataFrame:
    pages = _table(spark, sf, "pages")
    return html_extraction.extract_main_text(pages, carry=["page_id", "url"])


QUERIES = {
    "op1_pii": op1_pii,
    "op2_line_dedup": op2_line_dedup,
    "op3_packing": op3_packing,
    "op4_url_filters": op4_url_filters,
    "op5_language_id": op5_language_id,
    "op6_simhash_near_dedup": op6_simhash_near_dedup,
    "op7_sharding": op7_sharding,
    "op8_quality_rules": op8_quality_rules,
    "op9_benchmark_decontamination": op9_benchmark_decontamination,
    "op10_training_order": op10_training_order,
    "op11_filter_audit": op11_filter_audit,
    "op12_token_alignment": op12_token_alignment,
    "op13_html_extraction": op13_html_extraction,
}
