"""The registered queries of the text operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taperline.llm import (
    decontaminate,
    html_text,
    licenses,
    lm,
    merkle,
    near_dedup,
    negatives,
    packing,
    quality,
    repeats,
    secrets,
    sharding,
    warc,
)
from taperline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.secret_findings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_candidates", "n_findings", "findings")


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer_path())


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_verdicts(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op6_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_labels(table(spark, sf_dir, "documents"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.match_digest(found)


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.revisit_digest(warc.write_archive(table(spark, sf_dir, "pages")))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.document_scores(table(spark, sf_dir, "documents"), tokenizer_path())


def op10_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.without_repeats(table(spark, sf_dir, "documents")).drop("kept_bytes")


def op11_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_digest(sharding.shard_documents(table(spark, sf_dir, "documents"), shards=40))


def op12_hard_negative_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, label)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_digest(table(spark, sf_dir, "documents"))


def all_queries() -> dict[str, Query]:
    return {name: f for name, f in globals().items() if name.startswith("op") and callable(f)}
