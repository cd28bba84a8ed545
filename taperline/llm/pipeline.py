"""The stages of the corpus pipeline: each works on all that its predecessor kept.

All stages but the last return the columns of their input. Quality rules, deduplication and
decontamination drop rows; the secret scan masks secrets in texts; packing returns pieces with places.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taperline.llm import decontaminate, near_dedup, packing, quality, secrets
from taperline.llm.common import share_code, stored, table
from taperline.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the fixed rules and the fences of their language and source keep."""
    share_code(spark)
    return quality.quality_filter(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest doc_id of each group of near duplicates."""
    share_code(spark)
    return near_dedup.distinct_documents(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no benchmark passage contaminates."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents; found secrets are masked."""
    share_code(spark)
    return secrets.redacted(docs)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    share_code(spark)
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("quality rules", quality_rules),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_decontamination),
    ("secret scans", secret_scans),
    ("best-fit packing", best_fit_packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
