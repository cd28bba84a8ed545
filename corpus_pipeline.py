"""From raw documents to packed sequences: one stage per operator, each on what its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from taperline.llm import pipeline

#: (name, function of (spark, docs, sf_dir)) in the order of running.
STAGES = pipeline.STAGES

#: Trained forests and search for packings have no SQL form; the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, from the whole documents table."""
    return pipeline.run(spark, sf_dir)
