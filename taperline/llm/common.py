"""Helpers shared by the text operators."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from taperline.operators.hotspots import shared_folder

#: While a table is written: Spark removes the shuffle files behind it, and Python gets texts in small batches.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}
#: Bytes of text that a task's array code looks at together; a longer text is taken alone.
SLICE_BYTES = 1 << 20


def share_code(spark: SparkSession) -> None:
    """Python workers of a local session find the package where the driver does; clusters have it installed."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).parents[2]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A new path in the folder that all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """Write a table to the shared folder and read it back, so that lost executors cost only their tasks.

    The shuffle files behind the table are no longer needed then and are removed.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    before = {name: spark.conf.get(name, None) for name in WRITING}
    try:
        for name, value in WRITING.items():
            spark.conf.set(name, value)
        df.write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
    return spark.read.schema(df.schema).parquet(path)


def sized(df: DataFrame, rows: int, per_task: int = 100_000) -> DataFrame:
    """Run the last step of ``df`` in as many tasks as ``rows`` rows need, in place of one per shuffle partition."""
    least = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.coalesce(max(least, 1 + rows // per_task))


def discard(*tables: DataFrame) -> None:
    """Delete stored tables that nothing reads any more."""
    for df in tables:
        spark = df.sparkSession
        folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
        for folder in folders:
            path = spark._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_identity() -> list:
    """Columns that tell the rows of a table of texts apart; rows that share both are equal."""
    return [F.col("doc_id"), F.xxhash64(F.coalesce("text", F.lit(""))).alias("text_hash")]


def text_slices(batches: Iterable[pa.RecordBatch], column: str = "text") -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """(rows, bytes, offsets): the texts of some rows as one array of UTF-8 bytes; null is empty."""
    for batch in batches:
        at = batch.schema.get_field_index(column)
        texts = batch.column(at).fill_null("").cast(pa.large_string())
        if not batch.num_rows:
            continue
        _, places, content = texts.buffers()
        ends = np.frombuffer(places, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(content, dtype=np.uint8) if content else np.zeros(0, dtype=np.uint8)
        start = 0
        while start < len(texts):
            stop = max(start + 1, int(np.searchsorted(ends, ends[start] + SLICE_BYTES, side="right")) - 1)
            yield batch.slice(start, stop - start), data[ends[start] : ends[stop]], ends[start : stop + 1] - ends[start]
            start = stop
