"""Save and load what training learned: Parquet tables and fitted models.

Each save writes a folder of its own and then names it in ``CURRENT``, so a save that fails
changes nothing, tables loaded from the same path stay readable while they are saved back,
and nothing of an earlier state is mixed into a later one. The version before the current
one is kept for its readers; older ones are deleted.
"""

from __future__ import annotations

import uuid

from pyspark.ml.classification import (
    GBTClassificationModel,
    MultilayerPerceptronClassificationModel,
    RandomForestClassificationModel,
)
from pyspark.sql import DataFrame, SparkSession

from taperline.operators.fatigue import FatigueModels

MODEL_CLASSES = {
    "RandomForest": RandomForestClassificationModel,
    "GradientBoosting": GBTClassificationModel,
    "NeuralNetwork": MultilayerPerceptronClassificationModel,
}
FATIGUE_TABLES = ("registry", "scalers", "models")
LARGE = "session_type string, player string, model_type string, folder string"
CURRENT = "CURRENT"


def _path(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())


def _exists(spark: SparkSession, path: str) -> bool:
    target, files = _path(spark, path)
    return files.exists(target)


def _versions(spark: SparkSession, path: str) -> list[str]:
    """The current version and the one before it, if any."""
    if not _exists(spark, f"{path}/{CURRENT}"):
        return []
    return [r["value"] for r in spark.read.text(f"{path}/{CURRENT}", wholetext=True).collect()][0].split()


def _name_versions(spark: SparkSession, path: str, versions: list[str]) -> None:
    target, files = _path(spark, f"{path}/{CURRENT}")
    stream = files.create(target, True)
    try:
        stream.write(bytearray("\n".join(versions).encode()))
    finally:
        stream.close()


def save_artifacts(path: str, tables: dict[str, DataFrame], fatigue: FatigueModels) -> None:
    spark = next(iter(tables.values())).sparkSession
    earlier = _versions(spark, path)
    version = f"version-{uuid.uuid4().hex}"
    for name, table in tables.items():
        table.write.parquet(f"{path}/{version}/tables/{name}")
    for name in FATIGUE_TABLES:
        table = getattr(fatigue, name)
        if table is not None:
            table.write.parquet(f"{path}/{version}/tables/{name}")
    listed = []
    for number, (key, model) in enumerate(sorted(fatigue.large.items())):
        model.write().save(f"{path}/{version}/models/{number}")
        listed.append((*key, f"models/{number}"))
    if listed:
        spark.createDataFrame(listed, LARGE).write.parquet(f"{path}/{version}/tables/large")
    _name_versions(spark, path, [version, *earlier[:1]])
    for old in earlier[1:]:
        target, files = _path(spark, f"{path}/{old}")
        files.delete(target, True)


def load_artifacts(spark: SparkSession, path: str, names: list[str]) -> tuple[dict[str, DataFrame], FatigueModels]:
    versions = _versions(spark, path)
    if not versions:
        raise FileNotFoundError(f"No saved analytics at {path}")
    path = f"{path}/{versions[0]}"
    tables = {name: spark.read.parquet(f"{path}/tables/{name}") for name in names}
    fatigue = FatigueModels()
    for name in FATIGUE_TABLES:
        if _exists(spark, f"{path}/tables/{name}"):
            setattr(fatigue, name, spark.read.parquet(f"{path}/tables/{name}"))
    if _exists(spark, f"{path}/tables/large"):
        # One row per oversized player and kind.
        for session_type, player, kind, folder in spark.read.parquet(f"{path}/tables/large").collect():
            fatigue.large[session_type, player, kind] = MODEL_CLASSES[kind].load(f"{path}/{folder}")
    return tables, fatigue
