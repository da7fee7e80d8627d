"""Snapshots per version, restore, and JSON export."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a folder or file exists on whatever file system ``path`` names."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def snapshot_path(base: str, version: str) -> str:
    return f"{base.rstrip('/')}/version={version}"


def write_snapshot(df: DataFrame, base: str, version: str) -> str:
    """Store one version; a version that is already there is refused."""
    path = snapshot_path(base, version)
    df.write.mode("errorifexists").parquet(path)
    return path


def read_snapshot(spark: SparkSession, base: str, version: str) -> DataFrame:
    return spark.read.parquet(snapshot_path(base, version))


def restore_new(spark: SparkSession, base: str, version: str, target: str) -> DataFrame:
    """Restore a version into a new table; an existing target is refused."""
    if path_exists(spark, target):
        raise ValueError(f"target exists: {target}")
    read_snapshot(spark, base, version).write.mode("errorifexists").parquet(target)
    return spark.read.parquet(target)


def restore_in_place(spark: SparkSession, base: str, version: str, target: str) -> DataFrame:
    """Replace a table by one of its versions."""
    read_snapshot(spark, base, version).write.mode("overwrite").parquet(target)
    return spark.read.parquet(target)


def json_objects(df: DataFrame) -> DataFrame:
    """Each row as one JSON object with all its columns, NULLs included."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("json"))


def export_json(df: DataFrame, path: str) -> None:
    """JSON lines, written by all tasks; NULL columns are written as null."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(path)
