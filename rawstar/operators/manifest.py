"""What a run read: row counts per (batch, source hash), totals, and missing batches."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def manifest_groups(rows: DataFrame) -> DataFrame:
    """(raw_schema, raw_hash, row_count); a NULL hash is a group of its own."""
    return rows.groupBy("raw_schema", "raw_hash").agg(F.count(F.lit(1)).alias("row_count"))


def merge_manifests(partials: DataFrame) -> DataFrame:
    """Sum manifests of several staged parts."""
    return partials.groupBy("raw_schema", "raw_hash").agg(F.sum("row_count").alias("row_count"))


def manifest_totals(groups: DataFrame) -> DataFrame:
    """One row: total rows and distinct hashes, where NULL counts as one hash."""
    by_hash = groups.groupBy("raw_hash").agg(F.sum("row_count").alias("n"))
    return by_hash.agg(
        F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("expected_row_count"),
        F.count(F.lit(1)).alias("expected_distinct_raw_hash_count"),
    )


def ordered_manifest(groups: DataFrame) -> DataFrame:
    return groups.orderBy("raw_schema", F.col("raw_hash").asc_nulls_first())


def missing_scopes(groups: DataFrame, requested: DataFrame) -> DataFrame:
    """Requested labels (raw_schema) that no source row carries, sorted."""
    present = groups.select("raw_schema").distinct()
    return requested.select("raw_schema").distinct().join(present, "raw_schema", "left_anti").orderBy("raw_schema")


def require_scopes(groups: DataFrame, labels: list[str]) -> None:
    """Fail and name the requested labels that have no rows. Labels come from the caller."""
    spark = groups.sparkSession
    requested = spark.createDataFrame([(label,) for label in labels], "raw_schema string")
    missing = [row.raw_schema for row in missing_scopes(groups, requested).collect()]
    if missing:
        raise ValueError(f"raw_schema has no source rows: {', '.join(missing)}")


def row_counters(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count) for all tables; an empty table counts 0."""
    counted = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    whole = counted[0]
    for part in counted[1:]:
        whole = whole.unionByName(part)
    return whole


def require_count(df: DataFrame, expected: int) -> int:
    """Row count of a finished load; fails unless it is the expected one."""
    found = df.count()
    if found != expected:
        raise ValueError(f"expected {expected} rows, found {found}")
    return found
