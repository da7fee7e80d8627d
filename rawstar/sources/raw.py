"""The raw table: building records, numbering them, appending batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawstar.layout import RAW_SCHEMA
from rawstar.operators.numbering import dense_ids


def envelope(
    rows: DataFrame,
    headers: Sequence[str],
    raw_schema: str,
    raw_hash: Column,
    raw_tab: Column,
    ingested_at: Column | None = None,
) -> DataFrame:
    """Raw records without ids: every header as text under ``values``, absent cells as ``""``."""
    cells = [F.coalesce(F.col(h).cast("string"), F.lit("")).alias(h) for h in headers]
    return rows.select(
        "*",
        raw_hash.cast("string").alias("raw_hash"),
        (F.current_timestamp() if ingested_at is None else ingested_at).cast("timestamp").alias("raw_ingested_at"),
        F.lit(raw_schema).alias("raw_schema"),
        raw_tab.cast("string").alias("raw_tab"),
        F.to_json(F.struct(F.struct(*cells).alias("values"))).alias("raw"),
    )


def cells_to_columns(lines: DataFrame, headers: Sequence[str]) -> DataFrame:
    """Cells of scanned lines as columns named by the header row."""
    return lines.select(
        *[c for c in lines.columns if c != "values"],
        *[F.try_element_at("values", F.lit(i + 1)).alias(h) for i, h in enumerate(headers)],
    )


def next_raw_id(counters: DataFrame, table_name: str) -> int:
    """Next free id of a table from (table_name, next_raw_id); 1 for a new table."""
    row = counters.where(F.col("table_name") == table_name).agg(F.max("next_raw_id")).first()
    return row[0] or 1


def allocate_raw_ids(records: DataFrame, order: list[str], first: int) -> DataFrame:
    """Consecutive ``raw_id`` from ``first`` in source order, without a global window."""
    return dense_ids(records, order, "raw_id", first)


def advance_counter(counters: DataFrame, table_name: str, used: DataFrame) -> DataFrame:
    """The counter table after ``used`` (raw_id) rows were added to one table."""
    new = used.agg((F.max("raw_id") + 1).alias("next_raw_id")).select(
        F.lit(table_name).alias("table_name"), "next_raw_id"
    )
    return (
        counters.select("table_name", "next_raw_id")
        .unionByName(new)
        .groupBy("table_name")
        .agg(F.max("next_raw_id").alias("next_raw_id"))
    )


def as_raw(records: DataFrame) -> DataFrame:
    return records.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_SCHEMA])


def write_batch(records: DataFrame, path: str, batch: str) -> None:
    """Store one batch of raw rows under (raw_schema, batch).

    Only the partitions of this batch are replaced, so a batch that is run again
    after a failure never doubles its rows.
    """
    (
        as_raw(records)
        .withColumn("batch", F.lit(batch))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("raw_schema", "batch")
        .parquet(path)
    )


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """The stored raw table; a filter on raw_schema prunes folders."""
    return spark.read.schema(T.StructType([*RAW_SCHEMA, T.StructField("batch", T.StringType())])).parquet(path)


def count_check(expected: DataFrame, stored: DataFrame, label: str) -> DataFrame:
    """(label, expected, found, complete) per label; both inputs are (label, n)."""
    return (
        expected.select(label, F.col("n").alias("expected"))
        .join(stored.select(label, F.col("n").alias("found")), label, "full_outer")
        .select(
            label,
            F.coalesce("expected", F.lit(0)).cast("bigint").alias("expected"),
            F.coalesce("found", F.lit(0)).cast("bigint").alias("found"),
        )
        .withColumn("complete", F.col("expected") == F.col("found"))
    )
