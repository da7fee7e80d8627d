"""Incremental ingest and staging with Structured Streaming, restartable from its checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rawstar.layout import RAW_SCHEMA
from rawstar.plans import staging


def raw_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """New raw files of a folder as they arrive."""
    return spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def _append(rows: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Everything available now, then stop. The file sink commits each batch exactly once."""
    return (
        rows.writeStream.format("parquet")
        .partitionBy("raw_schema")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(out)
    )


def ingest_available(
    spark: SparkSession, incoming: str, out: str, checkpoint: str, files_per_batch: int = 1000
) -> DataFrame:
    """Append files not seen before to the raw table ``out`` and return the table."""
    _append(raw_stream(spark, incoming, files_per_batch), out, checkpoint).awaitTermination()
    return spark.read.schema(RAW_SCHEMA).parquet(out)


def stage_available(
    spark: SparkSession, incoming: str, out: str, checkpoint: str, files_per_batch: int = 1000
) -> DataFrame:
    """Append typed staging rows of files not seen before and return the staging table.

    The payload is parsed once per raw row over all runs; recipes read the result.
    """
    staged = staging.stage(raw_stream(spark, incoming, files_per_batch))
    _append(staged, out, checkpoint).awaitTermination()
    return spark.read.schema(staged.schema).parquet(out)
