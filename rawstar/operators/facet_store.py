"""Kept facet counts of a partitioned table: only partitions whose files changed are counted again.

The change token of a partition comes from its files – names, sizes and times of writing –
and needs no row. Counts are stored by partition and added up when they are read. A partition's
counts carry the token they were made from, so an interrupted refresh is made up by the next.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawstar.operators.facets import stale_tables, to_number
from rawstar.operators.skew import lookup_join
from rawstar.session import materialize
from rawstar.sources.snapshots import path_exists

COUNTS = "column_name string, value string, row_count bigint, change_token string, part string"


def partition_tokens(spark: SparkSession, path: str, partition: str) -> DataFrame:
    """(part, change_token) of each partition of a stored table."""
    files = spark.read.parquet(path).select(
        F.col(partition).cast("string").alias("part"),
        F.xxhash64("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").alias("file"),
    )
    return files.distinct().groupBy("part").agg(
        F.concat_ws(":", F.count(F.lit(1)).cast("string"), F.hex(F.bit_xor("file"))).alias("change_token")
    )


@dataclass(frozen=True)
class FacetStore:
    """Counts of ``columns`` of the table at ``source``, partitioned by ``partition``, kept at ``path``."""

    spark: SparkSession
    path: str
    source: str
    partition: str
    columns: tuple[str, ...]

    def _stored(self) -> DataFrame:
        if not path_exists(self.spark, self.path):
            return self.spark.createDataFrame([], COUNTS)
        return self.spark.read.schema(COUNTS).parquet(self.path)

    def stale(self) -> DataFrame:
        """(part, change_token) of the partitions that have changed since they were counted."""
        current = partition_tokens(self.spark, self.source, self.partition)
        kept = self._stored().groupBy("part").agg(F.max("change_token").alias("change_token"))

        def named(tokens: DataFrame) -> DataFrame:
            return tokens.select(F.col("part").alias("table_name"), F.lit(None).cast("string").alias("version_code"), "change_token")

        changed = stale_tables(named(kept), named(current)).select(F.col("table_name").alias("part"))
        return materialize(current.join(changed, "part", "left_semi"), "stale-partitions")

    def refresh(self) -> DataFrame:
        """Count the stale partitions again; returns them."""
        stale = self.stale()
        rows = self.spark.read.parquet(self.source).withColumn("part", F.col(self.partition).cast("string"))
        wanted = lookup_join(rows, stale, ["part"])
        melted = wanted.select("part", "change_token", *[F.col(c).cast("string").alias(c) for c in self.columns])
        melted = melted.unpivot(["part", "change_token"], list(self.columns), "column_name", "value")
        counted = melted.groupBy("part", "change_token", "column_name", "value").agg(F.count(F.lit(1)).alias("row_count"))
        (
            counted.select(*[c.split()[0] for c in COUNTS.split(", ")])
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("part")
            .parquet(self.path)
        )
        return stale

    def counts(self) -> DataFrame:
        """Like ``facets.facet_counts`` over the whole table; partitions that are gone do not count."""
        present = partition_tokens(self.spark, self.source, self.partition).select("part")
        kept = self._stored().join(present, "part", "left_semi")
        return (
            kept.groupBy("column_name", "value")
            .agg(F.sum("row_count").alias("row_count"))
            .select(
                "column_name",
                F.col("value").isNull().alias("is_null"),
                F.coalesce("value", F.lit("")).alias("value_text"),
                to_number(F.col("value")).alias("numeric_value"),
                "row_count",
            )
        )
