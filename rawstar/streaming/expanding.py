"""The six destinations fed by a stream: every batch of raw files is staged and expanded once.

Layout under ``base``: ``<table>/batch=<id>``, written by overwriting, so a batch that is run
again after a failure replaces what it left. Dimension keys are kept across batches: a batch adds only
the natural keys that no earlier batch has, and numbers them after the earlier ones. What a
batch writes depends on its rows and on earlier batches only, never on later ones or on itself, so a
replay gives the same rows and keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawstar import layout
from rawstar.operators.numbering import dense_ids
from rawstar.operators.skew import lookup_join
from rawstar.plans import expand, recipes, staging
from rawstar.session import materialize
from rawstar.sources.snapshots import path_exists
from rawstar.streaming.ingest import raw_stream

NATURAL = ["text_column_1", "text_column_3", "text_column_4"]


@dataclass(frozen=True)
class StreamedStar:
    """Six destinations under ``base``."""

    spark: SparkSession
    base: str

    def _path(self, name: str) -> str:
        return f"{self.base.rstrip('/')}/{name}"

    def table(self, name: str, before: int | None = None) -> DataFrame:
        """A destination, or what batches before that one wrote to it."""
        schema = layout.DESTINATION_COLUMNS[name]
        if not path_exists(self.spark, self._path(name)):
            return self.spark.createDataFrame([], schema)
        rows = self.spark.read.schema(f"{schema}, batch bigint").parquet(self._path(name))
        return (rows if before is None else rows.where(F.col("batch") < before)).drop("batch")

    def tables(self) -> dict[str, DataFrame]:
        return {name: self.table(name) for name in expand.RUN_ORDER}

    def _write(self, name: str, rows: DataFrame, batch: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self._path(name)}/batch={batch}")

    def take(self, raw_rows: DataFrame, batch: int) -> None:
        """Stage and expand one batch; running it again changes nothing."""
        source = materialize(staging.stage(raw_rows), "stream-batch")
        known = self.table("table3", before=batch)
        new = recipes.reference_keys(source).join(known.select(*NATURAL), NATURAL, "left_anti")
        first = (known.agg(F.max("id_column_1")).first()[0] or 0) + 1
        self._write("table3", recipes.conform(dense_ids(new, NATURAL, "id_column_1", first), "table3"), batch)
        codes = recipes.dim_code(source)
        seen = self.table("table4", before=batch).select("id_column_1")
        self._write("table4", lookup_join(codes, seen, ["id_column_1"], "left_anti"), batch)
        matched = recipes.match_reference(source, self.table("table3", before=batch + 1))
        builders = {
            "table1": lambda: recipes.fact_main(matched),
            "table5": lambda: recipes.child_measure(matched),
            "table6": lambda: recipes.bridge_code(matched, self.table("table4", before=batch + 1)),
            "table2": lambda: recipes.unpivot_positions(matched),
        }
        expand._write_together(builders, lambda name: f"{self._path(name)}/batch={batch}")


def expand_available(
    spark: SparkSession, incoming: str, base: str, checkpoint: str, files_per_batch: int = 1000, star: StreamedStar | None = None
) -> StreamedStar:
    """Expand the files not seen before, a batch at a time, then stop."""
    star = star or StreamedStar(spark, base)
    query = (
        raw_stream(spark, incoming, files_per_batch)
        .writeStream.foreachBatch(star.take)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return star
