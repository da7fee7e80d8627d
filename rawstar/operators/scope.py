"""Which load batches (raw_schema labels) a run reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def in_scope(raw_table: DataFrame, labels: list[str]) -> DataFrame:
    """Rows of the named batches; a partition filter when the table is stored by raw_schema."""
    return raw_table.where(F.col("raw_schema").isin(labels))


def registered_scopes(versions: DataFrame) -> DataFrame:
    """Batches of each table in the order of the version that first loaded them."""
    return (
        versions.where(F.col("raw_schema").isNotNull())
        .groupBy("table_name", "raw_schema")
        .agg(F.min(F.col("version_code").cast("int")).alias("first_version"))
    )


def scope_interval(ordered: DataFrame, first: str, last: str) -> DataFrame:
    """Labels from ``first`` to ``last`` of (raw_schema, first_version); errors if not an interval."""
    ends = ordered.where(F.col("raw_schema").isin(first, last)).agg(
        F.max(F.when(F.col("raw_schema") == first, F.struct("first_version", "raw_schema"))).alias("lo"),
        F.max(F.when(F.col("raw_schema") == last, F.struct("first_version", "raw_schema"))).alias("hi"),
    )
    found = ends.first()
    for label, end in ((first, found["lo"]), (last, found["hi"])):
        if end is None:
            raise ValueError(f"raw_schema is not registered: {label}")
    if found["lo"] > found["hi"]:
        raise ValueError("the first raw_schema comes after the last one")
    rank = F.struct("first_version", "raw_schema")
    low, high = (F.struct(F.lit(e[0]).alias("first_version"), F.lit(e[1]).alias("raw_schema"))
                 for e in (found["lo"], found["hi"]))
    return ordered.where((rank >= low) & (rank <= high))


def rows_of_interval(raw_table: DataFrame, interval: DataFrame) -> DataFrame:
    """Raw rows of an interval. Labels are versions of one table: a few, measured before use."""
    from rawstar.operators.skew import lookup_join

    labels = interval.select("raw_schema").distinct()
    return lookup_join(raw_table, labels, ["raw_schema"])
