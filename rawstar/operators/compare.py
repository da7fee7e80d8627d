"""Comparing tables: an order-free content digest, and where two tables differ."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.operators.skew import lookup_join

EMPTY = "empty"


def row_digest(columns: list[str]) -> Column:
    """MD5 of a row as JSON with all its columns, NULLs included."""
    return F.md5(F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}))


def _number(digest: Column, start: int) -> Column:
    """15 hex digits of a digest as a number below 2**60."""
    return F.conv(F.substring(digest, start, 15), 16, 10).cast("bigint")


def logical_digest(df: DataFrame, name: str) -> DataFrame:
    """(table_name, row_count, digest) of a table's content, whatever its order or layout.

    Row digests are combined by a sum and an xor, which tasks do separately, so
    no sort and no gathered list is needed. Repeated rows count. An empty table
    has the digest ``empty``.
    """
    rows = df.select(row_digest(df.columns).alias("d"))
    folded = rows.agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(_number(F.col("d"), 1).cast("decimal(28,0)")).alias("total"),
        F.bit_xor(_number(F.col("d"), 16)).alias("mix"),
    )
    text = F.concat_ws(":", F.col("row_count").cast("string"), F.col("total").cast("string"), F.col("mix").cast("string"))
    return folded.select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.when(F.col("row_count") == 0, EMPTY).otherwise(F.md5(text)).alias("digest"),
    )


def digests(tables: dict[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [logical_digest(df, name) for name, df in tables.items()])


def star_content(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The six destinations without surrogate keys: references become natural keys."""
    main = tables["table1"].select(F.col("id_column_1").alias("id_column_2"), F.col("id_column_3").alias("raw_id"))
    reference = tables["table3"].select(
        F.col("id_column_1").alias("id_column_4"),
        *[F.col(c).alias(f"d_{c}") for c in ("text_column_1", "text_column_2", "text_column_3", "text_column_4")],
        F.col("numeric_column_1").cast("string").alias("d_numeric_column_1"),
    )

    def child(name: str) -> DataFrame:
        # Names of the fact's own columns are not carried along.
        return tables[name].drop("id_column_1").join(main, "id_column_2").drop("id_column_2")

    fact = tables["table1"].drop("id_column_1").withColumnRenamed("id_column_3", "raw_id")
    return {
        "table3": tables["table3"].drop("id_column_1"),
        "table4": tables["table4"],
        "table1": lookup_join(fact, reference, ["id_column_4"], "left").drop("id_column_4"),
        "table5": child("table5"),
        "table6": child("table6"),
        "table2": child("table2"),
    }


def row_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose number of copies differs, with ``left_count`` and ``right_count``.

    One shuffle for both directions; copies are counted map-side.
    """
    columns = left.columns
    both = left.select("*", F.lit(1).alias("_l"), F.lit(0).alias("_r")).unionByName(
        right.select(*columns, F.lit(0).alias("_l"), F.lit(1).alias("_r"))
    )
    return (
        both.groupBy(*columns)
        .agg(F.sum("_l").alias("left_count"), F.sum("_r").alias("right_count"))
        .where("left_count <> right_count")
    )


def keyed_difference(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, status, changed): rows missing on one side, or with other values in ``changed`` columns."""
    others = [c for c in left.columns if c not in keys]
    a = left.select(*keys, F.struct(*others).alias("_a"))
    b = right.select(*keys, F.struct(*others).alias("_b"))
    changed = F.array_compact(
        F.array(*[F.when(~F.col(f"_a.{c}").eqNullSafe(F.col(f"_b.{c}")), F.lit(c)) for c in others])
    )
    status = (
        F.when(F.col("_b").isNull(), "only left").when(F.col("_a").isNull(), "only right").otherwise("changed")
    )
    return (
        a.join(b, keys, "full_outer")
        .select(*keys, status.alias("status"), F.when(status == "changed", F.array_join(changed, ",")).alias("changed"))
        .where((F.col("status") != "changed") | (F.col("changed") != ""))
    )


def tables_equal(left: DataFrame, right: DataFrame) -> bool:
    """Same rows with the same number of copies."""
    return row_difference(left, right.select(*left.columns)).isEmpty()
