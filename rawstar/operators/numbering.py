"""Row numbers without a single-task window: range-partition, then offset per partition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawstar.session import materialize, shuffle_width


def _in_order(df: DataFrame, order: list[str | Column], parts: int | None) -> DataFrame:
    """Globally ordered rows, stored, with ``_part`` and the 0-based ``_slot`` inside it."""
    parts = parts or shuffle_width(df.sparkSession)
    placed = (
        # Rows that tie in ``order`` may be a third of the table; the tie column
        # lets the ranges cut through them.
        df.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(parts, *order, "_tie")
        .sortWithinPartitions(*order, "_tie")
        .drop("_tie")
        # Partition number in the high bits, row number inside it in the low 33.
        .withColumn("_mark", F.monotonically_increasing_id())
    )
    stored = materialize(placed, "ordered")
    return stored.withColumns(
        {
            "_part": F.shiftright("_mark", 33).cast("int"),
            "_slot": F.col("_mark").bitwiseAND(F.lit((1 << 33) - 1)),
        }
    ).drop("_mark")


def dense_ids(
    df: DataFrame,
    order: list[str | Column],
    column: str,
    start: int | Column = 1,
    parts: int | None = None,
) -> DataFrame:
    """Consecutive ids ``start, start+1, ...`` in the given total order."""
    placed = _in_order(df, order, parts)
    sizes = placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # One row per partition, so this ordered window and the broadcast stay tiny.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    first = start if isinstance(start, Column) else F.lit(start)
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn(column, (first + F.col("_before") + F.col("_slot")).cast("bigint"))
        .drop("_part", "_slot", "_before")
    )


def running_totals(
    df: DataFrame, order: list[str | Column], size: str, column: str, parts: int | None = None
) -> DataFrame:
    """``column``: the sum of ``size`` over all rows before this one in the given total order."""
    placed = _in_order(df, order, parts)
    sums = placed.groupBy("_part").agg(F.sum(size).alias("_n"))
    # One row per partition, as in ``dense_ids``.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_own", F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(F.broadcast(offsets), "_part")
        .withColumn(column, (F.col("_before") + F.col("_own")).cast("bigint"))
        .drop("_part", "_slot", "_before", "_own")
    )


def group_positions(
    df: DataFrame,
    keys: list[str],
    order: list[str | Column],
    column: str,
    parts: int | None = None,
) -> DataFrame:
    """1-based position of each row inside its group, also for a group of any size.

    Rows are range-partitioned on (keys, order), so a huge group is spread over
    many partitions. Only the first group of a partition can have begun earlier;
    its offset is the number of its rows in earlier partitions.
    """
    placed = _in_order(df, [*keys, *order], parts)
    pieces = placed.groupBy("_part", *keys).agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per partition is left, so the broadcast is bounded.
    begun = (
        pieces.withColumn("_before", F.sum("_n").over(earlier))
        .where(F.col("_before") > 0)
        .select(F.col("_part").alias("_p"), *[F.col(k).alias(f"_k_{k}") for k in keys], "_before")
    )
    same = F.col("_part") == F.col("_p")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = Window.partitionBy("_part", *keys).orderBy("_slot")
    return (
        placed.withColumn("_rank", F.row_number().over(inside))
        .join(F.broadcast(begun), same, "left")
        .withColumn(column, (F.col("_rank") + F.coalesce("_before", F.lit(0))).cast("bigint"))
        .drop("_part", "_slot", "_rank", "_p", "_before", *[f"_k_{k}" for k in keys])
    )
