"""Relational constraints as checks that return the violating rows or keys."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.operators.skew import lookup_join


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _any(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def unique_violations(df: DataFrame, keys: list[str], where: Column | None = None) -> DataFrame:
    """Keys held by more than one row. A key with a NULL part equals no other key.

    ``where`` makes it a partial unique check. Counted map-side first, so one
    value holding a third of the rows costs one row per task.
    """
    rows = df if where is None else df.where(where)
    return (
        rows.where(_all([F.col(k).isNotNull() for k in keys]))
        .groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .where("row_count > 1")
    )


def null_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column_name, null_count) of NOT NULL columns, all in one scan."""
    counted = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return counted.unpivot([], columns, "column_name", "null_count")


def not_null_violations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with a NULL in any of the NOT NULL columns."""
    return df.where(_any([F.col(c).isNull() for c in columns]))


def primary_key_violations(df: DataFrame, keys: list[str]) -> DataFrame:
    """Repeated keys, and keys with a NULL part, with their row counts."""
    counted = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"))
    return counted.where((F.col("row_count") > 1) | _any([F.col(k).isNull() for k in keys]))


def fk_orphans(child: DataFrame, columns: list[str], parent: DataFrame, parent_keys: list[str]) -> DataFrame:
    """Foreign keys without a parent, with the number of child rows holding them.

    Child keys are counted before the join, so both join sides are unique.
    """
    used = (
        child.where(_all([F.col(c).isNotNull() for c in columns]))
        .groupBy(*columns)
        .agg(F.count(F.lit(1)).alias("row_count"))
    )
    known = parent.select(*[F.col(p).alias(c) for c, p in zip(columns, parent_keys)]).distinct()
    return used.join(known, columns, "left_anti")


def check_violations(df: DataFrame, condition: Column) -> DataFrame:
    """Rows for which a CHECK condition is false; NULL passes, as in SQL."""
    return df.where(~condition)


def inclusion_profile(
    children: dict[str, tuple[DataFrame, str]], parents: dict[str, tuple[DataFrame, str]]
) -> DataFrame:
    """For each (child, parent) column pair: distinct child values, and how many the parent has.

    A pair with nothing missing is a foreign-key candidate. All pairs share one grouping by
    value, which gives the set of columns that hold it. Values of
    the same set are counted together before any pair is formed, so pairs are as many as
    distinct sets, not as values.
    """
    numbers = {name: i for i, name in enumerate([*(f"c:{c}" for c in children), *(f"p:{p}" for p in parents)])}
    columns = {f"c:{n}": d for n, d in children.items()} | {f"p:{n}": d for n, d in parents.items()}
    parts = [
        df.where(F.col(c).isNotNull()).select(F.lit(numbers[n]).alias("column"), F.col(c).cast("string").alias("value"))
        for n, (df, c) in columns.items()
    ]
    # At most one number for each column, however often it holds the value.
    holders = F.array_sort(F.collect_set("column"))
    sets = reduce(DataFrame.unionByName, parts).groupBy("value").agg(holders.alias("holders"))
    counted = sets.groupBy("holders").agg(F.count(F.lit(1)).alias("n"))
    own = F.array(*[F.struct(F.lit(c).alias("child"), F.lit(numbers[f"c:{c}"]).alias("number")) for c in children])
    other = F.array(*[F.struct(F.lit(p).alias("parent"), F.lit(numbers[f"p:{p}"]).alias("number")) for p in parents])
    pairs = (
        counted.select("n", "holders", F.explode(F.filter(own, lambda c: F.array_contains("holders", c["number"]))).alias("c"))
        .select("n", "holders", F.col("c.child").alias("child"), F.explode(other).alias("p"))
        .select("n", "child", F.col("p.parent").alias("parent"), F.array_contains("holders", F.col("p.number")).alias("found"))
    )
    return pairs.groupBy("child", "parent").agg(
        F.sum("n").alias("distinct_values"),
        F.coalesce(F.sum(F.when(F.col("found"), F.col("n"))), F.lit(0)).alias("matched"),
        F.coalesce(F.sum(F.when(~F.col("found"), F.col("n"))), F.lit(0)).alias("missing"),
    )


def without_parents(child: DataFrame, column: str, deleted: DataFrame, deleted_key: str) -> DataFrame:
    """Child rows that survive the deletion of some parents (ON DELETE CASCADE)."""
    gone = deleted.select(F.col(deleted_key).alias(column)).distinct()
    return lookup_join(child, gone, [column], "left_anti").select(*child.columns)


def cascade_delete(
    deleted: DataFrame, deleted_key: str, chain: list[tuple[str, DataFrame, str, str]]
) -> dict[str, DataFrame]:
    """Survivors of each table down a foreign-key chain.

    ``chain`` lists (name, table, foreign key column, own key column), parent
    first; the keys deleted from one table are the deleted parents of the next.
    """
    kept = {}
    for name, table, foreign_key, own_key in chain:
        gone = deleted.select(F.col(deleted_key).alias(foreign_key)).distinct()
        kept[name] = without_parents(table, foreign_key, deleted, deleted_key)
        deleted = lookup_join(table, gone, [foreign_key], "left_semi")
        deleted_key = own_key
    return kept
