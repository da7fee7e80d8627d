"""Joins and numbering that stay balanced when one key holds a large share of rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.session import materialize, shuffle_width

_UNITS = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}


def broadcast_bytes(spark) -> int:
    """The session's own broadcast limit, in bytes."""
    text = spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760").strip().lower()
    digits = text.rstrip("bkmg")
    return int(digits) * _UNITS.get(text[len(digits):], 1)


def is_small(df: DataFrame) -> bool:
    """True only if all of ``df`` was measured to be under the session's broadcast limit.

    A plain sum, combined before its shuffle: each task sends one row.
    """
    size = df.agg(F.sum(F.octet_length(F.to_json(F.struct("*")))).alias("size")).first()["size"] or 0
    return size <= broadcast_bytes(df.sparkSession)


def hot_keys(rows: DataFrame, on: list[str], parts: int | None = None) -> DataFrame:
    """Keys holding more than 1/parts of all rows: by counting, fewer than ``parts`` keys."""
    parts = parts or shuffle_width(rows.sparkSession)
    counts = materialize(rows.groupBy(*on).agg(F.count(F.lit(1)).alias("_n")), "key-counts")
    total = counts.agg(F.sum("_n").alias("_total"))
    return counts.where(F.col("_n") * parts > total.scalar()).select(*on)


def lookup_join(rows: DataFrame, lookup: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Join ``rows`` to a ``lookup`` that is unique on ``on``.

    ``how`` is inner, left, left_semi or left_anti.

    A measured-small lookup is broadcast. Otherwise the few hot keys of ``rows``
    are joined to their (equally few) lookup rows by broadcast, and all other
    keys, none of which is large, by a normal shuffle. Rows with a NULL in their key match
    nothing: they pass by the join and are never shuffled.
    """
    if is_small(lookup):
        return rows.join(F.broadcast(lookup), on, how)
    any_null = reduce(lambda a, b: a | b, [F.col(c).isNull() for c in on])
    without_key, rows = rows.where(any_null), rows.where(~any_null)
    hot = F.broadcast(materialize(hot_keys(rows, on), "hot-keys"))
    added = [] if how in ("left_semi", "left_anti") else [c for c in lookup.columns if c not in on]
    columns = rows.columns + added
    hot_part = rows.join(hot, on, "left_semi").join(
        F.broadcast(lookup.join(hot, on, "left_semi")), on, how
    )
    cold_part = rows.join(hot, on, "left_anti").join(lookup, on, how)
    joined = hot_part.select(*columns).unionByName(cold_part.select(*columns))
    if how in ("inner", "left_semi"):
        return joined
    unmatched = [F.lit(None).cast(lookup.schema[c].dataType).alias(c) for c in added]
    return joined.unionByName(without_key.select("*", *unmatched))
