"""All constraints of a set of tables together: one scan of each table, one shuffle of all keys.

A row is turned into one small entry for each key it holds – the key of a unique rule, the key
a reference needs, the key it offers to references – and for each row test it fails. Entries
of all tables are counted in one grouping by (domain, key), map-side first, so that one
value held by a third of the rows costs an entry for each task. A unique key that references
point to is one domain: its own rows and those of all its children meet there once.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Unique:
    """No two rows of ``table`` (of those that meet ``where``) share ``keys``; a key with a NULL part equals none.

    Violations: keys held more than once.
    """

    name: str
    table: str
    keys: tuple[str, ...]
    where: str | None = None


@dataclass(frozen=True)
class Reference:
    """Each key in ``columns`` without a NULL part is a key of ``parent``. Violations: keys without a parent."""

    name: str
    table: str
    columns: tuple[str, ...]
    parent: str
    parent_keys: tuple[str, ...]


@dataclass(frozen=True)
class RowTest:
    """``condition`` is not false for any row; NULL passes, as in SQL. Violations: rows."""

    name: str
    table: str
    condition: str


def not_null(name: str, table: str, *columns: str) -> RowTest:
    return RowTest(name, table, " AND ".join(f"`{c}` IS NOT NULL" for c in columns))


Rule = Unique | Reference | RowTest


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
# Where an entry has its key: up to two whole numbers as such, any other key as text.
KEY = ["first", "second", "text"]


def _same_kind(child: T.DataType, parent: T.DataType) -> bool:
    """Whether equal values have equal text, and both are whole numbers or neither is."""
    return child == parent or (isinstance(child, _WHOLE) and isinstance(parent, _WHOLE))


def _entry(keep: Column, domain: int, slot: int, df: DataFrame, keys: tuple[str, ...]) -> Column:
    numbers, text = [F.lit(None).cast("bigint")] * 2, F.lit(None).cast("array<string>")
    if len(keys) <= 2 and all(isinstance(df.schema[k].dataType, _WHOLE) for k in keys):
        numbers = [*[F.col(f"`{k}`").cast("bigint") for k in keys], *numbers][:2]
    else:
        text = F.array(*[F.col(f"`{k}`").cast("string") for k in keys])
    key = [value.alias(name) for value, name in zip([*numbers, text], KEY)]
    return F.struct(keep.alias("keep"), F.lit(domain).alias("domain"), F.lit(slot).alias("slot"), *key)


def _known(keys: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(f"`{k}`").isNotNull() for k in keys])


def violations(tables: dict[str, DataFrame], rules: list[Rule]) -> DataFrame:
    """(rule, violations), one row for each rule, zero included."""
    spark = next(iter(tables.values())).sparkSession
    domains: dict[tuple, int] = {}
    children: dict[int, int] = {}  # slots taken in a domain
    entries: dict[str, list[Column]] = {name: [] for name in tables}
    listed: list[tuple[str, int, str]] = []

    def domain_of(table: str, keys: tuple[str, ...], where: str | None) -> int:
        place = (table, keys, where)
        if place not in domains:
            domains[place] = len(domains)
            keep = _known(keys) if where is None else _known(keys) & F.coalesce(F.expr(where), F.lit(False))
            entries[table].append(_entry(keep, domains[place], 0, tables[table], keys))
        return domains[place]

    for rule in rules:
        if isinstance(rule, Unique):
            listed.append((rule.name, domain_of(rule.table, rule.keys, rule.where), "repeated"))
        elif isinstance(rule, Reference):
            for c, p in zip(rule.columns, rule.parent_keys, strict=True):
                if not _same_kind(tables[rule.table].schema[c].dataType, tables[rule.parent].schema[p].dataType):
                    raise ValueError(f"{rule.name}: {c} and {p} have different types")
            domain = domain_of(rule.parent, rule.parent_keys, None)
            slot = children[domain] = children.get(domain, 0) + 1
            entries[rule.table].append(_entry(_known(rule.columns), domain, slot, tables[rule.table], rule.columns))
            listed.append((rule.name, domain, f"orphan{slot}"))
        else:
            domain = domains[rule] = len(domains)
            failed = F.coalesce(~F.expr(rule.condition), F.lit(False))
            entries[rule.table].append(_entry(failed, domain, 0, tables[rule.table], ()))
            listed.append((rule.name, domain, "rows"))

    # The entries become rows first and are filtered then: inside the array, all of them would be interpreted.
    parts = [
        df.select(F.inline(F.array(*entries[name]))).where("keep").drop("keep")
        for name, df in tables.items()
        if entries[name]
    ]
    slots = range(1 + max(children.values(), default=0))
    counted = reduce(DataFrame.unionByName, parts).groupBy("domain", *KEY)
    counted = counted.agg(*[F.count_if(F.col("slot") == s).alias(f"n{s}") for s in slots])
    found = counted.groupBy("domain").agg(
        F.sum("n0").alias("rows"),
        F.count_if(F.col("n0") > 1).alias("repeated"),
        *[F.count_if((F.col("n0") == 0) & (F.col(f"n{s}") > 0)).alias(f"orphan{s}") for s in slots if s],
    )
    kinds = [c for c in found.columns if c != "domain"]
    by_kind = found.unpivot(["domain"], kinds, "kind", "violations")
    names = F.array(*[F.struct(F.lit(n).alias("rule"), F.lit(d).alias("domain"), F.lit(k).alias("kind")) for n, d, k in listed])
    # One row for each rule.
    all_rules = spark.range(1).select(F.inline(names))
    joined = all_rules.join(by_kind, ["domain", "kind"], "left")
    return joined.select("rule", F.coalesce("violations", F.lit(0)).cast("bigint").alias("violations"))
