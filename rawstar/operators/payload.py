"""Reshaping the raw payload: keys, grouping of rows and columns, typed columns, child tables.

Rules the inputs do not settle are fixed here: lists follow the order of ``raw_id``, a list
of one value is written as the bare value, a NULL group key is a group of its own, text
that does not convert gives NULL and is kept in the ``_fail`` column beside it.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.functions import convert
from rawstar.functions.fields import field_text
from rawstar.functions.names import MAX_NAME
from rawstar.operators.numbering import group_positions

FAIL_SUFFIX = "_fail"


def _values(raw: Column) -> Column:
    return F.variant_get(F.parse_json(raw), "$.values", "variant")


def _is_list(value: Column) -> Column:
    return F.schema_of_variant(value).startswith("ARRAY")


def _value(raw: Column, key: str) -> Column:
    quote = '"' if "'" in key else "'"
    if quote in key:
        raise ValueError(f"a header with both kinds of quotes cannot be read by path: {key}")
    return F.try_variant_get(F.parse_json(raw), f"$.values[{quote}{key}{quote}]", "variant")


def payload_keys(raw_table: DataFrame) -> DataFrame:
    """Distinct payload headers, by name. Only key names are read and shuffled."""
    keys = F.explode(F.json_object_keys(F.get_json_object("raw", "$.values")))
    return raw_table.select(keys.alias("header")).distinct().orderBy("header")


def multivalue_keys(raw_table: DataFrame) -> DataFrame:
    """(header, has_list): does the header hold a list in at least one row?"""
    values = raw_table.select(_values(F.col("raw")).cast("map<string,variant>").alias("m"))
    return (
        values.select(F.explode("m").alias("header", "value"))
        .groupBy("header")
        .agg(F.coalesce(F.bool_or(_is_list(F.col("value"))), F.lit(False)).alias("has_list"))
    )


def _texts(value: Column) -> Column:
    """The items of a list, or the value itself, as text: strings bare, other values as JSON; null items stay null."""
    items = F.when(_is_list(value), value.cast("array<variant>")).otherwise(F.array(value))
    return F.transform(
        items,
        lambda v: F.when(~F.is_variant_null(v), F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")).otherwise(F.to_json(v))),
    )


def group_rows(
    raw_table: DataFrame,
    key_header: str,
    all_headers: Sequence[str] = (),
    unique_headers: Sequence[str] | None = None,
) -> DataFrame:
    """(group_key, header, position, value): the lists of every group, one row for each value.

    Headers in ``all_headers`` list all values, the others the unique ones; without
    ``unique_headers`` that is every other header met. A list value adds its items. Values stand
    in the order of their (first) ``raw_id``. A key without any value has one row, whose
    header, position and value are NULL. The form is the same for groups of any size, and
    a group is never in one row or task.
    """
    named = [*(unique_headers or ()), *all_headers]
    if len(set(named)) != len(named) or key_header in named:
        raise ValueError("a header may have only one role")
    values = raw_table.select("raw_id", _values(F.col("raw")).cast("map<string,variant>").alias("m"))
    key = _texts(F.try_element_at("m", F.lit(key_header)))
    listed = values.select("raw_id", F.get(key, F.lit(0)).alias("group_key"), F.map_filter("m", lambda k, _: k != key_header).alias("m"))
    cells = listed.select("raw_id", "group_key", F.explode("m").alias("header", "v"))
    if unique_headers is not None:
        cells = cells.where(F.col("header").isin(named))
    cells = cells.select("raw_id", "group_key", "header", F.posexplode(_texts(F.col("v"))).alias("item", "value"))
    cells = cells.where(F.col("value").isNotNull())
    is_all = F.col("header").isin(list(all_headers)) if all_headers else F.lit(False)
    place = F.struct("raw_id", "item")
    # Repeats are removed map-side before anything is ordered.
    unique = cells.where(~is_all).groupBy("group_key", "header", "value").agg(F.min(place).alias("place"))
    every = cells.where(is_all).select("group_key", "header", "value", place.alias("place"))
    placed = group_positions(unique.unionByName(every), ["group_key", "header"], ["place", "value"], "position")
    placed = placed.select("group_key", "header", "position", "value")
    used = placed.select(F.col("group_key").alias("_used")).distinct()
    keys = listed.select("group_key").distinct()
    alone = keys.join(used, keys["group_key"].eqNullSafe(used["_used"]), "left_anti")
    none = [F.lit(None).cast(placed.schema[c].dataType).alias(c) for c in ("header", "position", "value")]
    return placed.unionByName(alone.select("group_key", *none))


def group_columns(raw_table: DataFrame, groups: Sequence[tuple[str, Sequence[str]]]) -> DataFrame:
    """Each master header becomes the list [master, source, ...]; the sources are removed."""
    used = [h for master, sources in groups for h in (master, *sources)]
    if len(set(used)) != len(used):
        raise ValueError("a header may be in only one group")
    if any(not sources for _, sources in groups):
        raise ValueError("a group needs at least one source header")
    values = F.col("_m")

    def items(key: str) -> Column:
        value = F.try_element_at(values, F.lit(key))
        missing = F.array(F.parse_json(F.lit("null")))
        return (
            F.when(value.isNull(), missing)
            .when(_is_list(value), value.cast("array<variant>"))
            .otherwise(F.array(value))
        )

    merged = F.create_map(
        *[
            part
            for master, sources in groups
            for part in (F.lit(master), F.to_variant_object(F.flatten(F.array(*[items(h) for h in (master, *sources)]))))
        ]
    )
    rest = F.map_filter(values, lambda k, _: ~k.isin(used))
    return (
        raw_table.withColumn("_m", _values(F.col("raw")).cast("map<string,variant>"))
        .withColumn("raw", F.to_json(F.struct(F.map_concat(rest, merged).alias("values"))))
        .drop("_m")
    )


def first_item(raw: Column, key: str) -> Column:
    """Text of a header; of its first element if it holds a list."""
    value = _value(raw, key)
    return F.when(_is_list(value), F.try_variant_get(value, "$[0]", "string")).otherwise(
        F.try_variant_get(value, "$", "string")
    )


def valid_name(name: str) -> str:
    if not re.fullmatch(r"[a-z][a-z0-9_]*", name) or len(name) > MAX_NAME:
        raise ValueError(f"not a valid column name: {name}")
    return name


def expand_key(
    raw_table: DataFrame, key: str, name: str, type_name: str, first_array_item: bool = False, **options
) -> DataFrame:
    """Typed column ``name`` from a payload header, and ``name_fail`` with text that did not convert."""
    text = first_item(F.col("raw"), key) if first_array_item else field_text("raw", key)
    return (
        raw_table.withColumn("_text", text)
        .withColumn(valid_name(name), convert.convert(F.col("_text"), type_name, **options))
        .withColumn(name + FAIL_SUFFIX, F.when((F.btrim("_text") != "") & F.col(name).isNull(), F.col("_text")))
        .drop("_text")
    )


def convert_by_sql(df: DataFrame, text: Column, name: str, expression: str, type_name: str) -> DataFrame:
    """Column from a user's SQL over ``input_text`` and ``normalized_text`` (trimmed, lower case)."""
    return (
        df.withColumns({"input_text": text, "normalized_text": F.lower(F.btrim(text))})
        .withColumn(name, F.expr(expression).cast(convert.SPARK_TYPES[convert.canonical_type(type_name)]))
        .drop("input_text", "normalized_text")
    )


@dataclass(frozen=True)
class ChildValue:
    """Payload header ``raw_key`` fills child column ``column``, by type or by the user's SQL."""

    raw_key: str
    column: str
    type_name: str = "varchar"
    sql: str | None = None
    options: dict = field(default_factory=dict)


def expand_child(
    raw_table: DataFrame,
    parent_key: Column,
    child: DataFrame,
    child_key: str,
    child_order: list[str],
    mappings: Sequence[ChildValue],
) -> DataFrame:
    """Child rows with columns filled from the parent's lists, paired by position.

    The n-th child row of a key (in ``child_order``) takes the n-th list items; a
    column keeps its old value where the parent has none. Items beyond the child rows
    become further child rows, whose other columns are NULL. Two parents of one key are refused.
    """
    for names in ([m.raw_key for m in mappings], [m.column for m in mappings]):
        if len(set(names)) != len(names):
            raise ValueError("a header or a child column is mapped twice")

    def texts(key: str) -> Column:
        value = _value(F.col("raw"), key)
        return (
            F.when(value.isNull(), F.array().cast("array<string>"))
            .when(_is_list(value), value.cast("array<string>"))
            .otherwise(F.array(F.try_variant_get(value, "$", "string")))
        )

    zipped = F.arrays_zip(*[texts(m.raw_key).alias(f"t{i}") for i, m in enumerate(mappings)])
    parents = raw_table.select(parent_key.alias("_key"), zipped.alias("_z")).where(F.col("_key").isNotNull())
    twice = parents.groupBy("_key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).collect()
    if twice:
        raise ValueError(f"{twice[0].n} parents have the key {twice[0]['_key']}")
    lists = parents.select("_key", F.posexplode("_z").alias("_p", "_e"))
    lists = lists.select(
        "_key",
        (F.col("_p") + 1).cast("bigint").alias("_position"),
        *[F.col("_e")[f"t{i}"].alias(f"_t{i}") for i in range(len(mappings))],
    )
    for i, m in enumerate(mappings):
        if m.sql:
            lists = convert_by_sql(lists, F.col(f"_t{i}"), f"_n{i}", m.sql, m.type_name)
        else:
            lists = lists.withColumn(f"_n{i}", convert.convert(F.col(f"_t{i}"), m.type_name, **m.options))
    filled = F.lit(False)
    for i in range(len(mappings)):
        filled = filled | F.col(f"_n{i}").isNotNull()
    lists = lists.where(filled).drop(*[f"_t{i}" for i in range(len(mappings))]).withColumnRenamed("_position", "_at")
    placed = group_positions(child, [child_key], child_order, "_position")
    same = (placed[child_key] == lists["_key"]) & (placed["_position"] == lists["_at"])
    joined = placed.join(lists, same, "full_outer")
    new = {m.column: F.coalesce(F.col(f"_n{i}"), placed[m.column]) for i, m in enumerate(mappings)}
    new[child_key] = F.coalesce(placed[child_key], F.col("_key"))
    return joined.select(*[new.get(c, placed[c]).cast(child.schema[c].dataType).alias(c) for c in child.columns])


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Empty typed columns at the end; a name that exists is refused."""
    taken = [name for name in columns if name in df.columns]
    if taken:
        raise ValueError(f"columns exist: {', '.join(taken)}")
    return df.select(
        "*",
        *[
            F.lit(None).cast(convert.SPARK_TYPES[convert.canonical_type(t)]).alias(valid_name(name))
            for name, t in columns.items()
        ],
    )


def drop_column(df: DataFrame, name: str) -> DataFrame:
    """Remove a column; columns of the raw record are protected."""
    if "raw" in name.lower():
        raise ValueError(f"a raw column cannot be dropped: {name}")
    if name not in df.columns:
        raise ValueError(f"no such column: {name}")
    return df.drop(name)
