"""Faceted filtering straight on the table: row filters, value counts, search, preview.

A filter is ``{column: [item, ...]}``: items of one column are alternatives, columns
are combined with AND. An item is a dict with ``operator`` (eq, eq_numeric, gt, lt,
between) and its values, or ``is_null``. ``None`` instead of a list means "no filter".
"""

from __future__ import annotations

import re
from decimal import Decimal
from functools import reduce

from py4j.java_gateway import is_instance_of
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawstar.session import materialize

# Nodes of a parsed statement that change something.
_WRITES = re.compile(
    r"Insert|Overwrite|Append|Create|Replace(?!Column)|Drop|Alter|Delete|Update|Merge|Truncate|Load|Rename|Set[A-Z]|Add[A-Z]"
    r"|Cache|Refresh|Analyze|Repair|Recover|Command|Call"
)


def to_number(value: Column) -> Column:
    """Number in text with a decimal point or comma; NULL if there is none."""
    return F.replace(value.cast("string"), F.lit(","), F.lit(".")).try_cast("double")


def _bound(text: str) -> Decimal:
    return Decimal(str(text).strip().replace(",", "."))


def _number_of(df: DataFrame, column: str) -> Column:
    """The column itself if it is numeric, so that scans can use the test; else its text as a number."""
    return F.col(column) if isinstance(df.schema[column].dataType, T.NumericType) else to_number(F.col(column))


def _numeric(number: Column, item: dict) -> Column:
    operator = item["operator"]
    if operator == "between":
        return number.between(F.lit(_bound(item["lower_value"])), F.lit(_bound(item["upper_value"])))
    bound = F.lit(_bound(item["numeric_value"]))
    if operator == "gt":
        return number > bound
    if operator == "lt":
        return number < bound
    if operator == "eq_numeric":
        return number == bound
    raise ValueError(f"unknown filter operator: {operator}")


def matches(df: DataFrame, column: str, items: list[dict]) -> Column:
    """Any of the alternatives. Equality with the empty text also keeps NULL rows."""
    equal = [i for i in items if i.get("operator", "eq") == "eq"]
    texts = [str(i.get("value", "")) for i in equal if not i.get("is_null")]
    tests = [_numeric(_number_of(df, column), i) for i in items if i.get("operator", "eq") != "eq"]
    if texts:
        tests.append(F.col(column).cast("string").isin(texts))
    if "" in texts or len(texts) < len(equal):
        tests.append(F.col(column).isNull())
    return reduce(lambda a, b: a | b, tests, F.lit(False))


def predicate(df: DataFrame, filters: dict | None, ignoring: str | None = None) -> Column:
    """All filters as one Column, so the scan can use it; no join is needed."""
    wanted = [matches(df, c, items) for c, items in (filters or {}).items() if c != ignoring and items is not None]
    return reduce(lambda a, b: a & b, wanted, F.lit(True))


def filter_rows(df: DataFrame, filters: dict | None) -> DataFrame:
    return df.where(predicate(df, filters))


def facet_rows(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """One row per (row, column): text, NULL mark, number, lower-cased search text."""
    melted = df.select(F.col(key).alias("row_key"), *[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        "row_key", columns, "column_name", "value"
    )
    return melted.select(
        "column_name",
        "row_key",
        F.coalesce("value", F.lit("")).alias("value_text"),
        F.col("value").isNull().alias("is_null"),
        to_number(F.col("value")).alias("numeric_value"),
        F.lower(F.coalesce("value", F.lit(""))).alias("search_text"),
    )


def facet_counts(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows per value of every column; NULL and the empty text are two values."""
    melted = df.select(*[F.col(c).cast("string").alias(c) for c in columns]).unpivot(
        [], columns, "column_name", "value"
    )
    return (
        melted.groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            "column_name",
            F.col("value").isNull().alias("is_null"),
            F.coalesce("value", F.lit("")).alias("value_text"),
            to_number(F.col("value")).alias("numeric_value"),
            "row_count",
        )
    )


def search_condition(column: str, text: str) -> Column:
    """Case-insensitive substring of the whole text; no character is a wildcard."""
    needle = text.strip().lower()
    shown = F.coalesce(F.col(column).cast("string"), F.lit(""))
    return F.lower(shown).contains(needle)


def facet_values(
    df: DataFrame,
    column: str,
    filters: dict | None = None,
    search: str = "",
    numeric: dict | None = None,
) -> DataFrame:
    """Value counts of one column among rows passing the filters of all *other* columns.

    ``search`` narrows the listed values; a ``numeric`` test takes its place.
    """
    rows = df.where(predicate(df, filters, ignoring=column))
    if numeric is not None:
        rows = rows.where(_numeric(_number_of(df, column), numeric))
    elif search.strip():
        rows = rows.where(search_condition(column, search))
    return (
        rows.groupBy(F.col(column).cast("string").alias("value"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.col("value").isNull().alias("is_null"), F.coalesce("value", F.lit("")).alias("value_text"), "row_count"
        )
    )


def facet_list(values: DataFrame, limit: int | None = None) -> DataFrame:
    """The list a user sees: NULL first, then by text; all of it, or as many values as asked for, one at least."""
    ordered = values.orderBy(F.col("is_null").desc(), "value_text")
    return ordered.limit(max(1, limit)) if limit else ordered


def preview(df: DataFrame, key: str, filters: dict | None = None, rows: int = 50) -> DataFrame:
    return filter_rows(df, filters).orderBy(key).limit(rows)


def stale_tables(cached: DataFrame, current: DataFrame) -> DataFrame:
    """Tables of ``current`` (table_name, version_code, change_token) whose cached state differs.

    Blank marks count as missing, and missing equals missing.
    """

    def mark(side: str, name: str) -> Column:
        return F.nullif(F.btrim(F.col(f"{side}.{name}")), F.lit(""))

    same = mark("a", "version_code").eqNullSafe(mark("b", "version_code")) & mark("a", "change_token").eqNullSafe(
        mark("b", "change_token")
    )
    return (
        current.alias("a")
        .join(cached.alias("b"), F.col("a.table_name") == F.col("b.table_name"), "left")
        .where(F.col("b.table_name").isNull() | ~same)
        .select("a.table_name", F.col("b.table_name").isNull().alias("never_built"))
    )


def _statement_nodes(spark, sql: str, tables: dict[str, DataFrame]) -> set[str]:
    """Names of the nodes of the parsed statement; EXPLAIN parses and resolves it without running it."""
    text = spark.sql(f"explain extended {sql}", **tables).first()[0]
    parsed = text.split("== Analyzed Logical Plan ==")[0]
    return set(re.findall(r"^[\s:+|-]*'?([A-Z]\w+)", parsed, re.MULTILINE))


# Expressions that run code from outside the plan, by class.
_FOREIGN = {"CallMethodViaReflection", "PythonUDF", "ScalaUDF", "HiveSimpleUDF", "HiveGenericUDF"}


def _expression_classes(gateway, plan) -> set[str]:
    """Classes of all expressions of an analysed plan, its children and subqueries."""
    catalyst = "org.apache.spark.sql.catalyst"
    found, todo = set(), [plan]
    while todo:
        node = todo.pop()
        found.add(node.getClass().getSimpleName())
        parts = [node.children()]
        if is_instance_of(gateway, node, f"{catalyst}.plans.QueryPlan"):
            parts.append(node.expressions())
        for part in parts:
            todo += [part.apply(i) for i in range(part.size())]
        if is_instance_of(gateway, node, f"{catalyst}.expressions.PlanExpression"):
            todo.append(node.plan())
    return found


def readonly_query(spark, sql: str, limit: int, **tables: DataFrame) -> tuple[DataFrame, bool]:
    """Rows of a read-only query cut at ``limit``, and whether there were more.

    ``{name}`` in the text stands for a DataFrame passed as ``name=...``.
    """
    if sql.strip().split(None, 1)[0].lower() not in ("select", "with", "values", "table", "from"):
        raise ValueError("only read-only queries are allowed")
    if any(_WRITES.match(node) for node in _statement_nodes(spark, sql, tables)):
        raise ValueError("only read-only queries are allowed")
    query = spark.sql(sql, **tables)
    if _expression_classes(spark.sparkContext._gateway, query._jdf.queryExecution().analyzed()) & _FOREIGN:
        raise ValueError("only read-only queries are allowed: no foreign calls")
    # One execution: the rows shown and the flag come from the same stored result.
    result = materialize(query.limit(limit + 1), "query")
    return result.limit(limit), result.count() > limit


def delete_where(df: DataFrame, condition: Column) -> DataFrame:
    """What a DELETE leaves: rows for which the condition is false or NULL."""
    return df.where(~F.coalesce(condition, F.lit(False)))


def row_change(before: DataFrame, after: DataFrame) -> DataFrame:
    """(rows_before, rows_after, changed) of a managed change, for the exact row counter."""
    both = before.select(F.lit(1).alias("b"), F.lit(0).alias("a")).unionByName(
        after.select(F.lit(0).alias("b"), F.lit(1).alias("a"))
    )
    return both.agg(
        F.coalesce(F.sum("b"), F.lit(0)).cast("bigint").alias("rows_before"),
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("rows_after"),
    ).withColumn("changed", F.col("rows_after") - F.col("rows_before"))
