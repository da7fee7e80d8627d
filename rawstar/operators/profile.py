"""Structure profile of JSON documents, and table summaries."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar.session import materialize

# Names of forms and of primitive types.
OBJECT, ARRAY, PRIMITIVE = "object", "array", "primitive"
NULL, BOOLEAN, NUMBER, STRING = "null", "boolean", "number", "string"


def _form(kind: Column) -> Column:
    return F.when(kind.startswith("OBJECT"), OBJECT).when(kind.startswith("ARRAY"), ARRAY).otherwise(PRIMITIVE)


def _primitive(kind: Column) -> Column:
    return (
        F.when(kind.startswith("OBJECT") | kind.startswith("ARRAY"), None)
        .when(kind == "VOID", NULL)
        .when(kind == "BOOLEAN", BOOLEAN)
        .when(kind == "STRING", STRING)
        .otherwise(NUMBER)
    )


def json_profile(documents: DataFrame, column: str) -> DataFrame:
    """(path, forms, primitive_types, array_count, node_count) over all documents, all items.

    One level of nesting per step, each step a stored table; different shapes at
    one path are merged. Array items share the path of their array plus ``[]``. An empty key or
    one with a dot, bracket, quote or backslash is quoted, so different places have different paths.
    """
    spark = documents.sparkSession
    level = documents.select(F.lit("$").alias("path"), F.parse_json(column).alias("node"))
    # Read twice, by its profile and by the next level; ``documents`` may be costly to derive.
    level = materialize(level.where(F.col("node").isNotNull()), "json-level")
    profiles = []
    while True:
        typed = level.withColumn("_kind", F.schema_of_variant("node")).withColumn("form", _form(F.col("_kind")))
        items = F.when(F.col("form") == ARRAY, F.size(F.col("node").cast("array<variant>")))
        profiles.append(
            typed.groupBy("path").agg(
                F.collect_set("form").alias("forms"),
                F.collect_set(_primitive(F.col("_kind"))).alias("primitive_types"),
                F.coalesce(F.sum(items), F.lit(0)).alias("array_count"),
                F.count(F.lit(1)).alias("node_count"),
            )
        )
        nested = typed.where(F.col("form") != PRIMITIVE).select("path", "form", "node")
        children = spark.sql(
            r"""select case when n.form = 'array' then concat(n.path, '[]')
                   when c.key = '' or c.key rlike r'[.\[\]"\\]'
                   then concat(n.path, '."', replace(replace(c.key, r'\', r'\\'), '"', r'\"'), '"')
                   else concat(n.path, '.', c.key) end as path,
                 c.value as node
               from {nested} n, lateral variant_explode(n.node) c""",
            nested=nested,
        )
        level = materialize(children, "json-level")
        if level.isEmpty():
            break
    return reduce(DataFrame.unionByName, profiles)


def columns_summary(df: DataFrame, name: str) -> DataFrame:
    """(table_name, ordinal, column_name, row_count, non_null) of a table, in one scan."""
    counted = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns)])
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("table_name"),
                F.lit(i + 1).alias("ordinal"),
                F.lit(c).alias("column_name"),
                F.col("_rows").alias("row_count"),
                F.col(f"_{i}").alias("non_null"),
            )
            for i, c in enumerate(df.columns)
        ]
    )
    return counted.select(F.inline(rows))


def first_rows(df: DataFrame, order: list[str], rows: int = 3) -> DataFrame:
    """A few example rows of a table in a fixed order."""
    return df.orderBy(*order).limit(rows)
