"""The six destination recipes, each a function over the typed staging table.

``source`` is what ``staging.stage`` returns, stored or lazy. Child recipes take
``fact_rows``: the staged rows that have a fact row, with its key in ``fact_id``.
``with_fact`` builds that by a join on ``raw_id``; a full run carries the staged
columns along instead and never shuffles on ``raw_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rawstar import layout
from rawstar.functions.fields import upper_trim
from rawstar.operators.numbering import dense_ids
from rawstar.operators.skew import lookup_join


def conform(df: DataFrame, table: str) -> DataFrame:
    """Destination columns in declaration order; columns not supplied are NULL."""
    declared = (c.split(" ", 1) for c in layout.DESTINATION_COLUMNS[table].split(", "))
    return df.selectExpr(
        *[f"CAST({name if name in df.columns else 'NULL'} AS {kind}) AS {name}" for name, kind in declared]
    )


def _thousandths(value: Column) -> Column:
    """Whole thousandths, halves away from zero. Decimal input, so nothing is lost."""
    return F.round(value * F.lit(1000).cast("decimal(4,0)")).cast("int")


def _positive_thousandths(value: Column) -> Column:
    return F.when(value > 0, _thousandths(value))


def reference_keys(source: DataFrame) -> DataFrame:
    """Distinct natural keys of the reference dimension."""
    pair = upper_trim(F.col("text_column_2"))
    return (
        source.where((F.btrim("text_column_1") != "") & pair.rlike(layout.TWO_LETTERS))
        .select(
            F.btrim("text_column_1").alias("text_column_1"),
            F.lit(layout.REFERENCE_LABEL).alias("text_column_2"),
            F.left(pair, F.lit(1)).alias("text_column_3"),
            F.right(pair, F.lit(1)).alias("text_column_4"),
        )
        .distinct()
    )


def dim_reference(source: DataFrame) -> DataFrame:
    """table3. Its key numbers the natural keys in order."""
    numbered = dense_ids(
        reference_keys(source), ["text_column_1", "text_column_3", "text_column_4"], "id_column_1"
    )
    return conform(numbered, "table3")


def dim_code(source: DataFrame) -> DataFrame:
    """table4: at most 26 * 26 rows, whatever the source size."""
    code = upper_trim(F.col("text_column_3"))
    base = ord("A")
    number = (F.ascii(F.left(code, F.lit(1))) - base) * 26 + F.ascii(F.right(code, F.lit(1))) - base + 1
    rows = (
        source.where(code.rlike(layout.TWO_LETTERS))
        .select(
            number.cast("smallint").alias("id_column_1"),
            F.lit(layout.CODE_LABEL).alias("text_column_1"),
            code.alias("text_column_2"),
        )
        .distinct()
    )
    return conform(rows, "table4")


def match_reference(source: DataFrame, table3: DataFrame) -> DataFrame:
    """Staged rows that have a reference row, with its key as ``reference_id``.

    The row side of the match takes the first and last letter of whatever text
    there is; only the dimension itself insists on two letters.
    """
    pair = upper_trim(F.col("text_column_2"))
    keyed = source.withColumns(
        {
            "_text": F.btrim("text_column_1"),
            "_first": F.left(pair, F.lit(1)),
            "_last": F.right(pair, F.lit(1)),
        }
    )
    dimension = table3.where(
        (F.col("text_column_2") == layout.REFERENCE_LABEL) & F.col("numeric_column_1").isNull()
    ).select(
        F.col("text_column_1").alias("_text"),
        F.col("text_column_3").alias("_first"),
        F.col("text_column_4").alias("_last"),
        F.col("id_column_1").alias("reference_id"),
    )
    return (
        lookup_join(keyed, dimension, ["_text", "_first", "_last"])
        .drop("_text", "_first", "_last")
        .withColumn("fact_id", F.col("raw_id"))
    )


def fact_main(matched: DataFrame) -> DataFrame:
    """table1 from ``match_reference`` rows."""
    declared = ", ".join(layout.declared_key(p) for p in layout.POSITIONS)
    return conform(
        matched.select(
            F.col("fact_id").alias("id_column_1"),
            F.col("id_column_1").alias("id_column_2"),
            F.convert_timezone(
                None, F.lit(layout.LOCAL_ZONE), F.col("datetime_column_1").cast("timestamp_ntz")
            ).alias("datetime_column_1"),
            F.expr(f"greatest({declared})").alias("integer_column_1"),
            _positive_thousandths(F.col("numeric_column_2")).alias("integer_column_3"),
            F.col("raw_id").alias("id_column_3"),
            F.col("reference_id").alias("id_column_4"),
            _positive_thousandths(F.col("numeric_column_1")).alias("integer_column_7"),
        ),
        "table1",
    )


def with_fact(source: DataFrame, table1: DataFrame) -> DataFrame:
    """Staged rows joined to a stored fact table; both sides are unique on the key."""
    facts = table1.select(F.col("id_column_3").alias("raw_id"), F.col("id_column_1").alias("fact_id"))
    return source.join(facts, "raw_id")


def child_measure(fact_rows: DataFrame) -> DataFrame:
    """table5."""
    value = F.col("integer_column_1")
    return conform(
        fact_rows.where(value > 0).select(
            F.col("fact_id").alias("id_column_1"),
            F.round(value, 1).alias("numeric_column_1"),
            F.col("fact_id").alias("id_column_2"),
        ),
        "table5",
    )


def bridge_code(fact_rows: DataFrame, table4: DataFrame) -> DataFrame:
    """table6. The code table is keyed by a smallint, so it is never too big to broadcast."""
    codes = table4.where(F.col("text_column_1") == layout.CODE_LABEL).select(
        F.col("text_column_2").alias("_code"), F.col("id_column_1").alias("code_id")
    )
    return conform(
        fact_rows.select("fact_id", upper_trim(F.col("text_column_3")).alias("_code"))
        .join(F.broadcast(codes), "_code")
        .select(
            F.col("fact_id").alias("id_column_1"),
            F.col("fact_id").alias("id_column_2"),
            F.col("code_id").alias("id_column_3"),
        ),
        "table6",
    )


def unpivot_positions(fact_rows: DataFrame) -> DataFrame:
    """table2. Slots are filtered inside the array, so only kept slots become rows."""
    slots = ", ".join(
        f"""named_struct('position', CAST({p} AS smallint), 'declared', {layout.declared_key(p)},
          'kind', upper(btrim({layout.kind_key(p)})), 'weight', {layout.weight_key(p)}, 'gap', {layout.gap_key(p)})"""
        for p in layout.POSITIONS
    )
    kinds = ", ".join(f"'{k}'" for k in layout.KIND_TOKENS)
    kept = F.expr(
        f"filter(array({slots}), s -> s.declared = s.position AND s.weight >= 0 AND s.kind IN ({kinds}))"
    )
    return conform(
        fact_rows.select("fact_id", F.inline(kept)).select(
            (F.col("fact_id") * 16 + F.col("position")).alias("id_column_1"),
            F.col("fact_id").alias("id_column_2"),
            F.col("position").alias("integer_column_1"),
            _thousandths(F.col("weight")).alias("integer_column_2"),
            F.col("kind").alias("text_column_1"),
            _positive_thousandths(F.col("gap")).alias("integer_column_6"),
        ),
        "table2",
    )
