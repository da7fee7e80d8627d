"""Typed conversion and naming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar import testbed
from rawstar.catalog.registry import Registry
from rawstar.functions import convert, names
from rawstar.testbed import TYPED_CTE, oracle

reg = Registry()


def _typed(sql):
    return oracle(sql, TYPED_CTE)


@reg.query(_typed("select row_key, nullif(trim(label_text), '') as label from t"))
def conv_text(spark, sf):
    return testbed.typed_text(spark, sf).select("row_key", convert.to_text(F.col("label_text")).alias("label"))


@reg.query(
    _typed(
        """select row_key,
  case when lower(trim(flag_text)) in ('true','t','1','sim','s','yes','y') then true
       when lower(trim(flag_text)) in ('false','f','0','nao','n','no') then false end as by_default,
  case when lower(trim(flag_text)) in ('maybe','sim') then true
       when lower(trim(flag_text)) in ('nao') then false end as by_list from t"""
    )
)
def conv_boolean(spark, sf):
    word = F.col("flag_text")
    return testbed.typed_text(spark, sf).select(
        "row_key",
        convert.to_boolean(word).alias("by_default"),
        convert.to_boolean(word, ["maybe", "sim"], ["nao"]).alias("by_list"),
    )


@reg.query(
    _typed(
        """select row_key,
  cast(coalesce(try_strptime(day_text, '%d/%m/%Y'), try_strptime(day_text, '%Y-%m-%d')) as date) as day,
  cast(try_strptime(day_text, '%d/%m/%Y') as date) as day_one_format,
  strptime(moment_text, '%d/%m/%Y %H:%M:%S') as moment,
  strftime(strptime(moment_text, '%d/%m/%Y %H:%M:%S'), '%H:%M:%S') as clock from t"""
    )
)
def conv_datetime(spark, sf):
    day, moment = F.col("day_text"), F.col("moment_text")
    return testbed.typed_text(spark, sf).select(
        "row_key",
        convert.convert(day, "date", formats=["DD/MM/YYYY", "YYYY-MM-DD", "DD/MM/YYYY"]).alias("day"),
        convert.convert(day, "date").alias("day_one_format"),
        convert.convert(moment, "timestamp").alias("moment"),
        convert.convert(moment, "time", formats=[convert.MOMENT_FORMAT]).alias("clock"),
    )


@reg.query(
    _typed(
        """select row_key, try_cast(nullif(trim(count_text), '') as integer) as as_integer,
  try_cast(nullif(trim(count_text), '') as bigint) as as_bigint,
  cast(try_cast(nullif(trim(number_text), '') as decimal(33,15)) as decimal(18,2)) as as_numeric,
  case when row_key % 3 <> 0 then cast(concat(row_key, '.', repeat('7', 15)) as decimal(33,15)) end as as_exact from t"""
    )
)
def conv_numeric(spark, sf):
    # 16 digits are one too many, 15 fit, and zeros after them are no digits.
    ending = F.element_at(F.array(F.lit("6"), F.lit(""), F.lit("000000")), (F.col("row_key") % 3 + 1).cast("int"))
    long_text = F.concat(F.lit(" "), F.col("row_key").cast("string"), F.lit("." + "7" * 15), ending, F.lit(" "))
    return testbed.typed_text(spark, sf).select(
        "row_key",
        convert.convert(long_text, "numeric").alias("as_exact"),
        convert.convert(F.col("count_text"), "int4").alias("as_integer"),
        convert.convert(F.col("count_text"), "bigint").alias("as_bigint"),
        convert.convert(F.col("number_text"), "numeric").cast("decimal(18,2)").alias("as_numeric"),
    )


@reg.query(
    _typed(
        """select row_key, cast(try_cast(replace(number_text, ',', '.') as double) as decimal(18,2)) as amount from t"""
    )
)
def conv_decimal_comma(spark, sf):
    amount = convert.to_decimal_comma(F.col("number_text")).cast("decimal(18,2)").alias("amount")
    return testbed.typed_text(spark, sf).select("row_key", amount)


@reg.query(
    r"""select page_id, case when j = '' then 'raw_value' else rtrim(left(
    case when regexp_matches(j, '^[a-z]') then j else concat('raw_', j) end, 58), '_') end as name,
  case when s = '' then 'sem_titulo' else s end as slug,
  array_to_string([concat(upper(x[1]), lower(x[2:])) for x in string_split(w, ' ')], ' ') as label
from (select page_id, trim(regexp_replace(lower(v), '[^a-z0-9]+', '_', 'g'), '_') as j,
    trim(regexp_replace(regexp_replace(lower(v), '[^a-z0-9_-]+', '_', 'g'), '_+', '_', 'g'), '_') as s,
    trim(regexp_replace(v, '[^A-Za-z0-9]+', ' ', 'g')) as w
  from (select page_id, case when page_id % 10 = 0 then '%%' when page_id % 10 = 1 then concat('9 ', url)
    else url end as v from pages))"""
)
def name_slug(spark, sf):
    key = F.col("page_id") % 10
    text = F.when(key == 0, "%%").when(key == 1, F.concat(F.lit("9 "), "url")).otherwise(F.col("url"))
    return testbed.table(spark, sf, "pages").select(
        "page_id", names.column_name(text).alias("name"), names.slug(text).alias("slug"), names.label(text).alias("label")
    )
