"""Quality rule queries over customers and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar import testbed
from rawstar.catalog.registry import Registry
from rawstar.operators import quality
from rawstar.operators.quality import Domain, Rule
from rawstar.testbed import TYPED_CTE, oracle, table

reg = Registry()

_QA_SQL = """select c_custkey,
  case c_custkey % 11 when 0 then null when 1 then '' when 2 then '   ' else concat(c_mktsegment, substr(c_name, 10)) end
    as name,
  case when c_custkey % 13 = 0 then null else cast(c_acctbal as decimal(18,2)) end as balance
from customer"""
_CTE = f"with t as ({_QA_SQL})\n"
_BLANK = "(name is null or trim(name) = '')"


def _qa(spark, sf):
    return spark.sql(_QA_SQL.replace("from customer", "from {customer}"), customer=table(spark, sf, "customer"))


def _flags(spark, sf, rules, names):
    """Key plus the flags, renamed to ``names``."""
    df = _qa(spark, sf)
    return df.select("c_custkey", *[quality.flag(df, r).alias(n) for r, n in zip(rules, names)])


def _text_sql(fail: str) -> str:
    return (
        _CTE + f"select c_custkey, case when {_BLANK} then false else {fail} end as lenient, "
        f"case when {_BLANK} then true else {fail} end as strict from t"
    )


def _text(spark, sf, rule, params):
    return _flags(
        spark, sf, [Rule("name", rule, params, True), Rule("name", rule, params, False)], ["lenient", "strict"]
    )


@reg.query(_text_sql("false"))
def qa_not_blank(spark, sf):
    return _text(spark, sf, "not_blank", {})


@reg.query(_CTE + f"select c_custkey, not {_BLANK} as lenient, not {_BLANK} as strict from t")
def qa_is_blank(spark, sf):
    return _text(spark, sf, "is_blank", {})


@reg.query(_text_sql("not contains(name, 'BUILD')"))
def qa_contains(spark, sf):
    return _text(spark, sf, "contains", {"text": "BUILD"})


@reg.query(_text_sql("contains(name, '00')"))
def qa_not_contains(spark, sf):
    return _text(spark, sf, "not_contains", {"text": "00"})


@reg.query(
    _CTE
    + f"""select c_custkey, case when {_BLANK} then false else not length(name) < 17 end as lt,
  case when {_BLANK} then false else not length(name) <= 17 end as lte,
  case when {_BLANK} then true else not length(name) > 17 end as gt,
  case when {_BLANK} then true else not length(name) >= 17 end as gte from t"""
)
def qa_length_cmp(spark, sf):
    rules = [Rule("name", f"length_{op}", {"limit": 17}, op.startswith("l")) for op in ("lt", "lte", "gt", "gte")]
    return _flags(spark, sf, rules, ["lt", "lte", "gt", "gte"])


@reg.query(_text_sql("not length(name) between 17 and 18"))
def qa_length_between(spark, sf):
    return _text(spark, sf, "length_between", {"lower": 17, "upper": 18})


@reg.query(
    _CTE
    + """select c_custkey, balance is not null and not balance > 1000 as gt,
  balance is not null and not balance >= 1000 as gte,
  balance is null or not balance < 5000 as lt, balance is null or not balance <= 5000 as lte from t"""
)
def qa_numeric_cmp(spark, sf):
    rules = [Rule("balance", f"numeric_{op}", {"value": 1000}) for op in ("gt", "gte")]
    rules += [Rule("balance", f"numeric_{op}", {"value": 5000}, False) for op in ("lt", "lte")]
    return _flags(spark, sf, rules, ["gt", "gte", "lt", "lte"])


@reg.query(
    _CTE
    + """select c_custkey, balance is not null and not balance between 0 and 5000 as lenient,
  balance is null or not balance between 0 and 5000 as strict from t"""
)
def qa_numeric_between(spark, sf):
    params = {"lower": 0, "upper": 5000}
    rules = [Rule("balance", "numeric_between", params), Rule("balance", "numeric_between", params, False)]
    return _flags(spark, sf, rules, ["lenient", "strict"])


_STATS = "(select avg(cast(balance as double)) as m, stddev_samp(cast(balance as double)) as s from t) x"


@reg.query(
    _CTE
    + f"""select c_custkey, balance is not null and not abs(cast(balance as double) - m) <= 1.5 * s as fails
from t, {_STATS}"""
)
def qa_sigma_within(spark, sf):
    return _flags(spark, sf, [Rule("balance", "numeric_mean_stddev_within", {"stddevs": 1.5})], ["fails"])


@reg.query(
    _CTE + f"select c_custkey, balance is not null and not cast(balance as double) <= m + 1.2 * s as fails from t, {_STATS}"
)
def qa_sigma_max(spark, sf):
    return _flags(spark, sf, [Rule("balance", "numeric_max_mean_stddev", {"stddevs": 1.2})], ["fails"])


@reg.query(
    _CTE + f"select c_custkey, balance is not null and not cast(balance as double) >= m - 1.2 * s as fails from t, {_STATS}"
)
def qa_sigma_min(spark, sf):
    return _flags(spark, sf, [Rule("balance", "numeric_min_mean_stddev", {"stddevs": 1.2})], ["fails"])


def _domain_sql(column: str, kind: str, ok: str) -> str:
    blank = f"({column} is null or trim({column}) = '')"
    return f"""select '{column}' as column_name, '{kind}' as kind,
  count(*) filter (where not {blank} and coalesce({ok}, false)) as conforming,
  count(*) filter (where not {blank} and not coalesce({ok}, false)) as failing,
  count(*) filter (where {blank}) as blank from t"""


@reg.query(
    oracle(
        " union all ".join(
            [
                _domain_sql("count_text", "range", "try_cast(trim(count_text) as decimal(33,15)) between 10 and 900"),
                _domain_sql("count_text", "less", "try_cast(trim(count_text) as decimal(33,15)) < 500"),
                _domain_sql("number_text", "greater", "try_cast(trim(number_text) as decimal(33,15)) > 100000.5"),
                _domain_sql("flag_text", "boolean", "lower(trim(flag_text)) in ('sim', 'true', 'nao', 'f')"),
                _domain_sql(
                    "day_text",
                    "datetime",
                    "try_strptime(day_text, '%d/%m/%Y') is not null or try_strptime(day_text, '%Y-%m-%d') is not null",
                ),
            ]
        ),
        TYPED_CTE,
    )
)
def domain_conformance(spark, sf):
    return quality.domain_conformance(
        testbed.typed_text(spark, sf),
        [
            Domain("count_text", "range", lower="10", upper="900"),
            Domain("count_text", "less", upper="500"),
            Domain("number_text", "greater", lower="100000.5"),
            Domain("flag_text", "boolean", true_words=("sim", "true"), false_words=("nao", "f")),
            Domain("day_text", "datetime", formats=("DD/MM/YYYY", "YYYY-MM-DD")),
        ],
    )
