"""Payload reshaping and structure profile queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar import layout, testbed
from rawstar.catalog.registry import Registry
from rawstar.functions.fields import field_text
from rawstar.operators import payload, profile
from rawstar.testbed import LIST_CTE, RAW_ORDERS_CTE, TYPED_CTE, oracle, table

reg = Registry()


@reg.query(
    oracle(
        "select distinct unnest(["
        + ", ".join(f"'{k}'" for k in layout.PAYLOAD_KEYS)
        + "]) as header from base"
    )
)
def payload_keys(spark, sf):
    return payload.payload_keys(testbed.raw(spark, sf))


@reg.query(
    oracle(
        """select 'flags' as header, bool_or(n > 1) as has_list from lists
union all select 'parts', bool_or(n > 1) from lists
union all select 'order', false from lists group by 1 union all select 'empty', false from lists group by 1""",
        LIST_CTE,
    )
)
def multivalue_keys(spark, sf):
    return payload.multivalue_keys(testbed.raw_list(spark, sf))


@reg.query(
    oracle(
        """select status as group_key, 'owner' as header, owner as value,
  row_number() over (partition by status order by raw_id) as position from ro where owner is not null
union all select status, 'priority', priority, row_number() over (partition by status order by first)
from (select status, priority, min(raw_id) as first from ro where priority is not null group by status, priority)
union all select status, null, null, null from ro group by status having count(owner) = 0 and count(priority) = 0""",
        RAW_ORDERS_CTE,
    )
)
def group_rows(spark, sf):
    return payload.group_rows(testbed.raw_orders(spark, sf), "status", ["owner"])


@reg.query(
    oracle(
        """select raw_id, cast(to_json([owner, status, priority]) as varchar) as owner,
  cast(null as varchar) as status, cast(null as varchar) as priority from ro""",
        RAW_ORDERS_CTE,
    )
)
def group_columns(spark, sf):
    grouped = payload.group_columns(testbed.raw_orders(spark, sf), [("owner", ["status", "priority"])])
    return grouped.select("raw_id", *[field_text("raw", k).alias(k) for k in ("owner", "status", "priority")])


def _typed_raw(spark, sf):
    typed = testbed.typed_text(spark, sf)
    keys = [c for c in typed.columns if c != "row_key"]
    return typed.select(
        F.col("row_key").alias("raw_id"), F.to_json(F.struct(F.struct(*keys).alias("values"))).alias("raw")
    )


def _fail(column: str, text: str) -> str:
    return f"case when trim({text}) <> '' and ({column}) is null then {text} end"


_DAY = "cast(try_strptime(trim(day_text), '%d/%m/%Y') as date)"
_FLAG = """case when lower(trim(flag_text)) in ('true','t','1','sim','s','yes','y') then true
  when lower(trim(flag_text)) in ('false','f','0','nao','n','no') then false end"""
_COUNT = "try_cast(nullif(trim(count_text), '') as integer)"


@reg.query(
    oracle(
        f"""select row_key as raw_id, {_DAY} as day, {_fail(_DAY, 'day_text')} as day_fail,
  {_FLAG} as flag, {_fail(_FLAG, 'flag_text')} as flag_fail,
  {_COUNT} as amount, {_fail(_COUNT, 'count_text')} as amount_fail from t""",
        TYPED_CTE,
    )
)
def expand_key_typed(spark, sf):
    df = _typed_raw(spark, sf)
    df = payload.expand_key(df, "day_text", "day", "date")
    df = payload.expand_key(df, "flag_text", "flag", "boolean")
    return payload.expand_key(df, "count_text", "amount", "integer").drop("raw")


@reg.query(
    oracle(
        """select l_orderkey + 1 as raw_id, flags[1] as flag, cast(null as varchar) as flag_fail,
  cast(parts[1] as bigint) as part, cast(null as varchar) as part_fail from lists""",
        LIST_CTE,
    )
)
def expand_first_item(spark, sf):
    df = payload.expand_key(testbed.raw_list(spark, sf), "flags", "flag", "varchar", first_array_item=True)
    return payload.expand_key(df, "parts", "part", "bigint", first_array_item=True).drop("raw")


@reg.query(
    """with p as (select l_orderkey, l_linenumber, l_partkey, l_returnflag,
    row_number() over (partition by l_orderkey order by l_linenumber, l_partkey, l_returnflag) as pos from lineitem),
c as (select l_orderkey as parent_key, l_linenumber as line, row_number() over (partition by l_orderkey order by l_linenumber) as pos
  from lineitem where l_orderkey % 5 <> 0 or l_linenumber <= 2)
select coalesce(parent_key, l_orderkey) as parent_key, line, p.l_partkey as part,
  concat('flag-', lower(p.l_returnflag)) as flag, case when parent_key is not null then 'kept' end as note
from c full join p on p.l_orderkey = c.parent_key and p.pos = c.pos"""
)
def expand_child(spark, sf):
    """A fifth of the orders have child rows for their first two lines only."""
    lines = table(spark, sf, "lineitem").where("l_orderkey % 5 <> 0 or l_linenumber <= 2")
    child = lines.select(
        F.col("l_orderkey").alias("parent_key"),
        F.col("l_linenumber").alias("line"),
        F.lit(None).cast("bigint").alias("part"),
        F.lit(None).cast("string").alias("flag"),
        F.lit("kept").alias("note"),
    )
    return payload.expand_child(
        testbed.raw_list(spark, sf),
        field_text("raw", "order").cast("bigint"),
        child,
        "parent_key",
        ["line"],
        [
            payload.ChildValue("parts", "part", "bigint"),
            payload.ChildValue("flags", "flag", "varchar", sql="concat('flag-', normalized_text)"),
            payload.ChildValue("empty", "note"),
        ],
    )


@reg.query(
    oracle(
        """select row_key, case when lower(trim(flag_text)) in ('sim', 'true', '1') then 'on'
  when trim(flag_text) = '' then 'blank' else flag_text || '?' end as word from t""",
        TYPED_CTE,
    )
)
def convert_custom_sql(spark, sf):
    df = testbed.typed_text(spark, sf)
    sql = """case when normalized_text in ('sim', 'true', '1') then 'on'
      when normalized_text = '' then 'blank' else concat(input_text, '?') end"""
    return payload.convert_by_sql(df, F.col("flag_text"), "word", sql, "text").select("row_key", "word")


@reg.query(
    """select o_orderkey, o_orderstatus, cast(null as integer) as added_count, cast(null as date) as added_day
from orders"""
)
def add_drop_columns(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority")
    df = payload.add_columns(df, {"added_count": "integer", "added_day": "date"})
    return payload.drop_column(df, "o_orderpriority")


@reg.query(
    oracle(
        """select '$' as path, 'object' as forms, '' as primitive_types, 0 as array_count, count(*) as node_count from lists
union all select '$.values', 'object', '', 0, count(*) from lists
union all select '$.values.order', 'primitive', 'string', 0, count(*) from lists
union all select '$.values.empty', 'primitive', 'string', 0, count(*) from lists
union all select concat('$.values.', k), case when bool_or(n = 1) and bool_or(n > 1) then 'array,primitive'
    when bool_or(n > 1) then 'array' else 'primitive' end,
  case when bool_or(n = 1) then 'string' else '' end,
  cast(sum(case when n > 1 then n else 0 end) as bigint), count(*)
  from lists, (values ('flags'), ('parts')) v(k) group by k
union all select concat('$.values.', k, '[]'), 'primitive', 'string', 0, cast(sum(n) as bigint)
  from lists, (values ('flags'), ('parts')) v(k) where n > 1 group by k
union all select 'events $', 'object', '', 0, count(*) from events
union all select 'events $.k', 'primitive', 'number', 0, count(*) from events""",
        LIST_CTE,
    )
)
def json_profile(spark, sf):
    lists = profile.json_profile(testbed.raw_list(spark, sf), "raw")
    events = profile.json_profile(table(spark, sf, "events"), "props")
    both = lists.unionByName(events.withColumn("path", F.concat(F.lit("events "), "path")))
    return both.withColumns(
        {c: F.array_join(F.sort_array(c), ",") for c in ("forms", "primitive_types")}
    )


_SUMMARIES = {
    "nation": ["n_nationkey", "n_name", "n_regionkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
}


@reg.query(
    " union all ".join(
        f"select '{t}' as table_name, {i + 1} as ordinal, '{c}' as column_name, count(*) as row_count, "
        f"count({c}) as non_null from {t}"
        for t, cs in _SUMMARIES.items()
        for i, c in enumerate(cs)
    )
)
def table_summary(spark, sf):
    """All columns of both tables, in their order."""
    parts = [profile.columns_summary(table(spark, sf, t), t) for t in _SUMMARIES]
    return parts[0].unionByName(parts[1])


@reg.query("select o_orderkey, o_custkey, o_orderstatus from orders order by o_orderkey limit 3")
def table_examples(spark, sf):
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    return profile.first_rows(df, ["o_orderkey"])
