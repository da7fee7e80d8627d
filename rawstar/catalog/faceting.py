"""Filter, facet, preview and managed change queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar.catalog.registry import Registry
from rawstar.operators import facet_store, facets
from rawstar.session import materialize, scratch_path
from rawstar.testbed import table

reg = Registry()

_FACET_SQL = """select o_orderkey as row_key,
  case when o_orderkey % 13 = 0 then null when o_orderkey % 17 = 0 then '' else o_orderstatus end as status,
  case when o_orderkey % 11 = 0 then null else c_mktsegment end as segment,
  case when o_orderkey % 7 = 0 then '' else o_orderpriority end as priority,
  cast(o_totalprice as decimal(18,2)) as price
from orders left join customer on c_custkey = o_custkey"""
_CTE = f"with t as ({_FACET_SQL})\n"
_COLUMNS = ["status", "segment", "priority"]


def _facet_table(spark, sf):
    return spark.sql(
        _FACET_SQL.replace("from orders left join customer", "from {orders} left join {customer}"),
        orders=table(spark, sf, "orders"),
        customer=table(spark, sf, "customer"),
    )


def _eq(*values):
    return [{"value": v} for v in values]


_NULL = {"is_null": True}


@reg.query(
    _CTE + "select * from t where priority = '1-URGENT' or priority = '' order by row_key limit 50"
)
def preview_top50(spark, sf):
    return facets.preview(_facet_table(spark, sf), "row_key", {"priority": _eq("1-URGENT", "")})


@reg.query(
    _CTE
    + """select * from t where (status in ('F', 'O') or status is null)
and (price between 1000 and 90000.5 or price > 400000 or price = 100.25)
and (coalesce(segment, '') = '' or segment = 'BUILDING')"""
)
def row_filter(spark, sf):
    return facets.filter_rows(
        _facet_table(spark, sf),
        {
            "status": [*_eq("F", "O"), _NULL],
            "price": [
                {"operator": "between", "lower_value": "1000", "upper_value": "90000,5"},
                {"operator": "gt", "numeric_value": "400000"},
                {"operator": "eq_numeric", "numeric_value": "100.25"},
            ],
            "segment": _eq("", "BUILDING"),
            "priority": None,
        },
    )


_MELT = " union all ".join(
    f"select '{c}' as column_name, row_key, cast({c} as varchar) as v from t" for c in [*_COLUMNS, "price"]
)


@reg.query(
    _CTE
    + f"""select column_name, row_key, coalesce(v, '') as value_text, v is null as is_null,
  cast(try_cast(replace(v, ',', '.') as double) as decimal(18,2)) as numeric_value,
  lower(coalesce(v, '')) as search_text from ({_MELT})"""
)
def facet_rows(spark, sf):
    rows = facets.facet_rows(_facet_table(spark, sf), "row_key", [*_COLUMNS, "price"])
    return rows.withColumn("numeric_value", F.col("numeric_value").cast("decimal(18,2)"))


@reg.query(
    """with o as (
  select case when o_custkey % 8 = 3 and o_orderkey % 5 = 0 then 'X' else o_orderstatus end as o_orderstatus,
    case when o_orderkey % 11 = 0 then null else o_orderpriority end as o_orderpriority from orders)
select column_name, v is null as is_null, coalesce(v, '') as value_text, count(*) as row_count, 1 as recounted from (
  select 'o_orderstatus' as column_name, o_orderstatus as v from o union all select 'o_orderpriority', o_orderpriority from o)
group by column_name, v"""
)
def facet_counts_kept(spark, sf):
    """Counts of a table of eight partitions; one is written anew, and only that one is counted again."""
    source = scratch_path(spark, "partitioned")
    orders = table(spark, sf, "orders").select(
        "o_orderkey",
        "o_orderstatus",
        F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderpriority")).alias("o_orderpriority"),
        (F.col("o_custkey") % 8).alias("part_no"),
    )
    orders.write.partitionBy("part_no").parquet(source)
    store = facet_store.FacetStore(spark, scratch_path(spark, "facets"), source, "part_no", ("o_orderstatus", "o_orderpriority"))
    store.refresh()
    status = F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus"))
    changed = orders.where("part_no = 3").withColumn("o_orderstatus", status)
    changed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("part_no").parquet(source)
    recounted = store.refresh().count()
    return store.counts().drop("numeric_value").withColumn("recounted", F.lit(recounted))


@reg.query(
    _CTE
    + f"""select column_name, v is null as is_null, coalesce(v, '') as value_text,
  cast(min(try_cast(replace(v, ',', '.') as double)) as decimal(18,2)) as numeric_value, count(*) as row_count
from ({_MELT}) group by column_name, v"""
)
def facet_counts(spark, sf):
    counts = facets.facet_counts(_facet_table(spark, sf), [*_COLUMNS, "price"])
    return counts.withColumn("numeric_value", F.col("numeric_value").cast("decimal(18,2)"))


@reg.query(
    _CTE
    + """select v is null as is_null, coalesce(v, '') as value_text, row_count from (
  select cast(price as varchar) as v, count(*) as row_count from t group by 1)
order by v is null desc, value_text"""
)
def facet_top(spark, sf):
    return facets.facet_list(facets.facet_values(_facet_table(spark, sf), "price"))


@reg.query(
    _CTE
    + """select status is null as is_null, coalesce(status, '') as value_text, count(*) as row_count from t
where (coalesce(segment, '') = '' or segment = 'MACHINERY') and price < 200000 group by status"""
)
def facet_cross(spark, sf):
    return facets.facet_values(
        _facet_table(spark, sf),
        "status",
        {
            "status": _eq("F"),
            "segment": _eq("", "MACHINERY"),
            "price": [{"operator": "lt", "numeric_value": "200000"}],
        },
    )


@reg.query(
    """select false as is_null, text as value_text, count(*) as row_count from documents
where contains(lower(text), 'the,') group by text"""
)
def facet_search(spark, sf):
    documents = table(spark, sf, "documents")
    return facets.facet_values(documents, "text", search=" The,")


@reg.query(
    _CTE
    + """select 'between' as test, cast(price as varchar) as value_text, count(*) as row_count from t
where price between 150000 and 150500.5 group by price
union all select 'gt', cast(price as varchar), count(*) from t where price > 490000 group by price
union all select 'lt', cast(price as varchar), count(*) from t where price < 2000 group by price"""
)
def facet_numeric(spark, sf):
    rows = _facet_table(spark, sf)
    tests = {
        "between": {"operator": "between", "lower_value": "150000", "upper_value": "150500,5"},
        "gt": {"operator": "gt", "numeric_value": "490000"},
        "lt": {"operator": "lt", "numeric_value": "2000"},
    }
    parts = [
        facets.facet_values(rows, "price", numeric=spec).select(F.lit(name).alias("test"), "value_text", "row_count")
        for name, spec in tests.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


_STATE_SQL = """select concat('t', cast(o_custkey as {s})) as table_name,
  cast(max(o_orderkey) % 3 as {s}) as version_code,
  case when o_custkey % 5 = 0 then ' ' when o_custkey % 5 = 1 then null else cast(max(o_orderkey) % 4 as {s}) end
    as change_token
from orders group by o_custkey"""


@reg.query(
    f"""with cur as ({_STATE_SQL.format(s='varchar')}),
old as (select table_name, case when length(table_name) % 2 = 0 then version_code else '1 ' end as version_code,
  case when change_token = '2' then '3' when change_token is null then '' else change_token end as change_token
  from cur where version_code <> '2')
select cur.table_name, old.table_name is null as never_built from cur left join old using (table_name)
where old.table_name is null
  or nullif(trim(cur.version_code), '') is distinct from nullif(trim(old.version_code), '')
  or nullif(trim(cur.change_token), '') is distinct from nullif(trim(old.change_token), '')"""
)
def stale_tables(spark, sf):
    current = spark.sql(
        _STATE_SQL.format(s="string").replace("from orders", "from {orders}"), orders=table(spark, sf, "orders")
    )
    token = F.col("change_token")
    cached = current.where("version_code <> '2'").select(
        "table_name",
        F.when(F.length("table_name") % 2 == 0, F.col("version_code")).otherwise("1 ").alias("version_code"),
        F.when(token == "2", "3").when(token.isNull(), "").otherwise(token).alias("change_token"),
    )
    return facets.stale_tables(cached, current)


@reg.query(
    """select o_orderpriority, n, true as truncated from (
  select o_orderpriority, o_custkey, count(*) as n from orders group by 1, 2)
order by n desc, o_orderpriority, o_custkey limit 20"""
)
def sql_readonly(spark, sf):
    rows, truncated = facets.readonly_query(
        spark,
        """select o_orderpriority, n from (select o_orderpriority, o_custkey, count(*) as n
           from {orders} group by 1, 2) order by n desc, o_orderpriority, o_custkey""",
        20,
        orders=table(spark, sf, "orders"),
    )
    return rows.withColumn("truncated", F.lit(truncated))


@reg.query(
    _CTE
    + """select 'delete' as change, count(*) as rows_before,
  count(*) filter (where not coalesce(status = 'F' and price < 100000, false)) as rows_after,
  count(*) filter (where not coalesce(status = 'F' and price < 100000, false)) - count(*) as changed from t
union all select 'append', count(*), 2 * count(*), count(*) from t
union all select 'truncate', count(*), 0, -count(*) from t"""
)
def delete_where(spark, sf):
    before = materialize(_facet_table(spark, sf), "managed")
    after = {
        "delete": facets.delete_where(before, (F.col("status") == "F") & (F.col("price") < 100000)),
        "append": before.unionByName(before),
        "truncate": before.where("false"),
    }
    parts = [
        facets.row_change(before, df).select(F.lit(name).alias("change"), "rows_before", "rows_after", "changed")
        for name, df in after.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])
