"""Version, dictionary, upsert and chain queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar.catalog.registry import Registry
from rawstar.operators import scope, versions
from rawstar.testbed import table

reg = Registry()

# Orders stand for versions of 200 tables; the order key is the version number.
_VERS_SQL = """select o_orderkey as id, concat('t', cast(o_custkey % 200 as {s})) as table_name,
  lpad(cast(o_orderkey as {s}), cast(greatest(4, length(cast(o_orderkey as {s}))) as int), '0') as version_code,
  case when o_orderkey % 5 = 0 then null else concat('group', cast(o_orderkey % 9 as {s})) end as raw_schema,
  o_orderdate as created_at, concat('job', cast(o_orderkey % 50 as {s})) as job_id
from orders"""
_CTE = f"with v as ({_VERS_SQL.format(s='varchar')})\n"


def _versions(spark, sf):
    return spark.sql(
        _VERS_SQL.format(s="string").replace("from orders", "from {orders}"), orders=table(spark, sf, "orders")
    )


@reg.query(
    _CTE
    + """select t.table_name, case when m is null then '0000'
  else lpad(cast(m + 1 as varchar), cast(greatest(4, length(cast(m + 1 as varchar))) as int), '0') end as next_code
from (select distinct concat('t', cast(c_custkey % 300 as varchar)) as table_name from customer) t
left join (select table_name, max(cast(version_code as bigint)) as m from v group by table_name) using (table_name)"""
)
def next_version(spark, sf):
    names = table(spark, sf, "customer").select(
        F.concat(F.lit("t"), (F.col("c_custkey") % 300).cast("string")).alias("table_name")
    )
    return versions.next_versions(_versions(spark, sf), names)


@reg.query(
    _CTE
    + """select table_name, id, version_code, raw_schema, created_at, job_id
from (select *, max(id) over (partition by table_name) as newest from v) where id = newest"""
)
def latest_version(spark, sf):
    return versions.latest_versions(_versions(spark, sf))


@reg.query(_CTE + "select id, table_name, version_code, raw_schema, created_at, job_id from v where table_name = 't7'")
def version_history(spark, sf):
    return versions.history(_versions(spark, sf), "t7")


@reg.query(
    _CTE
    + """select table_name, raw_schema, min(cast(version_code as integer)) as first_version from v
where raw_schema is not null group by table_name, raw_schema"""
)
def registered_scopes(spark, sf):
    return scope.registered_scopes(_versions(spark, sf))


_NEW = "select distinct concat('job', cast(c_custkey % 60 as {s})) as job_id, concat('t', cast(c_custkey % 300 as {s})) as table_name from customer"


@reg.query(
    _CTE
    + f"""select n.job_id, n.table_name from ({_NEW.format(s='varchar')}) n
where not exists (select 1 from v where v.job_id = n.job_id and v.table_name = n.table_name)"""
)
def register_once(spark, sf):
    new = spark.sql(
        _NEW.format(s="string").replace("distinct ", "").replace("from customer", "from {customer}"),
        customer=table(spark, sf, "customer"),
    )
    return versions.register_once(_versions(spark, sf), new)


@reg.query(
    _CTE
    + """select table_name, n as versions, (select count(*) from lineitem where l_orderkey = first_id) as deps
from (select table_name, count(*) as n, min(id) as first_id from v group by table_name)"""
)
def dependency_counts(spark, sf):
    dependencies = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("table_version_id"))
    return versions.dependency_counts(_versions(spark, sf), dependencies)


_USAGE_SQL = """select distinct concat('t', cast(c_nationkey as {s})) as table_name,
  concat('c', cast(c_custkey % 40 as {s})) as column_name, concat('NATION_', cast(c_custkey % 20 as {s})) as standard_name
from customer"""
_COLUMNS_SQL = """select distinct concat('t', cast(s_nationkey as {s})) as table_name,
  concat('c', cast(s_suppkey % 50 as {s})) as column_name from supplier"""


def _links(spark, sf):
    usage = spark.sql(
        _USAGE_SQL.format(s="string").replace("from customer", "from {customer}"), customer=table(spark, sf, "customer")
    )
    columns = spark.sql(
        _COLUMNS_SQL.format(s="string").replace("from supplier", "from {supplier}"), supplier=table(spark, sf, "supplier")
    )
    return usage, columns


_U, _C = _USAGE_SQL.format(s="varchar"), _COLUMNS_SQL.format(s="varchar")


@reg.query(
    f"""select n_name as standard_name, count(u.standard_name) as usage_count from nation
left join ({_U}) u on u.standard_name = n_name group by n_name"""
)
def usage_counts(spark, sf):
    usage, _ = _links(spark, sf)
    return versions.usage_counts(table(spark, sf, "nation").select(F.col("n_name").alias("standard_name")), usage)


@reg.query(f"select u.* from ({_U}) u where (table_name, column_name) not in (select table_name, column_name from ({_C}))")
def link_orphans(spark, sf):
    usage, columns = _links(spark, sf)
    return versions.link_orphans(usage, columns)


@reg.query(f"select c.* from ({_C}) c where (table_name, column_name) not in (select table_name, column_name from ({_U}))")
def unlinked_columns(spark, sf):
    usage, columns = _links(spark, sf)
    return versions.unlinked_columns(columns, usage)


@reg.query(
    """with new as (select o_custkey as key, max(o_orderkey) as k, max_by(o_orderpriority, o_orderkey) as label
  from orders group by o_custkey having max(o_orderkey) % 2 = 0),
old as (select c_custkey * 2 as key, c_mktsegment as label, c_custkey as k from customer)
select key, label, k from new union all select key, label, k from old where key not in (select key from new)"""
)
def upsert_by_key(spark, sf):
    stored = table(spark, sf, "customer").select(
        (F.col("c_custkey") * 2).alias("key"), F.col("c_mktsegment").alias("label"), F.col("c_custkey").alias("k")
    )
    orders = table(spark, sf, "orders")
    even = orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("last")).where("last % 2 = 0").select("o_custkey")
    new = orders.join(even, "o_custkey", "left_semi").select(
        F.col("o_custkey").alias("key"), F.col("o_orderpriority").alias("label"), F.col("o_orderkey").alias("k")
    )
    return versions.upsert(stored, new, ["key"], order="k")


@reg.query(
    """with recursive e as (select p_partkey as child, p_partkey // 2 as parent from part where p_partkey >= 10),
walk as (select child, parent as top from e union all
  select w.child, e.parent from walk w join e on e.child = w.top)
select child, top as root from walk where top < 10"""
)
def resolve_chain(spark, sf):
    edges = table(spark, sf, "part").where("p_partkey >= 10").select(
        F.col("p_partkey").alias("child"), F.expr("p_partkey div 2").alias("parent")
    )
    return versions.resolve_chain(edges)


# Three keys of every fifty form a cycle; others may lead into one.
_CYCLES = """select p_partkey as child, case when p_partkey % 50 in (0, 1) then p_partkey + 1
  when p_partkey % 50 = 2 then p_partkey - 2 else p_partkey // 2 end as parent from part where p_partkey >= 10"""


@reg.query(
    f"""with e as ({_CYCLES})
select a.child as member from e a join e b on b.child = a.parent join e c on c.child = b.parent where c.parent = a.child"""
)
def chain_cycles(spark, sf):
    edges = spark.sql(_CYCLES.replace("//", "div").replace("from part", "from {part}"), part=table(spark, sf, "part"))
    return versions.cycle_members(edges)
