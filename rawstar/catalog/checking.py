"""Constraint check queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar import layout, testbed
from rawstar.catalog.registry import Registry
from rawstar.functions.fields import trim_to_null, upper_trim
from rawstar.operators import checks
from rawstar.testbed import oracle, table

reg = Registry()


@reg.query(
    """select l_orderkey, line, count(*) as row_count from (
  select l_orderkey, case when l_linenumber = 7 then null else l_linenumber end as line from lineitem)
where line is not null group by l_orderkey, line having count(*) > 1"""
)
def unique_violations(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("line")
    )
    return checks.unique_violations(lines, ["l_orderkey", "line"])


@reg.query(
    """select l_orderkey, line, count(*) as row_count from (
  select l_orderkey, case when l_linenumber = 7 then null else l_linenumber end as line from lineitem)
group by l_orderkey, line having count(*) > 1 or line is null"""
)
def primary_key_violations(spark, sf):
    lines = table(spark, sf, "lineitem").select(
        "l_orderkey", F.when(F.col("l_linenumber") != 7, F.col("l_linenumber")).alias("line")
    )
    return checks.primary_key_violations(lines, ["l_orderkey", "line"])


@reg.query(
    """select 'when set' as rule, other as key, count(*) as row_count from (
  select case when o_orderkey % 3 = 0 then null else o_custkey * 10 + o_orderkey % 2 end as other from orders)
where other is not null group by other having count(*) > 1
union all
select 'when null', o_custkey, count(*) from orders where o_orderkey % 3 = 0 group by o_custkey having count(*) > 1"""
)
def partial_unique_violations(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("main"),
        F.when(F.col("o_orderkey") % 3 != 0, F.col("o_custkey") * 10 + F.col("o_orderkey") % 2).alias("other"),
    )
    set_ = checks.unique_violations(rows, ["other"], F.col("other").isNotNull())
    unset = checks.unique_violations(rows, ["main"], F.col("other").isNull())
    return set_.select(F.lit("when set").alias("rule"), F.col("other").alias("key"), "row_count").unionByName(
        unset.select(F.lit("when null").alias("rule"), F.col("main").alias("key"), "row_count")
    )


@reg.query(
    """select part_id, count(*) as row_count from (
  select case when (l_orderkey + l_linenumber) % 97 = 0 then -1 - l_partkey
    when (l_orderkey + l_linenumber) % 89 = 0 then null else l_partkey end as part_id from lineitem)
where part_id is not null and part_id not in (select p_partkey from part) group by part_id"""
)
def fk_orphans(spark, sf):
    mark = F.col("l_orderkey") + F.col("l_linenumber")
    lines = table(spark, sf, "lineitem").select(
        F.when(mark % 97 == 0, -1 - F.col("l_partkey")).when(mark % 89 != 0, F.col("l_partkey")).alias("part_id")
    )
    return checks.fk_orphans(lines, ["part_id"], table(spark, sf, "part"), ["p_partkey"])


@reg.query(
    oracle(
        """select k, n, kind from (select k, n, case when (k + n) % 19 = 0 then null else upper(trim(t)) end as kind from lp)
where kind not in ('X', 'Y', 'Z')"""
    )
)
def check_violations(spark, sf):
    kinds = testbed.positions(spark, sf).select(
        "k", "n", F.when((F.col("k") + F.col("n")) % 19 != 0, upper_trim(F.col("t"))).alias("kind")
    )
    allowed = F.col("kind").isNull() | F.col("kind").isin(layout.KIND_TOKENS)
    return checks.check_violations(kinds, allowed)


@reg.query(
    oracle(
        """select k, n, nullif(trim(d), '') as declared, nullif(trim(w), '') as weight from lp
where nullif(trim(d), '') is null or nullif(trim(w), '') is null"""
    )
)
def not_null_violations(spark, sf):
    rows = testbed.positions(spark, sf).select(
        "k", "n", trim_to_null(F.col("d")).alias("declared"), trim_to_null(F.col("w")).alias("weight")
    )
    return checks.not_null_violations(rows, ["declared", "weight"])


@reg.query(
    oracle(
        """select 'declared' as column_name, count(*) as null_count from lp where nullif(trim(d), '') is null
union all select 'weight', count(*) from lp where nullif(trim(w), '') is null"""
    )
)
def null_counts(spark, sf):
    rows = testbed.positions(spark, sf).select(
        trim_to_null(F.col("d")).alias("declared"), trim_to_null(F.col("w")).alias("weight")
    )
    return checks.null_counts(rows, ["declared", "weight"])


@reg.query(
    """with c as (select distinct 'orders.o_custkey' as child, o_custkey as v from orders
  union all select distinct 'lineitem.l_partkey', l_partkey from lineitem
  union all select distinct 'lineitem.l_suppkey', l_suppkey from lineitem
  union all select distinct 'customer.c_nationkey', c_nationkey from customer),
p as (select 'customer.c_custkey' as parent, c_custkey as v from customer
  union all select 'part.p_partkey', p_partkey from part
  union all select 'supplier.s_suppkey', s_suppkey from supplier
  union all select 'nation.n_nationkey', n_nationkey from nation)
select child, parent, count(*) as distinct_values, count(m) as matched, count(*) - count(m) as missing from (
  select c.child, n.parent, c.v, p.v as m from c cross join (select distinct parent from p) n
  left join p on p.parent = n.parent and p.v = c.v) group by child, parent"""
)
def inclusion_profile(spark, sf):
    def column(name, key):
        return table(spark, sf, name), key

    return checks.inclusion_profile(
        {
            "orders.o_custkey": column("orders", "o_custkey"),
            "lineitem.l_partkey": column("lineitem", "l_partkey"),
            "lineitem.l_suppkey": column("lineitem", "l_suppkey"),
            "customer.c_nationkey": column("customer", "c_nationkey"),
        },
        {
            "customer.c_custkey": column("customer", "c_custkey"),
            "part.p_partkey": column("part", "p_partkey"),
            "supplier.s_suppkey": column("supplier", "s_suppkey"),
            "nation.n_nationkey": column("nation", "n_nationkey"),
        },
    )


@reg.query(
    """with gone_c as (select c_custkey from customer where c_acctbal < 0),
gone_o as (select o_orderkey from orders where o_custkey in (select c_custkey from gone_c))
select 'orders' as table_name, count(*) as kept from orders where o_orderkey not in (select o_orderkey from gone_o)
union all select 'lineitem', count(*) from lineitem where l_orderkey not in (select o_orderkey from gone_o)"""
)
def cascade_delete(spark, sf):
    customers = table(spark, sf, "customer").where("c_acctbal < 0")
    kept = checks.cascade_delete(
        customers,
        "c_custkey",
        [
            ("orders", table(spark, sf, "orders"), "o_custkey", "o_orderkey"),
            ("lineitem", table(spark, sf, "lineitem"), "l_orderkey", "l_orderkey"),
        ],
    )
    counts = [df.agg(F.count(F.lit(1)).alias("kept")).select(F.lit(n).alias("table_name"), "kept") for n, df in kept.items()]
    return counts[0].unionByName(counts[1])
