"""Digest, difference, resume and streaming queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar import layout, testbed
from rawstar.catalog.registry import Registry
from rawstar.operators import compare, hashtree
from rawstar.plans import expand, recipes, resume, staging
from rawstar.session import materialize, scratch_path
from rawstar.sources.snapshots import path_exists
from rawstar.streaming import expanding, ingest
from rawstar.testbed import RAW_CTE, STAR_CTE, oracle, table

reg = Registry()


def _digest_sql(name: str, select: str, columns: list[str]) -> str:
    row = "json_object(" + ", ".join(f"'{c}', {c}" for c in columns) + ")"
    return f"""select '{name}' as table_name, count(*) as row_count,
  case when count(*) = 0 then 'empty' else md5(concat(cast(count(*) as varchar), ':',
    cast(sum(cast('0x' || substr(d, 1, 15) as bigint)) as varchar), ':',
    cast(bit_xor(cast('0x' || substr(d, 16, 15) as bigint)) as varchar))) end as digest
from (select md5(cast({row} as varchar)) as d from ({select}))"""


def _plain(df):
    """Decimals and timestamps as text, so both engines write the same JSON."""
    casts = {}
    for field in df.schema:
        kind = field.dataType.typeName()
        if kind == "decimal":
            casts[field.name] = F.col(field.name).cast("string")
        if kind == "timestamp_ntz":
            casts[field.name] = F.date_format(field.name, "yyyy-MM-dd HH:mm:ss")
    return df.withColumns(casts) if casts else df


_CONTENT_SQL = {
    "table3": (
        "select text_column_1, text_column_2, cast(numeric_column_1 as varchar) as numeric_column_1, text_column_3, "
        "text_column_4 from dim3",
        ["text_column_1", "text_column_2", "numeric_column_1", "text_column_3", "text_column_4"],
    ),
    "table4": ("select * from dim4", ["id_column_1", "text_column_1", "text_column_2"]),
    "table5": (
        "select cast(numeric_column_1 as varchar) as numeric_column_1, cast(numeric_column_2 as varchar) as "
        "numeric_column_2, integer_column_1, integer_column_2, id_column_3, id_column_2 as raw_id from measure",
        ["numeric_column_1", "numeric_column_2", "integer_column_1", "integer_column_2", "id_column_3", "raw_id"],
    ),
    "table6": ("select id_column_3, id_column_2 as raw_id from bridge", ["id_column_3", "raw_id"]),
    "table2": (
        "select *, id_column_2 as raw_id from slots",
        [
            "integer_column_1",
            "integer_column_2",
            "text_column_1",
            "integer_column_3",
            "integer_column_4",
            "integer_column_5",
            "integer_column_6",
            "raw_id",
        ],
    ),
    "table1": (
        "select f.* exclude (datetime_column_1), strftime(f.datetime_column_1, '%Y-%m-%d %H:%M:%S') as datetime_column_1, "
        "f.id_column_3 as raw_id, r.text_column_1 as d1, r.text_column_2 as d2, r.text_column_3 as d3, "
        "r.text_column_4 as d4, cast(r.numeric_column_1 as varchar) as dn from fact f "
        "left join dim3 r on r.id_column_1 = f.id_column_4",
        None,
    ),
}
_FACT = [
    c.split()[0]
    for c in layout.DESTINATION_COLUMNS["table1"].split(", ")
    if c.split()[0] not in ("id_column_1", "id_column_4")
]
_FACT_JSON = ", ".join(
    f"'{'raw_id' if c == 'id_column_3' else c}', {'raw_id' if c == 'id_column_3' else c}" for c in _FACT
) + ", 'd_text_column_1', d1, 'd_text_column_2', d2, 'd_text_column_3', d3, 'd_text_column_4', d4, 'd_numeric_column_1', dn"


def _table_digest(name: str) -> str:
    select, columns = _CONTENT_SQL[name]
    sql = _digest_sql(name, select, columns or ["raw_id"])
    return sql if columns else sql.replace("json_object('raw_id', raw_id)", f"json_object({_FACT_JSON})")


@reg.query(
    oracle(
        " union all ".join(_table_digest(n) for n in _CONTENT_SQL)
        + " union all select 'none', 0, 'empty'",
        STAR_CTE,
    )
)
def logical_digest(spark, sf):
    star = expand.plan_star(testbed.raw(spark, sf))
    content = {n: _plain(df) for n, df in compare.star_content(star.tables).items()}
    content["none"] = content["table4"].where("false")
    return compare.digests(content)


_OLD = "select o_orderkey, o_orderstatus, o_orderpriority from orders"
_NEW = """select o_orderkey + case when o_orderkey % 501 = 0 then 1000000000 else 0 end as o_orderkey,
  case when o_orderkey % 77 = 0 then null else o_orderstatus end as o_orderstatus,
  case when o_orderkey % 91 = 0 then '9-NEW' else o_orderpriority end as o_orderpriority from orders"""


def _pair(spark, sf):
    orders = table(spark, sf, "orders")
    return tuple(spark.sql(q.replace("from orders", "from {orders}"), orders=orders) for q in (_OLD, _NEW))


@reg.query(
    f"""with a as ({_OLD}), b as ({_NEW})
select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
  case when b.o_orderkey is null then 'only left' when a.o_orderkey is null then 'only right' else 'changed' end as status,
  case when a.o_orderkey is not null and b.o_orderkey is not null then
    case when a.o_orderstatus is distinct from b.o_orderstatus and a.o_orderpriority is distinct from b.o_orderpriority
      then 'o_orderstatus,o_orderpriority'
    when a.o_orderstatus is distinct from b.o_orderstatus then 'o_orderstatus' else 'o_orderpriority' end end as changed
from a full join b on a.o_orderkey = b.o_orderkey
where a.o_orderkey is null or b.o_orderkey is null or a.o_orderstatus is distinct from b.o_orderstatus
  or a.o_orderpriority is distinct from b.o_orderpriority"""
)
def table_diff(spark, sf):
    old, new = _pair(spark, sf)
    return compare.keyed_difference(old, new, ["o_orderkey"])


# Keys are compared by ranges of 500; changes, losses and additions are in some of them.
_RANGED = """select o_orderkey, case when (o_orderkey // 500) % 5 = 2 and o_orderkey % 7 = 0 then null else o_orderstatus end as o_orderstatus,
  o_orderpriority from orders where not ((o_orderkey // 500) % 7 = 3 and o_orderkey % 90 = 1)
union all select max(o_orderkey) + 600, 'N', null from orders"""


@reg.query(
    f"""with a as ({_OLD}), b as ({_RANGED}),
d as (
  select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
    case when b.o_orderkey is null then 'only left' when a.o_orderkey is null then 'only right' else 'changed' end as status,
    case when a.o_orderkey is not null and b.o_orderkey is not null then 'o_orderstatus' end as changed
  from a full join b on a.o_orderkey = b.o_orderkey
  where a.o_orderkey is null or b.o_orderkey is null or a.o_orderstatus is distinct from b.o_orderstatus)
select *, (select count(distinct o_orderkey // 500) from d) as ranges_read from d"""
)
def hash_tree_difference(spark, sf):
    """Two stored versions of a table; the rows of ranges with equal digests are not read."""
    orders = table(spark, sf, "orders")
    sides = []
    for text in (_OLD, _RANGED.replace("//", "div")):
        side = hashtree.RangedTable(spark, scratch_path(spark, "ranged"), "o_orderkey", span=500, fanout=4)
        side.write(spark.sql(text.replace("from orders", "from {orders}"), orders=orders))
        sides.append(side)
    read = materialize(hashtree.differing_ranges(*sides), "ranges").count()
    return hashtree.tree_difference(*sides).withColumn("ranges_read", F.lit(read).cast("bigint"))


@reg.query(
    f"""with a as (select o_orderstatus, o_orderpriority from ({_OLD})),
b as (select o_orderstatus, o_orderpriority from ({_NEW}))
select o_orderstatus, o_orderpriority, cast(sum(l) as bigint) as left_count, cast(sum(r) as bigint) as right_count
from (select *, 1 as l, 0 as r from a union all select *, 0, 1 from b) group by 1, 2 having sum(l) <> sum(r)"""
)
def table_row_difference(spark, sf):
    old, new = (df.drop("o_orderkey") for df in _pair(spark, sf))
    return compare.row_difference(old, new)


_RANGE = "((raw_id - lo + 1) * 4 - 1) // (hi - lo + 1)"


@reg.query(
    oracle(
        f"""select part, lo, hi, n as rows, case when part = 3 then null when part = 2 then n - 1 else n end as found,
  part < 2 as reuse from (
  select cast({_RANGE} as integer) as part, min(raw_id) as lo, max(raw_id) as hi, count(*) as n
  from base, (select min(raw_id) as lo, max(raw_id) as hi from base) group by 1)"""
    )
)
def resume_plan(spark, sf):
    """Four staged ranges: two complete, one a row short, one not there."""
    raw = testbed.raw(spark, sf).select("raw_id")
    ends = raw.agg(F.min("raw_id").alias("lo"), F.max("raw_id").alias("hi")).first()
    part = staging.range_number(F.col("raw_id"), F.lit(ends.lo), F.lit(ends.hi), 4)
    counted = materialize(
        raw.groupBy(part.alias("part")).agg(
            F.min("raw_id").alias("lo"), F.max("raw_id").alias("hi"), F.count(F.lit(1)).alias("rows")
        ),
        "ranges",
    )
    stored = counted.where("part < 3").select("part", (F.col("rows") - (F.col("part") == 2).cast("int")).alias("rows"))
    return resume.resume_plan(counted, stored)


def _arrive(rows, incoming, files):
    """Append ``rows`` as ``files`` files, or as one for each split if there are more; returns how many were added.

    So a file, and a task, holds no more of a larger table.
    """
    wide = rows.rdd.getNumPartitions() >= files
    before = _files(rows.sparkSession, incoming)
    (rows if wide else rows.repartition(files)).write.mode("append").parquet(incoming)
    return _files(rows.sparkSession, incoming) - before


def _files(spark, path):
    return len(spark.read.schema(layout.RAW_SCHEMA).parquet(path).inputFiles()) if path_exists(spark, path) else 0


def _share(files, batches):
    """Files of a batch, if ``files`` are to come in so many batches."""
    return max(1, -(-files // batches))


@reg.query(oracle("select raw_id, raw_schema, raw_hash, raw_tab from base"))
def stream_ingest(spark, sf):
    """Files arrive in two steps; the second run takes only the new ones."""
    incoming, out, checkpoint = (scratch_path(spark, n) for n in ("incoming", "streamed", "stream-state"))
    records = materialize(testbed.raw(spark, sf), "records")
    for step in (0, 1):
        files = _arrive(records.where(F.col("raw_id") % 2 == step), incoming, 2)
        stored = ingest.ingest_available(spark, incoming, out, checkpoint, files_per_batch=_share(files, 2))
    return stored.select("raw_id", "raw_schema", "raw_hash", "raw_tab")


@reg.query(
    oracle(
        """select 'table2' as table_name, count(*) as row_count, cast(sum(integer_column_2) as bigint) as total from slots
union all select 'table1', count(*), cast(sum(integer_column_1) as bigint) from fact""",
        STAR_CTE,
    )
)
def stream_stage(spark, sf):
    """Recipes over a staging table that a stream filled."""
    incoming, out, checkpoint = (scratch_path(spark, n) for n in ("incoming", "staged", "stream-state"))
    files = _arrive(materialize(testbed.raw(spark, sf), "records"), incoming, 3)
    source = ingest.stage_available(spark, incoming, out, checkpoint, files_per_batch=_share(files, 2))
    matched = recipes.match_reference(source, materialize(recipes.dim_reference(source), "references"))

    def totals(name, df, column):
        return df.agg(F.count(F.lit(1)).alias("row_count"), F.sum(column).alias("total")).select(
            F.lit(name).alias("table_name"), "row_count", "total"
        )

    return totals("table2", recipes.unpivot_positions(matched), "integer_column_2").unionByName(
        totals("table1", recipes.fact_main(matched), "integer_column_1")
    )


# The star with rows broken by key, and what each rule must find.
_BROKEN = f"""{STAR_CTE},
t1 as (
  select * replace (case when id_column_1 % 89 = 0 then null when id_column_1 % 83 = 0 then -1 else id_column_3 end as id_column_3)
  from fact where id_column_1 % 97 <> 0),
t2 as (
  select * replace (case when id_column_1 % 41 = 0 then 'Q' else text_column_1 end as text_column_1) from slots
  union all select * from slots where id_column_1 % 50 = 0),
t3 as (select * from dim3 where id_column_1 > 1),
t4 as (select * from dim4 where id_column_1 <> 5),
t5 as (
  select * replace (case when id_column_1 % 13 = 0 then null else id_column_2 end as id_column_2,
                    case when id_column_1 % 10 = 0 then 7 end as id_column_3)
  from measure),
t6 as (select * replace (case when id_column_1 % 70 < 2 then id_column_1 // 70 else id_column_1 end as id_column_1) from bridge)"""


def _repeated(name: str, table: str, keys: str, where: str = "true") -> str:
    known = " and ".join(f"{k} is not null" for k in keys.split(", "))
    return f"select '{name}' as rule, count(*) as violations from (select {keys} from {table} where {known} and {where} group by {keys} having count(*) > 1)"


def _failing(name: str, table: str, failing: str) -> str:
    return f"select '{name}', count(*) from {table} where {failing}"


def _orphans(name: str, table: str, column: str, parent: str) -> str:
    return f"select '{name}', count(distinct {column}) from {table} where {column} not in (select id_column_1 from {parent})"


_RULES = [
    *[_repeated(f"table{i} primary key", f"t{i}", "id_column_1") for i in range(1, 7)],
    *[_failing(f"table{i} primary key set", f"t{i}", "id_column_1 is null") for i in range(1, 7)],
    _repeated("table1 source row unique", "t1", "id_column_3"),
    _failing("table1 source row set", "t1", "id_column_3 is null"),
    _orphans("table1 reference", "t1", "id_column_4", "t3"),
    _repeated("table2 position unique", "t2", "id_column_2, integer_column_1"),
    _failing("table2 set", "t2", "id_column_2 is null or integer_column_1 is null"),
    _failing("table2 kind", "t2", "text_column_1 not in ('X', 'Y', 'Z')"),
    _repeated("table5 one per fact", "t5", "id_column_2", "id_column_3 is null"),
    _repeated("table5 other id", "t5", "id_column_3"),
    _repeated("table6 pair unique", "t6", "id_column_2, id_column_3"),
    _orphans("table6 code", "t6", "id_column_3", "t4"),
    *[_orphans(f"table{i} fact", f"t{i}", "id_column_2", "t1") for i in (2, 5, 6)],
    *[_failing(f"table{i} fact set", f"t{i}", "id_column_2 is null") for i in (2, 5, 6)],
]


def _broken(tables):
    t1, t2, t3, t4, t5, t6 = (tables[f"table{i}"] for i in range(1, 7))
    key, ref = F.col("id_column_1"), F.col("id_column_2")
    source_row = F.when(key % 89 == 0, None).when(key % 83 == 0, -1).otherwise(F.col("id_column_3"))
    return {
        "table1": t1.where(key % 97 != 0).withColumn("id_column_3", source_row),
        "table2": t2.withColumn("text_column_1", F.when(key % 41 == 0, "Q").otherwise(F.col("text_column_1"))).union(
            t2.where(key % 50 == 0)
        ),
        "table3": t3.where(key > 1),
        "table4": t4.where(key != 5),
        "table5": t5.withColumn("id_column_2", F.when(key % 13 != 0, ref)).withColumn(
            "id_column_3", F.when(key % 10 == 0, 7).cast("bigint")
        ),
        "table6": t6.withColumn("id_column_1", F.when(key % 70 < 2, F.call_function("div", key, F.lit(70))).otherwise(key)),
    }


def _published(spark, sf, parts=2):
    records = materialize(testbed.raw(spark, sf), "records")
    run = resume.Run(spark, scratch_path(spark, "job"), "public.raw_data", ["group001", "group002", "group003"], parts)
    run.execute(records)
    return records, run


@reg.query(oracle(" union all ".join(_table_digest(n) for n in _CONTENT_SQL), STAR_CTE))
def stream_expand(spark, sf):
    """Raw files arrive in two steps of two batches; every batch is taken twice, as after a failure."""
    incoming, base, state = (scratch_path(spark, n) for n in ("incoming", "streamed-star", "stream-state"))
    records = materialize(testbed.raw(spark, sf), "records")

    class Replayed(expanding.StreamedStar):
        def take(self, raw_rows, batch):
            super().take(raw_rows, batch)
            super().take(raw_rows, batch)

    star = Replayed(spark, base)
    for step in (0, 1):
        files = _arrive(records.where(F.col("raw_id") % 2 == step), incoming, 2)
        expanding.expand_available(spark, incoming, base, state, files_per_batch=_share(files, 2), star=star)
    return compare.digests({n: _plain(df) for n, df in compare.star_content(star.tables()).items()})


@reg.query(oracle("\nunion all ".join(_RULES), _BROKEN))
def star_checks(spark, sf):
    """A published run end to end, then its tables with rows broken by key."""
    _, run = _published(spark, sf)
    return resume.star_problems(_broken(run.tables()))


_CHANGED = (
    RAW_CTE.replace("base as (", "base0 as (", 1)
    + """,
base as (
  select * replace (case when raw_id * 5 <= (select max(raw_id) from base0) then '' else text_column_3 end as text_column_3)
  from base0)"""
    + STAR_CTE[len(RAW_CTE) :]
)
_STAR_TABLES = {"table1": "fact", "table2": "slots", "table3": "dim3", "table4": "dim4", "table5": "measure", "table6": "bridge"}


@reg.query(
    "with " + _CHANGED + "\n"
    + "\nunion all ".join(
        f"select '{name}' as table_name, count(*) as row_count, cast(coalesce(sum(id_column_1), 0) as bigint) as key_sum, "
        f"2 as versions, 1 as restaged from {cte}"
        for name, cte in _STAR_TABLES.items()
    )
)
def rerun_changed_payload(spark, sf):
    """Run, blank one header in the first fifth of the rows, run again: one of four ranges is staged anew."""
    records, run = _published(spark, sf, parts=4)
    last = records.agg(F.max("raw_id")).first()[0]
    blank = F.regexp_replace("raw", '"text_column_3":"[^"]*"', '"text_column_3":""')
    changed = materialize(records.withColumn("raw", F.when(F.col("raw_id") * 5 <= last, blank).otherwise(F.col("raw"))), "changed")
    restaged = sum(not p.reuse for p in run.survey(changed).parts)
    run.execute(changed)
    versions = run._versions().groupBy("table_name").agg(F.count(F.lit(1)).cast("int").alias("versions"))
    counted = staging.union_parts(
        [
            df.agg(F.count(F.lit(1)).alias("row_count"), F.coalesce(F.sum("id_column_1"), F.lit(0)).cast("bigint").alias("key_sum"))
            .select(F.lit(name).alias("table_name"), "row_count", "key_sum")
            for name, df in run.tables().items()
        ]
    )
    return counted.join(versions, "table_name").withColumn("restaged", F.lit(restaged))
