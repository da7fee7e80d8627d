"""Recipe expansion and manifest queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar import layout, testbed
from rawstar.catalog.registry import Registry
from rawstar.functions import fields
from rawstar.operators import manifest, numbering, scope
from rawstar.plans import expand, recipes, staging
from rawstar.session import materialize
from rawstar.testbed import STAR_CTE, oracle

reg = Registry()


def _source(spark, sf):
    return materialize(staging.stage(testbed.raw(spark, sf)), "staging")


def _matched(source):
    return recipes.match_reference(source, materialize(recipes.dim_reference(source), "references"))


@reg.query(
    oracle(
        """select raw_id, id_column_1, datetime_column_1, text_column_2, numeric_column_2,
  coalesce(p.t, '') as text_column_4,
  cast(null as varchar) as absent
from base left join lp p on p.k + 1 = base.raw_id and p.n = 1"""
    )
)
def json_extract(spark, sf):
    keys = ["id_column_1", "datetime_column_1", "text_column_2", "numeric_column_2", "text_column_4", "absent"]
    return testbed.raw(spark, sf).select("raw_id", *[fields.field_text("raw", k).alias(k) for k in keys])


@reg.query(
    oracle(
        """select raw_id, cast(nullif(trim(id_column_1), '') as integer) as as_int,
  cast(nullif(trim(integer_column_1), '') as smallint) as as_small,
  cast(cast(nullif(trim(numeric_column_1), '') as decimal(33,15)) as decimal(18,2)) as as_numeric,
  cast(nullif(trim(text_column_1), '') as varchar) as as_text,
  cast(cast(datetime_column_1 as timestamptz) at time zone 'UTC' as timestamp) as as_utc from base"""
    )
)
def typed_cast(spark, sf):
    text = fields.parse_fields(
        testbed.raw(spark, sf),
        ["id_column_1", "integer_column_1", "numeric_column_1", "text_column_1", "datetime_column_1"],
        ["raw_id"],
    )
    return text.select(
        "raw_id",
        fields.typed(F.col("id_column_1"), "int").alias("as_int"),
        fields.typed(F.col("integer_column_1"), "smallint").alias("as_small"),
        fields.typed(F.col("numeric_column_1"), layout.NUMERIC).cast("decimal(18,2)").alias("as_numeric"),
        fields.trim_to_null(F.col("text_column_1")).alias("as_text"),
        fields.typed(F.col("datetime_column_1"), "timestamp").cast("timestamp_ntz").alias("as_utc"),
    )


@reg.query(oracle("select raw_id, raw_schema from base where raw_schema in ('group001', 'group003')"))
def scope_filter(spark, sf):
    return scope.in_scope(testbed.raw(spark, sf), ["group001", "group003"]).select("raw_id", "raw_schema")




@reg.query(
    oracle(
        """select base.raw_schema, count(*) as row_count from base
join (select raw_schema, min(raw_id) as first_version from base group by raw_schema) o using (raw_schema)
where (o.first_version, base.raw_schema) >= (
    select (min(raw_id), 'group002') from base where raw_schema = 'group002')
  and (o.first_version, base.raw_schema) <= (
    select (max(f), max_by(s, f)) from (select raw_schema as s, min(raw_id) as f from base group by 1))
group by base.raw_schema"""
    )
)
def scope_interval(spark, sf):
    raw = testbed.raw(spark, sf)
    ordered = materialize(raw.groupBy("raw_schema").agg(F.min("raw_id").alias("first_version")), "scopes")
    newest = ordered.agg(F.max_by("raw_schema", F.struct("first_version", "raw_schema"))).first()[0]
    interval = scope.scope_interval(ordered, "group002", newest)
    return scope.rows_of_interval(raw, interval).groupBy("raw_schema").agg(F.count(F.lit(1)).alias("row_count"))


@reg.query(oracle("select * from dim3", STAR_CTE))
def dim_reference(spark, sf):
    return recipes.dim_reference(staging.stage(testbed.raw(spark, sf), staging.recipe_uses("table3")))


@reg.query(oracle("select * from dim4", STAR_CTE))
def dim_code(spark, sf):
    return recipes.dim_code(staging.stage(testbed.raw(spark, sf), staging.recipe_uses("table4")))


@reg.query(oracle("select * from fact", STAR_CTE))
def fact_main(spark, sf):
    return recipes.fact_main(_matched(_source(spark, sf)))


@reg.query(oracle("select * from measure", STAR_CTE))
def child_measure(spark, sf):
    source = _source(spark, sf)
    table3 = materialize(recipes.dim_reference(source), "references")
    table1 = materialize(recipes.fact_main(recipes.match_reference(source, table3)), "facts")
    return recipes.child_measure(recipes.with_fact(source, table1))


@reg.query(oracle("select * from bridge", STAR_CTE))
def bridge_code(spark, sf):
    source = _source(spark, sf)
    return recipes.bridge_code(_matched(source), recipes.dim_code(source))


@reg.query(oracle("select * from slots", STAR_CTE))
def unpivot_positions(spark, sf):
    return recipes.unpivot_positions(_matched(_source(spark, sf)))


@reg.query(
    oracle(
        """select s.id_column_2 as raw_id, s.integer_column_1 as position, s.integer_column_2 as weight,
  s.text_column_1 as kind, s.integer_column_6 as gap, f.id_column_2 as owner, f.datetime_column_1 as local_time
from slots s join fact f on f.id_column_1 = s.id_column_2""",
        STAR_CTE,
    )
)
def unpivot_with_fact(spark, sf):
    """Flagship: each kept position with its fact row, both from one staging table."""
    matched = _matched(_source(spark, sf))
    facts = recipes.fact_main(matched).select(
        F.col("id_column_1").alias("raw_id"),
        F.col("id_column_2").alias("owner"),
        F.col("datetime_column_1").alias("local_time"),
    )
    slots = recipes.unpivot_positions(matched).select(
        F.col("id_column_2").alias("raw_id"),
        F.col("integer_column_1").alias("position"),
        F.col("integer_column_2").alias("weight"),
        F.col("text_column_1").alias("kind"),
        F.col("integer_column_6").alias("gap"),
    )
    return slots.join(facts, "raw_id")


@reg.query(
    oracle(
        """select 'table1' as table_name, count(*) as row_count, count(distinct id_column_1) as keys,
  cast(min(id_column_1) as bigint) as low, cast(max(id_column_1) as bigint) as high from fact
union all select 'table2', count(*), count(distinct id_column_1), min(id_column_1), max(id_column_1) from slots
union all select 'table3', count(*), count(distinct id_column_1), min(id_column_1), max(id_column_1) from dim3
union all select 'table4', count(*), count(distinct id_column_1), min(id_column_1), max(id_column_1) from dim4
union all select 'table5', count(*), count(distinct id_column_1), min(id_column_1), max(id_column_1) from measure
union all select 'table6', count(*), count(distinct id_column_1), min(id_column_1), max(id_column_1) from bridge""",
        STAR_CTE,
    )
)
def surrogate_keys(spark, sf):
    star = expand.plan_star(testbed.raw(spark, sf))
    # Distinct keys are counted by key groups first, so no task holds them all.
    parts = [
        df.groupBy("id_column_1")
        .agg(F.count(F.lit(1)).alias("n"))
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).cast("bigint").alias("row_count"),
            F.count("id_column_1").alias("keys"),
            F.min("id_column_1").cast("bigint").alias("low"),
            F.max("id_column_1").cast("bigint").alias("high"),
        )
        .select(F.lit(name).alias("table_name"), "row_count", "keys", "low", "high")
        for name, df in star.tables.items()
    ]
    return staging.union_parts(parts)


_COUNTS = """select 'table3' as destination, count(*) as row_count from dim3
union all select 'table4', count(*) from dim4 union all select 'table1', count(*) from fact
union all select 'table5', count(*) from measure union all select 'table6', count(*) from bridge
union all select 'table2', count(*) from slots"""


@reg.query(oracle(_COUNTS, STAR_CTE))
def expand_all_counts(spark, sf):
    return expand.plan_star(testbed.raw(spark, sf)).row_counts()


@reg.query(oracle(_COUNTS, STAR_CTE))
def expand_unstaged_counts(spark, sf):
    """The same run without the stored staging table."""
    # Six destinations parse the payload; the rows that hold it are derived once.
    records = materialize(testbed.raw(spark, sf), "records")
    return expand.plan_star(records, stored=False).row_counts()


@reg.query(
    oracle(
        f"""select destination, row_count from ({_COUNTS})
union all select 'source', count(*) from base
union all select 'total inserted', cast(sum(row_count) as bigint) from ({_COUNTS})""",
        STAR_CTE,
    )
)
def destination_counts(spark, sf):
    star = expand.plan_star(testbed.raw(spark, sf))
    counts = materialize(star.row_counts(), "counts")
    source = star.source.agg(F.count(F.lit(1)).alias("row_count"))
    total = counts.agg(F.sum("row_count").alias("row_count"))
    return counts.unionByName(source.select(F.lit("source").alias("destination"), "row_count")).unionByName(
        total.select(F.lit("total inserted").alias("destination"), "row_count")
    )


_WEIGHTS = " + ".join(
    f"coalesce(max(case when n = {p} then cast(nullif(trim(w), '') as decimal(18,2)) end), 0)" for p in range(1, 8)
)


@reg.query(
    oracle(
        f"""select b.raw_id, b.raw_schema, b.raw_hash, cast(nullif(trim(b.id_column_1), '') as integer) as id_column_1,
  b.text_column_2, cast(cast(b.numeric_column_2 as decimal(33,15)) as decimal(18,2)) as numeric_column_2,
  x.declared_1, cast(coalesce(x.total_weight, 0) as decimal(18,2)) as total_weight
from base b left join (
  select k, max(case when n = 1 then cast(nullif(trim(d), '') as smallint) end) as declared_1,
    {_WEIGHTS} as total_weight from lp group by k) x on x.k + 1 = b.raw_id"""
    )
)
def stage_typed(spark, sf):
    source = staging.stage(testbed.raw(spark, sf))
    total = sum(
        (F.coalesce(F.col(layout.weight_key(p)), F.lit(0).cast(layout.NUMERIC)) for p in layout.POSITIONS),
        F.lit(0).cast(layout.NUMERIC),
    )
    return source.select(
        *staging.SYSTEM_KEYS,
        "id_column_1",
        "text_column_2",
        F.col("numeric_column_2").cast("decimal(18,2)").alias("numeric_column_2"),
        F.col(layout.declared_key(1)).alias("declared_1"),
        total.cast("decimal(18,2)").alias("total_weight"),
    )


@reg.query(
    oracle(
        """select part, lo, hi, count(raw_id) as row_count from (
  select i as part, (select min(raw_id) from base) + ((select max(raw_id) - min(raw_id) + 1 from base) * i) // 4 as lo,
    (select min(raw_id) from base) + ((select max(raw_id) - min(raw_id) + 1 from base) * (i + 1)) // 4 - 1 as hi
  from range(4) t(i)) r left join base on raw_id between lo and hi group by part, lo, hi"""
    )
)
def range_buckets(spark, sf):
    raw = testbed.raw(spark, sf).select("raw_id")
    ends = raw.agg(F.min("raw_id").alias("lo"), F.max("raw_id").alias("hi")).first()
    ranges = spark.createDataFrame(
        [(i, lo, hi) for i, (lo, hi) in enumerate(staging.key_ranges(ends.lo, ends.hi, 4))],
        "part bigint, lo bigint, hi bigint",
    )
    counts = raw.groupBy(
        staging.range_number(F.col("raw_id"), F.lit(ends.lo), F.lit(ends.hi), 4).cast("bigint").alias("part")
    ).agg(F.count(F.lit(1)).alias("row_count"))
    return ranges.join(counts, "part")


@reg.query(oracle("select raw_id, raw_schema, raw_hash, raw_id % 4 as part from base"))
def union_all_parts(spark, sf):
    source = staging.stage(testbed.raw(spark, sf), [staging.FieldUse("id_column_1", "int")])
    stored = materialize(source.withColumn("part", F.col("raw_id") % 4), "parts")
    whole = staging.union_parts([stored.where(F.col("part") == p) for p in range(4)])
    return whole.select("raw_id", "raw_schema", "raw_hash", "part")


_GROUPS = "select raw_schema, raw_hash, count(*) as row_count from base group by raw_schema, raw_hash"


@reg.query(oracle(_GROUPS))
def manifest_groups(spark, sf):
    """Partial manifests per key range, then merged."""
    raw = testbed.raw(spark, sf)
    partial = raw.groupBy((F.col("raw_id") % 4).alias("part"), "raw_schema", "raw_hash").agg(
        F.count(F.lit(1)).alias("row_count")
    )
    return manifest.merge_manifests(partial)


@reg.query(
    oracle(
        f"""select cast(sum(row_count) as bigint) as expected_row_count,
  (select count(*) from (select distinct raw_hash from base)) as expected_distinct_raw_hash_count from ({_GROUPS})"""
    )
)
def manifest_totals(spark, sf):
    return manifest.manifest_totals(manifest.manifest_groups(testbed.raw(spark, sf)))


@reg.query(
    oracle(
        """select distinct concat('group00', cast(o_custkey % 7 as varchar)) as raw_schema from orders
where concat('group00', cast(o_custkey % 7 as varchar)) not in (select raw_schema from base)"""
    )
)
def missing_scope(spark, sf):
    requested = testbed.table(spark, sf, "orders").select(
        F.concat(F.lit("group00"), (F.col("o_custkey") % 7).cast("string")).alias("raw_schema")
    )
    return manifest.missing_scopes(manifest.manifest_groups(testbed.raw(spark, sf)), requested)


@reg.query(
    oracle(
        """select 'public.raw_data' as table_name, count(*) as row_count from base
union all select 'public.table1', count(*) from fact union all select 'public.table2', count(*) from slots
union all select 'public.empty', 0""",
        STAR_CTE,
    )
)
def row_counters(spark, sf):
    raw = materialize(testbed.raw(spark, sf), "records")
    tables = expand.plan_star(raw).tables
    return manifest.row_counters(
        {
            "public.raw_data": raw,
            "public.table1": tables["table1"],
            "public.table2": tables["table2"],
            "public.empty": raw.where("false"),
        }
    )
