"""Inputs derived from the given tables, as the same SQL text for Spark and the oracle.

``{s}`` is the engine's string type. Blanks, padding, lower case and bad tokens
are put in by key, so that every predicate sees rows that pass and rows that fail.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawstar import layout


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


POSITION_SQL = """
select l_orderkey as k, l_linenumber as n,
  case when (l_orderkey + l_linenumber) % 11 = 0 then '' else cast(l_linenumber as {s}) end as d,
  case when (l_orderkey + l_linenumber) % 13 = 0 then 'W'
       when min(l_returnflag) = 'R' then ' x ' when min(l_returnflag) = 'A' then 'Y' else 'z' end as t,
  case when (l_orderkey + l_linenumber) % 17 = 0 then ''
       else cast(sum(cast(l_quantity as decimal(18,2))) as {s}) end as w,
  case when (l_orderkey + l_linenumber) % 5 = 0 then ''
       else cast(max(cast(l_discount as decimal(18,2))) as {s}) end as g
from lineitem group by l_orderkey, l_linenumber
"""

BASE_SQL = """
select o_orderkey + 1 as raw_id,
  case when o_orderkey % 101 = 0 then null else concat('h', cast(o_orderkey % 4 as {s})) end as raw_hash,
  o_orderdate as raw_ingested_at,
  concat('group00', cast(1 + o_custkey % 3 as {s})) as raw_schema,
  'Sheet1' as raw_tab,
  case when o_orderkey % 5 = 0 then concat('  ', cast(o_custkey as {s}), ' ') else cast(o_custkey as {s}) end
    as id_column_1,
  case when o_orderkey % 19 = 0 then '  ' else '123ABC4567' end as text_column_1,
  concat(cast(timestamp '2024-04-01 00:00:00' + o_orderkey * interval '1' second as {s}), '-03')
    as datetime_column_1,
  case when o_orderkey % 17 = 0 then '' when o_orderkey % 23 = 0 then '0'
       else cast(o_custkey % 120 as {s}) end as integer_column_1,
  case o_orderkey % 6 when 0 then 'CA' when 1 then 'cb' when 2 then ' DA ' when 3 then 'DB'
       when 4 then 'X1' else '' end as text_column_2,
  cast(cast(o_totalprice as decimal(18,2)) as {s}) as numeric_column_1,
  case when o_orderkey % 31 = 0 then 'A'
       when o_orderkey % 7 = 0 then concat(chr(cast(97 + o_custkey % 3 as int)), chr(cast(65 + o_orderkey % 26 as int)))
       else concat(chr(cast(65 + o_custkey % 3 as int)), chr(cast(65 + o_orderkey % 26 as int))) end
    as text_column_3,
  case when o_orderkey % 29 = 0 then '0' else cast(cast(o_totalprice as decimal(18,2)) as {s}) end
    as numeric_column_2
from orders
"""


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of ``POSITION_SQL``, aggregated in fixed-width buffers after one shuffle by order.

    A least flag needs no text in the buffer: it is ``R`` if there is an ``R`` and nothing below it.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("n"), "l_returnflag", "l_quantity", "l_discount"
    )
    flag, number = F.col("l_returnflag"), F.col("k") + F.col("n")

    def least(value: str) -> Column:
        return F.bool_or(flag == value) & ~F.bool_or(flag < value)

    grouped = lines.repartition("k").groupBy("k", "n").agg(
        least("R").alias("_r"),
        least("A").alias("_a"),
        F.sum(F.col("l_quantity").cast("decimal(18,2)")).alias("_w"),
        F.max(F.col("l_discount").cast("decimal(18,2)")).alias("_g"),
    )
    return grouped.select(
        "k",
        "n",
        F.when(number % 11 == 0, "").otherwise(F.col("n").cast("string")).alias("d"),
        F.when(number % 13 == 0, "W").when(F.col("_r"), " x ").when(F.col("_a"), "Y").otherwise("z").alias("t"),
        F.when(number % 17 == 0, "").otherwise(F.col("_w").cast("string")).alias("w"),
        F.when(number % 5 == 0, "").otherwise(F.col("_g").cast("string")).alias("g"),
    )


def raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table: one row per order, 64 payload headers, lines in the position slots."""
    base = spark.sql(
        BASE_SQL.format(s="string").replace("from orders", "from {orders}"),
        orders=table(spark, sf_dir, "orders"),
    )
    # At most one entry per line number, so the map of an order is small.
    pivoted = (
        positions(spark, sf_dir)
        .groupBy("k")
        .agg(F.map_from_entries(F.collect_list(F.struct("n", F.struct("d", "t", "w", "g")))).alias("slots"))
    )
    # Joined by the key the lines are grouped by, so that only orders are shuffled for it.
    joined = base.join(pivoted, F.col("raw_id") - 1 == F.col("k"), "left")
    blank = F.struct(*[F.lit("").alias(c) for c in "dtwg"])
    slots = {p: F.coalesce(F.try_element_at("slots", F.lit(p)), blank) for p in layout.POSITIONS}
    placed = joined.select(base["*"], *[slot.alias(f"_slot{p}") for p, slot in slots.items()])
    values = [F.col(key) for key in layout.SINGLE_KEYS]
    for p in layout.POSITIONS:
        values += [F.col(f"_slot{p}.{c}").alias(key) for c, key in zip("dtwg", layout.position_keys(p))]
    return placed.select(
        "raw_id",
        "raw_hash",
        F.col("raw_ingested_at").cast("timestamp").alias("raw_ingested_at"),
        "raw_schema",
        "raw_tab",
        F.to_json(F.struct(F.struct(*values).alias("values")), {"ignoreNullFields": "false"}).alias("raw"),
    )


# ---- oracle side ----------------------------------------------------------

_NUM = "decimal(33,15)"


def _blank(x: str) -> str:
    return f"nullif(trim({x}), '')"


RAW_CTE = (
    "lp as materialized (" + POSITION_SQL.format(s="varchar").strip() + "),\n"
    "base as (" + BASE_SQL.format(s="varchar").strip() + ")"
)

# The six destinations, straight from base and lp, without any JSON.
STAR_CTE = (
    RAW_CTE
    + f""",
dim3 as (
  select row_number() over (order by text_column_1, text_column_3, text_column_4) as id_column_1, *
  from (select distinct trim(text_column_1) as text_column_1, 'SYNTHETIC/REFERENCE' as text_column_2,
          cast(null as {_NUM}) as numeric_column_1,
          left(upper(trim(text_column_2)), 1) as text_column_3,
          right(upper(trim(text_column_2)), 1) as text_column_4
        from base where trim(text_column_1) <> ''
          and regexp_full_match(upper(trim(text_column_2)), '[A-Z]{{2}}'))),
dim4 as (
  select distinct cast((ascii(left(c, 1)) - 65) * 26 + ascii(right(c, 1)) - 65 + 1 as smallint) as id_column_1,
    'SYNTHETIC/GENERIC' as text_column_1, c as text_column_2
  from (select upper(trim(text_column_3)) as c from base)
  where regexp_full_match(c, '[A-Z]{{2}}')),
top as (
  select k, max(cast({_blank('d')} as smallint)) as d from lp group by k),
fact as (
  select b.raw_id as id_column_1, cast({_blank('b.id_column_1')} as integer) as id_column_2,
    cast(null as varchar) as text_column_1,
    timezone('America/Sao_Paulo', cast(b.datetime_column_1 as timestamptz)) as datetime_column_1,
    cast(null as varchar) as text_column_2,
    t.d as integer_column_1, cast(null as smallint) as integer_column_2,
    case when cast(b.numeric_column_2 as {_NUM}) > 0
      then cast(round(cast(b.numeric_column_2 as {_NUM}) * 1000) as integer) end as integer_column_3,
    cast(null as varchar) as text_column_3,
    b.raw_id as id_column_3, r.id_column_1 as id_column_4, cast(null as bigint) as id_column_5,
    cast(null as integer) as integer_column_4, cast(null as integer) as integer_column_5,
    cast(null as integer) as id_column_6, cast(null as integer) as integer_column_6,
    case when cast(b.numeric_column_1 as {_NUM}) > 0
      then cast(round(cast(b.numeric_column_1 as {_NUM}) * 1000) as integer) end as integer_column_7
  from base b join dim3 r on r.text_column_1 = trim(b.text_column_1)
    and r.text_column_3 = left(upper(trim(b.text_column_2)), 1)
    and r.text_column_4 = right(upper(trim(b.text_column_2)), 1)
  left join top t on t.k + 1 = b.raw_id),
measure as (
  select b.raw_id as id_column_1,
    cast(round(cast({_blank('b.integer_column_1')} as {_NUM}), 1) as decimal(21,1)) as numeric_column_1,
    cast(null as {_NUM}) as numeric_column_2, cast(null as integer) as integer_column_1,
    cast(null as integer) as integer_column_2, f.id_column_1 as id_column_2,
    cast(null as bigint) as id_column_3
  from base b join fact f on f.id_column_3 = b.raw_id
  where cast({_blank('b.integer_column_1')} as {_NUM}) > 0),
bridge as (
  select b.raw_id as id_column_1, f.id_column_1 as id_column_2, c.id_column_1 as id_column_3
  from base b join fact f on f.id_column_3 = b.raw_id
  join dim4 c on c.text_column_2 = upper(trim(b.text_column_3))),
slots as (
  select f.id_column_1 * 16 + p.n as id_column_1, f.id_column_1 as id_column_2,
    cast(p.n as smallint) as integer_column_1,
    cast(round(cast({_blank('p.w')} as {_NUM}) * 1000) as integer) as integer_column_2,
    upper(trim(p.t)) as text_column_1, cast(null as integer) as integer_column_3,
    cast(null as integer) as integer_column_4, cast(null as integer) as integer_column_5,
    case when cast({_blank('p.g')} as {_NUM}) > 0
      then cast(round(cast({_blank('p.g')} as {_NUM}) * 1000) as integer) end as integer_column_6
  from lp p join fact f on f.id_column_3 = p.k + 1
  where cast({_blank('p.d')} as smallint) = p.n and cast({_blank('p.w')} as {_NUM}) >= 0
    and upper(trim(p.t)) in ('X', 'Y', 'Z'))"""
)


def oracle(select: str, ctes: str = RAW_CTE) -> str:
    return f"with {ctes}\n{select}"


# ---- text to convert -------------------------------------------------------

TYPED_SQL = """
select o_orderkey as row_key,
  case o_orderkey % 9 when 0 then 'Sim' when 1 then ' TRUE ' when 2 then 'n' when 3 then 'nao' when 4 then ''
    when 5 then 'maybe' when 6 then '1' when 7 then 'F' end as flag_text,
  case o_orderkey % 8 when 0 then '' when 1 then 'junk' when 2 then {iso}
    when 3 then null else {day} end as day_text,
  case o_orderkey % 10 when 0 then 'abc' when 1 then '   '
    when 2 then concat(' ', cast(cast(o_totalprice as decimal(18,2)) as {s}), ' ')
    else replace(cast(cast(o_totalprice as decimal(18,2)) as {s}), '.', ',') end as number_text,
  case o_orderkey % 7 when 0 then '' when 1 then 'x9' else cast(o_custkey as {s}) end as count_text,
  case o_orderkey % 6 when 0 then '  ' else concat(' ', o_orderpriority, ' ') end as label_text,
  {moment} as moment_text
from orders
"""
_MOMENT = "timestamp '2024-04-01 00:00:00' + o_orderkey * interval '1' second"


def typed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words, dates, decimal commas and junk, by order key."""
    text = TYPED_SQL.format(
        s="string",
        iso="date_format(o_orderdate, 'yyyy-MM-dd')",
        day="date_format(o_orderdate, 'dd/MM/yyyy')",
        moment=f"date_format({_MOMENT}, 'dd/MM/yyyy HH:mm:ss')",
    )
    return spark.sql(text.replace("from orders", "from {orders}"), orders=table(spark, sf_dir, "orders"))


TYPED_CTE = "t as (" + TYPED_SQL.strip().format(
    s="varchar",
    iso="strftime(o_orderdate, '%Y-%m-%d')",
    day="strftime(o_orderdate, '%d/%m/%Y')",
    moment=f"strftime({_MOMENT}, '%d/%m/%Y %H:%M:%S')",
) + ")"


# ---- payloads with lists ---------------------------------------------------


def raw_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload per order: ``flags`` and ``parts`` are lists, or bare values for one line."""
    # A payload is one record of its source file: the lines of one order, a handful.
    lines = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.sort_array(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_returnflag"))).alias("lines"))
    )

    def cell(name: str):
        values = F.to_json(F.transform("lines", lambda e: e[name].cast("string")))
        return F.when(F.size("lines") == 1, F.substring(values, F.lit(2), F.length(values) - 2)).otherwise(values)

    return lines.select(
        (F.col("l_orderkey") + 1).alias("raw_id"),
        F.concat(
            F.lit('{"values":{"order":"'),
            F.col("l_orderkey").cast("string"),
            F.lit('","flags":'),
            cell("l_returnflag"),
            F.lit(',"parts":'),
            cell("l_partkey"),
            F.lit(',"empty":""}}'),
        ).alias("raw"),
    )


LIST_CTE = """lists as (
  select l_orderkey, count(*) as n,
    list(l_returnflag order by l_linenumber, l_partkey, l_returnflag) as flags,
    list(cast(l_partkey as varchar) order by l_linenumber, l_partkey, l_returnflag) as parts
  from lineitem group by l_orderkey)"""


# Some orders have no header but their status, and a status of their own.
_BARE = "o_orderkey % 1009 = 5"
_STATUS = f"case when o_orderkey % 19 = 0 then null when {_BARE} then 'bare' else o_orderstatus end"


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Small payload per order; only three statuses, so groups by status are huge."""
    return spark.sql(
        f"""select o_orderkey + 1 as raw_id, to_json(struct(struct(
              {_STATUS} as status, case when {_BARE} then null else o_orderpriority end as priority,
              case when {_BARE} then null else cast(o_custkey as string) end as owner
            ) as values)) as raw from {{orders}}""",
        orders=table(spark, sf_dir, "orders"),
    )


RAW_ORDERS_CTE = f"""ro as (select o_orderkey + 1 as raw_id, {_STATUS} as status,
  case when {_BARE} then null else o_orderpriority end as priority,
  case when {_BARE} then null else cast(o_custkey as varchar) end as owner from orders)"""


# ---- scanned lines ---------------------------------------------------------

# Seven files; file f6 has no header, f2 another one, f4 has it twice.
LINES_SQL = """
select concat('f', cast(o_orderkey % 7 as {s})) as file_key,
  cast(floor(o_orderkey / 7) as bigint) + 3 as row_no,
  case when o_orderkey % 50 = 0 then '' when o_orderkey % 50 = 1 then 'key' else cast(o_orderkey as {s}) end as c1,
  case when o_orderkey % 50 = 0 then ' ' when o_orderkey % 50 = 1 then ' status' else o_orderstatus end as c2,
  case when o_orderkey % 50 = 0 then null when o_orderkey % 50 = 1 then 'priority' when o_orderkey % 9 = 0 then ''
    else o_orderpriority end as c3
from orders
union all
select distinct concat('f', cast(o_orderkey % 7 as {s})), cast(1 as bigint), ' key',
  case when o_orderkey % 7 = 2 then 'state' else 'status' end, 'priority ' from orders where o_orderkey % 7 <> 6
union all
select distinct concat('f', cast(o_orderkey % 7 as {s})), cast(2 as bigint),
  case when o_orderkey % 7 = 4 then 'key' end, case when o_orderkey % 7 = 4 then 'status' end,
  case when o_orderkey % 7 = 4 then 'priority' end from orders
"""


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    cells = spark.sql(
        LINES_SQL.format(s="string").replace("from orders", "from {orders}"), orders=table(spark, sf_dir, "orders")
    )
    return cells.select("file_key", "row_no", F.array("c1", "c2", "c3").alias("values"))


LINES_CTE = "ln as (" + LINES_SQL.strip().format(s="varchar") + ")"
