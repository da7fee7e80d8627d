"""Import review queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from rawstar import testbed
from rawstar.catalog.registry import Registry
from rawstar.operators import review
from rawstar.session import materialize
from rawstar.testbed import LINES_CTE, oracle

reg = Registry()


def _lines(spark, sf):
    return materialize(testbed.lines(spark, sf), "lines")


def _join(name="values"):
    return F.array_join(name, "|", "~").alias("cells")


_CELLS = "concat(coalesce(c1, '~'), '|', coalesce(c2, '~'), '|', coalesce(c3, '~'))"
_T1, _T2, _T3 = "trim(coalesce(c1, ''))", "trim(coalesce(c2, ''))", "trim(coalesce(c3, ''))"


@reg.query(
    oracle(
        f"""select f.file_key, h.cells is not null as has_header, h.cells from (select distinct file_key from ln) f
left join (select file_key, {_CELLS} as cells from ln where row_no = 1) h using (file_key)""",
        LINES_CTE,
    )
)
def header_first_line(spark, sf):
    lines = _lines(spark, sf)
    return review.first_lines(lines, lines).select("file_key", "has_header", _join())


_HEADERS = "row_no <= 2 and c1 is not null"


@reg.query(
    oracle(
        f"""select f.file_key, coalesce(h.n, 0) as header_count, h.cells <> (
    select min_by(concat({_T1}, '|', {_T2}, '|', {_T3}), file_key) from ln where row_no = 1) as differs
from (select distinct file_key from ln) f left join (
  select file_key, count(*) as n, min_by(concat({_T1}, '|', {_T2}, '|', {_T3}), row_no) as cells
  from ln where {_HEADERS} group by file_key) h using (file_key)""",
        LINES_CTE,
    )
)
def header_consistency(spark, sf):
    lines = _lines(spark, sf)
    headers = lines.where((F.col("row_no") <= 2) & F.col("values")[0].isNotNull())
    return review.header_consistency(headers, lines)


@reg.query(
    oracle(
        f"""select file_key, row_no, {_CELLS} as cells from ln
where not ({_HEADERS}) and not ({_T1} = '' and {_T2} = '' and {_T3} = '')""",
        LINES_CTE,
    )
)
def drop_noise_rows(spark, sf):
    lines = _lines(spark, sf)
    headers = lines.where((F.col("row_no") <= 2) & F.col("values")[0].isNotNull())
    noise = lines.where(F.forall(review.trimmed(F.col("values")), lambda v: v == ""))
    return review.drop_marked(lines, headers, noise).select("file_key", "row_no", _join())


_RANGES = """rg as (select distinct file_key, lo, lo + w as hi from (
  select file_key, (row_no // 100) * 100 as lo, length(file_key) * 10 as w from ln where row_no >= 100
  union all select file_key, (row_no // 100) * 100 + 15, 60 from ln where row_no >= 100))"""


@reg.query(
    oracle(
        f"""select file_key, row_no, {_CELLS} as cells from ln
where exists (select 1 from rg where rg.file_key = ln.file_key and row_no between lo and hi)""",
        LINES_CTE + ",\n" + _RANGES,
    )
)
def select_row_ranges(spark, sf):
    lines = _lines(spark, sf)
    hundreds = lines.where("row_no >= 100").select("file_key", (F.expr("row_no div 100") * 100).alias("lo")).distinct()
    ranges = hundreds.withColumn("hi", F.col("lo") + F.length("file_key") * 10).unionByName(
        hundreds.select("file_key", (F.col("lo") + 15).alias("lo"), (F.col("lo") + 75).alias("hi"))
    )
    return review.select_ranges(lines, ranges).select("file_key", "row_no", _join())


@reg.query(
    oracle(
        """select file_key, lo, hi from (
  select file_key, lo, hi, (select max(row_no) from ln l where l.file_key = rg.file_key) as last,
    (select min(row_no) from ln l where l.file_key = rg.file_key) as first from rg)
where lo > hi or lo < first or hi > last""",
        LINES_CTE + ",\n" + _RANGES,
    )
)
def bad_row_ranges(spark, sf):
    lines = _lines(spark, sf)
    hundreds = lines.where("row_no >= 100").select("file_key", (F.expr("row_no div 100") * 100).alias("lo")).distinct()
    ranges = hundreds.withColumn("hi", F.col("lo") + F.length("file_key") * 10).unionByName(
        hundreds.select("file_key", (F.col("lo") + 15).alias("lo"), (F.col("lo") + 75).alias("hi"))
    )
    return review.bad_ranges(lines, ranges)


@reg.query(
    oracle(
        """select file_key, row_no, case when row_no = hr then 'header' else 'noise' end as candidate from (
  select *, (select min(row_no) from cl x where x.file_key = cl.file_key and a <> '' and b <> '' and c <> '') as hr,
    (select min_by(concat(a, '|', b, '|', c), row_no) from cl x
      where x.file_key = cl.file_key and a <> '' and b <> '' and c <> '') as hc from cl)
where row_no = hr or concat(a, '|', b, '|', c) = hc or (a = '' and b = '' and c = '')""",
        LINES_CTE + f",\ncl as (select file_key, row_no, {_T1} as a, {_T2} as b, {_T3} as c from ln)",
    )
)
def noise_candidates(spark, sf):
    return review.candidates(_lines(spark, sf))
