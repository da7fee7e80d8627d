"""Import review of scanned lines (file_key, row_no, values): headers, noise, row ranges."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rawstar.operators.skew import lookup_join
from rawstar.session import materialize

# Rows of a file that meet row ranges together.
BUCKET = 1024
LINE_KEY = ["file_key", "row_no"]


def trimmed(values: Column) -> Column:
    """Cells without surrounding white space; a missing cell is empty text."""
    return F.transform(values, lambda v: F.regexp_replace(F.coalesce(v, F.lit("")), r"\A\s+|\s+\z", ""))


def padded(values: Column, width: Column) -> Column:
    return F.concat(trimmed(values), F.array_repeat(F.lit(""), F.greatest(width - F.size(values), F.lit(0))))


def first_lines(lines: DataFrame, files: DataFrame) -> DataFrame:
    """(file_key, has_header, values) with line 1 of each file as its header."""
    first = lines.where(F.col("row_no") == 1).select("file_key", "values")
    return files.select("file_key").distinct().join(first, "file_key", "left").withColumn(
        "has_header", F.col("values").isNotNull()
    )


def require_first_lines(lines: DataFrame, files: DataFrame, named: int = 20) -> None:
    """Fail with the number of files without a line 1 and the first few names."""
    missing = first_lines(lines, files).where(~F.col("has_header")).select("file_key")
    first = [r.file_key for r in missing.orderBy("file_key").limit(named).collect()]
    if first:
        raise ValueError(f"no first line in {missing.count()} files: {', '.join(first)}")


def header_consistency(headers: DataFrame, files: DataFrame) -> DataFrame:
    """(file_key, header_count, differs) of the chosen header lines, one row per file.

    Headers are trimmed and padded to the widest one, then compared with the
    header of the first file (by file_key).
    """
    per_file = headers.groupBy("file_key").agg(
        F.count(F.lit(1)).alias("header_count"), F.min_by("values", "row_no").alias("values")
    )
    # Two scalars of the headers; columns, because array lambdas cannot hold subqueries.
    compared = (
        files.select("file_key")
        .distinct()
        .join(per_file, "file_key", "left")
        .withColumn("_width", headers.agg(F.max(F.size("values"))).scalar())
        .withColumn("_reference", per_file.agg(F.min_by("values", "file_key")).scalar())
    )
    width = F.col("_width")
    return compared.select(
        "file_key",
        F.coalesce("header_count", F.lit(0)).alias("header_count"),
        (padded(F.col("values"), width) != padded(F.col("_reference"), width)).alias("differs"),
    )


def mark_overlap(headers: DataFrame, noise: DataFrame) -> DataFrame:
    """Lines marked both as header and as noise, which is an error."""
    return headers.select(*LINE_KEY).distinct().join(noise.select(*LINE_KEY).distinct(), LINE_KEY)


def drop_marked(lines: DataFrame, headers: DataFrame, noise: DataFrame) -> DataFrame:
    """Data lines: neither header nor noise."""
    if not mark_overlap(headers, noise).isEmpty():
        raise ValueError("a line is marked as header and as noise")
    marks = headers.select(*LINE_KEY).unionByName(noise.select(*LINE_KEY)).distinct()
    return lines.join(marks, LINE_KEY, "left_anti")


def merged_ranges(ranges: DataFrame) -> DataFrame:
    """(file_key, lo, hi): the same lines by disjoint ranges; reversed ranges hold none."""
    by_file = Window.partitionBy("file_key").orderBy("lo", "hi")
    reach = F.max("hi").over(by_file.rowsBetween(Window.unboundedPreceding, -1))
    apart = (F.col("lo") > F.coalesce(reach + 1, F.col("lo") - 1)).cast("int")
    held = ranges.select("file_key", "lo", "hi").where("lo <= hi").withColumn("_apart", apart)
    island = F.sum("_apart").over(by_file.rowsBetween(Window.unboundedPreceding, 0))
    merged = held.withColumn("_island", island).groupBy("file_key", "_island")
    return merged.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).drop("_island")


def select_ranges(lines: DataFrame, ranges: DataFrame, bucket: int = BUCKET) -> DataFrame:
    """Lines inside the (file_key, lo, hi) row ranges; overlapping ranges give a line once.

    Merged ranges are cut at multiples of ``bucket`` rows and met by equality on (file,
    bucket). A bucket that one range covers is told by two numbers; only in a bucket that
    ranges cut, a line is tested against the pieces there, fewer than ``bucket``.
    """
    number = lambda c: F.call_function("div", F.col(c) - F.pmod(F.col(c), F.lit(bucket)), F.lit(bucket))
    pieces = merged_ranges(ranges).withColumn("_bucket", F.explode(F.sequence(number("lo"), number("hi"))))
    pieces = pieces.select(
        "file_key",
        "_bucket",
        F.greatest("lo", F.col("_bucket") * bucket).alias("lo"),
        F.least("hi", F.col("_bucket") * bucket + bucket - 1).alias("hi"),
    )
    wanted = pieces.groupBy("file_key", "_bucket").agg(
        F.sum(F.col("hi") - F.col("lo") + 1).alias("_rows"), F.collect_list(F.struct("lo", "hi")).alias("_pieces")
    )
    wanted = wanted.withColumn("_pieces", F.when(F.col("_rows") < bucket, F.col("_pieces"))).drop("_rows")
    inside = F.exists("_pieces", lambda r: F.col("row_no").between(r["lo"], r["hi"]))
    return (
        lookup_join(lines.withColumn("_bucket", number("row_no")), materialize(wanted, "range-buckets"), ["file_key", "_bucket"])
        .where(F.col("_pieces").isNull() | inside)
        .select(*lines.columns)
    )


def bad_ranges(lines: DataFrame, ranges: DataFrame) -> DataFrame:
    """Ranges that are reversed, name an unknown file, or reach outside its lines."""
    extent = lines.groupBy("file_key").agg(F.min("row_no").alias("first"), F.max("row_no").alias("last"))
    return (
        ranges.join(extent, "file_key", "left")
        .where(
            F.col("first").isNull()
            | (F.col("lo") > F.col("hi"))
            | (F.col("lo") < F.col("first"))
            | (F.col("hi") > F.col("last"))
        )
        .select("file_key", "lo", "hi")
    )


def candidates(lines: DataFrame) -> DataFrame:
    """(file_key, row_no, candidate): suggested header and noise lines.

    Header: the first line of a file with no blank cell. Noise: a blank line, or
    a line that repeats the header.
    """
    cells = lines.withColumn("_cells", trimmed(F.col("values")))
    full = cells.where(~F.array_contains("_cells", "") & (F.size("_cells") > 0))
    header = full.groupBy("file_key").agg(
        F.min("row_no").alias("_header_row"), F.min_by("_cells", "row_no").alias("_header")
    )
    tagged = lookup_join(cells, header, ["file_key"], "left")
    is_header = F.coalesce(F.col("row_no") == F.col("_header_row"), F.lit(False))
    blank = F.forall("_cells", lambda v: v == "")
    repeats = F.coalesce(F.col("_cells") == F.col("_header"), F.lit(False))
    return tagged.select(
        *LINE_KEY, F.when(is_header, "header").when(blank | repeats, "noise").alias("candidate")
    ).where(F.col("candidate").isNotNull())


def header_names(values: Sequence[str]) -> list[str]:
    """Header texts as column names: trimmed, blank ones named by place, repeats refused."""
    names = [v.strip() or f"column_{i + 1}" for i, v in enumerate(values)]
    if len(set(names)) != len(names):
        raise ValueError("the header repeats a name")
    return names
