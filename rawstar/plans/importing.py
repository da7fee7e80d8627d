"""Files into a raw table end to end: scan, review, envelope, ids, append, snapshot, version.

Every line is read with its number in its file. The review suggests a header for each file and
noise lines (``review.candidates``); the caller may pass its own marks. Each file's cells are named
by its own header, further cells by their place. Kept lines get consecutive ids in the order (file, line); only line
numbers are shuffled for that, not payloads, as long as the table of line chunks is small.

Layout under ``base``: ``raw`` (the raw table, by batch label and import), ``snapshots``
(one per version), ``counters`` and ``versions``. A version row is written last: an import without
one is run again, under the same label, and replaces what it left.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawstar.operators import review, versions
from rawstar.operators.numbering import running_totals
from rawstar.operators.skew import lookup_join
from rawstar.session import materialize
from rawstar.sources import files, raw, snapshots

VERSION_SCHEMA = (
    "table_name string, version_code string, raw_schema string, batch string, row_count bigint, file_count bigint, "
    "first_raw_id bigint, last_raw_id bigint, snapshot string"
)
# Lines numbered together.
CHUNK = 4096


def named_headers(headers: DataFrame, lines: DataFrame) -> DataFrame:
    """(file_key, names): trimmed header cells as far as a line of the file has a cell; blank ones
    are named by place, repeats refused."""
    last = F.array_max(F.transform("values", lambda v, i: F.when(v.isNotNull(), i + 1)))
    widths = lines.groupBy("file_key").agg(F.max(last).alias("width"))
    cells = F.slice(review.trimmed(F.col("values")), F.lit(1), F.col("width"))
    names = F.transform(cells, lambda v, i: F.when(v == "", F.concat(F.lit("column_"), (i + 1).cast("string"))).otherwise(v))
    named = headers.join(widths, "file_key").select("file_key", names.alias("names"))
    repeats = F.size(F.array_distinct("names")) < F.size("names")
    return named.withColumn(
        "names", F.when(repeats, F.raise_error(F.concat(F.lit("the header repeats a name in "), F.col("file_key")))).otherwise(F.col("names"))
    )


def payload(names: Column, values: Column) -> Column:
    """Cells under their header names as JSON; a missing cell is empty text."""
    cells = F.transform(names, lambda n, i: F.coalesce(F.get(values, i), F.lit("")))
    return F.to_json(F.struct(F.map_from_arrays(names, cells).alias("values")))


def reviewed(lines: DataFrame, marks: DataFrame | None = None) -> DataFrame:
    """The marked lines, (file_key, row_no, candidate): one header a file, and noise. Fails without a header."""
    found = materialize(review.candidates(lines) if marks is None else marks, "marks")
    headers = found.where("candidate = 'header'")
    firsts = headers.join(lines, review.LINE_KEY).select("file_key", F.lit(1).alias("row_no"), "values")
    review.require_first_lines(firsts, lines.select("file_key"))
    twice = headers.groupBy("file_key").count().where("count > 1").limit(1).collect()
    if twice:
        raise ValueError(f"more than one header in {twice[0].file_key}")
    return found


def numbered(kept: DataFrame, lines: DataFrame, first: int, chunk: int = CHUNK) -> DataFrame:
    """``kept`` with ``raw_id``: consecutive from ``first`` in the order (file_key, row_no).

    Per chunk of line numbers, the rows kept before it, and the lines in it that were left
    out. ``lines`` are all line numbers; neither side's other columns are read for that.
    """
    at = F.call_function("div", F.col("row_no"), F.lit(chunk)).alias("_chunk")
    flagged = lines.select(*review.LINE_KEY).join(
        kept.select(*review.LINE_KEY, F.lit(True).alias("_kept")), review.LINE_KEY, "left"
    )
    out = F.col("_kept").isNull()
    chunks = flagged.groupBy("file_key", at).agg(
        F.count_if(~out).alias("_n"), F.min("row_no").alias("_from"), F.array_sort(F.collect_list(F.when(out, F.col("row_no")))).alias("_out")
    )
    placed = running_totals(chunks, ["file_key", "_chunk"], "_n", "_ahead").drop("_n")
    rows = lookup_join(kept.withColumn("_chunk", F.call_function("div", F.col("row_no"), F.lit(chunk))), materialize(placed, "chunks"), ["file_key", "_chunk"])
    gone = F.size(F.filter("_out", lambda x: x < F.col("row_no")))
    raw_id = F.lit(first) + F.col("_ahead") + F.col("row_no") - F.col("_from") - gone
    return rows.withColumn("raw_id", raw_id.cast("bigint")).drop("_chunk", "_ahead", "_from", "_out")


@dataclass
class Importer:
    """One raw table under ``base`` and the files it takes in."""

    spark: SparkSession
    base: str
    table_name: str

    def _path(self, kind: str) -> str:
        return f"{self.base.rstrip('/')}/{kind}"

    def versions(self) -> DataFrame:
        path = self._path("versions")
        if not snapshots.path_exists(self.spark, path):
            return self.spark.createDataFrame([], VERSION_SCHEMA)
        return self.spark.read.schema(VERSION_SCHEMA).json(path)

    def rows(self) -> DataFrame:
        """The raw rows of all registered imports."""
        done = self.versions().select("raw_schema", "batch").distinct()
        return lookup_join(raw.read_raw(self.spark, self._path("raw")), done, ["raw_schema", "batch"])

    def _next_id(self) -> int:
        last = self.versions().where(F.col("table_name") == self.table_name).agg(F.max("last_raw_id")).first()[0]
        return (last or 0) + 1

    def scan(self, paths: str | Sequence[str], width: int, delimiter: str = ",", **options) -> DataFrame:
        """(file_key, row_no, value, values) of all lines."""
        lines = files.scan_lines(self.spark, paths, width, delimiter, **options)
        whole = F.when(F.col(files.OVERFLOW).isNotNull(), F.raise_error(F.lit("a line has more cells than the width"))).otherwise(F.col("values"))
        return lines.select(F.col("file_path").alias("file_key"), "row_no", "value", whole.alias("values"))

    def add(
        self,
        paths: str | Sequence[str],
        raw_schema: str,
        batch: str,
        width: int,
        delimiter: str = ",",
        marks: DataFrame | None = None,
        ingested_at: Column | None = None,
        **options,
    ) -> str:
        """Import the files as one batch; returns its version code. A registered batch is refused."""
        known = self.versions().where((F.col("raw_schema") == raw_schema) & (F.col("batch") == batch))
        if not known.isEmpty():
            raise ValueError(f"already imported: {raw_schema} {batch}")
        # Parsed once: the review, the headers, the digests, the numbers and the rows all read it.
        lines = materialize(self.scan(paths, width, delimiter, **options), "scanned-lines")
        found = reviewed(lines, marks)
        headers = lines.join(found.where("candidate = 'header'"), review.LINE_KEY, "left_semi")
        hashes = files.line_digests(lines.withColumnRenamed("file_key", "file_path")).withColumnRenamed("file_path", "file_key")
        by_file = materialize(named_headers(headers, lines).join(hashes, "file_key").withColumn("tab", F.regexp_extract("file_key", r"([^/]+)$", 1)), "files")
        kept = lookup_join(lines.drop("value"), found.select(*review.LINE_KEY), review.LINE_KEY, "left_anti")
        first = self._next_id()
        records = lookup_join(numbered(kept, lines, first), by_file, ["file_key"]).select(
            "raw_id",
            F.col("file_hash").alias("raw_hash"),
            (F.current_timestamp() if ingested_at is None else ingested_at).alias("raw_ingested_at"),
            F.lit(raw_schema).alias("raw_schema"),
            F.col("tab").alias("raw_tab"),
            payload(F.col("names"), F.col("values")).alias("raw"),
        )
        raw.write_batch(records, self._path("raw"), batch)
        return self._register(raw_schema, batch, first, by_file.count())

    def _register(self, raw_schema: str, batch: str, first: int, file_count: int) -> str:
        """Snapshot and version of a batch that is stored."""
        stored = raw.read_raw(self.spark, self._path("raw")).where((F.col("raw_schema") == raw_schema) & (F.col("batch") == batch))
        ends = stored.agg(F.count(F.lit(1)).alias("n"), F.min("raw_id").alias("lo"), F.max("raw_id").alias("hi")).first()
        if ends.n and (ends.lo, ends.hi) != (first, first + ends.n - 1):
            raise ValueError(f"ids {ends.lo} to {ends.hi} for {ends.n} rows from {first}")
        name = self.spark.createDataFrame([(self.table_name,)], "table_name string")
        code = versions.next_versions(self.versions(), name).first().next_code
        path = snapshots.snapshot_path(self._path("snapshots"), code)
        # Left by an import that did not get as far as its version.
        stored.write.mode("overwrite").parquet(path)
        row = (self.table_name, code, raw_schema, batch, ends.n, file_count, first, first + ends.n - 1, path)
        self.spark.createDataFrame([row], VERSION_SCHEMA).coalesce(1).write.mode("append").json(self._path("versions"))
        return code
