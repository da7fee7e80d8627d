"""Reading delimited text, JSON documents and whole files."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawstar.operators.skew import lookup_join
from rawstar.session import materialize

OVERFLOW = "overflow"
# Lines, and digests, hashed together.
FANOUT = 4096


def scan_delimited(
    spark: SparkSession, paths: str | Sequence[str], width: int, delimiter: str = ",", encoding: str = "UTF-8", **options
) -> DataFrame:
    """(file_path, file_name, values, overflow) of CSV lines, all text, no header row assumed.

    ``values`` has up to ``width`` cells. A line with more cells is kept whole in
    ``overflow`` instead of losing them.
    """
    cells = [f"c{i}" for i in range(width)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*cells, OVERFLOW]])
    reader = spark.read.options(
        sep=delimiter,
        encoding=encoding,
        header=False,
        mode="PERMISSIVE",
        columnNameOfCorruptRecord=OVERFLOW,
        **options,
    ).schema(schema)
    lines = reader.csv(paths if isinstance(paths, str) else list(paths))
    return lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.array(*cells).alias("values"),
        # A short line is reported too, but it has lost nothing.
        F.when(F.col(cells[-1]).isNotNull(), F.col(OVERFLOW)).alias(OVERFLOW),
    )


def numbered_text(spark: SparkSession, paths: str | Sequence[str], encoding: str = "UTF-8", **options) -> DataFrame:
    """(file_path, row_no, value) of every physical line, blank ones too, numbered from 1 in each file.

    A file may be cut into any number of splits: a line's place in its split comes from its
    place in the task, and the lines of earlier splits of the file are added, one count for
    each split. Lines are stored once, with the splits they were read in, and not shuffled as
    long as the counts are small.
    """
    lines = spark.read.options(encoding=encoding, **options).text(paths if isinstance(paths, str) else list(paths))
    placed = lines.select(
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("_split"),
        "value",
        # A split is read by one task, from its first line to its last.
        F.monotonically_increasing_id().alias("_mark"),
    )
    placed = materialize(placed, "placed-lines")
    splits = placed.groupBy("file_path", "_split").agg(F.min("_mark").alias("_first"), F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("file_path").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    splits = materialize(splits, "splits").withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    numbered = lookup_join(placed, materialize(splits.drop("_n"), "split-counts"), ["file_path", "_split"])
    row_no = (F.col("_before") + F.col("_mark") - F.col("_first") + 1).cast("bigint")
    return numbered.select("file_path", row_no.alias("row_no"), "value")


def scan_lines(
    spark: SparkSession, paths: str | Sequence[str], width: int, delimiter: str = ",", encoding: str = "UTF-8", **options
) -> DataFrame:
    """``scan_delimited`` line by line, with ``row_no`` and blank lines: (file_path, row_no, value, values, overflow).

    A record is one line here; quoted line ends are not joined.
    """
    cells = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{c} string" for c in [*cells, OVERFLOW])
    rules = {"sep": delimiter, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": OVERFLOW, **options}
    lines = numbered_text(spark, paths, encoding)
    parsed = lines.withColumn("_cells", F.from_csv("value", schema, {k: str(v) for k, v in rules.items()}))
    return parsed.select(
        "file_path",
        "row_no",
        "value",
        F.array(*[F.col(f"_cells.{c}") for c in cells]).alias("values"),
        F.when(F.col(f"_cells.{cells[-1]}").isNotNull(), F.col(f"_cells.{OVERFLOW}")).alias(OVERFLOW),
    )


def line_digests(lines: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """(file_path, file_hash, line_count) of numbered lines: a file of any size is hashed in pieces.

    SHA-256 of each line, then of each ``fanout`` consecutive digests, level by level, until
    one is left: a tree whose pieces are hashed by different tasks. A file of one line has that line's digest.
    """
    level = lines.select("file_path", (F.col("row_no") - 1).alias("_at"), F.sha2(F.col("value").cast("binary"), 256).alias("digest"))
    level = materialize(level, "line-digests")
    counts = level.groupBy("file_path").agg(F.count(F.lit(1)).alias("line_count"))
    most = counts.agg(F.max("line_count")).first()[0] or 0
    while most > 1:
        runs = level.groupBy("file_path", F.call_function("div", F.col("_at"), F.lit(fanout)).alias("_at"))
        # At most ``fanout`` digests; a digest alone in its file goes up as it is.
        level = runs.agg(F.array_sort(F.collect_list(F.struct("_at", "digest"))).alias("_run")).select(
            "file_path",
            "_at",
            F.when((F.size("_run") == 1) & (F.col("_at") == 0), F.col("_run")[0]["digest"])
            .otherwise(F.sha2(F.array_join(F.transform("_run", lambda x: x["digest"]), ""), 256))
            .alias("digest"),
        )
        most = -(-most // fanout)
    return level.join(counts, "file_path").select("file_path", F.col("digest").alias("file_hash"), "line_count")


def scan_text(spark: SparkSession, paths: str | Sequence[str], separator: str | None = None) -> DataFrame:
    """(file_path, file_name, values) of plain text lines, split on a pattern if given."""
    lines = spark.read.text(paths if isinstance(paths, str) else list(paths))
    values = F.array("value") if separator is None else F.split("value", separator)
    return lines.select(
        F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"), values.alias("values")
    )


def scan_json(spark: SparkSession, paths: str | Sequence[str], schema: str, data_path: str) -> DataFrame:
    """Rows of the array at ``data_path`` (dotted) of each JSON document, one row per element.

    Other top-level fields are not read. ``json_data_path`` says where rows came from.
    """
    documents = spark.read.schema(schema).json(paths if isinstance(paths, str) else list(paths), multiLine=True)
    return json_rows(documents, data_path).withColumn("json_data_path", F.lit(data_path))


def json_rows(documents: DataFrame, data_path: str) -> DataFrame:
    """Explode the row array of parsed documents; ``row_no`` counts from 1 in each document."""
    placed = documents.select(F.col("_metadata.file_path").alias("file_path"), F.posexplode(data_path).alias("_p", "_row"))
    return placed.select("file_path", (F.col("_p") + 1).alias("row_no"), "_row.*")


def file_hashes(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file_path, file_hash, length) of whole files; one file is read by one task."""
    files = spark.read.format("binaryFile").load(paths if isinstance(paths, str) else list(paths))
    return files.select(F.col("path").alias("file_path"), F.sha2("content", 256).alias("file_hash"), "length")


def content_hash(df: DataFrame, column: str, name: str = "raw_hash") -> DataFrame:
    """SHA-256 of each row's content."""
    return df.withColumn(name, F.sha2(F.col(column).cast("binary"), 256))


def combine(sources: dict[str, DataFrame]) -> DataFrame:
    """Several sources of one batch as one, columns matched by name, with ``source`` kept."""
    tagged = [df.withColumn("source", F.lit(name)) for name, df in sources.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
