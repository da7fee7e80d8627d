"""What the operators of this folder share.

Rows are told apart by ``doc_id`` and a hash of the text, never by ``doc_id`` alone: a null
or repeated id is allowed everywhere. Rows that repeat both are the same document listed
twice and get the same verdict.
"""

from __future__ import annotations

import gc
import itertools
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rawstar.session import scratch_path, shuffle_width

SPACES = b" \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
KEY = ["doc_id", "text_hash"]
# Rows of one Arrow batch; texts may be long, so batches are kept short.
BATCH_ROWS = 1000
# Rows after which a Parquet writer looks whether a page is full (1 MB). Rows here may be long, and a page is
# compressed as a whole, outside the heap; by default it is looked at after 100 rows.
PAGE_CHECK = {"parquet.page.size.row.check.min": "1"}


def short_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keyed(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, ``text_hash``, ``text`` and the named columns; others are dropped, so none clash."""
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text", *more)


def as_bytes(docs: DataFrame, *more: str) -> DataFrame:
    """``keyed`` rows with the text as UTF-8 bytes; null counts as empty."""
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), text, *more)


def join_rows(left: DataFrame, right: DataFrame, how: str = "left") -> DataFrame:
    """Join on the row key, null ids included; ``right`` is unique on it."""
    other = right.withColumnsRenamed({k: f"_r_{k}" for k in KEY})
    same = left["doc_id"].eqNullSafe(other["_r_doc_id"]) & (left["text_hash"] == other["_r_text_hash"])
    return left.join(other, same, how).drop("_r_doc_id", "_r_text_hash")


def keep_rows(docs: DataFrame, keys: DataFrame, how: str = "left_semi") -> DataFrame:
    """The rows of ``docs``, all columns, whose row key is in ``keys`` (or is not: ``left_anti``)."""
    other = keys.select(*[F.col(k).alias(f"_r_{k}") for k in KEY])
    same = docs["doc_id"].eqNullSafe(other["_r_doc_id"]) & (F.xxhash64(docs["text"]) == other["_r_text_hash"])
    return docs.join(other, same, how)


def held_out(modulus: int, remainder: int) -> Column:
    """True where crc32 of the id as text has that remainder; a null id counts as empty text."""
    text = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    return F.pmod(F.crc32(text.cast("binary")), F.lit(modulus)) == remainder


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffle files of finished steps now, not at some later collection."""
    gc.collect()
    spark._jvm.System.gc()


def store(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` to the shared scratch folder; the table and its path, for ``discard``."""
    path = scratch_path(df.sparkSession, label)
    df.write.options(**PAGE_CHECK).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def store_bucketed(df: DataFrame, key: str, label: str) -> tuple[DataFrame, str]:
    """``store`` in buckets of ``key``, as many as there are shuffle partitions: grouping by ``key``
    later, or joining by it, moves the other side only. The name of the table is its folder's."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    name = path.rsplit("/", 1)[1].replace("-", "_")
    writer = df.write.format("parquet").option("path", path).option("compression", "zstd").options(**PAGE_CHECK)
    writer.bucketBy(shuffle_width(spark), key).saveAsTable(name)
    return spark.table(name), path


def discard(spark: SparkSession, path: str) -> None:
    """Delete a scratch table that only finished, stored steps have read."""
    spark.sql(f"DROP TABLE IF EXISTS {path.rsplit('/', 1)[1].replace('-', '_')}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    release(spark)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser over an unsigned array."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def odd_multipliers(count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def by_weight(items: Iterable, weight, limit: int) -> Iterator[list]:
    """Consecutive lists of items of about ``limit`` total weight, one item at least."""
    part, total = [], 0
    for item in items:
        part.append(item)
        total += weight(item)
        if total >= limit:
            yield part
            part, total = [], 0
    if part:
        yield part


def rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Plain tuples of Arrow batches."""
    return itertools.chain.from_iterable(zip(*(c.to_pylist() for c in b.columns)) for b in batches)
