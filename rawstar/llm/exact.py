"""Exact dedup: group by a 128-bit content hash, keep the smallest id, compare bytes inside groups.

Built-in functions only. Texts are equal when they are byte for byte the same after each run
of ASCII white space became one space; null counts as empty. The grouping key is the 128-bit
hash and the text itself, so two texts that collide in the hash stay apart. Copies are
combined before the shuffle, so a group of any size costs one row for each task.

Null ids are larger than any other. Rows repeating both id and text are marked alike;
``without_copies`` returns one of them. An empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rawstar.llm.common import SPACE_RUN
from rawstar.session import materialize

CONTENT = ["_h1", "_h2", "_sha"]


def _with_content(docs: DataFrame) -> DataFrame:
    norm = F.regexp_replace(F.coalesce(F.col("text"), F.lit("")), SPACE_RUN, " ")
    return (
        docs.withColumn("_norm", norm)
        .withColumn("_h1", F.xxhash64("_norm"))
        .withColumn("_h2", F.xxhash64(F.lit(1), "_norm"))
    )


def _with_digest(docs: DataFrame) -> DataFrame:
    return _with_content(docs).withColumn("_sha", F.sha2("_norm", 256)).drop("_norm")


def groups(docs: DataFrame) -> DataFrame:
    """One narrow row for each distinct text: its digests, keep_id, group_size. Stored.

    The digests carry the verdict back to the rows: the 128-bit hash, and SHA-256 to tell
    apart texts that collide in it.
    """
    texts = _with_content(docs.select("doc_id", "text")).groupBy("_h1", "_h2", "_norm")
    found = texts.agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
    return materialize(found.withColumn("_sha", F.sha2("_norm", 256)).drop("_norm"), "equal-texts")


def exact_copies(docs: DataFrame) -> DataFrame:
    """For each row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = _with_digest(docs.select("doc_id", "text")).drop("text")
    return rows.join(groups(docs), CONTENT).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.col("_sha").alias("text_sha256"),
    )


def without_copies(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, with one row for each distinct text."""
    found = groups(docs)
    narrow = _with_digest(docs.select("doc_id", "text")).drop("text")
    # Where the smallest id itself is listed more than once.
    again = narrow.groupBy("doc_id", *CONTENT).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
    keepers = found.join(
        again.withColumnRenamed("doc_id", "_id"),
        [found[c] == again[c] for c in CONTENT] + [found["keep_id"].eqNullSafe(F.col("_id"))],
        "left",
    ).select(*[found[c] for c in CONTENT], F.col("keep_id").alias("_keep"), F.coalesce("_n", F.lit(1)).alias("_n"))
    keepers = materialize(keepers, "keepers")

    # All columns travel in one struct, so none of them can clash with those added here.
    whole = docs.select("doc_id", "text", F.struct("*").alias("_row"))

    def kept(which: DataFrame) -> DataFrame:
        rows = _with_digest(whole).join(which.drop("_n"), CONTENT)
        return rows.where(F.col("doc_id").eqNullSafe(F.col("_keep")))

    once = kept(keepers.where("_n = 1")).select("_row.*")
    listed_again = kept(keepers.where("_n > 1")).dropDuplicates(CONTENT).select("_row.*")
    return once.union(listed_again)
