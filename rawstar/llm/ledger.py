r"""Secret scans: an incremental ledger of content-addressed blobs and rule versions.

Built-in functions only. Every version of a file is a row (path, text); its blob is the
SHA-256 of the text. The ledger lists the (blob, rule, version) pairs scanned so far with
their findings; a scan takes only the pairs that are not listed, one text for each blob,
and ``findings`` joins the ledger back to all paths.

Spans are code points, the end exclusive. The kinds assign, access and hex are the base;
pem and jwt are added by this method. A null text counts as empty; an empty table gives no
rows; equal texts share one scan.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window

from rawstar.session import materialize, scratch_path


@dataclass(frozen=True)
class Rule:
    """``pattern`` finds the spans, leftmost and non-overlapping; ``group`` needs ``least`` characters."""

    kind: str
    version: int
    pattern: str
    group: int = 0
    least: int = 1


# The rules in the order in which kinds are listed. Long runs are asked for
# in the pattern where that finds the same spans as a test of the length afterwards.
RULES = (
    Rule(
        "assign",
        1,
        r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=6,
    ),
    Rule("access", 1, r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", 1, r"[0-9a-f]{24,}"),
    Rule("pem", 1, r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", 1, r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
BASE = ("assign", "access", "hex")


def blob_of(text: Column) -> Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def empty_ledger(spark: SparkSession, path: str) -> None:
    schema = "blob binary, kind string, version int, spans array<struct<s:int,e:int>>"
    spark.createDataFrame([], schema).write.mode("append").parquet(path)


def _spans(texts: DataFrame, rule: Rule) -> DataFrame:
    """(blob, s, e) of one rule. A text is cut at its matches; starts are sums of the lengths before."""
    pattern = F.lit(rule.pattern)
    # A row listed twice would add its lengths twice: one text stands for a blob.
    matched = texts.where(F.col("text").rlike(rule.pattern)).select("blob", "text").dropDuplicates(["blob"])
    cut = matched.select(
        "blob",
        F.arrays_zip(
            F.split("text", rule.pattern, -1).alias("gap"),
            F.regexp_extract_all("text", pattern, F.lit(0)).alias("found"),
            F.regexp_extract_all("text", pattern, F.lit(rule.group)).alias("value"),
        ).alias("parts"),
    )
    rows = cut.select("blob", F.posexplode("parts").alias("at", "part")).select(
        "blob", "at", F.length("part.gap").alias("gap"), F.length("part.found").alias("size"), F.length("part.value").alias("value")
    )
    # The matches of one text; the last row is the gap after them.
    upto = Window.partitionBy("blob").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.coalesce("size", F.lit(0))).over(upto).cast("int")
    return (
        rows.withColumn("e", end)
        .where(F.col("value") >= rule.least)
        .select("blob", (F.col("e") - F.col("size")).alias("s"), "e")
    )


def scan_unseen(versions: DataFrame, ledger: str, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """Scan the blobs of ``versions`` (path, text) whose rule versions the ledger lacks; append and return it."""
    spark = versions.sparkSession
    rows = versions.select("path", "text", blob_of(F.col("text")).alias("blob"), F.xxhash64("text").alias("text_hash"))
    # One row stands for a blob: the smallest path; of rows repeating it, ``_spans`` takes one.
    blobs = rows.groupBy("blob").agg(F.min("path").alias("path"))
    known = spark.read.parquet(ledger).groupBy("blob").agg(F.collect_set(F.struct("kind", "version")).alias("seen"))
    wanted = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    todo = (
        blobs.join(known, "blob", "left")
        .select("blob", "path", F.array_except(wanted, F.coalesce("seen", F.array().cast("array<struct<kind:string,version:int>>"))).alias("todo"))
        .where(F.size("todo") > 0)
    )
    todo = materialize(todo, "unseen-blobs")
    picked = rows.alias("r").join(
        todo.alias("t"), (F.col("r.blob") == F.col("t.blob")) & F.col("r.path").eqNullSafe(F.col("t.path"))
    )
    texts = picked.select("r.blob", "r.text", "todo")
    found = None
    for rule in rules:
        pair = F.struct(F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"))
        spans = _spans(texts.where(F.array_contains("todo", pair)), rule)
        spans = spans.select("blob", F.lit(rule.kind).alias("kind"), F.lit(rule.version).alias("version"), "s", "e")
        found = spans if found is None else found.unionByName(spans)
    listed = found.groupBy("blob", "kind", "version").agg(F.array_sort(F.collect_set(F.struct("s", "e"))).alias("spans"))
    pairs = todo.select("blob", F.explode("todo").alias("p")).select("blob", "p.kind", "p.version")
    new = pairs.join(listed, ["blob", "kind", "version"], "left")
    new = new.withColumn("spans", F.coalesce("spans", F.array().cast("array<struct<s:int,e:int>>")))
    new.write.mode("append").parquet(ledger)
    return spark.read.parquet(ledger)


def _joined(spans: Column) -> Column:
    text = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["s"].cast("string"), x["e"].cast("string")))
    return F.array_join(text, ",")


def _of_kind(kind: str) -> Column:
    return F.filter("spans", lambda x: x["kind"] == kind)


def findings(versions: DataFrame, ledger: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each path: counts by kind, the base spans' digest, and all spans as text."""
    order = F.create_map(*[F.lit(x) for i, r in enumerate(rules) for x in (r.kind, i)])
    now = F.col("kind").isin([r.kind for r in rules]) & F.element_at(
        F.create_map(*[F.lit(x) for r in rules for x in (r.kind, r.version)]), F.col("kind")
    ).eqNullSafe(F.col("version"))
    by_blob = (
        ledger.where(now & (F.size("spans") > 0))
        .select("blob", "kind", F.element_at(order, F.col("kind")).alias("rank"), F.explode("spans").alias("x"))
        .groupBy("blob")
        .agg(F.array_sort(F.collect_set(F.struct("x.s", "rank", "x.e", "kind"))).alias("spans"))
    )
    rows = versions.select("path", blob_of(F.col("text")).alias("blob")).join(by_blob, "blob", "left")
    none = F.array().cast("array<struct<s:int,rank:int,e:int,kind:string>>")
    rows = rows.withColumn("spans", F.coalesce("spans", none))
    base = F.filter("spans", lambda x: x["kind"].isin(*BASE))
    counts = [F.size(_of_kind(kind)).cast("long").alias(f"n_{kind}") for kind in BASE]
    return rows.select(
        "path", *counts, F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans")
    )


def scan(docs: DataFrame) -> DataFrame:
    """Scan the rows of ``docs`` as versions of the path ``doc_id``, on a new ledger."""
    versions = docs.select(F.col("doc_id").alias("path"), "text")
    ledger = scratch_path(docs.sparkSession, "ledger")
    empty_ledger(docs.sparkSession, ledger)
    return findings(versions, scan_unseen(versions, ledger))
