"""The operators as registered queries over the whole given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rawstar.catalog.registry import Registry
from rawstar.llm import (
    decontaminate,
    exact,
    hmm,
    language,
    ledger,
    lines,
    merkle,
    neardup,
    negatives,
    notices,
    packing,
    warc,
    windows,
)
from rawstar.llm.common import held_out, table
from rawstar.llm.oracles import CAPTURES, CONTAMINATION, EXACT, LINES, MERKLE, NEGATIVES, REVISITS, SECRETS, WINDOWS

reg = Registry()


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@reg.query(LINES)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = lines.drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@reg.query()
def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(table(spark, sf_dir, "documents"), similarity=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@reg.query(EXACT)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_copies(table(spark, sf_dir, "documents"))


@reg.query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    tested = held_out(3, 1)
    found = language.identify(table(spark, sf_dir, "documents"), ~tested)
    return found.select("doc_id", tested.alias("held_out"), "lang_pred", "score")


@reg.query(CONTAMINATION)
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_words(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@reg.query(WINDOWS)
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = windows.remove_repeated_windows(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@reg.query()
def op7_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score(table(spark, sf_dir, "documents"), held_out(7, 2))


@reg.query(REVISITS)
def op8_warc_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captures are derived from the pages, the same SQL text for both engines; see ``CAPTURES``."""
    rows = spark.sql(CAPTURES, pages=table(spark, sf_dir, "pages"))
    names = {"ETag": "etag", "Last-Modified": "modified", "Content-Length": "length", "Cache-Control": "cache"}
    headers = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*names.values()))
    headers = F.map_filter(headers, lambda k, v: v.isNotNull())
    found = warc.resolve_revisits(rows.withColumn("headers", headers))
    listed = F.transform(F.array_sort(F.map_entries("headers")), lambda e: F.concat_ws(": ", e["key"], e["value"]))
    return found.withColumn("headers", F.array_join(listed, "\n"))


@reg.query()
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), end_id=2)


@reg.query(SECRETS)
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ledger.scan(table(spark, sf_dir, "documents")).withColumnRenamed("path", "doc_id")


@reg.query(MERKLE)
def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.audit(table(spark, sf_dir, "documents"), merkle.tampered()).drop("path")


@reg.query()
def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return notices.find_notices(table(spark, sf_dir, "documents")).drop("matches")


@reg.query(NEGATIVES)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, moved)
