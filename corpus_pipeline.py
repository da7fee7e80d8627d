"""A training corpus from ``documents``: five stages, each written as Parquet and read by the next.

language_id drops documents whose language is not recognised, exact_dedup and near_dedup (from
80 per cent similarity) leave one document of each group, decontamination drops documents that quote the benchmark, and packing
returns token sequences. The first four return the columns of documents, further ones too,
whatever their names.

Null and empty texts have no language and go first. Of equal texts the smallest id stays (a null id
is larger than any other), of near copies the smallest id, then the smaller text hash. A row listed twice is
one document to both dedup stages. Long texts are read whole. An empty table, or one of which
nothing is left, gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from rawstar.llm import decontaminate, exact, language, neardup, packing
from rawstar.llm.common import held_out, table
from rawstar.llm.queries import tokenizer_path
from rawstar.session import materialize


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return language.recognised(docs, ~held_out(3, 1))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return neardup.without_near_copies(docs, similarity=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path(), end_id=2)


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]
# A trained model and a tokenizer decide: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
