"""The corpus pipeline: quality rules, near-duplicate removal, byte dedup, surrogates for personal data, packing.

Each stage takes (spark, docs, sf_dir) and works on all documents that its predecessor kept; all but the last return
the columns of ``documents``. Stages are written as Parquet in the shared folder and read again, so a lost executor
never costs more than its stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltaria.llm import neardup, packing, pii, quality, suffixes
from voltaria.llm.common import shared_path, table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that every quality rule accepts."""
    return quality.filter_documents(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the smallest doc_id, of each group of near-duplicates (five words, similarity 0.8)."""
    return neardup.keep_one(docs, 5, 80)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the byte strings of 100 bytes or more that also start earlier."""
    return suffixes.dedup_documents(docs)


def surrogates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts with surrogates for personal data and secrets."""
    return pii.replace_entities(docs, pii.key_of(spark)).drop("n_entities")


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences that fill windows of 2048."""
    return packing.pack_documents(docs).withColumn("ids_crc32", F.crc32("ids"))


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("surrogates", surrogates),
    ("packing", pack),
]

#: SQL can't express near-duplicate components, keyed surrogates or packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
