"""What the corpus operators share: bounded Arrow batches, word rules, table reading and shared folders.

Rules that hold for every operator here: only the named columns are used, so further columns of any name do no
harm; a null text counts as an empty one unless the operator says otherwise; an empty table gives an empty result
with the same schema; repeated rows are treated row by row.
"""

from __future__ import annotations

import os
import uuid
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from ..shared import shared_dir

#: Rows and bytes that one Arrow batch handed to a Python worker may hold.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Bounds the batches that Python workers get, so that long texts don't pile up in one worker."""
    importable(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def importable(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver has it; on a cluster it is installed or added there."""
    env, root = spark.sparkContext.environment, str(Path(__file__).resolve().parents[2])
    known = [x for x in env.get("PYTHONPATH", "").split(os.pathsep) if x]
    if root not in known:
        env["PYTHONPATH"] = os.pathsep.join([*known, root])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: bytes) -> list[bytes]:
    """The words ``[^\\x20\\x09-\\x0D]+``: bytes.split() cuts at exactly these six characters."""
    return text.split()


def text_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of each text; null gives none."""
    return [b"" if x is None else x for x in column.cast(pa.large_binary()).to_pylist()]


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that driver and executors share (spark.checkpoint.dir).

    Where the setting is absent, a local master uses a local folder; on a cluster that is an error.
    """
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame, dealt: bool = False) -> DataFrame:
    """Reliable checkpoint: what follows survives lost executors without recomputing what came before.

    ``dealt``: the frame was repartitioned by a key and joins on it shall not shuffle it again. An adaptive plan does
    not tell its partitioning before it has run, so this one plan is made without adaptive execution.
    """
    spark = df.sparkSession
    shared_dir(spark)
    if not dealt:
        return df.checkpoint()
    name = "spark.sql.adaptive.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        return df.checkpoint()
    finally:
        spark.conf.set(name, before)


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
