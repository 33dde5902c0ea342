"""The folder that driver and executors share, and cutting lineage in it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that ``spark.checkpoint.dir`` names. Unset, a local master gets one in /tmp; on a cluster that is an error,
    as a machine's own folder is of no use to the others."""
    sc = spark.sparkContext
    at = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not at:
        if not sc.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = f"/tmp/voltaria-checkpoints/{sc.applicationId}"
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(at)
    return at.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: what follows reads the rows as they are now, and survives lost executors."""
    shared_dir(df.sparkSession)
    return df.checkpoint()
