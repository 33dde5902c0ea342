"""Latest rows, distinct-on, and key checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def distinct_on(df: DataFrame, keys: Sequence[str], *order: Column) -> DataFrame:
    """The first row of each key by an order; ties go to any row, so give an order that has none.

    Spark limits each task to one row a key before the shuffle (window group limit).
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rn", F.row_number().over(w)).filter("__rn = 1").drop("__rn")


def latest(df: DataFrame, keys: Sequence[str], at: str, *ties: str) -> DataFrame:
    """The newest row of each key; nulls in ``at`` count as oldest."""
    return distinct_on(df, keys, F.col(at).desc_nulls_last(), *(F.col(t).asc_nulls_last() for t in ties))


def latest_by_max(df: DataFrame, keys: Sequence[str], at: str, columns: Sequence[str]) -> DataFrame:
    """The newest row of each key by one aggregation: partial results are combined before the shuffle, so a key with
    very many rows costs no more than others. Ties go to the greatest columns in turn."""
    best = F.max(F.struct(at, *columns)).alias("__best")
    return df.groupBy(*keys).agg(best).select(*keys, *(f"__best.{c}" for c in [at, *columns]))


def newest_generation(df: DataFrame, generation: str) -> DataFrame:
    """Only the rows of the newest generation: one value is aggregated and broadcast."""
    newest = df.agg(F.max(generation).alias("__newest"))
    return df.join(F.broadcast(newest), F.col(generation) == F.col("__newest"), "left_semi")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")
