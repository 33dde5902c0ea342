"""Data tests: each gives the rows that break a rule; a suite counts them in one pass per table."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .dedup import duplicate_keys


def not_null(*columns: str) -> dict[str, Column]:
    return {f"not_null:{c}": F.col(c).isNull() for c in columns}


def accepted(column: str, values: Sequence[object]) -> dict[str, Column]:
    return {f"accepted:{column}": F.col(column).isNotNull() & ~F.col(column).isin(*values)}


def in_range(column: str, low: float, high: float) -> dict[str, Column]:
    """Nulls pass, as with NOT BETWEEN."""
    return {f"range:{column}": ~F.col(column).between(low, high)}


def expression(name: str, broken: Column) -> dict[str, Column]:
    return {f"expression:{name}": broken}


def row_rules(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """(rule, failures) of all rules at once: one scan, one short row a task."""
    sums = df.agg(*(F.count_if(F.coalesce(c, F.lit(False))).alias(n) for n, c in rules.items()))
    return sums.unpivot([], list(rules), "rule", "failures")


def unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(rule, failures): keys that occur more than once."""
    return duplicate_keys(df, keys).agg(F.count("*").alias("failures")).select(F.lit(f"unique:{','.join(keys)}").alias("rule"), "failures")


def relationship(df: DataFrame, column: str, parents: DataFrame, parent: str) -> DataFrame:
    """(rule, failures): values without a parent; nulls pass."""
    orphans = df.filter(F.col(column).isNotNull()).join(parents.select(F.col(parent).alias(column)), column, "left_anti")
    return orphans.agg(F.count("*").alias("failures")).select(F.lit(f"relationship:{column}").alias("rule"), "failures")


def reconciled(a: DataFrame, b: DataFrame, keys: Sequence[str], value: str, tolerance: float) -> DataFrame:
    """Keys whose values differ by more than a tolerance, or that one side lacks."""
    x, y = a.select(*keys, F.col(value).alias("__a")), b.select(*keys, F.col(value).alias("__b"))
    return x.join(y, list(keys), "full").filter(F.coalesce(F.abs(F.col("__a") - F.col("__b")) > tolerance, F.lit(True)))


def freshness(df: DataFrame, loaded_at: str, as_of: dt.datetime, warn_minutes: int, error_minutes: int) -> DataFrame:
    """(newest, age_minutes, status): pass, warn or error; error for an empty table."""
    newest = df.agg(F.max(loaded_at).alias("newest"))
    age = (F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(F.col("newest").cast("timestamp"))) / 60_000_000.0
    status = F.when(age <= warn_minutes, "pass").when(age <= error_minutes, "warn").otherwise("error")
    return newest.withColumn("age_minutes", age).withColumn("status", status)
