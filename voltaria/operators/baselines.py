"""Consumption baselines per device, quarter hour and kind of day."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import time as T


def with_slots(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("slot", T.slot_of_day(ts)).withColumn("is_weekday", T.is_weekday(ts)).withColumn("day", F.to_date(ts))


def high_x_of_y(daily: DataFrame, keys: Sequence[str], day: str, value: str, select: int, candidates: int, out: str = "baseline") -> DataFrame:
    """Mean of the ``select`` highest of the last ``candidates`` daily values of each key.

    Only the rows that a key keeps leave a task (window group limits before the shuffle).
    """
    newest = Window.partitionBy(*keys).orderBy(F.col(day).desc())
    highest = Window.partitionBy(*keys).orderBy(F.col(value).desc(), F.col(day).desc())
    last = daily.withColumn("__n", F.row_number().over(newest)).filter(F.col("__n") <= candidates)
    top = last.withColumn("__n", F.row_number().over(highest)).filter(F.col("__n") <= select)
    return top.groupBy(*keys).agg(F.avg(value).alias(out))


def daily_means(df: DataFrame, keys: Sequence[str], value: str, min_readings: int = 0) -> DataFrame:
    """Mean of each key and day, of days with enough readings (a day has 96 slots, so the gate is per slot)."""
    least = max(1, min_readings // 96)
    return df.groupBy(*keys, "day").agg(F.avg(value).alias(value), F.count(value).alias("readings")).filter(F.col("readings") >= least).drop("readings")


def trimmed(daily: DataFrame, keys: Sequence[str], value: str, share: float, least_days: int = 4) -> DataFrame:
    """Leaves out days beyond the ``share`` quantiles at both ends, where a key has ``least_days`` or more."""
    bounds = daily.groupBy(*keys).agg(F.expr(f"percentile({value}, array({share}, {1 - share}))").alias("__q"), F.count("*").alias("__n"))
    joined = daily.join(bounds, list(keys))
    return joined.filter((F.col("__n") < least_days) | F.col(value).between(F.col("__q")[0], F.col("__q")[1])).drop("__q", "__n")


def slot_medians(df: DataFrame, keys: Sequence[str], value: str, out: str = "baseline") -> DataFrame:
    return df.groupBy(*keys).agg(F.median(value).alias(out))


def upward_spread(daily: DataFrame, keys: Sequence[str], value: str, high: float = 0.75, low: float = 0.5, out: str = "spread") -> DataFrame:
    """How far the upper quantile of daily values lies above the lower one, at least zero."""
    q = F.expr(f"percentile({value}, array({high}, {low}))")
    return daily.groupBy(*keys).agg(q.alias("__q")).select(*keys, F.greatest(F.lit(0.0), F.col("__q")[0] - F.col("__q")[1]).alias(out))


def top_days(df: DataFrame, keys: Sequence[str], day: str, value: str, days: int) -> DataFrame:
    """Rows on the ``days`` days with the greatest sums of each key."""
    sums = df.groupBy(*keys, day).agg(F.sum(value).alias("__s"))
    w = Window.partitionBy(*keys).orderBy(F.col("__s").desc(), F.col(day))
    return df.join(sums.withColumn("__n", F.row_number().over(w)).filter(F.col("__n") <= days).select(*keys, day), [*keys, day], "left_semi")


def consumption_proxy(grid_import: Column, grid_export: Column, export_baseline: Column) -> Column:
    """Import plus the export that was expected and didn't come."""
    return grid_import + F.greatest(F.lit(0.0), F.coalesce(export_baseline, F.lit(0.0)) - grid_export)


def settled_devices(df: DataFrame, device: str, least_days: int = 14) -> DataFrame:
    """Devices with readings on enough days for a baseline."""
    return df.groupBy(device).agg(F.countDistinct("day").alias("days")).filter(F.col("days") >= least_days).select(device)
