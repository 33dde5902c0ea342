"""Sharing a pool: pro rata, capped, what is left after earlier claims, and places by points."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.tiers import share


def with_totals(df: DataFrame, keys: Sequence[str], *sums: Column) -> DataFrame:
    """Adds aggregates of each group to its rows.

    Groups may be whole days: a window would bring each to one task. Here partial sums are taken before the shuffle, and the
    totals, a row per group, come back by a join that AQE may broadcast or split. Null keys are a group of their own.
    """
    totals = df.groupBy(*(F.col(k).alias(f"__{k}") for k in keys)).agg(*sums)
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(totals, on).drop(*(f"__{k}" for k in keys))


def with_places(df: DataFrame, keys: Sequence[str], points: str) -> DataFrame:
    """Adds ``rank`` (from 1, most points first, ties share it), ``members`` of the group and ``below`` (those with fewer points).

    The window runs over the distinct points of a group with their counts, not over its members. ``points`` must be whole
    numbers that come out alike whenever they are computed (from integers, or from a checkpoint).
    """
    w = Window.partitionBy(*(f"__{k}" for k in keys)).orderBy(F.col(f"__{points}").desc_nulls_last())
    cols = [*keys, points]
    counts = df.groupBy(*(F.col(k).alias(f"__{k}") for k in cols)).agg(F.count("*").alias("__n"))
    upto, all_of = F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, 0)), F.sum("__n").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    places = counts.withColumns({"__upto": upto, "members": all_of}).withColumns({"rank": F.col("__upto") - F.col("__n") + 1, "below": F.col("members") - F.col("__upto")}).drop("__n", "__upto")
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in cols]
    return df.join(places, on).drop(*(f"__{k}" for k in cols))


def share_of_total(df: DataFrame, keys: Sequence[str], value: str, out: str, pool: Column | None = None) -> DataFrame:
    """value / total of its group (0 where the total isn't above zero), times the pool."""
    part = share(F.col(value), F.col("__total"))
    return with_totals(df, keys, F.sum(value).alias("__total")).withColumn(out, part * pool if pool is not None else part).drop("__total")


def capped(df: DataFrame, keys: Sequence[str], demand: str, budget: str, out: str, accepted: Column | None = None) -> DataFrame:
    """Each demand in full while the group's demands fit into the budget, else in proportion; nothing for those not accepted.

    A null budget allows everything.
    """
    ok = F.coalesce(accepted, F.lit(False)) if accepted is not None else F.lit(True)
    claim = F.when(ok, F.col(demand)).otherwise(0.0)
    total = F.col("__total")
    value = F.when(~ok, 0.0).when(F.col(budget).isNull() | (total <= F.col(budget)), F.col(demand)).otherwise(F.col(demand) * F.col(budget) / total)
    return with_totals(df, keys, F.sum(claim).alias("__total")).withColumn(out, value).drop("__total")


def remaining(budgets: DataFrame, used: DataFrame, keys: Sequence[str], budget: str, spent: str, out: str) -> DataFrame:
    """Budget less what was used, never below zero."""
    sums = used.groupBy(*keys).agg(F.sum(spent).alias("__used"))
    return budgets.join(sums, list(keys), "left").withColumn(out, F.greatest(F.lit(0.0), F.col(budget) - F.coalesce("__used", F.lit(0.0)))).drop("__used")


def netted(production: Column, consumption: Column) -> Column:
    """What is used where it is produced."""
    return F.least(production, consumption)
