"""Weekly streaks: a device's level rises with a response and decays to a floor without one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.geo import let


def update_streaks(previous: DataFrame, responses: DataFrame, fleet: DataFrame, device: str = "device_id", increment: int = 1, decay: int = 1, most: int = 10, floor: float = 0.5) -> DataFrame:
    """(device, level, peak) after a period. previous: (device, level, peak); responses: (device, responded boolean);
    every device of the three takes part, new ones from level 0. The floor is half the peak, rounded half to even."""
    state = previous.select(device, "level", "peak").join(responses.groupBy(device).agg(F.max("responded").alias("responded")), device, "full").join(fleet.select(device).distinct(), device, "full")
    level, peak = F.coalesce("level", F.lit(0)).cast("int"), F.coalesce("peak", F.lit(0)).cast("int")
    up = F.least(level + increment, F.lit(most))
    down = F.greatest(level - decay, F.bround(peak * floor).cast("int"), F.lit(0))
    after = F.when(F.coalesce("responded", F.lit(False)), up).otherwise(F.least(level, down))
    return state.select(device, after.cast("int").alias("level"), F.greatest(peak, after).cast("int").alias("peak"))


def run_streaks(responses: DataFrame, first: Column, last: Column, device: str = "device_id", increment: int = 1, decay: int = 1, most: int = 10, floor: float = 0.5) -> DataFrame:
    """(device, level, peak) after all periods from ``first`` to ``last``, from no state, by the rule of ``update_streaks``.

    responses: (device, period, responded), periods as whole numbers; one aggregation gathers the periods in which a device
    responded (as many as there are periods), and a fold over the periods replaces a join per period.
    """
    hits = responses.groupBy(device).agg(F.collect_set(F.when(F.col("responded"), F.col("period"))).alias("__hits"), F.first(first).alias("__a"), F.first(last).alias("__z"))

    def step(state: Column, period: Column) -> Column:
        up = F.least(state["level"] + increment, F.lit(most))
        down = F.greatest(state["level"] - decay, F.bround(state["peak"] * floor).cast("int"), F.lit(0))
        after = F.when(F.array_contains(F.col("__hits"), period), up).otherwise(F.least(state["level"], down)).cast("int")
        return let(after, lambda level: F.struct(level.alias("level"), F.greatest(state["peak"], level).alias("peak")))

    state = F.aggregate(F.sequence("__a", "__z"), F.struct(F.lit(0).alias("level"), F.lit(0).alias("peak")), step)
    return hits.select(device, state.alias("__s")).select(device, "__s.level", "__s.peak")
