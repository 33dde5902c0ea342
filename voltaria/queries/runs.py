"""Models run again and again over growing readings, against one SQL over all of them: bounded reads, replaced ranges, new keys
alone, columns kept by a merge, rows that lose their parent.

Each query registers models of its own, runs them at three times into tables of the shared folder and gives the table.
"""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import Context
from ..operators import timeseries
from ..plans.forecasts import heat_streaks
from ..registry import Hook, Registry, Since
from ..shared import shared_dir
from .base import E, r4, readings

#: When the runs take place; the last one is after all readings.
RUNS = [dt.datetime(2024, 1, 11), dt.datetime(2024, 1, 21, 6), dt.datetime(2024, 3, 1)]


def _run(spark: SparkSession, d: str, models: Registry, name: str) -> DataFrame:
    """The table of ``name`` after a run at each time, over the readings that had come by then."""
    at = f"{shared_dir(spark)}/runs-{uuid.uuid4().hex}"
    for now in RUNS:
        e = readings(spark, d).filter(F.col("ts") < F.lit(now).cast("timestamp_ntz"))
        out = models.run(Context(spark, at, now, tables={"readings": e}))
    return out[name]


def q_incremental_lookback(spark: SparkSession, d: str) -> DataFrame:
    """Slots from an hour before the newest on, then hours of them from two hours before the newest on."""
    r = Registry()

    @r.model("readings", kind="merge", key=("user_id", "slot"), reads={"readings": Since("slot", "ts", "1 HOUR")})
    def slots(ctx: Context, e: DataFrame) -> DataFrame:
        return e.groupBy("user_id", "slot").agg(F.sum("value").alias("kwh"), F.count("*").alias("n"))

    @r.model("slots", kind="merge", key=("user_id", "slot"), reads={"slots": Since("slot", back="2 HOURS")})
    def hours(ctx: Context, s: DataFrame) -> DataFrame:
        return timeseries.rollup(s, ["user_id"], "slot", 60, {"kwh": F.col("kwh"), "n": F.col("n")})

    h = _run(spark, d, r, "hours")
    return h.select("user_id", F.col("slot").alias("hr"), r4(F.col("kwh")).alias("kwh"), "n")


SQL_incremental_lookback = f"WITH {E} SELECT user_id, hr, round(sum(value), 4) AS kwh, count(*) AS n FROM e GROUP BY 1, 2"


def q_range_replace(spark: SparkSession, d: str) -> DataFrame:
    """The newest day written and those after it are made anew, from the readings of those days alone."""
    r = Registry()

    def range_of(ctx: Context) -> Column:
        return F.col("day") >= F.lit(ctx.target.agg(F.max("day")).first()[0])

    @r.model("readings", kind="range", replaced=range_of, reads={"readings": Since("day", "ts", like=lambda day: day.cast("timestamp_ntz"))})
    def days(ctx: Context, e: DataFrame) -> DataFrame:
        return e.groupBy("day", "event_type").agg(F.sum("value").alias("kwh"), F.countDistinct("user_id").alias("users"))

    return _run(spark, d, r, "days").select("day", "event_type", r4(F.col("kwh")).alias("kwh"), "users")


SQL_range_replace = f"WITH {E} SELECT day, event_type, round(sum(value), 4) AS kwh, count(DISTINCT user_id) AS users FROM e GROUP BY 1, 2"


def q_insert_new_keys(spark: SparkSession, d: str) -> DataFrame:
    """The first reading of each device and kind stays; later runs add new keys alone."""
    r = Registry()

    @r.model("readings", kind="insert", key=("user_id", "event_type"))
    def firsts(ctx: Context, e: DataFrame) -> DataFrame:
        return e.groupBy("user_id", "event_type").agg(F.min(F.struct("ts", "event_id", "value")).alias("f")).select("user_id", "event_type", "f.*", F.lit(RUNS.index(ctx.as_of)).alias("run"))

    return _run(spark, d, r, "firsts")


SQL_insert_new_keys = f"""WITH {E}, f AS (SELECT user_id, event_type, ts, event_id, value, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS rn FROM e)
SELECT user_id, event_type, ts, event_id, value, CASE WHEN ts < TIMESTAMP '2024-01-11' THEN 0 WHEN ts < TIMESTAMP '2024-01-21 06:00:00' THEN 1 ELSE 2 END AS run FROM f WHERE rn = 1"""


def q_post_hook(spark: SparkSession, d: str) -> DataFrame:
    """Totals by device, merged; after each run those go whose newest reading was an error."""
    r = Registry()

    def sound(ctx: Context, totals: DataFrame, e: DataFrame) -> DataFrame:
        newest = e.groupBy("user_id").agg(F.max(F.struct("ts", "event_id", "event_type")).alias("m"))
        return totals.join(newest.filter("m.event_type <> 'error'").select("user_id"), "user_id", "left_semi")

    @r.model("readings", kind="merge", key=("user_id",), update=("kwh", "n"), hooks=(Hook(sound, ("readings",)),))
    def totals(ctx: Context, e: DataFrame) -> DataFrame:
        return e.groupBy("user_id").agg(F.sum("value").alias("kwh"), F.count("*").alias("n"))

    return _run(spark, d, r, "totals").select("user_id", r4(F.col("kwh")).alias("kwh"), "n")


SQL_post_hook = f"""WITH {E}, n AS (SELECT user_id, event_type FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
SELECT user_id, round(sum(value), 4) AS kwh, count(*) AS n FROM e WHERE user_id IN (SELECT user_id FROM n WHERE event_type <> 'error') GROUP BY 1"""


def q_heat_waves_resumed(spark: SparkSession, d: str) -> DataFrame:
    """Days of a device over a limit, in runs of days; a later run reads five days back and goes on from the lengths before."""
    r = Registry()

    @r.model("readings", kind="merge", key=("lat", "lon", "date"), reads={"readings": Since("date", "ts", "5 DAYS", like=lambda day: day.cast("timestamp_ntz"))})
    def waves(ctx: Context, e: DataFrame) -> DataFrame:
        cell = e.withColumns({"lat": F.col("user_id") % 7, "lon": F.col("user_id") % 5}).groupBy("lat", "lon", F.col("day").alias("date"))
        # a month of summer, so that the thresholds of summer hold
        top = cell.agg(F.max("value").alias("v")).select("lat", "lon", "date", (F.col("v") - 40).alias("temp_max_c"), F.lit("low").alias("altitude_band"))
        before = None if ctx.target is None else ctx.target.filter(F.col("date") == F.lit(ctx.target.agg(F.date_sub(F.max("date"), 6)).first()[0]))
        summer = top.withColumn("real", F.col("date")).withColumn("date", F.date_add("date", 182))
        had = None if before is None else before.withColumn("date", F.date_add("date", 182))
        return heat_streaks(summer, had).select("lat", "lon", F.col("real").alias("date"), "temp_max_c", "is_heat_stress", "consecutive_heat_days")

    return _run(spark, d, r, "waves").select("lat", "lon", F.col("date").alias("day"), "is_heat_stress", "consecutive_heat_days")


SQL_heat_waves_resumed = f"""WITH {E}, t AS (SELECT user_id % 7 AS lat, user_id % 5 AS lon, day, max(value) - 40 AS v FROM e GROUP BY 1, 2, 3),
s AS (SELECT *, v > 27.0 AS hot FROM t), i AS (SELECT *, day - CAST(row_number() OVER (PARTITION BY lat, lon, hot ORDER BY day) AS INT) AS island FROM s)
SELECT lat, lon, day, hot AS is_heat_stress, CASE WHEN hot THEN row_number() OVER (PARTITION BY lat, lon, hot, island ORDER BY day) ELSE 0 END AS consecutive_heat_days FROM i"""
