"""The driver's tables as meter readings, registry members and stations, in Spark and in DuckDB's SQL.

A device is a user of ``events``; views and clicks stand for consumption, purchases and sign-ups for production.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import time as T
from ..functions.numbers import rounded

Query = Callable[[SparkSession, str], DataFrame]

#: What stands for now.
AS_OF = "2024-01-31 00:00:00"


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def readings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events with slot, hour, day, consumption (cons) and production (prod)."""
    e = t(spark, sf_dir, "events")
    v = F.col("value")
    return e.withColumns(
        {
            "slot": T.floor_minutes("ts", 15), "hr": T.floor_hour("ts"), "day": F.to_date("ts"),
            "cons": F.when(F.col("event_type").isin("view", "click"), v).otherwise(0.0), "prod": F.when(F.col("event_type").isin("purchase", "signup"), v).otherwise(0.0),
        }
    )


#: The same as a common table expression.
E = """e AS (SELECT event_id, ts, user_id, event_type, value, props, time_bucket(INTERVAL 15 MINUTE, ts) AS slot, date_trunc('hour', ts) AS hr,
       CAST(ts AS DATE) AS day, CASE WHEN event_type IN ('view', 'click') THEN value ELSE 0.0 END AS cons,
       CASE WHEN event_type IN ('purchase', 'signup') THEN value ELSE 0.0 END AS prod FROM events)"""


def members(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, nation, region): the registry."""
    c, n = t(spark, sf_dir, "customer"), t(spark, sf_dir, "nation")
    return c.join(n, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey").cast("long").alias("nation"), F.col("n_regionkey").cast("long").alias("region"))


M = "m AS (SELECT c_custkey AS user_id, CAST(c_nationkey AS BIGINT) AS nation, CAST(n_regionkey AS BIGINT) AS region FROM customer JOIN nation ON c_nationkey = n_nationkey)"


def r4(c, n: int = 4):
    """Rounded as the SQL rounds doubles."""
    return rounded(c, n)


def r4_up(c, n: int = 4):
    """Rounded where ties are common: they are lifted first, as engines differ in which way they round them."""
    return rounded(c + 1e-9, n)
