"""Meter readings: roll-ups, gaps, unpivoted measures, deduplication, reconciliation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import keys, time as T
from ..operators import dedup, joins, quality, reshape, timeseries
from .base import E, r4, readings, t


def q_slot_rollup(spark: SparkSession, d: str) -> DataFrame:
    s = timeseries.rollup(readings(spark, d).select("user_id", "ts", "value"), ["user_id"], "ts", 15, {"kwh": F.col("value")})
    return s.select(keys.md5_key(F.col("user_id"), keys.stamp("ts")).alias("_id"), "user_id", "ts", r4(F.col("kwh")).alias("kwh"))


SQL_slot_rollup = f"""WITH {E} SELECT md5(CAST(user_id AS VARCHAR) || strftime(slot, '%Y-%m-%d %H:%M:%S')) AS _id, user_id, slot AS ts, round(sum(value), 4) AS kwh
FROM e GROUP BY user_id, slot"""


def q_hour_rollup_reconcile(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d)
    slots = timeseries.rollup(e.select("user_id", "ts", "value"), ["user_id"], "ts", 15, {"kwh": F.col("value")})
    up = timeseries.rollup(slots, ["user_id"], "ts", 60, {"kwh": F.col("kwh")})
    direct = timeseries.rollup(e.select("user_id", "ts", "value"), ["user_id"], "ts", 60, {"kwh": F.col("value")})
    broken = quality.reconciled(direct, up, ["user_id", "ts"], "kwh", 1e-6)
    return direct.agg(F.count("*").alias("hours")).crossJoin(broken.agg(F.count("*").alias("mismatches")))


SQL_hour_rollup_reconcile = f"""WITH {E}, s AS (SELECT user_id, slot, sum(value) AS k FROM e GROUP BY 1, 2), u AS (SELECT user_id, date_trunc('hour', slot) AS h, sum(k) AS k FROM s GROUP BY 1, 2),
x AS (SELECT user_id, hr AS h, sum(value) AS k FROM e GROUP BY 1, 2)
SELECT (SELECT count(*) FROM x) AS hours, (SELECT count(*) FROM x FULL JOIN u USING (user_id, h) WHERE coalesce(abs(x.k - u.k) > 1e-6, true)) AS mismatches"""


def q_missing_slots(spark: SparkSession, d: str) -> DataFrame:
    """Hours without a reading, from the first to the last hour of all readings."""
    e = readings(spark, d).select("user_id", F.col("hr").alias("ts"))
    users = joins.with_scalars(e.select("user_id").distinct(), e.agg(F.min("ts").alias("first"), F.max("ts").alias("last")))
    m = timeseries.spine(users, F.col("first"), F.col("last"), "1 HOUR").select("user_id", "ts").join(e, ["user_id", "ts"], "left_anti")
    return m.withColumn("hour", F.hour("ts").cast("long"))


SQL_missing_slots = f"""WITH {E}, g AS (SELECT unnest(generate_series(min(hr), max(hr), INTERVAL 1 HOUR)) AS ts FROM e),
s AS (SELECT user_id, ts FROM (SELECT DISTINCT user_id FROM e), g)
SELECT user_id, ts, CAST(hour(ts) AS BIGINT) AS hour FROM s ANTI JOIN (SELECT DISTINCT user_id, hr AS ts FROM e) USING (user_id, ts)"""


def _daily_wide(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d)
    return e.groupBy("user_id", "day").agg(r4(F.sum("cons")).alias("cons"), r4(F.sum("prod")).alias("prod"), F.max(F.when(F.col("event_type") == "error", F.col("value"))).alias("fault"))


_WIDE = f"""{E}, w AS (SELECT user_id, day, round(sum(cons), 4) AS cons, round(sum(prod), 4) AS prod, max(CASE WHEN event_type = 'error' THEN value END) AS fault FROM e GROUP BY 1, 2)"""


def q_unpivot_drop_null(spark: SparkSession, d: str) -> DataFrame:
    long = reshape.to_long(_daily_wide(spark, d), ["user_id", "day"], ["cons", "prod", "fault"], "property", "value")
    return long.withColumn("property_iri", keys.iri("https://example.org/property/", F.col("property")))


SQL_unpivot_drop_null = f"""WITH {_WIDE} SELECT user_id, day, property, value, 'https://example.org/property/' || property AS property_iri FROM (UNPIVOT w ON cons, prod, fault INTO NAME property VALUE value)"""


def q_unpivot_keep_null(spark: SparkSession, d: str) -> DataFrame:
    long = reshape.to_long(_daily_wide(spark, d), ["user_id", "day"], ["cons", "prod", "fault"], "property", "value", keep_nulls=True)
    unit = F.when(F.col("property") == "fault", "1").otherwise("kWh")
    return long.withColumn("unit", unit)


SQL_unpivot_keep_null = f"""WITH {_WIDE} SELECT user_id, day, property, value, CASE WHEN property = 'fault' THEN '1' ELSE 'kWh' END AS unit FROM w UNPIVOT INCLUDE NULLS (value FOR property IN (cons, prod, fault))"""


def q_pivot_case(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d).groupBy("day", "event_type").agg(r4(F.sum("value")).alias("v"))
    return reshape.to_wide(e, ["day"], "event_type", "v", ["click", "error", "purchase", "signup", "view"])


SQL_pivot_case = f"""WITH {E}, s AS (SELECT day, event_type, round(sum(value), 4) AS v FROM e GROUP BY 1, 2) SELECT day, max(v) FILTER (event_type = 'click') AS click, max(v) FILTER (event_type = 'error') AS error,
max(v) FILTER (event_type = 'purchase') AS purchase, max(v) FILTER (event_type = 'signup') AS signup, max(v) FILTER (event_type = 'view') AS view FROM s GROUP BY day"""


def q_deaccumulate(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events").select("event_id", "user_id", "ts", "value")
    return timeseries.deaccumulate(e, ["user_id"], "ts", "value", "step").select("event_id", "user_id", r4(F.col("step")).alias("step"))


SQL_deaccumulate = """WITH b AS (SELECT *, lag(value) OVER (PARTITION BY user_id ORDER BY ts) AS p FROM events)
SELECT event_id, user_id, round(CASE WHEN p IS NULL OR value < p THEN value ELSE value - p END, 4) AS step FROM b"""


def q_latest_distinct_on(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    return dedup.latest(e, ["user_id", "event_type"], "ts", "event_id").select("user_id", "event_type", "event_id", "ts", "value")


SQL_latest_distinct_on = "SELECT DISTINCT ON (user_id, event_type) user_id, event_type, event_id, ts, value FROM events ORDER BY user_id, event_type, ts DESC, event_id"


def q_latest_rownum(spark: SparkSession, d: str) -> DataFrame:
    o = t(spark, d, "orders")
    return dedup.distinct_on(o, ["o_custkey"], F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").desc()).select("o_custkey", "o_orderkey", r4(F.col("o_totalprice"), 2).alias("o_totalprice"))


SQL_latest_rownum = """SELECT o_custkey, o_orderkey, round(o_totalprice, 2) AS o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1"""


def q_latest_by_max(spark: SparkSession, d: str) -> DataFrame:
    return dedup.latest_by_max(t(spark, d, "events"), ["user_id"], "ts", ["event_id", "value"])


SQL_latest_by_max = "SELECT user_id, ts, event_id, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"


def q_newest_generation(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d)
    return dedup.newest_generation(e, "day").groupBy("event_type").agg(F.count("*").alias("n"), r4(F.sum("value")).alias("total"))


SQL_newest_generation = f"WITH {E} SELECT event_type, count(*) AS n, round(sum(value), 4) AS total FROM e WHERE day = (SELECT max(day) FROM e) GROUP BY 1"


def q_duplicate_keys(spark: SparkSession, d: str) -> DataFrame:
    return dedup.duplicate_keys(t(spark, d, "orders"), ["o_custkey", "o_orderstatus"])


SQL_duplicate_keys = "SELECT o_custkey, o_orderstatus, count(*) AS n FROM orders GROUP BY 1, 2 HAVING count(*) > 1"


def q_surrogate_key(spark: SparkSession, d: str) -> DataFrame:
    c = t(spark, d, "customer")
    maybe = F.when(F.col("c_acctbal") > 0, F.col("c_mktsegment"))
    return c.select("c_custkey", keys.surrogate_key(F.col("c_custkey"), maybe, F.col("c_name")).alias("record_id"))


SQL_surrogate_key = "SELECT c_custkey, md5(CAST(c_custkey AS VARCHAR) || '-' || coalesce(CASE WHEN c_acctbal > 0 THEN c_mktsegment END, '_null_') || '-' || coalesce(c_name, '_null_')) AS record_id FROM customer"


def q_quality_suite(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    rules = quality.not_null("ts", "user_id") | quality.accepted("event_type", ["view", "click", "purchase"]) | quality.in_range("value", 0, 100) | quality.expression("error_value", (F.col("event_type") == "error") & (F.col("value") > 50))
    few = t(spark, d, "customer").filter("c_acctbal > 0")
    return quality.row_rules(e, rules).unionByName(quality.unique(e, ["user_id", "ts"])).unionByName(quality.relationship(e, "user_id", few, "c_custkey"))


SQL_quality_suite = """SELECT 'not_null:ts' AS rule, count(*) FILTER (ts IS NULL) AS failures FROM events UNION ALL SELECT 'not_null:user_id', count(*) FILTER (user_id IS NULL) FROM events
UNION ALL SELECT 'accepted:event_type', count(*) FILTER (event_type NOT IN ('view', 'click', 'purchase')) FROM events UNION ALL SELECT 'range:value', count(*) FILTER (value NOT BETWEEN 0 AND 100) FROM events
UNION ALL SELECT 'expression:error_value', count(*) FILTER (event_type = 'error' AND value > 50) FROM events
UNION ALL SELECT 'unique:user_id,ts', count(*) FROM (SELECT 1 FROM events GROUP BY user_id, ts HAVING count(*) > 1)
UNION ALL SELECT 'relationship:user_id', count(*) FROM events WHERE user_id NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)"""


def q_freshness(spark: SparkSession, d: str) -> DataFrame:
    f = quality.freshness(t(spark, d, "events"), "ts", dt.datetime(2024, 1, 31), 30, 120)
    return f.select("newest", F.round("age_minutes", 3).alias("age_minutes"), "status")


SQL_freshness = """SELECT newest, round(age, 3) AS age_minutes, CASE WHEN age <= 30 THEN 'pass' WHEN age <= 120 THEN 'warn' ELSE 'error' END AS status
FROM (SELECT max(ts) AS newest, (epoch_us(TIMESTAMP '2024-01-31 00:00:00') - epoch_us(max(ts))) / 60000000.0 AS age FROM events)"""


def q_local_day(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    local = T.to_local(F.col("ts").cast("timestamp"), "Europe/Rome")
    return e.groupBy(F.to_date(local).alias("local_day")).agg(F.count("*").alias("n"), F.max("value").alias("highest"))


SQL_local_day = "SELECT CAST(ts + INTERVAL 1 HOUR AS DATE) AS local_day, count(*) AS n, max(value) AS highest FROM events GROUP BY 1"


def q_tz_convert(spark: SparkSession, d: str) -> DataFrame:
    e = t(spark, d, "events")
    out = e.select("event_id", T.to_instant(F.col("ts").cast("timestamp"), "Europe/Rome").cast("timestamp_ntz").alias("instant"), T.to_local(F.col("ts").cast("timestamp"), "Europe/Rome").cast("timestamp_ntz").alias("local"))
    return out


SQL_tz_convert = "SELECT event_id, ts - INTERVAL 1 HOUR AS instant, ts + INTERVAL 1 HOUR AS local FROM events"


def q_semi_scope(spark: SparkSession, d: str) -> DataFrame:
    e, fleet = readings(spark, d), t(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("user_id"))
    scoped = e.join(fleet, "user_id", "left_semi")
    return scoped.groupBy("user_id").agg(r4(F.sum(F.greatest(F.col("value") - 25, F.lit(0.0)))).alias("clipped"), F.count("*").alias("n"))


SQL_semi_scope = f"WITH {E} SELECT user_id, round(sum(greatest(value - 25, 0.0)), 4) AS clipped, count(*) AS n FROM e WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) GROUP BY 1"
