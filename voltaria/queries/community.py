"""Energy community: netting per substation, allocation, windows, settlement, points, streaks, leaderboards."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..context import Context
from ..functions import tiers, time as T
from ..operators import allocation, baselines, dedup, joins, streaks, timeseries
from ..plans import flexibility
from ..shared import checkpointed
from .base import E, M, members, r4, r4_up, readings, t


def _net(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d).join(members(spark, d), "user_id")
    g = e.groupBy("hr", "nation").agg(F.sum("cons").alias("cons"), F.sum("prod").alias("prod"))
    return g.withColumn("shared", allocation.netted(F.col("prod"), F.col("cons")))


_NET = f"{E}, {M}, g AS (SELECT hr, nation, sum(cons) AS cons, sum(prod) AS prod, least(sum(prod), sum(cons)) AS shared FROM e JOIN m USING (user_id) GROUP BY 1, 2)"


def q_net_share(spark: SparkSession, d: str) -> DataFrame:
    """Per hour and substation: production, consumption, what is used where it is produced, and its ratio."""
    g = _net(spark, d)
    return g.select("hr", "nation", r4(F.col("cons")).alias("cons"), r4(F.col("prod")).alias("prod"), r4(F.col("shared")).alias("shared"), r4(tiers.share(F.col("shared"), F.col("prod"))).alias("ratio"))


SQL_net_share = f"WITH {_NET} SELECT hr, nation, round(cons, 4) AS cons, round(prod, 4) AS prod, round(shared, 4) AS shared, round(CASE WHEN prod > 0 THEN shared / prod ELSE 0.0 END, 4) AS ratio FROM g"


def q_net_share_daily(spark: SparkSession, d: str) -> DataFrame:
    """Netted hours summed to days; the ratio is taken from the sums."""
    g = _net(spark, d).groupBy(F.to_date("hr").alias("day"), "nation").agg(F.sum("prod").alias("prod"), F.sum("shared").alias("shared"))
    return g.select("day", "nation", r4(F.col("shared")).alias("shared"), r4(tiers.share(F.col("shared"), F.col("prod"))).alias("ratio"))


SQL_net_share_daily = f"WITH {_NET} SELECT CAST(hr AS DATE) AS day, nation, round(sum(shared), 4) AS shared, round(CASE WHEN sum(prod) > 0 THEN sum(shared) / sum(prod) ELSE 0.0 END, 4) AS ratio FROM g GROUP BY 1, 2"


def q_device_alloc(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d).join(members(spark, d), "user_id").groupBy("hr", "nation", "user_id").agg(F.sum("cons").alias("own"))
    g = _net(spark, d).withColumnRenamed("cons", "total")
    j = e.join(g, ["hr", "nation"])
    return j.select("hr", "nation", "user_id", r4(tiers.share(F.col("own"), F.col("total")) * F.col("shared")).alias("allocated"))


SQL_device_alloc = f"""WITH {_NET}, o AS (SELECT hr, nation, user_id, sum(cons) AS own FROM e JOIN m USING (user_id) GROUP BY 1, 2, 3)
SELECT hr, nation, user_id, round(CASE WHEN cons > 0 THEN own / cons ELSE 0.0 END * shared, 4) AS allocated FROM o JOIN g USING (hr, nation)"""


def q_share_of_total(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d).groupBy("user_id", "day").agg(F.sum("cons").alias("own"))
    return allocation.share_of_total(e, ["day"], "own", "share").select("user_id", "day", F.round("share", 6).alias("share"))


SQL_share_of_total = f"WITH {E}, s AS (SELECT user_id, day, sum(cons) AS own FROM e GROUP BY 1, 2) SELECT user_id, day, round(CASE WHEN sum(own) OVER (PARTITION BY day) > 0 THEN own / sum(own) OVER (PARTITION BY day) ELSE 0.0 END, 6) AS share FROM s"


def _windows(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d).filter("event_type = 'signup'")
    return e.select("user_id", F.col("event_id").alias("window_id"), F.col("hr").alias("start_ts"), T.plus("hr", hours=6).alias("end_ts")).distinct()


_WIN = "w AS (SELECT user_id, event_id AS window_id, hr AS start_ts, hr + INTERVAL 6 HOUR AS end_ts FROM e WHERE event_type = 'signup')"


def q_interval_left_join(spark: SparkSession, d: str) -> DataFrame:
    p = readings(spark, d).select("event_id", "user_id", "ts", "value")
    j = joins.interval_join(p, _windows(spark, d), ["user_id"], "ts", "start_ts", "end_ts", "left")
    first = dedup.distinct_on(j, ["event_id"], F.col("start_ts").asc_nulls_last(), F.col("window_id").asc_nulls_last())
    return first.select("event_id", "user_id", F.coalesce("window_id", F.lit(-1)).alias("window_id"), F.col("window_id").isNotNull().alias("in_window"))


SQL_interval_left_join = f"""WITH {E}, {_WIN}, j AS (SELECT e.event_id, e.user_id, w.window_id, row_number() OVER (PARTITION BY e.event_id ORDER BY w.start_ts NULLS LAST, w.window_id NULLS LAST) AS rn
FROM e LEFT JOIN w ON e.user_id = w.user_id AND e.ts >= w.start_ts AND e.ts < w.end_ts) SELECT event_id, user_id, coalesce(window_id, -1) AS window_id, window_id IS NOT NULL AS in_window FROM j WHERE rn = 1"""


def q_proportional_cap(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d).join(members(spark, d), "user_id").groupBy("day", "nation", "user_id").agg(F.sum("prod").alias("demand"))
    e = e.withColumn("budget", F.when(F.col("nation") % 7 != 0, 50.0 + 10 * F.col("nation")))
    out = allocation.capped(e, ["day", "nation"], "demand", "budget", "allocated", F.col("user_id") % 4 != 0)
    return out.select("day", "nation", "user_id", r4(F.col("demand")).alias("demand"), r4(F.col("allocated")).alias("allocated"))


SQL_proportional_cap = f"""WITH {E}, {M}, s AS (SELECT day, nation, user_id, sum(prod) AS demand, user_id % 4 <> 0 AS ok, CASE WHEN nation % 7 <> 0 THEN 50.0 + 10 * nation END AS budget FROM e JOIN m USING (user_id) GROUP BY day, nation, user_id),
x AS (SELECT *, sum(CASE WHEN ok THEN demand ELSE 0.0 END) OVER (PARTITION BY day, nation) AS total FROM s)
SELECT day, nation, user_id, round(demand, 4) AS demand, round(CASE WHEN NOT ok THEN 0.0 WHEN budget IS NULL OR total <= budget THEN demand ELSE demand * CAST(budget AS DOUBLE) / total END, 4) AS allocated FROM x"""


def q_passive_alloc(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d).join(members(spark, d), "user_id").groupBy("day", "nation", "user_id").agg(F.sum("cons").alias("cons"), F.sum("prod").alias("prod"), F.max((F.col("event_type") == "signup").cast("int")).alias("signed"))
    committed, budgets = e.filter("signed = 1"), e.select("day", "nation").distinct().withColumn("budget", 20.0 + F.col("nation") * 5)
    left = allocation.remaining(budgets, committed, ["day", "nation"], "budget", "prod", "rest")
    passive = e.join(committed.select("day", "nation", "user_id"), ["day", "nation", "user_id"], "left_anti").join(left, ["day", "nation"])
    out = allocation.share_of_total(passive, ["day", "nation"], "cons", "got", F.col("rest"))
    return out.select("day", "nation", "user_id", r4(F.col("rest")).alias("rest"), r4(F.col("got")).alias("got"))


SQL_passive_alloc = f"""WITH {E}, {M}, s AS (SELECT day, nation, user_id, sum(cons) AS cons, sum(prod) AS prod, max(CAST(event_type = 'signup' AS INT)) AS signed FROM e JOIN m USING (user_id) GROUP BY 1, 2, 3),
b AS (SELECT day, nation, greatest(0.0, CAST(20.0 + nation * 5 AS DOUBLE) - coalesce(sum(prod) FILTER (signed = 1), 0.0)) AS rest FROM s GROUP BY 1, 2),
p AS (SELECT s.day, s.nation, user_id, cons, rest, sum(cons) OVER (PARTITION BY s.day, s.nation) AS total FROM s JOIN b USING (day, nation) WHERE signed = 0)
SELECT day, nation, user_id, round(rest, 4) AS rest, round(CASE WHEN total > 0 THEN cons / total ELSE 0.0 END * rest, 4) AS got FROM p"""


def _sessions(spark: SparkSession, d: str) -> DataFrame:
    h = readings(spark, d).join(members(spark, d), "user_id").groupBy("nation", "day", "hr").agg(F.sum("prod").alias("prod"), F.sum("cons").alias("cons"))
    surplus = h.withColumn("surplus", F.col("prod") - F.col("cons")).filter("surplus > 0")
    s = timeseries.sessions(surplus, ["nation", "day"], "hr", 3600)
    c = timeseries.chunks(s, ["nation", "day", "session"], "hr", 3)
    g = c.groupBy("nation", "day", "session", "chunk").agg(F.min("hr").alias("start_ts"), T.plus(F.max("hr"), hours=1).alias("end_ts"), F.sum("surplus").alias("kwh"), F.count("*").alias("hours"))
    return g.filter("hours >= 2")


_SES = f"""{E}, {M}, h AS (SELECT nation, day, hr, sum(prod) - sum(cons) AS surplus FROM e JOIN m USING (user_id) GROUP BY 1, 2, 3 HAVING sum(prod) - sum(cons) > 0),
l AS (SELECT *, CAST(coalesce(hr - lag(hr) OVER (PARTITION BY nation, day ORDER BY hr) > INTERVAL 1 HOUR, false) AS BIGINT) AS fresh FROM h),
s AS (SELECT *, sum(fresh) OVER (PARTITION BY nation, day ORDER BY hr ROWS UNBOUNDED PRECEDING) AS session FROM l),
c AS (SELECT *, (row_number() OVER (PARTITION BY nation, day, session ORDER BY hr) - 1) // 3 AS chunk FROM s),
win AS (SELECT nation, day, session, chunk, min(hr) AS start_ts, max(hr) + INTERVAL 1 HOUR AS end_ts, sum(surplus) AS kwh, count(*) AS hours FROM c GROUP BY 1, 2, 3, 4 HAVING count(*) >= 2)"""


def q_sessionise_chunk(spark: SparkSession, d: str) -> DataFrame:
    return _sessions(spark, d).select("nation", "start_ts", "end_ts", r4(F.col("kwh")).alias("kwh"), "hours")


SQL_sessionise_chunk = f"WITH {_SES} SELECT nation, start_ts, end_ts, round(kwh, 4) AS kwh, hours FROM win"


def q_hit_rate(spark: SparkSession, d: str) -> DataFrame:
    hours = timeseries.hours(_sessions(spark, d), "start_ts", "end_ts", out="hr")
    actual = readings(spark, d).groupBy("hr").agg(F.sum("prod").alias("made"), F.sum("cons").alias("used"))
    j = hours.join(actual, "hr", "left").groupBy("nation").agg(F.count_if(F.col("made") > F.col("used")).alias("hits"), F.count("made").alias("known"))
    rate = F.when(F.col("known") > 0, F.greatest(F.lit(0.3), F.least(F.lit(0.95), F.col("hits") / F.col("known"))))
    return j.select("nation", "hits", "known", r4(rate).alias("confidence"))


SQL_hit_rate = f"""WITH {_SES}, x AS (SELECT nation, unnest(generate_series(start_ts, end_ts - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS hr FROM win), a AS (SELECT hr, sum(prod) AS made, sum(cons) AS used FROM e GROUP BY 1)
SELECT nation, count(*) FILTER (made > used) AS hits, count(made) AS known, round(CASE WHEN count(made) > 0 THEN greatest(0.3::DOUBLE, least(0.95::DOUBLE, count(*) FILTER (made > used) / count(made))) END, 4) AS confidence FROM x LEFT JOIN a USING (hr) GROUP BY 1"""


def q_slot_expand_lookup(spark: SparkSession, d: str) -> DataFrame:
    base = readings(spark, d).withColumn("hour", F.hour("ts")).withColumn("weekday", T.is_weekday("ts")).groupBy("user_id", "hour", "weekday").agg(F.median("value").alias("base"))
    slots = timeseries.hours(_windows(spark, d), "start_ts", "end_ts", out="at").withColumn("hour", F.hour("at")).withColumn("weekday", T.is_weekday("at"))
    j = slots.join(base, ["user_id", "hour", "weekday"], "left")
    return j.groupBy("window_id", "user_id").agg(F.count("*").alias("slots"), r4(F.sum(F.coalesce("base", F.lit(0.0)))).alias("expected"))


SQL_slot_expand_lookup = f"""WITH {E}, {_WIN}, b AS (SELECT user_id, hour(ts) AS h, isodow(ts) < 6 AS wd, median(value) AS base FROM e GROUP BY 1, 2, 3),
s AS (SELECT window_id, user_id, unnest(generate_series(start_ts, end_ts - INTERVAL 1 HOUR, INTERVAL 1 HOUR)) AS ats FROM w)
SELECT window_id, s.user_id, count(*) AS slots, round(sum(coalesce(base, 0.0)), 4) AS expected FROM s LEFT JOIN b ON s.user_id = b.user_id AND hour(ats) = h AND (isodow(ats) < 6) = wd GROUP BY 1, 2"""


def _daily(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d).withColumn("weekday", T.is_weekday("ts"))
    return baselines.daily_means(e, ["user_id", "weekday"], "value", 96)


_DAILY = f"{E}, dm AS (SELECT user_id, isodow(ts) < 6 AS weekday, day, avg(value) AS value FROM e GROUP BY 1, 2, 3)"


def q_high_x_of_y(spark: SparkSession, d: str) -> DataFrame:
    b = baselines.high_x_of_y(_daily(spark, d), ["user_id", "weekday"], "day", "value", 4, 7)
    return b.select("user_id", "weekday", r4(F.col("baseline"), 6).alias("baseline"))


_HXY = """r AS (SELECT *, row_number() OVER (PARTITION BY user_id, weekday ORDER BY day DESC) AS n FROM {0}), k AS (SELECT *, row_number() OVER (PARTITION BY user_id, weekday ORDER BY value DESC, day DESC) AS h FROM r WHERE n <= 7)
SELECT user_id, weekday, round(avg(value), 6) AS baseline FROM k WHERE h <= 4 GROUP BY 1, 2"""
SQL_high_x_of_y = f"WITH {_DAILY}, " + _HXY.format("dm")


def q_trimmed_high_x(spark: SparkSession, d: str) -> DataFrame:
    cut = baselines.trimmed(_daily(spark, d), ["user_id", "weekday"], "value", 0.05)
    b = baselines.high_x_of_y(cut, ["user_id", "weekday"], "day", "value", 4, 7)
    return b.select("user_id", "weekday", r4(F.col("baseline"), 6).alias("baseline"))


SQL_trimmed_high_x = (
    f"WITH {_DAILY}, q AS (SELECT user_id, weekday, quantile_cont(value, 0.05) AS lo, quantile_cont(value, 0.95) AS hi, count(*) AS c FROM dm GROUP BY 1, 2), "
    "tr AS (SELECT dm.* FROM dm JOIN q USING (user_id, weekday) WHERE c < 4 OR value BETWEEN lo AND hi), " + _HXY.format("tr")
)


def q_median_slot(spark: SparkSession, d: str) -> DataFrame:
    e = baselines.with_slots(readings(spark, d).drop("slot", "day"), "ts").withColumn("hour", F.floor(F.col("slot") / 4).cast("long"))
    return baselines.slot_medians(e, ["user_id", "hour", "is_weekday"], "value").select("user_id", "hour", "is_weekday", r4(F.col("baseline")).alias("baseline"))


SQL_median_slot = "SELECT user_id, CAST(hour(ts) AS BIGINT) AS hour, isodow(ts) < 6 AS is_weekday, round(median(value), 4) AS baseline FROM events GROUP BY 1, 2, 3"


def q_upward_spread(spark: SparkSession, d: str) -> DataFrame:
    e = readings(spark, d)
    clear = baselines.top_days(e, ["user_id"], "day", "prod", 5)
    daily = clear.groupBy("user_id", "day").agg(F.avg("value").alias("value"))
    return baselines.upward_spread(daily, ["user_id"], "value").select("user_id", r4(F.col("spread")).alias("spread"))


SQL_upward_spread = f"""WITH {E}, s AS (SELECT user_id, day, sum(prod) AS p, avg(value) AS v FROM e GROUP BY 1, 2), k AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY p DESC, day) AS n FROM s)
SELECT user_id, round(greatest(0.0, quantile_cont(v, 0.75) - quantile_cont(v, 0.5)), 4) AS spread FROM k WHERE n <= 5 GROUP BY 1"""


def _user_days(spark: SparkSession, d: str) -> DataFrame:
    """(user_id, day, kwh, slots), summed in the order of events: bounds and roundings are met by totals that end there."""
    return timeseries.sums_in_order(readings(spark, d), ["user_id", "day"], ["event_id", "value"], "value", "kwh", "slots")


def q_effort_points(spark: SparkSession, d: str) -> DataFrame:
    e = _user_days(spark, d)
    tier = tiers.ladder(F.col("kwh") / F.col("slots"), [(60.0, "high"), (45.0, "mid"), (30.0, "low")], "none")
    p = e.withColumn("tier", tier).withColumn("points", tiers.effort_points(F.col("kwh"), F.col("slots")))
    p = allocation.with_totals(p, ["day"], F.sum("points").alias("pool"))
    return p.select("user_id", "day", "tier", r4(F.col("points")).alias("points"), r4(F.col("points") / F.col("pool"), 6).alias("pool_share"))


SQL_effort_points = f"""WITH {E}, s AS (SELECT user_id, day, sum(value) AS kwh, count(*) AS slots FROM e GROUP BY 1, 2), p AS (SELECT *, slots * ln(1 + kwh / slots) * 10 AS points FROM s)
SELECT user_id, day, CASE WHEN kwh / slots >= 60 THEN 'high' WHEN kwh / slots >= 45 THEN 'mid' WHEN kwh / slots >= 30 THEN 'low' ELSE 'none' END AS tier, round(points, 4) AS points, round(points / sum(points) OVER (PARTITION BY day), 6) AS pool_share FROM p"""


_UD = f"{E}, u AS (SELECT user_id, day, sum(value) AS kwh FROM e GROUP BY 1, 2)"


def q_trailing_median_spike(spark: SparkSession, d: str) -> DataFrame:
    m = timeseries.trailing(_user_days(spark, d), ["user_id"], "day", "kwh", 30, "median", "usual")
    return m.filter(F.col("kwh") > 2 * F.col("usual")).select("user_id", "day", r4(F.col("kwh")).alias("kwh"), r4(F.col("usual")).alias("usual"))


SQL_trailing_median_spike = f"""WITH {_UD}, j AS (SELECT a.user_id, a.day, a.kwh, median(b.kwh) AS usual FROM u a JOIN u b ON a.user_id = b.user_id AND b.day < a.day AND b.day >= a.day - 30 GROUP BY 1, 2, 3)
SELECT user_id, day, round(kwh, 4) AS kwh, round(usual, 4) AS usual FROM j WHERE kwh > 2 * usual"""


def q_trailing_avg_cap(spark: SparkSession, d: str) -> DataFrame:
    m = timeseries.trailing(_user_days(spark, d), ["user_id"], "day", "kwh", 30, "mean", "usual")
    cap = F.when(F.col("usual").isNull(), F.col("kwh")).otherwise(F.least(F.col("kwh"), 2 * F.col("usual")))
    return m.select("user_id", "day", r4_up(cap).alias("capped"), (F.col("kwh") > cap + 0.001).alias("was_capped"))


SQL_trailing_avg_cap = f"""WITH {_UD}, j AS (SELECT a.user_id, a.day, a.kwh, (SELECT avg(b.kwh) FROM u b WHERE a.user_id = b.user_id AND b.day < a.day AND b.day >= a.day - 30) AS usual FROM u a)
SELECT user_id, day, round(CASE WHEN usual IS NULL THEN kwh ELSE least(kwh, 2 * usual) END + 1e-9, 4) AS capped, kwh > CASE WHEN usual IS NULL THEN kwh ELSE least(kwh, 2 * usual) END + 0.001 AS was_capped FROM j"""


#: What stands for now in seasons of orders, and the season's anchor and length.
_SEASON_NOW, _SEASON_VARS = dt.datetime(1996, 7, 10), {"season_anchor_date": "1995-05-01", "season_months": 2}


def q_season_leaderboard(spark: SparkSession, d: str) -> DataFrame:
    """Orders as points: past seasons with those who have points, the current one with everybody; nothing before the anchor."""
    ctx = Context(spark, "", _SEASON_NOW, vars=_SEASON_VARS)
    o = t(spark, d, "orders").filter(F.col("o_orderdate") < F.lit(_SEASON_NOW.date()))
    day = o.groupBy(F.col("o_custkey").cast("string").alias("device_id"), F.to_date("o_orderdate").alias("ts_date")).agg(F.floor(F.sum(F.col("o_totalprice").cast("decimal(18,2)")) / 1000).cast("int").alias("daily_settlement_points"), F.count("*").cast("int").alias("daily_bonus_points"))
    points = day.select("device_id", flexibility.season(ctx, F.col("ts_date")).alias("season_start"), "daily_settlement_points", "daily_bonus_points", (F.col("daily_settlement_points") + F.col("daily_bonus_points")).alias("daily_points"))
    return flexibility.rec_points_leaderboard(ctx, checkpointed(points), t(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("device_id")))


_SEASON = "CAST(DATE '1995-05-01' + INTERVAL (CAST(floor(((year({0}) - 1995) * 12 + month({0}) - 5) / 2.0) * 2 AS INT)) MONTH AS DATE)"
SQL_season_leaderboard = f"""WITH d AS (SELECT o_custkey::VARCHAR AS device_id, CAST(o_orderdate AS DATE) AS ts_date, CAST(floor(sum(CAST(o_totalprice AS DECIMAL(18, 2))) / 1000) AS INT) AS base, count(*)::INT AS bonus FROM orders WHERE o_orderdate < DATE '1996-07-10' GROUP BY 1, 2),
p AS (SELECT device_id, {_SEASON.format("ts_date")} AS season_start, sum(base)::BIGINT AS season_base_points, sum(bonus)::BIGINT AS season_bonus_points, sum(base + bonus)::BIGINT AS season_points FROM d GROUP BY 1, 2 HAVING season_start >= DATE '1995-05-01'),
u AS (SELECT c_custkey::VARCHAR AS device_id, DATE '1996-07-01' AS season_start FROM customer),
s AS (SELECT * FROM p WHERE season_start <> DATE '1996-07-01' UNION ALL SELECT u.device_id, u.season_start, coalesce(season_base_points, 0), coalesce(season_bonus_points, 0), coalesce(season_points, 0) FROM u LEFT JOIN p USING (device_id, season_start)),
a AS (SELECT device_id, sum(season_base_points)::BIGINT AS alltime_base_points, sum(season_bonus_points)::BIGINT AS alltime_bonus_points FROM p GROUP BY 1)
SELECT md5(device_id || strftime(season_start, '%Y-%m-%d')) AS _id, device_id, season_start, CAST(season_start + INTERVAL 2 MONTH AS DATE) AS season_end, season_base_points, season_bonus_points, season_points, rank() OVER (PARTITION BY season_start ORDER BY season_points DESC) AS season_rank,
count(*) OVER (PARTITION BY season_start) AS total_members, coalesce(alltime_base_points, 0) AS alltime_base_points, coalesce(alltime_bonus_points, 0) AS alltime_bonus_points, season_start = DATE '1996-07-01' AS is_current_season FROM s LEFT JOIN a USING (device_id)"""


def q_percent_rank(spark: SparkSession, d: str) -> DataFrame:
    s = checkpointed(_user_days(spark, d).select("day", "user_id", F.round("kwh").cast("long").alias("points")))
    pct = F.coalesce(F.col("below") / F.nullif(F.col("members") - 1, F.lit(0)), F.lit(0.0))
    return allocation.with_places(s, ["day"], "points").select("day", "user_id", "points", r4(pct, 6).alias("pct"), "rank")


SQL_percent_rank = f"WITH {E}, s AS (SELECT day, user_id, CAST(round(sum(value)) AS BIGINT) AS points FROM e GROUP BY 1, 2) SELECT day, user_id, points, round(percent_rank() OVER (PARTITION BY day ORDER BY points), 6) AS pct, rank() OVER (PARTITION BY day ORDER BY points DESC) AS rank FROM s"


def q_streak_step(spark: SparkSession, d: str) -> DataFrame:
    """Weekly steps from the first to the last week with a purchase, from no state."""
    week = F.floor(F.datediff("day", F.lit("1970-01-05")) / 7).cast("int")
    p = readings(spark, d).filter("event_type = 'purchase'").groupBy(F.col("user_id").alias("device_id"), week.alias("period")).agg((F.sum("value") > 60).alias("responded"))
    p = joins.with_scalars(p, p.agg(F.min("period").alias("a"), F.max("period").alias("z")))
    state = streaks.run_streaks(p, F.col("a"), F.col("z"))
    return state.select("device_id", F.col("level").cast("long").alias("level"), F.col("peak").cast("long").alias("peak"), F.round(tiers.streak_multiplier(F.col("level")), 4).alias("multiplier"))


SQL_streak_step = f"""WITH RECURSIVE {E}, p AS (SELECT user_id, CAST(date_trunc('week', day) AS DATE) AS w, sum(value) > 60 AS ok FROM e WHERE event_type = 'purchase' GROUP BY 1, 2), b AS (SELECT min(w) AS a, max(w) AS z FROM p),
r(user_id, w, lv, pk) AS (SELECT DISTINCT user_id, (SELECT a FROM b), 0, 0 FROM p UNION ALL
  SELECT user_id, w, lv, greatest(pk, lv) FROM (SELECT r.user_id, CAST(r.w + INTERVAL 7 DAY AS DATE) AS w, CASE WHEN coalesce(p.ok, false) THEN least(lv + 1, 10) ELSE least(lv, greatest(lv - 1, round_even(pk * 0.5, 0)::INT, 0)) END AS lv, pk FROM r LEFT JOIN p ON p.user_id = r.user_id AND p.w = r.w WHERE r.w <= (SELECT z FROM b)))
SELECT user_id AS device_id, lv::BIGINT AS level, pk::BIGINT AS peak, round(least(1.0 + lv * 0.05, 1.5)::DOUBLE, 4) AS multiplier FROM r WHERE w > (SELECT z FROM b)"""


def _own(spark: SparkSession, d: str) -> DataFrame:
    """Production stands for what a device uses of its own energy; decimals, so that rounding is the same everywhere."""
    return readings(spark, d).select("user_id", "ts", "day", F.col("prod").cast("decimal(18,4)").alias("self_consumed_kwh"))


def _factors(spark: SparkSession) -> DataFrame:
    rows = [("it", Decimal("0.233"), Decimal("21.0")), ("de", Decimal("0.400"), Decimal("20.0"))]
    return spark.createDataFrame(rows, "country string, kg_co2_per_kwh decimal(6,3), trees_per_ton decimal(4,1)")


_SAVED = ["consumption_kwh", "co2_avoided_kg", "trees_equivalent"]
_SAVED_SQL = "CAST(round(kwh, 4) AS DOUBLE) AS consumption_kwh, CAST(round(kwh * 0.233, 3) AS DOUBLE) AS co2_avoided_kg, CAST(round(CAST(kwh * 0.233 * 0.021 AS DECIMAL(30, 10)), 6) AS DOUBLE) AS trees_equivalent"


def q_co2(spark: SparkSession, d: str) -> DataFrame:
    """What each device's own energy of a day saved: no windows, no rounding before the factors."""
    g = _own(spark, d).groupBy("user_id", "day").agg(F.sum("self_consumed_kwh").alias("consumption_kwh"))
    return flexibility.savings(g, _factors(spark), "it").select("user_id", "day", *(F.col(c).cast("double").alias(c) for c in _SAVED))


SQL_co2 = f"WITH {E}, g AS (SELECT user_id, day, sum(CAST(prod AS DECIMAL(18, 4))) AS kwh FROM e GROUP BY 1, 2) SELECT user_id, day, {_SAVED_SQL} FROM g"


def q_co2_community(spark: SparkSession, d: str) -> DataFrame:
    """The same of all readings that lie in a window of their device, with the devices that took part."""
    e, w = _own(spark, d), _windows(spark, d)
    hit = joins.interval_join(e.select("user_id", "ts").distinct(), w.select("user_id", "start_ts", "end_ts").distinct(), ["user_id"], "ts", "start_ts", "end_ts").select("user_id", "ts").distinct()
    g = e.join(hit, ["user_id", "ts"], "left_semi").groupBy("day").agg(F.countDistinct("user_id").alias("participating_devices"), F.sum("self_consumed_kwh").alias("consumption_kwh"))
    return flexibility.savings(g, _factors(spark), "it").select("day", *(F.col(c).cast("double").alias(c) for c in _SAVED), "participating_devices")


SQL_co2_community = f"""WITH {E}, {_WIN}, g AS (SELECT day, count(DISTINCT user_id) AS participating_devices, sum(CAST(prod AS DECIMAL(18, 4))) AS kwh FROM e
WHERE EXISTS (SELECT 1 FROM w WHERE w.user_id = e.user_id AND ts >= start_ts AND ts < end_ts) GROUP BY 1) SELECT day, {_SAVED_SQL}, participating_devices FROM g"""


def q_anti_gaming(spark: SparkSession, d: str) -> DataFrame:
    """Readings as bonuses: a window an event, cut where it is over 60."""
    e = readings(spark, d).select(F.col("event_id").cast("string").alias("_id"), F.col("user_id").cast("string").alias("device_id"), F.col("ts").alias("window_start"), T.plus("ts", hours=1).alias("window_end"), F.col("value").alias("bonus_points_raw"))
    b = e.withColumn("bonus_points_capped", F.least(F.col("bonus_points_raw"), F.lit(60.0))).withColumn("bonus_points", F.floor(F.col("bonus_points_capped") * F.when(F.dayofmonth("window_start") % 7 == 0, 30).otherwise(1)).cast("int"))
    return flexibility.rec_anti_gaming_flags(Context(spark, "", dt.datetime(2024, 1, 31)), b)


SQL_anti_gaming = f"""WITH {E}, b AS (SELECT event_id, user_id::VARCHAR AS device_id, ts AS window_start, value AS raw, least(value, 60.0) AS capped, CAST(floor(least(value, 60.0) * CASE WHEN day(ts) % 7 = 0 THEN 30 ELSE 1 END) AS INT) AS points FROM e),
d AS (SELECT device_id, CAST(window_start AS DATE) AS flag_date, sum(points)::BIGINT AS daily FROM b GROUP BY 1, 2),
m AS (SELECT d.device_id, d.flag_date, d.daily, quantile_cont(p.daily, 0.5) AS med FROM d JOIN d p ON p.device_id = d.device_id AND p.flag_date >= d.flag_date - INTERVAL 30 DAY AND p.flag_date < d.flag_date GROUP BY 1, 2, 3),
u AS (SELECT device_id, flag_date, 'L4_DAILY_SPIKE' AS flag_type, daily::DOUBLE AS metric_value, med * 10 AS threshold_value, 'warning' AS severity, '' AS more FROM m WHERE med > 0 AND daily > med * 10
UNION ALL SELECT DISTINCT ON (device_id, window_start) device_id, CAST(window_start AS DATE), 'L3_WINDOW_CAP', raw, capped, 'info', strftime(window_start, '%Y-%m-%d %H:%M:%S') FROM b WHERE raw > capped + 0.001)
SELECT md5(device_id || strftime(flag_date, '%Y-%m-%d') || flag_type || more) AS _id, device_id, flag_date, flag_type, metric_value, threshold_value, severity FROM u"""
