"""Flexibility: windows, settlement, commitments, points, bonuses, seasons, savings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import Context
from ..functions import keys, tiers, time as T
from ..materialize import Table
from ..operators import allocation, baselines, dedup, joins, streaks, timeseries
from ..registry import Days, Hook, model

#: kWh of an hour's surplus that counts; first hour of the day; hours of a window at most and at least (fixed values).
SURPLUS_KWH, FIRST_HOUR, MOST_HOURS, LEAST_HOURS = 0.5, 5, 3, 2
#: Least consumption of a slot that a baseline assumes, kWh (fixed value).
FLOOR_KWH = 0.025
#: Effort over the baseline -> multiplier; shifted share -> multiplier (fixed values).
EFFORT = [(1.5, 2.0), (1.25, 1.5), (1.1, 1.0), (1.0, 0.5)]
SHIFT = [(1.0, 2.5), (0.5, 2.0), (0.25, 1.5)]
LIVE = ("committed", "settled")
BASE_KEYS = ["device_id", "slot", "is_weekday"]


def _wide_baselines(b: DataFrame) -> DataFrame:
    """One row per device, slot and kind of day, a column per type: one join serves every lookup."""
    types = ["settlement", "reference", "grid_export_median", "shift_potential", "import_spread"]
    return b.groupBy(*BASE_KEYS).agg(*(F.max(F.when(F.col("baseline_type") == t, F.col("baseline_kwh"))).alias(f"b_{t}") for t in types))


def _slotted(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumn("slot", T.slot_of_day(ts)).withColumn("is_weekday", T.is_weekday(ts))


@model("meters_data_15m", "rec_active_devices", layer="silver", tags=("flexibility",))
def rec_meters_15m(ctx: Context, meters: DataFrame, active: DataFrame) -> DataFrame:
    own = F.greatest(F.col("self_consumed_kwh"), F.lit(0.0))
    m = meters.join(active, "device_id", "left_semi")
    return m.select("_id", "device_id", "ts", "consumption_kwh", "production_kwh", (F.col("self_consumed_kwh") + F.col("production_kwh")).alias("pv_production_kwh"), own.alias("self_consumed_kwh"), (F.col("consumption_kwh") + own).alias("total_consumption_kwh"))


@model("flexibility_commitments_mirror", layer="silver", kind="table", tags=("flexibility",))
def silver_flexibility_commitments(ctx: Context, raw: DataFrame) -> DataFrame:
    time = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return raw.select(
        F.col("id").alias("commitment_id"), "user_id", "suggestion_id", "suggestion_type", "community_id", "device_id", *map(time, ("period_start", "period_end", "committed_at", "settled_at", "reminded_at")),
        F.split_part(F.col("status"), F.lit("."), F.lit(-1)).alias("status"), "reward_points_estimated", "reward_points_actual", T.hours_between("period_start", "period_end").alias("window_duration_hours"), "last_updated",
    )


@model("rec_device_baselines_raw", tags=("flexibility",))
def rec_device_baselines(ctx: Context, b: DataFrame) -> DataFrame:
    return b.select("device_id", "baseline_type", "slot", "is_weekday", "baseline_kwh", "computed_at")


@model("rec_device_streaks_raw", tags=("flexibility",))
def rec_device_streaks(ctx: Context, s: DataFrame) -> DataFrame:
    return s.select("device_id", "level", "peak", "multiplier", "computed_at")


@model("rec_meters_15m", tags=("flexibility",))
def rec_device_class(ctx: Context, meters: DataFrame) -> DataFrame:
    """Devices without any generation of their own behind the meter."""
    return meters.groupBy("device_id").agg((F.max("pv_production_kwh") == 0.0).alias("is_m1_only"))


def compute_baselines(ctx: Context, history: DataFrame, select: int = 4, candidates: int = 7, min_readings: int = 96, trim: float = 0.05, least_days: int = 14, value: str = "total_consumption_kwh") -> DataFrame:
    """All baseline types of the devices with enough days: (device_id, baseline_type, slot, is_weekday, baseline_kwh, computed_at)."""
    h = baselines.with_slots(history, "ts")
    h = h.join(baselines.settled_devices(h, "device_id", least_days), "device_id", "left_semi")
    m1 = h.groupBy("device_id").agg((F.max("pv_production_kwh") == 0).alias("m1"))
    exports = h.groupBy("device_id").agg(F.sum("production_kwh").alias("e")).filter("e > 0").select("device_id")
    exported = baselines.slot_medians(h.join(m1.filter("m1"), "device_id", "left_semi"), BASE_KEYS, "production_kwh")
    base = h.join(m1, "device_id").join(exported.withColumnRenamed("baseline", "usual_export"), BASE_KEYS, "left")
    proxy = baselines.consumption_proxy(F.col("consumption_kwh"), F.col("production_kwh"), F.col("usual_export"))
    base = base.withColumn("used", F.when(F.col("m1"), proxy).otherwise(F.col(value)))
    daily = baselines.daily_means(base, BASE_KEYS, "used", min_readings)
    seen = baselines.daily_means(baselines.top_days(h.join(exports, "device_id", "left_semi"), ["device_id"], "day", "production_kwh", 7), BASE_KEYS, value)
    imports = baselines.daily_means(h, BASE_KEYS, "consumption_kwh")
    kinds = {
        "settlement": baselines.high_x_of_y(daily, BASE_KEYS, "day", "used", select, candidates),
        "reference": baselines.high_x_of_y(baselines.trimmed(daily, BASE_KEYS, "used", trim), BASE_KEYS, "day", "used", select, candidates),
        "grid_export_median": exported,
        "shift_potential": baselines.upward_spread(seen, BASE_KEYS, value, out="baseline"),
        "import_spread": baselines.upward_spread(imports, BASE_KEYS, "consumption_kwh", out="baseline"),
    }
    out = [d.select("device_id", F.lit(k).alias("baseline_type"), "slot", "is_weekday", F.col("baseline").alias("baseline_kwh")) for k, d in kinds.items()]
    rows = out[0]
    for d in out[1:]:
        rows = rows.unionByName(d)
    return rows.withColumn("computed_at", ctx.now())


def weekly_streaks(ctx: Context, previous: DataFrame, bonus: DataFrame, fleet: DataFrame) -> DataFrame:
    """Streak state after the week before ``as_of``: a device responded if it earned a bonus."""
    week = bonus.filter((F.col("window_start") >= ctx.now() - F.expr("INTERVAL 7 DAYS")) & (F.col("window_start") < ctx.now()))
    responses = week.groupBy("device_id").agg((F.sum("bonus_points") > 0).alias("responded"))
    state = streaks.update_streaks(previous, responses, fleet)
    return state.withColumn("multiplier", tiers.streak_multiplier(F.col("level"))).withColumn("computed_at", ctx.now())


def auto_commitments(ctx: Context, meters: DataFrame, windows: DataFrame, community: str) -> DataFrame:
    """A synthetic commitment of every device with meter rows to every distinct window of today and tomorrow.

    The windows of two days (at most a dozen a day, as none is shorter than LEAST_HOURS) ride along as one array.
    """
    w = windows.filter((F.col("ts_date") >= ctx.today()) & (F.col("ts_date") <= ctx.today(-1))).select("window_start", "window_end").distinct()
    both = joins.with_scalars(meters.select("device_id").distinct(), w.agg(F.collect_list(F.struct("window_start", "window_end")).alias("w"))).select("device_id", F.explode("w").alias("w")).select("device_id", "w.*")
    named = lambda *parts: F.concat(F.lit("auto-"), *parts)
    span = F.concat(F.date_format("window_start", "yyyyMMddHHmm"), F.lit("-"), F.date_format("window_end", "HHmm"))
    never = lambda name, kind: F.lit(None).cast(kind).alias(name)
    return both.select(
        named("device_id", F.lit("-"), span).alias("id"), named(F.lit("user-"), "device_id").alias("user_id"), named(F.lit("sug-"), span).alias("suggestion_id"), F.lit("solar_overproduction").alias("suggestion_type"), F.lit(community).alias("community_id"),
        "device_id", F.col("window_start").alias("period_start"), F.col("window_end").alias("period_end"), ctx.now().alias("committed_at"), never("settled_at", "timestamp_ntz"), never("reminded_at", "timestamp_ntz"),
        F.lit("committed").alias("status"), F.lit(10).alias("reward_points_estimated"), never("reward_points_actual", "int"), ctx.now().alias("last_updated"),
    )


def auto_commit(ctx: Context, mirror: Table, meters: DataFrame, windows: DataFrame) -> bool:
    """Takes the synthetic commitments of former runs out of the mirror and puts today's and tomorrow's in, in one commit.

    Only where the variable ``auto_commit`` is set; without devices or windows the mirror stays as it is. Whether it was written.
    """
    if not ctx.var("auto_commit", False):
        return False
    batch = auto_commitments(ctx, meters, windows, ctx.var("community", "community"))
    if batch.isEmpty():
        return False
    mirror.replace_range(batch, F.col("id").startswith("auto-"))
    return True


def surplus_windows(forecast: DataFrame) -> DataFrame:
    """(ts_date, window_start, window_end, community_kwh) of hourly surplus (ts, net_exchange_kwh)."""
    f = forecast.filter((F.col("net_exchange_kwh") > SURPLUS_KWH) & (F.hour("ts") >= FIRST_HOUR)).withColumn("ts_date", F.to_date("ts"))
    c = timeseries.chunks(timeseries.sessions(f, ["ts_date"], "ts", 3600), ["ts_date", "session"], "ts", MOST_HOURS)
    w = c.groupBy("ts_date", "session", "chunk").agg(F.min("ts").alias("window_start"), T.plus(F.max("ts"), hours=1).alias("window_end"), F.sum("net_exchange_kwh").alias("community_kwh"), F.count("*").alias("hours"))
    return w.filter(F.col("hours") >= LEAST_HOURS).drop("session", "chunk", "hours")


def hit_rate(past: DataFrame, actual: DataFrame) -> DataFrame:
    """(confidence): how often hours of past windows had the surplus, within 0.30 and 0.95; null without actuals."""
    hours = timeseries.hours(past.select("window_start", "window_end"), "window_start", "window_end")
    real = actual.groupBy(T.floor_hour("ts").alias("ts")).agg(F.avg("net_exchange_kwh").alias("net"))
    rate = F.count_if(F.col("net") > SURPLUS_KWH) / F.nullif(F.count("net"), F.lit(0))
    r = hours.join(real, "ts", "left").agg(rate.alias("rate"))
    return r.select(F.when(F.col("rate").isNotNull(), F.round(F.least(F.lit(0.95), F.greatest(F.lit(0.30), F.col("rate"))), 2)).alias("confidence"))


def _from_today(ctx: Context) -> Column:
    return F.col("ts_date") >= ctx.today()


#: Of forecasts later runs read the hours from today on.
_AHEAD = Days("to_date(CAST(timestamp AS TIMESTAMP_NTZ))")


@model("total_meters_forecast", kind="range", full_refresh=False, replaced=_from_today, tags=("flexibility",))
def rec_flexibility_windows_community(ctx: Context, forecast: DataFrame) -> DataFrame:
    """Windows of the newest forecast. On later runs only days from ``as_of`` on are replaced, so history stays; their
    confidence is the hit rate of the windows of the 30 days before, as the table holds them."""
    f = forecast.withColumn("ts", F.col("timestamp").cast("timestamp_ntz"))
    newest = dedup.newest_generation(f.filter("period = 'forecast'"), "generated_at")
    if ctx.target is None:
        w = surplus_windows(newest.select("ts", "net_exchange_kwh")).withColumn("confidence", F.lit(None).cast("double"))
    else:
        past = ctx.target.filter((F.col("ts_date") >= ctx.today(30)) & (F.col("ts_date") < ctx.today()))
        actual = f.filter((F.col("period") == "actual") & (F.col("ts") >= ctx.today(31)) & (F.col("ts") < ctx.today()))
        w = joins.with_scalars(surplus_windows(newest.filter(F.col("ts") >= ctx.today()).select("ts", "net_exchange_kwh")), hit_rate(past, actual))
    key = keys.md5_key(F.col("ts_date"), keys.stamp("window_start"), keys.stamp("window_end"))
    return w.select(key.alias("_id"), "ts_date", "window_start", "window_end", F.round("community_kwh", 2).alias("community_kwh"), "confidence", F.lit(ctx.var("flexibility_model", "solar_overproduction")).alias("flexibility_model"))


def reward_points(kwh: Column, start: Column, end: Column) -> Column:
    slots = T.hours_between(start, end) * 4
    return F.round(tiers.effort_points(kwh, slots)).cast("int")


@model("rec_flexibility_windows_community", "meters_energy_forecast", "rec_device_baselines", "rec_device_class", kind="range", full_refresh=False, replaced=_from_today, reads={"rec_flexibility_windows_community": Days("ts_date"), "meters_energy_forecast": _AHEAD}, tags=("flexibility",))
def rec_flexibility_windows(ctx: Context, windows: DataFrame, forecast: DataFrame, base: DataFrame, classes: DataFrame) -> DataFrame:
    """Per device and window: expected use, held to the community's surplus, and the points to gain."""
    used = F.coalesce("total_consumption_kwh", "grid_import_kwh", F.lit(0.0))
    f = forecast.filter("period = 'forecast' AND data_missing = 0").withColumn("ts", F.col("timestamp").cast("timestamp_ntz"))
    f = dedup.latest(f, ["device_id", "ts"], "generated_at").select("device_id", "ts", used.alias("used"))
    w = windows.select("ts_date", "window_start", "window_end", "community_kwh", "confidence")
    at = ["device_id", "ts_date", "window_start", "window_end", "community_kwh", "confidence"]
    live = joins.interval_join(f, w, [], "ts", "window_start", "window_end").groupBy(*at).agg(F.sum("used").alias("forecast_kwh"))
    based = base.filter("baseline_type = 'shift_potential'").select("device_id").distinct().withColumn("based", F.lit(True))
    slots = _slotted(timeseries.hours(live.join(based, "device_id"), "window_start", "window_end", "15 MINUTES", "at"), "at").join(_wide_baselines(base), BASE_KEYS, "left")
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    sums = slots.groupBy(*at).agg(
        F.sum(F.coalesce("b_settlement", F.lit(FLOOR_KWH))).alias("expected"), F.sum(zero("b_shift_potential")).alias("potential"), F.sum(zero("b_grid_export_median") + zero("b_import_spread")).alias("cap")
    )
    gain = F.when(F.coalesce("is_m1_only", F.lit(False)), F.least("potential", "cap")).otherwise(F.col("potential"))
    known = sums.join(classes, "device_id", "left").select(*at, ((F.col("expected") + gain) * float(ctx.var("calibration_lambda", 1.0))).alias("kwh"))
    other = live.join(based, "device_id", "left_anti").select(*at, F.col("forecast_kwh").alias("kwh"))
    kwh = F.when(F.col("total") > F.col("community_kwh"), F.col("kwh") / F.col("total") * F.col("community_kwh")).otherwise(F.col("kwh"))
    d = allocation.with_totals(known.unionByName(other), ["window_start", "window_end"], F.sum("kwh").alias("total")).filter("kwh > 0").withColumn("estimate", kwh)
    return d.select(
        keys.md5_key(F.col("device_id"), F.col("ts_date"), keys.stamp("window_start"), keys.stamp("window_end")).alias("_id"), "device_id", "ts_date", "window_start", "window_end", F.round("community_kwh", 2).alias("community_kwh"),
        F.round("estimate", 2).alias("estimated_kwh"), reward_points(F.col("estimate"), F.col("window_start"), F.col("window_end")).alias("reward_points_estimated"), "confidence", F.lit(ctx.var("flexibility_model", "solar_overproduction")).alias("flexibility_model"),
    )


@model("rec_meters_15m", "rec_flexibility_windows", kind="merge", key=("_id",), reads={"rec_meters_15m": Days("ts", 2)}, tags=("flexibility",))
def rec_settlement_15m(ctx: Context, meters: DataFrame, windows: DataFrame) -> DataFrame:
    """Readings with the earliest window of their device that holds them, if any."""
    w = windows.select("device_id", "window_start", "window_end", "ts_date", F.col("estimated_kwh").alias("window_estimated_kwh"), F.col("reward_points_estimated").alias("window_reward_points_estimated"))
    m = meters.select("device_id", "ts", "consumption_kwh", F.col("consumption_kwh").alias("grid_import_kwh"), F.col("production_kwh").alias("grid_export_kwh"), "total_consumption_kwh")
    j = joins.interval_join(m, w, ["device_id"], "ts", "window_start", "window_end", "left")
    first = dedup.distinct_on(j, ["device_id", "ts"], F.col("window_start").asc_nulls_last(), F.col("window_end").asc_nulls_last())
    keep = "ts device_id consumption_kwh grid_import_kwh grid_export_kwh total_consumption_kwh window_start window_end ts_date window_estimated_kwh window_reward_points_estimated"
    return first.select(keys.md5_key(F.col("device_id"), keys.stamp("ts")).alias("_id"), *keep.split())


@model("rec_settlement_15m", kind="merge", key=("_id",), reads={"rec_settlement_15m": Days("ts", 2)}, tags=("flexibility",))
def rec_settlement_1h(ctx: Context, slots: DataFrame) -> DataFrame:
    g = slots.groupBy("device_id", T.floor_hour("ts").alias("ts")).agg(F.sum("consumption_kwh").alias("consumption_kwh"), *(F.max(c).alias(c) for c in ("window_start", "window_end", "ts_date", "window_estimated_kwh")))
    return g.select(keys.md5_key(F.col("device_id"), keys.stamp("ts")).alias("_id"), "ts", "device_id", "consumption_kwh", "window_start", "window_end", "ts_date", "window_estimated_kwh")


@model("rec_settlement_15m", "rec_device_class", "rec_device_baselines", "total_meters_forecast", kind="merge", key=("_id",), reads={"rec_settlement_15m": Days("ts", 2)}, tags=("flexibility",))
def rec_settlement_points(ctx: Context, slots: DataFrame, classes: DataFrame, base: DataFrame, forecast: DataFrame) -> DataFrame:
    """Points per slot: the logarithm of the use times the effort over the baseline; in a surplus in full, else by share of what is made."""
    s = _slotted(slots.select("ts", "device_id", "grid_import_kwh", "grid_export_kwh", "total_consumption_kwh"), "ts")
    s = s.join(classes, "device_id", "left").join(_wide_baselines(base), BASE_KEYS, "left").withColumn("is_m1_only", F.coalesce("is_m1_only", F.lit(False)))
    used = F.when(F.col("is_m1_only"), baselines.consumption_proxy(F.col("grid_import_kwh"), F.col("grid_export_kwh"), F.col("b_grid_export_median"))).otherwise(F.col("total_consumption_kwh"))
    s = s.withColumn("consumption_kwh", used).withColumn("baseline_kwh", F.coalesce("b_settlement", F.lit(FLOOR_KWH)))
    made = forecast.filter("period = 'actual'").groupBy(T.floor_hour(F.col("timestamp").cast("timestamp_ntz")).alias("hr")).agg((F.avg("production_kwh") / 4).alias("made"))
    ratio = F.when(F.col("baseline_kwh") < FLOOR_KWH, 1.0).otherwise(F.col("consumption_kwh") / F.nullif("baseline_kwh", F.lit(0.0)))
    s = s.withColumn("effort_ratio", ratio).withColumn("effort_multiplier", tiers.ladder(F.col("effort_ratio"), EFFORT, 0.25))
    s = s.withColumn("weight", F.log1p("consumption_kwh") * F.col("effort_multiplier")).withColumn("log_scaled_points", F.col("weight") * 10)
    s = allocation.with_totals(s, ["ts"], F.sum("grid_import_kwh").alias("comm_grid_import_kwh"), F.sum("weight").alias("all_weight")).withColumn("hr", T.floor_hour("ts"))
    s = s.join(made, "hr", "left").withColumn("comm_grid_export_kwh", F.coalesce("made", F.lit(0.0)))
    s = s.withColumns({"is_surplus_interval": (F.col("comm_grid_export_kwh") >= F.col("comm_grid_import_kwh")).cast("int"), "has_production": (F.col("comm_grid_export_kwh") > 0).cast("int")})
    full = F.when(F.col("is_surplus_interval") == 1, F.col("log_scaled_points")).otherwise(0.0)
    pool = F.when((F.col("is_surplus_interval") == 0) & (F.col("has_production") == 1) & (F.col("all_weight") > 0), F.col("comm_grid_export_kwh") * 10 * F.col("weight") / F.col("all_weight")).otherwise(0.0)
    s = s.withColumn("effort_adjusted_points", full).withColumn("pool_share_points", pool).withColumn("settlement_points", full + pool)
    keep = "ts device_id consumption_kwh baseline_kwh is_m1_only grid_import_kwh grid_export_kwh effort_ratio effort_multiplier comm_grid_export_kwh comm_grid_import_kwh is_surplus_interval has_production log_scaled_points effort_adjusted_points pool_share_points settlement_points"
    return s.select(keys.md5_key(F.col("device_id"), keys.stamp("ts")).alias("_id"), *keep.split())


def bonus_of_live_commitments(ctx: Context, bonus: DataFrame, commits: DataFrame) -> DataFrame:
    """After a bonus run: rows whose window no live commitment of the device holds any more go. The interval in the interval is
    found by start times: windows meet the periods that hold their start, by buckets of time."""
    live = commits.filter(F.col("status").isin(*LIVE)).select("device_id", F.col("period_start").alias("held_from"), F.col("period_end").alias("held_to")).distinct()
    own = bonus.select("_id", "device_id", F.col("window_start").alias("from"), F.col("window_end").alias("to"))
    met = joins.interval_join(own, live, ["device_id"], "from", "held_from", "held_to").filter("`to` <= held_to").select(F.col("_id").alias("__id"))
    return bonus.join(met, F.col("_id") == F.col("__id"), "left_semi")


@model("silver_flexibility_commitments", "rec_flexibility_windows", "rec_settlement_points", "rec_device_baselines", "rec_device_streaks", kind="merge", key=("_id",), reads={"silver_flexibility_commitments": Days("period_start", 7)}, hooks=(Hook(bonus_of_live_commitments, ("silver_flexibility_commitments",)),), tags=("flexibility",))
def rec_flexibility_bonus(ctx: Context, commits: DataFrame, windows: DataFrame, points: DataFrame, base: DataFrame, state: DataFrame) -> DataFrame:
    """What a device shifted into the windows that it committed to, over its reference."""
    at = ["device_id", "window_start", "window_end"]
    c = commits.filter(F.col("status").isin(*LIVE)).select("device_id", F.col("period_start").alias("window_start"), F.col("period_end").alias("window_end"))
    w = c.join(windows.select(*at), at, "left_semi").distinct()
    got = joins.interval_join(points.select("device_id", "ts", "consumption_kwh", "is_surplus_interval"), w, ["device_id"], "ts", "window_start", "window_end")
    got = got.groupBy(*at).agg(F.sum("consumption_kwh").alias("actual_kwh"), F.count("*").alias("n"), F.sum((F.col("is_surplus_interval") == 1).cast("int")).alias("surplus"))
    slots = _slotted(timeseries.hours(got.select(*at), "window_start", "window_end", "15 MINUTES", "at"), "at").join(_wide_baselines(base), BASE_KEYS, "left")
    reference = slots.groupBy(*at).agg(F.coalesce(F.sum("b_reference"), F.lit(0.0)).alias("reference_kwh"))
    s = got.join(reference, at).withColumn("shifted_kwh", F.greatest(F.col("actual_kwh") - F.col("reference_kwh"), F.lit(0.0)))
    s = s.withColumn("shift_fraction", tiers.share(F.col("shifted_kwh"), F.col("reference_kwh")))
    mult = F.when((F.col("shift_fraction") < 0.05) | (F.col("shifted_kwh") < 0.05), 0.0).otherwise(tiers.ladder(F.col("shift_fraction"), SHIFT, 1.0))
    s = s.withColumns({"shift_effort_mult": mult, "event_mult": F.lit(1.0), "accuracy": F.greatest(F.lit(0.5), F.col("surplus") / F.nullif("n", F.lit(0)))})
    s = s.join(state.select("device_id", F.col("multiplier").alias("streak_mult")), "device_id", "left").withColumn("streak_mult", F.coalesce("streak_mult", F.lit(1.0)))
    s = s.withColumn("bonus_points_raw", F.col("shifted_kwh") * 15 * F.col("shift_effort_mult") * F.col("event_mult") * F.col("accuracy") * F.col("streak_mult"))
    recent = F.when(F.col("window_start") >= ctx.now() - F.expr("INTERVAL 30 DAYS"), F.col("bonus_points_raw"))
    s = s.withColumn("usual", F.avg(recent).over(Window.partitionBy("device_id")))
    capped = F.when(F.col("usual").isNull() | (F.col("usual") == 0), F.col("bonus_points_raw")).otherwise(F.least("bonus_points_raw", F.col("usual") * 2))
    s = s.withColumn("bonus_points_capped", capped).withColumn("bonus_points", F.round("bonus_points_capped").cast("int")).filter("shifted_kwh > 0")
    keep = "shifted_kwh reference_kwh shift_fraction shift_effort_mult event_mult accuracy streak_mult bonus_points_raw bonus_points_capped bonus_points"
    return s.select(keys.md5_key(F.col("device_id"), keys.stamp("window_start"), keys.stamp("window_end")).alias("_id"), *at, *keep.split())


def _budgets(windows: DataFrame) -> DataFrame:
    return windows.groupBy("window_start", "window_end").agg(F.min("community_kwh").alias("budget"))


@model("silver_flexibility_commitments", "rec_settlement_1h", "rec_flexibility_windows", "rec_settlement_points", "rec_flexibility_bonus", kind="merge", key=("commitment_id",), reads={"silver_flexibility_commitments": Days("last_updated", 2)}, update=("status", "actual_kwh", "allocated_kwh", "reward_points_actual", "adherence_ratio"), tags=("flexibility",))
def rec_commitment_settlement(ctx: Context, commits: DataFrame, hours: DataFrame, windows: DataFrame, points: DataFrame, bonus: DataFrame) -> DataFrame:
    """What each commitment used in its period, its part of the window's budget, and its points."""
    span = commits.select("commitment_id", "device_id", "period_start", "period_end")
    per = lambda df, value, out: joins.interval_join(df, span, ["device_id"], "ts", "period_start", "period_end").groupBy("commitment_id").agg(F.sum(value).alias(out))
    used = per(hours.filter("window_start IS NOT NULL").select("device_id", "ts", "consumption_kwh"), "consumption_kwh", "actual_kwh")
    layer1 = per(points.select("device_id", "ts", "settlement_points"), "settlement_points", "layer1")
    layer2 = bonus.groupBy("device_id", F.col("window_start").alias("period_start"), F.col("window_end").alias("period_end")).agg(F.sum("bonus_points").alias("layer2"))
    budget = _budgets(windows).select(F.col("window_start").alias("period_start"), F.col("window_end").alias("period_end"), "budget")
    c = commits.join(used, "commitment_id", "left").join(layer1, "commitment_id", "left").join(layer2, ["device_id", "period_start", "period_end"], "left").join(budget, ["period_start", "period_end"], "left")
    c = c.withColumn("actual_kwh", F.coalesce("actual_kwh", F.lit(0.0))).withColumn("live", F.col("status").isin(*LIVE))
    # a suggestion may go to the whole fleet: its total comes from partial sums
    claims = commits.filter(F.col("status").isin(*LIVE)).join(used, "commitment_id", "left").groupBy(F.col("suggestion_id").alias("__s")).agg(F.sum(F.coalesce("actual_kwh", F.lit(0.0))).alias("total"))
    c = c.join(claims, F.col("suggestion_id").eqNullSafe(F.col("__s")), "left").drop("__s")
    fits = F.col("budget").isNull() | F.col("total").isNull() | (F.col("total") <= F.col("budget"))
    part = F.when(~F.col("live"), 0.0).when(fits, F.col("actual_kwh")).otherwise(F.round(F.col("actual_kwh") / F.nullif("total", F.lit(0.0)) * F.col("budget"), 4))
    gained = F.round(F.coalesce("layer1", F.lit(0.0)) + F.coalesce("layer2", F.lit(0))).cast("int")
    c = c.withColumn("allocated_kwh", part).withColumn("reward_points_actual", gained)
    kept = F.when((F.col("status") == "settled") & (F.col("reward_points_estimated") > 0), F.col("reward_points_actual") / F.col("reward_points_estimated"))
    keep = "commitment_id user_id device_id community_id suggestion_type period_start period_end status reward_points_estimated reward_points_actual window_duration_hours actual_kwh allocated_kwh"
    return c.select(*keep.split(), kept.alias("adherence_ratio"), "committed_at", "settled_at", "last_updated")


@model("rec_settlement_15m", "silver_flexibility_commitments", "rec_commitment_settlement", "rec_flexibility_windows", kind="merge", key=("_id",), reads={"rec_settlement_15m": Days("ts", 2), "silver_flexibility_commitments": Days("to_date(committed_at)", 2)}, tags=("flexibility",))
def rec_gamification_summary(ctx: Context, slots: DataFrame, commits: DataFrame, settled: DataFrame, windows: DataFrame) -> DataFrame:
    """Daily use in windows, what those who didn't commit get of the rest, and ranks."""
    at = ["window_start", "window_end"]
    used = slots.filter("window_start IS NOT NULL").groupBy("device_id", "ts_date", *at).agg(F.sum("consumption_kwh").alias("kwh"))
    committed = commits.filter(F.col("status").isin(*LIVE)).select("device_id", F.to_date("committed_at").alias("ts_date")).distinct()
    spent = settled.filter(F.col("status").isin(*LIVE)).groupBy(F.col("period_start").alias("window_start"), F.col("period_end").alias("window_end")).agg(F.sum("allocated_kwh").alias("spent"))
    rest = _budgets(windows).join(spent, at, "left").select(*at, F.greatest(F.lit(0.0), F.col("budget") - F.coalesce("spent", F.lit(0.0))).alias("rest"))
    p = allocation.with_totals(used.join(committed, ["device_id", "ts_date"], "left_anti"), at, F.sum("kwh").alias("total")).join(rest, at, "left")
    part = F.when(F.coalesce("rest", F.lit(0.0)) == 0, 0.0).when(F.col("total") <= F.col("rest"), F.col("kwh")).otherwise(F.round(F.col("kwh") / F.nullif("total", F.lit(0.0)) * F.col("rest"), 4))
    passive = p.withColumn("part", part).groupBy("device_id", "ts_date").agg(F.sum("kwh").alias("total_consumption_kwh"), F.sum("part").alias("total_allocated_kwh")).withColumn("committed", F.lit(False))
    active = used.join(committed, ["device_id", "ts_date"], "left_semi").groupBy("device_id", "ts_date").agg(F.sum("kwh").alias("total_consumption_kwh"), F.lit(0.0).alias("total_allocated_kwh")).withColumn("committed", F.lit(True))
    placed = allocation.with_places(active.unionByName(passive), ["ts_date"], "total_consumption_kwh")
    share = F.coalesce(F.col("below") / F.nullif(F.col("members") - 1, F.lit(0)), F.lit(0.0))
    return placed.select(
        keys.md5_key(F.col("device_id"), F.col("ts_date")).alias("_id"), "device_id", "ts_date", "total_consumption_kwh", "total_allocated_kwh", "committed", share.alias("percentile_rank"), F.col("rank").alias("rank_position"), F.col("members").alias("total_members"),
    )


@model("rec_settlement_points", "rec_flexibility_bonus", kind="merge", key=("_id",), reads={"rec_settlement_points": Days("ts", 2), "rec_flexibility_bonus": Days("window_start", 2)}, tags=("flexibility",))
def rec_participant_points(ctx: Context, points: DataFrame, bonus: DataFrame) -> DataFrame:
    s = points.groupBy("device_id", F.to_date("ts").alias("ts_date")).agg(F.round(F.sum("settlement_points")).cast("int").alias("daily_settlement_points"), F.sum("consumption_kwh").alias("daily_consumption_kwh"))
    b = bonus.groupBy("device_id", F.to_date("window_start").alias("ts_date")).agg(F.sum("bonus_points").cast("int").alias("daily_bonus_points"))
    j = s.join(b, ["device_id", "ts_date"], "left").fillna(0, ["daily_settlement_points", "daily_bonus_points"])
    total = (F.col("daily_settlement_points") + F.col("daily_bonus_points")).alias("daily_points")
    return j.select(keys.md5_key(F.col("device_id"), F.col("ts_date")).alias("_id"), "device_id", "ts_date", season(ctx, F.col("ts_date")).alias("season_start"), "daily_consumption_kwh", "daily_settlement_points", "daily_bonus_points", total)


def season(ctx: Context, day: Column) -> Column:
    return T.season_start(day, ctx.var("season_anchor_date", "2025-09-01"), int(ctx.var("season_months", 2)))


def season_places(full: DataFrame) -> DataFrame:
    """(device_id, season_start, season_points, ...) with the place in the season and its members."""
    z = allocation.with_places(full, ["season_start"], "season_points").drop("below")
    return z.withColumnsRenamed({"rank": "season_rank", "members": "total_members"})


@model("rec_participant_points", "rec_active_devices", kind="table", tags=("flexibility",))
def rec_points_leaderboard(ctx: Context, points: DataFrame, fleet: DataFrame) -> DataFrame:
    """Past seasons with those who have points in them; the current one with the whole fleet, zero-filled."""
    anchor = F.trunc(F.to_date(F.lit(ctx.var("season_anchor_date", "2025-09-01"))), "month")
    kinds = {"season_base_points": "daily_settlement_points", "season_bonus_points": "daily_bonus_points", "season_points": "daily_points"}
    per = points.filter(F.col("season_start") >= anchor).groupBy("device_id", "season_start").agg(*(F.sum(c).cast("long").alias(n) for n, c in kinds.items()))
    now = season(ctx, ctx.today())
    everyone = fleet.select("device_id", now.alias("season_start"))
    current = everyone.join(per, ["device_id", "season_start"], "left").fillna(0, list(kinds))
    full = season_places(per.filter(F.col("season_start") != now).unionByName(current))
    ever = per.groupBy("device_id").agg(F.sum("season_base_points").alias("alltime_base_points"), F.sum("season_bonus_points").alias("alltime_bonus_points"))
    z = full.join(ever, "device_id", "left").fillna(0, ["alltime_base_points", "alltime_bonus_points"])
    end = F.add_months("season_start", int(ctx.var("season_months", 2))).alias("season_end")
    return z.select(keys.md5_key(F.col("device_id"), F.col("season_start")).alias("_id"), "device_id", "season_start", end, *kinds, "season_rank", "total_members", "alltime_base_points", "alltime_bonus_points", (F.col("season_start") == now).alias("is_current_season"))


#: Days far above this many times the usual are flagged; what a cut must exceed (fixed values).
SPIKE, CUT = 10, 0.001


def daily_spikes(daily: DataFrame, ids: list[str], day: str, points: str) -> DataFrame:
    """Days whose points exceed ten times the median of the 30 days before (where that is over 0), with ``threshold_value``."""
    m = timeseries.trailing(daily, ids, day, points, 30, "median", "usual")
    return m.filter((F.col("usual") > 0) & (F.col(points) > F.col("usual") * SPIKE)).withColumn("threshold_value", F.col("usual") * SPIKE).drop("usual")


@model("rec_flexibility_bonus", kind="merge", key=("_id",), tags=("flexibility",))
def rec_anti_gaming_flags(ctx: Context, bonus: DataFrame) -> DataFrame:
    """Days far above the usual (warning) and windows whose bonus was cut (info). Later runs look for spikes among the last
    seven days alone, their medians too."""
    recent = bonus if ctx.target is None else Days("window_start", 7).apply(ctx, bonus)
    daily = recent.groupBy("device_id", F.to_date("window_start").alias("flag_date")).agg(F.sum("bonus_points").alias("daily_points"))
    cols = ["device_id", "flag_date", "flag_type", "metric_value", "threshold_value", "severity"]
    spike = daily_spikes(daily, ["device_id"], "flag_date", "daily_points").withColumns({"flag_type": F.lit("L4_DAILY_SPIKE"), "metric_value": F.col("daily_points").cast("double"), "severity": F.lit("warning")})
    cut = bonus.filter(F.col("bonus_points_raw") > F.col("bonus_points_capped") + CUT).withColumns({"flag_date": F.to_date("window_start"), "flag_type": F.lit("L3_WINDOW_CAP"), "metric_value": F.col("bonus_points_raw"), "threshold_value": F.col("bonus_points_capped"), "severity": F.lit("info")})
    key = [F.col("device_id"), F.col("flag_date"), F.col("flag_type")]
    return spike.select(keys.md5_key(*key).alias("_id"), *cols).unionByName(dedup.distinct_on(cut, ["device_id", "window_start"], F.col("window_end")).select(keys.md5_key(*key, keys.stamp("window_start")).alias("_id"), *cols))


def savings(daily: DataFrame, factors: DataFrame, country: str) -> DataFrame:
    """Adds carbon dioxide and trees to ``consumption_kwh``; they come from the energy before it is rounded."""
    j = joins.with_scalars(daily, factors.filter(F.col("country") == country).select("kg_co2_per_kwh", "trees_per_ton"))
    kg = F.col("consumption_kwh") * F.col("kg_co2_per_kwh")
    return j.withColumns({"co2_avoided_kg": F.round(kg, 3), "trees_equivalent": F.round(kg / 1000 * F.col("trees_per_ton"), 6), "consumption_kwh": F.round("consumption_kwh", 4)})


@model("rec_meters_15m", "co2_factors", kind="merge", key=("_id",), reads={"rec_meters_15m": Days("ts", 2)}, tags=("flexibility",))
def rec_co2_savings(ctx: Context, meters: DataFrame, factors: DataFrame) -> DataFrame:
    """What each device used of its own energy, day by day, windows or not."""
    d = meters.groupBy("device_id", F.to_date("ts").alias("ts_date")).agg(F.sum("self_consumed_kwh").alias("consumption_kwh"))
    return savings(d, factors, ctx.var("co2_country", "it")).select(keys.md5_key(F.col("device_id"), F.col("ts_date")).alias("_id"), "device_id", "ts_date", "consumption_kwh", "co2_avoided_kg", "trees_equivalent")


@model("rec_meters_15m", "rec_settlement_15m", "co2_factors", kind="merge", key=("ts_date",), reads={"rec_meters_15m": Days("ts", 2), "rec_settlement_15m": Days("ts", 2)}, tags=("flexibility",))
def rec_co2_savings_community(ctx: Context, meters: DataFrame, slots: DataFrame, factors: DataFrame) -> DataFrame:
    """Own energy used in windows, by all who took part."""
    within = slots.filter("window_start IS NOT NULL").select("device_id", "ts")
    d = meters.join(within, ["device_id", "ts"]).groupBy(F.to_date("ts").alias("ts_date")).agg(F.sum("self_consumed_kwh").alias("consumption_kwh"), F.countDistinct("device_id").alias("participating_devices"))
    return savings(d, factors, ctx.var("co2_country", "it")).select("ts_date", "consumption_kwh", "co2_avoided_kg", "trees_equivalent", "participating_devices")
