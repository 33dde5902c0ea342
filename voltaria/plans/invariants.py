"""Data tests over the models' tables: each gives the rows that break a rule, none if all is well."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import time as T
from ..operators import dedup, quality, timeseries
from ..registry import MODELS

#: Name -> (tables that it reads, rule).
TESTS: dict[str, tuple[tuple[str, ...], Callable[..., DataFrame]]] = {}

#: Physical bounds of measures; a missing value is no violation (fixed values).
BOUNDS = {
    "temperature_c": (-60.0, 60.0), "humidity_pct": (0.0, 100.0), "wind_speed_ms": (0.0, 120.0), "wind_gust_ms": (0.0, 150.0), "wind_direction_deg": (0.0, 360.0),
    "precipitation_mm": (0.0, 500.0), "cloud_cover_pct": (0.0, 100.0), "pressure_hpa": (500.0, 1100.0), "precipitation_probability_pct": (0.0, 100.0),
}


def test(*tables: str):
    def add(f: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
        TESTS[f.__name__] = tables, f
        return f

    return add


def _rows(name: str, table: str, broken: str) -> None:
    TESTS[name] = (table,), lambda df: df.filter(broken)


def out_of_bounds(df: DataFrame) -> DataFrame:
    """Rows with any measure out of its bounds."""
    broken = F.lit(False)
    for c, (low, high) in BOUNDS.items():
        if c in df.columns:
            broken = broken | F.coalesce(~F.col(c).between(low, high), F.lit(False))
    return df.filter(broken)


_rows("meters_data_15m_grid_flows_non_negative", "meters_data_15m", "consumption_kwh < 0 OR production_kwh < 0")
_rows("meters_data_15m_slots_are_quarter_aligned", "meters_data_15m", "minute(ts) % 15 <> 0 OR second(ts) <> 0")
_rows("rec_meters_15m_no_negative_self_consumed", "rec_meters_15m", "self_consumed_kwh < 0")
_rows("settlement_points_non_negative", "rec_settlement_points", "settlement_points < 0")
_rows("streak_multiplier_within_bounds", "rec_device_streaks", "multiplier NOT BETWEEN 1.0 AND 1.5")
_rows("windows_estimates_non_negative", "rec_flexibility_windows", "estimated_kwh < 0 OR reward_points_estimated < 0")
_rows("confidence_within_bounds", "rec_flexibility_windows_community", "confidence NOT BETWEEN 0.30 AND 0.95")
_rows("bonus_respects_per_window_cap", "rec_flexibility_bonus", "bonus_points_capped > bonus_points_raw")
_rows("mt_forecast_daily_temperature_bounds_are_ordered", "mt_forecasts_daily", "temperature_min_c > temperature_max_c")
_rows("weather_alerts_expire_after_they_start", "weather_alerts_active", "expires_at < starts_at")


@test("mt_forecasts_hourly", "mt_station_observations")
def mt_measures_within_physical_range(forecasts: DataFrame, observations: DataFrame) -> DataFrame:
    return out_of_bounds(forecasts).select(F.lit("forecast").alias("source"), F.col("forecast_at").alias("at")).unionByName(out_of_bounds(observations).select(F.lit("observation").alias("source"), F.col("observed_at").alias("at")))


@test("weather_current", "weather_forecast_hourly")
def weather_measures_within_physical_range(current: DataFrame, hourly: DataFrame) -> DataFrame:
    return out_of_bounds(current).select("location_id").unionByName(out_of_bounds(hourly).select("location_id"))


@test("mt_station_observations")
def mt_observations_one_row_per_station_and_instant(obs: DataFrame) -> DataFrame:
    return dedup.duplicate_keys(obs, ["station_code", "observed_at"])


@test("weather__forecast_hourly", "weather__forecast_daily", "weather__current")
def mt_weather_contract_is_unique_on_its_declared_key(hourly: DataFrame, daily: DataFrame, current: DataFrame) -> DataFrame:
    keyed = ((hourly, ["location_id", "forecast_at"]), (daily, ["location_id", "forecast_date"]), (current, ["station_id"]))
    return _all(*(dedup.duplicate_keys(df, k).select("n") for df, k in keyed))


def _all(first: DataFrame, *others: DataFrame) -> DataFrame:
    for o in others:
        first = first.unionByName(o)
    return first


@test("weather__forecast_hourly")
def mt_weather_contract_rows_the_facade_cannot_distinguish_must_agree(hourly: DataFrame) -> DataFrame:
    """Rows of one place, height and time with different values."""
    g = hourly.groupBy("lat", "lon", "elevation_m", "forecast_at").agg(F.countDistinct(F.struct("temperature_c", "precipitation_mm")).alias("values"))
    return g.filter("values > 1")


@test("weather_forecast_hourly", "weather_forecast_daily")
def weather_forecasts_one_row_per_location_and_time(hourly: DataFrame, daily: DataFrame) -> DataFrame:
    return _all(dedup.duplicate_keys(hourly, ["location_id", "forecast_at"]).select("n"), dedup.duplicate_keys(daily, ["location_id", "forecast_date"]).select("n"))


@test("rec_flexibility_bonus", "silver_flexibility_commitments")
def bonus_requires_active_commitment(bonus: DataFrame, commits: DataFrame) -> DataFrame:
    from .flexibility import bonus_of_live_commitments

    return bonus.join(bonus_of_live_commitments(bonus, commits).select("_id"), "_id", "left_anti")


@test("rec_commitment_settlement", "rec_flexibility_windows")
def commitment_allocation_within_budget(settled: DataFrame, windows: DataFrame) -> DataFrame:
    used = settled.filter("status IN ('committed', 'settled')").groupBy("period_start", "period_end").agg(F.sum("allocated_kwh").alias("used"))
    budget = windows.groupBy(F.col("window_start").alias("period_start"), F.col("window_end").alias("period_end")).agg(F.min("community_kwh").alias("budget"))
    return used.join(budget, ["period_start", "period_end"]).filter("used > budget + 0.001")


@test("rec_gamification_summary", "rec_flexibility_windows")
def passive_allocation_within_remaining_budget(summary: DataFrame, windows: DataFrame) -> DataFrame:
    given = summary.filter("NOT committed").groupBy("ts_date").agg(F.sum("total_allocated_kwh").alias("given"))
    budget = windows.select("ts_date", "window_start", "window_end", "community_kwh").distinct().groupBy("ts_date").agg(F.sum("community_kwh").alias("budget"))
    return given.join(budget, "ts_date").filter("given > budget + 0.001")


@test("meters_data_15m", "meters_data_1h")
def meters_data_1h_matches_15m_rollup(slots: DataFrame, hours: DataFrame) -> DataFrame:
    """Full hours (four slots) that differ from the sum of their slots."""
    full = slots.groupBy("device_id", T.floor_hour("ts").alias("ts")).agg(F.count("*").alias("n")).filter("n = 4").drop("n")
    up = timeseries.rollup(slots, ["device_id"], "ts", 60, {"consumption_kwh": F.col("consumption_kwh")}).join(full, ["device_id", "ts"], "left_semi")
    return quality.reconciled(hours.join(full, ["device_id", "ts"], "left_semi"), up, ["device_id", "ts"], "consumption_kwh", 1e-6)


def run_tests(tables: dict[str, DataFrame]) -> dict[str, int]:
    """How many rows break each rule whose tables are all there, and keys of models that aren't unique."""
    out = {n: rule(*(tables[x] for x in needs)).count() for n, (needs, rule) in TESTS.items() if all(x in tables for x in needs)}
    for m in MODELS.models.values():
        if m.key and m.name in tables and set(m.key) <= set(tables[m.name].columns):
            out[f"unique:{m.name}"] = dedup.duplicate_keys(tables[m.name], m.key).count()
    return out
