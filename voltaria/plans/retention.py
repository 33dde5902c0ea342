"""What is kept how long: rows older than their limit are left out of a table's next version."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..context import Context
from ..materialize import Table

#: Rule -> tables (layer, name), the column that dates a row, and how many days it is kept (fixed values).
RULES = {
    "cleanup_om_heat": ([("raw", "om_heat")], "_sdc_extracted_at", 2),
    "cleanup_om_obs": ([("raw", "om_obs")], "_sdc_extracted_at", 1),
    "cleanup_om_weather": ([("raw", "om_weather")], "_sdc_extracted_at", 30),
    "cleanup_om_wind": ([("raw", "om_wind")], "_sdc_extracted_at", 2),
    "cleanup_owm_forecasts": ([("silver", f"owm_weather_{k}") for k in ("alerts", "current", "daily", "hourly", "minutely")], "synced_at", 90),
    "cleanup_weather_forecasts": ([("gold", "weather_forecast_hourly"), ("gold", "weather_forecast_daily")], "forecast_at", 30),
    "cleanup_mt_observations": ([], "observed_at", 0),
}


def clean(ctx: Context, rule: str) -> int:
    """Applies a rule to its tables that exist; how many rows went."""
    tables, column, days = RULES[rule]
    n = 0
    for layer, name in tables:
        t = Table(ctx.spark, ctx.path(layer, name))
        if t.exists():
            at = column if column in t.read().columns else "forecast_date"
            n += t.delete(F.col(at) < ctx.now() - F.make_dt_interval(F.lit(days)))
    return n


def expired_forecasts(ctx: Context, layer: str, name: str, valid: str = "valid_datetime_utc") -> int:
    """Forecasts for times that have passed go; one rewrite takes the place of a loop of small deletes."""
    return Table(ctx.spark, ctx.path(layer, name)).delete(F.col(valid) < ctx.now())


def past_model_forecasts(ctx: Context, layer: str, name: str) -> int:
    """Reanalysis rows that were forecasts (data_type fc) for times that have passed go."""
    return Table(ctx.spark, ctx.path(layer, name)).delete((F.col("data_type") == "fc") & (F.col("datetime_utc") < ctx.now()))
