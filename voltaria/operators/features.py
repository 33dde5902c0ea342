"""Forecasting features of hourly weather series."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import time as T
from ..shared import checkpointed
from . import scans
from .timeseries import rolling


def calendar(df: DataFrame, ts: str, holidays: DataFrame | None = None) -> DataFrame:
    """hour, day_of_week (Monday 0), is_weekend, is_daylight and, with a calendar, is_holiday."""
    t = F.col(ts)
    out = df.withColumns({"hour": F.hour(t), "day_of_week": F.weekday(t), "is_weekend": (F.weekday(t) >= 5).cast("int"), "is_daylight": F.hour(t).between(6, 20).cast("int")})
    if holidays is None:
        return out
    marked = F.broadcast(holidays.select(F.col("date").alias("__day"), F.lit(1).alias("__h")))  # some hundred rows
    return out.join(marked, F.to_date(t) == F.col("__day"), "left").withColumn("is_holiday", F.coalesce("__h", F.lit(0))).drop("__day", "__h")


def fourier(df: DataFrame, ts: str, origin: str = "2020-01-01") -> DataFrame:
    """Sine and cosine of the hour, the day of the week, the year and the half year."""
    since = T.hours_between(F.lit(origin).cast("timestamp_ntz"), F.col(ts))
    parts = {"hour": (F.hour(ts), 24.0), "dow": (F.weekday(F.col(ts)), 7.0), "annual": (since, 8766.0), "semi_annual": (since, 4383.0)}
    angle = lambda c, period: c * (2 * math.pi / period)
    return df.withColumns({f"{n}_{f}": fn(angle(*v)) for n, v in parts.items() for f, fn in (("sin", F.sin), ("cos", F.cos))})


def above(value: Column | float, other: Column | float, known: Column) -> Column:
    """max(0, value - other); null where what it is computed from is null."""
    return F.when(known.isNotNull(), F.greatest(F.lit(0.0), value - other))


#: Rows that the windows of a set of features look back: two days, or as far as the decaying mean reaches.
HALF_LIFE, LONGEST = 12, 48


def _weather(df: DataFrame, keys: Sequence[str], temperature: str) -> DataFrame:
    """Heating degrees and a day's rolling means, within buckets."""
    w, t = rolling([*keys, "__bucket"], "__n", 24), F.col(temperature)
    df = df.withColumn("heating_degree_hour", above(F.lit(18.0), t, t))
    rolls = {"temp_rolling_mean_24h": F.avg(t).over(w), "temp_rolling_std_24h": F.stddev_samp(t).over(w), "heating_degree_rolling_mean_24h": F.avg("heating_degree_hour").over(w)}
    more = {"radiation_rolling_mean_24h": "shortwave_radiation", "cloud_cover_rolling_mean_24h": "cloud_cover"}
    return df.withColumns(rolls | {n: F.avg(c).over(w) for n, c in more.items() if c in df.columns})


def _thermal(df: DataFrame, keys: Sequence[str], temperature: str, back: int) -> DataFrame:
    """Rates of change, decaying mean and the sum of two days' heating degrees, within buckets."""
    own = [*keys, "__bucket"]
    w, t = Window.partitionBy(*own).orderBy("__n"), F.col(temperature)
    heat = F.sum(above(F.lit(18.0), t, t)).over(rolling(own, "__n", LONGEST))
    return df.withColumns({"temp_change_rate_3h": (t - F.lag(t, 3).over(w)) / 3, "temp_gradient_24h": t - F.lag(t, 24).over(w), "cumulative_hdd_48h": heat, "thermal_inertia_12h": scans.decaying(keys, temperature, HALF_LIFE, back)})


def weather(df: DataFrame, keys: Sequence[str], ts: str, temperature: str = "temperature_2m") -> DataFrame:
    """Heating degrees and a day's rolling means; of radiation and clouds where the table has them."""
    return scans.own_rows(_weather(scans.bucketed(df, keys, ts, 24), keys, temperature))


def thermal(df: DataFrame, keys: Sequence[str], ts: str, temperature: str = "temperature_2m") -> DataFrame:
    """Rates of change, decaying mean and the sum of two days' heating degrees."""
    back = scans.reach(HALF_LIFE)
    return scans.own_rows(_thermal(scans.bucketed(df, keys, ts, back), keys, temperature, back))


def interactions(df: DataFrame) -> DataFrame:
    """Products of weather with the time of day and the weekend."""
    night = ((F.col("hour") >= 20) | (F.col("hour") <= 6)).cast("int")
    return df.withColumns(
        {
            "temp_x_hour_sin": F.col("temperature_2m") * F.col("hour_sin"), "radiation_x_daytime": F.col("shortwave_radiation") * F.col("is_daylight"),
            "weekend_x_hour_cos": F.col("is_weekend") * F.col("hour_cos"), "heating_x_night": F.col("heating_degree_hour") * night,
        }
    )


#: Degrees north of the place that solar features are made for (fixed value).
LATITUDE = 45.9167


def _sine_of_elevation(ts: Column, lat: float) -> Column:
    """Sine of the sun's height over the horizon at a full hour."""
    tilt = F.radians(23.45 * F.sin(F.radians(360 / 365 * (F.dayofyear(ts) - 81))))
    turn, phi = F.radians(15.0 * (F.hour(ts) - 12)), F.radians(F.lit(lat))
    return F.sin(phi) * F.sin(tilt) + F.cos(phi) * F.cos(tilt) * F.cos(turn)


def clear_sky_index(radiation: Column, ts: Column, lat: float = LATITUDE, least: float = 50.0, most: float = 1.5) -> Column:
    """Measured over clear-sky radiation, 0 at night and at most ``most``; null by day without a measure."""
    clear = F.greatest(_sine_of_elevation(ts, lat), F.lit(0.0)) * 1000
    held = F.when(radiation.isNotNull(), F.least(F.greatest(radiation / clear, F.lit(0.0)), F.lit(most)))
    return F.when(clear > least, held).otherwise(0.0)


def solar_elevation(ts: Column, lat: float = LATITUDE) -> Column:
    """Degrees over the horizon at a full hour."""
    return F.degrees(F.asin(F.least(F.greatest(_sine_of_elevation(ts, lat), F.lit(-1.0)), F.lit(1.0))))


#: Columns with more nulls than this in a series stay as they are, so a null that is filled has a value this near, if any.
MOST_NULLS = 48


def _near(keys: Sequence[str], c: str) -> Column:
    """Within buckets that reach ``MOST_NULLS`` rows to both sides: the next value (the last one in turned order, as a frame up
    to the last row is computed anew for every row), then the one before."""
    w = Window.partitionBy(*keys, "__bucket")
    return F.coalesce(*(F.last(c, ignorenulls=True).over(w.orderBy(o).rowsBetween(Window.unboundedPreceding, 0)) for o in (F.desc("__n"), F.asc("__n"))))


def _with_near(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The buckets' own rows, and for each column what would fill a null of it."""
    return df.withColumns({f"__near_{c}": _near(keys, c) for c in columns}).filter("__own").drop("__own", "__bucket", "__n")


def _filled(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Fills the columns that have nulls, but not more than ``MOST_NULLS`` in the series; 0 where a column has no value. The rows
    are checkpointed, so that counting doesn't make them again."""
    df = checkpointed(df)
    counts = df.groupBy(*keys).agg(*(F.count_if(F.col(c).isNull()).alias(f"__n_{c}") for c in columns))
    j = df.alias("d").join(counts.alias("s"), scans._same(keys)).select("d.*", *(f"s.__n_{c}" for c in columns))
    fill = lambda c: F.when(F.col(c).isNull() & (F.col(f"__n_{c}") <= MOST_NULLS), F.coalesce(f"__near_{c}", F.lit(0.0))).otherwise(F.col(c))
    return j.withColumns({c: fill(c) for c in columns}).drop(*(f"__{p}_{c}" for c in columns for p in ("n", "near")))


def fill_edges(df: DataFrame, keys: Sequence[str], ts: str, columns: Sequence[str]) -> DataFrame:
    """What windows leave null at a series' edges: the next value, then the one before, 0 for a column without any. Columns
    with more than ``MOST_NULLS`` nulls in a series stay as they are."""
    return _filled(_with_near(scans.bucketed(df, keys, ts, MOST_NULLS, MOST_NULLS), keys, columns), keys, columns)


#: The feature sets, in order (fixed values).
WEATHER_FEATURES = [
    "hour_sin", "hour_cos", "dow_sin", "dow_cos", "annual_sin", "annual_cos", "semi_annual_sin", "semi_annual_cos", "is_weekend", "is_holiday", "is_daylight", "temperature_2m", "heating_degree_hour",
    "temp_rolling_mean_24h", "temp_rolling_std_24h", "temp_change_rate_3h", "thermal_inertia_12h", "temp_gradient_24h", "heating_degree_rolling_mean_24h", "cumulative_hdd_48h", "temp_x_hour_sin",
    "heating_x_night", "shortwave_radiation", "radiation_rolling_mean_24h", "radiation_x_daytime", "cloud_cover", "cloud_cover_rolling_mean_24h", "precipitation", "weekend_x_hour_cos",
]
METER_FEATURES = [
    "hour_sin", "hour_cos", "day_of_week", "month", "is_weekend", "global_tilted_irradiance", "shortwave_radiation", "cloud_cover", "temperature_2m", "clearsky_index", "effective_solar_pv",
    "solar_elevation", "cloud_cover_diff", "pv_temp_factor", "ghi_ramp", "heating_degree", "cooling_degree", "is_daylight", "theoretical_prod",
]
_CALENDAR = {"hour_sin", "hour_cos", "dow_sin", "dow_cos", "annual_sin", "annual_cos", "semi_annual_sin", "semi_annual_cos", "is_weekend", "is_holiday", "is_daylight", "weekend_x_hour_cos", "day_of_week", "month", "solar_elevation"}


def gold_features(df: DataFrame, keys: Sequence[str], ts: str, holidays: DataFrame | None = None) -> DataFrame:
    """The keys, the time and the 29 features of hourly temperature, radiation, clouds and precipitation.

    One deal of the rows to buckets serves all windows: they reach back as far as the decaying mean, and further by what
    filling the edges looks at. Impute first: where no temperature was known for some 770 rows, the decaying mean is null."""
    back = scans.reach(HALF_LIFE) + MOST_NULLS
    b = scans.bucketed(df, keys, ts, back, MOST_NULLS)
    f = interactions(_thermal(_weather(fourier(calendar(b, ts, holidays), ts), keys, "temperature_2m"), keys, "temperature_2m", back))
    out = [c for c in WEATHER_FEATURES if c in f.columns]
    edges = [c for c in out if c not in _CALENDAR]
    return _filled(_with_near(f.select(*keys, ts, "__n", "__bucket", "__own", *out), keys, edges), keys, edges)


def meter_features(df: DataFrame, keys: Sequence[str], ts: str, lat: float = LATITUDE) -> DataFrame:
    """The keys, the time and the 19 features of solar production."""
    t, w = F.col("temperature_2m"), Window.partitionBy(*keys, "__bucket").orderBy("__n")
    tilted, step = F.col("global_tilted_irradiance"), lambda c: F.col(c) - F.lag(c).over(w)
    sun = F.coalesce("direct_radiation", F.lit(0.0)) + 0.9 * F.coalesce("diffuse_radiation", F.lit(0.0))
    df = fourier(calendar(scans.bucketed(df, keys, ts, 1 + MOST_NULLS, MOST_NULLS), ts), ts).withColumns(
        {
            "month": F.month(ts), "clearsky_index": clear_sky_index(F.col("shortwave_radiation"), F.col(ts), lat), "effective_solar_pv": sun, "solar_elevation": solar_elevation(F.col(ts), lat),
            "cloud_cover_diff": F.abs(step("cloud_cover")), "pv_temp_factor": 1 - 0.004 * above(t, 25.0, t), "ghi_ramp": F.coalesce(step("global_tilted_irradiance"), F.lit(0.0)),
            "heating_degree": above(F.lit(18.0), t, t), "cooling_degree": above(t, 24.0, t), "theoretical_prod": F.coalesce(tilted, F.lit(0.0)) * sun,
        }
    )
    edges = [c for c in METER_FEATURES if c not in _CALENDAR]
    return _filled(_with_near(df.select(*keys, ts, "__n", "__bucket", "__own", *METER_FEATURES), keys, edges), keys, edges)
