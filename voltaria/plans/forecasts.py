"""Gridded forecasts and reanalyses: staging, de-accumulation, wind, heat, solar, features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import Context
from ..functions import keys, tiers, time as T
from ..operators import dedup, features, reshape, timeseries
from ..registry import Since, model

CELL = ["lat", "lon"]


# --- numerical weather prediction -------------------------------------------------------------------------------------


def _typed(raw: DataFrame) -> DataFrame:
    at = {"run_time_utc": F.col("run_datetime").cast("timestamp"), "interval_start_utc": F.col("interval_start_datetime").cast("timestamp"), "interval_end_utc": F.col("interval_end_datetime").cast("timestamp"), "value": F.col("value").cast("double")}
    return raw.withColumns(at | {c: F.col(c).cast("double") for c in CELL})


def _newest(df: DataFrame) -> DataFrame:
    """Of a value that was loaded again the last."""
    return dedup.latest(df, [*STEP, "name"], "_sdc_last_modified")


def _not_past(ctx: Context, raw: DataFrame) -> DataFrame:
    """Intervals that end today or later, those of today that have ended included."""
    return raw.filter(F.col("interval_end_datetime").cast("timestamp") >= ctx.today())


STEP = ["run_time_utc", "interval_start_utc", "interval_end_utc", *CELL]
#: From the newest run written on: of a raw column and of a typed one.
_RAW_RUN, _RUN = Since("run_time_utc", "CAST(run_datetime AS TIMESTAMP)"), Since("run_time_utc")


@model("dwd_icon_d2_raw", layer="staging", tags=("dwd",))
def stg_dwd_icon_d2(ctx: Context, raw: DataFrame) -> DataFrame:
    s = _newest(_typed(_not_past(ctx, raw)))
    return s.select(*STEP[:3], "step_range", "step_units", *CELL, "name", "value", "level_type", "level", "ensemble", "centre", "data_type", "grid_type", "_sdc_filename", "_sdc_last_modified")


#: How a variable's values add up over the steps of a run (fixed values).
STEP_TYPES = {"avg_snswrf": "avg", "tp": "accum", "2t": "instant", "CLCT": "instant"}


@model("dwd_icon_d2_raw", layer="silver", kind="merge", key=("run_time_utc", "forecast_hour", "lat", "lon", "name"), schema_change="sync", reads={"dwd_icon_d2_raw": _RAW_RUN}, tags=("dwd",))
def dwd_icon_d2_silver(ctx: Context, raw: DataFrame) -> DataFrame:
    """Whole runs are read, so the value of the step before is there."""
    kind = F.element_at(F.create_map(*(F.lit(x) for kv in STEP_TYPES.items() for x in kv)), F.col("name"))
    hours = {"forecast_hour": T.hours_between("run_time_utc", "interval_end_utc"), "interval_hours": T.hours_between("interval_start_utc", "interval_end_utc"), "valid_datetime_rome": T.to_local("interval_end_utc", "Europe/Rome"), "step_type": kind}
    df = _newest(_typed(raw.filter(F.col("name").isin(*STEP_TYPES)))).withColumns(hours)
    w = Window.partitionBy("run_time_utc", *CELL, "name").orderBy("interval_end_utc")
    df = df.withColumns({"prev_value": F.lag("value").over(w), "prev_forecast_hour": F.lag("forecast_hour").over(w)})
    return df.select(*STEP, "name", "value", *hours, "prev_value", "prev_forecast_hour", "_sdc_last_modified")


@model("dwd_icon_d2_silver", kind="merge", key=("run_time_utc", "forecast_hour", "lat", "lon"), schema_change="sync", reads={"dwd_icon_d2_silver": _RUN}, tags=("dwd",))
def dwd_icon_d2_gold(ctx: Context, s: DataFrame) -> DataFrame:
    """Hourly values of four variables side by side, complete rows of the next 48 local hours."""
    v, h, zero = F.col("value"), F.col("forecast_hour"), F.lit(0.0)
    hourly = F.when(F.col("step_type") == "avg", v * h - F.coalesce(F.col("prev_value") * F.col("prev_forecast_hour"), zero))
    hourly = hourly.when(F.col("step_type") == "accum", v - F.coalesce("prev_value", zero)).otherwise(v)
    unit = F.when(F.col("name") == "2t", hourly - 273.15).when(F.col("name").isin("avg_snswrf", "tp"), F.greatest(hourly, zero)).otherwise(hourly)
    wide = reshape.to_wide(s.filter("forecast_hour > 0").withColumn("v", unit), ["run_time_utc", "forecast_hour", "interval_end_utc", "valid_datetime_rome", *CELL], "name", "v", list(STEP_TYPES))
    out = {"2t": ("temperature_2m", 1), "avg_snswrf": ("shortwave_radiation", 1), "CLCT": ("cloud_cover", 0), "tp": ("precipitation", 2)}
    near = F.col("valid_datetime_rome") < T.to_local("run_time_utc", "Europe/Rome") + F.expr("INTERVAL 48 HOURS")
    return wide.dropna(subset=list(out)).filter(near).select("run_time_utc", "forecast_hour", F.col("interval_end_utc").alias("valid_datetime_utc"), "valid_datetime_rome", *CELL, *(F.round(F.col(f"`{k}`"), n).alias(a) for k, (a, n) in out.items()))


@model("stg_dwd_icon_d2", layer="silver", kind="merge", key=tuple(STEP), schema_change="sync", reads={"stg_dwd_icon_d2": _RUN}, tags=("dwd", "wind"))
def dwd_icon_d2_wind(ctx: Context, s: DataFrame) -> DataFrame:
    """The speed is null unless both components are there."""
    of = lambda n: F.max(F.when(F.col("name") == n, F.col("value")))
    w = s.filter(F.col("name").isin("10u", "10v", "max_i10fg")).groupBy(*STEP).agg(of("10u").alias("u10"), of("10v").alias("v10"), of("max_i10fg").alias("i10fg"), F.max("_sdc_last_modified").alias("_sdc_last_modified"))
    speed = F.sqrt(F.col("u10") * F.col("u10") + F.col("v10") * F.col("v10"))
    return w.select(*STEP, "u10", "v10", "i10fg", speed.alias("wind_speed"), "_sdc_last_modified")


@model("dwd_icon_d2_wind", kind="merge", key=("run_time_utc", "date", "lat", "lon"), schema_change="sync", reads={"dwd_icon_d2_wind": _RUN}, tags=("dwd", "wind"))
def dwd_icon_d2_gusts(ctx: Context, w: DataFrame) -> DataFrame:
    d = w.groupBy("run_time_utc", F.to_date("interval_end_utc").alias("date"), *CELL).agg(F.max("wind_speed").alias("wind_speed_max"), F.max("i10fg").alias("i10fg_max"), F.max("_sdc_last_modified").alias("_sdc_last_modified"))
    tier = tiers.wind_level(F.col("i10fg_max"), F.col("wind_speed_max"))
    return d.select("run_time_utc", "date", *CELL, point(), "wind_speed_max", "i10fg_max", (F.col("i10fg_max") - F.col("wind_speed_max")).alias("gust_excess"), tier.alias("gust_excess_tier"), "_sdc_last_modified")


@model("dwd_icon_d2_raw", layer="silver", kind="merge", key=tuple(STEP), schema_change="sync", reads={"dwd_icon_d2_raw": _RAW_RUN}, tags=("dwd", "solar"))
def dwd_icon_d2_solar_forecast_interval(ctx: Context, raw: DataFrame) -> DataFrame:
    s = _newest(_typed(_not_past(ctx, raw.filter("name = 'avg_snswrf'"))))
    return s.select(*STEP, "name", "value", T.hours_between("interval_start_utc", "interval_end_utc").alias("interval_hours"), "_sdc_last_modified")


@model("dwd_icon_d2_solar_forecast_interval", kind="merge", key=("run_time_utc", "interval_end_utc", "lat", "lon"), schema_change="sync", reads={"dwd_icon_d2_solar_forecast_interval": _RUN}, tags=("dwd", "solar"))
def dwd_icon_d2_solar_energy(ctx: Context, s: DataFrame) -> DataFrame:
    energy = F.col("value") * F.col("interval_hours") / 1000
    return s.select(F.lit("icon_d2").alias("provider"), "run_time_utc", "interval_end_utc", *CELL, point().alias("geog"), energy.alias("solar_energy_kwh_per_m2"))


# --- grid points of a forecast service ----------------------------------------------------------------------------------


def point(lat: str = "lat", lon: str = "lon"):
    return F.struct(F.col(lon).alias("lon"), F.col(lat).alias("lat")).alias("geoposition")


def _staged(name: str, columns: dict[str, str], more: tuple[str, ...], time: str = "datetime", zone: str | None = None):
    """A staging model: numbers under standard names with their unit, the time as an instant if a zone is given."""

    def build(ctx: Context, raw: DataFrame) -> DataFrame:
        at = F.col(time).cast("timestamp") if zone else F.col(time).cast("timestamp_ntz")
        return raw.select((T.to_instant(at, zone) if zone else at).alias("datetime"), *(F.col(c).cast("double").alias(n) for c, n in columns.items()), *more)

    build.__name__ = name
    return build


#: Standard names of the service's variables (fixed values).
WIND = {"wind_speed_10m": "wind_speed_ms", "wind_gusts_10m": "wind_gusts_ms", "wind_direction_10m": "wind_direction_deg"}
OBSERVED = {"temperature_2m": "temp_c", "apparent_temperature": "apparent_temp_c", **WIND, "precipitation": "precip_mm"}
WEATHER = ["shortwave_radiation", "direct_radiation", "diffuse_radiation", "global_tilted_irradiance", "cloud_cover", "temperature_2m", "precipitation"]
_CELL = {"lat": "lat", "lon": "lon"}

#: What was loaded since the target's newest load.
_EXTRACTED = Since("_sdc_extracted_at", strict=True)

model("om_wind_raw", name="stg_om_wind", layer="staging", tags=("om", "wind"))(_staged("stg_om_wind", _CELL | WIND, ("model", "_sdc_extracted_at")))
model("om_obs_raw", name="stg_om_obs", layer="staging", tags=("om", "obs"))(_staged("stg_om_obs", _CELL | OBSERVED, ("model", "_sdc_extracted_at"), zone="Europe/Rome"))
model("om_weather_raw", name="stg_om_weather", layer="staging", kind="merge", key=("datetime",), reads={"om_weather_raw": _EXTRACTED}, tags=("om",))(_staged("stg_om_weather", {c: c for c in WEATHER}, ("location_name", "_sdc_extracted_at"), "time"))


@model("om_heat_raw", layer="staging", tags=("om", "heat"))
def stg_om_heat(ctx: Context, raw: DataFrame) -> DataFrame:
    return raw.select(F.to_date("date").alias("date"), *(F.col(c).cast("double").alias(c) for c in ("lat", "lon")), F.col("elevation").cast("double").alias("elevation_m"), F.col("temperature_2m_max").cast("double").alias("temp_max_c"), F.col("model").alias("forecast_model"), "_sdc_extracted_at")


@model("stg_om_wind", layer="silver", kind="merge", key=("datetime", "lat", "lon"), reads={"stg_om_wind": _EXTRACTED}, tags=("om", "wind"))
def om_wind_hourly(ctx: Context, s: DataFrame) -> DataFrame:
    return dedup.latest(s, ["datetime", *CELL], "_sdc_extracted_at")


@model("stg_om_obs", layer="silver", kind="merge", key=("datetime", "lat", "lon"), reads={"stg_om_obs": _EXTRACTED}, tags=("om", "obs"))
def om_obs_15min(ctx: Context, s: DataFrame) -> DataFrame:
    return dedup.latest(s, ["datetime", *CELL], "_sdc_extracted_at").withColumn("geoposition", point())


@model("stg_om_heat", layer="silver", kind="merge", key=("date", "lat", "lon"), reads={"stg_om_heat": _EXTRACTED}, tags=("om", "heat"))
def om_heat_daily(ctx: Context, s: DataFrame) -> DataFrame:
    return dedup.latest(s, ["date", *CELL], "_sdc_extracted_at").withColumn("altitude_band", F.coalesce(tiers.altitude_band(F.col("elevation_m")), F.lit("high")))


@model("stg_om_weather", layer="silver", kind="merge", key=("datetime",), reads={"stg_om_weather": Since("datetime", back="7 DAYS", strict=True)}, tags=("om",))
def om_weather_hourly(ctx: Context, s: DataFrame) -> DataFrame:
    return s.select("datetime", *WEATHER)


@model("om_weather_hourly", tags=("om",))
def om_weather_hourly_view(ctx: Context, s: DataFrame) -> DataFrame:
    return s


@model("om_wind_hourly", kind="merge", key=("date", "lat", "lon"), reads={"om_wind_hourly": Since("date", "datetime", like=lambda day: day.cast("timestamp_ntz"))}, tags=("om", "wind"))
def om_wind_gusts(ctx: Context, w: DataFrame) -> DataFrame:
    most, mean = lambda c: F.max(f"wind_{c}_ms").alias(f"wind_{c}_max"), lambda c: F.avg(f"wind_{c}_ms").alias(f"wind_{c}_avg")
    d = w.groupBy(F.to_date("datetime").alias("date"), *CELL).agg(*map(most, ("speed", "gusts")), *map(mean, ("speed", "gusts")), F.max("_sdc_extracted_at").alias("_sdc_extracted_at"))
    gust, wind = F.col("wind_gusts_max"), F.col("wind_speed_max")
    return d.withColumns({"gust_excess": gust - wind, "gust_excess_tier": tiers.wind_level(gust, wind), "geoposition": point()})


def heat_streaks(d: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Adds threshold, stress and the length of the running heat wave to daily maxima of cells. ``before``: (lat, lon, date,
    consecutive_heat_days) of the days before the first; a wave that starts on the day after one of them goes on from its length."""
    t = tiers.heat_threshold(F.col("altitude_band"), F.col("date"))
    d = d.withColumn("p90_threshold", t).withColumn("is_heat_stress", F.coalesce(F.col("temp_max_c") > t, F.lit(False)))
    i = timeseries.islands(d, [*CELL, "is_heat_stress"], "date")
    so_far = F.col("streak")
    if before is not None:
        start = F.date_sub("date", F.col("streak").cast("int"))  # the day before the wave's first
        i = i.withColumn("__start", start).join(before.select(*CELL, F.col("date").alias("__start"), F.col("consecutive_heat_days").alias("__had")), [*CELL, "__start"], "left")
        so_far = so_far + F.coalesce("__had", F.lit(0))
    return i.withColumn("consecutive_heat_days", F.when(F.col("is_heat_stress"), so_far).otherwise(0)).drop("island", "streak", "streak_total", "__start", "__had")


@model("om_heat_daily", kind="merge", key=("date", "lat", "lon"), reads={"om_heat_daily": Since("date", back="5 DAYS")}, tags=("om", "heat"))
def om_heat_risk(ctx: Context, d: DataFrame) -> DataFrame:
    """A later run reads five days back; waves that began before go on from what the table holds."""
    tier = F.when(~F.col("is_heat_stress"), "GREEN").when(F.col("consecutive_heat_days") >= 3, "RED").otherwise("ORANGE")
    before = None
    if ctx.target is not None:
        newest = ctx.target.agg(F.date_sub(F.max("date"), 6).alias("__eve"))
        before = ctx.target.join(newest, F.col("date") == F.col("__eve"), "left_semi")
    return heat_streaks(d, before).withColumn("heat_risk_tier", tier).withColumn("geoposition", point())


#: Defaults by month of what is missing, January to December (fixed values).
MONTHLY = {
    "temperature_2m": [-2.0, -1.0, 3.0, 7.0, 11.0, 15.0, 17.0, 17.0, 13.0, 8.0, 3.0, -1.0], "shortwave_radiation": [150, 200, 300, 400, 500, 550, 550, 500, 400, 280, 180, 130],
    "cloud_cover": [55, 50, 50, 55, 55, 50, 40, 45, 45, 50, 60, 60], "precipitation": [0.0, 0.0, 0.0, 0.1, 0.1, 0.1, 0.1, 0.1, 0.1, 0.0, 0.0, 0.0],
}


def imputed(h: DataFrame, columns: list[str], keys: list[str]) -> DataFrame:
    """Hourly weather without gaps in the given columns."""
    return timeseries.impute_columns(h, keys, "datetime", {c: dict(enumerate(MONTHLY[c], 1)) if c in MONTHLY else None for c in columns})


def _series(ctx: Context, h: DataFrame) -> tuple[DataFrame, list[str]]:
    """The series that a table of hourly weather holds: one per location where the table names locations, else one."""
    return (h, ["location_id"]) if "location_id" in h.columns else (h.withColumn("series", F.lit(1)), ["series"])


#: Hours that are made anew, and hours of history that they are made from: windows and decay reach back some 820 rows, imputation a
#: few days; more than twice that, as hours may be missing.
RECOMPUTED, HISTORY = 48, 1800


def _recomputed(ctx: Context) -> Column:
    """The last 48 hours that were written, and all after them."""
    newest = ctx.target.agg(F.max("datetime").cast("string")).first()[0]
    return F.col("datetime") >= F.lit(newest).cast("timestamp_ntz") - F.expr(f"INTERVAL {RECOMPUTED} HOURS")


@model("om_weather_hourly", kind="range", replaced=_recomputed, reads={"om_weather_hourly": Since("datetime", back=f"{RECOMPUTED + HISTORY} HOURS")}, tags=("om", "features"))
def om_weather_features(ctx: Context, h: DataFrame) -> DataFrame:
    """The 29 forecasting features. The last 48 hours written are made anew from a bounded history: what lies before it weighs less
    than a double can tell. (A column without any value for all of that history is taken as without values.)"""
    h, keys_ = _series(ctx, h)
    columns = ["temperature_2m", "shortwave_radiation", "cloud_cover", "precipitation"]
    h = imputed(h, columns, keys_) if ctx.var("impute", True) else h
    return features.gold_features(h, keys_, "datetime", T.italian_holidays(ctx.spark)).drop("series")


@model("om_weather_hourly", kind="merge", key=("datetime",), tags=("om", "features"))
def om_weather_features_meters(ctx: Context, h: DataFrame) -> DataFrame:
    """The 19 features of solar production."""
    h, keys_ = _series(ctx, h)
    columns = [c for c in WEATHER if c != "precipitation"]
    h = imputed(h, columns, keys_) if ctx.var("impute", True) else h
    return features.meter_features(h, keys_, "datetime", float(ctx.var("lat", features.LATITUDE))).drop("series")


def regular_grid(ctx: Context, lat: tuple[float, float], lon: tuple[float, float], spacing: float) -> DataFrame:
    """All points of a regular grid, both ends included."""
    steps = lambda a, b: F.explode(F.sequence(F.lit(0), F.lit(int((b - a) / spacing + 1e-9))))
    g = ctx.spark.range(1).select(steps(*lat).alias("i")).select("i", steps(*lon).alias("j"))
    return g.select(F.round(lat[0] + F.col("i") * spacing, 6).alias("lat"), F.round(lon[0] + F.col("j") * spacing, 6).alias("lon"))


# --- reanalyses -------------------------------------------------------------------------------------------------------------


_REANALYSIS = ["datetime_utc", "latitude", "longitude", "level_type", "level", "variable_name", "value", "forecast_step", "data_type"]
_DIMENSIONS = [c for c in _REANALYSIS if c != "value"]


def _renamed(raw: DataFrame, empty_is_null: bool) -> DataFrame:
    t = (lambda c: F.nullif(F.col(c), F.lit(""))) if empty_is_null else F.col
    return raw.select(
        F.col("datetime").cast("timestamp").alias("datetime_utc"), F.col("lat").cast("double").alias("latitude"), F.col("lon").cast("double").alias("longitude"), t("level_type").alias("level_type"), F.col("level").cast("int").alias("level"),
        t("name").alias("variable_name"), F.col("value").cast("double").alias("value"), F.col("forecast_step").cast("int").alias("forecast_step"), t("data_type").alias("data_type"),
    )


@model("era5_raw", layer="staging", tags=("copernicus",))
def stg_era5_single_levels(ctx: Context, raw: DataFrame) -> DataFrame:
    return _renamed(raw, True)


def _keyed(df: DataFrame, sep: str, null: str) -> DataFrame:
    """Adds record_id, the MD5 of the dimensions' text (numbers in their shortest form, times as "2026-01-01 00:00:00"); of rows
    that share it the one of the greatest value stays."""
    text = [keys.stamp(c) if c == "datetime_utc" else keys.number_text(df, c) for c in _DIMENSIONS]
    key = F.md5(F.concat_ws(sep, *(F.coalesce(x, F.lit(null)) for x in text)))
    return dedup.distinct_on(df.withColumn("record_id", key), ["record_id"], F.col("value").desc_nulls_last())


#: What a null dimension is called in the keys of the hourly reanalysis (fixed value).
NULL_DIMENSION = "_dbt_utils_surrogate_key_null_"


@model("stg_era5_single_levels", layer="silver", kind="merge", key=("record_id",), tags=("copernicus",))
def copernicus_era5_single_levels(ctx: Context, s: DataFrame) -> DataFrame:
    return _keyed(s, "-", NULL_DIMENSION).select("record_id", *_REANALYSIS, F.date_trunc("day", "datetime_utc").alias("date_day"), F.hour("datetime_utc").alias("hour_utc"))


def typed_or_empty(ctx: Context, name: str, schema: str) -> DataFrame:
    """A table that may be absent: its rows, or none with the schema."""
    return ctx.tables.get(name, ctx.spark.createDataFrame([], schema))


@model(layer="staging", tags=("copernicus",))
def stg_cams_global_reanalysis_eac4_monthly(ctx: Context) -> DataFrame:
    raw = "datetime timestamp, lat double, lon double, level_type string, level int, name string, value double, forecast_step int, data_type string"
    return _renamed(typed_or_empty(ctx, "cams_raw", raw), False)


@model("stg_cams_global_reanalysis_eac4_monthly", layer="silver", kind="merge", key=("record_id",), tags=("copernicus",))
def copernicus_cams_global_reanalysis_eac4_monthly(ctx: Context, s: DataFrame) -> DataFrame:
    return _keyed(s, "||", "").select("record_id", *_REANALYSIS, F.date_trunc("month", "datetime_utc").alias("date_month"), F.hour("datetime_utc").alias("hour_utc"))


@model("copernicus_era5_single_levels", kind="merge", key=("record_id",), reads={"copernicus_era5_single_levels": Since("datetime_utc", strict=True)}, tags=("copernicus",))
def copernicus_era5_analysis(ctx: Context, s: DataFrame) -> DataFrame:
    """Analyses alone, so without a step."""
    return s.filter("data_type = 'an'").select("record_id", "datetime_utc", "latitude", "longitude", "level_type", "level", "variable_name", "value", F.lit(None).cast("int").alias("forecast_step"), F.lit("an").alias("data_type"), "date_day", "hour_utc")


@model("radiation_raw", layer="staging", tags=("copernicus", "solar"))
def stg_radiation_raw(ctx: Context, raw: DataFrame) -> DataFrame:
    """Numbers from text; a column that older files lack becomes null."""
    number = lambda c: F.nullif(F.nullif(F.trim(c), F.lit("")), F.lit("nan")).cast("double")
    return raw.select(*((number(c) if c in raw.columns else F.lit(None).cast("double")).alias(c) for c in _RADIATION), "date_start")


_RADIATION = ["toa", "clear_sky_ghi", "clear_sky_bhi", "clear_sky_dhi", "clear_sky_bni", "ghi", "bhi", "dhi", "bni", "reliability"]


@model("stg_radiation_raw", layer="silver", kind="merge", key=("datetime_utc",), tags=("copernicus", "solar"))
def copernicus_solar_radiation(ctx: Context, s: DataFrame) -> DataFrame:
    at = F.col("date_start").cast("timestamp")
    index = F.when(F.col("ghi") > 0, F.try_divide("ghi", "clear_sky_ghi"))
    return dedup.distinct_on(s.filter("date_start IS NOT NULL"), ["date_start"], F.col("ghi").desc_nulls_last()).select(at.alias("datetime_utc"), *_RADIATION, F.date_trunc("day", at).alias("date_day"), F.hour(at).alias("hour_utc"), index.alias("ghi_clearness_index"))


@model("copernicus_solar_radiation", "copernicus_era5_single_levels", layer="silver", kind="merge", key=("datetime",), reads={"copernicus_solar_radiation": Since("datetime", "datetime_utc", strict=True)}, tags=("copernicus", "solar"))
def copernicus_weather_features(ctx: Context, solar: DataFrame, era5: DataFrame) -> DataFrame:
    """Solar rows with the newest temperature of the 12 hours before."""
    s = solar.select(F.lit(1).alias("one"), F.col("datetime_utc").alias("datetime"), F.col("ghi").alias("shortwave_radiation"), F.coalesce("ghi_clearness_index", F.lit(0.0)).alias("clearsky_index"), (F.coalesce("ghi", F.lit(0.0)) > 0).cast("int").alias("is_daylight"))
    t = era5.filter("variable_name = '2t'").groupBy(F.lit(1).alias("one"), F.col("datetime_utc").alias("datetime")).agg((F.avg("value") - 273.15).alias("temperature_2m"))
    j = timeseries.asof(s, t, ["one"], "datetime", ["temperature_2m"], 12 * 3600).drop("one", "right_ts")
    k = F.col("temperature_2m")
    j = j.select("datetime", "shortwave_radiation", "temperature_2m", "clearsky_index", "is_daylight")
    return j.withColumns({"heating_degree": F.when(k.isNotNull(), F.greatest(F.lit(0.0), 18 - k)), "cooling_degree": F.when(k.isNotNull(), F.greatest(F.lit(0.0), k - 24))})
