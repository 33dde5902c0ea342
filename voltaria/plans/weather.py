"""Weather by place: stations, nested forecasts, alerts, the provider-neutral facade and observations in long form."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import Context
from ..functions import keys, tiers, time as T
from ..operators import dedup, joins
from ..registry import Since, model
from ..sources import payloads

ZONE = "Europe/Rome"


# --- stations and local forecasts -----------------------------------------------------------------------------------


def _recent(name: str, days: int | None, column: str = "_sdc_extracted_at"):
    def build(ctx: Context, raw: DataFrame) -> DataFrame:
        return raw if days is None else raw.filter(F.col(column) >= ctx.now() - F.make_dt_interval(F.lit(days)))

    build.__name__ = name
    return build


for _name, _days in {"alerts": None, "forecast_locations": None, "forecasts_daily": 7, "forecasts_hourly": 3, "meteo_stations": None, "sky_conditions": None, "station_observations": 30}.items():
    model(f"mt_{_name}_raw", name=f"stg_mt_{_name}", layer="staging", tags=("mt",))(_recent(f"stg_mt_{_name}", _days))


def _as(df: DataFrame, spec: str) -> DataFrame:
    """Columns by a list of "source", "source:type" or "source:type:name"; the type ``local`` is a naive local time that becomes
    an instant."""

    def one(item: str) -> Column:
        source, kind, name = (item.split(":") + ["", ""])[:3]
        c = F.col(source)
        if kind == "local":
            c = T.to_instant(c.cast("timestamp"), ZONE)
        elif kind:
            c = c.cast(kind)
        return c.alias(name or source)

    return df.select(*map(one, spec.split()))


def _local(column: str) -> str:
    """The instant of a naive local time, as an SQL expression."""
    return f"to_utc_timestamp(CAST({column} AS TIMESTAMP), '{ZONE}')"


@model("stg_mt_alerts", layer="silver", kind="table", tags=("mt",))
def mt_alerts(ctx: Context, raw: DataFrame) -> DataFrame:
    return _as(raw, "identifier sender sent:local expires:local source status language headline category event urgency severity certainty description web contact area_desc area_polygon resource_uri msg_type scope")


@model("stg_mt_forecast_locations", layer="silver", kind="table", tags=("mt",))
def mt_forecast_locations(ctx: Context, raw: DataFrame) -> DataFrame:
    return _as(raw, "id::location_id name_it name_de name_en name_lld elevation:int:elevation_m latitude:double longitude:double venue_type:int forecast_url")


#: What daily and hourly forecasts share, after the temperature (source:type:name).
_FORECAST = "rain_fall:double:rain_fall_mm fresh_snow:double:fresh_snow_cm snow_level:int:snow_level_m wind_speed:double:wind_speed_ms wind_gust:double:wind_gust_ms wind_direction:int:wind_direction_deg sky_condition freezing_level:int:freezing_level_m rain_probability:int:rain_probability_pct sunshine_duration:double:sunshine_duration_min"


def _forecasts(raw: DataFrame, temperatures: str) -> DataFrame:
    """Of several answers for one time the newest."""
    newest = dedup.latest(raw, ["location_id", "forecast_timestamp"], "_sdc_extracted_at")
    return _as(newest, f"location_id forecast_timestamp:local:forecast_at interval_minutes:int {temperatures} {_FORECAST}")


@model("stg_mt_forecasts_daily", layer="silver", kind="merge", key=("location_id", "forecast_at"), reads={"stg_mt_forecasts_daily": Since("forecast_at", _local("forecast_timestamp"), "7 DAYS", strict=True)}, tags=("mt",))
def mt_forecasts_daily(ctx: Context, raw: DataFrame) -> DataFrame:
    return _forecasts(raw, "temperature:double:temperature_c temperature_maximum:double:temperature_max_c temperature_minimum:double:temperature_min_c")


@model("stg_mt_forecasts_hourly", layer="silver", kind="merge", key=("location_id", "forecast_at"), reads={"stg_mt_forecasts_hourly": Since("forecast_at", _local("forecast_timestamp"), "3 DAYS", strict=True)}, tags=("mt",))
def mt_forecasts_hourly(ctx: Context, raw: DataFrame) -> DataFrame:
    return _forecasts(raw, "temperature:double:temperature_c")


@model("stg_mt_meteo_stations", layer="silver", kind="table", tags=("mt",))
def mt_meteo_stations(ctx: Context, raw: DataFrame) -> DataFrame:
    return _as(raw, "code name shortname elevation:int:elevation_m latitude:double longitude:double east:double north:double startdate:date:active_since enddate:date:active_until")


@model("stg_mt_sky_conditions", layer="silver", kind="table", tags=("mt",))
def mt_sky_conditions(ctx: Context, raw: DataFrame) -> DataFrame:
    return _as(raw, "id icon_day icon_night name_deu name_eng name_ita name_lld")


@model("stg_mt_station_observations", layer="silver", kind="merge", key=("station_code", "observed_at"), reads={"stg_mt_station_observations": Since("observed_at", _local("timestamp"), "7 DAYS", strict=True)}, tags=("mt",))
def mt_station_observations(ctx: Context, raw: DataFrame) -> DataFrame:
    newest = dedup.latest(raw, ["station_code", "timestamp"], "_sdc_extracted_at")
    return _as(newest, "station_code timestamp:local:observed_at air_temperature_c:double precipitation_mm:double wind_speed_ms:double wind_direction_deg:double wind_gust_ms:double global_radiation_wm2:double relative_humidity_pct:double snow_depth_cm:double")


def _unexpired(ctx: Context, alerts: DataFrame) -> DataFrame:
    return alerts.filter(F.col("expires").isNull() | (F.col("expires") > ctx.now()))


@model("mt_alerts", kind="table", tags=("mt",))
def mt_alerts_active(ctx: Context, alerts: DataFrame) -> DataFrame:
    newest = dedup.latest(_unexpired(ctx, alerts), ["identifier"], "sent")
    return newest.select("identifier", "sent", "expires", "event", "severity", "urgency", "certainty", "headline", "description", "area_desc", "web", "source")


def _ahead(ctx: Context, f: DataFrame, places: DataFrame) -> DataFrame:
    """Forecasts that still matter, with their place (aliases f and l)."""
    return f.filter(F.col("forecast_at") >= ctx.now() - F.expr("INTERVAL 1 HOUR")).alias("f").join(places.alias("l"), F.col("f.location_id") == F.col("l.location_id"))


_PLACED = ["f.location_id", "l.name_it location_name_it", "l.name_en location_name_en", "l.elevation_m location_elevation_m", "l.latitude", "l.longitude", "f.forecast_at"]
_WEATHER = ["f.rain_fall_mm", "f.fresh_snow_cm", "f.snow_level_m", "f.wind_speed_ms", "f.wind_gust_ms", "f.wind_direction_deg", "f.sky_condition", "f.freezing_level_m", "f.rain_probability_pct", "f.sunshine_duration_min"]


@model("mt_forecasts_daily", "mt_forecast_locations", kind="table", tags=("mt",))
def mt_forecast_daily(ctx: Context, f: DataFrame, places: DataFrame) -> DataFrame:
    return _ahead(ctx, f, places).selectExpr(*_PLACED, "f.temperature_c", "f.temperature_max_c", "f.temperature_min_c", *_WEATHER)


@model("mt_forecasts_hourly", "mt_forecast_locations", kind="table", tags=("mt",))
def mt_forecast_hourly(ctx: Context, f: DataFrame, places: DataFrame) -> DataFrame:
    return _ahead(ctx, f, places).selectExpr(*_PLACED, "f.interval_minutes", "f.temperature_c", *_WEATHER)


def _active(ctx: Context, stations: DataFrame) -> DataFrame:
    """Stations without an end or with one that isn't past."""
    return stations.filter(F.col("active_until").isNull() | (F.col("active_until") >= ctx.today()))


@model("mt_meteo_stations", kind="table", tags=("mt",))
def mt_stations(ctx: Context, stations: DataFrame) -> DataFrame:
    return _active(ctx, stations).select("code", "name", "shortname", "elevation_m", "latitude", "longitude", "active_since")


def _current(ctx: Context, obs: DataFrame, stations: DataFrame, window: str) -> DataFrame:
    """The newest observation of each active station within the window (aliases o and s)."""
    recent = obs.filter(F.col("observed_at") >= ctx.now() - F.expr(f"INTERVAL {window}"))
    return dedup.latest(recent, ["station_code"], "observed_at").alias("o").join(_active(ctx, stations).alias("s"), F.expr("s.code = o.station_code"))


@model("mt_station_observations", "mt_meteo_stations", kind="table", tags=("mt",))
def mt_observations_current(ctx: Context, obs: DataFrame, stations: DataFrame) -> DataFrame:
    measured = ["air_temperature_c", "precipitation_mm", "wind_speed_ms", "wind_direction_deg", "wind_gust_ms", "global_radiation_wm2", "relative_humidity_pct", "snow_depth_cm"]
    return _current(ctx, obs, stations, "1 HOUR").selectExpr("o.station_code", "s.name station_name", "s.shortname station_shortname", "s.elevation_m", "s.latitude", "s.longitude", "o.observed_at", *(f"o.{c}" for c in measured))


@model("mt_station_observations", "mt_meteo_stations", kind="table", alias="weather__current", tags=("mt", "contract"))
def mt_weather_current(ctx: Context, obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Half degrees of wind direction go to the even integer, as in the source engine."""
    return _current(ctx, obs, stations, "6 HOURS").selectExpr(
        "'mt' provider", "o.station_code station_id", "s.name station_name", "s.latitude lat", "s.longitude lon", "s.elevation_m", "o.observed_at", "o.air_temperature_c temperature_c", "o.relative_humidity_pct humidity_pct", "o.wind_speed_ms",
        "CAST(bround(o.wind_direction_deg) AS INT) wind_direction_deg", "o.wind_gust_ms", "o.precipitation_mm", "CAST(NULL AS DOUBLE) cloud_cover_pct", "CAST(NULL AS STRING) sky_condition", "CAST(NULL AS DOUBLE) pressure_hpa",
    )


@model("mt_alerts", kind="table", alias="weather__alerts", tags=("mt", "contract"))
def mt_weather_alerts(ctx: Context, a: DataFrame) -> DataFrame:
    return _unexpired(ctx, a).selectExpr("'mt' provider", "CAST(NULL AS STRING) location_id", "identifier alert_id", "event", "severity", "urgency", "headline", "description", "sent starts_at", "expires expires_at", "source source_name", "area_desc")


def _with_sky(ctx: Context, f: DataFrame, places: DataFrame, sky: DataFrame) -> DataFrame:
    """Forecasts ahead, with place and the sky's English name or else its code (``sky``)."""
    named = sky.select(F.lower("id").alias("sky_id"), "name_eng")
    return _ahead(ctx, f, places).join(named, F.lower("f.sky_condition") == F.col("sky_id"), "left").withColumn("sky", F.coalesce("name_eng", "f.sky_condition"))


_CONTRACT = ["'mt' provider", "CAST(f.location_id AS STRING) location_id", "l.name_en location_name", "l.latitude lat", "l.longitude lon", "l.elevation_m"]


@model("mt_forecasts_daily", "mt_forecast_locations", "mt_sky_conditions", kind="merge", key=("location_id", "forecast_date"), alias="weather__forecast_daily", tags=("mt", "contract"))
def mt_weather_forecast_daily(ctx: Context, f: DataFrame, places: DataFrame, sky: DataFrame) -> DataFrame:
    """``forecast_date`` is the day of the instant in the session's zone."""
    return _with_sky(ctx, f, places, sky).selectExpr(
        *_CONTRACT, "CAST(f.forecast_at AS DATE) forecast_date", "f.temperature_c", "f.temperature_min_c", "f.temperature_max_c", "f.rain_fall_mm precipitation_mm", "f.rain_probability_pct precipitation_probability_pct", "f.wind_speed_ms", "f.wind_gust_ms",
        "f.wind_direction_deg", "CAST(NULL AS DOUBLE) cloud_cover_pct", "sky sky_condition", "f.fresh_snow_cm snow_cm", "CAST(NULL AS TIMESTAMP) sunrise", "CAST(NULL AS TIMESTAMP) sunset",
    )


@model("mt_forecasts_hourly", "mt_forecast_locations", "mt_sky_conditions", kind="merge", key=("location_id", "forecast_at"), alias="weather__forecast_hourly", tags=("mt", "contract"))
def mt_weather_forecast_hourly(ctx: Context, f: DataFrame, places: DataFrame, sky: DataFrame) -> DataFrame:
    return _with_sky(ctx, f, places, sky).selectExpr(
        *_CONTRACT, "f.forecast_at", "f.temperature_c", "CAST(NULL AS DOUBLE) humidity_pct", "f.wind_speed_ms", "f.wind_gust_ms", "f.wind_direction_deg", "f.rain_fall_mm precipitation_mm", "f.rain_probability_pct precipitation_probability_pct",
        "CAST(NULL AS DOUBLE) cloud_cover_pct", "sky sky_condition", "CAST(NULL AS DOUBLE) pressure_hpa", "f.fresh_snow_cm snow_cm",
    )


@model("mt_station_observations", "mt_meteo_stations", kind="merge", key=("date", "lat", "lon"), alias="heat_daily_obs", reads={"mt_station_observations": Since("date", "observed_at", "3 DAYS", like=lambda day: T.to_instant(day.cast("timestamp"), ZONE))}, tags=("mt", "heat"))
def mt_heat_daily_obs(ctx: Context, obs: DataFrame, stations: DataFrame) -> DataFrame:
    """Highest temperature of each station's local day, with its altitude band; a station without a height counts as high."""
    d = obs.filter("air_temperature_c IS NOT NULL").groupBy("station_code", F.to_date(T.to_local("observed_at", ZONE)).alias("date")).agg(F.max("air_temperature_c").alias("temp_max_c"), F.max("observed_at").alias("latest_obs"))
    band = F.coalesce(tiers.altitude_band(F.col("elevation_m")), F.lit("high"))
    return d.join(_active(ctx, stations), F.col("station_code") == F.col("code")).select("date", F.col("latitude").alias("lat"), F.col("longitude").alias("lon"), "elevation_m", band.alias("altitude_band"), "temp_max_c", "latest_obs")


# --- nested forecasts -----------------------------------------------------------------------------------------------


_LOADED = ["_sdc_extracted_at", "_sdc_received_at", "_sdc_batched_at", "_sdc_deleted_at", "_sdc_sequence", "_sdc_table_version", "_sdc_sync_started_at"]


@model("owm_forecast_raw", layer="staging", tags=("owm",))
def stg_forecast_stream(ctx: Context, raw: DataFrame) -> DataFrame:
    return raw.select("synced_at", "lat", "lon", "location_id", "timezone", "timezone_offset", "current", "minutely", "hourly", "daily", "alerts", *(c for c in _LOADED if c in raw.columns))


def _new_rows(name: str, build):
    """Entries that the table doesn't have yet, the newest answer first; what it has stays as it came."""

    def rows(ctx: Context, stream: DataFrame) -> DataFrame:
        return dedup.latest(build(stream), ["dt_lat_lon"], "synced_at")

    rows.__name__ = name
    model("stg_forecast_stream", name=name, layer="silver", kind="insert", key=("dt_lat_lon",), tags=("owm",))(rows)


for _kind in ("current", "hourly", "daily", "minutely", "alerts"):
    _new_rows(f"owm_weather_{_kind}", getattr(payloads, f"weather_{_kind}"))


def place_rows(df: DataFrame, place: str, key: list[str], newest: str) -> DataFrame:
    """Rows of locations whose name holds ``place``, one of each key."""
    return dedup.latest(df.filter(F.lower("location_id").contains(place.lower())), key, newest)


for _kind, (_key, _newest) in {"alerts": (["synced_at", "event", "start_ts"], "start_ts"), "current": (["dt_lat_lon"], "synced_at"), "daily": (["synced_at", "dt_lat_lon"], "ts"), "hourly": (["synced_at", "dt_lat_lon"], "ts"), "minutely": (["synced_at", "dt_lat_lon"], "dt")}.items():

    def _rows(ctx: Context, df: DataFrame, _key: list[str] = _key, _newest: str = _newest) -> DataFrame:
        return place_rows(df, ctx.var("place", "folgaria"), _key, _newest)

    model(f"owm_weather_{_kind}", name=f"folgaria_weather_{_kind}", kind="table" if _kind == "current" else "merge", key=tuple(_key), tags=("owm",))(_rows)

#: Observed properties and their labels (fixed values).
PROPERTIES = [
    ("temperature", "Air Temperature"), ("humidity", "Relative Humidity"), ("pressure", "Air Pressure"), ("uvi", "UV Index"), ("clouds", "Cloud Cover"),
    ("wind_deg", "Wind Direction"), ("precipitation", "Precipitation"), ("pop", "Probability of Precipitation"),
]


@model(alias="weather_observed_properties", tags=("owm", "rdf"))
def rdf_weather_observed_properties(ctx: Context) -> DataFrame:
    return ctx.spark.createDataFrame(PROPERTIES, "code string, label string")


def _feature() -> Column:
    return keys.text("weather:feature:", F.col("location_id")).alias("foi_iri")


_OBSERVED = ["temp", "humidity", "pressure", "uvi", "clouds", "wind_deg", "weather_main", "weather_description"]

for _scale, _at, _values in (("current", "ts", _OBSERVED), ("hourly", "ts", _OBSERVED), ("minutely", "dt", ["precipitation"])):

    def _obs(ctx: Context, df: DataFrame, _scale: str = _scale, _at: str = _at, _values: list[str] = _values) -> DataFrame:
        iri = keys.text(f"weather:obs:{_scale}:", F.col("location_id"), ":", keys.zoned(_at))
        return df.select(iri.alias("observation_iri"), F.col(_at).alias("result_time"), "location_id", _feature(), F.lit(_scale).alias("timescale"), *_values)

    model(f"owm_weather_{_scale}", name=f"rdf_weather_observations_{_scale}", tags=("owm", "rdf"))(_obs)


@model("owm_weather_daily", tags=("owm", "rdf"))
def rdf_weather_observations_daily(ctx: Context, df: DataFrame) -> DataFrame:
    """Days carry no identifiers."""
    temps = [f"{p}_{t}" for p, ts in (("temp", ("day", "min", "max", "night", "eve", "morn")), ("feels_like", ("day", "night", "eve", "morn"))) for t in ts]
    return df.select("location_id", F.col("ts").alias("result_time"), *temps, "humidity", "pressure", "uvi", "rain", "clouds", "wind_deg", "wind_gust", "weather_description", "summary")


@model("owm_weather_alerts", tags=("owm", "rdf"))
def rdf_weather_alerts(ctx: Context, a: DataFrame) -> DataFrame:
    iri = keys.text("weather:alert:", F.col("location_id"), ":", keys.zoned("start_ts"))
    return a.select(iri.alias("alert_iri"), "location_id", _feature(), "sender_name", "event", "description", "start_ts", "end_ts")


@model("owm_weather_current", tags=("owm", "rdf"))
def rdf_weather_feature_of_interest(ctx: Context, c: DataFrame) -> DataFrame:
    return c.select("location_id", "lat", "lon", _feature()).distinct()


_DEGREE, _SHARE = "unit:DegreeCelsius", "unit:Percent"
#: Property and unit of each column, by time scale (fixed values).
_POINT = {
    "temp": ("Temperature", _DEGREE), "humidity": ("Humidity", _SHARE), "pressure": ("Pressure", "unit:HectoPASCal"), "uvi": ("UVI", None), "clouds": ("CloudCover", _SHARE), "wind_deg": ("WindDirection", "unit:Degree"),
    "weather_description": ("WeatherCondition", None),
}
LONG = {
    "current": _POINT,
    "hourly": _POINT,
    "daily": {
        "temp_day": ("TemperatureDay", _DEGREE), "temp_min": ("TemperatureMin", _DEGREE), "temp_max": ("TemperatureMax", _DEGREE), "temp_night": ("TemperatureNight", _DEGREE), "temp_eve": ("TemperatureEvening", _DEGREE),
        "temp_morn": ("TemperatureMorning", _DEGREE), "feels_like_day": ("FeelsLikeDay", _DEGREE), "feels_like_night": ("FeelsLikeNight", _DEGREE), "feels_like_eve": ("FeelsLikeEvening", _DEGREE), "feels_like_morn": ("FeelsLikeMorning", _DEGREE),
        "humidity": ("Humidity", _SHARE), "pressure": ("Pressure", "unit:HectoPASCal"), "uvi": ("UVI", None), "rain": ("Rainfall", "unit:Millimeter"), "clouds": ("CloudCover", _SHARE), "wind_deg": ("WindDirection", "unit:Degree"),
        "wind_gust": ("WindGust", "unit:MeterPerSecond"), "weather_description": ("WeatherCondition", None), "summary": ("Summary", None),
    },
    "minutely": {"precipitation": ("Precipitation", "unit:Millimeter")},
}


def _long(df: DataFrame, scale: str) -> DataFrame:
    """A row per observation and property, values as text, missing values kept: one pass, no union over properties."""
    one = [F.struct(F.lit(name).alias("property"), keys.number_text(df, c).alias("value"), F.lit(unit).cast("string").alias("unit")) for c, (name, unit) in LONG[scale].items()]
    e = df.select("location_id", "result_time", F.explode(F.array(*one)).alias("e")).select("location_id", "result_time", "e.*")
    key = keys.text(f"{scale}|", F.col("location_id"), "|", keys.zoned("result_time"), "|", F.col("property"))
    return e.select(F.md5(key).alias("observation_id"), "location_id", "result_time", "property", "value", "unit")


@model("rdf_weather_observations_current", "rdf_weather_observations_hourly", "rdf_weather_observations_daily", "rdf_weather_observations_minutely", tags=("owm", "rdf"))
def rdf_weather_observations_unpivoted(ctx: Context, current: DataFrame, hourly: DataFrame, daily: DataFrame, minutely: DataFrame) -> DataFrame:
    return _long(current, "current").unionAll(_long(hourly, "hourly")).unionAll(_long(daily, "daily")).unionAll(_long(minutely, "minutely"))


# --- the facade: every location gets the nearest source -----------------------------------------------------------------


def nearest_source(src: DataFrame, places: DataFrame, keys_: list[str], reach: float, tie: str) -> DataFrame:
    """For each place (and time) the source row within ``reach`` degrees on both axes that is nearest, then by height, then by id."""
    p = places.select("location_id", F.col("lat").alias("p_lat"), F.col("lon").alias("p_lon"), F.col("elevation_m").alias("p_elevation"))
    s = src.withColumnRenamed("location_id", "source_id") if "location_id" in src.columns else src
    far = F.abs(F.col("lat") - F.col("p_lat")) + F.abs(F.col("lon") - F.col("p_lon"))
    pairs = joins.near_join(p, s, ["location_id"], ("p_lat", "p_lon"), ("lat", "lon"), reach, far)
    best = joins.nearest(pairs, ["location_id", *keys_], F.col("distance"), F.abs(F.col("elevation_m") - F.col("p_elevation")).asc_nulls_last(), F.col(tie))
    return best.drop("p_lat", "p_lon", "p_elevation", "distance")


for _contract in ("current", "forecast_daily", "forecast_hourly"):

    def _pass(ctx: Context, df: DataFrame) -> DataFrame:
        return df

    model(f"mt_weather_{_contract}", name=f"stg_weather_{_contract}", layer="staging", tags=("weather",))(_pass)

_ALERT = ["location_id", "provider", "alert_id", "event", "severity", "urgency", "headline", "description", "starts_at", "expires_at", "source_name", "area_desc"]


@model("mt_weather_alerts", "weather_locations", layer="staging", tags=("weather",))
def stg_weather_alerts(ctx: Context, alerts: DataFrame, places: DataFrame) -> DataFrame:
    """Alerts without a place go to every place of their provider."""
    regional = alerts.filter("location_id IS NULL").drop("location_id").join(places.select("location_id", "provider"), "provider")
    return regional.select(*_ALERT).unionByName(alerts.filter("location_id IS NOT NULL").select(*_ALERT))


@model("stg_weather_alerts", name="weather_alerts_active", kind="table", tags=("weather",))
def weather_alerts_active(ctx: Context, alerts: DataFrame) -> DataFrame:
    return alerts


_WIND = ["wind_speed_ms", "wind_gust_ms", "wind_direction_deg"]


@model("stg_weather_current", "weather_locations", name="weather_current", kind="table", tags=("weather",))
def weather_current(ctx: Context, src: DataFrame, places: DataFrame) -> DataFrame:
    n = nearest_source(src, places, [], 0.15, "station_id")
    return n.select("location_id", "provider", "station_id", "station_name", "observed_at", "elevation_m", "temperature_c", "humidity_pct", "wind_speed_ms", "wind_direction_deg", "wind_gust_ms", "precipitation_mm", "cloud_cover_pct", "sky_condition", "pressure_hpa")


@model("stg_weather_forecast_daily", "weather_locations", name="weather_forecast_daily", kind="merge", key=("location_id", "forecast_date"), tags=("weather",))
def weather_forecast_daily(ctx: Context, src: DataFrame, places: DataFrame) -> DataFrame:
    n = nearest_source(src, places, ["forecast_date"], 0.1, "source_id")
    return n.select("location_id", "provider", "forecast_date", "elevation_m", "temperature_c", "temperature_min_c", "temperature_max_c", "precipitation_mm", "precipitation_probability_pct", *_WIND, "cloud_cover_pct", "sky_condition", "snow_cm", "sunrise", "sunset")


@model("stg_weather_forecast_hourly", "weather_locations", name="weather_forecast_hourly", kind="merge", key=("location_id", "forecast_at"), tags=("weather",))
def weather_forecast_hourly(ctx: Context, src: DataFrame, places: DataFrame) -> DataFrame:
    n = nearest_source(src, places, ["forecast_at"], 0.1, "source_id")
    return n.select("location_id", "provider", "forecast_at", "elevation_m", "temperature_c", "humidity_pct", *_WIND, "precipitation_mm", "precipitation_probability_pct", "cloud_cover_pct", "sky_condition", "pressure_hpa", "snow_cm")
