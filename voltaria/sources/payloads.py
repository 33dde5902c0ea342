"""Service answers and bundles as tables: weather forecasts, registries, detections."""

from __future__ import annotations

import datetime
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

try:  # only bundles in YAML need it
    import yaml
except ImportError:
    yaml = None

_SKY = "weather:array<struct<main:string,description:string>>"
#: Fields of one entry of a forecast, by kind.
ENTRIES = {
    "hourly": f"struct<dt:long,temp:double,humidity:int,pressure:int,uvi:double,clouds:int,wind_deg:int,{_SKY}>",
    "daily": "struct<dt:long,pop:double,uvi:double,rain:double,clouds:int,sunrise:long,sunset:long,humidity:int,pressure:int,wind_deg:int,dew_point:double,wind_gust:double,temp:struct<day:double,min:double,max:double,night:double,eve:double,morn:double>,"
    f"feels_like:struct<day:double,night:double,eve:double,morn:double>,{_SKY},summary:string,moonrise:long,moonset:long>",
    "alerts": "struct<sender_name:string,event:string,start:long,end:long,description:string>",
    "minutely": "struct<dt:long,precipitation:double>",
    "current": f"struct<dt:long,temp:double,humidity:int,pressure:int,uvi:double,clouds:int,wind_deg:int,sunrise:long,sunset:long,{_SKY}>",
}
_PLACE = ["synced_at", "lat", "lon"]


def epoch(c: Column | str) -> Column:
    return F.timestamp_seconds(F.col(c) if isinstance(c, str) else c)


def _key(*cols: str) -> Column:
    """Parts that are missing are empty, as their separators stay."""
    return F.concat_ws("_", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols)).alias("dt_lat_lon")


def _sky() -> list[Column]:
    first = F.get("e.weather", F.lit(0))
    return [first["main"].alias("weather_main"), first["description"].alias("weather_description")]


def entries(stream: DataFrame, kind: str) -> DataFrame:
    """A row per entry (``e``) of a forecast's JSON array; answers without the array give none."""
    return stream.select(*_PLACE, "location_id", F.explode(F.from_json(kind, f"array<{ENTRIES[kind]}>")).alias("e"))


def weather_current(stream: DataFrame) -> DataFrame:
    """Every answer gives a row, one without current conditions a row of nulls."""
    e = stream.withColumn("e", F.from_json("current", ENTRIES["current"]))
    fields = ["temp", "humidity", "pressure", "uvi", "clouds", "wind_deg"]
    return e.select(*_PLACE, "timezone", "timezone_offset", "location_id", epoch("e.dt").alias("ts"), *(f"e.{f}" for f in fields), epoch("e.sunrise").alias("sunrise"), epoch("e.sunset").alias("sunset"), *_sky(), _key("e.dt", "lat", "lon"))


def weather_hourly(stream: DataFrame) -> DataFrame:
    fields = ["temp", "humidity", "pressure", "uvi", "clouds", "wind_deg"]
    return entries(stream, "hourly").select(*_PLACE, "location_id", epoch("e.dt").alias("ts"), *(f"e.{f}" for f in fields), *_sky(), _key("e.dt", "lat", "lon"))


def weather_daily(stream: DataFrame) -> DataFrame:
    temps = [F.col(f"e.{p}.{t}").alias(f"{p}_{t}") for p, ts in (("temp", ("day", "min", "max", "night", "eve", "morn")), ("feels_like", ("day", "night", "eve", "morn"))) for t in ts]
    sun, moon = ([epoch(f"e.{c}{when}").alias(f"{c}{when}") for when in ("rise", "set")] for c in ("sun", "moon"))
    fields = ["humidity", "pressure", "wind_deg", "dew_point", "wind_gust"]
    return entries(stream, "daily").select(*_PLACE, "location_id", epoch("e.dt").alias("ts"), "e.pop", "e.uvi", "e.rain", "e.clouds", *sun, *(f"e.{f}" for f in fields), *temps, *_sky(), "e.summary", *moon, _key("e.dt", "lat", "lon"))


def weather_minutely(stream: DataFrame) -> DataFrame:
    return entries(stream, "minutely").select(*_PLACE, "location_id", epoch("e.dt").alias("dt"), "e.precipitation", _key("e.dt", "lat", "lon"))


def weather_alerts(stream: DataFrame) -> DataFrame:
    """An alert's key holds its start and its end."""
    return entries(stream, "alerts").select(*_PLACE, "location_id", "e.sender_name", "e.event", epoch("e.start").alias("start_ts"), epoch("e.end").alias("end_ts"), "e.description", _key("e.start", "e.end", "lat", "lon"))


def grid_answers(answers: DataFrame, arrays: list[str]) -> DataFrame:
    """Column-wise answers (one array per variable and one of times) to a row per time."""
    from ..operators.reshape import zip_arrays

    return zip_arrays(answers, arrays)


#: What forecasts of today and tomorrow, and those of later days, come from (fixed values).
NEAR_MODEL, FAR_MODEL = "icon_d2", "best_match_extended"


def heat_days(answers: DataFrame, today: datetime.date) -> DataFrame:
    """A service's daily rows as raw heat rows, each with the forecast model by its distance from the day of the extraction."""
    date = F.to_date("time")
    model = F.when(F.date_diff(date, F.lit(today)) <= 1, NEAR_MODEL).otherwise(FAR_MODEL)
    return answers.select(date.alias("date"), "lat", "lon", "temperature_2m_max", "elevation", model.alias("model"))


BUNDLE = "struct<community:struct<id:string,areas:map<string,struct<topology:array<string>>>>,members:map<string,struct<status:string,user_id:string,area:string,role:string,type:string,delivery_points:array<struct<id:string>>,assets:struct<meter:map<string,struct<sensor_id:string>>>>>>"


def bundles(texts: DataFrame, column: str = "value") -> DataFrame:
    """(bundle), a row of JSON text per document of exports that hold several, parted by lines of three hyphens, in YAML or
    JSON. Empty documents and null texts give no rows; a document that can't be read fails."""
    parts = texts.select(F.explode(F.split(column, r"(?m)^---(?=\s|$)[ \t]*(?:#.*)?")).alias("part")).filter(F.trim(F.regexp_replace("part", r"(?m)^\s*(#.*|\.\.\.)?$", ""), F.lit(" \n\r\t")) != "")

    @F.pandas_udf("string")
    def as_json(frames: Iterator[pd.Series]) -> Iterator[pd.Series]:
        load = json.loads if yaml is None else lambda t: yaml.load(t, getattr(yaml, "CSafeLoader", yaml.SafeLoader))
        for texts in frames:
            docs = texts.map(load)
            yield docs.map(lambda d: json.dumps(d, default=str) if d else None)

    return parts.select(as_json("part").alias("bundle")).filter(F.col("bundle").isNotNull())


def registry_members(bundles: DataFrame, column: str = "bundle") -> DataFrame:
    """A row per active member of community bundles given as JSON text. Communities without an id, and members without a user,
    give none."""
    b = bundles.select(F.from_json(column, BUNDLE).alias("b"))
    m = b.select(F.col("b.community.id").alias("rec_id"), F.col("b.community.areas").alias("areas"), F.explode(F.map_entries("b.members")).alias("m")).filter((F.lower("m.value.status") == "active") & (F.col("rec_id") != "") & (F.col("m.value.user_id") != ""))
    v = F.col("m.value")
    sensors = F.filter(F.transform(F.map_values(v["assets"]["meter"]), lambda x: x["sensor_id"]), lambda s: s != "")
    none = F.array().cast("array<string>")
    return m.select(
        v["user_id"].alias("user_id"), "rec_id", v["area"].alias("area"), v["role"].alias("role"), v["type"].alias("member_type"),
        F.coalesce(F.try_element_at("areas", v["area"])["topology"], none).alias("topology_ids"),
        F.coalesce(F.filter(F.transform(v["delivery_points"], lambda p: p["id"]), lambda p: p != ""), none).alias("delivery_point_ids"), F.coalesce(sensors, none).alias("sensor_ids"),
    )


def registry_devices(members: DataFrame) -> DataFrame:
    """A row per sensor of a member, with its first topology node; members without sensors give none."""
    one = members.filter(F.size("sensor_ids") > 0)
    return one.select("user_id", "rec_id", "area", "role", "member_type", F.get("topology_ids", F.lit(0)).alias("substation_id"), F.explode("sensor_ids").alias("sensor_id"), *(c for c in members.columns if c == "last_updated"))


def commitments(raw: DataFrame) -> DataFrame:
    """Typed commitments; a status such as "Kind.settled" is its last part."""
    hours = (F.unix_micros("period_end") - F.unix_micros("period_start")) / 3_600_000_000.0
    return raw.withColumn("status", F.lower(F.split_part("status", F.lit("."), F.lit(-1)))).withColumn("duration_hours", hours)


def detection(raw: Column) -> tuple[Column, Column]:
    """(has_pv, confidence) of a model's free answer. The first {...} in it counts if it is JSON: its has_pv (any value that
    isn't false, 0, empty or null), its confidence. Otherwise has_pv is true if the text holds "true" or "yes" anywhere,
    else false if it holds "false" or "no", else null, and the confidence is the number after "confidence" or "conf".
    The confidence is held within 0 and 1 and is 0 if there is none."""
    found = F.regexp_extract(raw, r"(\{[^{}]*\})", 1)
    obj = F.from_json(found, "map<string,string>")
    value, quoted = F.try_element_at(obj, F.lit("has_pv")), F.regexp_like(found, F.lit(r'"has_pv"\s*:\s*"'))
    truthy = F.when(quoted, value != "").otherwise(~F.coalesce(value.isin("false", "0", "0.0", "[]", "{}"), F.lit(True)))
    low = F.lower(raw)
    said = F.when(low.contains("true") | low.contains("yes"), True).when(low.contains("false") | low.contains("no"), False)
    number = F.regexp_extract(low, r"(?:confidence|conf)[:\s]*([0-9]*\.?[0-9]+)", 1)
    given = F.try_element_at(obj, F.lit("confidence"))
    json = obj.isNotNull() & (given.isNull() | given.try_cast("double").isNotNull())
    flag = F.when(json, F.when(F.map_contains_key(obj, "has_pv"), truthy)).otherwise(said)
    confidence = F.when(json, F.coalesce(given.try_cast("double"), F.lit(0.0))).otherwise(F.when(number != "", number.cast("double")).otherwise(0.0))
    return flag, F.when(raw.isNotNull(), F.least(F.greatest(confidence, F.lit(0.0)), F.lit(1.0)))
