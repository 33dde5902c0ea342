"""Metering and the energy community: slot roll-ups, gaps, netting per substation, shares, measurements."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import Context
from ..functions import keys, tiers, time as T
from ..operators import allocation, dedup, joins, timeseries
from ..registry import Since, model
from ..sources import payloads

MEASURES = ["consumption_kwh", "production_kwh", "self_consumed_kwh"]
#: Units of energies and of ratios (fixed values).
KWH, UNITLESS = "http://qudt.org/vocab/unit/KiloW-HR", "http://qudt.org/vocab/unit/UNITLESS"


def _since(back: str) -> Since:
    return Since("ts", back=back)


@model("meters_data_normalized", kind="merge", key=("_id",), update=("ts", *MEASURES), reads={"meters_data_normalized": _since("1 HOUR")}, tags=("metering",))
def meters_data_15m(ctx: Context, raw: DataFrame) -> DataFrame:
    g = raw.groupBy("device_id", "ts").agg(*(F.sum(m).alias(m) for m in MEASURES))
    return g.select(keys.md5_key(F.col("device_id"), keys.stamp("ts")).alias("_id"), "device_id", "ts", *MEASURES)


@model("meters_data_15m", kind="merge", key=("_id",), update=("ts", "consumption_kwh", "production_kwh"), reads={"meters_data_15m": _since("1 HOUR")}, tags=("metering",))
def meters_data_1h(ctx: Context, slots: DataFrame) -> DataFrame:
    """The bound lies on a full hour, so every hour that is read is whole."""
    g = timeseries.rollup(slots, ["device_id"], "ts", 60, {m: F.col(m) for m in MEASURES[:2]})
    return g.select(keys.md5_key(F.col("device_id"), keys.stamp("ts")).alias("_id"), "device_id", "ts", *MEASURES[:2])


@model("meters_data_15m", kind="merge", key=("event_id",), update=("device_id", "ts", "created_at"), after=_since("1 HOUR"), tags=("metering",))
def meters_data_15m_missing_intervals(ctx: Context, slots: DataFrame) -> DataFrame:
    """Slots of the last ``gap_hours`` (seven days), both ends included, without a reading; with the local hour."""
    end = T.floor_minutes(ctx.now(), 15)
    start = end - F.make_dt_interval(F.lit(0), F.lit(int(ctx.var("gap_hours", 7 * 24))), F.lit(0), F.lit(0))
    m = timeseries.missing_slots(slots, ["device_id"], "ts", start, end, "15 MINUTES")
    local = T.to_local(F.col("ts").cast("timestamp"), ctx.var("zone", "Europe/Rome"))
    return m.select(keys.md5_key(F.col("device_id"), keys.stamp("ts")).alias("event_id"), "device_id", "ts", F.hour(local).alias("hour"), ctx.now().alias("created_at"))


def _observations(ctx: Context, df: DataFrame, key: Column, feature: Column, sensor: Column | None, *quantities: tuple) -> DataFrame:
    """A row per quantity that has a value. ``quantities``: (property, column, unit and whether a sensor measured it). The
    identifiers' base and the vocabulary are the variables ``id_base`` and ``vocabulary``."""
    text = lambda: F.lit(None).cast("string")
    part = lambda c: F.col(c) if c in df.columns else text()
    one = [F.struct(F.lit(p).alias("property"), F.col(c).alias("value"), F.lit(unit).alias("unit"), F.lit(measured).alias("measured")) for p, c, unit, measured in quantities]
    e = df.select(key.alias("__key"), F.col("ts").alias("result_time"), *(part(c).alias(c) for c in ("device_id", "rec_id", "substation_id")), feature.alias("feature_iri"), (text() if sensor is None else sensor).alias("__sensor"), F.explode(F.array(*one)).alias("e"))
    return e.filter("e.value IS NOT NULL").select(
        F.md5(F.concat("__key", F.lit("|"), "e.property")).alias("observation_id"), "result_time", "device_id", "rec_id", "substation_id", "feature_iri", F.when(F.col("e.measured"), F.col("__sensor")).alias("sensor_iri"),
        F.concat(F.lit(ctx.var("vocabulary", "https://example.org/energy#")), "e.property").alias("observed_property"), "e.value", "e.unit",
    )


def _id(ctx: Context, kind: str, *parts: str) -> Column:
    """An identifier of a kind of thing; null if a part is."""
    return F.concat(F.lit(f"{ctx.var('id_base', 'https://example.org/id')}/{kind}"), *(x for p in parts for x in (F.lit("/"), F.col(p))))


@model("meters_data_15m", tags=("metering",))
def meters_measurements_15m(ctx: Context, slots: DataFrame) -> DataFrame:
    q = [("GridImportEnergy", "consumption_kwh", KWH, True), ("GridExportEnergy", "production_kwh", KWH, True), ("SelfConsumedEnergy", "self_consumed_kwh", KWH, True)]
    return _observations(ctx, slots, F.col("_id"), _id(ctx, "connection-point", "device_id"), _id(ctx, "device", "device_id"), *q)


@model("rec_registry_mirror", layer="silver", tags=("community",))
def silver_rec_registry(ctx: Context, members: DataFrame) -> DataFrame:
    return payloads.registry_devices(members)


@model("silver_gse_cabine_raw", layer="silver", kind="table", tags=("community",))
def silver_gse_cabine_primarie(ctx: Context, raw: DataFrame) -> DataFrame:
    """Substation areas that are not deleted, the attributes from the JSON text ``features``."""
    of = lambda p, kind="string": F.get_json_object("features", f"$.{p}").cast(kind).alias(p)
    filled = lambda p: F.nullif(F.trim(F.get_json_object("features", f"$.{p}")), F.lit("")).alias(p)
    at = F.coalesce("_sdc_extracted_at", "_sdc_received_at", "_sdc_batched_at")
    return raw.filter("_sdc_deleted_at IS NULL").select(
        "fid", "geometry", of("cod_ac"), of("rag_soc"), filled("cod_conseg"), of("shape__area", "double"), of("shape__length", "double"), of("objectid", "int"), of("p_cab_pri"), of("t_cab_pri"), filled("txt1"), filled("txt2"),
        at.alias("last_updated_at"), "_sdc_filename", "_sdc_deleted_at",
    )


@model("silver_gse_cabine_primarie", kind="merge", key=("cod_ac",), update=("geometry", "rag_soc", "cod_conseg", "shape__area", "shape__length", "last_updated_at"), reads={"silver_gse_cabine_primarie": Since("last_updated_at", strict=True)}, tags=("community",))
def gse_cabine_primarie(ctx: Context, areas: DataFrame) -> DataFrame:
    """The geometry stays WKT in degrees; of rows of one area the last loaded."""
    newest = dedup.latest(areas, ["cod_ac"], "last_updated_at")
    return newest.select("geometry", "rag_soc", "cod_ac", "cod_conseg", "shape__area", "shape__length", "last_updated_at")


_TOTALS = ["total_consumption_kwh", "total_production_kwh", "self_consumption_kwh", "self_consumption_ratio"]
_POOL = ("ts", "rec_id", "substation_id")


@model("meters_data_15m", "silver_rec_registry", kind="merge", key=_POOL, update=tuple(_TOTALS), reads={"meters_data_15m": _since("1 HOUR")}, tags=("community",))
def rec_virtual_consumption_15m(ctx: Context, meters: DataFrame, registry: DataFrame) -> DataFrame:
    m = meters.join(registry, meters["device_id"] == registry["sensor_id"])
    made = F.when(F.col("role") == "prosumer", F.coalesce("production_kwh", F.lit(0.0))).otherwise(0.0)
    g = m.groupBy(*_POOL).agg(F.sum("consumption_kwh").alias("total_consumption_kwh"), F.sum(made).alias("total_production_kwh"))
    return _with_self_consumption(g)


def _with_self_consumption(g: DataFrame) -> DataFrame:
    own = allocation.netted(F.col("total_production_kwh"), F.col("total_consumption_kwh"))
    return g.withColumn("self_consumption_kwh", own).withColumn("self_consumption_ratio", tiers.share(F.col("self_consumption_kwh"), F.col("total_production_kwh")))


@model("rec_virtual_consumption_15m", kind="merge", key=_POOL, update=tuple(_TOTALS), reads={"rec_virtual_consumption_15m": _since("2 HOURS")}, tags=("community",))
def rec_virtual_consumption_hourly(ctx: Context, slots: DataFrame) -> DataFrame:
    """Sums of what was netted per slot; the ratio is taken from the sums."""
    g = timeseries.rollup(slots, ["rec_id", "substation_id"], "ts", 60, {c: F.col(c) for c in _TOTALS[:3]})
    return g.select(*_POOL, *_TOTALS[:3], tiers.share(F.col("self_consumption_kwh"), F.col("total_production_kwh")).alias("self_consumption_ratio"))


_SHARE = ("ts", "device_id", "rec_id", "substation_id", "consumption_kwh", "virtual_consumption_kwh", "ratio")


def _device_key() -> Column:
    return keys.md5_key(F.col("device_id"), keys.stamp("ts"), F.col("rec_id"), F.col("substation_id")).alias("_id")


@model("meters_data_15m", "silver_rec_registry", "rec_virtual_consumption_15m", kind="merge", key=("_id",), update=_SHARE, reads={"meters_data_15m": _since("1 HOUR"), "rec_virtual_consumption_15m": _since("1 HOUR")}, tags=("community",))
def rec_virtual_consumption_per_device_15m(ctx: Context, meters: DataFrame, registry: DataFrame, pool: DataFrame) -> DataFrame:
    """A device's share of what its substation shares, by its part of the consumption."""
    m = meters.join(registry, meters["device_id"] == registry["sensor_id"]).select("ts", "rec_id", "substation_id", "device_id", "consumption_kwh")
    p = pool.select(*_POOL, "total_consumption_kwh", "self_consumption_kwh")
    out = m.join(p, list(_POOL)).withColumn("ratio", tiers.share(F.col("consumption_kwh"), F.col("total_consumption_kwh")))
    return out.select(_device_key(), "ts", "device_id", "rec_id", "substation_id", "consumption_kwh", "ratio", (F.col("ratio") * F.col("self_consumption_kwh")).alias("virtual_consumption_kwh"))


@model("rec_virtual_consumption_per_device_15m", kind="merge", key=("_id",), update=_SHARE, reads={"rec_virtual_consumption_per_device_15m": _since("2 HOURS")}, tags=("community",))
def rec_virtual_consumption_per_device_hourly(ctx: Context, slots: DataFrame) -> DataFrame:
    g = timeseries.rollup(slots, ["rec_id", "substation_id", "device_id"], "ts", 60, {c: F.col(c) for c in ("consumption_kwh", "virtual_consumption_kwh")})
    g = allocation.share_of_total(g, list(_POOL), "consumption_kwh", "ratio")
    return g.select(_device_key(), "ts", "device_id", "rec_id", "substation_id", "consumption_kwh", "virtual_consumption_kwh", "ratio")


@model("rec_virtual_consumption_15m", tags=("community",))
def rec_measurements_15m(ctx: Context, slots: DataFrame) -> DataFrame:
    q = [("GridImportEnergy", "total_consumption_kwh", KWH, False), ("GridExportEnergy", "total_production_kwh", KWH, False), ("CollectivelySharedEnergy", "self_consumption_kwh", KWH, False), ("SelfConsumptionRatio", "self_consumption_ratio", UNITLESS, False)]
    grain = F.concat("rec_id", F.lit("|"), "substation_id", F.lit("|"), keys.stamp("ts"))
    return _observations(ctx, slots, grain, _id(ctx, "sharing-group", "rec_id", "substation_id"), None, *q)


@model("rec_virtual_consumption_per_device_15m", tags=("community",))
def rec_measurements_per_device_15m(ctx: Context, slots: DataFrame) -> DataFrame:
    """What a meter measured has a sensor; the virtual share has none."""
    q = [("GridImportEnergy", "consumption_kwh", KWH, True), ("VirtualConsumedEnergy", "virtual_consumption_kwh", KWH, False)]
    return _observations(ctx, slots, F.col("_id"), _id(ctx, "connection-point", "device_id"), _id(ctx, "device", "device_id"), *q)


def balance(slots: DataFrame) -> DataFrame:
    """Read query: totals and the share of each community's self-consumption."""
    g = slots.groupBy("rec_id").agg(F.sum("total_production_kwh").alias("production_kwh"), F.sum("self_consumption_kwh").alias("self_consumption_kwh"))
    whole = joins.with_scalars(g, g.agg(F.sum("self_consumption_kwh").alias("__all")))
    return whole.withColumn("share", F.col("self_consumption_kwh") / F.col("__all")).drop("__all")
