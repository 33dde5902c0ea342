"""Buildings and rooftop photovoltaics: open map data, constraints, suitability, detections, estimates, plans."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..context import Context
from ..functions import geo
from ..operators import dedup, planning, spatial
from ..registry import Since, model
from ..sources import payloads

# --- open map data ------------------------------------------------------------------------------------------------------


#: What was loaded since the target's newest load.
_LOADED = Since("_sdc_extracted_at", strict=True)


def _osm_staging(region: str):
    def build(ctx: Context, raw: DataFrame) -> DataFrame:
        return raw

    model(f"osm_{region}_raw", name=f"openstreetmap_{region}", layer="staging", tags=("osm",))(build)


def _osm_base(region: str, tags: list[str]):
    """Features (osm_id, element, WKT in degrees, JSON tags) with their tags as columns; of one loaded again the last."""

    def build(ctx: Context, s: DataFrame) -> DataFrame:
        t = dedup.latest(s, ["osm_id"], "_sdc_extracted_at").withColumn("__t", F.from_json("features", "map<string,string>"))
        named = [F.try_element_at("__t", F.lit(k)).alias(k.replace(":", "_")) for k in tags]
        return t.select("osm_id", "element", "geometry", "_sdc_extracted_at", *named, geo.wkt_feature(F.col("geometry")).alias("geom_geojson"))

    model(f"openstreetmap_{region}", name=f"openstreetmap_{region}_base", layer="silver", kind="merge", key=("osm_id",), reads={f"openstreetmap_{region}": _LOADED}, tags=("osm",))(build)


def themes() -> dict[str, dict[str, Column]]:
    """Region -> theme -> predicate by map tags (fixed values); alternatives are in brackets."""
    c = F.col
    return {
        "fi_lappeenranta": {"social_buildings": (c("amenity") == "social_facility") | c("social_facility").isNotNull()},
        "it_alpecimbra": {
            "amusement": c("leisure").isin("amusement_arcade", "theme_park", "water_park", "park"), "ev_charging": c("amenity") == "charging_station",
            "hospitality": c("tourism").isin("hotel", "guest_house", "alpine_hut", "resort", "hostel", "camp_site", "caravan_site"), "parking": c("amenity").isin("parking", "parking_space"),
            "piste_and_lifts": c("piste_type").isNotNull() | c("aerialway").isNotNull(), "tourism_culture": c("tourism").isin("museum", "artwork", "gallery", "attraction", "exhibit") | c("heritage").isNotNull() | c("amenity").isin("theatre", "arts_centre"),
        },
    }


#: Tags that become columns, by region (fixed values).
_OSM_TAGS = {
    "fi_lappeenranta": ["name", "amenity", "social_facility", "operator", "addr:city", "addr:street", "addr:postcode", "phone", "website", "start_date"],
    "it_alpecimbra": ["piste:type", "aerialway", "tourism", "amenity", "leisure", "heritage", "name"],
}


def _register_osm() -> None:
    for region, tags in _OSM_TAGS.items():
        _osm_staging(region)
        _osm_base(region, tags)
        for theme in {"fi_lappeenranta": ["social_buildings"], "it_alpecimbra": ["amusement", "ev_charging", "hospitality", "parking", "piste_and_lifts", "tourism_culture"]}[region]:

            def build(ctx: Context, base: DataFrame, region: str = region, theme: str = theme) -> DataFrame:
                return base.filter(themes()[region][theme])

            model(f"openstreetmap_{region}_base", name=f"openstreetmap_{region}_{theme}", layer="silver", kind="merge", key=("osm_id",), reads={f"openstreetmap_{region}_base": _LOADED}, tags=("osm",))(build)


_register_osm()


@model("overture_buildings_raw", layer="staging", tags=("overture",))
def stg_overture_buildings(ctx: Context, raw: DataFrame) -> DataFrame:
    return raw.select("geometry", "features", *(c for c in ("metadata", *_META) if c in raw.columns))


#: What loaders add to every row.
_META = ("_sdc_extracted_at", "_sdc_received_at", "_sdc_batched_at", "_sdc_deleted_at", "_sdc_sequence")


@model("stg_overture_buildings", layer="silver", kind="merge", key=("building_id",), reads={"stg_overture_buildings": _LOADED}, tags=("overture",))
def pv_overture_buildings(ctx: Context, s: DataFrame) -> DataFrame:
    """Buildings under a stable id, the MD5 of their outline."""
    p = lambda k, kind: F.get_json_object("features", f"$.{k}").cast(kind)
    b = dedup.latest(s.withColumn("building_id", F.md5("geometry")), ["building_id"], "_sdc_extracted_at")
    return b.select(
        "building_id", "geometry", "_sdc_extracted_at", p("class", "string").alias("building_class"), p("subtype", "string").alias("building_subtype"), p("height", "double").alias("height"), p("num_floors", "int").alias("num_floors"),
        geo.area_of(geo.polygons_of_wkt(F.col("geometry"))).alias("footprint_area_m2"), geo.wkt_feature(F.col("geometry")).alias("geom_geojson"),
    )


# --- constraints and suitability ----------------------------------------------------------------------------------------


def _constraint(name: str, silver: str, *attributes: str):
    """Areas from GeoJSON. ``polygons`` are the parsed rings, for joins; ``geometry`` stays GeoJSON."""

    def staging(ctx: Context, raw: DataFrame) -> DataFrame:
        return raw.select("id", *(c for c in ("type",) if c in raw.columns), "geometry", *(c for c in ("geometry_name",) if c in raw.columns), "properties", *(c for c in _META if c in raw.columns))

    def build(ctx: Context, s: DataFrame) -> DataFrame:
        r = dedup.latest(s, ["id"], "_sdc_extracted_at").withColumn("polygons", geo.polygons_of_geojson(F.col("geometry")))
        named = [F.get_json_object("properties", f"$.{a}").alias(a) for a in attributes]
        return r.select("id", "geometry", "_sdc_extracted_at", *named, geo.area_of(F.col("polygons")).alias("area_m2"), F.concat(F.lit('{"type":"Feature","geometry":'), "geometry", F.lit(',"properties":{}}')).alias("geom_geojson"), "polygons")

    model(f"{name}_raw", name=f"stg_{name}", layer="staging", tags=("rooftops",))(staging)
    model(f"stg_{name}", name=silver, layer="silver", kind="merge", key=("id",), reads={f"stg_{name}": _LOADED}, tags=("rooftops",))(build)


_constraint("aree_non_idonee", "pv_aree_non_idonee", "nome", "tipo")
_constraint("vincoli_diretti", "pv_vincoli_diretti", "denominazione", "tipo_vincolo")
_constraint("vincoli_indiretti", "pv_vincoli_indiretti", "denominazione", "tipo_vincolo")

_BUILDING = ["building_class", "building_subtype", "height", "num_floors", "footprint_area_m2"]


@model("pv_overture_buildings", "pv_aree_non_idonee", "pv_vincoli_diretti", "pv_vincoli_indiretti", kind="merge", key=("building_id",), reads={"pv_overture_buildings": _LOADED}, tags=("rooftops",))
def pv_building_suitability(ctx: Context, b: DataFrame, areas: DataFrame, direct: DataFrame, indirect: DataFrame) -> DataFrame:
    """Buildings whose outline no constraint area touches; later runs test buildings loaded since."""
    other = [(c.select(F.explode("polygons").alias(f"rings_{k}")), f"rings_{k}") for k, c in enumerate((areas, direct, indirect))]
    own = b.withColumn("rings", geo.rings_of_wkt(F.col("geometry")))
    free = spatial.free_of(own, ["building_id"], "rings", other, float(ctx.var("cell_deg", 0.01)))
    return free.select("building_id", "geometry", *_BUILDING, "_sdc_extracted_at", geo.wkt_feature(F.col("geometry")).alias("geom_geojson"))


# --- detections -----------------------------------------------------------------------------------------------------------


@model("pv_predictions_raw", layer="staging", tags=("pv",))
def stg_pv_predictions(ctx: Context, raw: DataFrame) -> DataFrame:
    return raw.select("building_id", "has_pv", "confidence", "model_name", "lon", "lat", "_sdc_extracted_at")


@model("stg_pv_predictions", layer="silver", kind="merge", key=("building_id",), reads={"stg_pv_predictions": Since("detected_at", "_sdc_extracted_at", strict=True)}, tags=("pv",))
def pv_detections(ctx: Context, p: DataFrame) -> DataFrame:
    n = dedup.latest(p, ["building_id"], "_sdc_extracted_at")
    return n.select("building_id", F.col("has_pv").cast("boolean").alias("has_pv"), F.col("confidence").cast("double").alias("confidence"), "model_name", "lon", "lat", F.col("_sdc_extracted_at").alias("detected_at"))


@model("pv_detections", "pv_overture_buildings", kind="merge", key=("building_id",), reads={"pv_detections": Since("detected_at", strict=True)}, tags=("pv",))
def pv_detected_installations(ctx: Context, d: DataFrame, b: DataFrame) -> DataFrame:
    """Every detection, with or without panels, of a building that is known."""
    j = d.join(b.select("building_id", "geometry", *_BUILDING), "building_id")
    return j.select("building_id", "geometry", "has_pv", "confidence", "model_name", "detected_at", *_BUILDING)


def buildings_to_scan(b: DataFrame, done: DataFrame, box: tuple[float, float, float, float] | None = None, least_area: float | None = None, ids: list[str] | None = None, limit: int | None = None) -> DataFrame:
    """Buildings without a prediction that meet the given conditions, in order of id."""
    keep = []
    if box:
        q = geo.bbox(geo.points_of_wkt(F.col("geometry")))
        keep += [q["minx"] <= box[2], q["maxx"] >= box[0], q["miny"] <= box[3], q["maxy"] >= box[1]]
    if least_area is not None:
        keep.append(F.col("footprint_area_m2") >= least_area)
    if ids is not None:
        keep.append(F.col("building_id").isin(*ids))
    for k in keep:
        b = b.filter(k)
    b = b.join(done.select("building_id"), "building_id", "left_anti").orderBy("building_id")
    return b.limit(limit) if limit else b


def detect(tiles: DataFrame, answer, name: str, threshold: float = 0.6) -> DataFrame:
    """Predictions for (building_id, content): ``answer(list of bytes) -> list of texts`` is the model's free text."""
    @F.pandas_udf("string")
    def ask(content: pd.Series) -> pd.Series:
        return pd.Series(answer(content.tolist()))

    flag, confidence = payloads.detection(F.col("__raw"))
    out = tiles.withColumn("__raw", ask("content")).withColumn("confidence", confidence)
    return out.select("building_id", F.coalesce(flag, F.col("confidence") >= threshold).alias("has_pv"), "confidence", F.lit(name).alias("model_name"))


# --- estimates and roll-out ------------------------------------------------------------------------------------------------


def eligible_buildings(suitability: DataFrame, detections: DataFrame | None = None) -> DataFrame:
    """Candidates for an estimate: all suitable buildings, or with detections those that were seen to have no panels yet."""
    if detections is None:
        return suitability
    return suitability.join(detections.filter(~F.col("has_pv")).select("building_id").distinct(), "building_id", "left_semi")


def estimate(buildings: DataFrame, done: DataFrame | None = None) -> DataFrame:
    """Size, use and cash flow of each building with room for the least system; buildings that ``done`` holds are skipped."""
    if done is not None:
        buildings = buildings.join(done.select("building_id").distinct(), "building_id", "left_anti")
    area = F.col("footprint_area_m2")
    b = buildings.filter(area > 0).withColumn("user_type", planning.use_of_building(area, F.col("num_floors"), F.col("building_class")))
    b = b.withColumn("use_kwh", planning.yearly_use(area, F.col("user_type")))
    b = b.withColumn("kwp", planning.system_size(area, F.col("user_type"), F.col("use_kwh"))).filter(F.col("kwp") >= planning.LEAST_KWP)
    b, places = planning.cash_flow(b, "kwp", "use_kwh"), {"npv": 2, "irr": 4, "payback_simple": 1, "payback_discounted": 1, "tasso_autoconsumo": 4}
    return b.select(
        "building_id", "kwp", F.round(F.col("kwp") * planning.EUR_KWP, 2).alias("capex"), F.round(F.col("kwp") * planning.KWH_KWP, 1).alias("annual_production_kwh"),
        F.round("use_kwh", 1).alias("annual_consumption_kwh"), "user_type", F.lit("RID").alias("regime"), *(F.round(k, n).alias(k) for k, n in places.items()),
    )


_ESTIMATE = ["kwp", "capex", "annual_production_kwh", "annual_consumption_kwh", "user_type", "regime", "npv", "irr", "payback_simple", "payback_discounted", "tasso_autoconsumo"]


@model("pv_roi_estimates_raw", layer="staging", tags=("pv",))
def stg_pv_roi_estimates(ctx: Context, raw: DataFrame) -> DataFrame:
    return raw.select("building_id", *_ESTIMATE, "_sdc_extracted_at")


@model("stg_pv_roi_estimates", layer="silver", kind="merge", key=("building_id",), reads={"stg_pv_roi_estimates": Since("estimated_at", "_sdc_extracted_at", strict=True)}, tags=("pv",))
def pv_roi_estimates(ctx: Context, s: DataFrame) -> DataFrame:
    return dedup.latest(s, ["building_id"], "_sdc_extracted_at").select("building_id", *_ESTIMATE, F.col("_sdc_extracted_at").alias("estimated_at"))


@model("pv_roi_estimates", "pv_overture_buildings", kind="merge", key=("building_id",), reads={"pv_roi_estimates": Since("estimated_at", strict=True)}, tags=("pv",))
def pv_rooftop_opportunities(ctx: Context, e: DataFrame, b: DataFrame) -> DataFrame:
    j = e.join(b.select("building_id", "geometry", *_BUILDING), "building_id")
    return j.select("building_id", "geometry", *_BUILDING, *_ESTIMATE, "estimated_at", geo.wkt_feature(F.col("geometry")).alias("geom_geojson"))


@model("pv_rooftop_opportunities", kind="table", tags=("pv",))
def pv_installation_ranking(ctx: Context, o: DataFrame) -> DataFrame:
    """Roofs worth their cost, soonest paid first."""
    cols = ["building_id", "geometry", "building_class", "user_type", "footprint_area_m2", "kwp", "capex", "annual_production_kwh", "annual_consumption_kwh", "npv", "irr", "payback_simple", "tasso_autoconsumo", "geom_geojson"]
    return planning.rank_with_percentile(o.filter("npv > 0").select(*cols), F.col("payback_simple").asc_nulls_last(), F.col("irr").desc_nulls_first(), F.col("building_id").asc())


@model("pv_installation_ranking", "installation_plan_params", kind="table", tags=("pv",))
def pv_installation_plan(ctx: Context, r: DataFrame, params: DataFrame) -> DataFrame:
    made, own = F.col("annual_production_kwh"), F.col("tasso_autoconsumo")
    p = planning.roll_out(r, params).withColumns({"annual_self_consumed_kwh": made * own, "annual_grid_export_kwh": made * (1 - own)})
    return p.drop("total_buildings", "cumulative_pct")


@model("pv_installation_plan", "pv_installation_ranking", kind="table", tags=("pv",))
def pv_installation_plan_summary(ctx: Context, p: DataFrame, ranking: DataFrame) -> DataFrame:
    return planning.yearly_summary(p, ranking.agg(F.count("*").alias("total_eligible"))).orderBy("install_year")


@model("pv_overture_buildings", "gse_cabine_primarie", kind="table", tags=("pv", "community"))
def rec_building_cabina(ctx: Context, b: DataFrame, areas: DataFrame) -> DataFrame:
    """The substation areas that each building's outline meets."""
    a = areas.select("cod_ac", F.posexplode(geo.polygons_of_wkt(F.col("geometry"))).alias("part", "area_rings"))
    own = b.select("building_id", geo.rings_of_wkt(F.col("geometry")).alias("rings"))
    met = spatial.overlay(own, a, ["building_id"], ["cod_ac", "part"], "rings", "area_rings", float(ctx.var("cell_deg", 0.05)))
    return met.select("building_id", "cod_ac").distinct().join(areas.select("cod_ac", "rag_soc"), "cod_ac").select("building_id", "cod_ac", "rag_soc")


@model("rec_building_cabina", "pv_rooftop_opportunities", kind="table", tags=("pv", "community"))
def rec_cabina_opportunities(ctx: Context, m: DataFrame, o: DataFrame) -> DataFrame:
    cols = ["building_id", "user_type", "kwp", "capex", "annual_production_kwh", "annual_consumption_kwh", "npv", "irr", "payback_simple", "tasso_autoconsumo", "footprint_area_m2", "geometry", "geom_geojson"]
    return m.join(o.select(*cols), "building_id").select("cod_ac", "rag_soc", *cols)


@model("rec_cabina_opportunities", kind="table", tags=("pv", "community"))
def rec_cabina_summary(ctx: Context, o: DataFrame) -> DataFrame:
    return planning.area_summary(o, ["cod_ac", "rag_soc"])


@model("rec_building_cabina", "pv_installation_plan", kind="table", tags=("pv", "community"))
def rec_cabina_plan(ctx: Context, m: DataFrame, p: DataFrame) -> DataFrame:
    return planning.area_plan(m.join(p, "building_id"), ["cod_ac", "rag_soc"])
