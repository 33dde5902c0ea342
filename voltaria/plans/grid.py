"""Risks of the electricity grid: nearest forecast per segment, nowcasts, worst risk, trend, shapes and tiles.

Segments come as WKT lines in metres of UTM zone 32 in ``geom``, weather as cells in degrees (lat, lon).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..context import Context
from ..functions import geo, tiers
from ..operators import dedup, joins, reshape, spatial
from ..registry import Days, model
from .forecasts import heat_streaks

SEGMENT = ["date", "dso_id", "line_name", "municipality", "conductor_type", "length_m"]
#: What one row is chosen of: operators don't count.
RANKED = ["date", "line_name", "municipality", "conductor_type", "length_m"]
LINE = ["dso_id", "line_name", "conductor_type", "parent_substation_name", "operational_unit", "feeder_id", "municipality", "length_m"]
TREES = ["is_vegetated_zone", "elevation_start_m", "elevation_end_m", "strike_tree_tier", "strike_tree_multiplier", "strike_density_per_km"]
#: What heat tiers are called as risks (fixed values).
HEAT_LEVELS = {"RED": "ALERT", "ORANGE": "WARNING", "GREEN": "NORMAL"}
LEVELS = ["ALERT", "WARNING"]
#: Metres of a tile's side; shares of the network at risk above which a day is an alert or a warning (fixed values).
#: Metres of a cell in which fragments of a line are compared.
CELL = 500.0
TILE, SHARE_ALERT, SHARE_WARNING = 5000, 0.65, 0.35


def _nearest(lines: DataFrame, cells: DataFrame, metres: float, by: list[str]) -> DataFrame:
    """Each segment with each of its cells' days within ``metres`` of the whole line, and of each group ``by`` the nearest;
    segments without a cell are kept, with nulls."""
    s = lines.withColumn("__seg", geo.line_segments(F.col("geom")))
    u = geo.to_utm(F.col("lat"), F.col("lon"))
    p = cells.withColumn("__u", u).withColumns({"__x": F.col("__u.x"), "__y": F.col("__u.y")}).drop("__u")
    met = spatial.near_lines(s.filter(F.size("__seg") > 0).select(*lines.columns, "__seg"), p, "__seg", ("__x", "__y"), metres, metres)
    met = met.drop("__seg", "__x", "__y")
    lost = lines.join(met.select(*LINE, "geom").distinct(), [lines[c].eqNullSafe(met[c]) for c in (*LINE, "geom")], "left_anti")
    return dedup.distinct_on(met.unionByName(lost, allowMissingColumns=True), by, F.col("distance").asc_nulls_last(), F.col("lat"), F.col("lon"))


def _ahead(ctx: Context, df: DataFrame) -> DataFrame:
    """Today and the two days after, or from the day asked for."""
    today = F.lit(ctx.as_of.date())
    start = F.to_date(F.lit(ctx.var("start_date"))) if ctx.var("start_date") else today
    return df.filter(F.col("date").between(start, F.date_add(today, 2)))


@model("silver_grid_ac_line_segment", "om_heat_risk", kind="merge", key=tuple(SEGMENT), tags=("grid", "heat"))
def grid_heat_risks(ctx: Context, segments: DataFrame, heat: DataFrame) -> DataFrame:
    h = _ahead(ctx, heat).select("date", "lat", "lon", "heat_risk_tier", "temp_max_c", "p90_threshold", "consecutive_heat_days", "elevation_m", "altitude_band", "forecast_model")
    j = _nearest(segments.filter("conductor_type = 'underground_cable'").select(*LINE, "geom"), h, 5000, RANKED)
    names = F.create_map(*(F.lit(x) for kv in HEAT_LEVELS.items() for x in kv))
    j = j.withColumn("risk_level", F.coalesce(F.element_at(names, F.col("heat_risk_tier")), F.col("heat_risk_tier")))
    return j.select(*LINE, "date", "risk_level", "temp_max_c", "p90_threshold", "consecutive_heat_days", "elevation_m", "altitude_band", "forecast_model", tiers.risk_color(F.col("risk_level")).alias("risk_color_hex"))


def _escalated(df: DataFrame, level: Column) -> DataFrame:
    """A warning where trees that may strike are tall is an alert."""
    tall = F.coalesce((level == "WARNING") & (F.col("strike_tree_tier") == "high"), F.lit(False))
    df = df.withColumn("risk_level", F.when(tall, "ALERT").otherwise(level)).withColumn("escalated_by_tree_strike", tall)
    return df.withColumn("risk_color_hex", tiers.risk_color(F.col("risk_level")))


@model("silver_grid_ac_line_segment", "om_wind_gusts", kind="merge", key=tuple(SEGMENT), tags=("grid", "wind"))
def grid_wind_risks(ctx: Context, segments: DataFrame, wind: DataFrame) -> DataFrame:
    g = _ahead(ctx, wind).select("date", "lat", "lon", "gust_excess_tier", "gust_excess", "wind_speed_max", "wind_gusts_max")
    j = _nearest(segments.filter("conductor_type <> 'underground_cable'").select(*LINE, *TREES, "geom"), g, 5000, RANKED)
    return _escalated(j, F.col("gust_excess_tier")).select(*LINE, *TREES, "date", "risk_level", "escalated_by_tree_strike", "gust_excess", "wind_speed_max", "wind_gusts_max", "risk_color_hex")


@model("silver_grid_ac_line_segment", "mt_heat_daily_obs", kind="table", key=tuple(SEGMENT), tags=("grid", "heat"))
def grid_heat_risks_now(ctx: Context, segments: DataFrame, obs: DataFrame) -> DataFrame:
    """Today's heat from observations; segments at risk only."""
    week = obs.filter(F.col("date") >= F.date_sub(F.lit(ctx.as_of.date()), 7))
    today = heat_streaks(week).filter(F.col("date") == F.lit(ctx.as_of.date()))
    level = F.when(~F.col("is_heat_stress"), "NORMAL").when(F.col("consecutive_heat_days") >= 3, "ALERT").otherwise("WARNING")
    h = today.select("date", "lat", "lon", level.alias("risk_level"), "temp_max_c", "p90_threshold", "consecutive_heat_days", "elevation_m", "altitude_band", F.col("latest_obs").alias("observed_at"))
    j = _nearest(segments.filter("conductor_type = 'underground_cable'").select(*LINE, "geom"), h, 15_000, RANKED[1:]).filter("risk_level <> 'NORMAL'")
    return j.select(*LINE, "date", "risk_level", "temp_max_c", "p90_threshold", "consecutive_heat_days", "elevation_m", "altitude_band", tiers.risk_color(F.col("risk_level")).alias("risk_color_hex"), "observed_at")


@model("silver_grid_ac_line_segment", "om_obs_15min", kind="table", key=tuple(SEGMENT), tags=("grid", "wind"))
def grid_wind_risks_now(ctx: Context, segments: DataFrame, obs: DataFrame) -> DataFrame:
    """The last three hours' newest observation of each cell; segments at risk only."""
    recent = dedup.latest(obs.filter(F.col("datetime") >= ctx.now() - F.expr("INTERVAL 3 HOURS")), ["lat", "lon"], "datetime")
    o = recent.select("lat", "lon", F.col("datetime").alias("observed_at"), F.col("wind_speed_ms").alias("wind_speed_max"), F.col("wind_gusts_ms").alias("wind_gusts_max"))
    j = _nearest(segments.filter("conductor_type <> 'underground_cable'").select(*LINE, *TREES, "geom"), o, 5000, RANKED[1:])
    out = _escalated(j, tiers.wind_level(F.col("wind_gusts_max"), F.col("wind_speed_max"))).filter("risk_level <> 'NORMAL'")
    return out.select(*LINE, *TREES, F.lit(ctx.as_of.date()).alias("date"), "risk_level", "escalated_by_tree_strike", (F.col("wind_gusts_max") - F.col("wind_speed_max")).alias("gust_excess"), "wind_speed_max", "wind_gusts_max", "risk_color_hex", "observed_at")


def segment_id(asset: str = "ac_line_segment", *parts: str) -> Column:
    """MD5 of the asset's key; null if a part is null."""
    cols = [F.col(c) for c in (parts or ("line_name", "conductor_type", "municipality"))]
    joined: list[Column] = [F.col("dso_id"), F.lit(asset), *cols]
    return F.md5(F.concat(*(x for k, c in enumerate(joined) for x in ([F.lit("|")] * (k > 0) + [c.cast("string")]))))


def _worst(df: DataFrame, vector: str, metric: str, fields: list[str], *more: str) -> DataFrame:
    at_risk = df.filter(F.col("risk_level").isin(*LEVELS)).withColumn("segment_id", segment_id())
    w = spatial.worst(at_risk, ["segment_id", "date"], "risk_level", metric, LEVELS)
    return w.select("segment_id", "date", F.lit(vector).alias("risk_vector"), "risk_level", "risk_color_hex", reshape.json_object(**{f: F.col(f) for f in fields}).alias("metrics"), *more)


WIND_METRICS = ["gust_excess", "wind_speed_max", "wind_gusts_max", "strike_tree_tier", "strike_tree_multiplier", "strike_density_per_km", "escalated_by_tree_strike"]
HEAT_METRICS = ["temp_max_c", "p90_threshold", "consecutive_heat_days", "altitude_band"]


@model("grid_wind_risks", "grid_heat_risks", kind="range", replaced=lambda ctx: F.col("date") >= ctx.today(), reads={"grid_wind_risks": Days("date"), "grid_heat_risks": Days("date")}, tags=("grid",))
def grid_risks(ctx: Context, wind: DataFrame, heat: DataFrame) -> DataFrame:
    """Warnings and alerts alone, the worst of each segment's fragments."""
    return reshape.pad_union(_worst(wind, "wind", "gust_excess", WIND_METRICS), _worst(heat, "heat", "temp_max_c", [*HEAT_METRICS, "forecast_model"]))


@model("grid_wind_risks_now", "grid_heat_risks_now", kind="table", tags=("grid",))
def grid_risks_now(ctx: Context, wind: DataFrame, heat: DataFrame) -> DataFrame:
    return reshape.pad_union(_worst(wind, "wind", "gust_excess", WIND_METRICS, "observed_at"), _worst(heat, "heat", "temp_max_c", HEAT_METRICS, "observed_at"))


@model("grid_risks", "grid_shapes", kind="range", replaced=lambda ctx: F.col("date") >= ctx.today(), reads={"grid_risks": Days("date")}, tags=("grid",))
def grid_risks_trendline(ctx: Context, risks: DataFrame, shapes: DataFrame) -> DataFrame:
    """Per day and vector: the share at risk of the segments that the vector concerns (bare and insulated overhead lines for
    wind, underground cables for heat)."""
    lines = shapes.filter("asset_type = 'ac_line_segment'")
    totals = lines.agg(F.count_if(F.col("conductor_type").isin("overhead_bare", "overhead_insulated")).alias("wind_total"), F.count_if(F.col("conductor_type") == "underground_cable").alias("heat_total"))
    d = risks.groupBy("date", "risk_vector").agg(F.count_if(F.col("risk_level") == "ALERT").alias("alert_count"), F.count_if(F.col("risk_level") == "WARNING").alias("warning_count"))
    j = joins.with_scalars(d, totals).withColumn("total_segments", F.when(F.col("risk_vector") == "wind", F.col("wind_total")).otherwise(F.col("heat_total")))
    ratio = (F.col("alert_count") + F.col("warning_count")) / F.nullif("total_segments", F.lit(0))
    level = F.when(ratio > SHARE_ALERT, "ALERT").when(ratio > SHARE_WARNING, "WARNING").otherwise("NORMAL")
    return j.select("date", "risk_vector", "alert_count", "warning_count", "total_segments", F.round(ratio, 4).alias("risk_ratio"), level.alias("day_risk_level"))


@model("silver_grid_ac_line_segment", "silver_grid_substation", kind="table", tags=("grid",))
def grid_shapes(ctx: Context, segments: DataFrame, substations: DataFrame) -> DataFrame:
    """One shape per line, conductor type and municipality (the union of its fragments, cut where they meet and without what
    runs twice), and substations as points. ``feature_geojson`` carries the geometry in degrees."""
    key = ["dso_id", "line_name", "conductor_type", "municipality"]
    has = lambda t: F.bool_or(F.coalesce(F.col("strike_tree_tier") == t, F.lit(False)))
    tier = F.when(has("high"), "high").when(has("mid"), "mid").when(has("low"), "low")
    g = segments.groupBy(*key).agg(
        F.min("operational_unit").alias("operational_unit"), F.min("parent_substation_name").alias("parent_substation_name"), F.min("feeder_id").alias("feeder_id"), F.sum("length_m").alias("length_m"),
        F.bool_or("is_vegetated_zone").alias("is_vegetated_zone"), tier.alias("strike_tree_tier"), F.max("strike_tree_multiplier").alias("strike_tree_multiplier"), F.max("strike_density_per_km").alias("strike_density_per_km"),
    )
    merged = spatial.line_union(segments, key, "geom", CELL).groupBy(*key).agg(spatial.multiline(F.collect_list("part")).alias("geom"))
    same = F.lit(True)
    for k in key:
        same = same & F.col(f"g.{k}").eqNullSafe(F.col(f"m.{k}"))
    g = g.alias("g").join(merged.alias("m"), same, "left").select("g.*", "m.geom")
    g = g.withColumns({"segment_id": segment_id(), "asset_type": F.lit("ac_line_segment"), "asset_key": F.col("line_name")})
    props = ["segment_id", "asset_type", "line_name", "conductor_type", "parent_substation_name", "operational_unit", "municipality", "strike_tree_tier", "strike_tree_multiplier", "strike_density_per_km"]
    g = g.withColumn("feature_geojson", geo.feature(geo.utm_geojson(F.col("geom")), extraProps=F.struct(*props)))
    s = substations.withColumns({"segment_id": segment_id("substation", "asset_id"), "asset_type": F.lit("substation"), "asset_key": F.col("asset_id")})
    label = F.concat(F.coalesce("label", F.lit("")), F.lit(" \u2014 "), F.col("municipality")).alias("label")
    own = F.struct("segment_id", "asset_type", "asset_id", "name", label, "line_name", "parent_substation_name", "operational_unit", "municipality")
    s = s.withColumn("feature_geojson", geo.feature(geo.utm_geojson(F.col("geom")), iconColor=F.lit("#1E88E5"), iconSize=F.lit(8), extraProps=own)).drop("asset_id")
    out = "segment_id dso_id asset_type asset_key line_name operational_unit municipality conductor_type parent_substation_name feeder_id length_m is_vegetated_zone strike_tree_tier strike_tree_multiplier strike_density_per_km voltage_class label label_id name geom feature_geojson"
    return reshape.pad_union(g, s).select(*out.split())


@model("silver_grid_substation", kind="table", tags=("grid",))
def grid_substations(ctx: Context, s: DataFrame) -> DataFrame:
    at = geo.points_of_wkt(F.col("geom"))[0]
    label = F.concat(F.coalesce("label", F.lit("")), F.lit(" \u2014 "), F.col("municipality")).alias("label")
    own = F.struct(label, "asset_id", "name", "municipality", F.col("parent_substation_name").alias("substation_name"), "line_name")
    cols = ["dso_id", "asset_id", "name", "label_id", "label", "line_name", "feeder_id", "parent_substation_name", "operational_unit", "municipality", "geom"]
    u = geo.let(at, lambda p: geo.from_utm(p["x"], p["y"]))
    out = s.select(*cols, u.alias("__u"), geo.feature(geo.utm_geojson(F.col("geom")), iconColor=F.lit("#1E88E5"), iconSize=F.lit(8), extraProps=own).alias("feature_geojson"))
    return out.select(*cols, F.col("__u.lon").alias("longitude"), F.col("__u.lat").alias("latitude"), "feature_geojson")


@model("silver_grid_ac_line_segment", kind="table", tags=("grid",))
def grid_network_topology(ctx: Context, s: DataFrame) -> DataFrame:
    return s.select("dso_id", "line_name", "parent_substation_name", "operational_unit", "municipality", "conductor_type").distinct().orderBy("parent_substation_name", "line_name")


@model("grid_shapes", kind="table", tags=("grid",))
def grid_tiles(ctx: Context, shapes: DataFrame) -> DataFrame:
    """Tiles of 5 km, numbered from the south-west corner of all shapes, with the segments that meet them."""
    size = float(TILE)
    s = shapes.select("segment_id", geo.line_segments(F.col("geom")).alias("__seg")).filter(F.size("__seg") > 0)
    s = s.withColumn("__b", geo.bbox(F.flatten(F.transform("__seg", lambda e: F.array(e["p"], e["q"])))))
    whole = s.agg(*((F.floor(F.min(f"__b.min{a}") / size) * TILE).cast("long").alias(f"__{a}0") for a in "xy"), *((F.ceil(F.max(f"__b.max{a}") / size) * TILE).cast("long").alias(f"__{a}1") for a in "xy"))
    s = joins.with_scalars(s, whole)

    def numbers(a: str) -> Column:
        """Tiles that the box touches, edges included, of those in the whole."""
        first = F.greatest(F.ceil((F.col(f"__b.min{a}") - F.col(f"__{a}0")) / size).cast("long") - 1, F.lit(0))
        last = F.least(F.floor((F.col(f"__b.max{a}") - F.col(f"__{a}0")) / size).cast("long"), ((F.col(f"__{a}1") - F.col(f"__{a}0")) / size).cast("long") - 1)
        return F.when(first <= last, F.sequence(first, last))

    t = s.select("segment_id", "__seg", "__x0", "__y0", numbers("x").alias("__xs"), numbers("y").alias("__ys"))
    t = t.withColumn("__at", F.explode(F.flatten(F.transform("__xs", lambda i: F.transform("__ys", lambda j: F.struct(i.alias("i"), j.alias("j")))))))
    t = t.withColumns({"tile_x": F.col("__at.i"), "tile_y": F.col("__at.j")})
    x, y = F.col("__x0") + F.col("tile_x") * TILE, F.col("__y0") + F.col("tile_y") * TILE
    corner = lambda i, j: F.struct((x + i * TILE).cast("double").alias("x"), (y + j * TILE).cast("double").alias("y"))
    ring = F.array(corner(0, 0), corner(0, 1), corner(1, 1), corner(1, 0), corner(0, 0))
    at = lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))
    t = t.withColumn("__ring", ring)
    edges = geo.edges_of(F.array("__ring"))
    first = F.col("__seg")[0]["p"]
    inside = (first["x"] >= x) & (first["x"] <= x + TILE) & (first["y"] >= y) & (first["y"] <= y + TILE)
    hit = inside | geo.let(edges, lambda es: F.exists("__seg", lambda e: F.exists(es, lambda g: geo.edges_cross(e, g))))
    wkt = F.concat(F.lit("POLYGON (("), F.array_join(F.transform("__ring", at), ", "), F.lit("))"))
    name = F.concat(F.lit("tile_"), F.col("tile_x").cast("string"), F.lit("_"), F.col("tile_y").cast("string"))
    return t.filter(hit).select(name.alias("tile_id"), F.col("tile_x").cast("int").alias("tile_x"), F.col("tile_y").cast("int").alias("tile_y"), "segment_id", geo.utm_geojson(wkt).alias("tile_bbox_geojson"))


@model("grid_tiles", tags=("grid",))
def grid_tile_index(ctx: Context, tiles: DataFrame) -> DataFrame:
    return tiles.groupBy("tile_id", "tile_x", "tile_y", "tile_bbox_geojson").agg(F.count("*").alias("segment_count")).orderBy("tile_y", "tile_x")


@model("grid_risks", "grid_shapes", tags=("grid",))
def v_superset_grid(ctx: Context, risks: DataFrame, shapes: DataFrame) -> DataFrame:
    return risks.filter(F.col("date") >= F.lit(ctx.as_of.date())).join(shapes, "segment_id")
