"""Community, weather, grid and rooftop models on small tables; the registry's selection and order."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

import voltaria.plans  # noqa: F401
from voltaria.context import Context
from voltaria.plans import community, forecasts, grid, rooftops, weather
from voltaria.registry import MODELS, apply_row_filter

NOW = dt.datetime(2026, 7, 10, 12)


@pytest.fixture
def ctx(spark, tmp_path):
    return Context(spark, str(tmp_path), NOW)


def df(ctx, schema, *rows):
    return ctx.spark.createDataFrame(list(rows), schema)


def test_every_model_is_registered_in_an_order():
    order = MODELS.order()
    assert len(MODELS.models) == 156
    assert order.index("grid_risks") > order.index("grid_wind_risks") > order.index("om_wind_gusts")
    assert "om_wind_gusts" in MODELS.select("tag:wind,tag:om") and "om_heat_risk" not in MODELS.select("tag:wind,tag:om")
    assert set(MODELS.select("+om_wind_gusts")) == {"stg_om_wind", "om_wind_hourly", "om_wind_gusts"}


def test_netting_and_shares(ctx):
    m = df(ctx, "device_id string, ts timestamp_ntz, consumption_kwh double, production_kwh double", ("a", NOW, 1.0, 9.0), ("b", NOW, 3.0, 2.0), ("x", NOW, 5.0, 5.0))
    m = m.selectExpr("*", "concat(device_id, ts) _id", "0.0D self_consumed_kwh")
    r = df(ctx, "sensor_id string, user_id string, rec_id string, role string, substation_id string", ("a", "u1", "r", "consumer", "s"), ("b", "u2", "r", "prosumer", "s"))
    v = community.rec_virtual_consumption_15m(ctx, m, r)
    row = v.first()
    assert (row.total_consumption_kwh, row.total_production_kwh, row.self_consumption_kwh, row.self_consumption_ratio) == (4.0, 2.0, 2.0, 1.0)
    per = {x.device_id: x.virtual_consumption_kwh for x in community.rec_virtual_consumption_per_device_15m(ctx, m, r, v).collect()}
    assert per == {"a": 0.5, "b": 1.5}
    assert community.rec_measurements_15m(ctx, v).count() == 4
    assert apply_row_filter(m, "device_id", df(ctx, "d string", ("a",))).count() == 1


def test_missing_slots(ctx):
    end = NOW
    have = [("a", end - dt.timedelta(minutes=15 * k)) for k in range(1, 5) if k != 3]
    ctx.vars["gap_hours"] = 1
    got = community.meters_data_15m_missing_intervals(ctx, df(ctx, "device_id string, ts timestamp_ntz", *have)).collect()
    assert sorted((r.ts, r.hour) for r in got) == [(end - dt.timedelta(minutes=45), 13), (end, 14)] and got[0].created_at == NOW


def test_nearest_source_by_distance_height_and_id(ctx):
    places = df(ctx, "location_id string, provider string, lat double, lon double, elevation_m int", ("p", "x", 46.0, 11.0, 1000), ("far", "x", 50.0, 11.0, 0))
    src = df(ctx, "station_id string, lat double, lon double, elevation_m int, temperature_c double", ("s1", 46.05, 11.0, 900, 1.0), ("s2", 46.05, 11.0, 990, 2.0), ("s3", 46.2, 11.0, 1000, 3.0), ("s0", 46.05, 11.0, None, 4.0))
    src = src.selectExpr("*", "'x' provider", "station_id station_name", "now() observed_at", *(f"CAST(NULL AS DOUBLE) {c}" for c in ("humidity_pct", "wind_speed_ms", "wind_direction_deg", "wind_gust_ms", "precipitation_mm", "cloud_cover_pct", "sky_condition", "pressure_hpa")))
    got = weather.weather_current(ctx, src, places).collect()
    assert [(r.location_id, r.station_id) for r in got] == [("p", "s2")]


def test_regional_alerts_go_to_the_providers_places(ctx):
    places = df(ctx, "location_id string, provider string", ("p", "mt"), ("q", "owm"))
    a = df(ctx, "location_id string, provider string, alert_id string", (None, "mt", "1"), ("z", "owm", "2"))
    a = a.selectExpr("*", *(f"CAST(NULL AS STRING) {c}" for c in ("event", "severity", "urgency", "headline", "description", "starts_at", "expires_at", "source_name", "area_desc")))
    assert {(r.location_id, r.alert_id) for r in weather.stg_weather_alerts(ctx, a, places).collect()} == {("p", "1"), ("z", "2")}


def test_nested_forecasts(ctx):
    hourly = json.dumps([{"dt": 1767225600, "temp": 1.5, "weather": [{"main": "Snow"}]}, {"dt": 1767229200, "temp": 2.5, "weather": []}])
    s = df(ctx, "synced_at timestamp, lat double, lon double, location_id string, hourly string, daily string, current string, alerts string, minutely string", (NOW, 46.0, 11.0, "Folgaria", hourly, None, json.dumps({"dt": 1767225600, "temp": 3.0, "sunrise": 1767254400, "weather": [{"main": "Rain", "description": "light rain"}]}), None, None))
    s = s.selectExpr("*", "'Europe/Rome' timezone", "3600 timezone_offset")
    got = sorted(weather.payloads.weather_hourly(s).collect(), key=lambda r: r.ts)
    assert [(r.temp, r.weather_main) for r in got] == [(1.5, "Snow"), (2.5, None)]
    assert weather.payloads.weather_daily(s).count() == 0 and weather.payloads.weather_alerts(s).count() == 0
    now = weather.payloads.weather_current(s).first()
    assert (now.weather_main, now.weather_description, now.timezone, now.sunrise, now.dt_lat_lon) == ("Rain", "light rain", "Europe/Rome", dt.datetime(2026, 1, 1, 8), "1767225600_46.0_11.0")
    assert weather.place_rows(weather.payloads.weather_hourly(s), "FOLGARIA", ["dt_lat_lon"], "ts").count() == 2


def test_accumulated_forecasts_become_hourly(ctx):
    run = dt.datetime(2026, 7, 10, 0)
    at = lambda h: run + dt.timedelta(hours=h)
    rows = [(run, at(h - 1), at(h), 46.0, 11.0, n, v, at(0)) for n, vs in {"avg_snswrf": (100.0, 150.0), "tp": (1.0, 3.5), "2t": (273.15, 283.15), "CLCT": (10.4, 90.0)}.items() for h, v in enumerate(vs, 1)]
    rows.append((run, at(0), at(1), 46.0, 11.0, "tp", 9.0, at(-1)))
    raw = df(ctx, "run_datetime timestamp, interval_start_datetime timestamp, interval_end_datetime timestamp, lat double, lon double, name string, value double, _sdc_last_modified timestamp", *rows)
    gold = forecasts.dwd_icon_d2_gold(ctx, forecasts.dwd_icon_d2_silver(ctx, raw))
    got = [(r.temperature_2m, r.shortwave_radiation, r.cloud_cover, r.precipitation) for r in gold.orderBy("forecast_hour").collect()]
    assert got == [(0.0, 100.0, 10.0, 1.0), (10.0, 200.0, 90.0, 2.5)]


def test_heat_waves(ctx):
    temps = [28, 28, 28, 20, 28]
    d = df(ctx, "date date, lat double, lon double, elevation_m double, altitude_band string, temp_max_c double", *((dt.date(2026, 7, 1) + dt.timedelta(days=k), 46.0, 11.0, 300.0, "low", float(t)) for k, t in enumerate(temps)))
    got = [(r.consecutive_heat_days, r.heat_risk_tier) for r in forecasts.om_heat_risk(ctx, d).orderBy("date").collect()]
    assert got == [(1, "ORANGE"), (2, "ORANGE"), (3, "RED"), (0, "GREEN"), (1, "ORANGE")]
    winter = d.withColumn("date", F.add_months("date", 6))
    assert {r.heat_risk_tier for r in forecasts.om_heat_risk(ctx, winter).collect()} == {"GREEN"}


def test_solar_rows_take_the_temperature_of_half_a_day(ctx):
    solar = df(ctx, "datetime_utc timestamp, ghi double, ghi_clearness_index double", (NOW, 100.0, 0.5), (NOW + dt.timedelta(hours=20), 0.0, None))
    era5 = df(ctx, "datetime_utc timestamp, variable_name string, value double", (NOW - dt.timedelta(hours=11), "2t", 283.15), (NOW - dt.timedelta(hours=2), "2t", 293.15))
    got = forecasts.copernicus_weather_features(ctx, solar, era5).orderBy("datetime").collect()
    assert got[0].temperature_2m == pytest.approx(20.0) and got[0].heating_degree == 0 and got[1].temperature_2m is None and got[1].heating_degree is None


def segments(ctx):
    """Lines whose middle is far from the cell at (46, 11) while an end is near, one cable near it and one lost line."""
    cols = "dso_id string, line_name string, municipality string, conductor_type string, length_m double, operational_unit string, parent_substation_name string, feeder_id string, is_vegetated_zone boolean, elevation_start_m double, elevation_end_m double, strike_tree_tier string, strike_tree_multiplier double, strike_density_per_km double, geom string"
    row = lambda n, kind, tier, x, y, far=10: ("d", n, "m", kind, 10.0, "o", "p", "f", True, 1.0, 2.0, tier, 1.5, 0.5, f"LINESTRING ({x} {y}, {x + far} {y})")
    u = ctx.spark.range(1).select(grid.geo.to_utm(F.lit(46.0), F.lit(11.0)).alias("u")).first().u
    return df(ctx, cols, row("near", "overhead_bare", "high", u.x + 100, u.y, 30_000), row("tall", "overhead_bare", "very_high", u.x + 100, u.y), row("cable", "underground_cable", None, u.x, u.y + 50), row("lost", "overhead_insulated", None, u.x + 90_000, u.y))


def test_risks_of_segments(ctx):
    s = segments(ctx)
    wind = df(ctx, "date date, lat double, lon double, gust_excess_tier string, gust_excess double, wind_speed_max double, wind_gusts_max double", (NOW.date(), 46.0, 11.0, "WARNING", 9.0, 9.0, 18.0), (NOW.date(), 46.03, 11.0, "ALERT", 29.0, 1.0, 30.0), (NOW.date() + dt.timedelta(days=3), 46.0, 11.0, "ALERT", 29.0, 1.0, 30.0))
    w = grid.grid_wind_risks(ctx, s, wind)
    got = {r.line_name: r for r in w.collect()}
    assert len(got) == w.count() == 3 and got["near"].risk_level == "ALERT" and got["near"].escalated_by_tree_strike and got["near"].gust_excess == 9.0
    assert got["tall"].risk_level == "WARNING" and not got["tall"].escalated_by_tree_strike and got["tall"].risk_color_hex == "#F7D000"
    assert got["lost"].risk_level is None and got["lost"].date is None and got["lost"].risk_color_hex == "#808080"
    heat = df(ctx, "date date, lat double, lon double, heat_risk_tier string, temp_max_c double, p90_threshold double, consecutive_heat_days bigint, elevation_m double, altitude_band string, forecast_model string", (NOW.date(), 46.0, 11.0, "ORANGE", 28.0, 27.0, 1, 400.0, "low", "x"))
    h = grid.grid_heat_risks(ctx, s, heat)
    assert [(r.line_name, r.risk_level, r.forecast_model) for r in h.collect()] == [("cable", "WARNING", "x")]
    risks = grid.grid_risks(ctx, w, h)
    assert risks.count() == 3 and json.loads(risks.filter("risk_vector = 'heat'").first().metrics)["temp_max_c"] == 28.0
    subs = "dso_id string, asset_id string, name string, label_id string, label string, line_name string, feeder_id string, parent_substation_name string, operational_unit string, municipality string, voltage_class string, geom string"
    shapes = grid.grid_shapes(ctx, s.union(s.filter("line_name = 'near'").withColumn("geom", F.lit("MULTILINESTRING ((1 1, 2 2), (3 3, 4 4))"))), df(ctx, subs, ("d", "a1", "sub", None, None, "near", "f", "p", "o", "m", "MT", "POINT (655000 5096000)")))
    rows = {r.asset_key: r for r in shapes.collect()}
    assert len(rows) == 5 and rows["near"].length_m == 20.0 and rows["near"].geom.count("(") == 4 and rows["a1"].asset_type == "substation"
    assert json.loads(rows["a1"].feature_geojson)["geometry"]["type"] == "Point" and json.loads(rows["tall"].feature_geojson)["geometry"]["coordinates"][0][1] == pytest.approx(46.0, abs=1e-3)
    t = {r.risk_vector: (r.alert_count, r.warning_count, r.total_segments, r.risk_ratio, r.day_risk_level) for r in grid.grid_risks_trendline(ctx, risks, shapes).collect()}
    assert t == {"wind": (1, 1, 3, 0.6667, "ALERT"), "heat": (0, 1, 1, 1.0, "ALERT")}
    assert grid.v_superset_grid(ctx, risks, shapes).count() == 3 and grid.grid_network_topology(ctx, s).count() == 4
    line = df(ctx, "segment_id string, geom string", ("a", "LINESTRING (1000 1000, 9000 9000)"), ("b", "LINESTRING (1000 8000, 2000 9000)"), ("c", "LINESTRING (12000 12000, 12000 14000)"))
    tiles = {(r.tile_id, r.segment_id) for r in grid.grid_tiles(ctx, line).collect()}
    assert {x for x in tiles if x[1] != "a"} == {("tile_0_1", "b"), ("tile_2_2", "c")} and {("tile_0_0", "a"), ("tile_1_1", "a")} <= {x for x in tiles}
    assert [(r.tile_x, r.tile_y) for r in grid.grid_tile_index(ctx, grid.grid_tiles(ctx, line)).collect()][0] == (0, 0)


def test_nowcast_keeps_risks_only(ctx):
    obs = df(ctx, "datetime timestamp_ntz, lat double, lon double, wind_gusts_ms double, wind_speed_ms double", (NOW - dt.timedelta(hours=1), 46.0, 11.0, 25.0, 5.0), (NOW - dt.timedelta(hours=2), 46.0, 11.0, 5.0, 5.0), (NOW - dt.timedelta(hours=9), 46.0, 12.0, 90.0, 5.0))
    assert sorted((r.line_name, r.risk_level, r.gust_excess) for r in grid.grid_wind_risks_now(ctx, segments(ctx), obs).collect()) == [("near", "ALERT", 20.0), ("tall", "ALERT", 20.0)]


def square(x, y, size):
    return f"POLYGON (({x} {y}, {x + size} {y}, {x + size} {y + size}, {x} {y + size}, {x} {y}))"


def test_suitability_and_plan(ctx):
    props = json.dumps({"class": "commercial", "num_floors": 1})
    raw = df(ctx, "geometry string, features string, _sdc_extracted_at timestamp", *((square(11 + k * 0.01, 46.0, 0.0005), props, NOW) for k in range(4)))
    b = rooftops.pv_overture_buildings(ctx, rooftops.stg_overture_buildings(ctx, raw))
    area = b.first().footprint_area_m2
    assert area == pytest.approx(2154.4, rel=2e-3)  # 55.6 m by 38.7 m
    gj = lambda *boxes: json.dumps({"type": "MultiPolygon", "coordinates": [[[[x, y], [x + w, y], [x + w, y + h], [x, y + h], [x, y]]] for x, y, w, h in boxes]})
    areas = lambda *boxes: df(ctx, "id string, geometry string", ("1", gj(*boxes))).select("id", rooftops.geo.polygons_of_geojson(F.col("geometry")).alias("polygons"))
    none = areas()
    # the second part holds the first building; a narrow strip crosses the second without a corner in it
    hit, strip = areas((20, 20, 1, 1), (10.999, 45.999, 0.005, 0.005)), areas((11.0102, 45.9, 0.0001, 0.2))
    assert rooftops.pv_building_suitability(ctx, b, hit, strip, none).count() == 2
    ok = rooftops.pv_building_suitability(ctx, b, hit, none, none)
    assert ok.count() == 3 and json.loads(ok.first().geom_geojson)["geometry"]["type"] == "Polygon"
    seen = df(ctx, "building_id string, has_pv boolean", (ok.first().building_id, True))
    assert rooftops.eligible_buildings(ok).count() == 3 and rooftops.eligible_buildings(ok, seen).count() == 0 and rooftops.estimate(ok, seen).count() == 2
    e = rooftops.estimate(ok)
    assert {r.user_type for r in e.collect()} == {"commercial"} and e.first().kwp == 20.0 and e.first().capex == 30_000 and 0 < e.first().irr < 1
    o = rooftops.pv_rooftop_opportunities(ctx, e.withColumn("estimated_at", F.lit(NOW)), b)
    assert o.columns[:3] == ["building_id", "geometry", "building_class"]
    r = rooftops.pv_installation_ranking(ctx, o.withColumn("npv", F.when(F.col("building_id") == ok.first().building_id, -1.0).otherwise(F.col("npv"))))
    assert sorted((x["rank"], x.cumulative_pct) for x in r.collect()) == [(1, 50.0), (2, 100.0)]
    params = df(ctx, "year int, cumulative_adoption_pct double, degradation_rate double", (1, 50.0, 0.0045), (2, 100.0, 0.0045))
    plan = rooftops.pv_installation_plan(ctx, r, params)
    s = {x.install_year: (x.new_buildings, x.cum_buildings, x.coverage_pct, x.cum_investment_eur, x.cum_annual_production_mwh, x.total_eligible) for x in rooftops.pv_installation_plan_summary(ctx, plan, r).collect()}
    assert s == {1: (1, 1, 50.0, 30_000.0, 22.0, 2), 2: (1, 2, 100.0, 60_000.0, 43.9, 2)}
    hole = "POLYGON ((10.5 45.5, 11.5 45.5, 11.5 46.5, 10.5 46.5, 10.5 45.5), (11.019 45.99, 11.025 45.99, 11.025 46.01, 11.019 46.01, 11.019 45.99))"
    cab = rooftops.rec_building_cabina(ctx, b, df(ctx, "cod_ac string, rag_soc string, geometry string", ("A", "x", hole), ("B", "y", "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((11.0 46.0, 11.001 46.0, 11.001 46.001, 11.0 46.0)))")))
    assert sorted(x.cod_ac for x in cab.collect()) == ["A", "A", "A", "B"]  # one building lies in the hole
    q = rooftops.rec_cabina_summary(ctx, rooftops.rec_cabina_opportunities(ctx, cab, o)).filter("cod_ac = 'A'").first()
    assert (q.buildings, q.commercial_buildings, q.rag_soc, q.total_kwp, q.total_production_mwh) == (2, 2, "x", 40.0, 44.0)
    assert rooftops.rec_cabina_plan(ctx, cab, plan).agg(F.max("cum_buildings")).first()[0] >= 1


def test_detections(ctx):
    tiles = df(ctx, "building_id string, content binary", ("a", b"1"), ("b", b"2"), ("c", b"3"))
    says = {b"1": 'I see {"has_pv": true, "confidence": 1.7}', b"2": "no panels, Confidence: 0.2", b"3": "unclear, confidence 0.9"}
    got = {r.building_id: (r.has_pv, r.confidence) for r in rooftops.detect(tiles, lambda xs: [says[bytes(x)] for x in xs], "stub").collect()}
    assert got == {"a": (True, 1.0), "b": (False, 0.2), "c": (True, 0.9)}


def test_map_themes(ctx):
    raw = df(ctx, "osm_id bigint, geometry string, features string, _sdc_extracted_at timestamp", (1, "POINT (1 2)", json.dumps({"amenity": "parking"}), NOW), (2, "POINT (1 2)", json.dumps({"piste:type": "downhill"}), NOW), (3, "POINT (1 2)", "{}", NOW)).withColumn("element", F.lit("node"))
    m = MODELS.models
    base = m["openstreetmap_it_alpecimbra_base"].build(ctx, m["openstreetmap_it_alpecimbra"].build(ctx, raw))
    assert [r.osm_id for r in m["openstreetmap_it_alpecimbra_parking"].build(ctx, base).collect()] == [1]
    assert [r.osm_id for r in m["openstreetmap_it_alpecimbra_piste_and_lifts"].build(ctx, base).collect()] == [2]


def test_regular_grid(ctx):
    g = forecasts.regular_grid(ctx, (45.0, 45.1), (11.0, 11.08), 0.04)
    assert g.count() == 9 and g.agg(F.max("lat")).first()[0] == 45.08
