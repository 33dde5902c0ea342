"""Operators whose results SQL doesn't show: against pandas, by hand, or through written tables."""

import datetime as dt

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltaria import materialize
from voltaria.functions import geo, time as T
from voltaria.materialize import DuplicateKeys, Table, merged, since_watermark
from voltaria.operators import allocation, joins, quality, spatial, timeseries
from voltaria.sources import files, payloads

T0 = dt.datetime(2026, 1, 1)


def test_decaying_mean_is_that_of_pandas(spark):
    r = np.random.default_rng(3)
    v = r.normal(10, 5, 1500)
    v[r.random(1500) < 0.1] = np.nan
    pdf = pd.DataFrame({"k": 1, "t": range(1500), "v": v})
    df = spark.createDataFrame(pdf).withColumn("v", F.when(~F.isnan("v"), F.col("v")))
    got = timeseries.decaying_mean(df, ["k"], "t", "v", 12, "m").orderBy("t").toPandas()["m"]
    want = pdf["v"].ewm(halflife=12, adjust=True).mean()
    assert np.allclose(got.astype(float), want, equal_nan=True)


def test_imputation_reads_what_it_filled(spark):
    n = 24 * 5
    v = [float(k % 24) for k in range(n)]
    for k in range(30, 70):
        v[k] = None
    v[100] = None
    v[0] = None
    df = spark.createDataFrame([(1, T0 + dt.timedelta(hours=k), v[k]) for k in range(n)], "s int, t timestamp_ntz, v double")
    got = [r.v for r in timeseries.impute(df, ["s"], "t", "v").orderBy("t").collect()]
    assert got[30:70] == [float(k % 24) for k in range(30, 70)] and got[100] == 4.0 and got[0] == 1.0


def test_asof_takes_the_newest_within_the_tolerance(spark):
    h = lambda x: T0 + dt.timedelta(hours=x)
    left = spark.createDataFrame([(1, h(5), "a"), (1, h(30), "b"), (2, h(5), "c"), (1, h(5), "d")], "k int, t timestamp_ntz, n string")
    right = spark.createDataFrame([(1, h(1), 1.0), (1, h(5), 2.0), (1, h(6), 3.0)], "k int, t timestamp_ntz, v double")
    got = {r.n: r.v for r in timeseries.asof(left, right, ["k"], "t", ["v"], 12 * 3600).collect()}
    assert got == {"a": 2.0, "d": 2.0, "b": None, "c": None}


def test_spine_without_slots(spark):
    e = spark.createDataFrame([(1,)], "k int")
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    assert timeseries.spine(e, at("2026-01-02"), at("2026-01-01"), "1 HOUR").count() == 0
    assert timeseries.spine(e, at("2026-01-01"), at("2026-01-01 02:00:00"), "1 HOUR").count() == 3


def test_intervals_over_several_buckets(spark):
    p = spark.createDataFrame([(1, T0 + dt.timedelta(hours=k)) for k in range(0, 96, 6)], "k int, t timestamp_ntz")
    w = spark.createDataFrame([(1, T0, T0 + dt.timedelta(hours=60)), (1, T0 + dt.timedelta(hours=60), T0 + dt.timedelta(hours=60))], "k int, s timestamp_ntz, e timestamp_ntz")
    assert joins.interval_join(p, w, ["k"], "t", "s", "e").count() == 10
    assert joins.interval_join(p, w, ["k"], "t", "s", "e", "left").count() == 16


def test_global_rank_over_partitions(spark):
    df = spark.range(1000).withColumn("v", (F.col("id") * 7919) % 1000)
    got = joins.ranked(df, F.col("v").asc(), F.col("id").asc()).orderBy("rank").collect()
    assert [r["rank"] for r in got] == list(range(1, 1001)) and [r.v for r in got] == sorted(r.v for r in got)


def test_merge_retention_and_ranges(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    make = lambda rows, s="k int, a string, b int": spark.createDataFrame(rows, s)
    assert not t.exists() and t.newest("b") is None
    t.merge(make([(1, "x", 1), (2, "y", 2)]), ["k"])
    t.merge(make([(2, "z", 9), (3, "w", 3)]), ["k"], ["b"])
    assert sorted(map(tuple, t.read().collect())) == [(1, "x", 1), (2, "y", 9), (3, "w", 3)]
    with pytest.raises(DuplicateKeys):
        t.merge(make([(1, "x", 1), (1, "y", 2)]), ["k"])
    t.merge(make([(3, "q", 3, 1.5)], "k int, a string, b int, c double"), ["k"])
    assert {r.k: r.c for r in t.read().collect()} == {1: None, 2: None, 3: 1.5}
    assert t.delete(F.col("b") < 2) == 1 and t.newest("b") == 9
    t.replace_range(make([(7, "n", 7)]), F.col("k") >= 3)
    assert sorted(r.k for r in t.read().collect()) == [2, 7]
    assert not t.overwrite_unless_empty(make([])) and t.read().count() == 2
    t.keep_referenced(make([(7, "", 0)]), ["k"])
    t.append(make([(8, "m", 1)]))
    assert sorted(r.k for r in t.read().collect()) == [7, 8]
    assert merged(make([(1, "x", 1)]), make([(1, 5)], "k int, b int"), ["k"], schema_change="sync").columns == ["k", "b"]


def test_watermarks(spark):
    df = spark.createDataFrame([(T0 + dt.timedelta(hours=h),) for h in range(5)], "t timestamp_ntz")
    assert since_watermark(df, "t", T0 + dt.timedelta(hours=3)).count() == 1
    assert since_watermark(df, "t", T0 + dt.timedelta(hours=3), "1 HOUR").count() == 3
    assert since_watermark(df, "t", None).count() == 5
    assert materialize.since_watermark(df, "t", T0 + dt.timedelta(hours=3), strict=False).count() == 2


def test_geometry(spark):
    one = spark.range(1)
    get = lambda c: one.select(c.alias("c")).first().c
    # on the central meridian the northing is the meridian's arc, here by its usual series, times the scale
    arc = 111_132.954 * 46 - 16_038.509 * np.sin(np.radians(92)) + 16.833 * np.sin(np.radians(184)) - 0.022 * np.sin(np.radians(276))
    u = get(geo.to_utm(F.lit(46.0), F.lit(9.0)))
    assert u.x == pytest.approx(500_000, abs=1e-3) and u.y == pytest.approx(0.9996 * arc, abs=0.5)
    back = get(geo.from_utm(F.lit(u.x), F.lit(u.y)))
    assert (back.lat, back.lon) == (pytest.approx(46.0, abs=1e-8), pytest.approx(9.0, abs=1e-8))
    ring = geo.outer_ring(F.lit("POLYGON ((0 0, 2 0, 2 2, 0 2, 0 0), (0.5 0.5, 1 0.5, 1 1, 0.5 0.5))"))
    assert get(geo.planar_area(ring)) == 4.0 and get(geo.contains(ring, F.lit(1.0), F.lit(1.0))) and not get(geo.contains(ring, F.lit(3.0), F.lit(1.0)))
    g = geo.polygons_of_geojson(F.lit('{"type":"Polygon","coordinates":[[[0,0],[2.5,0],[2,2],[0,0]]]}'))
    assert [[[(p.x, p.y) for p in ring] for ring in polygon] for polygon in get(g)] == [[[(0, 0), (2.5, 0), (2, 2), (0, 0)]]]
    assert get(geo.points_of_wkt(F.lit("POINT EMPTY"))) is None


def test_points_in_areas_and_tiles(spark):
    areas = spark.createDataFrame([("a", "POLYGON ((0 0, 10 0, 10 10, 0 10, 0 0))"), ("b", "POLYGON ((5 5, 15 5, 15 15, 5 15, 5 5))")], "id string, wkt string").withColumn("ring", geo.outer_ring(F.col("wkt")))
    pts = spark.createDataFrame([(1, 1.0, 1.0), (2, 7.0, 7.0), (3, 20.0, 20.0)], "p int, x double, y double")
    got = sorted((r.p, r.id) for r in spatial.points_in(pts, areas, "x", "y", "ring", 4.0).collect())
    assert got == [(1, "a"), (2, "a"), (2, "b")]
    assert spatial.tiles(pts, "x", "y", 10.0).count() == 4
    assert spatial.extent(areas, ["id"], "ring").filter("id = 'b'").first().maxx == 15


def test_easter_and_holidays(spark):
    known = {2000: (4, 23), 2019: (4, 21), 2024: (3, 31), 2025: (4, 20), 2026: (4, 5), 2038: (4, 25)}
    assert {y: (T.easter(y).month, T.easter(y).day) for y in known} == known
    assert T.italian_holidays(spark, 2024, 2024).count() == 11


def test_registry_bundles(spark):
    import json

    bundle = {
        "community": {"id": "rec1", "areas": {"n": {"topology": ["s1", "s2"]}}},
        "members": {
            "1": {"status": "ACTIVE", "user_id": "u1", "area": "n", "role": "prosumer", "type": "home", "delivery_points": [{"id": "d1"}], "assets": {"meter": {"x": {"sensor_id": "m1"}, "y": {"sensor_id": "m2"}, "z": {"sensor_id": None}}}},
            "2": {"status": "left", "user_id": "u2", "area": "n"}, "3": {"status": "active", "user_id": "u3", "area": "other", "role": "consumer"},
        },
    }
    m = payloads.registry_members(spark.createDataFrame([(json.dumps(bundle),)], "bundle string"))
    got = {r.user_id: r for r in m.collect()}
    assert set(got) == {"u1", "u3"} and sorted(got["u1"].sensor_ids) == ["m1", "m2"] and got["u1"].topology_ids == ["s1", "s2"] and got["u3"].topology_ids == []
    assert sorted((r.sensor_id, r.substation_id) for r in payloads.registry_devices(m).collect()) == [("m1", "s1"), ("m2", "s1")]


def test_files(spark, tmp_path):
    (tmp_path / "g.geojson").write_text('{"type":"FeatureCollection","features":[{"id":"1","geometry":{"type":"Point","coordinates":[1,2]},"properties":{"name":"x"}}]}')
    assert files.geojson(spark, str(tmp_path / "g.geojson")).first().properties == '{"name":"x"}'
    (tmp_path / "t").mkdir()
    (tmp_path / "t" / "abc.png").write_bytes(b"1")
    (tmp_path / "t" / "12345678.png").write_bytes(b"2")
    b = spark.createDataFrame([("abc",), ("12345678-9",), ("zz",)], "building_id string")
    got = {r.building_id: r.content for r in files.tiles_of(b, files.tiles(spark, str(tmp_path / "t"))).collect()}
    assert got["abc"] == b"1" and got["12345678-9"] == b"2" and got["zz"] is None


def test_reconciliation_sees_missing_keys(spark):
    a, b = spark.createDataFrame([(1, 1.0), (2, 2.0)], "k int, v double"), spark.createDataFrame([(1, 1.0), (3, 1.0)], "k int, v double")
    assert sorted(r.k for r in quality.reconciled(a, b, ["k"], "v", 0.1).collect()) == [2, 3]


def test_streaks_folded_are_those_of_the_steps(spark):
    from voltaria.operators import streaks

    r = np.random.default_rng(8)
    rows = [(f"d{k}", w, bool(r.random() < 0.6)) for k in range(12) for w in range(3, 30) if r.random() < 0.8]
    df = spark.createDataFrame(rows, "device_id string, period int, responded boolean")
    got = {x.device_id: (x.level, x.peak) for x in streaks.run_streaks(df, F.lit(3), F.lit(29)).collect()}
    hit = {(d, w) for d, w, ok in rows if ok}
    for d in got:
        level = peak = 0
        for w in range(3, 30):
            level = min(level + 1, 10) if (d, w) in hit else min(level, max(level - 1, round(peak * 0.5), 0))
            peak = max(peak, level)
        assert got[d] == (level, peak)


def test_totals_and_places_by_joins(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 2, 5), ("a", 3, 9), ("a", 4, None), (None, 5, 2), (None, 6, 2)], "day string, id int, points long")
    got = {r.id: r.all for r in allocation.with_totals(df, ["day"], F.sum("points").alias("all")).collect()}
    assert got == {1: 19, 2: 19, 3: 19, 4: 19, 5: 4, 6: 4}
    placed = allocation.with_places(df, ["day"], "points")
    assert placed.columns == ["day", "id", "points", "members", "rank", "below"]
    assert {r.id: (r.rank, r.members, r.below) for r in placed.collect()} == {3: (1, 4, 3), 1: (2, 4, 1), 2: (2, 4, 1), 4: (4, 4, 0), 5: (1, 2, 0), 6: (1, 2, 0)}
    assert allocation.with_places(df.limit(0), ["day"], "points").count() == 0


def test_overlay_of_crossing_nested_and_apart(spark):
    box = lambda x0, y0, x1, y1: [[(float(a), float(b)) for a, b in ((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))]]
    schema = "id string, {} array<array<struct<x: double, y: double>>>"
    left = spark.createDataFrame([("bar", box(0, 4, 10, 5)), ("far", box(50, 50, 51, 51)), ("none", None)], schema.format("ra"))
    right = spark.createDataFrame([("cross", box(4, 0, 5, 10)), ("inner", box(1, 4.2, 2, 4.8)), ("outer", box(49, 49, 60, 60))], schema.format("rb").replace("id", "other"))
    for size in (0.3, 3.0, 1000.0):
        assert sorted((r.id, r.other) for r in spatial.overlay(left, right, ["id"], ["other"], "ra", "rb", size).collect()) == [("bar", "cross"), ("bar", "inner"), ("far", "outer")]


def test_overlay_of_a_large_area_with_holes(spark):
    """Small boxes against a ring of many corners with a hole: inside, in the hole, on the border, outside, on a cell's corner;
    no cell holds more than the edges that run through it."""
    import math

    ring = lambda r, n: [(100 + r * math.cos(2 * math.pi * k / n), 100 + r * math.sin(2 * math.pi * k / n)) for k in range(n)] + [(100.0 + r, 100.0)]
    box = lambda x, y, s=1.0: [[(x, y), (x + s, y), (x + s, y + s), (x, y + s), (x, y)]]
    schema = "array<array<struct<x: double, y: double>>>"
    area = spark.createDataFrame([("area", [ring(50.0, 1000), ring(20.0, 400)])], f"a string, ra {schema}")
    at = {"in": (130.0, 100.0), "corner": (140.0, 100.0), "hole": (99.5, 99.5), "rim": (119.5, 100.0), "outer rim": (149.5, 99.5), "out": (151.0, 100.0), "far": (300.0, 100.0), "left": (60.0, 100.0), "low": (100.0, 65.0), "left of all": (10.0, 100.0)}
    boxes = spark.createDataFrame([(n, box(*xy)) for n, xy in at.items()] + [("around", box(0.0, 0.0, 200.0)), ("in hole", box(90.0, 90.0, 20.0))], f"b string, rb {schema}")
    for size in (3.0, 10.0, 77.0):
        got = {r.b for r in spatial.overlay(area, boxes, ["a"], ["b"], "ra", "rb", size).collect()}
        assert got == {"in", "corner", "rim", "outer rim", "left", "low", "around"}, size
    cells = spatial.polygon_cells(spatial.edge_cells(area, ["a"], "ra", 3.0), ["a"], 3.0)
    assert cells.agg(F.max(F.size("edges"))).first()[0] < 40 and cells.filter("parity AND size(edges) = 0").count() > 500


def test_line_union(spark):
    """Worked out by hand: a crossing, a touch, an overlap, a copy the other way round, a corner that stays, other keys apart."""
    cases = {
        "cross": (["LINESTRING (0 0, 2 2)", "LINESTRING (0 2, 2 0)"], {"0 0, 1 1", "1 1, 2 2", "0 2, 1 1", "1 1, 2 0"}),
        "touch": (["LINESTRING (0 0, 4 0)", "LINESTRING (1 0, 1 3)"], {"0 0, 1 0", "1 0, 4 0", "1 0, 1 3"}),
        "overlap": (["LINESTRING (0 0, 4 0)", "LINESTRING (6 0, 2 0)"], {"0 0, 2 0", "2 0, 4 0", "4 0, 6 0"}),
        "copy": (["LINESTRING (0 0, 1 0, 1 1)", "LINESTRING (1 1, 1 0, 0 0)", "LINESTRING (0 0, 1 0, 1 1)"], {"0 0, 1 0", "1 0, 1 1"}),
        "corner": (["LINESTRING (0 0, 1 1, 2 0, 3 0)"], {"0 0, 1 1, 2 0, 3 0"}),
        "parts": (["MULTILINESTRING ((0 0, 5 5, 10 0), (0 2, 10 2))"], {"0 0, 2 2", "2 2, 5 5, 8 2", "10 0, 8 2", "0 2, 2 2", "2 2, 8 2", "10 2, 8 2"}),
        "loop": (["LINESTRING (0 0, 2 0, 2 2, 1 -1)"], {"0 0, 1.3333333333333333 0", "1.3333333333333333 0, 2 0, 2 2, 1.3333333333333333 0", "1 -1, 1.3333333333333333 0"}),
        "point": (["POINT (1 1)"], set()),
    }
    lines = spark.createDataFrame([(k, w) for k, (ws, _) in cases.items() for w in ws], "k string, wkt string")
    for size in (0.7, 100.0):
        got: dict[str, set] = {k: set() for k in cases}
        for r in spatial.line_union(lines, ["k"], "wkt", size).collect():
            pts = [(p.x, p.y) for p in r.part]
            got[r.k].add(min(tuple(pts), tuple(reversed(pts))))
        text = lambda s: tuple(tuple(float(v) for v in p.split()) for p in s.split(", "))
        for k, (_, want) in cases.items():
            near = lambda ps: {tuple((round(x, 9), round(y, 9)) for x, y in p) for p in ps}
            assert near(got[k]) == near({min(text(w), tuple(reversed(text(w)))) for w in want}), (k, size)
    shape = spatial.line_union(lines.filter("k = 'cross'"), ["k"], "wkt", 10.0).groupBy("k").agg(spatial.multiline(F.collect_list("part")).alias("w")).first().w
    assert shape == "MULTILINESTRING ((0 0, 1 1), (0 2, 1 1), (1 1, 2 0), (1 1, 2 2))"
