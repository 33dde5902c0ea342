"""Golden cases of the flexibility models, and runs through the registry with tables written."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from voltaria.context import Context
from voltaria.materialize import Table
from voltaria.plans import flexibility as fx
from voltaria.registry import MODELS

DAY = dt.datetime(2026, 5, 28)
COMMIT = "commitment_id string, user_id string, suggestion_id string, suggestion_type string, community_id string, device_id string, period_start timestamp_ntz, period_end timestamp_ntz, status string, reward_points_estimated int, committed_at timestamp_ntz, settled_at timestamp_ntz, last_updated timestamp_ntz, window_duration_hours double"
WINDOW = "device_id string, ts_date date, window_start timestamp_ntz, window_end timestamp_ntz, community_kwh double, estimated_kwh double, reward_points_estimated int"
POINTS = "device_id string, ts timestamp_ntz, settlement_points double, consumption_kwh double, is_surplus_interval int"
BONUS = "device_id string, window_start timestamp_ntz, window_end timestamp_ntz, bonus_points int"
BASE = "device_id string, baseline_type string, slot int, is_weekday boolean, baseline_kwh double, computed_at timestamp_ntz"


def at(h, m=0):
    return DAY + dt.timedelta(hours=h, minutes=m)


@pytest.fixture
def ctx(spark, tmp_path):
    return Context(spark, str(tmp_path), at(12))


def df(ctx, schema, *rows):
    return ctx.spark.createDataFrame(list(rows), schema)


def hours(ctx, *pairs):
    return df(ctx, "ts timestamp_ntz, net_exchange_kwh double", *((at(h), float(v)) for h, v in pairs))


def windows_of(w):
    return sorted((r.window_start.hour, r.window_end.hour, round(r.community_kwh, 2)) for r in w.collect())


def test_nine_hours_make_three_windows(ctx):
    assert windows_of(fx.surplus_windows(hours(ctx, *((h, 1.0) for h in range(6, 15))))) == [(6, 9, 3.0), (9, 12, 3.0), (12, 15, 3.0)]


def test_a_gap_starts_a_window(ctx):
    assert windows_of(fx.surplus_windows(hours(ctx, (9, 1.0), (10, 1.0), (13, 0.9), (14, 0.9)))) == [(9, 11, 2.0), (13, 15, 1.8)]


def test_small_night_and_lone_hours_make_none(ctx):
    assert windows_of(fx.surplus_windows(hours(ctx, (3, 9.0), (4, 9.0), (9, 0.5), (10, 0.5), (15, 2.0)))) == []


def test_confidence_is_the_hit_rate(ctx):
    past = df(ctx, "window_start timestamp_ntz, window_end timestamp_ntz", (at(9), at(11)))
    assert fx.hit_rate(past, hours(ctx, (9, 1.0), (10, 0.1))).first()[0] == 0.5
    assert fx.hit_rate(past, hours(ctx, (15, 1.0))).first()[0] is None
    assert fx.hit_rate(past, hours(ctx, (9, 1.0), (10, 1.0))).first()[0] == 0.95


def device_windows(ctx, budget, *forecasts):
    w = df(ctx, "ts_date date, window_start timestamp_ntz, window_end timestamp_ntz, community_kwh double, confidence double", (DAY.date(), at(9), at(11), budget, None))
    rows = [(d, at(h), v, None, "forecast", 0, at(0)) for d, h, v in forecasts]
    f = df(ctx, "device_id string, timestamp timestamp_ntz, total_consumption_kwh double, grid_import_kwh double, period string, data_missing int, generated_at timestamp_ntz", *rows)
    out = fx.rec_flexibility_windows(ctx, w, f, df(ctx, BASE), df(ctx, "device_id string, is_m1_only boolean"))
    return {r.device_id: (r.estimated_kwh, r.reward_points_estimated) for r in out.collect()}


def test_points_of_devices_share_the_budget(ctx):
    got = device_windows(ctx, 2.0, ("dev-01", 9, 0.5), ("dev-01", 10, 0.5), ("dev-02", 9, 1.5), ("dev-02", 10, 1.5))
    assert got == {"dev-01": (0.5, 5), "dev-02": (1.5, 14)}


def test_points_within_the_budget(ctx):
    got = device_windows(ctx, 4.0, ("dev-01", 9, 0.5), ("dev-01", 10, 0.5), ("dev-02", 9, 0.8), ("dev-02", 10, 0.8))
    assert {d: p for d, (_, p) in got.items()} == {"dev-01": 9, "dev-02": 15}


def test_newest_forecast_and_baseline_devices(ctx):
    w = df(ctx, "ts_date date, window_start timestamp_ntz, window_end timestamp_ntz, community_kwh double, confidence double", (DAY.date(), at(9), at(11), 10.0, 0.5))
    cols = "device_id string, timestamp timestamp_ntz, total_consumption_kwh double, grid_import_kwh double, period string, data_missing int, generated_at timestamp_ntz"
    f = df(ctx, cols, ("a", at(9), 5.0, None, "forecast", 0, at(1)), ("a", at(9), 1.0, None, "forecast", 0, at(2)), ("b", at(9), 9.0, None, "forecast", 1, at(2)), ("c", at(9), 2.0, None, "forecast", 0, at(2)))
    base = df(ctx, BASE, ("c", "shift_potential", 36, True, 0.5, at(0)), ("c", "settlement", 36, True, 0.1, at(0)), ("c", "grid_export_median", 36, True, 0.2, at(0)))
    out = fx.rec_flexibility_windows(ctx, w, f, base, df(ctx, "device_id string, is_m1_only boolean", ("c", True)))
    got = {r.device_id: r.estimated_kwh for r in out.collect()}
    # c: eight slots, one with a baseline of 0.1 and seven of the floor, plus what the cap of 0.2 leaves of 0.5
    assert got == {"a": 1.0, "c": round(0.1 + 7 * 0.025 + 0.2, 2)}


def settle(ctx, status, budget, *actual):
    rows = [(f"c{k}", "u", "s1", "t", "r", f"d{k}", at(9), at(11), st, 10, at(7), None, at(8), 2.0) for k, st in enumerate(status)]
    h = df(ctx, "device_id string, ts timestamp_ntz, consumption_kwh double, window_start timestamp_ntz", *((f"d{k}", at(9), v, at(9)) for k, v in enumerate(actual)))
    w = df(ctx, WINDOW, ("d0", DAY.date(), at(9), at(11), budget, 1.0, 1))
    p = df(ctx, POINTS, *((f"d{k}", at(9), 10.0 * v if budget is None else v * 2.5 * 4 / 2, v, 1) for k, v in enumerate(actual)))
    out = fx.rec_commitment_settlement(ctx, df(ctx, COMMIT, *rows), h, w, p, df(ctx, BONUS))
    return {r.commitment_id: r for r in out.collect()}


def test_allocation_is_cut_to_the_budget(ctx):
    got = settle(ctx, ["settled", "settled"], 2.0, 1.0, 3.0)
    assert [got[c].allocated_kwh for c in ("c0", "c1")] == [0.5, 1.5]
    assert [got[c].reward_points_actual for c in ("c0", "c1")] == [5, 15]
    assert got["c1"].adherence_ratio == 1.5


def test_rejected_gets_nothing_and_committed_has_no_ratio(ctx):
    got = settle(ctx, ["rejected", "committed"], 9.0, 1.0, 3.0)
    assert (got["c0"].allocated_kwh, got["c1"].allocated_kwh) == (0.0, 3.0) and got["c1"].adherence_ratio is None


def test_the_earliest_window_holds_a_reading(ctx):
    m = df(ctx, "device_id string, ts timestamp_ntz, consumption_kwh double, production_kwh double, total_consumption_kwh double", ("d", at(9, 30), 1.0, 0.0, 1.0), ("d", at(12), 2.0, 0.0, 2.0))
    w = df(ctx, WINDOW, ("d", DAY.date(), at(9), at(11), 1.0, 1.0, 1), ("d", DAY.date(), at(8), at(12), 1.0, 1.0, 1))
    got = {r.ts.hour: r.window_start for r in fx.rec_settlement_15m(ctx, m, w).collect()}
    assert got == {9: at(8), 12: None}


def test_passive_devices_share_what_is_left(ctx):
    s = df(ctx, "device_id string, ts_date date, window_start timestamp_ntz, window_end timestamp_ntz, consumption_kwh double", *((d, DAY.date(), at(9), at(11), v) for d, v in (("act", 3.0), ("p1", 1.0), ("p2", 3.0))))
    c = df(ctx, COMMIT, ("c", "u", "s", "t", "r", "act", at(9), at(11), "committed", 1, at(7), None, at(7), 2.0))
    settled = df(ctx, "status string, period_start timestamp_ntz, period_end timestamp_ntz, allocated_kwh double", ("committed", at(9), at(11), 3.0))
    w = df(ctx, WINDOW, ("act", DAY.date(), at(9), at(11), 5.0, 1.0, 1))
    got = {r.device_id: r for r in fx.rec_gamification_summary(ctx, s, c, settled, w).collect()}
    assert {d: r.total_allocated_kwh for d, r in got.items()} == {"act": 0.0, "p1": 0.5, "p2": 1.5}
    assert {d: r.rank_position for d, r in got.items()} == {"act": 1, "p2": 1, "p1": 3} and got["act"].committed


def test_seasons(ctx):
    d = df(ctx, "d string", ("2025-09-15",), ("2025-11-05",), ("2026-05-28",), ("2025-08-31",)).select(F.to_date("d").alias("d"))
    got = [str(r[0]) for r in d.select(fx.season(ctx, F.col("d"))).collect()]
    assert got == ["2025-09-01", "2025-11-01", "2026-05-01", "2025-07-01"]


def test_leaderboard_is_complete_and_ranked(ctx):
    """The current season has the whole fleet; an earlier one those with points alone, one before the anchor nobody."""
    may, march, old = dt.date(2026, 5, 1), dt.date(2026, 3, 1), dt.date(2025, 7, 1)
    rows = [(d, s, n - 5, 5, n) for d, s, n in (("a", may, 10), ("a", may, 20), ("b", may, 20), ("c", may, 20), ("a", march, 7), ("gone", march, 9), ("a", old, 99))]
    p = df(ctx, "device_id string, season_start date, daily_settlement_points int, daily_bonus_points int, daily_points int", *rows)
    board = fx.rec_points_leaderboard(ctx, p, df(ctx, "device_id string", ("a",), ("b",), ("c",), ("d",)))
    got = {(r.device_id, r.season_start): (r.season_base_points, r.season_bonus_points, r.season_points, r.season_rank, r.total_members, r.alltime_base_points, r.alltime_bonus_points, r.is_current_season) for r in board.collect()}
    assert got == {
        ("a", may): (20, 10, 30, 1, 4, 22, 15, True), ("b", may): (15, 5, 20, 2, 4, 15, 5, True), ("c", may): (15, 5, 20, 2, 4, 15, 5, True), ("d", may): (0, 0, 0, 4, 4, 0, 0, True),
        ("gone", march): (4, 5, 9, 1, 2, 4, 5, False), ("a", march): (2, 5, 7, 2, 2, 22, 15, False),
    }
    assert {r.season_end for r in board.filter("is_current_season").collect()} == {dt.date(2026, 7, 1)}


def test_savings_count_own_energy_of_all_slots_and_of_windows(ctx):
    m = df(ctx, "device_id string, ts timestamp_ntz, self_consumed_kwh double", ("a", at(9), 1.00004), ("a", at(20), 2.0), ("b", at(9), 4.0), ("b", at(21), 8.0))
    f = df(ctx, "country string, kg_co2_per_kwh double, trees_per_ton double", ("it", 0.233, 21.0), ("de", 9.0, 9.0))
    got = {r.device_id: (r.consumption_kwh, r.co2_avoided_kg, r.trees_equivalent) for r in fx.rec_co2_savings(ctx, m, f).collect()}
    assert got == {"a": (3.0, 0.699, 0.014679), "b": (12.0, 2.796, 0.058716)}  # 12 kWh: 2.796 kg, of which 0.002796 t times 21
    s = df(ctx, "device_id string, ts timestamp_ntz, window_start timestamp_ntz, consumption_kwh double", ("a", at(9), at(9), 50.0), ("a", at(20), None, 50.0), ("b", at(9), at(9), 50.0))
    r = fx.rec_co2_savings_community(ctx, m, s, f).collect()
    assert [tuple(x) for x in r] == [(DAY.date(), 5.0, 1.165, 0.024465, 2)]


def test_flags(ctx):
    """Ten times the median of the 30 days before is the limit; a median of 0 sets none; each cut window is a flag of its own."""
    cols = "_id string, device_id string, window_start timestamp_ntz, window_end timestamp_ntz, bonus_points int, bonus_points_raw double, bonus_points_capped double"
    row = lambda d, day, n, raw=1.0, cap=1.0, h=9: ("", d, at(h) - dt.timedelta(days=day), at(h + 1) - dt.timedelta(days=day), n, raw, cap)
    b = df(ctx, cols, row("a", 40, 10_000), row("a", 3, 1), row("a", 2, 2), row("a", 1, 5), row("a", 0, 10), row("a", 0, 11, h=14), row("zero", 2, 0), row("zero", 1, 0), row("zero", 0, 999), row("cut", 0, 5, 9.0, 4.0), row("cut", 0, 5, 8.0, 4.0, 14), row("cut", 1, 5, 4.0005, 4.0))
    got = sorted((r.device_id, r.flag_date, r.flag_type, r.metric_value, r.threshold_value, r.severity) for r in fx.rec_anti_gaming_flags(ctx, b).collect())
    assert got == [("a", DAY.date(), "L4_DAILY_SPIKE", 21.0, 20.0, "warning"), ("cut", DAY.date(), "L3_WINDOW_CAP", 8.0, 4.0, "info"), ("cut", DAY.date(), "L3_WINDOW_CAP", 9.0, 4.0, "info")]
    assert fx.rec_anti_gaming_flags(ctx, b).select("_id").distinct().count() == 3


def test_settlement_points_of_surplus_and_deficit(ctx):
    import math

    s = df(ctx, "ts timestamp_ntz, device_id string, grid_import_kwh double, grid_export_kwh double, total_consumption_kwh double", (at(9), "a", 1.0, 0.0, 1.0), (at(9), "b", 1.0, 0.0, 2.0), (at(10), "a", 0.5, 0.0, 1.0))
    base = df(ctx, BASE, ("a", "settlement", 36, True, 0.5, at(0)))
    f = df(ctx, "timestamp timestamp_ntz, period string, production_kwh double", (at(9), "actual", 4.0), (at(10), "actual", 4.0))
    got = {(r.device_id, r.ts.hour): r for r in fx.rec_settlement_points(ctx, s, df(ctx, "device_id string, is_m1_only boolean"), base, f).collect()}
    a = got["a", 9]
    assert a.is_surplus_interval == 0 and a.effort_multiplier == 2.0 and a.effort_adjusted_points == 0
    wa, wb = math.log1p(1) * 2, math.log1p(2) * 2
    assert a.pool_share_points == pytest.approx(10 * wa / (wa + wb)) and got["b", 9].pool_share_points == pytest.approx(10 * wb / (wa + wb))
    assert got["a", 10].is_surplus_interval == 1 and got["a", 10].settlement_points == pytest.approx(math.log1p(1) * 20)


def test_bonus_and_its_retention(ctx):
    c = df(ctx, COMMIT, ("c", "u", "s", "t", "r", "d", at(9), at(10), "committed", 1, at(7), None, at(7), 1.0))
    w = df(ctx, WINDOW, ("d", DAY.date(), at(9), at(10), 5.0, 1.0, 1))
    p = df(ctx, POINTS, *(("d", at(9, m), 1.0, 0.5, int(m < 30)) for m in (0, 15, 30, 45)))
    base = df(ctx, BASE, *(("d", "reference", s, True, 0.25, at(0)) for s in range(36, 40)))
    state = df(ctx, "device_id string, multiplier double", ("d", 1.1))
    r = fx.rec_flexibility_bonus(ctx, c, w, p, base, state).first()
    assert (r.shifted_kwh, r.reference_kwh, r.shift_fraction, r.shift_effort_mult, r.accuracy) == (1.0, 1.0, 1.0, 2.5, 0.5)
    assert r.bonus_points_raw == pytest.approx(1.0 * 15 * 2.5 * 0.5 * 1.1) and r.bonus_points == 21
    b = fx.rec_flexibility_bonus(ctx, c, w, p, base, state)
    assert fx.bonus_of_live_commitments(ctx, b, c).count() == 1 and fx.bonus_of_live_commitments(ctx, b, c.withColumn("status", F.lit("cancelled"))).count() == 0
    assert fx.bonus_of_live_commitments(ctx, b, c.withColumn("period_end", F.col("period_end") - F.expr("INTERVAL 1 MINUTE"))).count() == 0


def test_baselines_of_a_fleet(ctx):
    start = dt.datetime(2026, 4, 1)
    rows = [(d, start + dt.timedelta(days=k, minutes=15 * s), 0.5 + 0.1 * (s % 5), 0.2 if d == "b" else 0.0, 0.1 if d == "b" else 0.0) for d in "ab" for k in range(15) for s in range(0, 96, 24)]
    rows += [("c", start, 1.0, 0.0, 0.0)]
    h = df(ctx, "device_id string, ts timestamp_ntz, consumption_kwh double, production_kwh double, pv_production_kwh double", *rows).withColumn("total_consumption_kwh", F.col("consumption_kwh"))
    b = fx.compute_baselines(ctx, h, min_readings=0)
    got = {(r.device_id, r.baseline_type, r.slot, r.is_weekday): r.baseline_kwh for r in b.collect()}
    assert not any(k[0] == "c" for k in got)
    assert got["b", "settlement", 24, True] == pytest.approx(0.9) and got["b", "shift_potential", 24, True] == 0.0
    assert ("a", "shift_potential", 24, True) not in got and got["a", "grid_export_median", 0, False] == 0.0


def test_streaks(ctx):
    prev = df(ctx, "device_id string, level int, peak int", ("up", 2, 2), ("down", 4, 5), ("floor", 3, 6), ("top", 10, 10))
    bonus = df(ctx, BONUS, ("up", at(0) - dt.timedelta(days=1), at(1), 5), ("top", at(0), at(1), 1), ("down", at(0) - dt.timedelta(days=9), at(1), 5))
    got = {r.device_id: (r.level, r.peak, r.multiplier) for r in fx.weekly_streaks(ctx, prev, bonus, df(ctx, "device_id string", ("new",), ("up",))).collect()}
    assert got == {"up": (3, 3, 1.15), "down": (3, 5, 1.15), "floor": (3, 6, 1.15), "top": (10, 10, 1.5), "new": (0, 0, 1.0)}


def test_models_run_through_the_registry(ctx):
    """Meters to settlement, twice: merges, ranges that keep history, views that stay lazy."""
    raw = df(ctx, "device_id string, ts timestamp_ntz, consumption_kwh double, production_kwh double, self_consumed_kwh double", *(("dev", at(h, m), 0.25, 0.0, 0.0) for h in range(8, 12) for m in (0, 15, 30, 45)))
    ctx.tables |= {
        "meters_data_normalized": raw.unionByName(raw.limit(1)), "rec_active_devices": df(ctx, "device_id string", ("dev",)),
        "total_meters_forecast": df(ctx, "timestamp timestamp_ntz, period string, net_exchange_kwh double, production_kwh double, generated_at timestamp_ntz", *((at(h), "forecast", 2.0, 1.0, at(0)) for h in (9, 10)), (at(9), "actual", 2.0, 8.0, at(0))),
        "meters_energy_forecast": df(ctx, "device_id string, timestamp timestamp_ntz, total_consumption_kwh double, grid_import_kwh double, period string, data_missing int, generated_at timestamp_ntz", ("dev", at(9), 1.0, None, "forecast", 0, at(0))),
        "rec_device_baselines_raw": df(ctx, BASE), "co2_factors": df(ctx, "country string, kg_co2_per_kwh double, trees_per_ton double", ("it", 0.233, 21.0)),
    }
    names = MODELS.needed(["rec_settlement_points", "rec_co2_savings", "rec_settlement_1h"])
    for _ in range(2):
        for n in [m for m in ctx.tables if m in MODELS.models]:
            del ctx.tables[n]
        out = MODELS.run(ctx, [n for n in names if n in MODELS.models])
        assert out["meters_data_15m"].count() == 16 and out["rec_flexibility_windows"].count() == 1
        assert out["rec_settlement_15m"].filter("window_start IS NOT NULL").count() == 8 and out["rec_settlement_points"].count() == 16
        assert out["rec_co2_savings"].first().consumption_kwh == 0.0


def test_auto_commitments_take_the_place_of_former_ones(ctx):
    meters = df(ctx, "device_id string", ("a",), ("a",), ("b",))
    day = DAY.date()
    other = lambda k: day + dt.timedelta(days=k)
    w = df(ctx, WINDOW, ("a", day, at(9), at(11), 1.0, 1.0, 1), ("b", day, at(9), at(11), 1.0, 1.0, 1), ("a", other(1), at(33), at(36), 1.0, 1.0, 1), ("a", other(-1), at(-15), at(-13), 1.0, 1.0, 1), ("a", other(2), at(57), at(59), 1.0, 1.0, 1))
    rows = fx.auto_commitments(ctx, meters, w, "c1")
    got = {r.id: r for r in rows.collect()}
    assert sorted(got) == ["auto-a-202605280900-1100", "auto-a-202605290900-1200", "auto-b-202605280900-1100", "auto-b-202605290900-1200"]
    r = got["auto-b-202605290900-1200"]
    assert (r.user_id, r.suggestion_id, r.community_id, r.period_start, r.period_end, r.status, r.reward_points_estimated) == ("auto-user-b", "auto-sug-202605290900-1200", "c1", at(33), at(36), "committed", 10)
    assert r.settled_at is None and r.reward_points_actual is None and r.committed_at == r.last_updated == at(12)
    mirror = Table(ctx.spark, ctx.path("raw", "flexibility_commitments_mirror"))
    own = rows.filter("device_id = 'a'").limit(1).withColumn("id", F.lit("real-1"))
    mirror.append(own.unionByName(rows.limit(1).withColumn("id", F.lit("auto-old"))))
    assert not fx.auto_commit(ctx, mirror, meters, w) and mirror.read().count() == 2
    ctx.vars["auto_commit"] = True
    assert not fx.auto_commit(ctx, mirror, meters, w.limit(0)) and mirror.read().count() == 2
    for _ in range(2):
        assert fx.auto_commit(ctx, mirror, meters, w)
        assert {r.id for r in mirror.read().collect()} == {"real-1", *got} and mirror.read().count() == 5
    assert fx.silver_flexibility_commitments(ctx, mirror.read()).filter("window_duration_hours = 3").count() == 2
