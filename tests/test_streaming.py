"""Streaming jobs over files, run until all input is taken."""

import datetime as dt

import pytest

from voltaria.materialize import Table
from voltaria.streaming import jobs

T0 = dt.datetime(2026, 1, 1)
SCHEMA = "device_id string, ts timestamp, kwh double"


@pytest.fixture
def source(spark, tmp_path):
    def put(rows, schema=SCHEMA):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        return spark.readStream.schema(schema).parquet(str(tmp_path / "in"))

    return put


def run(stream, name, tmp_path, mode):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / f"c-{name}")).trigger(availableNow=True).start()
    q.awaitTermination(120)


def test_rollup(spark, source, tmp_path):
    s = source([("a", T0 + dt.timedelta(minutes=m), 1.0) for m in (0, 5, 14, 15, 50)])
    run(jobs.rollup(s, ["device_id"], "ts", "kwh"), "slots", tmp_path, "complete")
    assert sorted((r.ts.minute, r.kwh) for r in spark.table("slots").collect()) == [(0, 3.0), (15, 1.0), (45, 1.0)]


def test_merge_of_micro_batches(spark, source, tmp_path):
    t = Table(spark, str(tmp_path / "out"))
    s = source([("a", T0, 1.0), ("a", T0 + dt.timedelta(hours=1), 2.0), ("b", T0, 5.0)])
    jobs.merge_into(s, t, ["device_id"], "ts", str(tmp_path / "c")).awaitTermination(120)
    assert {r.device_id: r.kwh for r in t.read().collect()} == {"a": 2.0, "b": 5.0}
    source([("b", T0 + dt.timedelta(hours=2), 7.0)])
    jobs.merge_into(s, t, ["device_id"], "ts", str(tmp_path / "c")).awaitTermination(120)
    assert {r.device_id: r.kwh for r in t.read().collect()} == {"a": 2.0, "b": 7.0}


def test_streak_state(spark, source, tmp_path):
    w = lambda k: dt.date(2026, 1, 5) + dt.timedelta(weeks=k)
    s = source([("a", w(0), True), ("a", w(1), True), ("a", w(2), False), ("b", w(0), False)], "device_id string, week date, responded boolean")
    run(jobs.streaks(s), "streaks", tmp_path, "append")
    got = {(r.device_id, str(r.week)): (r.level, r.peak) for r in spark.table("streaks").collect()}
    assert got["a", str(w(2))] == (1, 2) and got["a", str(w(1))] == (2, 2) and got["b", str(w(0))] == (0, 0)


def test_a_silent_device_decays_by_timers_and_late_weeks_are_ordered(spark, source, tmp_path):
    name, before = "spark.sql.streaming.stateStore.providerClass", spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.conf.set(name, jobs.STATE_STORE)
    try:
        at = lambda k, day=1: dt.datetime(2026, 1, 5) + dt.timedelta(weeks=k, days=day)
        schema = "device_id string, ts timestamp, responded boolean"
        out = lambda s: {(r.device_id, str(r.week)): (r.level, r.peak) for r in s}
        jobs_of = lambda stream: stream.writeStream.format("parquet").option("path", str(tmp_path / "o")).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination(120)
        s = source([("a", at(1), True), ("a", at(0), True), ("a", at(1), False), ("b", at(0), False)], schema)
        jobs_of(jobs.timed_streaks(s))  # weeks 0 and 1 aren't over yet, or just one
        source([("a", at(2), True), ("clock", at(9), False)], schema)
        jobs_of(jobs.timed_streaks(s))  # restarted from the checkpoint
        source([("clock", at(12), False)], schema)
        jobs_of(jobs.timed_streaks(s))
        got = out(spark.read.parquet(str(tmp_path / "o")).collect())
        week = lambda k: str(at(k, 0).date())
        assert [got.get(("a", week(k))) for k in range(5)] == [(1, 1), (2, 2), (3, 3), (2, 3), (2, 3)]  # to half of the peak, and rests there
        assert ("a", week(6)) not in got and got["b", week(0)] == (0, 0) and ("b", week(2)) not in got
    finally:
        spark.conf.set(name, before)
