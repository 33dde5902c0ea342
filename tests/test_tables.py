"""Written tables: what readers see while writers fail or meet, what a write touches, and ranks at size."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from voltaria import settings
from voltaria.materialize import Conflict, DuplicateKeys, Table
from voltaria.operators import joins


def test_a_write_that_dies_before_its_commit_leaves_the_table_as_it_was(spark, tmp_path, monkeypatch):
    t = Table(spark, str(tmp_path / "t"))
    t.overwrite(spark.range(5))

    def dies(*_):
        raise KeyboardInterrupt

    for write in (lambda x: x.overwrite(spark.range(9)), lambda x: x.append(spark.range(9)), lambda x: x.replace_range(spark.range(9), F.col("id") > 1)):
        broken = Table(spark, str(tmp_path / "t"))
        monkeypatch.setattr(broken, "_commit", dies)
        with pytest.raises(KeyboardInterrupt):
            write(broken)
        assert sorted(r.id for r in t.read().collect()) == [0, 1, 2, 3, 4]
    assert t.clean(keep=1) == 4 and t.read().count() == 5


def test_of_two_writers_from_one_commit_the_second_fails(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    t.overwrite(spark.range(3))
    number, folders = t._state()
    t.append(spark.range(2))
    with pytest.raises(Conflict):
        t._commit(number, folders)
    assert t.read().count() == 5


def test_appends_and_ranges_touch_no_other_folder(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), partition_by=["day"])
    for day in range(3):
        t.append(spark.range(4).withColumn("day", F.lit(day)))
    before = t._state()[1]
    t.replace_range(spark.range(1).withColumn("day", F.lit(1)), F.col("day") == 1)
    after = t._state()[1]
    assert after[:2] == [before[0], before[2]] and before[1] not in after
    assert sorted((r.day, r.id) for r in t.read().collect()) == sorted([(0, k) for k in range(4)] + [(2, k) for k in range(4)] + [(1, 0)])
    assert t.delete(F.col("day") > 5) == 0 and t._state()[1] == after


def test_merges_rewrite_only_parts_with_matches(spark, tmp_path):
    rows = lambda *r: spark.createDataFrame(list(r), "id int, day int, v string")
    for by in ((), ("day",)):
        t = Table(spark, str(tmp_path / f"t{len(by)}"), by)
        for day in (1, 2, 3):
            t.append(rows(*((k + 10 * day, day, "old") for k in range(3))))
        before = t._state()[1]
        t.merge(rows((21, 2, "new"), (90, 2, "more")), ["id"])
        after = t._state()[1]
        assert set(before) - set(after) == {before[1]}
        t.merge(rows((91, 3, "more"), (None, 1, "null key")), ["id"])  # no match: nothing is rewritten
        assert set(after) <= set(t._state()[1])
        t.merge(rows((None, 1, "null again")), ["id"])
        got = {(r.id, r.day, r.v) for r in t.read().collect()}
        assert got == {(k + 10 * d, d, "old") for d in (1, 2, 3) for k in range(3)} - {(21, 2, "old")} | {(21, 2, "new"), (90, 2, "more"), (91, 3, "more"), (None, 1, "null again")}


def test_inserts_keep_what_is_there(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    rows = lambda *r: spark.createDataFrame(list(r), "k string, v int")
    t.insert(rows(("a", 1), ("b", 1)), ["k"])
    before = t._state()[1]
    t.insert(rows(("b", 2), ("c", 2)), ["k"])
    assert before[0] in t._state()[1] and sorted(map(tuple, t.read().collect())) == [("a", 1), ("b", 1), ("c", 2)]
    with pytest.raises(DuplicateKeys):
        t.insert(rows(("d", 2), ("d", 3)), ["k"])
    assert t.read().count() == 3 and t.compact(most=1) and len(t._state()[1]) == 1 and not t.compact(most=1) and t.read().count() == 3


def test_a_range_takes_no_row_from_outside_and_loses_none(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"))
    day = lambda *ds: spark.createDataFrame([(d, f"run{len(ds)}") for d in ds], "day int, run string")
    for _ in range(3):
        t.replace_range(day(1, 2, 3), F.col("day") >= 3)
        assert sorted(r.day for r in t.read().collect()) == [1, 2, 3]
    t.replace_range(day(0, 3, 4), F.col("day") >= 3)
    assert sorted(r.day for r in t.read().collect()) == [1, 2, 3, 4]


def test_old_days_move_to_the_archive(spark, tmp_path, monkeypatch):
    t = Table(spark, str(tmp_path / "t"))
    hours = [(dt.datetime(2026, 1, d, h), d) for d in (1, 2, 3) for h in (0, 23)]
    t.overwrite(spark.createDataFrame(hours, "ts timestamp_ntz, v int"))
    monkeypatch.setattr(t, "delete", lambda _: 0)  # dies after writing
    t.archive("ts", dt.date(2026, 1, 3), str(tmp_path / "cold"))
    monkeypatch.undo()
    assert t.archive("ts", dt.date(2026, 1, 3), str(tmp_path / "cold")) == 4 and t.read().count() == 2
    assert t.archive("ts", dt.date(2026, 1, 3), str(tmp_path / "cold")) == 0
    cold = spark.read.parquet(str(tmp_path / "cold"))
    assert sorted((str(r.archived_day), r.v) for r in cold.collect()) == [("2026-01-01", 1)] * 2 + [("2026-01-02", 2)] * 2


def test_settings(spark, tmp_path, monkeypatch):
    tier = lambda k, *rows: [{k: a, "multiplier": b} for a, b in rows]
    (tmp_path / "s.json").write_text(json.dumps({"fleet": {"active_devices": ["x"]}, "settlement": {"effort_multiplier_tiers": tier("ratio_min", (1.5, 2), (1, 0.5))}, "flexibility_bonus": {"shift_effort_tiers": tier("shift_pct_min", (0.5, 2)), "event_multiplier_tiers": tier("ratio_min", (2, 3), (0, 1))}}))
    s = settings.load(tmp_path / "s.json")
    assert settings.effort_tiers(s) == [(1.0, 0.5), (1.5, 2.0)] and settings.shift_tiers(s) == [(0.5, 2.0)] and settings.event_tiers(s) == [(0.0, 1.0), (2.0, 3.0)]
    monkeypatch.delenv(settings.FLEET, raising=False)
    assert settings.active_devices(s) == ["x"] and settings.active_devices({}) == []
    monkeypatch.setenv(settings.FLEET, " a, b,,")
    assert settings.active_devices(s) == ["a", "b"] and settings.write_fleet(settings.active_devices(s), tmp_path / "n" / "f.csv") == 2
    assert [r.device_id for r in spark.read.csv(str(tmp_path / "n" / "f.csv"), header=True).collect()] == [r.device_id for r in settings.fleet(spark, ["a", "b"]).collect()]


@pytest.mark.parametrize("advisory", ["64m", "256k"])
def test_ranks_of_wide_rows_under_coalescing(spark, tmp_path, advisory):
    spark.range(300_000).withColumn("v", F.rand(3)).withColumn("wide", F.repeat(F.lit("abcdefgh"), 24)).write.parquet(str(tmp_path / "x"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes", "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", advisory)
        spark.conf.set("spark.sql.shuffle.partitions", "50")
        got = joins.ranked(spark.read.parquet(str(tmp_path / "x")), F.col("v"), F.col("id"))
        n, distinct, least, most, wrong = got.agg(F.count("*"), F.countDistinct("rank"), F.min("rank"), F.max("rank"), F.corr("rank", "v")).first()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert (n, distinct, least, most) == (300_000, 300_000, 1, 300_000) and wrong > 0.99
