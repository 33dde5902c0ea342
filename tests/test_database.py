"""Reads and writes of databases: JDBC by the database that comes with Spark, the sink by a file of this machine."""

import datetime as dt
import json
import sqlite3

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from voltaria.sources import database


@pytest.fixture
def shop(spark, tmp_path):
    """Options of the sink, and a function that runs SQL on the database."""
    at = str(tmp_path / "shop.db")
    cloudpickle.register_pickle_by_value(database)
    spark.dataSource.register(database.Database)

    def ask(sql):
        with sqlite3.connect(at) as c:
            return c.execute(sql).fetchall()

    ask("CREATE TABLE mirror (id INTEGER PRIMARY KEY, status TEXT, points REAL, committed TEXT)")
    yield {"driver": "sqlite3", "connect": json.dumps({"database": at, "timeout": 60}), "table": "mirror"}, ask
    cloudpickle.unregister_pickle_by_value(database)


def put(df, options, mode="append", **more):
    df.write.format("database").options(**options, **more).mode(mode).save()


def rows(spark, *given):
    return spark.createDataFrame(list(given), "id int, status string, points double").repartition(3)


def test_upserts_update_the_named_columns(spark, shop):
    options, ask = shop
    put(rows(spark, (1, "open", 1.0), (2, "open", None)), options, keys="id")
    put(rows(spark, (2, "settled", 5.0), (3, None, 7.0)), options, keys="id", update="status")
    assert ask("SELECT id, status, points FROM mirror ORDER BY id") == [(1, "open", 1.0), (2, "settled", None), (3, None, 7.0)]
    put(rows(spark, (3, "x", 0.0), (4, "new", 0.0)), options, keys="id", update="")
    assert ask("SELECT id, status, points FROM mirror WHERE id > 2 ORDER BY id") == [(3, None, 7.0), (4, "new", 0.0)]
    assert [t for (t,) in ask("SELECT name FROM sqlite_master WHERE type = 'table'")] == ["mirror"]


def test_prune_and_overwrite_go_with_the_rows(spark, shop):
    options, ask = shop
    put(rows(spark, (1, "old", 1.0), (2, "open", 2.0)), options, keys="id")
    put(rows(spark, (2, "settled", 2.0)), options, keys="id", prune="status = 'old'")
    assert ask("SELECT id, status FROM mirror") == [(2, "settled")]
    put(rows(spark, (8, "a", 1.0), (9, "b", 1.0)), options, mode="overwrite")
    assert sorted(ask("SELECT id, status FROM mirror")) == [(8, "a"), (9, "b")]
    put(rows(spark), options, keys="id")
    assert len(ask("SELECT * FROM mirror")) == 2
    put(rows(spark), options, mode="overwrite")
    assert ask("SELECT * FROM mirror") == []


def test_a_task_that_fails_leaves_all_as_it_was(spark, shop):
    options, ask = shop
    put(rows(spark, (1, "open", 1.0)), options, keys="id")
    many = spark.range(2, 4002, numPartitions=4).select(F.col("id").cast("int").alias("id"), F.when(F.col("id") == 3900, F.raise_error(F.lit("lost"))).otherwise("new").alias("status"))
    with pytest.raises(Exception, match="lost"):
        put(many, options, keys="id", prune="id = 1")
    assert ask("SELECT id, status FROM mirror") == [(1, "open")]
    assert [t for (t,) in ask("SELECT name FROM sqlite_master WHERE type = 'table'")] == ["mirror"]


def test_keys_that_are_null_or_come_twice(spark, shop):
    options, ask = shop
    for bad in ([(1, "a", 1.0), (1, "b", 2.0)], [(1, "a", 1.0), (None, "b", 2.0)]):
        with pytest.raises(Exception, match="comes twice|is null"):
            put(rows(spark, *bad), options, keys="id", prune="1 = 1")
        assert ask("SELECT * FROM mirror") == []
    with pytest.raises(Exception, match="no columns"):
        put(rows(spark, (1, "a", 1.0)), options, keys="other")
    assert [t for (t,) in ask("SELECT name FROM sqlite_master WHERE type = 'table'")] == ["mirror"]


def test_attempts_that_do_not_count(spark, shop):
    """A task that ran twice, of which one attempt counts."""
    options, ask = shop
    sink = database.Sink(options, ["id", "status"], False, "x")
    sink.prepare()
    sink.put(iter([(1, "lost"), (2, "lost")]))
    kept = sink.put(iter([(1, "kept")]))
    database.BatchWriter(sink).commit([kept, None])
    assert ask("SELECT id, status FROM mirror") == [(1, "kept")]


def test_stream_batches_count_once(spark, shop, tmp_path):
    options, ask = shop
    rows(spark, (1, "a", 1.0), (2, "b", 2.0)).write.json(str(tmp_path / "in"))
    stream = spark.readStream.schema("id int, status string, points double").json(str(tmp_path / "in"))

    def run(checkpoint):
        w = stream.writeStream.format("database").options(**options, query="q", keys="id", update="status,points").option("checkpointLocation", str(tmp_path / checkpoint))
        w.trigger(availableNow=True).start().awaitTermination(60)

    run("c")
    assert sorted(ask("SELECT id, status, points FROM mirror")) == [(1, "a", 1.0), (2, "b", 2.0)]
    ask("UPDATE mirror SET status = 'later'")
    run("lost checkpoint")  # the first batch again, under its number: noted already
    assert {s for (s,) in ask("SELECT status FROM mirror")} == {"later"}
    rows(spark, (2, "c", 3.0), (5, "d", 4.0)).write.mode("append").json(str(tmp_path / "in"))
    run("c")
    assert sorted(ask("SELECT id, status, points FROM mirror")) == [(1, "later", 1.0), (2, "c", 3.0), (5, "d", 4.0)]
    assert ask("SELECT count(*) FROM mirror_in_q") == [(0,)] and len(ask("SELECT * FROM mirror_batches")) == 1


def test_partitioned_reads(spark, tmp_path):
    spark._jvm.java.lang.System.setProperty("derby.stream.error.file", str(tmp_path / "derby.log"))
    url, how = "jdbc:derby:memory:voltaria;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    n = 100
    day = F.date_add(F.lit(dt.date(2026, 1, 1)), F.col("id").cast("int"))
    spark.range(n).select("id", day.alias("day"), (F.col("id") * 0.5).alias("kwh")).write.jdbc(url, "readings", "overwrite", how)
    for key in ("id", "day"):
        got = database.read_table(spark, url, "readings", key, 4, **how)
        assert got.rdd.getNumPartitions() == 4
        assert sorted((r.id, r.kwh) for r in got.collect()) == [(i, i * 0.5) for i in range(n)]
    few = database.read_table(spark, url, "readings", "id", 4, **how).filter("id >= 90").select("kwh")
    plan = few._jdf.queryExecution().toString()
    assert few.count() == 10 and "GreaterThanOrEqual" in plan.split("PushedFilters")[-1]
    spark.range(0).select("id").write.jdbc(url, "nothing", "overwrite", how)
    assert database.read_table(spark, url, "nothing", "id", 4, **how).count() == 0
