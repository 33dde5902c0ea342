"""Windows over long series by buckets, against pandas over the whole series; a recomputed tail against the full history."""

import datetime as dt
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltaria.context import Context
from voltaria.operators import features, scans, timeseries
from voltaria.plans import forecasts
from voltaria.registry import MODELS

T0 = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def series(spark):
    """Two hourly series, one over several buckets with missing hours and long and short runs of nulls, one without a value."""
    rng = np.random.default_rng(4)
    hours = np.sort(rng.choice(11_000, 9_500, replace=False))
    p = pd.DataFrame({"k": "long", "ts": [T0 + dt.timedelta(hours=int(h)) for h in hours], "v": rng.normal(10, 8, len(hours))})
    p.loc[4000:8500, "v"] = np.nan  # longer than a bucket
    p.loc[rng.choice(len(p), 300, replace=False), "v"] = np.nan
    p.loc[:2, "v"] = np.nan
    q = pd.DataFrame({"k": "none", "ts": [T0 + dt.timedelta(hours=h) for h in range(5)], "v": np.nan})
    rows = [(k, t.to_pydatetime(), None if np.isnan(v) else float(v)) for k, t, v in pd.concat([p, q]).itertuples(index=False)]
    return p, spark.createDataFrame(rows, "k string, ts timestamp_ntz, v double").repartition(5).cache()


def got(df, column):
    return [r[0] for r in df.filter("k = 'long'").orderBy("ts").select(column).collect()]


def same(a, b):
    np.testing.assert_allclose(np.array([np.nan if x is None else x for x in a], float), np.asarray(b, float), rtol=0, atol=1e-9)


def test_decaying_mean(series):
    p, df = series
    same(got(timeseries.decaying_mean(df, ["k"], "ts", "v", 12, "e"), "e"), p["v"].ewm(halflife=12, adjust=True).mean())


def test_fills_and_gaps(series):
    p, df = series
    same(got(timeseries.fill(df, ["k"], "ts", ["v"]), "v"), p["v"].ffill())
    both = timeseries.fill(df, ["k"], "ts", ["v"], True, True)
    same(got(both, "v"), p["v"].ffill().bfill())
    assert both.filter("k = 'none' AND v IS NOT NULL").count() == 0
    run = (p["v"].isna() != p["v"].isna().shift()).cumsum()
    length = p.groupby(run)["v"].transform("size").where(p["v"].isna(), 0)
    gaps = timeseries.gap_lengths(df, ["k"], "ts", "v")
    same(got(gaps, "gap_length"), length)
    assert {r.gap_length for r in gaps.filter("k = 'none'").collect()} == {5}


def walked(v, months, small=6):
    """The imputation row by row, on a list with nans."""
    v, n, known = list(v), len(v), ~np.isnan(v)
    gaps, k = [0] * n, 0
    while k < n:
        end = k
        while end < n and not known[end]:
            end += 1
        gaps[k:end] = [end - k] * (end - k)
        k = max(end, k + 1)
    for k in range(n):
        if gaps[k] > small:
            before = [v[k - 24 * d] for d in (1, 2, 3) if k >= 24 * d and not np.isnan(v[k - 24 * d])]
            v[k] = before[0] if before else months.get(k, np.nan)
    return v


def test_imputation_by_buckets_equals_a_walk(series):
    """Long gaps by the walk; then short ones by interpolation over at most six rows, and the edges."""
    p, df = series
    default = {1: 1.0, 2: 2.0, 5: 5.0}
    months = {k: default[t.month] for k, t in enumerate(p["ts"]) if t.month in default}
    v = pd.Series(walked(p["v"], months))
    filled = timeseries.impute(df, ["k"], "ts", "v", monthly=default).cache()
    same(got(filled, "v"), v.interpolate(limit=6).ffill().bfill())
    assert filled.count() == df.count() and filled.filter("k = 'none' AND v IS NOT NULL").count() == 0  # a short gap without neighbours


def test_two_columns_at_once_are_as_one_by_one(series):
    _, df = series
    two = df.withColumn("u", F.when(F.hour("ts") < 12, F.col("v") * 2))
    both = timeseries.impute_columns(two, ["k"], "ts", {"v": {1: 1.0}, "u": None})
    assert both.columns == two.columns
    same(got(both, "v"), got(timeseries.impute(df, ["k"], "ts", "v", monthly={1: 1.0}), "v"))
    same(got(both, "u"), got(timeseries.impute(two.drop("v"), ["k"], "ts", "u"), "u"))


def test_imputation_windows_are_bounded(series):
    """Windows over a series, or a chain, order one row a bucket or span; those over rows have a bucket or span among their keys."""
    _, df = series
    plan = timeseries.impute(df, ["k"], "ts", "v")._jdf.queryExecution().optimizedPlan().toString()
    windows = [line for line in plan.splitlines() if "Window [" in line]
    keys = [re.findall(r"\[([^\[\]]*)\]", line)[-2 if re.search(r"(ASC|DESC) NULLS (FIRST|LAST)\]$", line.strip()) else -1] for line in windows]
    over_rows = [k for k in keys if re.search("__(bucket|k|span)#", k)]
    series_alone = [line for line, k in zip(windows, keys, strict=True) if k not in over_rows]
    assert over_rows and series_alone
    assert all(re.search(r"__(rows|e)|__e_", line) for line in series_alone), series_alone


def test_buckets_hold_a_bounded_number_of_rows_and_every_row_once(series):
    p, df = series
    b = scans.bucketed(df, ["k"], "ts", 30, 10, size=100)
    assert b.groupBy("k", "__bucket").count().agg(F.max("count")).first()[0] <= 140
    assert scans.own_rows(b).count() == df.count() and b.filter("__own").select("k", "__n").distinct().count() == df.count()
    assert got(scans.numbered(df, ["k"], "ts"), "__n") == list(range(len(p)))


def test_rolling_features(series):
    p, df = series
    f = features.weather(df.withColumnRenamed("v", "temperature_2m"), ["k"], "ts")
    roll = p["v"].rolling(24, min_periods=1)
    same(got(f, "temp_rolling_mean_24h"), roll.mean())
    same(got(f, "temp_rolling_std_24h"), roll.std())


def hourly(spark, days):
    rng = np.random.default_rng(9)
    t, r = rng.normal(10, 8, 24 * 140).tolist(), rng.uniform(0, 600, 24 * 140).tolist()
    cols = "datetime timestamp_ntz, temperature_2m double, shortwave_radiation double, cloud_cover double, precipitation double"
    return spark.createDataFrame([(T0 + dt.timedelta(hours=h), None if h % 97 in (5, 6) else t[h], r[h], 50.0, 0.0) for h in range(24 * days)], cols)


def test_a_recomputed_tail_equals_the_full_history(spark, tmp_path):
    at = lambda n: str(tmp_path / n)
    for days in (136, 137, 140):
        hourly(spark, days).write.parquet(at(f"h{days}"))
        ctx = Context(spark, at("w"), T0 + dt.timedelta(days=days), tables={"om_weather_hourly": spark.read.parquet(at(f"h{days}"))})
        grown = MODELS.run(ctx, ["om_weather_features"])["om_weather_features"]
    full = forecasts.om_weather_features(ctx, spark.read.parquet(at("h140")))
    a, b = (df.orderBy("datetime").toPandas() for df in (grown, full))
    assert list(a.columns) == list(b.columns) and (a["datetime"] == b["datetime"]).all() and len(a) == 24 * 140
    for c in a.columns[1:]:
        np.testing.assert_allclose(a[c].astype(float), b[c].astype(float), rtol=0, atol=1e-9, err_msg=c)
    bound = MODELS.models["om_weather_features"].reads["om_weather_hourly"].apply(Context(spark, "", T0, target=grown), spark.read.parquet(at("h140")))
    assert bound.count() == 48 + 1800 + 1 and "GreaterThanOrEqual(datetime" in bound._jdf.queryExecution().executedPlan().toString()
