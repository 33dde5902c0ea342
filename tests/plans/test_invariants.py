"""Data tests find what breaks them; retention drops what is old."""

import datetime as dt

from pyspark.sql import functions as F

from voltaria.context import Context
from voltaria.materialize import Table
from voltaria.plans import invariants, retention

T0 = dt.datetime(2026, 5, 28)


def test_rules_find_their_rows(spark):
    df = lambda schema, *rows: spark.createDataFrame(list(rows), schema)
    tables = {
        "meters_data_15m": df("_id string, device_id string, ts timestamp_ntz, consumption_kwh double, production_kwh double", *((str(k), "a", T0 + dt.timedelta(minutes=15 * k), 1.0, 0.0) for k in range(4)), ("9", "a", T0 + dt.timedelta(hours=3, minutes=7), -1.0, 0.0)),
        "meters_data_1h": df("_id string, device_id string, ts timestamp_ntz, consumption_kwh double", ("1", "a", T0, 5.0), ("1", "a", T0 + dt.timedelta(hours=3), 9.0)),
        "rec_flexibility_windows_community": df("ts_date date, confidence double", (T0.date(), None), (T0.date(), 0.5), (T0.date(), 0.99)),
        "rec_commitment_settlement": df("commitment_id string, status string, period_start timestamp_ntz, period_end timestamp_ntz, allocated_kwh double", ("c", "settled", T0, T0, 3.0)),
        "rec_flexibility_windows": df("ts_date date, window_start timestamp_ntz, window_end timestamp_ntz, community_kwh double, estimated_kwh double, reward_points_estimated int", (T0.date(), T0, T0, 2.0, 1.0, 1)),
        "mt_station_observations": df("station_code string, observed_at timestamp, temperature_c double", ("s", T0, 10.0), ("s", T0, None), ("s", T0 + dt.timedelta(hours=1), 99.0)),
        "mt_forecasts_hourly": df("location_id string, forecast_at timestamp, humidity_pct double", ("p", T0, 101.0)),
    }
    got = invariants.run_tests(tables)
    assert got["meters_data_15m_grid_flows_non_negative"] == 1 and got["meters_data_15m_slots_are_quarter_aligned"] == 1
    assert got["meters_data_1h_matches_15m_rollup"] == 1 and got["unique:meters_data_1h"] == 1 and got["unique:meters_data_15m"] == 0
    assert got["confidence_within_bounds"] == 1 and got["commitment_allocation_within_budget"] == 1
    assert got["mt_observations_one_row_per_station_and_instant"] == 1 and got["mt_measures_within_physical_range"] == 2
    assert "settlement_points_non_negative" not in got and len(invariants.TESTS) == 20


def test_retention(spark, tmp_path):
    ctx = Context(spark, str(tmp_path), T0)
    rows = spark.createDataFrame([(T0 - dt.timedelta(days=k),) for k in range(5)], "_sdc_extracted_at timestamp_ntz")
    t = Table(spark, ctx.path("raw", "om_wind"))
    t.overwrite(rows)
    assert retention.clean(ctx, "cleanup_om_wind") == 2 and t.read().count() == 3
    assert retention.clean(ctx, "cleanup_om_obs") == 0 and retention.clean(ctx, "cleanup_mt_observations") == 0
    f = Table(spark, ctx.path("gold", "f"))
    f.overwrite(rows.withColumnRenamed("_sdc_extracted_at", "valid_datetime_utc").withColumn("valid_datetime_utc", F.col("valid_datetime_utc") + F.expr("INTERVAL 2 DAYS")))
    assert retention.expired_forecasts(ctx, "gold", "f") == 2
