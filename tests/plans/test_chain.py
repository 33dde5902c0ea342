"""All models as one chain, twice; later runs over growing sources against one full run; bounds that reach the scan."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import voltaria.plans  # noqa: F401
from voltaria.context import Context
from voltaria.registry import MODELS, Days, Since

from .raw import raw_tables

NOW = dt.datetime(2026, 7, 10, 12)

#: The columns of models, in order.
COLUMNS = {
    "mt_alerts": "identifier sender sent expires source status language headline category event urgency severity certainty description web contact area_desc area_polygon resource_uri msg_type scope",
    "mt_forecast_locations": "location_id name_it name_de name_en name_lld elevation_m latitude longitude venue_type forecast_url",
    "mt_forecasts_daily": "location_id forecast_at interval_minutes temperature_c temperature_max_c temperature_min_c rain_fall_mm fresh_snow_cm snow_level_m wind_speed_ms wind_gust_ms wind_direction_deg sky_condition freezing_level_m rain_probability_pct sunshine_duration_min",
    "mt_forecasts_hourly": "location_id forecast_at interval_minutes temperature_c rain_fall_mm fresh_snow_cm snow_level_m wind_speed_ms wind_gust_ms wind_direction_deg sky_condition freezing_level_m rain_probability_pct sunshine_duration_min",
    "mt_meteo_stations": "code name shortname elevation_m latitude longitude east north active_since active_until",
    "mt_sky_conditions": "id icon_day icon_night name_deu name_eng name_ita name_lld",
    "mt_station_observations": "station_code observed_at air_temperature_c precipitation_mm wind_speed_ms wind_direction_deg wind_gust_ms global_radiation_wm2 relative_humidity_pct snow_depth_cm",
    "mt_alerts_active": "identifier sent expires event severity urgency certainty headline description area_desc web source",
    "mt_forecast_daily": "location_id location_name_it location_name_en location_elevation_m latitude longitude forecast_at temperature_c temperature_max_c temperature_min_c rain_fall_mm fresh_snow_cm snow_level_m wind_speed_ms wind_gust_ms wind_direction_deg sky_condition freezing_level_m rain_probability_pct sunshine_duration_min",
    "mt_forecast_hourly": "location_id location_name_it location_name_en location_elevation_m latitude longitude forecast_at interval_minutes temperature_c rain_fall_mm fresh_snow_cm snow_level_m wind_speed_ms wind_gust_ms wind_direction_deg sky_condition freezing_level_m rain_probability_pct sunshine_duration_min",
    "mt_heat_daily_obs": "date lat lon elevation_m altitude_band temp_max_c latest_obs",
    "mt_observations_current": "station_code station_name station_shortname elevation_m latitude longitude observed_at air_temperature_c precipitation_mm wind_speed_ms wind_direction_deg wind_gust_ms global_radiation_wm2 relative_humidity_pct snow_depth_cm",
    "mt_stations": "code name shortname elevation_m latitude longitude active_since",
    "mt_weather_alerts": "provider location_id alert_id event severity urgency headline description starts_at expires_at source_name area_desc",
    "mt_weather_current": "provider station_id station_name lat lon elevation_m observed_at temperature_c humidity_pct wind_speed_ms wind_direction_deg wind_gust_ms precipitation_mm cloud_cover_pct sky_condition pressure_hpa",
    "mt_weather_forecast_daily": "provider location_id location_name lat lon elevation_m forecast_date temperature_c temperature_min_c temperature_max_c precipitation_mm precipitation_probability_pct wind_speed_ms wind_gust_ms wind_direction_deg cloud_cover_pct sky_condition snow_cm sunrise sunset",
    "mt_weather_forecast_hourly": "provider location_id location_name lat lon elevation_m forecast_at temperature_c humidity_pct wind_speed_ms wind_gust_ms wind_direction_deg precipitation_mm precipitation_probability_pct cloud_cover_pct sky_condition pressure_hpa snow_cm",
    "owm_weather_alerts": "synced_at lat lon location_id sender_name event start_ts end_ts description dt_lat_lon",
    "owm_weather_current": "synced_at lat lon timezone timezone_offset location_id ts temp humidity pressure uvi clouds wind_deg sunrise sunset weather_main weather_description dt_lat_lon",
    "owm_weather_daily": "synced_at lat lon location_id ts pop uvi rain clouds sunrise sunset humidity pressure wind_deg dew_point wind_gust temp_day temp_min temp_max temp_night temp_eve temp_morn feels_like_day feels_like_night feels_like_eve feels_like_morn weather_main weather_description summary moonrise moonset dt_lat_lon",
    "owm_weather_hourly": "synced_at lat lon location_id ts temp humidity pressure uvi clouds wind_deg weather_main weather_description dt_lat_lon",
    "owm_weather_minutely": "synced_at lat lon location_id dt precipitation dt_lat_lon",
    "folgaria_weather_current": "synced_at lat lon timezone timezone_offset location_id ts temp humidity pressure uvi clouds wind_deg sunrise sunset weather_main weather_description dt_lat_lon",
    "folgaria_weather_hourly": "synced_at lat lon location_id ts temp humidity pressure uvi clouds wind_deg weather_main weather_description dt_lat_lon",
    "rdf_weather_alerts": "alert_iri location_id foi_iri sender_name event description start_ts end_ts",
    "rdf_weather_feature_of_interest": "location_id lat lon foi_iri",
    "rdf_weather_observations_current": "observation_iri result_time location_id foi_iri timescale temp humidity pressure uvi clouds wind_deg weather_main weather_description",
    "rdf_weather_observations_hourly": "observation_iri result_time location_id foi_iri timescale temp humidity pressure uvi clouds wind_deg weather_main weather_description",
    "rdf_weather_observations_daily": "location_id result_time temp_day temp_min temp_max temp_night temp_eve temp_morn feels_like_day feels_like_night feels_like_eve feels_like_morn humidity pressure uvi rain clouds wind_deg wind_gust weather_description summary",
    "rdf_weather_observations_minutely": "observation_iri result_time location_id foi_iri timescale precipitation",
    "rdf_weather_observations_unpivoted": "observation_id location_id result_time property value unit",
    "weather_current": "location_id provider station_id station_name observed_at elevation_m temperature_c humidity_pct wind_speed_ms wind_direction_deg wind_gust_ms precipitation_mm cloud_cover_pct sky_condition pressure_hpa",
    "weather_forecast_daily": "location_id provider forecast_date elevation_m temperature_c temperature_min_c temperature_max_c precipitation_mm precipitation_probability_pct wind_speed_ms wind_gust_ms wind_direction_deg cloud_cover_pct sky_condition snow_cm sunrise sunset",
    "weather_forecast_hourly": "location_id provider forecast_at elevation_m temperature_c humidity_pct wind_speed_ms wind_gust_ms wind_direction_deg precipitation_mm precipitation_probability_pct cloud_cover_pct sky_condition pressure_hpa snow_cm",
    "stg_dwd_icon_d2": "run_time_utc interval_start_utc interval_end_utc step_range step_units lat lon name value level_type level ensemble centre data_type grid_type _sdc_filename _sdc_last_modified",
    "dwd_icon_d2_silver": "run_time_utc interval_start_utc interval_end_utc lat lon name value forecast_hour interval_hours valid_datetime_rome step_type prev_value prev_forecast_hour _sdc_last_modified",
    "dwd_icon_d2_gold": "run_time_utc forecast_hour valid_datetime_utc valid_datetime_rome lat lon temperature_2m shortwave_radiation cloud_cover precipitation",
    "dwd_icon_d2_wind": "run_time_utc interval_start_utc interval_end_utc lat lon u10 v10 i10fg wind_speed _sdc_last_modified",
    "dwd_icon_d2_gusts": "run_time_utc date lat lon geoposition wind_speed_max i10fg_max gust_excess gust_excess_tier _sdc_last_modified",
    "dwd_icon_d2_solar_forecast_interval": "run_time_utc interval_start_utc interval_end_utc lat lon name value interval_hours _sdc_last_modified",
    "dwd_icon_d2_solar_energy": "provider run_time_utc interval_end_utc lat lon geog solar_energy_kwh_per_m2",
    "copernicus_era5_single_levels": "record_id datetime_utc latitude longitude level_type level variable_name value forecast_step data_type date_day hour_utc",
    "copernicus_era5_analysis": "record_id datetime_utc latitude longitude level_type level variable_name value forecast_step data_type date_day hour_utc",
    "copernicus_cams_global_reanalysis_eac4_monthly": "record_id datetime_utc latitude longitude level_type level variable_name value forecast_step data_type date_month hour_utc",
    "copernicus_solar_radiation": "datetime_utc toa clear_sky_ghi clear_sky_bhi clear_sky_dhi clear_sky_bni ghi bhi dhi bni reliability date_day hour_utc ghi_clearness_index",
    "copernicus_weather_features": "datetime shortwave_radiation temperature_2m clearsky_index is_daylight heating_degree cooling_degree",
    "meters_data_15m": "_id device_id ts consumption_kwh production_kwh self_consumed_kwh",
    "meters_data_1h": "_id device_id ts consumption_kwh production_kwh",
    "meters_data_15m_missing_intervals": "event_id device_id ts hour created_at",
    "meters_measurements_15m": "observation_id result_time device_id rec_id substation_id feature_iri sensor_iri observed_property value unit",
    "silver_rec_registry": "user_id rec_id area role member_type substation_id sensor_id last_updated",
    "silver_gse_cabine_primarie": "fid geometry cod_ac rag_soc cod_conseg shape__area shape__length objectid p_cab_pri t_cab_pri txt1 txt2 last_updated_at _sdc_filename _sdc_deleted_at",
    "gse_cabine_primarie": "geometry rag_soc cod_ac cod_conseg shape__area shape__length last_updated_at",
    "rec_virtual_consumption_15m": "ts rec_id substation_id total_consumption_kwh total_production_kwh self_consumption_kwh self_consumption_ratio",
    "rec_virtual_consumption_hourly": "ts rec_id substation_id total_consumption_kwh total_production_kwh self_consumption_kwh self_consumption_ratio",
    "rec_virtual_consumption_per_device_15m": "_id ts device_id rec_id substation_id consumption_kwh ratio virtual_consumption_kwh",
    "rec_virtual_consumption_per_device_hourly": "_id ts device_id rec_id substation_id consumption_kwh virtual_consumption_kwh ratio",
    "rec_measurements_15m": "observation_id result_time device_id rec_id substation_id feature_iri sensor_iri observed_property value unit",
    "rec_measurements_per_device_15m": "observation_id result_time device_id rec_id substation_id feature_iri sensor_iri observed_property value unit",
    "rec_meters_15m": "_id device_id ts consumption_kwh production_kwh pv_production_kwh self_consumed_kwh total_consumption_kwh",
    "silver_flexibility_commitments": "commitment_id user_id suggestion_id suggestion_type community_id device_id period_start period_end committed_at settled_at reminded_at status reward_points_estimated reward_points_actual window_duration_hours last_updated",
    "rec_settlement_15m": "_id ts device_id consumption_kwh grid_import_kwh grid_export_kwh total_consumption_kwh window_start window_end ts_date window_estimated_kwh window_reward_points_estimated",
    "rec_settlement_1h": "_id ts device_id consumption_kwh window_start window_end ts_date window_estimated_kwh",
    "rec_flexibility_windows_community": "_id ts_date window_start window_end community_kwh confidence flexibility_model",
    "rec_flexibility_windows": "_id device_id ts_date window_start window_end community_kwh estimated_kwh reward_points_estimated confidence flexibility_model",
    "rec_participant_points": "_id device_id ts_date season_start daily_consumption_kwh daily_settlement_points daily_bonus_points daily_points",
    "rec_points_leaderboard": "_id device_id season_start season_end season_base_points season_bonus_points season_points season_rank total_members alltime_base_points alltime_bonus_points is_current_season",
    "rec_gamification_summary": "_id device_id ts_date total_consumption_kwh total_allocated_kwh committed percentile_rank rank_position total_members",
    "rec_anti_gaming_flags": "_id device_id flag_date flag_type metric_value threshold_value severity",
    "rec_co2_savings": "_id device_id ts_date consumption_kwh co2_avoided_kg trees_equivalent",
    "rec_co2_savings_community": "ts_date consumption_kwh co2_avoided_kg trees_equivalent participating_devices",
    "openstreetmap_fi_lappeenranta_base": "osm_id element geometry _sdc_extracted_at name amenity social_facility operator addr_city addr_street addr_postcode phone website start_date geom_geojson",
    "openstreetmap_it_alpecimbra_base": "osm_id element geometry _sdc_extracted_at piste_type aerialway tourism amenity leisure heritage name geom_geojson",
    "pv_overture_buildings": "building_id geometry _sdc_extracted_at building_class building_subtype height num_floors footprint_area_m2 geom_geojson",
    "pv_building_suitability": "building_id geometry building_class building_subtype height num_floors footprint_area_m2 _sdc_extracted_at geom_geojson",
    "pv_aree_non_idonee": "id geometry _sdc_extracted_at nome tipo area_m2 geom_geojson polygons",
    "pv_vincoli_diretti": "id geometry _sdc_extracted_at denominazione tipo_vincolo area_m2 geom_geojson polygons",
    "pv_vincoli_indiretti": "id geometry _sdc_extracted_at denominazione tipo_vincolo area_m2 geom_geojson polygons",
    "pv_detections": "building_id has_pv confidence model_name lon lat detected_at",
    "pv_detected_installations": "building_id geometry has_pv confidence model_name detected_at building_class building_subtype height num_floors footprint_area_m2",
    "pv_roi_estimates": "building_id kwp capex annual_production_kwh annual_consumption_kwh user_type regime npv irr payback_simple payback_discounted tasso_autoconsumo estimated_at",
    "rec_building_cabina": "building_id cod_ac rag_soc",
}
#: Written models that have no rows for these sources: no table, no such features, no spikes.
EMPTY = {"copernicus_cams_global_reanalysis_eac4_monthly", "openstreetmap_it_alpecimbra_amusement", "openstreetmap_it_alpecimbra_ev_charging", "openstreetmap_it_alpecimbra_piste_and_lifts", "openstreetmap_it_alpecimbra_tourism_culture", "rec_anti_gaming_flags"}


@pytest.fixture
def few_partitions(spark):
    name = "spark.sql.shuffle.partitions"
    before = spark.conf.get(name)
    spark.conf.set(name, "2")
    yield
    spark.conf.set(name, before)


def test_all_models_run_as_a_chain_and_again(spark, tmp_path, few_partitions):
    tables = raw_tables(spark, NOW, NOW - dt.timedelta(days=2))
    out = MODELS.run(Context(spark, str(tmp_path), NOW, tables=dict(tables)))
    assert set(out) == set(MODELS.models)
    assert {n: " ".join(df.columns) for n, df in out.items() if n in COLUMNS} == COLUMNS
    counts = {n: out[n].count() for n in out if MODELS.models[n].kind != "view"}
    assert {n for n, c in counts.items() if not c} == EMPTY
    kept = [n for n, m in MODELS.models.items() if m.kind not in ("view", "table")]
    again = MODELS.run(Context(spark, str(tmp_path), NOW, tables=dict(tables)), kept)
    assert {n: again[n].count() for n in kept} == {n: counts[n] for n in kept}
    at = {r.station_code: r.wind_direction_deg for r in out["mt_observations_current"].collect()}
    assert set(at) == {"T1", "T3"}  # not the station that is gone
    assert {r.gust_excess_tier for r in out["dwd_icon_d2_gusts"].collect()} == {"ALERT"}  # 20 against 5
    assert {r.sky_condition for r in out["mt_weather_forecast_hourly"].collect()} == {"Sunny"}
    assert out["owm_weather_alerts"].select("dt_lat_lon").distinct().count() == out["owm_weather_alerts"].count() == 2  # two ends of one start
    assert {(r.property, r.value, r.unit) for r in out["rdf_weather_observations_unpivoted"].filter("property IN ('Humidity', 'Temperature')").collect()} == {("Humidity", "60", "unit:Percent"), ("Humidity", "50", "unit:Percent"), ("Temperature", "12.5", "unit:DegreeCelsius")}


#: Models whose rows follow from all rows of their sources, whenever they came.
GROWING = [
    "meters_data_15m", "meters_data_1h", "rec_virtual_consumption_15m", "rec_virtual_consumption_hourly", "rec_virtual_consumption_per_device_15m", "rec_virtual_consumption_per_device_hourly", "dwd_icon_d2_silver", "dwd_icon_d2_gold",
    "stg_om_weather", "om_weather_hourly", "om_wind_hourly", "om_heat_daily", "om_heat_risk", "om_obs_15min", "copernicus_era5_single_levels", "copernicus_era5_analysis", "copernicus_solar_radiation", "copernicus_weather_features",
    "mt_station_observations", "mt_heat_daily_obs", "pv_overture_buildings", "pv_detections", "pv_detected_installations",
]


def test_runs_over_growing_sources_equal_one_full_run(spark, tmp_path, few_partitions):
    first = NOW - dt.timedelta(days=10)
    names = MODELS.needed(GROWING)
    for back in (8, 1, 0):
        now = NOW - dt.timedelta(days=back)
        ctx = Context(spark, str(tmp_path / "grown"), now, tables=raw_tables(spark, now, first))
        grown = MODELS.run(ctx, [n for n in MODELS.order() if n in names])
    full = MODELS.run(Context(spark, str(tmp_path / "full"), NOW, tables=raw_tables(spark, NOW, first)), [n for n in MODELS.order() if n in names])
    for n in GROWING:
        cols = [F.round(c, 9).alias(c) if kind == "double" else F.to_json(F.struct(c)).alias(c) if kind.startswith("struct") else F.col(c) for c, kind in full[n].dtypes]
        a, b = grown[n].select(*cols), full[n].select(*cols)
        assert a.count() == b.count() and a.exceptAll(b).isEmpty(), n


def test_bounds_reach_the_scan(spark, tmp_path, few_partitions):
    slots = [(NOW - dt.timedelta(hours=h), float(h)) for h in range(48)]
    spark.createDataFrame(slots, "ts timestamp_ntz, v double").write.parquet(str(tmp_path / "x"))
    df = spark.read.parquet(str(tmp_path / "x"))
    ctx = Context(spark, str(tmp_path), NOW, target=df.filter(F.col("ts") <= NOW - dt.timedelta(hours=3)))
    for bound, n in ((Since("ts"), 4), (Since("ts", strict=True), 3), (Since("ts", back="1 HOUR"), 5), (Days("ts", 1), 37)):
        rows = bound.apply(ctx, df)
        pushed = rows._jdf.queryExecution().executedPlan().toString().split("PushedFilters: [")[1].split("]")[0]
        assert rows.count() == n and "GreaterThan" in pushed, bound


def test_a_withdrawn_commitment_takes_its_bonus_along(spark, tmp_path, few_partitions):
    tables = raw_tables(spark, NOW, NOW - dt.timedelta(days=2))
    names = [n for n in MODELS.order() if n in MODELS.needed(["rec_flexibility_bonus"])]
    window = spark.createDataFrame([("w", "a", NOW.date(), NOW.replace(hour=9), NOW, 2.0, 1.0, 5, None, "x")], "_id string, device_id string, ts_date date, window_start timestamp_ntz, window_end timestamp_ntz, community_kwh double, estimated_kwh double, reward_points_estimated int, confidence double, flexibility_model string")
    run = [n for n in names if n != "rec_flexibility_windows" and n != "rec_flexibility_windows_community"]
    out = MODELS.run(Context(spark, str(tmp_path), NOW, tables=tables | {"rec_flexibility_windows": window}), run)
    assert out["rec_flexibility_bonus"].count() == 1
    gone = tables["flexibility_commitments_mirror"].withColumn("status", F.lit("Status.cancelled"))
    out = MODELS.run(Context(spark, str(tmp_path), NOW, tables=tables | {"rec_flexibility_windows": window, "flexibility_commitments_mirror": gone}), run)
    assert out["rec_flexibility_bonus"].count() == 0
