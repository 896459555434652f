"""Registered queries against their SQL on the smallest tables."""

import decimal
import math
import os

import duckdb
import pytest

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events".split()
#: One or more of each family.
NAMES = """a1_integrate_profiles a4_hourly_rows a5_external_hourly a7_night_metrics a8_expected_night_window w1_trapezoid_integral w3_merge_latest_nights f3_rain_suspect p1_num_aliases p7_night_date
p20_month_periods j4_merge_weather_datasets j1_join_observed_weather j2_unmatched_observed j9_nearest_grid_cell j11_support_score j20_merge_grid_weather a36_validate_weather_day s3_parse_object_key
j18_expected_vs_available d1_prefer_lp d3_incremental_target_window d3_catch_up_status d3_run_status j19_detect_changed_radars j7_asof_nearest_join j7_asof_repeated_rows a13_pair_statistics j15_build_crosswalk j16_comparison_index a14_score_regression
a15_pooled_and_per_site w4_average_rank a18_peak_timing_error a19_top_overlap w6_blocked_time_split m13_select_model_family m13_validated_choice m9_leave_one_radar_out m5_cyclic_smooths m8_radar_effect m13_family_checks m14_candidate_gate m4_additive_plane m6_interaction_plane m17_offset_plane m15_component_selection a11_percentile_range a32_frames_from_long
a33_nest_frames a29_colour_scale_stats p22_log_ticks a46_detail_profile_metrics a47_time_height_matrix a25_phenology_median_doy a27_radar_day_aggregate k1_write_night_archive t1_stream_profiles
t2_hourly_tumbling t3_complete_night_emission p13_boundary_join a13_median_offset j15_unmatched_radars o5_every_nth_cell w5_top_fraction_flag t6_late_data_replace t8_day_watermark s2_read_vpts_archive s14_read_metrics k5_write_daily_frames k10_artifact_inventory a40_seasonal_climatology j13_match_site_hour_cell j21_kernel_grid a12_error_metrics""".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{DATA}/{t}.parquet"
        con.sql(f"create view {t} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return con


def plain(x):
    if isinstance(x, decimal.Decimal):
        return float(x)
    if isinstance(x, float) and math.isnan(x):
        return None
    return x


def rows(data, columns):
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    return sorted((tuple(plain(r[i]) for i in at) for r in data), key=repr)


@pytest.mark.parametrize("name", NAMES)
def test_query_says_what_sql_says(spark, sql, name):
    import __spark_entry__ as entry

    df = entry.queries()[name](spark, DATA)
    got = sql.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in got.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows([tuple(r) for r in df.collect()], df.columns) == rows(got.fetchall(), columns)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0


def test_every_query_can_be_called():
    import __spark_entry__ as entry

    assert set(entry.oracle_sql()) <= set(entry.queries()) and all(map(callable, entry.queries().values()))
