"""Hand-computed cases."""

import math

import pytest
from pyspark.sql import functions as F

from aeroskein.functions import coerce, domain, geo, scales
from aeroskein.operators import compare, inventory, observed, profiles, training, validation


def layers(spark, rows):
    return spark.createDataFrame(rows, "radar string, pulse string, ts string, height double, dens double, ff double, dd double, dbzh double, gap boolean").withColumn("ts", F.col("ts").cast("timestamp"))


def night(spark, dbzh=None, bins=2):
    """Two profiles ten minutes apart, densities 10 and 20 at 200 m and 400 m."""
    return layers(spark, [("a", "lp", f"2025-07-14 22:{m}:00", 200.0 * (i + 1), 10.0 * (i + 1), 10.0, 90.0, dbzh, False) for m in ("00", "10") for i in range(bins)])


def test_rate_direction_and_night_traffic(spark):
    p = profiles.integrate_profiles(night(spark))
    assert [round(r["mtr_birds_km_h"], 6) for r in p.collect()] == [216.0, 216.0]
    n = observed.night_metrics(p).first()
    assert (n["migration_traffic_birds_per_km"], n["dominant_direction_deg"], n["integrated_interval_count"]) == (36.0, 90.0, 1)
    assert n["coverage_fraction"] is None and n["quality_class"] == "partial" and n["intensity_class"] == "moderate"


def test_rain_leaves_nothing_to_integrate(spark):
    p = profiles.integrate_profiles(night(spark, dbzh=20.0, bins=5))
    assert all(r["rain_suspect"] and r["mtr_birds_km_h"] is None and r["vid_birds_per_km2"] > 0 for r in p.collect())
    assert observed.integrable_nights(observed.night_metrics(p)).count() == 0


def test_no_density_means_no_rate_even_in_rain(spark):
    rows = night(spark, dbzh=20.0, bins=5).withColumn("dens", F.lit(0.0))
    assert [r["mtr_birds_km_h"] for r in profiles.integrate_profiles(rows).collect()] == [0.0, 0.0]


def test_summary_profiles_integrate_too(spark):
    raw = spark.createDataFrame([("a", "2025-07-14 22:00:00", "unknown", 0, None, "12.5"), ("a", "2025-07-14 22:10:00", "unknown", 0, "NA", "7.5")], "radar string, ts string, pulse string, row_order int, dens string, mtr string").withColumn("ts", F.col("ts").cast("timestamp"))
    s = profiles.summary_profiles(raw).withColumns({"night_date": F.lit("2025-07-14").cast("date"), "rain_suspect": F.lit(False)})
    n = observed.night_metrics(s).first()
    assert (n["migration_traffic_birds_per_km"], n["mean_mtr_birds_km_h"]) == (1.666667, 10.0)


def test_gap_of_more_than_thirty_minutes_breaks_the_integral(spark):
    rows = layers(spark, [("a", "lp", t, 200.0, 10.0, 10.0, 90.0, None, False) for t in ("2025-07-14 22:00:00", "2025-07-14 22:30:00", "2025-07-14 23:01:00")])
    assert observed.night_metrics(profiles.integrate_profiles(rows)).first()["integrated_interval_count"] == 1


@pytest.mark.parametrize("parts", [1, 5])
def test_layout_does_not_change_a_night(spark, parts):
    a = observed.night_metrics(profiles.integrate_profiles(night(spark).repartition(parts))).collect()
    assert a == observed.night_metrics(profiles.integrate_profiles(night(spark))).collect()


def test_errors_of_two_archives(spark):
    pairs = spark.createDataFrame([("dens", 3.0, 2.0), ("dens", 5.0, 4.0)], "variable string, a double, b double")
    r = compare.error_metrics(pairs, ["variable"]).first()
    assert (abs(r["bias"]), r["mae"], r["rmse"]) == (1.0, 1.0, 1.0)


def test_correlation_without_spread_is_null_or_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 3.0)], "a double, b double")
    assert df.agg(compare.safe_corr("a", "b").alias("c"), validation.pearson("a", "b").alias("p")).first() == (None, 0.0)


def metrics(spark, rmse, share):
    rows = [("leave_one_radar_out", p, t, rmse, share, share) for p in ("lp", "sp") for t in ("mtr_birds_km_h", "vid_birds_per_km2", "bird_u_ms", "bird_v_ms")]
    return spark.createDataFrame(rows, "validation string, pulse string, target string, rmse double, top_decile_precision double, top_decile_recall double")


@pytest.mark.parametrize(("rmse", "share", "selected"), [(8.5, 0.85, "challenger"), (9.5, 0.85, "baseline"), (8.5, 0.7, "baseline")])
def test_challenger(spark, rmse, share, selected):
    row = validation.select_model_family(metrics(spark, 10.0, 0.8), metrics(spark, rmse, share)).first()
    assert row["selected"] == selected and row["temporal_required"] is False


def test_missing_row_is_no_promotion(spark):
    challenger = metrics(spark, 8.5, 0.85).where("not (pulse = 'sp' and target = 'vid_birds_per_km2')")
    base = metrics(spark, 10.0, 0.8)
    assert validation.select_model_family(base, challenger).first()["selected"] == "baseline"
    reasons = {(r["pulse"], r["target"]): r["reason"] for r in validation.family_checks(base, challenger).where("validation = 'leave_one_radar_out'").collect()}
    assert reasons == {("lp", "mtr_birds_km_h"): None, ("lp", "vid_birds_per_km2"): None, ("sp", "mtr_birds_km_h"): None, ("sp", "vid_birds_per_km2"): "missing_metrics"}


def test_blocked_times_count_where_there_are_any(spark):
    blocked = lambda rmse: metrics(spark, rmse, 0.85).withColumn("validation", F.lit("blocked_time"))
    base, challenger = metrics(spark, 10.0, 0.8), metrics(spark, 8.5, 0.85)
    said = lambda b, c: validation.select_model_family(b, c).first()["selected"]
    assert said(base.union(blocked(10.0)), challenger.union(blocked(8.0))) == "challenger"
    assert said(base.union(blocked(10.0)), challenger.union(blocked(9.8))) == "baseline" and said(base, challenger.union(blocked(8.0))) == "baseline"
    # vectors are judged on held-out radars only
    worse = blocked(8.0).withColumn("rmse", F.when(F.col("target").isin("bird_u_ms", "bird_v_ms"), 99.0).otherwise(F.col("rmse")))
    assert said(base.union(blocked(10.0)), challenger.union(worse)) == "challenger"
    bad = challenger.withColumn("rmse", F.when(F.col("target") == "bird_u_ms", 10.21).otherwise(F.col("rmse")))
    assert said(base, bad) == "baseline"


def test_the_gate_leaves_the_short_pulse_s_density_out(spark):
    rows = [("lp", "mtr_birds_km_h", 0.0), ("lp", "vid_birds_per_km2", -0.01), ("sp", "mtr_birds_km_h", 0.1), ("sp", "vid_birds_per_km2", -5.0), ("lp", "bird_u_ms", 0.03), ("lp", "bird_v_ms", 0.01), ("sp", "bird_u_ms", -1.0)]
    r = validation.candidate_gate(spark.createDataFrame(rows, "pulse string, target string, d_r_squared double")).first()
    assert (r["worst_intensity"], round(r["mean_vector_gain"], 9), r["accept"]) == (-0.01, 0.02, True)
    assert validation.candidate_gate(spark.createDataFrame([], "pulse string, target string, d_r_squared double")).first()["accept"] is False


def targets(spark, last, was, **more):
    date = lambda df, c: df.withColumn(c, F.col(c).cast("date"))
    catalog = date(spark.createDataFrame([("a", last)], "radar string, last_date string"), "last_date")
    cursor = date(spark.createDataFrame([("a", was)] if was else [], "radar string, source_date string"), "source_date")
    return inventory.incremental_targets(catalog, cursor, **more)


@pytest.mark.parametrize(("last", "was", "days"), [
    ("2026-07-14", None, ["2026-07-12", "2026-07-13", "2026-07-14"]), ("2026-07-14", "2026-07-14", ["2026-07-13", "2026-07-14"]), ("2026-07-14", "2026-07-13", ["2026-07-13", "2026-07-14"]),
    ("2026-07-14", "2026-07-01", [f"2026-07-{k:02d}" for k in range(1, 9)]), ("2026-07-14", "2026-07-15", []),
])
def test_days_to_read(spark, last, was, days):
    """A lookback of two days reads three; a cursor far behind moves on by seven days and skips none."""
    t = targets(spark, last, was, lookback=2)
    assert sorted(str(r["day"]) for r in inventory.target_days(t).collect()) == days


def test_cursor_after_a_run(spark):
    t = targets(spark, "2026-07-14", "2026-07-01")
    objects = spark.createDataFrame([("a", f"2026-07-{k:02d}", p, f"{p}{k}", "e") for k in (7, 8) for p in ("lp", "sp")], "radar string, day string, pulse string, key string, etag string").withColumn("day", F.col("day").cast("date"))
    r = inventory.catch_up_status(t, objects, objects.limit(0).select("key", "etag")).first()
    assert (str(r["proposed_source_date"]), str(r["latest_complete_night"]), r["selected_file_count"], r["missing_target"], r["changed"]) == ("2026-07-08", "2026-07-07", 2, False, True)
    same = inventory.catch_up_status(targets(spark, "2026-07-08", "2026-07-08"), objects, objects.select("key", "etag"))
    assert same.first()["changed"] is False and inventory.run_status(same).first()["no_change"] is True
    lost = inventory.catch_up_status(targets(spark, "2026-07-14", "2026-07-14"), objects, objects.select("key", "etag"))
    assert inventory.run_status(lost).first().asDict() == {"ok": False, "no_change": False, "changed_radars": 0, "files": 0}


def test_rows_of_one_time_all_find_their_partner(spark):
    left = spark.createDataFrame([("a", "2025-07-14 00:02:00", p) for p in ("lp", "sp")] + [("a", "2025-07-14 00:02:00", "lp")], "radar string, ts string, pulse string").withColumn("ts", F.col("ts").cast("timestamp"))
    right = left.limit(1).select("radar", (F.col("ts") + F.expr("interval 1 minute")).alias("ts"))
    assert [r["offset_s"] for r in compare.asof_nearest(left, right).collect()] == [-60.0] * 3


def test_reports_agree_in_source_and_in_name_whatever_its_case(spark):
    crosswalk = spark.createDataFrame([("ukone", "bejab", "baltrad"), ("uktwo", "frabb", "baltrad")], "radar string, other string, source string")
    reports = spark.createDataFrame([("UKONE", "BEJAB", "baltrad", "2025-01-01", 1, 20), ("ukone", "bejab", "uva", "2025-02-01", 2, 30), ("uktwo", "frabb", "uva", "2025-02-01", 3, 9)], "radar string, other string, source string, generated_at string, order int, levels int")
    got = {r["radar"]: (r["report_available"], r["levels"]) for r in compare.comparison_index(crosswalk, reports).collect()}
    assert got == {"ukone": (True, 20), "uktwo": (False, None)}


def test_revisions_are_told_by_time_not_by_etag(spark):
    from aeroskein.streaming.archive import current_rows

    rows = [("k", "zz9", "2025-07-01", 0, 1), ("k", "aa1", "2025-07-02", 1, 2), ("late", "b", "2025-07-02", 0, 3), ("late", "c", "2025-07-01", 1, 4), ("twice", "x", "2025-07-01", 0, 5), ("twice", "w", "2025-07-01", 1, 6)]
    got = current_rows(spark.createDataFrame(rows, "key string, etag string, modified string, batch int, size int")).collect()
    assert {r["key"]: r["size"] for r in got} == {"k": 2, "late": 3, "twice": 6}


def test_an_empty_release_has_a_problem(spark):
    from aeroskein.sources.writers import release_problems

    none = spark.createDataFrame([], "asset string")
    assert [r["problem"] for r in release_problems(none, none.withColumnRenamed("asset", "key"), F.lit(False)).collect()] == ["no_data"]


def test_a_week_that_is_no_date_is_an_error(spark):
    from aeroskein.sources.readers import region_weeks

    raw = spark.createDataFrame([("a", "2025-01-06", "1"), ("", "soon", "1"), ("b", "soon", None), ("c", None, "2")], "region string, week_start string, rate string")
    assert region_weeks(raw, "rate").count() == 1
    with pytest.raises(Exception, match="ISO"):
        region_weeks(raw.union(spark.createDataFrame([("a", "soon", "1")], raw.schema)), "rate").collect()


def test_a_month_without_rows(spark):
    from aeroskein.operators.historical import seasonal_climatology

    rows = spark.createDataFrame([("2025-03-01", 1.0), ("2025-03-02", 3.0), ("2025-04-01", 0.001), ("2025-05-01", None)], "hour string, mean_vid_birds_per_km2 double").withColumn("hour", F.col("hour").cast("timestamp"))
    got = {r["month"]: r["vid"] for r in seasonal_climatology(rows).collect()}
    assert got == {m: 0.25 for m in range(1, 13)} | {3: 3.0, 4: 0.02}


def test_nearest_profile_within_the_day_and_tolerance(spark):
    at = lambda *t: spark.createDataFrame([("a", x) for x in t], "radar string, ts string").withColumn("ts", F.col("ts").cast("timestamp"))
    got = compare.asof_nearest(at("2025-07-14 00:02:00", "2025-07-14 12:00:00", "2025-07-14 18:00:00"), at("2025-07-13 23:59:00", "2025-07-14 00:05:00", "2025-07-14 11:55:00", "2025-07-14 12:05:00", "2025-07-14 18:05:01")).collect()
    assert sorted((str(r["ts"])[11:16], str(r["ts_r"])[11:16]) for r in got) == [("00:02", "00:05"), ("12:00", "11:55")]


def test_numbers_and_flags(spark):
    df = spark.createDataFrame([("NA", " 4.5 "), ("inf", "x"), ("", None), ("7", "8")], "a string, b string")
    assert [r[0] for r in df.select(coerce.num(F.col("a"), F.col("b"))).collect()] == [4.5, None, None, 7.0]
    flags = spark.createDataFrame([("TRUE",), ("f",), ("?",), (None,)], "a string").select(coerce.bool_token(F.col("a"))).collect()
    assert [r[0] for r in flags] == [True, False, None, None]


def test_projection_of_known_points(spark):
    """Origin of the projection, and a point computed with the published formulas."""
    df = spark.createDataFrame([(10.0, 52.0), (5.0, 50.0)], "lon double, lat double")
    x, y = geo.project_laea(F.col("lon"), F.col("lat"))
    (x0, y0), (x1, y1) = df.select(x, y).collect()
    assert (round(x0, 3), round(y0, 3)) == (4321000.0, 3210000.0)
    assert abs(x1 - 3962799.45) < 1 and abs(y1 - 2999718.85) < 1


def test_scales(spark):
    df = spark.createDataFrame([(0.3, 47.0), (2.0, 1000.0)], "a double, b double")
    got = df.select(scales.nice_floor(F.col("a")), scales.nice_ceil(F.col("b")), scales.log_ticks(F.lit(1.0), F.lit(10.0))).collect()
    assert [(round(r[0], 6), r[1], r[2]) for r in got] == [(0.2, 50.0, [1.0, 2.0, 5.0, 10.0]), (2.0, 1000.0, [1.0, 2.0, 5.0, 10.0])]


def test_hole_is_outside(spark):
    ring = lambda a, b: F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in ((a, a), (b, a), (b, b), (a, b))])
    df = spark.createDataFrame([(1.0, 1.0), (5.0, 5.0), (11.0, 5.0)], "x double, y double")
    assert [r[0] for r in df.select(geo.point_in_polygons(F.col("x"), F.col("y"), F.array(F.array(ring(0, 10), ring(4, 6))))).collect()] == [True, False, False]


def test_ages(spark):
    df = spark.createDataFrame([(-1.0,), (6.0,), (6.1,), (24.0,), (25.0,)], "a double")
    assert [r[0] for r in df.select(domain.age_mode(F.col("a"))).collect()] == ["assimilated", "assimilated", "propagated", "propagated", "weather_only"]


def test_long_pulse_first(spark):
    o = spark.createDataFrame([("a", "2025-07-14", "sp", "k1"), ("a", "2025-07-14", "lp", "k2"), ("b", "2025-07-14", "sp", "k3")], "radar string, day string, pulse string, key string")
    assert {r["radar"]: (r["pulse"], r["available_pulses"]) for r in inventory.prefer_lp(o).collect()} == {"a": ("lp", ["lp", "sp"]), "b": ("sp", ["sp"])}


def test_unknown_optional_feature_is_refused(spark):
    with pytest.raises(ValueError, match="unknown"):
        training.weather_features(spark.range(1), ("snow",))


def test_empty_input_gives_empty_output(spark):
    none = night(spark).limit(0)
    p = profiles.integrate_profiles(none)
    assert p.count() == 0 and observed.hourly_rows(p).count() == 0 and observed.night_metrics(p).count() == 0
    assert not math.isnan(0.0)
