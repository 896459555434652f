"""Queries over training tables, models, frames, detail views and the historical package."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroskein.functions import domain, scales
from aeroskein.functions.coerce import iso
from aeroskein.operators import detail as X
from aeroskein.operators import frames as R
from aeroskein.operators import historical as H
from aeroskein.operators import models as M
from aeroskein.operators import training as T
from aeroskein.operators import weather as W
from aeroskein.plans import derived as D
from aeroskein.plans.registry import TABLES, query
from aeroskein.sources.scratch import scratch_path

HOUR = "strftime(hour, '%Y-%m-%dT%H:%M:%SZ')"
WINDOW = 5


def joined(spark, d):
    weather = W.merge_weather_datasets(D.weather_site(spark, d))
    return W.join_observed_weather(D.hourly(spark, d), weather).join(D.radars(spark, d).select("radar", "latitude", "longitude"), "radar")


TABLES["joined_rows"] = "select h.*, w.* exclude (radar, hour), r.latitude, r.longitude from hourly h join weather w using (radar, hour) join radars r using (radar)"
TABLES["qc_rows"] = "select * from joined_rows where usable_mtr_profile_count >= 3 and rain_suspect_fraction <= 0.5 and mean_mtr_birds_km_h is not null and mean_vid_birds_per_km2 is not null"
TABLES["full_days"] = "select cast(hour as date) as day from qc_rows group by 1 having count(distinct date_part('hour', hour)) = 24"
TABLES["training"] = f"select *, mean_ground_speed_ms * sin(radians(dominant_direction_deg)) as u, mean_ground_speed_ms * cos(radians(dominant_direction_deg)) as v from qc_rows where cast(hour as date) between (select max(day) from full_days) - {WINDOW - 1} and (select max(day) from full_days)"



@query("f6_training_qc", f"select radar, pulse, {HOUR} as hour from qc_rows")
def f6(spark, d):
    return T.quality_control(joined(spark, d)).select("radar", F.col("observed_pulse").alias("pulse"), iso(F.col("hour")).alias("hour"))


@query("f7_complete_case", f"select radar, pulse, {HOUR} as hour from qc_rows where date_part('hour', hour) % 5 <> 0")
def f7(spark, d):
    rows = T.model_rows(joined(spark, d)).withColumn("u_850_ms", F.when(F.hour("hour") % 5 == 0, F.lit(float("nan"))).otherwise(F.col("u_850_ms")))
    return T.complete_cases(rows, list(T.FEATURES)).select("radar", "pulse", iso(F.col("hour")).alias("hour"))


@query("a10_complete_days", "select cast(cast(hour as date) as varchar) as day from weather group by 1 having count(distinct date_part('hour', hour)) = 24")
def a10(spark, d):
    return T.complete_days(D.weather_site(spark, d)).select(F.col("day").cast("string"))


@query("f8_rolling_window", f"select radar, {HOUR} as hour from weather where cast(hour as date) between (select max(day) from (select cast(hour as date) as day from weather group by 1 having count(distinct date_part('hour', hour)) = 24)) - 2 and (select max(day) from (select cast(hour as date) as day from weather group by 1 having count(distinct date_part('hour', hour)) = 24))")
def f8(spark, d):
    rows = W.merge_weather_datasets(D.weather_site(spark, d)).select("radar", "hour")
    return T.rolling_window(rows, 3).withColumn("hour", iso(F.col("hour")))


@query("m1_build_training_table", f"select radar, pulse, {HOUR} as hour, mean_mtr_birds_km_h as mtr, mean_vid_birds_per_km2 as vid, round(u, 6) + 0.0 as u, round(v, 6) + 0.0 as v, cast(usable_mtr_profile_count as double) as profiles, t_pressure_level_850 as temperature_850_k, tp as hourly_precipitation_m from training")
def m1(spark, d):
    t = T.build_training_table(joined(spark, d), WINDOW)
    return t.select("radar", "pulse", iso(F.col("hour")).alias("hour"), F.col("mtr_birds_km_h").alias("mtr"), F.col("vid_birds_per_km2").alias("vid"), (F.round("bird_u_ms", 6) + 0.0).alias("u"), (F.round("bird_v_ms", 6) + 0.0).alias("v"), F.col("profile_count").alias("profiles"), "temperature_850_k", "hourly_precipitation_m")


@query("a9_table_summary", f"select count(*) as rows, count(distinct radar) as radars, count(*) filter (where pulse = 'lp') as lp_rows, count(*) filter (where pulse = 'sp') as sp_rows, strftime(min(hour), '%Y-%m-%dT%H:%M:%SZ') as first_hour, strftime(max(hour), '%Y-%m-%dT%H:%M:%SZ') as last_hour from qc_rows")
def a9(spark, d):
    return T.table_summary(T.model_rows(joined(spark, d))).withColumns({"first_hour": iso(F.col("first_hour")), "last_hour": iso(F.col("last_hour"))})


@query("a11_percentile_range", """
with long as (unpivot (select sp, t_pressure_level_850 as t, mean_mtr_birds_km_h as mtr from qc_rows) on sp, t, mtr into name feature value value), ranked as (select feature, value, row_number() over (partition by feature order by value) - 1 as i, count(*) over (partition by feature) as n from long)
select feature, max(value) filter (where i = greatest(0, floor(n * 0.01) - 1)) as lower, max(value) filter (where i = least(n - 1, floor(n * 0.99))) as upper from ranked group by feature""")
def a11(spark, d):
    rows = T.model_rows(joined(spark, d)).selectExpr("surface_pressure_pa as sp", "temperature_850_k as t", "mtr_birds_km_h as mtr")
    return T.percentile_ranges(rows, ["sp", "t", "mtr"])


@query("a44_population_guard", "select count(*) as rows, count(*) filter (where pulse = 'lp') as lp_rows, count(*) filter (where pulse = 'sp') as sp_rows, false as same_population, 'u_925_ms' as missing_features from qc_rows")
def a44(spark, d):
    rows = T.model_rows(joined(spark, d))
    return T.population_guard(rows, rows.where("radar != 'radar-00'"), ["u_850_ms", "u_925_ms"])


@query("m2_model_spec", "select target, 'boosted' as family, 'easting_m,northing_m,temperature_850_k,relative_humidity_850_percent,u_850_ms,v_850_ms,surface_pressure_pa,mean_sea_level_pressure_pa,total_cloud_cover_fraction,boundary_layer_height_m,hourly_precipitation_m' as predictors, case when target like 'bird%' then 'identity' else 'cube_root' end as response, case when target like 'bird%' then 'mtr' else 'profile_count' end as weights, '' as \"offset\", rows from (select unnest(['mtr_birds_km_h', 'vid_birds_per_km2', 'bird_u_ms', 'bird_v_ms']) as target) t, lateral (select case when target like 'bird%' then count(*) filter (where mean_ground_speed_ms is not null and dominant_direction_deg is not null) else count(*) end as rows from qc_rows)")
def m2(spark, d):
    """The default specs with the rows that each can be fitted on."""
    rows = T.model_rows(joined(spark, d))
    n = rows.agg(*[F.count(t).alias(t) for t in T.TARGETS])
    counts = n.select(F.explode(F.array(*[F.struct(F.lit(t).alias("target"), F.col(t).alias("rows")) for t in T.TARGETS])).alias("x")).select("x.*")
    return M.spec_table(spark, M.default_specs()).join(counts, "target")


def learnable(spark, d):
    """Training rows without the rolling window, as a written table that all fits read."""
    path = scratch_path(spark, "training")
    T.complete_cases(T.model_rows(joined(spark, d)), list(T.FEATURES)).write.parquet(path)
    return spark.read.parquet(path)


BASE = M.default_specs()


def _metrics_query(name: str, specs: dict[str, M.ModelSpec], *validations: str):
    """A query that validates models of both pulses: no SQL says the same."""

    @query(name)
    def run(spark, d):
        return M.validation_metrics(learnable(spark, d), specs, validations)

    return run


_metrics_query("m7_tweedie_intensity", {"mtr_birds_km_h": M.ModelSpec("mtr_birds_km_h", family="tweedie", predictors=("temperature_850_k", "u_850_ms", "v_850_ms", "total_cloud_cover_fraction"))}, "blocked_time")


#: Rounds of boosting that the survey recommends on Spark; the reference runs 500.
ROUNDS = 50
BOOSTED = {t: M.replace(s, max_iter=ROUNDS) for t, s in BASE.items()}


@query("m3_fit_boosted")
def m3(spark, d):
    """Boosted models of each target and pulse on the last fifth of times."""
    return M.validation_metrics(learnable(spark, d), BOOSTED, ("blocked_time",))


def model_grid(spark, d):
    """Grid rows with the features that models read."""
    wide = W.pivot_levels(D.weather_grid(spark, d))
    f = T.weather_features(wide).withColumns({"relative_humidity_850_percent": F.lit(50.0), "mean_sea_level_pressure_pa": F.col("sp") + 800.0, "boundary_layer_height_m": F.lit(500.0), "hourly_precipitation_m": F.lit(0.0)})
    from aeroskein.functions.geo import project_laea

    x, y = project_laea(F.col("longitude"), F.col("latitude"))
    return f.select("hour", "latitude", "longitude", x.alias("easting_m"), y.alias("northing_m"), *T.FEATURES, F.lit(1.0).alias("support"))


# models of two covariates, whose weighted least squares SQL can solve

def _plane(name: str, target: str, x: str, y: str, sql: tuple[str, str, str], wind: tuple[str, str] = ("", "0.0"), cube: bool = False, **more):
    """A query of the predictions of a linear model of covariates x and y, fitted on all rows of each pulse.

    sql: the target, x and y in SQL. wind: an offset and what it is in SQL. The weights are
    numbers of profiles.
    """
    offset = wind[1]
    spec = M.ModelSpec(target, **({"family": "additive", "response": "cube_root" if cube else "identity", "weights": "profile_count", "knots": 0, "reg": 0.0, "predictors": (x, y), "offset": wind[0] or None} | more))
    response = f"cbrt({sql[0]})" if cube else f"({sql[0]} - {offset})"
    value = "power(greatest(a + b * x + c * y, 0), 3)" if cube else f"a + b * x + c * y + {offset}"

    @query(name, f"""
with r as (select *, {sql[1]} as x, {sql[2]} as y, {response} as t, greatest(usable_mtr_profile_count, 1)::double as w from qc_rows where {sql[0]} is not null),
m as (select pulse, sum(w) as sw, sum(w * x) / sum(w) as mx, sum(w * y) / sum(w) as my, sum(w * t) / sum(w) as mt from r group by pulse),
q as (select pulse, sum(w * (x - mx) * (x - mx)) as xx, sum(w * (y - my) * (y - my)) as yy, sum(w * (x - mx) * (y - my)) as xy, sum(w * (x - mx) * (t - mt)) as xt, sum(w * (y - my) * (t - mt)) as yt from r join m using (pulse) group by pulse),
k as (select pulse, (xt * yy - yt * xy) / (xx * yy - xy * xy) as b, (yt * xx - xt * xy) / (xx * yy - xy * xy) as c from q), f as (select pulse, b, c, mt - b * mx - c * my as a from k join m using (pulse))
select radar, pulse, {HOUR} as hour, round({value}, 5) + 0.0 as predicted from r join f using (pulse)""")
    def run(spark, d):
        rows = learnable(spark, d)
        parts = [M.fit(rows.where(F.col("pulse") == p), spec).predict(rows.where(F.col("pulse") == p).where(F.col(target).isNotNull())) for p in ("lp", "sp")]
        return parts[0].union(parts[1]).select("radar", "pulse", iso(F.col("hour")).alias("hour"), (F.round("predicted", 5) + 0.0).alias("predicted"))

    return run


_U = "(mean_ground_speed_ms * sin(radians(dominant_direction_deg)))"
_plane("m4_additive_plane", "vid_birds_per_km2", "temperature_850_k", "u_850_ms", ("mean_vid_birds_per_km2", "t_pressure_level_850", "u_pressure_level_850"), cube=True)
_plane("m6_interaction_plane", "bird_u_ms", "u_850_ms", "u_850_ms_x_v_850_ms", (_U, "u_pressure_level_850", "u_pressure_level_850 * v_pressure_level_850"), predictors=("u_850_ms",), interactions=(("u_850_ms", "v_850_ms"),))
_plane("m17_offset_plane", "bird_u_ms", "temperature_850_k", "v_850_ms", (_U, "t_pressure_level_850", "v_pressure_level_850"), wind=("u_850_ms", "u_pressure_level_850"))


# frames

TABLES["wide_frames"] = """
  select hour, pulse, latitude, longitude, 1.0::double / (1 + h % 3) as support, cast((c * 7 + h * 3) % 400 as double) / 10 as mtr, cast((c * 5 + h) % 90 as double) / 10 as vid, cast((c + h) % 21 - 10 as double) as u, cast((c * 3 + h) % 19 - 9 as double) as v,
    cast((c + h) % 7 as double) as uncertainty_mtr, cast(c % 5 as double) as uncertainty_vid, null::double as uncertainty_u, cast(h % 9 as double) as uncertainty_v
  from (select distinct hour, latitude, longitude, cast((latitude - 48) * 4 * 3 + (longitude + 7) * 4 * 5 as bigint) as c, cast((epoch(hour) - epoch(timestamp '2025-07-14 00:00:00')) / 3600 as bigint) as h from weather_grid), (select unnest(['lp', 'sp']) as pulse)"""


def wide_frames(spark, d, *by):
    """Predictions of each cell, hour and pulse. Tasks have cells by place, or by columns `by` of places."""
    # the grid's cells are distinct before they have hours
    cells = D.grid_cells(spark, d).distinct()
    if by:
        cells = cells.repartition(D.cell_tasks(spark, d), *by)
    g = D.grid_hours(spark, d, cells).select("hour", "latitude", "longitude").withColumns({"c": F.expr("cast((latitude - 48) * 4 * 3 + (longitude + 7) * 4 * 5 as bigint)"), "h": F.expr(f"(unix_seconds(hour) - unix_seconds({D.START})) div 3600"), "pulse": F.explode(F.array(F.lit("lp"), F.lit("sp")))})
    return g.selectExpr(
        "hour", "pulse", "latitude", "longitude", "1.0D / (1 + h % 3) as support", "cast((c * 7 + h * 3) % 400 as double) / 10 as mtr", "cast((c * 5 + h) % 90 as double) / 10 as vid", "cast((c + h) % 21 - 10 as double) as u", "cast((c * 3 + h) % 19 - 9 as double) as v",
        "cast((c + h) % 7 as double) as uncertainty_mtr", "cast(c % 5 as double) as uncertainty_vid", "cast('NaN' as double) as uncertainty_u", "cast(h % 9 as double) as uncertainty_v",
    )


@query("p26_canonical_cell", f"select {HOUR} as hour, pulse, latitude, longitude, greatest(uncertainty_mtr, uncertainty_vid, uncertainty_v) as uncertainty from wide_frames")
def p26(spark, d):
    w = wide_frames(spark, d)
    return w.select(iso(F.col("hour")).alias("hour"), "pulse", "latitude", "longitude", domain.max_uncertainty(*[F.col(f"uncertainty_{t}") for t in R.TARGETS]).alias("uncertainty"))


@query("a32_frames_from_long", f"select {HOUR} as hour, pulse, latitude, longitude, round(support, 6) as support, greatest(uncertainty_mtr, uncertainty_vid, uncertainty_v) as uncertainty, mtr, vid, u, v from wide_frames where not (u = 3)")
def a32(spark, d):
    long = R.to_long(wide_frames(spark, d)).where("not (target = 'u' and value = 3)").withColumn("uncertainty", F.when(~F.isnan("uncertainty"), F.col("uncertainty")))
    w = R.to_wide(long)
    return w.select(iso(F.col("hour")).alias("hour"), "pulse", "latitude", "longitude", F.round("support", 6).alias("support"), "uncertainty", *R.TARGETS)


@query("a33_nest_frames", f"select pulse, {HOUR} as hour, count(*) as cell_count, first(latitude order by latitude desc, longitude) as first_latitude, first(longitude order by latitude desc, longitude) as first_longitude, first(mtr order by latitude desc, longitude) as first_mtr, last(mtr order by latitude desc, longitude) as last_mtr, floor(latitude / 5.0) * 5.0 as tile_latitude, floor(longitude / 5.0) * 5.0 as tile_longitude from wide_frames group by pulse, hour, floor(latitude / 5.0), floor(longitude / 5.0)")
def a33(spark, d):
    n = R.nest_frames(wide_frames(spark, d, *R.tile()))
    first, last = F.element_at("cells", 1), F.element_at("cells", -1)
    return n.select("pulse", iso(F.col("hour")).alias("hour"), F.col("cell_count").cast("long").alias("cell_count"), first["latitude"].alias("first_latitude"), first["longitude"].alias("first_longitude"), first["mtr"].alias("first_mtr"), last["mtr"].alias("last_mtr"), "tile_latitude", "tile_longitude")


@query("a34_day_frame_check", "select pulse, cast(cast(hour as date) as varchar) as day, count(*) as hours, min(n) as fewest, max(n) as most, count(*) = 24 and min(n) = max(n) as ok from (select pulse, hour, count(*) as n from wide_frames where mtr > 0.5 or pulse = 'lp' group by all) group by 1, 2")
def a34(spark, d):
    return R.day_checks(wide_frames(spark, d).where("mtr > 0.5 or pulse = 'lp'")).withColumn("day", F.col("day").cast("string"))


@query("a35_merge_daily_predictions", "select cast(cast(day as date) as varchar) as day, coalesce(hours, 0) as hours, coalesce(cells, 0) as cells, coalesce(hours = 24, false) as ok from (select unnest(generate_series((select cast(min(hour) as date) - 1 from wide_frames), (select cast(max(hour) as date) + 1 from wide_frames), interval 1 day)) as day) s left join (select cast(hour as date) as d, count(distinct hour) as hours, count(distinct (latitude, longitude)) as cells from wide_frames group by 1) w on w.d = s.day")
def a35(spark, d):
    from aeroskein.operators.inventory import date_spine

    w = wide_frames(spark, d)
    merged = R.merge_days([w.where("pulse = 'lp'"), w.where("pulse = 'sp'")])
    bounds = w.agg(F.date_sub(F.min("hour"), 1).alias("start"), F.date_add(F.max("hour"), 1).alias("end"))
    return R.merge_checks(merged, date_spine(bounds)).withColumn("day", F.col("day").cast("string"))


@query("a31_grid_descriptor", "select 0.25::double as latitude_step, 0.25::double as longitude_step, count(distinct latitude) as latitude_count, count(distinct longitude) as longitude_count, count(*) as cell_count, min(longitude) - 0.125 as west, max(longitude) + 0.125 as east, min(latitude) - 0.125 as south, max(latitude) + 0.125 as north from cells")
def a31(spark, d):
    return R.grid_descriptor(D.weather_grid(spark, d))


@query("w8_axis_step", "select count(*) as latitude_count, min(latitude) as latitude_min, max(latitude) as latitude_max, min(latitude - was) as latitude_step from (select latitude, lag(latitude) over (order by latitude) as was from (select distinct latitude from cells))")
def w8(spark, d):
    return R.axis_steps(D.weather_grid(spark, d), "latitude")


NICE = "case when {p} < 2 then 1.0 when {p} < 5 then 2.0 else 5.0 end"
TABLES["log_bounds"] = """
  select pulse, power(10.0, floor(log10(a))) * case when a / power(10.0, floor(log10(a))) >= 5 then 5.0 when a / power(10.0, floor(log10(a))) >= 2 then 2.0 else 1.0 end as minimum,
    power(10.0, floor(log10(b))) * case when b / power(10.0, floor(log10(b))) <= 1 then 1.0 when b / power(10.0, floor(log10(b))) <= 2 then 2.0 when b / power(10.0, floor(log10(b))) <= 5 then 5.0 else 10.0 end as maximum
  from (select pulse, quantile_cont(mtr, 0.01) as a, quantile_cont(mtr, 0.99) as b from wide_frames where mtr > 0 group by pulse)"""


@query("a29_colour_scale_stats", "select l.pulse, minimum, maximum, lin_min, lin_max from log_bounds l join (select pulse, round(quantile_cont(vid, 0.05), 6) as lin_min, round(quantile_cont(vid, 0.95), 6) as lin_max from wide_frames group by pulse) q using (pulse)")
def a29(spark, d):
    w = wide_frames(spark, d)
    lin = R.linear_scale(w, ["pulse"], "vid").select("pulse", F.round("minimum", 6).alias("lin_min"), F.round("maximum", 6).alias("lin_max"))
    return R.log_scale(w, ["pulse"], "mtr").drop("ticks").join(lin, "pulse")


@query("p22_log_ticks", "select pulse, t as tick from log_bounds, (select unnest([0.01, 0.02, 0.05, 0.1, 0.2, 0.5, 1.0, 2.0, 5.0, 10.0, 20.0, 50.0, 100.0, 200.0, 500.0]) as t) where t >= minimum and t <= maximum")
def p22(spark, d):
    return R.log_scale(wide_frames(spark, d), ["pulse"], "mtr").select("pulse", F.explode("ticks").alias("tick"))


@query("p23_scale_position", f"select {HOUR} as hour, latitude, longitude, round(least(1, greatest(0, (log10(greatest(mtr, 1)) - 0) / 2)), 6) as log_place, round(least(1, greatest(0, vid / 8)), 6) as place from wide_frames")
def p23(spark, d):
    w = wide_frames(spark, d)
    lit = lambda x: F.lit(float(x))
    return w.select(iso(F.col("hour")).alias("hour"), "latitude", "longitude", F.round(scales.scale_position(F.col("mtr"), lit(1), lit(100), True), 6).alias("log_place"), F.round(scales.scale_position(F.col("vid"), lit(0), lit(8), False), 6).alias("place"))


@query("a30_bounded_sample", "select c_custkey from customer order by md5(cast(c_custkey as varchar)), c_custkey limit 100")
def a30(spark, d):
    return R.bounded_sample(D.table(spark, d, "customer"), "c_custkey", 100).select("c_custkey")


@query("a43_fallback_scale", "with r as (select pulse, vid, row_number() over (partition by pulse order by vid) - 1 as i, count(*) over (partition by pulse) as n from wide_frames) select pulse, max(vid) filter (where i = floor(n * 0.05)) as minimum, max(vid) filter (where i = least(n - 1, floor(n * 0.95))) as maximum from r group by pulse")
def a43(spark, d):
    return R.fallback_scale(wide_frames(spark, d), ["pulse"], "vid")


@query("f14_visible_cells", f"select pulse, {HOUR} as hour, count(*) as cells from wide_frames where mtr >= 10 group by pulse, hour")
def f14(spark, d):
    return R.visible_cells(wide_frames(spark, d)).groupBy("pulse", iso(F.col("hour")).alias("hour")).agg(F.count("*").alias("cells"))


@query("a28_spatial_mean", f"select pulse, {HOUR} as hour, round(avg(mtr), 6) as mean from wide_frames where mtr >= 10 group by pulse, hour")
def a28(spark, d):
    return R.visible_cells(wide_frames(spark, d)).groupBy("pulse", iso(F.col("hour")).alias("hour")).agg(F.round(F.avg("mtr"), 6).alias("mean"))


@query("o5_every_nth_cell", f"select pulse, {HOUR} as hour, latitude, longitude from (select *, row_number() over (partition by pulse, hour order by latitude desc, longitude) - 1 as n from wide_frames) where n % 8 = 0")
def o5(spark, d):
    return R.every_nth(wide_frames(spark, d)).select("pulse", iso(F.col("hour")).alias("hour"), "latitude", "longitude")


# detail

TABLES["detail_layers"] = "select *, dens * 11 as eta, cast((bin * 3) % 5 as double) as sd_vvp from layers"
TABLES["slots"] = "select radar, pulse, time_bucket(interval 10 minute, ts, timestamp '2025-01-01') as slot, height, avg(dens) as dens, avg(eta) as eta, avg(ff) as ff, avg(sd_vvp) as sd_vvp, avg(dbzh) as dbzh, bool_or(gap) as gap from detail_layers group by all"
SLOT = "strftime(slot, '%Y-%m-%dT%H:%M:%SZ') as slot"


def slots(spark, d):
    return X.resample_layers(D.layers(spark, d).withColumns({"eta": F.col("dens") * 11, "sd_vvp": (F.col("bin") * 3 % 5).cast("double")}))


@query("a45_resample_layers", f"select radar, pulse, {SLOT}, height, round(dens, 6) as dens, round(ff, 6) as ff, gap from slots")
def a45(spark, d):
    return slots(spark, d).select("radar", "pulse", iso(F.col("slot")).alias("slot"), "height", F.round("dens", 6).alias("dens"), F.round("ff", 6).alias("ff"), "gap")


@query("f16_sd_vvp_filter", "select radar, pulse, count(*) as n from slots where sd_vvp >= 2 and height between 200 and 4000 and not gap group by all")
def f16(spark, d):
    return X.sd_filter(slots(spark, d)).groupBy("radar", "pulse").agg(F.count("*").alias("n"))


@query("f17_day_interval", "select radar, count(*) as n from layers where ts >= timestamp '2025-07-15 00:00:00' and ts < timestamp '2025-07-18 00:00:00' group by radar")
def f17(spark, d):
    return X.day_interval(D.layers(spark, d), "2025-07-16", 72).groupBy("radar").agg(F.count("*").alias("n"))


@query("a46_detail_profile_metrics", f"""
with s as (select radar, pulse, slot, case when count(distinct height) > 1 then (max(height) - min(height)) / (count(distinct height) - 1) else 200 end / 1000.0 as w, sum(dens) as d, sum(eta) as e, sum(ff * dens * 3.6) as m, sum(ff * eta * 3.6) as r,
  count(*) filter (where height <= 2000) as low, count(*) filter (where height <= 2000 and dbzh >= 7) as rain from slots where sd_vvp >= 2 and not gap group by all)
select radar, pulse, {SLOT}, round(d * w, 6) as vid, round(e * w, 6) as vir, case when rain >= 3 and rain / greatest(low, 1) >= 0.8 then null else round(m * w, 6) end as mtr, case when rain >= 3 and rain / greatest(low, 1) >= 0.8 then null else round(r * w, 6) end as rtr from s""")
def a46(spark, d):
    out = X.detail_metrics(slots(spark, d))
    return out.withColumns({"slot": iso(F.col("slot"))} | {c: F.round(c, 6) for c in ("vid", "vir", "mtr", "rtr")})


@query("a47_time_height_matrix", f"select radar, pulse, {SLOT}, height, round(dens, 6) as dens, round(least(1, ln(1 + greatest(dens, 0)) / ln(1 + greatest(max(dens) over (partition by radar, pulse), 1))), 6) as share from slots")
def a47(spark, d):
    out = X.time_height(slots(spark, d))
    return out.withColumns({"slot": iso(F.col("slot")), "dens": F.round("dens", 6), "share": F.round("share", 6)})


# historical package

PERIOD = "case o_orderkey % 3 when 0 then 'day' when 1 then 'civil_twilight' else 'night' end"
SEASON = "case o_orderkey % 4 when 0 then 'spring' when 1 then 'summer' when 2 then 'autumn' else 'winter' end"
HIST = f"select o_orderkey, cast(2013 + o_orderkey % 14 as varchar) as year, 'radar-0' || cast(o_custkey % 4 as varchar) as radar, case when o_orderkey % 5 = 0 then 'sp' else 'lp' end as pulse, {PERIOD} as solar_period, {SEASON} as season, o_totalprice, o_orderdate from orders"


def hist(spark, d):
    """Raw historical rows as text, a blank here and there."""
    o = D.table(spark, d, "orders").selectExpr(
        "cast(2013 + o_orderkey % 14 as string) as year", "concat('radar-0', cast(o_custkey % 4 as string)) as radar", "if(o_orderkey % 5 = 0, 'sp', 'lp') as pulse", f"{PERIOD} as solar_period", f"{SEASON} as season",
        "date_format(o_orderdate, 'yyyy-MM-dd') as date", "cast(o_orderkey % 50 as string) as profile_count", "if(o_orderkey % 11 = 0, '', cast(o_totalprice as string)) as vid_birds_per_km2",
        "cast(o_totalprice / 7 as string) as mean_vid_birds_per_km2_per_profile", "if(o_orderkey % 13 = 0, 'x', cast(o_orderkey % 900 as string)) as mean_weighted_height_m", "cast(o_orderkey % 17 as string) as mean_ff_ms",
        "cast(o_orderkey % 300 as string) as day_count", "cast(o_orderkey % 17 as string) as radar_count", "cast(o_totalprice / 100 as string) as mean_daily_vid_birds_per_km2", "'1.5' as mean_profile_vid_birds_per_km2",
        "if(o_orderkey % 9 = 0, '', date_format(o_orderdate, 'yyyy-MM-dd')) as median_50_date", "'' as onset_5_date", "'' as early_10_date", "'' as late_90_date", "'' as peak_date", "'2' as peak_vid_birds_per_km2",
        "cast(o_orderkey % 400 as string) as file_count", "'0' as failed_file_count", "date_format(o_orderdate, 'yyyy-MM-dd') as first_date", "date_format(o_orderdate, 'yyyy-MM-dd') as last_date",
    )
    return o


@query("p21_historical_projections", "select strftime(o_orderdate, '%Y-%m-%d') as date, radar, pulse, solar_period as period, season, cast(o_orderkey % 50 as bigint) as profiles, case when o_orderkey % 11 = 0 then null else round(o_totalprice, 8) end as vid, round(o_totalprice / 7, 4) as mean_vid, case when o_orderkey % 13 = 0 then null else cast(o_orderkey % 900 as double) end as height_m, cast(o_orderkey % 17 as double) as speed_ms from (" + HIST + ")")
def p21(spark, d):
    return H.daily_records(hist(spark, d)).withColumn("mean_vid", F.round("mean_vid", 4))


@query("a22_radar_first_last_date", f"select r.radar, min(strftime(o_orderdate, '%Y-%m-%d')) as first_date, max(strftime(o_orderdate, '%Y-%m-%d')) as last_date, case when count(year) > 0 then count(distinct year) end as years from radars r left join (select * from ({HIST}) where radar <> 'radar-03') h on h.radar = r.radar group by r.radar")
def a22(spark, d):
    return H.radar_spans(H.coverage_records(hist(spark, d)).where("radar != 'radar-03'"), D.radars(spark, d))


@query("a23_annual_nocturnal_series", f"select season, cast(year as bigint) as year, round(o_totalprice / 100, 8) as mean_daily_vid from ({HIST}) where pulse = 'lp' and solar_period = 'night' and season in ('spring', 'autumn') and cast(year as int) <= 2025")
def a23(spark, d):
    return H.annual_nocturnal(H.annual_records(hist(spark, d)))


@query("a24_solar_period_mean", f"select solar_period as period, round(avg(o_totalprice / 100), 4) as mean_daily_vid from ({HIST}) where pulse = 'lp' and cast(year as int) <= 2025 group by 1")
def a24(spark, d):
    return H.solar_period_means(H.annual_records(hist(spark, d))).withColumn("mean_daily_vid", F.round("mean_daily_vid", 4))


@query("a25_phenology_median_doy", f"select cast(year as bigint) as year, season, median(dayofyear(o_orderdate)) as day_of_year from ({HIST}) where pulse = 'lp' and solar_period = 'night' and season in ('spring', 'autumn') and cast(year as int) <= 2025 and o_orderkey % 9 <> 0 group by 1, 2")
def a25(spark, d):
    return H.phenology_medians(H.phenology_records(hist(spark, d)))


@query("a26_availability_matrix", f"select distinct radar, cast(year as bigint) as year from ({HIST}) where pulse = 'sp'")
def a26(spark, d):
    return H.availability(H.coverage_records(hist(spark, d)), "sp")


@query("a27_radar_day_aggregate", f"select radar, strftime(o_orderdate, '%Y-%m-%d') as date, round(coalesce(sum(case when o_orderkey % 11 <> 0 then o_totalprice end), 0), 4) as vid, cast(sum(o_orderkey % 50) as bigint) as profiles, case when sum(o_orderkey % 50) > 0 then round(coalesce(sum(case when o_orderkey % 13 <> 0 then o_orderkey % 900 * (o_orderkey % 50) end), 0) / sum(o_orderkey % 50), 6) end as height_m, case when sum(o_orderkey % 50) > 0 then round(sum(o_orderkey % 17 * (o_orderkey % 50)) / sum(o_orderkey % 50), 6) end as speed_ms from ({HIST}) group by 1, 2")
def a27(spark, d):
    out = H.radar_day_aggregate(H.daily_records(hist(spark, d)))
    return out.withColumns({"vid": F.round("vid", 4), "height_m": F.round("height_m", 6), "speed_ms": F.round("speed_ms", 6)})


@query("a40_seasonal_climatology", "with r as (select date_part('month', hour) as month, mean_vid_birds_per_km2 as x, row_number() over (partition by date_part('month', hour) order by mean_vid_birds_per_km2) - 1 as i, count(*) over (partition by date_part('month', hour)) as n from hourly where mean_vid_birds_per_km2 is not null) select cast(m.month as int) as month, case when count(x) = 0 then 0.25 else greatest(max(x) filter (where i = n // 2), 0.02) end as vid from (select unnest(range(1, 13)) as month) m left join r on r.month = m.month group by m.month")
def a40(spark, d):
    return H.seasonal_climatology(D.hourly(spark, d))


TABLES["latest_hours"] = "select * from hourly qualify row_number() over (partition by radar order by hour desc, pulse) = 1"


def observations(spark, d):
    """Latest row of each radar with its cell on a 10 km grid and its vector."""
    from aeroskein.functions.geo import grid_cell
    from aeroskein.operators.observed import latest_per_radar

    rows = latest_per_radar(D.hourly(spark, d), "hour").join(D.radars(spark, d).select("radar", "latitude", "longitude"), "radar")
    row, col = grid_cell((F.col("longitude") + 10) * 70_000.0, (F.col("latitude") - 49) * 111_000.0, 0.0, 0.0, 10_000.0, 175, 230)
    u, v = domain.uv(F.col("mean_ground_speed_ms"), F.col("dominant_direction_deg"), missing_as_zero=True)
    density = F.greatest(F.coalesce("mean_vid_birds_per_km2", F.lit(0.0)), F.lit(0.0))
    return rows.select("radar", row.alias("row"), col.alias("col"), density.alias("density"), F.pow(F.greatest(F.lit(0.04), density * 0.5), F.lit(2.0)).alias("variance"), u.alias("u"), v.alias("v")).where("row is not null")


TABLES["observations"] = "select radar, cast(floor((latitude - 49) * 111000.0 / 10000) as int) as row, cast(floor((longitude + 10) * 70000.0 / 10000) as int) as col, greatest(coalesce(mean_vid_birds_per_km2, 0), 0) as density, power(greatest(0.04, greatest(coalesce(mean_vid_birds_per_km2, 0), 0) * 0.5), 2) as variance, coalesce(mean_ground_speed_ms, 0) * sin(radians(coalesce(dominant_direction_deg, 0))) as u, coalesce(mean_ground_speed_ms, 0) * cos(radians(coalesce(dominant_direction_deg, 0))) as v from latest_hours join radars using (radar)"


@query("j22_observations_to_cells", "select radar, row, col, density, round(variance, 6) as variance, round(u, 6) + 0.0 as u, round(v, 6) + 0.0 as v from observations")
def j22(spark, d):
    return observations(spark, d).withColumns({c: F.round(c, 6) + 0.0 for c in ("variance", "u", "v")})


@query("a41_density_weighted_wind", "select round(sum(greatest(density, 0.05) * u) / sum(greatest(density, 0.05)), 6) as u, round(sum(greatest(density, 0.05) * v) / sum(greatest(density, 0.05)), 6) as v from observations")
def a41(spark, d):
    return H.density_weighted_wind(observations(spark, d)).withColumns({"u": F.round("u", 6), "v": F.round("v", 6)})
