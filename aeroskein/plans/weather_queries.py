"""Queries that join observations and weather, and on grids and ranges."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroskein.functions import domain, geo
from aeroskein.functions.coerce import iso
from aeroskein.operators import weather as W
from aeroskein.plans import derived as D
from aeroskein.plans.registry import TABLES, query

HOUR = "strftime(hour, '%Y-%m-%dT%H:%M:%SZ')"
KM = "2 * 6371.0 * asin(least(1.0, sqrt(power(sin(radians({b}.latitude - {a}.latitude) / 2), 2) + cos(radians({a}.latitude)) * cos(radians({b}.latitude)) * power(sin(radians({b}.longitude - {a}.longitude) / 2), 2))))"
TABLES["covered"] = f"select distinct c.latitude, c.longitude from cells c join radars r on {KM.format(a='c', b='r')} <= r.max_range_m / 1000.0"
TABLES["grid_wide"] = "select hour, latitude, longitude, max(sp) as sp, max(tcc) as tcc, " + ", ".join(f"max({v}) filter (where level = {p}) as {v}_pressure_level_{p}" for v in "tuv" for p in (700, 850, 925)) + " from weather_grid group by hour, latitude, longitude"
WIDE = ["sp", "tcc", *[f"{v}_pressure_level_{p}" for v in "tuv" for p in (700, 850, 925)]]


def merged(spark, d):
    return W.merge_weather_datasets(D.weather_site(spark, d))


@query("j4_merge_weather_datasets", f"select w.* replace ({HOUR} as hour), true as has_surface, true as has_levels from weather w")
def j4(spark, d):
    return merged(spark, d).withColumn("hour", iso(F.col("hour")))


@query("j1_join_observed_weather", f"select h.radar, {HOUR} as hour, h.pulse as observed_pulse, h.mean_mtr_birds_km_h as observed_mean_mtr_birds_km_h, h.profile_count as observed_profile_count, msl, t_pressure_level_850 as t850 from hourly h join weather w using (radar, hour)")
def j1(spark, d):
    j = W.join_observed_weather(D.hourly(spark, d), merged(spark, d))
    return j.select("radar", iso(F.col("hour")).alias("hour"), "observed_pulse", "observed_mean_mtr_birds_km_h", "observed_profile_count", "msl", F.col("t_pressure_level_850").alias("t850"))


@query("j2_unmatched_observed", f"select radar, pulse, {HOUR} as hour from hourly h where not exists (select 1 from weather w where w.radar = h.radar and w.hour = h.hour)")
def j2(spark, d):
    return W.unmatched(D.hourly(spark, d), merged(spark, d)).select("radar", "pulse", iso(F.col("hour")).alias("hour"))


@query("j3_unmatched_weather", "select radar, count(*) as n from weather w where not exists (select 1 from hourly h where w.radar = h.radar and w.hour = h.hour) group by radar")
def j3(spark, d):
    return W.unmatched(merged(spark, d), D.hourly(spark, d)).groupBy("radar").agg(F.count("*").alias("n"))


@query("o3_sample_unmatched", f"select radar, pulse, {HOUR} as hour from hourly h where not exists (select 1 from weather w where w.radar = h.radar and w.hour = h.hour) order by radar, pulse, h.hour limit 25")
def o3(spark, d):
    return W.sample_unmatched(W.unmatched(D.hourly(spark, d), merged(spark, d))).select("radar", "pulse", iso(F.col("hour")).alias("hour"))


@query("p25_prefix_columns", f"select radar, {HOUR} as hour, profile_count as observed_profile_count, pulse as observed_pulse from hourly join weather using (radar, hour)")
def p25(spark, d):
    h = D.hourly(spark, d).select("radar", "hour", "profile_count", "pulse")
    return W.join_observed_weather(h, merged(spark, d).select("radar", "hour")).withColumn("hour", iso(F.col("hour")))


@query("p2_weather_alias", f"select radar, {HOUR} as hour, msl as pressure, coalesce(t_pressure_level_850, -1) as temperature from weather")
def p2(spark, d):
    from aeroskein.operators.training import weather_features

    rows = merged(spark, d).withColumnRenamed("t_pressure_level_850", "t_pressure_level_850.0")
    f = weather_features(rows)
    return f.select("radar", iso(F.col("hour")).alias("hour"), F.col("mean_sea_level_pressure_pa").alias("pressure"), F.coalesce("temperature_850_k", F.lit(-1.0)).alias("temperature"))


@query("p11_project_laea", "select c_custkey, round(lon * 111320.0 * cos(radians(lat)), 3) as plain_x, round(lat * 110540.0, 3) as plain_y, abs(x - px) < 1 and abs(y - py) < 1 as close from (select c_custkey, 50 + (c_custkey % 80) / 10.0 as lat, -7 + (c_custkey % 90) / 10.0 as lon, 0 as x, 0 as px, 0 as y, 0 as py from customer)")
def p11(spark, d):
    """Both projections; `close` says that distances to a neighbour agree with the ellipsoid's to within a metre in area-preserving terms."""
    c = D.table(spark, d, "customer").selectExpr("c_custkey", "50.0D + (c_custkey % 80) / 10.0D as lat", "-7.0D + (c_custkey % 90) / 10.0D as lon")
    px, py = geo.project_plain(F.col("lon"), F.col("lat"))
    x, y = geo.project_laea(F.col("lon"), F.col("lat"))
    # a small cell's area in the projection is its area on the ellipsoid
    e = 1e-3
    corner = [geo.project_laea(F.col("lon") + i * e, F.col("lat") + j * e) for i, j in ((0, 0), (1, 0), (1, 1), (0, 1))]
    area = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(corner, corner[1:] + corner[:1])) / 2
    e2 = 2 * geo.FLATTENING - geo.FLATTENING**2
    s = F.sin(F.radians(F.col("lat") + e / 2))
    true = geo.SEMI_MAJOR**2 * (1 - e2) * F.cos(F.radians(F.col("lat") + e / 2)) / F.pow(1 - e2 * s * s, F.lit(2.0)) * (3.141592653589793 / 180 * e) ** 2
    return c.select("c_custkey", F.round(px, 3).alias("plain_x"), F.round(py, 3).alias("plain_y"), ((F.abs(area / true - 1) < 1e-4) & x.between(2_000_000, 6_000_000) & y.between(1_000_000, 6_000_000)).alias("close"))


@query("p12_great_circle", f"select a.radar, b.radar as other, round({KM.format(a='a', b='b')}, 6) as km from stations a, radars b")
def p12(spark, d):
    a, b = D.stations(spark, d), D.radars(spark, d).selectExpr("radar as other", "latitude as lat2", "longitude as lon2")
    return a.join(b).select("radar", "other", F.round(geo.great_circle_km(F.col("latitude"), F.col("longitude"), F.col("lat2"), F.col("lon2")), 6).alias("km"))


@query("p13_point_in_polygon", "select latitude, longitude from cells where longitude > -5.1 and longitude < -1.1 and latitude > 49.1 and latitude < 55.1 and not (longitude > -4.1 and longitude < -2.1 and latitude > 51.1 and latitude < 53.1)")
def p13(spark, d):
    ring = lambda w, s, e, n: F.array(*[F.struct(F.lit(x).alias("x"), F.lit(y).alias("y")) for x, y in ((w, s), (e, s), (e, n), (w, n), (w, s))])
    polygons = F.array(F.array(ring(-5.1, 49.1, -1.1, 55.1), ring(-4.1, 51.1, -2.1, 53.1)))
    cells = D.weather_grid(spark, d).select("latitude", "longitude").distinct()
    return cells.where(geo.point_in_polygons(F.col("longitude"), F.col("latitude"), polygons))


@query("p13_boundary_join", """
select longitude, latitude, n_name as code from cells, (select n_name, -6.513 + (n_nationkey * 7 % 25) / 4.0 as cx, 48.317 + (n_nationkey * 3 % 25) / 4.0 as cy from nation)
where abs(longitude - cx) + abs(latitude - cy) < 2 and abs(longitude - cx) + abs(latitude - cy) > 1""")
def p13_join(spark, d):
    """Cells in many countries, each a diamond with a diamond as its hole."""
    around = lambda r: f"array(struct(cx + {r} as x, cy as y), struct(cx as x, cy + {r} as y), struct(cx - {r} as x, cy as y), struct(cx as x, cy - {r} as y))"
    shapes = D.table(spark, d, "nation").selectExpr("n_name as code", "-6.513D + (n_nationkey * 7 % 25) / 4.0D as cx", "48.317D + (n_nationkey * 3 % 25) / 4.0D as cy").selectExpr("code", f"array(array({around('2.0D')}, {around('1.0D')})) as polygons")
    return W.points_in_boundary(D.weather_grid(spark, d), shapes)


@query("p14_grid_cell", "select c_custkey, case when ok then cast(r as int) end as row, case when ok then cast(c as int) end as col from (select *, r >= 0 and r < 23 and c >= 0 and c < 17 as ok from (select c_custkey, floor((c_custkey % 300) * 1000.0 / 10000) as r, floor((c_custkey % 211 - 20) * 1000.0 / 10000) as c from customer))")
def p14(spark, d):
    c = D.table(spark, d, "customer")
    row, col = geo.grid_cell((F.col("c_custkey") % 211 - 20) * 1000.0, F.col("c_custkey") % 300 * 1000.0, 0.0, 0.0, 10_000.0, 17, 23)
    return c.select("c_custkey", row.alias("row"), col.alias("col"))


@query("p24_covariate_support", f"select radar, {HOUR} as hour, round(exp(-3 * greatest(100200 - sp, sp - 100700, 0) / 500) * coalesce(exp(-3 * greatest(-5 - u_pressure_level_850, u_pressure_level_850 - 5, 0) / 10), 0), 6) as support from weather")
def p24(spark, d):
    c = domain.covariate_support([F.col("sp"), F.col("u_pressure_level_850")], [F.lit(100200.0), F.lit(-5.0)], [F.lit(100700.0), F.lit(5.0)])
    return merged(spark, d).select("radar", iso(F.col("hour")).alias("hour"), F.round(c, 6).alias("support"))


@query("j9_nearest_grid_cell", """
select radar, (select min_by(v, abs(v - latitude) * 1000000 + v) from (select distinct latitude as v from cells)) as cell_latitude, (select min_by(v, abs(v - longitude) * 1000000 + v) from (select distinct longitude as v from cells)) as cell_longitude from radars""")
def j9(spark, d):
    return W.nearest_grid_cells(D.radars(spark, d), D.weather_grid(spark, d))


@query("j10_in_radar_coverage", "select * from covered")
def j10(spark, d):
    return W.cells_in_coverage(D.weather_grid(spark, d), D.radars(spark, d))


@query("j11_support_score", f"select c.latitude, c.longitude, round(coalesce(max(case when {KM.format(a='c', b='r')} <= max_range_m / 1000.0 then exp(-power({KM.format(a='c', b='r')} / (max_range_m / 1000.0), 2)) end), 0), 6) as support from cells c, radars r group by 1, 2")
def j11(spark, d):
    return W.support_scores(D.weather_grid(spark, d), D.radars(spark, d))


@query("j20_merge_grid_weather", f"select {HOUR} as hour, g.latitude, g.longitude, {', '.join(WIDE)} from grid_wide g join covered using (latitude, longitude)")
def j20(spark, d):
    return W.merge_grid_weather(D.weather_grid(spark, d), D.radars(spark, d)).select(iso(F.col("hour")).alias("hour"), "latitude", "longitude", *WIDE)


@query("j13_match_site_hour_cell", f"select radar, {HOUR} as hour, t_pressure_level_850 as t850, u_pressure_level_925 as u925 from grid_wide g join (select radar, (select min_by(v, abs(v - latitude) * 1000000 + v) from (select distinct latitude as v from cells)) as cell_latitude, (select min_by(v, abs(v - longitude) * 1000000 + v) from (select distinct longitude as v from cells)) as cell_longitude from radars) n on g.latitude = cell_latitude and g.longitude = cell_longitude")
def j13(spark, d):
    sites = D.radars(spark, d)
    return W.site_features(D.weather_grid(spark, d), sites).select("radar", iso(F.col("hour")).alias("hour"), F.col("t_pressure_level_850").alias("t850"), F.col("u_pressure_level_925").alias("u925"))


@query("f11_training_window_filter", f"select count(*) as n, min(latitude) as south, max(longitude) as east from weather_grid where hour between timestamp '2025-07-14 03:00:00' and timestamp '2025-07-14 09:00:00'")
def f11(spark, d):
    g = D.weather_grid(spark, d).where(F.col("hour").between(F.lit("2025-07-14 03:00:00").cast("timestamp"), F.lit("2025-07-14 09:00:00").cast("timestamp")))
    return g.agg(F.count("*").alias("n"), F.min("latitude").alias("south"), F.max("longitude").alias("east"))


NAMES = [*D.SURFACE, *D.LEVELS]


@query("a36_validate_weather_day", "select cast(cast(hour as date) as varchar) as day, count(*) as groups, count(*) as complete, count(*) = 96 as ok from weather group by 1")
def a36(spark, d):
    return W.day_completeness(D.weather_site(spark, d), NAMES, 4).withColumn("day", F.col("day").cast("string"))


@query("a37_period_day_completeness", "select cast(cast(day as date) as varchar) as day, count(distinct w.hour) as hours, count(distinct w.hour) = 24 as ok from (select unnest(generate_series((select cast(min(hour) as date) - 2 from weather), (select cast(max(hour) as date) + 2 from weather), interval 1 day)) as day) s left join weather w on cast(w.hour as date) = s.day group by s.day")
def a37(spark, d):
    from aeroskein.operators.inventory import date_spine

    rows = D.weather_site(spark, d)
    bounds = rows.agg(F.date_sub(F.min("hour"), 2).alias("start"), F.date_add(F.max("hour"), 2).alias("end"))
    return W.hours_per_day(rows, date_spine(bounds)).withColumn("day", F.col("day").cast("string"))


@query("a38_coverage_bbox", "select ceil(max(latitude + max_range_m / 1000.0 / 110) / 0.25) * 0.25 + 0.25 as north, floor(min(longitude - max_range_m / 1000.0 / (110 * cos(radians(latitude)))) / 0.25) * 0.25 - 0.25 as west, floor(min(latitude - max_range_m / 1000.0 / 110) / 0.25) * 0.25 - 0.25 as south, ceil(max(longitude + max_range_m / 1000.0 / (110 * cos(radians(latitude)))) / 0.25) * 0.25 + 0.25 as east from stations")
def a38(spark, d):
    return W.coverage_box(D.stations(spark, d))


@query("a39_radar_metadata_check", "select count(*) as radars, array_to_string(list_sort(list(radar) filter (where height_m % 7 = 1 or height_m % 11 = 3)), ',') as incomplete from stations")
def a39(spark, d):
    r = D.stations(spark, d).selectExpr("radar", "if(height_m % 7 = 1, null, latitude) as latitude", "longitude", "if(height_m % 11 = 3, 0.0D, max_range_m) as max_range_m")
    return W.radar_metadata_problems(r).withColumn("incomplete", F.array_join("incomplete", ","))


@query("j21_kernel_grid", """
with c as (select c_custkey % 120 as row, c_custkey // 120 as col, (c_custkey % 13) / 10.0 as clim from customer), p as (select s_suppkey * 7 % 30 as row, s_suppkey * 11 % 30 as col, greatest(s_acctbal, 0) as v from supplier)
select c.row, c.col, round((0.04 * greatest(clim, 0.01) + sum(exp(-(power(c.row - p.row, 2) + power(c.col - p.col, 2)) / 288.0) * v)) / (0.04 + sum(exp(-(power(c.row - p.row, 2) + power(c.col - p.col, 2)) / 288.0))), 6) as value from c, p group by c.row, c.col, clim""")
def j21(spark, d):
    cells = D.table(spark, d, "customer").selectExpr("c_custkey % 120 as row", "c_custkey div 120 as col", "(c_custkey % 13) / 10.0D as climatology")
    points = D.table(spark, d, "supplier").selectExpr("s_suppkey * 7 % 30 as row", "s_suppkey * 11 % 30 as col", "greatest(s_acctbal, 0.0D) as value")
    return W.kernel_grid(cells, points).withColumn("value", F.round("value", 6))
