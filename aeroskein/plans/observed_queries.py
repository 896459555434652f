"""Queries over layers, profiles, hours and nights."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroskein.functions import coerce, domain
from aeroskein.operators import observed as O
from aeroskein.operators import profiles as P
from aeroskein.plans import derived as D
from aeroskein.plans.registry import query

TS = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
HOUR = "strftime(hour, '%Y-%m-%dT%H:%M:%SZ')"


def six(df, *names):
    """Six places; a hair is added so that exact halves, which sums in another order may miss, go one way."""
    return df.withColumns({n: F.round(F.col(n) + 1e-9, 6) for n in names})


@query("a1_integrate_profiles", f"select * replace ({TS} as ts, round(vid_birds_per_km2 + 1e-9, 6) as vid_birds_per_km2, round(mtr_birds_km_h + 1e-9, 6) as mtr_birds_km_h, round(mean_ground_speed_ms + 1e-9, 6) as mean_ground_speed_ms, round(density_weighted_mean_height_m + 1e-9, 6) as density_weighted_mean_height_m, round(layer_width_km + 1e-9, 6) as layer_width_km, round(rain_layer_fraction + 1e-9, 6) as rain_layer_fraction) from profiles")
def a1(spark, d):
    out = six(D.profiles(spark, d), "vid_birds_per_km2", "mtr_birds_km_h", "mean_ground_speed_ms", "density_weighted_mean_height_m", "layer_width_km", "rain_layer_fraction")
    return out.withColumn("ts", coerce.iso(F.col("ts")))


@query("a2_layer_width", f"select radar, pulse, {TS} as ts, round(width, 6) as width_km from widths")
def a2(spark, d):
    sets = P.in_band(D.layers(spark, d)).groupBy("radar", "pulse", "ts").agg(F.collect_set("height").alias("h"))
    return sets.select("radar", "pulse", coerce.iso(F.col("ts")).alias("ts"), F.round(P.median_gap_km(F.col("h")), 6).alias("width_km"))


@query("a3_summary_profiles", f"""
select radar, {TS} as ts, pulse, min_by(2.5 * bin, bin) as vid_birds_per_km2, min_by(10.0 + bin, bin) as mtr_birds_km_h, min_by(ff, bin) as mean_ground_speed_ms, min_by(dd, bin) as dominant_direction_deg, min_by(height, bin) as density_weighted_mean_height_m
from layers group by radar, ts, pulse having count(*) filter (where not (date_part('minute', ts) % 10 = 0)) = 0""")
def a3(spark, d):
    raw = D.layers(spark, d).selectExpr("radar", "ts", "pulse", "bin as row_order", "if(minute(ts) % 10 = 0, 'NA', cast(dens as string)) as dens", "cast(2.5D * bin as string) as vid", "cast(10.0D + bin as string) as mtr", "cast(ff as string) as speed", "cast(dd as string) as direction", "cast(height as string) as height_m")
    return P.summary_profiles(raw).withColumn("ts", coerce.iso(F.col("ts")))


@query("a4_hourly_rows", f"select * replace ({HOUR} as hour, floor(mean_ground_speed_ms * 100000) / 100000 as mean_ground_speed_ms) from hourly")
def a4(spark, d):
    """Speeds cut after five places: some are halves at the seventh, which sums in another order may miss."""
    return D.hourly(spark, d).withColumns({"hour": coerce.iso(F.col("hour")), "mean_ground_speed_ms": F.floor(F.col("mean_ground_speed_ms") * 100000) / 100000})


@query("a5_external_hourly", f"""
select radar, {HOUR} as hour, count(*) as profile_count, round(avg(mtr_birds_km_h) + 1e-9, 6) as mtr_birds_km_h, round(avg(vid_birds_per_km2) + 1e-9, 6) as vid_birds_per_km2,
  round(avg(coalesce(mean_ground_speed_ms, 0) * sin(radians(coalesce(dominant_direction_deg, 0)))) + 1e-9, 6) as bird_u_ms, round(avg(coalesce(mean_ground_speed_ms, 0) * cos(radians(coalesce(dominant_direction_deg, 0)))) + 1e-9, 6) as bird_v_ms
from (select *, date_trunc('hour', ts) as hour from profiles) where mtr_birds_km_h is not null and vid_birds_per_km2 is not null group by radar, hour""")
def a5(spark, d):
    out = six(O.external_hourly(D.profiles(spark, d)), "mtr_birds_km_h", "vid_birds_per_km2", "bird_u_ms", "bird_v_ms")
    return out.withColumn("hour", coerce.iso(F.col("hour")))


@query("a6_circular_mean", """
select radar, pulse, case when sum(sin(radians(dd)) * dens) <> 0 or sum(cos(radians(dd)) * dens) <> 0 then round((degrees(atan2(sum(sin(radians(dd)) * dens), sum(cos(radians(dd)) * dens))) + 360) % 360, 6) end as direction from layers group by all""")
def a6(spark, d):
    rad = F.radians("dd")
    return D.layers(spark, d).groupBy("radar", "pulse").agg(domain.circular(F.sum(F.sin(rad) * F.col("dens")), F.sum(F.cos(rad) * F.col("dens"))).alias("direction"))


NIGHT_COLUMNS = "radar night_date profile_count usable_profile_count integrated_interval_count integrated_hours migration_traffic_birds_per_km mean_mtr_birds_km_h peak_mtr_birds_km_h mean_ground_speed_ms dominant_direction_deg mean_flight_height_m rain_contamination_fraction quality_class".split()
CLASS = "case when mean_mtr_birds_km_h is null then 'missing' when mean_mtr_birds_km_h <= 0 then 'none' when mean_mtr_birds_km_h < 100 then 'low' when mean_mtr_birds_km_h < 500 then 'moderate' when mean_mtr_birds_km_h < 1000 then 'high' else 'very_high' end"


@query("a7_night_metrics", f"select * replace (cast(night_date as varchar) as night_date), {CLASS} as intensity_class from nights")
def a7(spark, d):
    out = D.nights(spark, d).select(*NIGHT_COLUMNS, "intensity_class", F.array_join("pulse_products", ",").alias("pulse_products"))
    return out.withColumn("night_date", F.col("night_date").cast("string"))


SUN = "select *, cast(cast(ts as date) as timestamp) + interval 4 hour + to_minutes(cast(substr(radar, 7) as int)) as sunrise, cast(cast(ts as date) as timestamp) + interval 20 hour as sunset from layers"


def sunny_profiles(spark, d):
    """Profiles whose layers bring sunrise and sunset of their day."""
    with_sun = D.layers(spark, d).selectExpr("*", "timestampadd(MINUTE, 240 + cast(substr(radar, 7) as int), cast(to_date(ts) as timestamp)) as sunrise", "timestampadd(HOUR, 20, cast(to_date(ts) as timestamp)) as sunset")
    return P.integrate_profiles(with_sun)


@query("a8_expected_night_window", f"""
with p as (select distinct radar, ts, pulse, sunrise, sunset from ({SUN})),
n as (select *, case when ts >= sunrise and ts <= sunset then null when ts <= sunrise then cast(ts as date) - 1 else cast(ts as date) end as night_date from p),
w as (select radar, night_date, min(sunset) filter (where cast(sunset as date) = night_date) as sunset, max(sunrise) filter (where cast(sunrise as date) = night_date + 1) as sunrise from n where night_date is not null group by all)
select radar, cast(night_date as varchar) as night_date, strftime(sunset, '%Y-%m-%dT%H:%M:%SZ') as sunset, strftime(sunrise, '%Y-%m-%dT%H:%M:%SZ') as sunrise, round(case when sunrise > sunset then (epoch_us(sunrise) - epoch_us(sunset)) / 3.6e9 end, 6) as expected_night_hours from w""")
def a8(spark, d):
    out = O.expected_night_window(sunny_profiles(spark, d))
    return out.withColumns({"night_date": F.col("night_date").cast("string"), "sunset": coerce.iso(F.col("sunset")), "sunrise": coerce.iso(F.col("sunrise"))})


@query("w1_trapezoid_integral", """
select radar, cast(night_date as varchar) as night_date, pulse, round(sum((was + mtr_birds_km_h) / 2 * hours), 6) as traffic, round(sum(hours), 6) as hours, count(*) as intervals
from (select *, lag(mtr_birds_km_h) over w as was, (epoch_us(ts) - epoch_us(lag(ts) over w)) / 3.6e9 as hours from profiles where mtr_birds_km_h is not null and not rain_suspect and night_date is not null window w as (partition by radar, night_date, pulse order by ts))
where hours > 0 and hours * 60 <= 30 group by radar, night_date, pulse""")
def w1(spark, d):
    t = O.trapezoids(D.profiles(spark, d).where("night_date is not null"), ["radar", "night_date", "pulse"])
    return t.groupBy("radar", F.col("night_date").cast("string").alias("night_date"), "pulse").agg(F.round(F.sum("traffic"), 6).alias("traffic"), F.round(F.sum("hours"), 6).alias("hours"), F.count("*").alias("intervals"))


@query("w2_latest_per_radar", f"select radar, {TS} as ts, pulse, round(vid_birds_per_km2, 6) as vid from (select *, row_number() over (partition by radar order by ts desc, pulse) as n from profiles) where n = 1")
def w2(spark, d):
    return O.latest_per_radar(D.profiles(spark, d)).select("radar", coerce.iso(F.col("ts")).alias("ts"), "pulse", F.round("vid_birds_per_km2", 6).alias("vid"))


@query("w3_merge_latest_nights", """
with mx as (select max(night_date) as m from nights), old as (select radar, night_date, migration_traffic_birds_per_km as traffic, false as is_new from nights, mx where night_date < m),
new as (select radar, night_date, migration_traffic_birds_per_km + 1 as traffic, true as is_new from nights where extract(day from night_date) % 2 = 0)
select radar, cast(night_date as varchar) as night_date, round(traffic, 6) as traffic, is_new from (select *, row_number() over (partition by radar order by night_date desc, is_new desc) as n from (select * from old union all select * from new)) where n = 1""")
def w3(spark, d):
    nights = D.nights(spark, d).select("radar", "night_date", F.col("migration_traffic_birds_per_km").alias("traffic"))
    newest = nights.agg(F.max("night_date").alias("m"))
    old = nights.join(F.broadcast(newest), F.col("night_date") < F.col("m"), "left_semi")
    new = nights.where("day(night_date) % 2 = 0").withColumn("traffic", F.col("traffic") + 1)
    return O.merge_latest_nights(old, new).select("radar", F.col("night_date").cast("string").alias("night_date"), F.round("traffic", 6).alias("traffic"), "is_new")


@query("f1_altitude_band", "select radar, pulse, count(*) as layers, min(height) as lowest, max(height) as highest from layers where height between 400 and 1200 group by all")
def f1(spark, d):
    return P.in_band(D.layers(spark, d), 400, 1200).groupBy("radar", "pulse").agg(F.count("*").alias("layers"), F.min("height").alias("lowest"), F.max("height").alias("highest"))


@query("f2_gap_exclusion", "select radar, pulse, count(*) filter (where gap) as gaps, count(*) filter (where not gap) as used, round(sum(dens) filter (where not gap), 6) as dens from layers group by all")
def f2(spark, d):
    return D.layers(spark, d).groupBy("radar", "pulse").agg(F.count_if("gap").alias("gaps"), F.count_if(~F.col("gap")).alias("used"), F.round(F.sum(F.when(~F.col("gap"), F.col("dens"))), 6).alias("dens"))


@query("f3_rain_suspect", f"select radar, pulse, {TS} as ts, bins, wet, bins >= 5 and wet / bins >= 0.8 as suspect from profile_sums")
def f3(spark, d):
    bins, wet = P.rain_flags()
    g = D.layers(spark, d).groupBy("radar", "pulse", "ts").agg(bins.alias("bins"), wet.alias("wet"))
    return g.select("radar", "pulse", coerce.iso(F.col("ts")).alias("ts"), "bins", "wet", P.rain_suspect(F.col("bins"), F.col("wet")).alias("suspect"))


@query("f4_complete_night", "select radar, cast(night_date as varchar) as night_date, profile_count from nights join (select radar, max(cast(ts as date)) as m from profiles group by radar) using (radar) where night_date < m")
def f4(spark, d):
    profiles = D.profiles(spark, d)
    newest = profiles.groupBy("radar").agg(F.max(F.to_date("ts")).alias("source_date"))
    return O.complete_nights(O.night_metrics(profiles), newest).select("radar", F.col("night_date").cast("string").alias("night_date"), "profile_count")


@query("f5_integrable_nights", "select radar, cast(night_date as varchar) as night_date, integrated_interval_count from nights where integrated_interval_count > 0")
def f5(spark, d):
    return O.integrable_nights(D.nights(spark, d)).select("radar", F.col("night_date").cast("string").alias("night_date"), "integrated_interval_count")


@query("f12_valid_external_profile", f"select radar, pulse, {TS} as ts from profiles where mtr_birds_km_h is not null and vid_birds_per_km2 is not null")
def f12(spark, d):
    return D.profiles(spark, d).where("mtr_birds_km_h is not null and vid_birds_per_km2 is not null").select("radar", "pulse", coerce.iso(F.col("ts")).alias("ts"))


@query("j5_attach_radar_site", "select n.radar, cast(night_date as varchar) as night_date, latitude, longitude from nights n left join (select * from radars where radar <> 'radar-02') r using (radar)")
def j5(spark, d):
    return O.attach_site(D.nights(spark, d), D.radars(spark, d).where("radar != 'radar-02'")).select("radar", F.col("night_date").cast("string").alias("night_date"), "latitude", "longitude")


@query("u2_radar_differences", "with seen as (select distinct case when radar = 'radar-01' then 'radar-' || cast(20 + bin as varchar) else radar end as radar from layers) select radar, 'missing' as problem from radars where radar not in (select radar from seen) union all select radar, 'unexpected' from seen where radar not in (select radar from radars)")
def u2(spark, d):
    """One radar's layers go by other names."""
    seen = D.layers(spark, d).selectExpr("if(radar = 'radar-01', concat('radar-', 20 + bin), radar) as radar")
    return O.radar_differences(seen, D.radars(spark, d).select("radar"))


@query("d2_both_pulses", "select radar, pulse, cast(cast(ts as date) as varchar) as day, count(*) as profiles, round(sum(vid_birds_per_km2), 6) as vid from profiles group by all")
def d2(spark, d):
    return D.profiles(spark, d).groupBy("radar", "pulse", F.to_date("ts").cast("string").alias("day")).agg(F.count("*").alias("profiles"), F.round(F.sum("vid_birds_per_km2"), 6).alias("vid"))


# scalar functions

@query("p1_num_aliases", """
select o_orderkey, coalesce(case when isfinite(try_cast(trim(a) as double)) then try_cast(trim(a) as double) end, case when isfinite(try_cast(trim(b) as double)) then try_cast(trim(b) as double) end) as value
from (select o_orderkey, case o_orderkey % 6 when 0 then 'NA' when 1 then '' when 2 then 'inf' when 3 then 'x1' else cast(o_orderkey % 97 as varchar) end as a, case when o_orderkey % 7 = 0 then null else ' ' || cast(o_custkey as varchar) || '.5' end as b from orders)""")
def p1(spark, d):
    raw = D.table(spark, d, "orders").selectExpr("o_orderkey", "case o_orderkey % 6 when 0 then 'NA' when 1 then '' when 2 then 'inf' when 3 then 'x1' else cast(o_orderkey % 97 as string) end as a", "if(o_orderkey % 7 = 0, null, concat(' ', cast(o_custkey as string), '.5')) as b")
    return raw.select("o_orderkey", coerce.num(F.col("a"), F.col("b")).alias("value"))


@query("p3_bool_token", """
select o_orderkey, case when lower(trim(t)) in ('true', 't', '1', 'yes', 'y') then true when lower(trim(t)) in ('false', 'f', '0', 'no', 'n') then false end as flag
from (select o_orderkey, ['TRUE', ' t', '1', 'Yes', 'y', 'False', 'F ', '0', 'no', 'N', 'maybe', ''][cast(o_orderkey % 12 as int) + 1] as t from orders)""")
def p3(spark, d):
    words = F.array(*[F.lit(x) for x in ("TRUE", " t", "1", "Yes", "y", "False", "F ", "0", "no", "N", "maybe", "")])
    return D.table(spark, d, "orders").select("o_orderkey", coerce.bool_token(F.get(words, (F.col("o_orderkey") % 12).cast("int"))).alias("flag"))


@query("p4_parse_ts", """
select event_id, strftime(coalesce(try_cast(a as timestamp), try_cast(b as timestamp)), '%Y-%m-%dT%H:%M:%SZ') as at
from (select event_id, case when event_id % 3 = 0 then 'none' else strftime(ts, '%Y-%m-%d %H:%M:%S') end as a, case when event_id % 5 = 0 then null else '2025-07-14 01:02:03' end as b from events)""")
def p4(spark, d):
    raw = D.table(spark, d, "events").selectExpr("event_id", "if(event_id % 3 = 0, 'none', date_format(ts, 'yyyy-MM-dd HH:mm:ss')) as a", "if(event_id % 5 = 0, null, '2025-07-14T01:02:03Z') as b")
    return raw.select("event_id", coerce.iso(coerce.parse_ts(F.col("a"), F.col("b"))).alias("at"))


@query("p5_hour_key", "select strftime(date_trunc('hour', ts), '%Y-%m-%dT%H:%M:%SZ') as hour, count(*) as events from events group by 1")
def p5(spark, d):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123456789Z"))
    return D.table(spark, d, "events").groupBy(coerce.iso(coerce.hour_key(coerce.parse_ts(text))).alias("hour")).agg(F.count("*").alias("events"))


DAY = "case when event_id % 9 = 0 then event_id % 2 = 0 when event_id % 4 = 0 then ts >= sr and ts <= ss else date_part('hour', solar) >= 6 and date_part('hour', solar) < 18 end"
SKY = "select event_id, ts, cast(event_id % 41 - 20 as double) as lon, ts + to_microseconds(cast((event_id % 41 - 20) * 240000000 as bigint)) as solar, cast(cast(ts as date) as timestamp) + interval 5 hour as sr, cast(cast(ts as date) as timestamp) + interval 19 hour as ss from events"


def sky(spark, d):
    e = D.table(spark, d, "events").selectExpr("event_id", "cast(ts as timestamp) as ts", "cast(event_id % 41 - 20 as double) as lon", "if(event_id % 9 = 0, event_id % 2 = 0, null) as flag", "if(event_id % 4 = 0, timestampadd(HOUR, 5, cast(to_date(ts) as timestamp)), null) as sunrise", "if(event_id % 4 = 0, timestampadd(HOUR, 19, cast(to_date(ts) as timestamp)), null) as sunset")
    return e.withColumn("day", domain.is_day(F.col("ts"), F.col("lon"), F.col("flag"), F.col("sunrise"), F.col("sunset")))


@query("p6_is_day", f"select event_id, {DAY} as day from ({SKY})")
def p6(spark, d):
    return sky(spark, d).select("event_id", "day")


@query("p7_night_date", f"""
select event_id, cast(case when {DAY} then null when event_id % 4 = 0 and ts <= sr then cast(ts as date) - 1 when event_id % 4 = 0 and ts >= ss then cast(ts as date)
  when date_part('hour', solar) < 12 then cast(solar as date) - 1 else cast(solar as date) end as varchar) as night from ({SKY})""")
def p7(spark, d):
    night = domain.night_date(F.col("ts"), F.col("day"), F.col("lon"), F.col("sunrise"), F.col("sunset"))
    return sky(spark, d).select("event_id", night.cast("string").alias("night"))


@query("p8_intensity_class", "select l_orderkey, l_linenumber, l_partkey, case when v is null then 'missing' when v <= 0 then 'none' when v < 100 then 'low' when v < 500 then 'moderate' when v < 1000 then 'high' else 'very_high' end as class from (select *, case when l_partkey % 10 = 0 then null else l_quantity * 30 - 60 end as v from lineitem)")
def p8(spark, d):
    v = F.when(F.col("l_partkey") % 10 != 0, F.col("l_quantity") * 30 - 60)
    return D.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", domain.intensity_class(v).alias("class"))


@query("p9_quality_class", "select o_orderkey, case when c >= 0.75 and n >= 2 then 'good' when n > 0 then 'partial' else 'insufficient' end as class from (select o_orderkey, case when o_orderkey % 3 = 0 then null else (o_orderkey % 101) / 100.0 end as c, o_custkey % 4 as n from orders)")
def p9(spark, d):
    c = F.when(F.col("o_orderkey") % 3 != 0, F.col("o_orderkey") % 101 / 100.0)
    return D.table(spark, d, "orders").select("o_orderkey", domain.quality_class(c, F.col("o_custkey") % 4).alias("class"))


@query("p10_uv_components", f"""
select radar, pulse, {TS} as ts, bin, round(s * sin(radians(dd)), 6) + 0.0 as u, round(s * cos(radians(dd)), 6) + 0.0 as v, round(coalesce(s, 0) * sin(radians(dd)), 6) + 0.0 as u0, round(coalesce(s, 0) * cos(radians(dd)), 6) + 0.0 as v0
from (select *, case when bin = 2 then null else ff end as s from layers)""")
def p10(spark, d):
    s = F.when(F.col("bin") != 2, F.col("ff"))
    (u, v), (u0, v0) = domain.uv(s, F.col("dd")), domain.uv(s, F.col("dd"), missing_as_zero=True)
    return D.layers(spark, d).select("radar", "pulse", coerce.iso(F.col("ts")).alias("ts"), "bin", *[(F.round(c, 6) + 0.0).alias(k) for k, c in (("u", u), ("v", v), ("u0", u0), ("v0", v0))])


@query("p15_age_mode", "select event_id, case when a <= 6 then 'assimilated' when a <= 24 then 'propagated' else 'weather_only' end as mode from (select event_id, greatest(0, (event_id % 400) / 10.0 - 5) as a from events)")
def p15(spark, d):
    return D.table(spark, d, "events").select("event_id", domain.age_mode(F.col("event_id") % 400 / 10.0 - 5).alias("mode"))


@query("p16_transforms", "select o_orderkey, round(cbrt(greatest(x, 0)), 6) as cube, round(sqrt(greatest(x, 0)), 6) as root, round(ln(1 + greatest(x, 0)), 6) as log, round(power(greatest(y, 0), 3), 4) as uncube, round(exp(greatest(y, 0)) - 1, 4) as unlog from (select o_orderkey, o_totalprice / 1000 - 20 as x, (o_orderkey % 50) / 10.0 - 1 as y from orders)")
def p16(spark, d):
    x, y = F.col("o_totalprice") / 1000 - 20, F.col("o_orderkey") % 50 / 10.0 - 1
    return D.table(spark, d, "orders").select("o_orderkey", F.round(domain.transform(x, "cube_root"), 6).alias("cube"), F.round(domain.transform(x, "sqrt"), 6).alias("root"), F.round(domain.transform(x, "log1p"), 6).alias("log"), F.round(domain.inverse(y, "cube_root"), 4).alias("uncube"), F.round(domain.inverse(y, "log1p"), 4).alias("unlog"))


@query("p17_sample_weights", "select o_orderkey, cast(greatest(n, 1) as double) as counted, 1.0::double as uniform, greatest(m, 0.01) as rate, round(sqrt(greatest(m, 0.01)), 6) as root, round(power(greatest(m, 0.01), 0.25), 6) as powered from (select o_orderkey, o_orderkey % 5 as n, o_totalprice / 1000 - 50 as m from orders)")
def p17(spark, d):
    n, m = F.col("o_orderkey") % 5, F.col("o_totalprice") / 1000 - 50
    w = lambda kind, p=0.5: domain.sample_weight(n, m, kind, p)
    return D.table(spark, d, "orders").select("o_orderkey", w("profile_count").alias("counted"), w("uniform").alias("uniform"), w("mtr").alias("rate"), F.round(w("sqrt_mtr"), 6).alias("root"), F.round(w("mtr_power", 0.25), 6).alias("powered"))


@query("p18_wind_offset", "select radar, strftime(hour, '%Y-%m-%dT%H:%M:%SZ') as hour, target, case target when 'bird_u_ms' then u_pressure_level_850 when 'bird_v_ms' then v_pressure_level_850 else 0 end as off from weather, (select unnest(['mtr', 'bird_u_ms', 'bird_v_ms']) as target)")
def p18(spark, d):
    from aeroskein.operators.weather import merge_weather_datasets

    w = merge_weather_datasets(D.weather_site(spark, d)).withColumn("target", F.explode(F.array(F.lit("mtr"), F.lit("bird_u_ms"), F.lit("bird_v_ms"))))
    return w.select("radar", coerce.iso(F.col("hour")).alias("hour"), "target", domain.wind_offset(F.col("target"), F.col("u_pressure_level_850"), F.col("v_pressure_level_850")).alias("off"))


@query("p19_calendar_covariates", "select event_id, cast(dayofyear(ts) as int) as doy, cast(hour(ts) as int) as hour from events")
def p19(spark, d):
    return D.table(spark, d, "events").select("event_id", F.dayofyear("ts").alias("doy"), F.hour("ts").alias("hour"))


@query("p20_month_periods", """
with days as (select unnest(generate_series(date_trunc('day', min(o_orderdate)), date_trunc('day', max(o_orderdate)), interval 1 day)) as day from orders)
select cast(min(cast(day as date)) as varchar) as first_day, cast(max(cast(day as date)) as varchar) as last_day, count(*) as days from days group by date_trunc('month', day)""")
def p20(spark, d):
    from aeroskein.operators.inventory import date_spine, month_periods

    ends = D.table(spark, d, "orders").agg(F.min(F.to_date("o_orderdate")).alias("start"), F.max(F.to_date("o_orderdate")).alias("end"))
    return month_periods(date_spine(ends)).select(F.col("first_day").cast("string"), F.col("last_day").cast("string"), "days")


@query("p27_match_class", "select radar, pulse, case when date_part('minute', ts) % 15 = 0 then 'exact' else 'cadence-adjusted' end as class, count(*) as n from profiles group by all")
def p27(spark, d):
    return D.profiles(spark, d).groupBy("radar", "pulse", domain.match_class(F.minute("ts") % 15).alias("class")).agg(F.count("*").alias("n"))


@query("f9_required_fields", "select c_custkey, array_to_string([case when c_name is null or trim(c_name) = '' then 'c_name' end, case when c_mktsegment = 'BUILDING' then 'segment' end], ',') as missing from customer where c_name is null or trim(c_name) = '' or c_mktsegment = 'BUILDING'")
def f9(spark, d):
    rows = D.table(spark, d, "customer").withColumn("segment", F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")))
    return rows.select("c_custkey", domain.required_fields(["c_name", "segment"]).alias("m")).where(F.size("m") > 0).select("c_custkey", F.array_join("m", ",").alias("missing"))
