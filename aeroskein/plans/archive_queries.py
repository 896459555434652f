"""Queries on inventories, crosswalks and comparisons of archives, and on validation."""

from __future__ import annotations

from pyspark.sql import functions as F

from aeroskein.functions.coerce import iso
from aeroskein.operators import compare as C
from aeroskein.operators import inventory as I
from aeroskein.operators import profiles as P
from aeroskein.operators import validation as V
from aeroskein.plans import derived as D
from aeroskein.plans.registry import TABLES, query

HOUR = "strftime(hour, '%Y-%m-%dT%H:%M:%SZ')"
DAY = "cast(day as varchar) as day"
text = lambda df, *names: df.withColumns({n: F.col(n).cast("string") for n in names})


def catalog(spark, d):
    """Declared dates of each radar; one is a day ahead of its objects."""
    g = D.layers(spark, d).groupBy("radar").agg(F.min(F.to_date("ts")).alias("first_date"), F.max(F.to_date("ts")).alias("last_date"))
    return g.withColumn("last_date", F.expr("if(radar = 'radar-03', date_add(last_date, 1), last_date)"))


TABLES["catalog"] = "select radar, min(cast(ts as date)) as first_date, max(cast(ts as date)) + case when radar = 'radar-03' then 1 else 0 end as last_date from layers group by radar"


def spine(spark, d):
    return I.date_spine(catalog(spark, d).agg(F.min("first_date").alias("start"), F.max("last_date").alias("end")))


TABLES["spine"] = "select cast(unnest(generate_series(min(first_date), max(last_date), interval 1 day)) as date) as day from catalog"
TABLES["expected"] = "select r.radar, s.day, p.pulse, o.key from radars r cross join spine s cross join (select unnest(['lp', 'sp']) as pulse) p left join objects o on o.radar = r.radar and o.day = s.day and o.pulse = p.pulse"


@query("s3_parse_object_key", "select key, radar, cast(day as varchar) as day, pulse, 'csv' as suffix from objects union all select 'other/20250715.h5', null, '2025-07-15', null, 'h5' from region where r_regionkey = 0")
def s3(spark, d):
    odd = D.table(spark, d, "region").where("r_regionkey = 0").select(F.lit("other/20250715.h5").alias("key"))
    keys = D.objects(spark, d).select("key").union(odd)
    return text(keys.select("key", *[c.alias(k) for k, c in I.parse_object_key(F.col("key")).items()]), "day")


@query("s6_vpts_object_path", "select key from objects")
def s6(spark, d):
    return D.objects(spark, d).select(I.object_key(F.col("radar"), F.col("day"), F.col("pulse")).alias("key"))


@query("s5_external_coverage_objects", "select distinct 'baltrad' as source, 'frxxx' as radar, cast(day as varchar) as day, 'baltrad/daily/frxxx/' || strftime(day, '%Y') || '/frxxx_vpts_' || strftime(day, '%Y%m%d') || '.csv' as key from (select cast(o_orderdate as date) as day from orders) where day between date '1995-01-05' and date '1995-03-09'")
def s5(spark, d):
    o = D.table(spark, d, "orders")
    listing = o.selectExpr("concat('baltrad/hdf5/frxxx/', year(o_orderdate), '/', month(o_orderdate), '/', day(o_orderdate)) as directory").union(o.selectExpr("concat('baltrad/hdf5/frxxx/1995/02/3', o_orderkey % 10) as directory")).union(o.selectExpr("concat('uva/hdf5/frxxx/1995/02/0', 1 + o_orderkey % 9) as directory"))
    return text(I.coverage_objects(listing, "baltrad", "frxxx", "1995-01-05", "1995-03-09"), "day")


@query("j18_expected_vs_available", f"select radar, {DAY}, pulse, key from expected")
def j18(spark, d):
    return text(I.expected_vs_available(D.radars(spark, d), spine(spark, d), D.objects(spark, d)), "day")


@query("a21_radar_coverage", "select radar, count(*) as requested, count(*) filter (where n > 0) as available, array_to_string(list_sort(list(cast(day as varchar)) filter (where n = 0)), ',') as missing, round(avg(case when n > 0 then 1.0 else 0.0 end), 6) as fraction from (select radar, day, count(key) as n from expected group by all) group by radar")
def a21(spark, d):
    out = I.radar_coverage(I.expected_vs_available(D.radars(spark, d), spine(spark, d), D.objects(spark, d)))
    return out.withColumn("missing", F.nullif(F.array_join("missing", ","), F.lit("")))


@query("d1_prefer_lp", f"select radar, {DAY}, min_by(pulse, case pulse when 'lp' then 0 else 1 end) as pulse, min_by(key, case pulse when 'lp' then 0 else 1 end) as key, array_to_string(list_sort(list(distinct pulse)), ',') as available_pulses from objects group by radar, day")
def d1(spark, d):
    return text(I.prefer_lp(D.objects(spark, d)).select("radar", "day", "pulse", "key", F.array_join("available_pulses", ",").alias("available_pulses")), "day")


TABLES["cursor_dates"] = "select radar, last_date - case radar when 'radar-00' then 0 when 'radar-01' then 20 else -2 end as source_date from catalog where radar <> 'radar-03'"
TABLES["targets"] = """select c.radar, last_date, source_date, case when source_date is null then 'bootstrap' when last_date < source_date then 'regression' when last_date = source_date then 'unchanged' else 'catch_up' end as state,
  case when source_date is null then last_date - 8 when last_date > source_date then source_date else last_date - 1 end as first_date,
  case when last_date > source_date then least(last_date, source_date + 7) else last_date end as target_date from catalog c left join cursor_dates using (radar)"""


def cursor_dates(spark, d):
    return catalog(spark, d).where("radar != 'radar-03'").selectExpr("radar", "date_sub(last_date, case radar when 'radar-00' then 0 when 'radar-01' then 20 else -2 end) as source_date")


@query("d3_incremental_target_window", "select t.radar, cast(day as varchar) as day, state from targets t, (select unnest(range(0, 10)) as k), lateral (select first_date + cast(k as int) as day) where state <> 'regression' and day <= target_date union all select radar, null, state from targets where state = 'regression'")
def d3(spark, d):
    t = I.incremental_targets(catalog(spark, d), cursor_dates(spark, d))
    days = I.target_days(t).join(t.select("radar", "state"), "radar")
    return text(days.select("radar", "day", "state").union(t.where("state = 'regression'").selectExpr("radar", "cast(null as date)", "state")), "day")


TABLES["cursor_objects"] = "select key, case when day = date '2025-07-16' then 'old' else etag end as etag from objects where radar <> 'radar-03'"
TABLES["catch_up"] = """
  select t.radar, t.state, t.target_date as proposed_source_date, t.target_date - 1 as latest_complete_night, count(p.key) as selected_file_count, count(p.key) filter (where p.day = t.target_date) = 0 as missing_target,
    t.source_date is distinct from t.target_date or count(*) filter (where p.key is not null and p.etag is distinct from c.etag) > 0 as changed
  from targets t left join (select * from objects qualify row_number() over (partition by radar, day order by pulse) = 1) p on p.radar = t.radar and p.day between t.first_date and t.target_date left join cursor_objects c on c.key = p.key
  group by t.radar, t.state, t.target_date, t.source_date"""


def catch_up(spark, d):
    known = D.objects(spark, d).where("radar != 'radar-03'").selectExpr("key", "if(day = date '2025-07-16', 'old', etag) as etag")
    return I.catch_up_status(I.incremental_targets(catalog(spark, d), cursor_dates(spark, d)), D.objects(spark, d), known)


@query("d3_catch_up_status", "select radar, state, cast(proposed_source_date as varchar) as proposed_source_date, cast(latest_complete_night as varchar) as latest_complete_night, selected_file_count, missing_target, changed from catch_up")
def d3_status(spark, d):
    return text(catch_up(spark, d), "proposed_source_date", "latest_complete_night")


@query("d3_run_status", "select ok, ok and changed_radars = 0 as no_change, changed_radars, case when ok then files else 0 end as files from (select bool_and(state <> 'regression' and not missing_target) as ok, count(*) filter (where changed) as changed_radars, cast(sum(case when changed then selected_file_count else 0 end) as bigint) as files from catch_up where state <> 'regression' and not missing_target)")
def d3_run(spark, d):
    return I.run_status(catch_up(spark, d).where("state != 'regression' and not missing_target"))


@query("d4_missing_target", "select radar, cast(last_date as varchar) as last_date from catalog c where not exists (select 1 from objects o where o.radar = c.radar and o.day = c.last_date)")
def d4(spark, d):
    return text(I.missing_targets(catalog(spark, d), D.objects(spark, d)).select("radar", "last_date"), "last_date")


@query("d5_latest_common_window", "select cast(min(last_date) - 1 as varchar) as common, cast(min(last_date) - 1 as varchar) as end, cast(min(last_date) - 7 as varchar) as start, true as ok from catalog")
def d5(spark, d):
    return text(I.latest_common_window(catalog(spark, d), 7), "common", "end", "start")


@query("j19_detect_changed_radars", "select radar, count(*) filter (where day > date '2025-07-20' or day = date '2025-07-16') as changed, cast(max(day) as varchar) as source_date from objects group by radar having count(*) filter (where day > date '2025-07-20' or day = date '2025-07-16') > 0")
def j19(spark, d):
    old = D.objects(spark, d).where("day <= date '2025-07-20'").selectExpr("key", "if(day = date '2025-07-16', 'old', etag) as etag")
    return text(I.changed_radars(D.objects(spark, d), old), "source_date")


@query("f10_catalog_health_gates", "select count(*) as radars, 50.0 as age_hours, 'stale,radar_count' as problems from catalog")
def f10(spark, d):
    return I.catalog_health(catalog(spark, d), "2025-07-14 00:00:00", "2025-07-16 02:00:00", 5).withColumn("problems", F.array_join("problems", ","))


@query("a42_manifest_summary", "select count(*) as count, array_to_string(list_sort(list(distinct radar)), ',') as radars, cast(min(day) as varchar) as first_day, cast(max(day) as varchar) as last_day, true as ok from objects")
def a42(spark, d):
    return text(I.manifest_summary(D.objects(spark, d)).withColumn("radars", F.array_join("radars", ",")), "first_day", "last_day")


@query("o4_max_files", "select key from objects order by radar, day, pulse limit 7")
def o4(spark, d):
    return I.first_n_objects(D.objects(spark, d), 7).select("key")


@query("u1_union_batches", "select source, count(*) as n, round(sum(dens), 4) as dens from (select 'own' as source, dens from layers union all select 'external', dens from external_layers) group by source")
def u1(spark, d):
    both = D.layers(spark, d).withColumn("source", F.lit("own")).unionByName(D.external_layers(spark, d).withColumn("source", F.lit("external")))
    return both.groupBy("source").agg(F.count("*").alias("n"), F.round(F.sum("dens"), 4).alias("dens"))


@query("u5_sorted_distinct", "select radar, array_to_string(list_sort(list(distinct pulse)), ',') as pulses, count(distinct bin) as bins from layers group by radar")
def u5(spark, d):
    return D.layers(spark, d).groupBy("radar").agg(F.array_join(F.array_sort(F.collect_set("pulse")), ",").alias("pulses"), F.countDistinct("bin").alias("bins"))


# comparisons of archives

TABLES["external_profiles"] = "select distinct radar, ts from external_layers"
TABLES["own_profiles"] = "select distinct radar, ts from layers"


@query("j6_select_nearest_profile", """
with best as (select radar, min_by(ts, abs(epoch_us(ts) - epoch_us(timestamp '2025-07-14 13:03:00')) * 1000 + epoch_us(ts) / 1e15) as ts from own_profiles group by radar)
select radar, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as ts, height, dens from layers join best using (radar, ts)""")
def j6(spark, d):
    out = C.select_nearest_profile(D.layers(spark, d), F.lit("2025-07-14 13:03:00").cast("timestamp"))
    return out.select("radar", iso(F.col("ts")).alias("ts"), "height", "dens")


TABLES["nearest_pairs"] = """
  select e.radar, e.ts, o.ts as ts_r, (epoch_us(e.ts) - epoch_us(o.ts)) / 1e6 as offset_s from external_profiles e join own_profiles o on o.radar = e.radar and cast(o.ts as date) = cast(e.ts as date) and abs(epoch_us(e.ts) - epoch_us(o.ts)) <= 300000000
  qualify row_number() over (partition by e.radar, e.ts order by abs(epoch_us(e.ts) - epoch_us(o.ts)), o.ts) = 1"""


def nearest_pairs(spark, d):
    ext = D.external_layers(spark, d).select("radar", "ts").distinct()
    own = D.layers(spark, d).select("radar", "ts").distinct()
    return C.asof_nearest(ext, own)


@query("j7_asof_repeated_rows", "select p.radar, p.pulse, p.bin, strftime(p.ts, '%Y-%m-%dT%H:%M:%SZ') as ts, strftime(n.ts_r, '%Y-%m-%dT%H:%M:%SZ') as ts_r from external_layers p join nearest_pairs n on n.radar = p.radar and n.ts = p.ts")
def j7_rows(spark, d):
    """Layers, of which many share a radar and a time: each gets its partner."""
    out = C.asof_nearest(D.external_layers(spark, d).select("radar", "ts", "pulse", "bin"), D.layers(spark, d).select("radar", "ts").distinct())
    return out.select("radar", "pulse", "bin", iso(F.col("ts")).alias("ts"), iso(F.col("ts_r")).alias("ts_r"))


@query("j7_asof_nearest_join", "select radar, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as ts, strftime(ts_r, '%Y-%m-%dT%H:%M:%SZ') as ts_r, offset_s, case when offset_s = 0 then 'exact' else 'cadence-adjusted' end as match from nearest_pairs")
def j7(spark, d):
    return nearest_pairs(spark, d).select("radar", iso(F.col("ts")).alias("ts"), iso(F.col("ts_r")).alias("ts_r"), "offset_s", "match")


@query("w7_nearest_rank", """
select e.radar, strftime(e.ts, '%Y-%m-%dT%H:%M:%SZ') as ts, strftime(o.ts, '%Y-%m-%dT%H:%M:%SZ') as ts_r, row_number() over (partition by e.radar, e.ts order by abs(epoch_us(e.ts) - epoch_us(o.ts)), o.ts) as rank
from external_profiles e join own_profiles o on o.radar = e.radar and cast(o.ts as date) = cast(e.ts as date) and abs(epoch_us(e.ts) - epoch_us(o.ts)) <= 600000000
qualify row_number() over (partition by e.radar, e.ts order by abs(epoch_us(e.ts) - epoch_us(o.ts)), o.ts) <= 2""")
def w7(spark, d):
    ext = D.external_layers(spark, d).select("radar", "ts").distinct()
    own = D.layers(spark, d).select("radar", "ts").distinct()
    out = C.asof_nearest(ext, own, tolerance_s=600, nearest=2)
    return out.select("radar", iso(F.col("ts")).alias("ts"), iso(F.col("ts_r")).alias("ts_r"), F.col("rank").cast("long").alias("rank"))


@query("f13_time_tolerance", "select radar, count(*) filter (where abs(offset_s) <= 60) as within_minute, count(*) as within_five from nearest_pairs group by radar")
def f13(spark, d):
    return nearest_pairs(spark, d).groupBy("radar").agg(F.count_if(F.abs("offset_s") <= 60).alias("within_minute"), F.count("*").alias("within_five"))


#: The variables that archives are compared in, and how they come from layers.
VARIABLES = {"dens": "dens", "eta": "dens * 11.0", "dbz": "dbzh", "dbz_all": "dbzh + 1.0", "u": "ff * sin(radians(dd))", "v": "ff * cos(radians(dd))", "ff": "ff", "dd": "dd"}
_SIDE = "select radar, ts, height, " + ", ".join(f"max_by({e}, bin) as {v}" for v, e in VARIABLES.items())
TABLES["altitude_pairs"] = f"""
  select p.radar, p.ts, e.height, {", ".join(f"o.{v} as {v}_a, e.{v} as {v}_b" for v in VARIABLES)} from nearest_pairs p
  join ({_SIDE} from external_layers group by all) e on e.radar = p.radar and e.ts = p.ts
  join ({_SIDE} from layers group by all) o on o.radar = p.radar and o.ts = p.ts_r and o.height = e.height"""
TABLES["long_pairs"] = " union all ".join(f"select radar, '{v}' as variable, {v}_a as a, {v}_b as b from altitude_pairs where {v}_a is not null and {v}_b is not null" for v in VARIABLES)


def altitude_pairs(spark, d):
    pairs = nearest_pairs(spark, d).select("radar", "ts", "ts_r")
    ext = D.external_layers(spark, d).join(pairs.select("radar", "ts"), ["radar", "ts"])
    own = D.layers(spark, d).withColumnRenamed("ts", "ts_r").join(pairs, ["radar", "ts_r"]).drop("ts_r")
    side = lambda df: df.selectExpr("radar", "ts", "height", "bin", *[f"{e} as {v}" for v, e in VARIABLES.items()])
    return C.match_altitudes(side(own), side(ext), ["radar", "ts"], list(VARIABLES))


@query("j8_match_altitudes", "select radar, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') as ts, height, round(dens_a, 6) as dens_a, round(dens_b, 6) as dens_b, round(ff_a, 6) as ff_a, round(ff_b, 6) as ff_b from altitude_pairs")
def j8(spark, d):
    out = altitude_pairs(spark, d)
    return out.select("radar", iso(F.col("ts")).alias("ts"), "height", *[F.round(c, 6).alias(c) for c in ("dens_a", "dens_b", "ff_a", "ff_b")])


@query("a12_error_metrics", "select radar, variable, count(*) as count, round(avg(a), 6) as mean_a, round(avg(b), 6) as mean_b, round(avg(b - a), 6) as bias, round(avg(abs(b - a)), 6) as mae, round(sqrt(avg((b - a) * (b - a))), 6) as rmse from long_pairs group by all")
def a12(spark, d):
    return C.error_metrics(C.long_pairs(altitude_pairs(spark, d), ["radar"], list(VARIABLES)), ["radar", "variable"], 6)


@query("a13_pair_statistics", "select variable, count(*) as count, round(avg(b - a), 6) as bias, round(avg(abs(b - a)), 6) as mae, round(sqrt(avg((b - a) * (b - a))), 6) as rmse, round(corr(a, b), 5) as correlation, round(median(a / b) filter (where a > 0 and b > 0), 6) as median_ratio, round(median(log10(a / b)) filter (where a > 0 and b > 0 and variable = 'dens'), 6) as median_log10_ratio from long_pairs group by variable")
def a13(spark, d):
    out = C.pair_statistics(C.long_pairs(altitude_pairs(spark, d), ["radar"], list(VARIABLES)), ["variable"])
    return out.withColumns({c: F.round(c, 6) for c in ("bias", "mae", "rmse", "median_ratio", "median_log10_ratio")} | {"correlation": F.round("correlation", 5)})


@query("a13_median_offset", "select radar, median(abs(offset_s)) as median_offset_s from nearest_pairs group by radar")
def a13_offset(spark, d):
    return C.median_offsets(nearest_pairs(spark, d), ["radar"])


@query("u3_common_heights", "select radar, count(*) as heights from (select radar, height from layers intersect select radar, height + 400 from external_layers) group by radar")
def u3(spark, d):
    both = D.layers(spark, d).select("radar", "height").intersect(D.external_layers(spark, d).select("radar", F.col("height") + 400))
    return both.groupBy("radar").agg(F.count("*").alias("heights"))


MAPPING = "select 'radar-' || lpad(cast(n_nationkey % 5 as varchar), 2, '0') as radar, n_name as other, case when n_nationkey = 3 then 'web' else 'baltrad' end as source, case when n_nationkey % 2 = 0 then 'exact' else 'near' end as class, case when n_nationkey = 1 then 60 end as tolerance_s from nation where n_nationkey < 6"
TABLES["crosswalk"] = f"""select m.radar, other, source, class, coalesce(tolerance_s, case when class = 'exact' then 0 else 300 end) as tolerance_s,
  coalesce(array_to_string([case when r.radar is null then 'unknown_radar' end, case when source <> 'baltrad' then 'source' end, case when count(*) over (partition by m.radar) > 1 then 'duplicate' end], ','), '') as problems from ({MAPPING}) m left join radars r on r.radar = m.radar"""


def crosswalk(spark, d):
    m = D.table(spark, d, "nation").where("n_nationkey < 6").selectExpr("concat('radar-', lpad(cast(n_nationkey % 5 as string), 2, '0')) as radar", "n_name as other", "if(n_nationkey = 3, 'web', 'baltrad') as source", "if(n_nationkey % 2 = 0, 'exact', 'near') as class", "if(n_nationkey = 1, 60, null) as tolerance_s")
    return C.build_crosswalk(m, D.radars(spark, d), ["baltrad"], ["exact", "near"])


@query("j15_build_crosswalk", "select * from crosswalk")
def j15(spark, d):
    return crosswalk(spark, d).select("radar", "other", "source", "class", "tolerance_s", F.array_join("problems", ",").alias("problems"))


@query("j15_unmatched_radars", f"select s.radar from (select 'radar-' || case when s_suppkey < 100 then lpad(cast(s_suppkey as varchar), 2, '0') else cast(s_suppkey as varchar) end as radar from supplier) s where radar not in (select radar from ({MAPPING}))")
def j15_unmatched(spark, d):
    sites = D.table(spark, d, "supplier").selectExpr("concat('radar-', if(s_suppkey < 100, lpad(cast(s_suppkey as string), 2, '0'), cast(s_suppkey as string))) as radar")
    return C.unmatched_radars(crosswalk(spark, d), sites)


REPORTS = "select upper(c.radar) as radar, case when o_orderkey % 3 = 0 then 'uva' else source end as source, lower(other) as other, cast(o_orderdate as varchar) as generated_at, o_orderkey as ord, cast(o_orderkey % 50 as int) as levels from crosswalk c join orders on o_orderkey % 7 = cast(substr(c.radar, 7) as int) where c.radar <> 'radar-01'"
TABLES["comparison_index"] = f"select c.*, r.generated_at is not null as report_available, r.generated_at, r.levels from crosswalk c left join (select * from ({REPORTS}) qualify row_number() over (partition by radar, source, other order by generated_at desc, ord) = 1) r on lower(r.radar) = lower(c.radar) and r.source = c.source and lower(r.other) = lower(c.other)"


def index(spark, d):
    c = crosswalk(spark, d)
    o = D.table(spark, d, "orders").selectExpr("o_orderkey", "cast(o_orderdate as string) as generated_at")
    reports = c.where("radar != 'radar-01'").join(o, F.expr("o_orderkey % 7 = cast(substr(radar, 7) as int)")).selectExpr("upper(radar) as radar", "if(o_orderkey % 3 = 0, 'uva', source) as source", "lower(other) as other", "generated_at", "o_orderkey as order", "cast(o_orderkey % 50 as int) as levels")
    return C.comparison_index(c, reports)


@query("j16_comparison_index", "select radar, other, report_available, substr(generated_at, 1, 10) as generated_at, levels from comparison_index")
def j16(spark, d):
    return index(spark, d).select("radar", "other", "report_available", F.substring("generated_at", 1, 10).alias("generated_at"), "levels")


@query("p28_comparison_status", "select r.radar, case when report_available is null then 'none' when not report_available then 'configured' else 'published (' || cast(levels as varchar) || ' levels)' end as status from radars r left join comparison_index i on i.radar = r.radar and i.other <> 'ETHIOPIA'")
def p28(spark, d):
    return C.comparison_status(D.radars(spark, d), index(spark, d).where("other != 'ETHIOPIA'"))


@query("w9_latest_report", f"select radar, source, other, substr(generated_at, 1, 10) as day, ord from (select * from ({REPORTS}) qualify row_number() over (partition by radar, source, other order by generated_at desc, ord) = 1)")
def w9(spark, d):
    from pyspark.sql import Window

    c = crosswalk(spark, d).where("radar != 'radar-01'")
    o = D.table(spark, d, "orders").selectExpr("o_orderkey as ord", "cast(o_orderdate as string) as generated_at")
    w = Window.partitionBy("radar", "source", "other").orderBy(F.desc("generated_at"), "ord")
    j = c.join(o, F.expr("ord % 7 = cast(substr(radar, 7) as int)")).selectExpr("upper(radar) as radar", "if(ord % 3 = 0, 'uva', source) as source", "lower(other) as other", "generated_at", "ord").withColumn("n", F.row_number().over(w)).where("n = 1")
    return j.select("radar", "source", "other", F.substring("generated_at", 1, 10).alias("day"), "ord")


# validation of predictions

TABLES["match"] = "select h.radar, h.pulse, h.hour, h.mean_mtr_birds_km_h as observed, p.mtr as predicted from hourly h join predictions p using (radar, pulse, hour)"


def match(spark, d):
    h = D.hourly(spark, d).select("radar", "pulse", "hour", F.col("mean_mtr_birds_km_h").alias("observed"))
    p = D.predictions(spark, d).select("radar", "pulse", "hour", F.col("mtr").alias("predicted"), F.lit(1).alias("file_order"))
    older = p.withColumns({"predicted": F.lit(0.0), "file_order": F.lit(0)})
    return C.match_hours(h, p.union(older), ["radar", "pulse", "hour"], "file_order")


@query("j12_match_prediction_hour", f"select radar, pulse, {HOUR} as hour, observed, round(predicted, 6) as predicted from match")
def j12(spark, d):
    return match(spark, d).select("radar", "pulse", iso(F.col("hour")).alias("hour"), "observed", F.round("predicted", 6).alias("predicted"))


SCORE = """count(*) as row_count, round(sqrt(avg(power(predicted - observed, 2))), 6) as rmse, round(avg(abs(predicted - observed)), 6) as mae, round(avg(predicted - observed), 6) + 0.0 as bias,
  round(1 - sum(power(predicted - observed, 2)) / sum(power(observed - mean, 2)), 6) as r_squared, round(count(*) filter (where observed >= cut and predicted >= cut) / count(*) filter (where predicted >= cut), 6) as top_decile_precision,
  round(count(*) filter (where observed >= cut and predicted >= cut) / count(*) filter (where observed >= cut), 6) as top_decile_recall"""


@query("a14_score_regression", f"select pulse, {SCORE} from match join (select pulse, quantile_cont(observed, 0.9) as cut, avg(observed) as mean from match group by pulse) using (pulse) group by pulse")
def a14(spark, d):
    out = V.score_regression(match(spark, d), ["pulse"])
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in out.columns if c not in ("pulse", "row_count")})


@query("a15_pooled_and_per_site", "select pulse, radar, count(*) as count, round(avg(predicted - observed), 6) + 0.0 as bias, round(avg(abs(predicted - observed)), 6) as mae, round(sqrt(avg(power(predicted - observed, 2))), 6) as rmse from match group by grouping sets ((pulse, radar), (pulse))")
def a15(spark, d):
    out = V.pooled_and_per_site(match(spark, d), "pulse", "radar")
    return out.withColumns({c: F.round(c, 6) + 0.0 for c in ("bias", "mae", "rmse")})


def weeks(spark, d):
    return D.region_weeks(spark, d)


@query("j14_match_region_week", "select region, cast(week_start as varchar) as week_start, reporting_rate, radar_intensity + 1 as radar_intensity, complete_list_count from region_weeks where extract(day from week_start) <> 3")
def j14(spark, d):
    w = weeks(spark, d)
    radar = w.where("day(week_start) != 3").selectExpr("region", "week_start", "explode(array(struct(radar_intensity as v, 0 as o), struct(radar_intensity + 1 as v, 1 as o))) as x").selectExpr("region", "week_start", "x.v as radar_intensity", "x.o as row_order")
    return text(V.match_region_weeks(w.drop("radar_intensity"), radar), "week_start")


@query("a16_pearson", "select region, round(coalesce(corr(reporting_rate, radar_intensity), 0), 6) as pearson from region_weeks group by region")
def a16(spark, d):
    return weeks(spark, d).groupBy("region").agg(F.round(V.pearson("reporting_rate", "radar_intensity"), 6).alias("pearson"))


TABLES["ranked_weeks"] = "select region, week_start, rank() over (partition by region order by reporting_rate) + (count(*) over (partition by region, reporting_rate) - 1) / 2.0 as a, rank() over (partition by region order by radar_intensity) + (count(*) over (partition by region, radar_intensity) - 1) / 2.0 as b from region_weeks"


@query("w4_average_rank", "select region, cast(week_start as varchar) as week_start, cast(a as double) as rank_reporting_rate, cast(b as double) as rank_radar_intensity from ranked_weeks")
def w4(spark, d):
    out = V.average_ranks(weeks(spark, d), ["region"], "reporting_rate", "radar_intensity")
    return text(out.select("region", "week_start", F.col("rank_reporting_rate").cast("double").alias("rank_reporting_rate"), F.col("rank_radar_intensity").cast("double").alias("rank_radar_intensity")), "week_start")


@query("a17_spearman", "select region, round(corr(a, b), 6) as spearman from ranked_weeks group by region")
def a17(spark, d):
    return V.spearman(weeks(spark, d), ["region"], "reporting_rate", "radar_intensity").withColumn("spearman", F.round("spearman", 6))


TABLES["peaks"] = "select region, (select week_start from region_weeks x where x.region = r.region order by reporting_rate desc, week_start limit 1) as rate_peak, (select week_start from region_weeks x where x.region = r.region order by radar_intensity desc, week_start limit 1) as radar_peak from (select distinct region from region_weeks) r"


@query("a18_peak_timing_error", "select region, cast(rate_peak as varchar) as rate_peak, cast(radar_peak as varchar) as radar_peak, abs(date_diff('day', radar_peak, rate_peak)) / 7.0::double as weeks from peaks")
def a18(spark, d):
    return text(V.peak_timing_error(weeks(spark, d)), "rate_peak", "radar_peak")


@query("w10_peak_row", "select region, cast(radar_peak as varchar) as week_start from peaks")
def w10(spark, d):
    return text(V.peak_rows(weeks(spark, d), ["region"], "radar_intensity", "week_start").select("region", "week_start"), "week_start")


@query("o6_top_k", "select region, cast(week_start as varchar) as week_start, radar_intensity, row_number() over (partition by region order by radar_intensity desc, week_start) as place from region_weeks qualify row_number() over (partition by region order by radar_intensity desc, week_start) <= 3")
def o6(spark, d):
    out = V.top_rows(weeks(spark, d), ["region"], "radar_intensity", "week_start", 3)
    return text(out.select("region", "week_start", "radar_intensity", F.col("place").cast("long").alias("place")), "week_start")


TABLES["tops"] = "select region, week_start, row_number() over (partition by region order by reporting_rate desc, week_start) <= greatest(1, ceil(count(*) over (partition by region) * 0.2)) as a, row_number() over (partition by region order by radar_intensity desc, week_start) <= greatest(1, ceil(count(*) over (partition by region) * 0.2)) as b from region_weeks"


@query("w5_top_fraction_flag", "select region, cast(week_start as varchar) as week_start, b as top from tops")
def w5(spark, d):
    out = V.top_fraction(weeks(spark, d), ["region"], "radar_intensity", ["week_start"])
    return text(out.select("region", "week_start", F.col("top_radar_intensity").alias("top")), "week_start")


@query("a19_top_overlap", "select region, round(count(*) filter (where a and b) / count(*) filter (where a or b), 6) as overlap from tops group by region")
def a19(spark, d):
    return V.top_overlap(weeks(spark, d), ["region"], "reporting_rate", "radar_intensity", ["week_start"]).withColumn("overlap", F.round("overlap", 6))


@query("a20_effort_sum", "select region, cast(sum(complete_list_count) as bigint) as effort, count(distinct week_start) as weeks, cast(max(week_start) as varchar) as latest from region_weeks group by region")
def a20(spark, d):
    return weeks(spark, d).groupBy("region").agg(F.sum("complete_list_count").alias("effort"), F.countDistinct("week_start").alias("weeks"), F.max("week_start").cast("string").alias("latest"))


@query("w6_blocked_time_split", f"select radar, pulse, {HOUR} as hour, hour <= (select hour from (select hour, row_number() over (order by hour) as i, count(*) over () as n from (select distinct hour from match)) where i = floor(n * 0.8)) as is_train from match")
def w6(spark, d):
    return V.blocked_time_split(match(spark, d)).select("radar", "pulse", iso(F.col("hour")).alias("hour"), "is_train")


@query("f15_minimum_evidence", "select pulse, count(*) as rows, count(distinct radar) as radars, count(*) >= 30 and count(distinct radar) >= 2 as enough from match group by pulse")
def f15(spark, d):
    return V.evidence_gate(match(spark, d), ["pulse"])


def metrics(spark, d, run):
    """Metrics of two runs by (validation, pulse, target), made from part and supplier prices."""
    p = D.table(spark, d, "part").where("p_partkey >= 0")
    shift = {"baseline": 0, "candidate": 7}[run]
    return p.groupBy(F.expr("if(p_size % 2 = 0, 'leave_one_radar_out', 'blocked_time')").alias("validation"), F.expr("if(p_partkey % 2 = 0, 'lp', 'sp')").alias("pulse"), F.expr("element_at(array('mtr_birds_km_h', 'vid_birds_per_km2', 'bird_u_ms', 'bird_v_ms'), cast(p_partkey div 2 % 4 as int) + 1)").alias("target")).agg(
        F.round(F.avg(F.expr(f"p_retailprice * (1.0D - {shift} / 50.0D)")), 6).alias("rmse"), F.round(F.avg(F.expr(f"(p_size + {shift}) / 100.0D")), 6).alias("r_squared"),
        F.round(F.avg(F.expr(f"(p_partkey % 10 + {shift}) / 20.0D")), 6).alias("top_decile_precision"), F.round(F.avg(F.expr(f"(p_partkey % 7 + {shift}) / 20.0D")), 6).alias("top_decile_recall"),
    )


for _run, _shift in (("baseline", 0), ("candidate", 7)):
    TABLES[f"metrics_{_run}"] = f"select case when p_size % 2 = 0 then 'leave_one_radar_out' else 'blocked_time' end as validation, case when p_partkey % 2 = 0 then 'lp' else 'sp' end as pulse, ['mtr_birds_km_h', 'vid_birds_per_km2', 'bird_u_ms', 'bird_v_ms'][cast(p_partkey // 2 % 4 as int) + 1] as target, round(avg(p_retailprice * (1.0 - {_shift} / 50.0)), 6) as rmse, round(avg((p_size + {_shift}) / 100.0), 6) as r_squared, round(avg((p_partkey % 10 + {_shift}) / 20.0), 6) as top_decile_precision, round(avg((p_partkey % 7 + {_shift}) / 20.0), 6) as top_decile_recall from part group by all"
TABLES["delta"] = "select pulse, target, b.r_squared as r_squared_baseline, b.rmse as rmse_baseline, c.r_squared as r_squared_candidate, c.rmse as rmse_candidate, c.r_squared - b.r_squared as d_r_squared, c.rmse - b.rmse as d_rmse from (select * from metrics_baseline where validation = 'leave_one_radar_out') b full join (select * from metrics_candidate where validation = 'leave_one_radar_out' and target <> 'bird_v_ms') c using (pulse, target)"


def delta(spark, d, skip="bird_v_ms"):
    held = lambda run: metrics(spark, d, run).where("validation = 'leave_one_radar_out'")
    return V.metric_delta(held("baseline"), held("candidate").where(F.col("target") != skip))


@query("j17_metric_delta", "select pulse, target, r_squared_baseline, rmse_baseline, r_squared_candidate, rmse_candidate, round(d_r_squared, 6) as d_r_squared, round(d_rmse, 6) as d_rmse from delta")
def j17(spark, d):
    return delta(spark, d).withColumns({"d_r_squared": F.round("d_r_squared", 6), "d_rmse": F.round("d_rmse", 6)})


TABLES["family_checks"] = """
  select validation, pulse, target, case when b.rmse > 0 then (b.rmse - c.rmse) / b.rmse else '-infinity'::double end as improvement, c.top_decile_precision >= b.top_decile_precision and c.top_decile_recall >= b.top_decile_recall as events_better,
    b.rmse is not null and c.rmse is not null as complete, c.rmse <= b.rmse * 1.02 as vector_ok
  from (select * from (values ('leave_one_radar_out'), ('blocked_time')) v(validation), (values ('lp'), ('sp')) p(pulse), (values ('mtr_birds_km_h'), ('vid_birds_per_km2'), ('bird_u_ms'), ('bird_v_ms')) t(target))
  left join metrics_baseline b using (validation, pulse, target) left join (select * from metrics_candidate where not (validation = 'blocked_time' and pulse = 'sp' and target = 'vid_birds_per_km2')) c using (validation, pulse, target)"""


def challenger(spark, d):
    return metrics(spark, d, "candidate").where("not (validation = 'blocked_time' and pulse = 'sp' and target = 'vid_birds_per_km2')")


@query("m13_family_checks", "select validation, pulse, target, case when complete then round(improvement, 6) end as improvement, case when complete then events_better end as events_better, complete and improvement >= 0.10 and events_better as passed, case when not complete then 'missing_metrics' end as reason from family_checks where target in ('mtr_birds_km_h', 'vid_birds_per_km2')")
def m13_checks(spark, d):
    return V.family_checks(metrics(spark, d, "baseline"), challenger(spark, d)).withColumn("improvement", F.round("improvement", 6))


@query("m13_select_model_family", """
select bool_and(complete and improvement >= 0.10 and events_better) filter (where target in ('mtr_birds_km_h', 'vid_birds_per_km2') and validation = 'leave_one_radar_out') as intensity_ok,
  bool_and(complete and vector_ok) filter (where target in ('bird_u_ms', 'bird_v_ms') and validation = 'leave_one_radar_out') as vectors_not_worse, true as temporal_required,
  bool_and(complete and improvement >= 0.10 and events_better) filter (where target in ('mtr_birds_km_h', 'vid_birds_per_km2') and validation = 'blocked_time') as temporal_ok,
  case when bool_and(case when target in ('mtr_birds_km_h', 'vid_birds_per_km2') then complete and improvement >= 0.10 and events_better when validation = 'leave_one_radar_out' then complete and vector_ok else true end) then 'challenger' else 'baseline' end as selected from family_checks""")
def m13(spark, d):
    """One decision over both validations; a metric of the challenger is missing."""
    return V.select_model_family(metrics(spark, d, "baseline"), challenger(spark, d))


_PRIMARY = "((pulse = 'lp' and target in ('mtr_birds_km_h', 'vid_birds_per_km2')) or (pulse = 'sp' and target = 'mtr_birds_km_h'))"


@query("m14_candidate_gate", f"select round(min(d_r_squared) filter (where {_PRIMARY}), 6) as worst_intensity, round(avg(d_r_squared) filter (where target in ('bird_u_ms', 'bird_v_ms') and pulse = 'lp'), 6) as mean_vector_gain, coalesce(min(d_r_squared) filter (where {_PRIMARY}) >= -0.01, false) and coalesce(avg(d_r_squared) filter (where target in ('bird_u_ms', 'bird_v_ms') and pulse = 'lp') >= 0.02, false) as accept from delta")
def m14(spark, d):
    return V.candidate_gate(delta(spark, d)).withColumns({"worst_intensity": F.round("worst_intensity", 6), "mean_vector_gain": F.round("mean_vector_gain", 6)})


@query("m15_component_selection", "select pulse, target, case when pulse = 'sp' and target in ('bird_u_ms', 'bird_v_ms') and bool_and(c.r_squared > b.r_squared) then 'candidate' else 'baseline' end as run from metrics_baseline b join metrics_candidate c using (validation, pulse, target) group by pulse, target")
def m15(spark, d):
    return V.component_selection(metrics(spark, d, "baseline"), metrics(spark, d, "candidate"))


@query("u4_union_of_keys", "select count(*) as keys, count(*) filter (where rmse_candidate is null) as only_baseline from delta")
def u4(spark, d):
    return delta(spark, d).agg(F.count("*").alias("keys"), F.count_if(F.col("rmse_candidate").isNull()).alias("only_baseline"))
