"""Tables of the domain, derived from the given ones by arithmetic that SQL repeats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from aeroskein.operators.observed import hourly_rows, night_metrics
from aeroskein.operators.profiles import integrate_profiles
from aeroskein.plans.registry import TABLES

START = "timestamp '2025-07-14 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Altitude layers: an order is a profile, a line number an altitude bin. After sixteen times there is a gap of forty minutes."""
    orders, items = table(spark, sf_dir, "orders").select("o_orderkey"), table(spark, sf_dir, "lineitem")
    joined = orders.join(items, F.col("l_orderkey") == F.col("o_orderkey"))
    sums = joined.groupBy("o_orderkey", "l_linenumber").agg(
        F.min("l_quantity").alias("q"), F.min("l_discount").alias("d"), F.min("l_partkey").alias("p"), F.min("l_tax").alias("t"),
        F.every(F.col("l_returnflag") == "R").alias("gap"),
    )
    return sums.selectExpr(
        "concat('radar-', lpad(cast(o_orderkey % 4 as string), 2, '0')) as radar", "if(o_orderkey % 5 = 0, 'sp', 'lp') as pulse",
        f"timestampadd(MINUTE, cast((o_orderkey div 4) * 5 + (o_orderkey div 64) * 40 as int), {START}) as ts", "200.0D * l_linenumber as height",
        "q / 10.0D as dens", "2.0D + d * 100.0D as ff", "cast((p * 37) % 360 as double) as dd",
        "t * 200.0D - 4.0D + if(o_orderkey % 7 = 0, 12.0D, 0.0D) as dbzh", "gap", "cast(l_linenumber as int) as bin",
    )


TABLES["layers"] = """
  select 'radar-' || lpad(cast(o_orderkey % 4 as varchar), 2, '0') as radar, case when o_orderkey % 5 = 0 then 'sp' else 'lp' end as pulse,
    timestamp '2025-07-14 00:00:00' + to_minutes(cast((o_orderkey // 4) * 5 + (o_orderkey // 64) * 40 as int)) as ts, 200.0::double * l_linenumber as height,
    min(l_quantity) / 10.0::double as dens, 2.0::double + min(l_discount) * 100.0::double as ff, cast((min(l_partkey) * 37) % 360 as double) as dd,
    min(l_tax) * 200.0::double - 4.0::double + case when o_orderkey % 7 = 0 then 12.0::double else 0.0::double end as dbzh,
    bool_and(l_returnflag = 'R') as gap, cast(l_linenumber as int) as bin
  from orders join lineitem on l_orderkey = o_orderkey group by o_orderkey, l_linenumber
"""
TABLES["widths"] = """
  select radar, pulse, ts, coalesce(median(h - was), 200.0) / 1000.0 as width
  from (select radar, pulse, ts, height as h, lag(height) over (partition by radar, pulse, ts order by height) as was
        from (select distinct radar, pulse, ts, height from layers where height between 200 and 4000)) group by all
"""
TABLES["profile_sums"] = """
  select radar, pulse, ts, any_value(width) as width, count(*) filter (where gap) as gaps,
    count(*) filter (where not gap and dens >= 0) as n_dens, count(*) filter (where not gap and dens >= 0 and ff >= 0) as n_mtr,
    sum(dens * width) filter (where not gap and dens >= 0) as vid, sum(height * dens * width) filter (where not gap and dens >= 0) as hd,
    sum(dens * ff * 3.6 * width) filter (where not gap and dens >= 0 and ff >= 0) as rate,
    sum(ff * dens * width) filter (where not gap and dens >= 0 and ff >= 0) as sd,
    sum(sin(radians(dd)) * dens * ff * 3.6 * width) filter (where not gap and dens * ff > 0) as east,
    sum(cos(radians(dd)) * dens * ff * 3.6 * width) filter (where not gap and dens * ff > 0) as north,
    count(*) filter (where not gap and dbzh is not null and height <= 2000) as bins,
    count(*) filter (where not gap and dbzh > 7 and height <= 2000) as wet
  from layers join widths using (radar, pulse, ts) where height between 200 and 4000 group by all
"""
TABLES["profiles"] = """
  select radar, pulse, ts, hour(ts) >= 6 and hour(ts) < 18 as is_day,
    case when hour(ts) < 6 then cast(ts as date) - 1 when hour(ts) >= 18 then cast(ts as date) end as night_date,
    case when n_dens > 0 then vid end as vid_birds_per_km2,
    case when n_dens = 0 then null when vid = 0 then 0.0 when n_mtr = 0 or (bins >= 5 and wet / bins >= 0.8) then null else rate end as mtr_birds_km_h,
    case when vid > 0 then sd / vid end as mean_ground_speed_ms,
    case when east <> 0 or north <> 0 then round((degrees(atan2(east, north)) + 360.0) % 360.0, 6) end as dominant_direction_deg,
    case when vid > 0 then hd / vid end as density_weighted_mean_height_m,
    n_dens as density_layer_count, n_mtr as mtr_layer_count, gaps as gap_layer_count, width as layer_width_km,
    bins >= 5 and wet / bins >= 0.8 as rain_suspect, case when bins > 0 then wet / bins else 0.0 end as rain_layer_fraction
  from profile_sums
"""


def profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrate_profiles(layers(spark, sf_dir))


TABLES["hourly"] = """
  select radar, pulse, date_trunc('hour', ts) as hour, count(*) as profile_count,
    count(*) filter (where mtr_birds_km_h is not null and not rain_suspect) as usable_mtr_profile_count,
    round(avg(mtr_birds_km_h) filter (where not rain_suspect), 6) as mean_mtr_birds_km_h, round(avg(vid_birds_per_km2), 6) as mean_vid_birds_per_km2,
    round(avg(mean_ground_speed_ms), 6) as mean_ground_speed_ms,
    round(avg(case when rain_suspect then 1.0 else 0.0 end), 6) as rain_suspect_fraction,
    round(avg(case when night_date is null then 0.0 else 1.0 end), 6) as night_profile_fraction,
    case when count(dominant_direction_deg) = count(dominant_direction_deg + mtr_birds_km_h)
          and (sum(sin(radians(dominant_direction_deg)) * mtr_birds_km_h) <> 0 or sum(cos(radians(dominant_direction_deg)) * mtr_birds_km_h) <> 0)
      then round((degrees(atan2(sum(sin(radians(dominant_direction_deg)) * mtr_birds_km_h), sum(cos(radians(dominant_direction_deg)) * mtr_birds_km_h))) + 360.0) % 360.0, 6)
      end as dominant_direction_deg
  from profiles group by radar, pulse, date_trunc('hour', ts)
"""


def hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hourly_rows(profiles(spark, sf_dir))


TABLES["nights"] = """
  select radar, night_date, count(*) as profile_count, count(*) filter (where ok) as usable_profile_count,
    count(*) filter (where linked) as integrated_interval_count, round(coalesce(sum(hours) filter (where linked), 0), 6) as integrated_hours,
    round(coalesce(sum((was + mtr_birds_km_h) / 2 * hours) filter (where linked), 0), 6) as migration_traffic_birds_per_km,
    round(sum((was + mtr_birds_km_h) / 2 * hours) filter (where linked) / sum(hours) filter (where linked), 6) as mean_mtr_birds_km_h,
    round(max(mtr_birds_km_h) filter (where ok), 6) as peak_mtr_birds_km_h, round(avg(mean_ground_speed_ms) filter (where ok), 6) as mean_ground_speed_ms,
    case when sum(sin(radians(dominant_direction_deg)) * mtr_birds_km_h) filter (where ok) <> 0 or sum(cos(radians(dominant_direction_deg)) * mtr_birds_km_h) filter (where ok) <> 0
      then round((degrees(atan2(sum(sin(radians(dominant_direction_deg)) * mtr_birds_km_h) filter (where ok), sum(cos(radians(dominant_direction_deg)) * mtr_birds_km_h) filter (where ok))) + 360.0) % 360.0, 6) end as dominant_direction_deg,
    round(avg(density_weighted_mean_height_m) filter (where ok), 6) as mean_flight_height_m,
    round(avg(case when rain_suspect then 1.0 else 0.0 end), 6) as rain_contamination_fraction,
    case when count(*) filter (where linked) > 0 then 'partial' else 'insufficient' end as quality_class,
    array_to_string(list_sort(list(distinct pulse)), ',') as pulse_products
  from (select *, (epoch_us(ts) - epoch_us(lag(ts) over w)) / 3.6e9 as hours, lag(mtr_birds_km_h) over w as was,
          ok and (epoch_us(ts) - epoch_us(lag(ts) over w)) > 0 and (epoch_us(ts) - epoch_us(lag(ts) over w)) <= 30 * 60000000 as linked
        from (select *, mtr_birds_km_h is not null and not rain_suspect as ok from profiles where night_date is not null)
        window w as (partition by radar, night_date, ok order by ts, pulse))
  group by radar, night_date
"""


def nights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return night_metrics(profiles(spark, sf_dir))


def radars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").where("n_nationkey < 4").selectExpr(
        "concat('radar-', lpad(cast(n_nationkey as string), 2, '0')) as radar", "50.0D + 2.0D * n_nationkey as latitude", "-5.0D + 1.5D * n_nationkey as longitude",
        "100.0D * n_nationkey as height_m", "255000.0D as max_range_m", "n_name as label",
    )


TABLES["radars"] = """
  select 'radar-' || lpad(cast(n_nationkey as varchar), 2, '0') as radar, 50.0::double + 2.0::double * n_nationkey as latitude,
    -5.0::double + 1.5::double * n_nationkey as longitude, 100.0::double * n_nationkey as height_m, 255000.0::double as max_range_m, n_name as label
  from nation where n_nationkey < 4
"""


def stations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A larger network: a station for each supplier."""
    return table(spark, sf_dir, "supplier").selectExpr(
        "concat('station-', cast(s_suppkey as string)) as radar", "45.0D + (s_suppkey * 7 % 150) / 10.0D as latitude", "-9.0D + (s_suppkey * 11 % 300) / 10.0D as longitude",
        "cast(s_suppkey % 900 as double) as height_m", "150000.0D + 1000.0D * (s_suppkey % 106) as max_range_m", "s_name as label",
    )


TABLES["stations"] = """
  select 'station-' || cast(s_suppkey as varchar) as radar, 45.0::double + (s_suppkey * 7 % 150) / 10.0::double as latitude, -9.0::double + (s_suppkey * 11 % 300) / 10.0::double as longitude,
    cast(s_suppkey % 900 as double) as height_m, 150000.0::double + 1000.0::double * (s_suppkey % 106) as max_range_m, s_name as label from supplier
"""
#: Predictors: name, base, factor of the hour, factor of the radar, modulus.
SURFACE = {"sp": (100000, 37, 11, 900), "msl": (101000, 41, 13, 800), "tcc": (0, 3, 5, 10), "blh": (200, 29, 7, 1500), "tp": (0, 5, 3, 4)}
LEVELS = {f"{v}_pressure_level_{p}": (b, 7 + i, 3 + i, m) for i, (v, p, b, m) in enumerate([("t", 850, 270, 20), ("r", 850, 30, 70), ("u", 850, -10, 21), ("v", 850, -9, 19), ("u", 925, -8, 17), ("v", 925, -7, 15), ("u", 700, -12, 25), ("v", 700, -11, 23)])}


def _predictor(spec: tuple[int, int, int, int], hour: str, k: str) -> str:
    base, a, b, m = spec
    return f"cast({base} + ({hour} * {a} + {k} * {b}) % {m} as double)"


def weather_site(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site weather in long form: two rows an hour, surface and pressure levels; some hours are missing."""
    sites = table(spark, sf_dir, "nation").where("n_nationkey < 4").selectExpr("cast(n_nationkey as bigint) as k", "concat('radar-', lpad(cast(n_nationkey as string), 2, '0')) as radar")
    hours = layers(spark, sf_dir).select(F.date_trunc("hour", "ts").alias("hour")).distinct()
    both = hours.join(F.broadcast(sites)).withColumn("h", F.expr(f"(unix_seconds(hour) - unix_seconds({START})) div 3600")).where("(h * 7 + k) % 97 != 0")
    part = lambda i, specs, others: both.selectExpr("radar", "hour", f"{i} as dataset_index", *[f"{_predictor(s, 'h', 'k')} as {n}" for n, s in specs.items()], *[f"cast(null as double) as {n}" for n in others])
    return part(0, SURFACE, LEVELS).unionByName(part(1, LEVELS, SURFACE))


TABLES["weather_hours"] = """
  select radar, k, hour, cast((epoch(hour) - epoch(timestamp '2025-07-14 00:00:00')) / 3600 as bigint) as h
  from (select distinct date_trunc('hour', ts) as hour from layers), (select cast(n_nationkey as bigint) as k, 'radar-' || lpad(cast(n_nationkey as varchar), 2, '0') as radar from nation where n_nationkey < 4)
  where (cast((epoch(hour) - epoch(timestamp '2025-07-14 00:00:00')) / 3600 as bigint) * 7 + k) % 97 <> 0
"""
TABLES["weather_site"] = " union all by name ".join(
    f"select radar, hour, {i} as dataset_index, " + ", ".join(f"{_predictor(s, 'h', 'k')} as {n}" for n, s in specs.items()) + " from weather_hours" for i, specs in ((0, SURFACE), (1, LEVELS))
)
TABLES["weather"] = "select radar, hour, " + ", ".join(f"max({n}) as {n}" for n in [*SURFACE, *LEVELS]) + " from weather_site group by radar, hour"


#: Cells of the derived grid that a task has. Each becomes 24 hours, 48 predictions or 72 rows of weather.
CELLS_A_TASK = 5_000


def cell_tasks(spark: SparkSession, sf_dir: str) -> int:
    """A task for every CELLS_A_TASK; of a small grid one for every core."""
    return max(spark.sparkContext.defaultParallelism, -(-table(spark, sf_dir, "customer").count() // CELLS_A_TASK))


def grid_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns, rows and places (i, j, latitude, longitude) of the derived grid, in tasks of some CELLS_A_TASK whatever files the customers come in.

    Cells are dealt by place: what groups them by place and hour is done in the same tasks, however many they are.
    """
    cells = table(spark, sf_dir, "customer").selectExpr("c_custkey % 41 as i", "c_custkey div 41 as j")
    return cells.selectExpr("i", "j", "48.0D + 0.25D * i as latitude", "-7.0D + 0.25D * j as longitude").repartition(cell_tasks(spark, sf_dir), "latitude", "longitude")


def grid_hours(spark: SparkSession, sf_dir: str, cells: DataFrame) -> DataFrame:
    """The 24 hours of each cell (i, j, latitude, longitude)."""
    hours = table(spark, sf_dir, "nation").where("n_nationkey < 24").selectExpr("cast(n_nationkey as bigint) as h")
    both = cells.join(F.broadcast(hours)).withColumn("cell", F.expr("i * 3 + j * 5"))
    return both.selectExpr("*", f"timestampadd(HOUR, cast(h as int), {START}) as hour")


def weather_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gridded weather in long form: 24 hours on a quarter-degree grid, a row for each level."""
    at = grid_hours(spark, sf_dir, grid_cells(spark, sf_dir))
    levels = at.select("*", F.explode(F.array(F.lit(700), F.lit(850), F.lit(925))).alias("level"))
    return levels.selectExpr(
        "hour", "latitude", "longitude", "level", f"{_predictor(SURFACE['sp'], 'h', 'cell')} as sp", f"{_predictor(SURFACE['tcc'], 'h', 'cell')} as tcc",
        "cast(270 + (h * 7 + cell * 3 + level) % 20 as double) as t", "cast(-10 + (h * 9 + cell * 5 + level) % 21 as double) as u", "cast(-9 + (h * 5 + cell * 7 + level) % 19 as double) as v",
    )


TABLES["weather_grid"] = f"""
  select timestamp '2025-07-14 00:00:00' + to_hours(cast(h as int)) as hour, 48.0::double + 0.25::double * i as latitude, -7.0::double + 0.25::double * j as longitude, level,
    {_predictor(SURFACE['sp'], 'h', 'cell')} as sp, {_predictor(SURFACE['tcc'], 'h', 'cell')} as tcc,
    cast(270 + (h * 7 + cell * 3 + level) % 20 as double) as t, cast(-10 + (h * 9 + cell * 5 + level) % 21 as double) as u, cast(-9 + (h * 5 + cell * 7 + level) % 19 as double) as v
  from (select c_custkey % 41 as i, c_custkey // 41 as j, (c_custkey % 41) * 3 + (c_custkey // 41) * 5 as cell from customer),
    (select cast(n_nationkey as bigint) as h from nation where n_nationkey < 24), (select unnest([700, 850, 925]) as level)
"""
TABLES["cells"] = "select distinct latitude, longitude from weather_grid"


def objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing of daily objects (radar, day, pulse, key, etag, size) with some missing."""
    days = layers(spark, sf_dir).groupBy("radar", F.to_date("ts").alias("day"), "pulse").agg(F.count("*").alias("size"))
    return days.where("(datediff(day, date '2025-07-14') + cast(substr(radar, 7) as int)) % 11 != 3").selectExpr(
        "radar", "day", "pulse", "concat('vpts/', radar, '/', date_format(day, 'yyyy'), '/', date_format(day, 'yyyyMMdd'), '_', pulse, '_vpts.csv') as key",
        "date_format(day, 'yyyyMMdd') as etag", "size",
    )


TABLES["objects"] = """
  select radar, cast(ts as date) as day, pulse, 'vpts/' || radar || '/' || strftime(cast(ts as date), '%Y') || '/' || strftime(cast(ts as date), '%Y%m%d') || '_' || pulse || '_vpts.csv' as key,
    strftime(cast(ts as date), '%Y%m%d') as etag, count(*) as size
  from layers where (date_diff('day', date '2025-07-14', cast(ts as date)) + cast(substr(radar, 7) as int)) % 11 <> 3 group by all
"""


def external_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers of another archive: all profiles, two minutes later, with fewer birds."""
    return layers(spark, sf_dir).withColumns({"ts": F.expr("timestampadd(MINUTE, 2, ts)"), "dens": F.col("dens") * 0.8})


TABLES["external_layers"] = "select * replace (ts + interval 2 minute as ts, dens * 0.8::double as dens) from layers"


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted hours (radar, pulse, hour, mtr, vid, u, v): the hourly rows, perturbed."""
    h = "(unix_seconds(hour) div 3600)"
    return hourly(spark, sf_dir).where("mean_mtr_birds_km_h is not null").selectExpr(
        "radar", "pulse", "hour", f"mean_mtr_birds_km_h + cast({h} % 7 - 3 as double) as mtr", f"mean_vid_birds_per_km2 * (1.0D + cast({h} % 5 - 2 as double) / 10.0D) as vid",
        f"cast({h} % 13 - 6 as double) as u", f"cast({h} % 11 - 5 as double) as v",
    )


TABLES["predictions"] = """
  select radar, pulse, hour, mean_mtr_birds_km_h + cast(cast(epoch(hour) as bigint) // 3600 % 7 - 3 as double) as mtr,
    mean_vid_birds_per_km2 * (1.0 + cast(cast(epoch(hour) as bigint) // 3600 % 5 - 2 as double) / 10.0) as vid,
    cast(cast(epoch(hour) as bigint) // 3600 % 13 - 6 as double) as u, cast(cast(epoch(hour) as bigint) // 3600 % 11 - 5 as double) as v
  from hourly where mean_mtr_birds_km_h is not null
"""


def region_weeks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(region, week_start, reporting_rate, radar_intensity, complete_list_count) from orders by the customer's region."""
    o, c = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    n, r = table(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey"), table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    j = o.join(c, F.col("o_custkey") == F.col("c_custkey")).join(n, F.col("c_nationkey") == F.col("n_nationkey")).join(r, F.col("n_regionkey") == F.col("r_regionkey"))
    return j.groupBy(F.col("r_name").alias("region"), F.to_date(F.date_trunc("week", "o_orderdate")).alias("week_start")).agg(
        F.round(F.avg((F.col("o_orderpriority") < "3").cast("double")), 6).alias("reporting_rate"), F.round(F.sum("o_totalprice"), 2).alias("radar_intensity"),
        F.count("*").alias("complete_list_count"),
    )


TABLES["region_weeks"] = """
  select r_name as region, cast(date_trunc('week', o_orderdate) as date) as week_start, round(avg(case when o_orderpriority < '3' then 1.0 else 0.0 end), 6) as reporting_rate,
    round(sum(o_totalprice), 2) as radar_intensity, count(*) as complete_list_count
  from orders join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey group by 1, 2
"""
