"""From profiles to hours and nights."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from aeroskein.functions.coerce import hour_key
from aeroskein.functions.domain import circular, intensity_class, quality_class, uv

MAX_GAP_MINUTES = 30.0


def usable() -> Column:
    """A profile with a rate and no suspicion of rain."""
    return F.col("mtr_birds_km_h").isNotNull() & ~F.col("rain_suspect")


def hourly_rows(profiles: DataFrame, with_nights: bool = True, event_time: str | None = None) -> DataFrame:
    """One row a (radar, pulse, hour). Pulses are never mixed. On a stream hours are windows of the column `event_time`.

    The mean rate is over usable profiles, the mean density over all. The direction is null
    if any profile with a direction has no rate.
    """
    direction, mtr = F.col("dominant_direction_deg"), F.col("mtr_birds_km_h")
    both = direction.isNotNull() & mtr.isNotNull()
    hour = F.window(event_time, "1 hour").alias("_hour") if event_time else hour_key(F.col("ts")).alias("hour")
    sums = profiles.groupBy("radar", "pulse", hour).agg(
        F.count("*").alias("profile_count"), F.count_if(usable()).alias("usable_mtr_profile_count"),
        F.round(F.avg(F.when(usable(), mtr)), 6).alias("mean_mtr_birds_km_h"), F.round(F.avg("vid_birds_per_km2"), 6).alias("mean_vid_birds_per_km2"),
        F.round(F.avg("mean_ground_speed_ms"), 6).alias("mean_ground_speed_ms"),
        F.sum(F.when(both, F.sin(F.radians(direction)) * mtr)).alias("east"), F.sum(F.when(both, F.cos(F.radians(direction)) * mtr)).alias("north"),
        F.count(direction).alias("n_direction"), F.count_if(both).alias("n_both"),
        F.round(F.avg(F.col("rain_suspect").cast("double")), 6).alias("rain_suspect_fraction"),
        F.round(F.avg(F.col("night_date").isNotNull().cast("double")), 6).alias("night_profile_fraction"),
    )
    if event_time:
        sums = sums.withColumn("hour", F.col("_hour.start")).drop("_hour").select("radar", "pulse", "hour", *[c for c in sums.columns if c not in ("radar", "pulse", "_hour")])
    out = sums.withColumn("dominant_direction_deg", F.when(F.col("n_direction") == F.col("n_both"), circular(F.col("east"), F.col("north"))))
    out = out.drop("east", "north", "n_direction", "n_both")
    return out if with_nights else out.drop("night_profile_fraction")


def external_hourly(profiles: DataFrame) -> DataFrame:
    """Plain hourly means of profiles with a rate and a density; missing vector parts count as 0."""
    u, v = uv(F.col("mean_ground_speed_ms"), F.col("dominant_direction_deg"), missing_as_zero=True)
    valid = profiles.where(F.col("mtr_birds_km_h").isNotNull() & F.col("vid_birds_per_km2").isNotNull())
    return valid.groupBy("radar", hour_key(F.col("ts")).alias("hour")).agg(
        F.count("*").alias("profile_count"), F.avg("mtr_birds_km_h").alias("mtr_birds_km_h"), F.avg("vid_birds_per_km2").alias("vid_birds_per_km2"),
        F.avg(u).alias("bird_u_ms"), F.avg(v).alias("bird_v_ms"),
    )


def trapezoids(profiles: DataFrame, keys: list[str], max_gap_minutes: float = MAX_GAP_MINUTES) -> DataFrame:
    """Intervals between consecutive usable profiles of a group: hours, traffic.

    Unusable profiles are taken out first, then neighbours are paired. Groups are nights of a
    radar, which are bounded by the radar's cadence.
    """
    w = Window.partitionBy(*keys).orderBy("ts", "pulse")
    paired = profiles.where(usable()).withColumns({"before": F.lag("ts").over(w), "was": F.lag("mtr_birds_km_h").over(w)})
    hours = (F.unix_micros("ts") - F.unix_micros("before")) / 3.6e9
    return paired.withColumn("hours", hours).where((F.col("hours") > 0) & (F.col("hours") * 60 <= max_gap_minutes)).select(
        *keys, "ts", "hours", ((F.col("was") + F.col("mtr_birds_km_h")) / 2 * F.col("hours")).alias("traffic")
    )


def night_metrics(profiles: DataFrame, by_pulse: bool = False, max_gap_minutes: float = MAX_GAP_MINUTES) -> DataFrame:
    """One row a (radar, night): integral, coverage, means, peak, direction, rain and classes.

    By default the pulses of a night are taken together; by_pulse keeps them apart. The
    intervals and the group sums come from one shuffle by radar and night: the window adds an
    interval's parts to its row, and the aggregation reuses the partitioning.
    """
    keys = ["radar", "night_date", *(["pulse"] if by_pulse else [])]
    night = profiles.where(F.col("night_date").isNotNull())
    w = Window.partitionBy(*keys, usable()).orderBy("ts", "pulse")
    hours = F.when(usable(), (F.unix_micros("ts") - F.unix_micros(F.lag("ts").over(w))) / 3.6e9)
    mtr, direction = F.col("mtr_birds_km_h"), F.col("dominant_direction_deg")
    night = night.withColumns({"gap_hours": hours, "was": F.lag("mtr_birds_km_h").over(w)})
    joined = F.col("gap_hours") > 0
    joined &= F.col("gap_hours") * 60 <= max_gap_minutes
    turned = usable() & direction.isNotNull()
    sunset = F.col("sunset") if "sunset" in profiles.columns else F.lit(None).cast("timestamp")
    sunrise = F.col("sunrise") if "sunrise" in profiles.columns else F.lit(None).cast("timestamp")
    key_list = F.array_sort(F.collect_set(F.nullif("source_key", F.lit("")))) if "source_key" in profiles.columns else F.array().cast("array<string>")
    sums = night.groupBy(*keys).agg(
        F.count("*").alias("profile_count"), F.count_if(usable()).alias("usable_profile_count"), F.count_if(joined).alias("integrated_interval_count"),
        F.coalesce(F.sum(F.when(joined, F.col("gap_hours"))), F.lit(0.0)).alias("hours"),
        F.coalesce(F.sum(F.when(joined, (F.col("was") + mtr) / 2 * F.col("gap_hours"))), F.lit(0.0)).alias("traffic"),
        F.max(F.when(usable(), mtr)).alias("peak"), F.avg(F.when(usable(), F.col("mean_ground_speed_ms"))).alias("speed"),
        F.avg(F.when(usable(), F.col("density_weighted_mean_height_m"))).alias("height"),
        F.sum(F.when(turned, F.sin(F.radians(direction)) * mtr)).alias("east"), F.sum(F.when(turned, F.cos(F.radians(direction)) * mtr)).alias("north"),
        F.avg(F.col("rain_suspect").cast("double")).alias("rain"), F.array_sort(F.collect_set("pulse")).alias("pulse_products"), key_list.alias("source_keys"),
        F.min(F.when(F.to_date(sunset) == F.col("night_date"), sunset)).alias("sunset"),
        F.max(F.when(F.to_date(sunrise) == F.date_add("night_date", 1), sunrise)).alias("sunrise"),
        *[F.min_by(c, F.when(F.col(c).isNotNull(), F.col("ts"))).alias(c) for c in ("latitude", "longitude") if c in profiles.columns],
    )
    expected = F.when(F.col("sunrise") > F.col("sunset"), (F.unix_micros("sunrise") - F.unix_micros("sunset")) / 3.6e9)
    coverage = F.when(expected > 0, F.least(F.lit(1.0), F.col("hours") / expected))
    mean = F.when(F.col("hours") > 0, F.col("traffic") / F.nullif("hours", F.lit(0.0)))
    return sums.select(
        *keys, "profile_count", "usable_profile_count", "integrated_interval_count", F.round("hours", 6).alias("integrated_hours"),
        F.round(expected, 6).alias("expected_night_hours"), "sunset", "sunrise", F.round("traffic", 6).alias("migration_traffic_birds_per_km"),
        F.round(mean, 6).alias("mean_mtr_birds_km_h"), F.round("peak", 6).alias("peak_mtr_birds_km_h"), F.round("speed", 6).alias("mean_ground_speed_ms"),
        circular(F.col("east"), F.col("north")).alias("dominant_direction_deg"), F.round("height", 6).alias("mean_flight_height_m"),
        F.round(coverage, 6).alias("coverage_fraction"), F.round("rain", 6).alias("rain_contamination_fraction"),
        quality_class(F.coalesce(coverage, F.lit(-1.0)), F.col("integrated_interval_count")).alias("quality_class"),
        intensity_class(mean).alias("intensity_class"), "pulse_products", "source_keys",
        *[c for c in ("latitude", "longitude") if c in profiles.columns],
    )


def expected_night_window(profiles: DataFrame) -> DataFrame:
    """First sunset and last sunrise of each (radar, night), and the hours between."""
    sums = profiles.where(F.col("night_date").isNotNull()).groupBy("radar", "night_date").agg(
        F.min(F.when(F.to_date("sunset") == F.col("night_date"), F.col("sunset"))).alias("sunset"),
        F.max(F.when(F.to_date("sunrise") == F.date_add("night_date", 1), F.col("sunrise"))).alias("sunrise"),
    )
    hours = (F.unix_micros("sunrise") - F.unix_micros("sunset")) / 3.6e9
    return sums.withColumn("expected_night_hours", F.round(F.when(F.col("sunrise") > F.col("sunset"), hours), 6))


def complete_nights(nights: DataFrame, newest: DataFrame) -> DataFrame:
    """Nights before the newest source date of their radar; `newest` is (radar, source_date)."""
    return nights.join(newest, "radar", "left").where(F.col("source_date").isNull() | (F.col("night_date") < F.col("source_date"))).drop("source_date")


def integrable_nights(nights: DataFrame, required: bool = False) -> DataFrame:
    """Nights with an interval. If they are `required`, it is an error that none is left; that takes a look at the data."""
    found = nights.where(F.col("integrated_interval_count") > 0)
    if required and found.isEmpty():
        raise ValueError("no complete night can be integrated")
    return found


def radar_differences(observed: DataFrame, expected: DataFrame) -> DataFrame:
    """Radars on one side only, with the side's name; both are (radar)."""
    missing = expected.select("radar").distinct().join(observed, "radar", "left_anti").withColumn("problem", F.lit("missing"))
    extra = observed.select("radar").distinct().join(expected, "radar", "left_anti").withColumn("problem", F.lit("unexpected"))
    return missing.unionByName(extra)


def latest_per_radar(rows: DataFrame, time: str = "ts", order: str = "pulse") -> DataFrame:
    """The newest row of each radar; of equal times the first by `order`."""
    w = Window.partitionBy("radar").orderBy(F.desc(time), order)
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def merge_latest_nights(stored: DataFrame, new: DataFrame) -> DataFrame:
    """The newest night of each radar from stored and new ones; a new one wins a tie."""
    both = stored.withColumn("is_new", F.lit(False)).unionByName(new.withColumn("is_new", F.lit(True)))
    w = Window.partitionBy("radar").orderBy(F.desc("night_date"), F.desc("is_new"))
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def attach_site(rows: DataFrame, radars: DataFrame) -> DataFrame:
    """Coordinates of the radar table, else the rows' own."""
    site = radars.select("radar", F.col("latitude").alias("_lat"), F.col("longitude").alias("_lon"))
    own = lambda c: F.col(c) if c in rows.columns else F.lit(None).cast("double")
    joined = rows.join(site, "radar", "left")
    return joined.withColumns({"latitude": F.coalesce("_lat", own("latitude")), "longitude": F.coalesce("_lon", own("longitude"))}).drop("_lat", "_lon")
