"""From altitude layers to profiles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroskein.functions.coerce import bool_token, num, parse_ts
from aeroskein.functions.domain import circular, is_day, night_date

#: The altitude band in m, when layers are rain, and a layer's height without neighbours.
BAND = (200.0, 4000.0)
RAIN_BINS, RAIN_SHARE, RAIN_DBZ, RAIN_TOP = 5, 0.8, 7.0, 2000.0
DEFAULT_WIDTH = 200.0
#: Canonical columns and the names that raw tables have for them.
ALIASES = {
    "height": ("height", "height_m", "altitude_m"), "dens": ("dens", "density"), "ff": ("ff", "ground_speed_ms", "speed"),
    "dd": ("dd", "direction_deg", "direction"), "dbzh": ("DBZH", "dbz"), "latitude": ("radar_latitude", "latitude"), "longitude": ("radar_longitude", "longitude"),
}
TIMES = ("timestamp_utc", "datetime", "time", "datetime_utc", "date_time")


def _any(df: DataFrame, names, make, kind: str) -> Column:
    there = [F.col(f"`{n}`") for n in names if n in df.columns]
    return make(*there) if there else F.lit(None).cast(kind)


def canonical_layers(raw: DataFrame) -> DataFrame:
    """Raw text rows with canonical names and types; rows without a radar or time are dropped."""
    columns = {k: _any(raw, names, num, "double") for k, names in ALIASES.items()}
    columns |= {k: _any(raw, (k,), parse_ts, "timestamp") for k in ("sunrise", "sunset")}
    columns |= {k: _any(raw, (k,), bool_token, "boolean") for k in ("gap", "day")}
    pulse = F.coalesce(F.nullif(F.col("pulse"), F.lit("")), F.lit("unknown")) if "pulse" in raw.columns else F.lit("unknown")
    out = raw.select(
        F.col("radar"), _any(raw, TIMES, parse_ts, "timestamp").alias("ts"), pulse.alias("pulse"),
        *[c.alias(k) for k, c in columns.items()], *[F.col(k) for k in ("source_key", "source_etag") if k in raw.columns],
    )
    return out.where((F.col("radar") != "") & F.col("ts").isNotNull())


def in_band(layers: DataFrame, low: float = BAND[0], high: float = BAND[1]) -> DataFrame:
    """Layers of the altitude band, both ends included; a layer without height goes."""
    return layers.where(F.col("height").between(low, high))


def median_gap_km(heights: Column) -> Column:
    """Median of the gaps between sorted distinct heights in km; 0.2 if there are none."""
    s = F.array_sort(heights)
    gaps = F.array_sort(F.zip_with(F.slice(s, 2, F.greatest(F.size(s) - 1, F.lit(0))), F.slice(s, 1, F.greatest(F.size(s) - 1, F.lit(0))), lambda b, a: b - a))
    n = F.size(gaps)
    low, high = F.floor((n - 1) / 2).cast("int"), F.floor(n / 2).cast("int")
    return F.when(n > 0, (F.get(gaps, low) + F.get(gaps, high)) / 2).otherwise(DEFAULT_WIDTH) / 1000.0


def rain_flags() -> tuple[Column, Column]:
    """Aggregates: number of low bins with a reflectivity, and of those above the rain threshold."""
    low = ~F.coalesce("gap", F.lit(False)) & F.col("dbzh").isNotNull() & (F.col("height") <= RAIN_TOP)
    return F.count_if(low), F.count_if(low & (F.col("dbzh") > RAIN_DBZ))


def rain_suspect(bins: Column, positive: Column) -> Column:
    return (bins >= RAIN_BINS) & (positive / F.greatest(bins, F.lit(1)) >= RAIN_SHARE)


def integrate_profiles(layers: DataFrame, low: float = BAND[0], high: float = BAND[1], event_time: str | None = None) -> DataFrame:
    """One row a (radar, second, pulse) from canonical layers.

    On a stream with a watermark on ts, `event_time` names a column that carries the watermark
    on to further aggregations.

    One aggregation, no window and no join. Density and heights are summed without the width,
    which is the same for all layers of a profile, and scaled afterwards. Rates and their components are
    scaled before they are summed, from the lowest layer up: where layers cancel, what is left
    is the rounding of each scaled term, and the direction follows it. Gap layers
    count but add nothing. A profile whose density is 0 has a rate of 0 even in rain; else a
    rain-suspect profile, or one without speeds, has none.
    """
    extra = [c for c in ("latitude", "longitude", "sunrise", "sunset", "day", "source_key", "source_etag") if c in layers.columns]
    there = lambda c, kind: F.col(c) if c in layers.columns else F.lit(None).cast(kind)
    gap = F.coalesce("gap", F.lit(False))
    d, s, h = F.col("dens"), F.col("ff"), F.col("height")
    dense, moving = ~gap & (d >= 0), ~gap & (d >= 0) & (s >= 0)
    rate = d * s * 3.6
    turned = moving & (rate > 0) & F.col("dd").isNotNull()
    part = lambda f: F.when(turned, f(F.radians("dd")) * d * s * 3.6).otherwise(0.0)
    moves = F.struct(h.alias("h"), rate.alias("r"), part(F.sin).alias("east"), part(F.cos).alias("north"))
    scaled = lambda name: F.aggregate("moves", F.lit(0.0), lambda sum, m: sum + m[name] * F.col("layer_width_km"))
    bins, positive = rain_flags()
    inside = h.between(low, high)
    second = F.window("ts", "1 second").alias("_second") if event_time else F.date_trunc("second", "ts").alias("ts")
    sums = (
        layers.where(inside).groupBy("radar", second, "pulse").agg(
            F.collect_set("height").alias("heights"), F.count_if(gap).alias("gap_layer_count"),
            F.count_if(dense).alias("density_layer_count"), F.count_if(moving).alias("mtr_layer_count"),
            F.sum(F.when(dense, d)).alias("d"), F.sum(F.when(dense, h * d)).alias("hd"), F.sort_array(F.collect_list(F.when(moving, moves))).alias("moves"),
            F.sum(F.when(moving, s * d)).alias("sd"), F.sum(F.when(moving, d)).alias("md"),
            bins.alias("rain_bins"), positive.alias("rain_positive"),
            *[F.min_by(c, "height").alias(c) for c in extra],
        )
    )
    if event_time:
        sums = sums.withColumn(event_time, F.window_time("_second")).withColumn("ts", F.col("_second.start"))
    width = median_gap_km(F.col("heights"))
    wet = rain_suspect(F.col("rain_bins"), F.col("rain_positive"))
    vid = F.col("d") * F.col("layer_width_km")
    day = is_day(F.col("ts"), there("longitude", "double"), there("day", "boolean"), there("sunrise", "timestamp"), there("sunset", "timestamp"))
    night = night_date(F.col("ts"), F.col("is_day"), there("longitude", "double"), there("sunrise", "timestamp"), there("sunset", "timestamp"))
    rated = (
        F.when(F.col("density_layer_count") == 0, None).when(vid == 0, 0.0)
        .when((F.col("mtr_layer_count") == 0) | F.col("rain_suspect"), None).otherwise(scaled("r"))
    )
    return (
        sums.withColumns({"layer_width_km": width, "rain_suspect": wet, "is_day": day}).withColumns({"east": scaled("east"), "north": scaled("north")})
        .select(
            "radar", "pulse", "ts", *([event_time] if event_time else []), night.alias("night_date"), "is_day", *extra,
            F.when(F.col("density_layer_count") > 0, vid).alias("vid_birds_per_km2"), rated.cast("double").alias("mtr_birds_km_h"),
            F.when(F.col("md") > 0, F.col("sd") / F.nullif("md", F.lit(0.0))).alias("mean_ground_speed_ms"),
            circular(F.col("east"), F.col("north")).alias("dominant_direction_deg"),
            F.when(F.col("d") > 0, F.col("hd") / F.nullif("d", F.lit(0.0))).alias("density_weighted_mean_height_m"),
            "density_layer_count", "mtr_layer_count", "gap_layer_count", "layer_width_km", "rain_suspect",
            F.when(F.col("rain_bins") > 0, F.col("rain_positive") / F.greatest("rain_bins", F.lit(1))).otherwise(0.0).alias("rain_layer_fraction"),
        )
    )


def summary_profiles(raw: DataFrame) -> DataFrame:
    """Profiles of groups in which no row has a density: the first row's summary fields.

    `raw` has radar, ts, pulse, row_order, dens and any of the summary aliases.
    """
    names = {
        "vid_birds_per_km2": ("vid", "vid_birds_per_km2"), "mtr_birds_km_h": ("mtr", "MTR", "migration_traffic_rate", "traffic_rate"),
        "mean_ground_speed_ms": ("ground_speed_ms", "speed", "ff"), "dominant_direction_deg": ("direction_deg", "direction", "dd"),
        "density_weighted_mean_height_m": ("height_m", "height"),
    }
    fields = F.struct(*[_any(raw, a, num, "double").alias(k) for k, a in names.items()])
    grouped = raw.groupBy("radar", F.date_trunc("second", "ts").alias("ts"), "pulse").agg(
        F.count(num(F.col("dens"))).alias("n"), F.min_by(fields, "row_order").alias("f")
    )
    return grouped.where("n = 0").select("radar", "ts", "pulse", "f.*")
