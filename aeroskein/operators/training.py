"""Training tables: feature names, quality control, complete cases, rolling windows, ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroskein.functions.coerce import num
from aeroskein.functions.domain import uv
from aeroskein.functions.geo import project_laea
from aeroskein.operators.quantiles import values_at


#: The features of training tables, and the names of columns that may hold them, best first.
FEATURES = {
    "temperature_850_k": ("t_pressure_level_850", "t_pressure_level_850.0", "t_isobaricInhPa_850", "temperature_850"),
    "relative_humidity_850_percent": ("r_pressure_level_850", "r_pressure_level_850.0", "r_isobaricInhPa_850", "relative_humidity_850"),
    "u_850_ms": ("u_pressure_level_850", "u_pressure_level_850.0", "u_isobaricInhPa_850", "u_850"),
    "v_850_ms": ("v_pressure_level_850", "v_pressure_level_850.0", "v_isobaricInhPa_850", "v_850"),
    "surface_pressure_pa": ("sp", "surface_pressure"),
    "mean_sea_level_pressure_pa": ("msl", "mean_sea_level_pressure"),
    "total_cloud_cover_fraction": ("tcc", "total_cloud_cover"),
    "boundary_layer_height_m": ("blh", "boundary_layer_height"),
    "hourly_precipitation_m": ("tp_hourly", "total_precipitation_hourly", "tp", "total_precipitation"),
}
#: Features that a table may have besides.
OPTIONAL = {
    "u_925_ms": ("u_pressure_level_925", "u_pressure_level_925.0", "u_isobaricInhPa_925", "u_925"),
    "v_925_ms": ("v_pressure_level_925", "v_pressure_level_925.0", "v_isobaricInhPa_925", "v_925"),
    "u_700_ms": ("u_pressure_level_700", "u_pressure_level_700.0", "u_isobaricInhPa_700", "u_700"),
    "v_700_ms": ("v_pressure_level_700", "v_pressure_level_700.0", "v_isobaricInhPa_700", "v_700"),
}
TARGETS = ("mtr_birds_km_h", "vid_birds_per_km2", "bird_u_ms", "bird_v_ms")
MIN_PROFILES, MAX_RAIN = 3, 0.5


def weather_features(rows: DataFrame, optional: tuple[str, ...] = ()) -> DataFrame:
    """`rows` with each feature from the first of its columns that holds a number."""
    unknown = set(optional) - set(OPTIONAL)
    if unknown:
        raise ValueError(f"unknown features: {sorted(unknown)}")
    names = FEATURES | {k: OPTIONAL[k] for k in optional}
    pick = lambda aliases: [F.col(f"`{a}`") for a in aliases if a in rows.columns]
    return rows.withColumns({k: num(*cols) if (cols := pick(a)) else F.lit(None).cast("double") for k, a in names.items()})


def quality_control(joined: DataFrame) -> DataFrame:
    """Rows of a known pulse with enough profiles, little rain, both intensities and a place."""
    return joined.where(
        F.lower("observed_pulse").isin("lp", "sp") & (F.col("observed_usable_mtr_profile_count") >= MIN_PROFILES) & (F.col("observed_rain_suspect_fraction") <= MAX_RAIN)
        & F.col("observed_mean_mtr_birds_km_h").isNotNull() & F.col("observed_mean_vid_birds_per_km2").isNotNull() & F.col("latitude").isNotNull() & F.col("longitude").isNotNull()
    )


def model_rows(joined: DataFrame, optional: tuple[str, ...] = ()) -> DataFrame:
    """Joined rows after quality control with coordinates, targets and features; u and v only where both parts are there."""
    rows = weather_features(quality_control(joined), optional)
    x, y = project_laea(F.col("longitude"), F.col("latitude"))
    u, v = uv(F.col("observed_mean_ground_speed_ms"), F.col("observed_dominant_direction_deg"))
    return rows.select(
        "radar", F.lower("observed_pulse").alias("pulse"), "hour", "latitude", "longitude", x.alias("easting_m"), y.alias("northing_m"),
        F.col("observed_mean_mtr_birds_km_h").alias("mtr_birds_km_h"), F.col("observed_mean_vid_birds_per_km2").alias("vid_birds_per_km2"), u.alias("bird_u_ms"), v.alias("bird_v_ms"),
        F.col("observed_usable_mtr_profile_count").cast("double").alias("profile_count"), F.col("observed_rain_suspect_fraction").alias("rain_suspect_fraction"), *FEATURES, *optional,
    )


def complete_cases(rows: DataFrame, features: list[str]) -> DataFrame:
    """Rows without a null, NaN or infinite feature."""
    keep = F.lit(True)
    for f in features:
        keep = keep & F.col(f).isNotNull() & ~F.isnan(f) & (F.abs(F.col(f)) != F.lit(float("inf")))
    return rows.where(keep)


def complete_days(rows: DataFrame) -> DataFrame:
    """Days on which all 24 hours occur in some row."""
    return rows.groupBy(F.to_date("hour").alias("day")).agg(F.countDistinct(F.hour("hour")).alias("hours")).where("hours = 24").select("day")


def rolling_window(rows: DataFrame, window_days: int) -> DataFrame:
    """Rows of the window that ends with the last complete day; none if there is no complete day."""
    last = complete_days(rows).agg(F.max("day").alias("_last"))
    day = F.to_date("hour")
    return rows.join(last, day.between(F.date_sub("_last", window_days - 1), F.col("_last"))).drop("_last")


def percentile_ranges(rows: DataFrame, features: list[str]) -> DataFrame:
    """Lower and upper bound of each feature: values at places max(0, floor(.01 n) - 1) and min(n - 1, floor(.99 n)).

    Exact at any size; see quantiles.running_counts().
    """
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])).alias("x")).select("x.*").where("value is not null")
    low, high = F.greatest(F.lit(0), F.floor(F.col("total") * 0.01) - 1), F.least(F.col("total") - 1, F.floor(F.col("total") * 0.99))
    return values_at(long, ["feature"], "value", {"lower": low, "upper": high})


def table_summary(rows: DataFrame) -> DataFrame:
    """One row: rows, radars, rows by pulse, first and last hour."""
    return rows.agg(
        F.count("*").alias("rows"), F.countDistinct("radar").alias("radars"), F.count_if(F.col("pulse") == "lp").alias("lp_rows"), F.count_if(F.col("pulse") == "sp").alias("sp_rows"),
        F.min("hour").alias("first_hour"), F.max("hour").alias("last_hour"),
    )


def build_training_table(joined: DataFrame, window_days: int = 365, optional: tuple[str, ...] = ()) -> DataFrame:
    """Quality control, features, complete cases and the rolling window, in the order of columns that writers keep."""
    rows = complete_cases(model_rows(joined, optional), ["easting_m", "northing_m", *FEATURES, *optional])
    return rolling_window(rows, window_days)


def preferred_order(rows: DataFrame, optional: tuple[str, ...] = ()) -> DataFrame:
    """Columns in the order of the training table, then others by name."""
    first = ["radar", "pulse", "hour", "latitude", "longitude", "easting_m", "northing_m", *TARGETS, "profile_count", "rain_suspect_fraction", *FEATURES, *optional]
    return rows.select(*[c for c in first if c in rows.columns], *sorted(set(rows.columns) - set(first)))


def population_guard(rows: DataFrame, baseline: DataFrame, features: list[str]) -> DataFrame:
    """One row: whether two tables have equal counts by pulse, and which features are missing."""
    a, b = table_summary(rows), table_summary(baseline).select(*[F.col(c).alias(f"b_{c}") for c in ("rows", "lp_rows", "sp_rows")])
    missing = [f for f in features if f not in rows.columns]
    same: Column = F.lit(True)
    for c in ("rows", "lp_rows", "sp_rows"):
        same = same & (F.col(c) == F.col(f"b_{c}"))
    return a.join(F.broadcast(b)).select("rows", "lp_rows", "sp_rows", same.alias("same_population"), F.lit(",".join(missing)).alias("missing_features"))
