"""The historical package: its records, series and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aeroskein.operators.quantiles import values_at

PERIODS = ("day", "civil_twilight", "night")


def _real(name: str) -> Column:
    return F.round(F.col(name).cast("string").try_cast("double"), 8)


def _whole(name: str) -> Column:
    return F.col(name).cast("string").try_cast("double").cast("bigint")


def _blank(name: str) -> Column:
    return F.nullif(F.col(name).cast("string"), F.lit(""))


def daily_records(raw: DataFrame) -> DataFrame:
    return raw.select(
        "radar", "date", "pulse", F.col("solar_period").alias("period"), "season", _whole("profile_count").alias("profiles"), _real("vid_birds_per_km2").alias("vid"),
        _real("mean_vid_birds_per_km2_per_profile").alias("mean_vid"), _real("mean_weighted_height_m").alias("height_m"), _real("mean_ff_ms").alias("speed_ms"),
    )


def annual_records(raw: DataFrame) -> DataFrame:
    return raw.select(
        _whole("year").alias("year"), "pulse", F.col("solar_period").alias("period"), "season", _whole("day_count").alias("days"), _whole("radar_count").alias("radars"),
        _whole("profile_count").alias("profiles"), _real("mean_daily_vid_birds_per_km2").alias("mean_daily_vid"), _real("mean_profile_vid_birds_per_km2").alias("mean_profile_vid"), _real("vid_birds_per_km2").alias("vid"),
    )


def phenology_records(raw: DataFrame) -> DataFrame:
    dates = {"onset_5": "onset_5_date", "early_10": "early_10_date", "median_50": "median_50_date", "late_90": "late_90_date", "peak": "peak_date"}
    return raw.select(
        _whole("year").alias("year"), "radar", "pulse", F.col("solar_period").alias("period"), "season", _whole("day_count").alias("days"),
        *[_blank(c).alias(k) for k, c in dates.items()], _real("peak_vid_birds_per_km2").alias("peak_vid"),
    )


def coverage_records(raw: DataFrame) -> DataFrame:
    return raw.select(
        _whole("year").alias("year"), "radar", "pulse", _whole("file_count").alias("files"), _whole("profile_count").alias("profiles"), _whole("failed_file_count").alias("failed"),
        _blank("first_date").alias("first_date"), _blank("last_date").alias("last_date"),
    )


def radar_spans(coverage: DataFrame, radars: DataFrame) -> DataFrame:
    """Each radar with its first and last date and number of years, null without coverage."""
    spans = coverage.groupBy("radar").agg(F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"), F.countDistinct("year").alias("years"))
    return radars.select("radar").join(spans, "radar", "left")


def annual_nocturnal(annual: DataFrame, pulse: str = "lp", end_year: int = 2025) -> DataFrame:
    """Mean daily VID by year of spring and autumn nights."""
    keep = (F.col("pulse") == pulse) & (F.col("period") == "night") & F.col("season").isin("spring", "autumn") & (F.col("year") <= end_year) & F.col("mean_daily_vid").isNotNull()
    return annual.where(keep).select("season", "year", "mean_daily_vid")


def solar_period_means(annual: DataFrame, pulse: str = "lp", end_year: int = 2025) -> DataFrame:
    """Mean of mean daily VID of each solar period; 0 for one without values."""
    mean = annual.where((F.col("pulse") == pulse) & (F.col("year") <= end_year)).groupBy("period").agg(F.avg("mean_daily_vid").alias("m"))
    spine = annual.sparkSession.range(len(PERIODS)).select(F.element_at(F.array(*[F.lit(p) for p in PERIODS]), (F.col("id") + 1).cast("int")).alias("period"))
    return spine.join(mean, "period", "left").select("period", F.coalesce("m", F.lit(0.0)).alias("mean_daily_vid"))


def phenology_medians(phenology: DataFrame, pulse: str = "lp", end_year: int = 2025) -> DataFrame:
    """Median day of year of the median passage dates over radars, by year and season."""
    keep = (F.col("pulse") == pulse) & (F.col("period") == "night") & F.col("season").isin("spring", "autumn") & (F.col("year") <= end_year) & F.col("median_50").isNotNull()
    return phenology.where(keep).groupBy("year", "season").agg(F.median(F.dayofyear(F.col("median_50").cast("date"))).alias("day_of_year"))


def availability(coverage: DataFrame, pulse: str = "lp") -> DataFrame:
    """The (radar, year) pairs with files of a pulse."""
    return coverage.where(F.col("pulse") == pulse).select("radar", "year").distinct()


def radar_day_aggregate(daily: DataFrame) -> DataFrame:
    """Sums of a day's records by radar; heights and speeds weigh by profiles, all of which count in the denominator."""
    n = F.coalesce("profiles", F.lit(0))
    total = F.sum(n)
    weighted = lambda c: F.when(total > 0, F.coalesce(F.sum(F.when(n > 0, F.col(c) * n)), F.lit(0.0)) / F.greatest(total, F.lit(1)))
    return daily.groupBy("radar", "date").agg(F.coalesce(F.sum("vid"), F.lit(0.0)).alias("vid"), total.alias("profiles"), weighted("height_m").alias("height_m"), weighted("speed_ms").alias("speed_ms"))


def seasonal_climatology(hourly: DataFrame) -> DataFrame:
    """Upper median of VID in each of the twelve months, 0.02 at least; 0.25 in a month without values."""
    found = values_at(hourly.select(F.month("hour").alias("month"), "mean_vid_birds_per_km2"), ["month"], "mean_vid_birds_per_km2", {"vid": F.floor(F.col("total") / 2)})
    found = found.withColumn("vid", F.greatest("vid", F.lit(0.02)))
    months = hourly.sparkSession.range(1, 13).select(F.col("id").cast("int").alias("month"))
    return months.join(found, "month", "left").withColumn("vid", F.coalesce("vid", F.lit(0.25)))


def density_weighted_wind(observations: DataFrame) -> DataFrame:
    """One row: means of u and v weighted by density, 0.05 at least; 0 without observations."""
    w = F.greatest("density", F.lit(0.05))
    ratio = lambda c: F.coalesce(F.sum(w * F.col(c)) / F.nullif(F.sum(w), F.lit(0.0)), F.lit(0.0))
    return observations.agg(ratio("u").alias("u"), ratio("v").alias("v"))
