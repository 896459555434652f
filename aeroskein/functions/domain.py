"""Classes, day and night, vectors, transforms and weights as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_lit(x) -> Column:
    return x if isinstance(x, Column) else F.lit(x)


def intensity_class(mtr: Column) -> Column:
    return (
        F.when(mtr.isNull(), "missing").when(mtr <= 0, "none").when(mtr < 100, "low").when(mtr < 500, "moderate")
        .when(mtr < 1000, "high").otherwise("very_high")
    )


def quality_class(coverage: Column, intervals: Column) -> Column:
    return F.when((coverage >= 0.75) & (intervals >= 2), "good").when(intervals > 0, "partial").otherwise("insufficient")


def solar_time(ts: Column, longitude: Column) -> Column:
    """Local solar time: four minutes a degree east; no longitude counts as 0."""
    return F.timestamp_micros((F.unix_micros(ts) + F.round(F.coalesce(longitude, F.lit(0.0)) * 240_000_000)).cast("long"))


def is_day(ts: Column, longitude: Column, flag: Column, sunrise: Column, sunset: Column) -> Column:
    """The flag if given, else between sunrise and sunset, else from 6 to 18 hours solar time."""
    hour = F.hour(solar_time(ts, longitude))
    return F.coalesce(flag, (ts >= sunrise) & (ts <= sunset), (hour >= 6) & (hour < 18))


def night_date(ts: Column, day: Column, longitude: Column, sunrise: Column, sunset: Column) -> Column:
    """The date on which a time's night began; null by day."""
    solar = solar_time(ts, longitude)
    fallback = F.when(F.hour(solar) < 12, F.date_sub(F.to_date(solar), 1)).otherwise(F.to_date(solar))
    return F.when(
        ~day, F.when(ts <= sunrise, F.date_sub(F.to_date(ts), 1)).when(ts >= sunset, F.to_date(ts)).otherwise(fallback)
    )


def uv(speed: Column, direction: Column, missing_as_zero: bool = False) -> tuple[Column, Column]:
    """East and north components of a speed towards a direction in degrees."""
    if missing_as_zero:
        speed, direction = F.coalesce(speed, F.lit(0.0)), F.coalesce(direction, F.lit(0.0))
    return speed * F.sin(F.radians(direction)), speed * F.cos(F.radians(direction))


def circular(sin_sum: Column, cos_sum: Column) -> Column:
    """Direction of summed components in [0, 360), to six places; null if there is none."""
    angle = F.degrees(F.atan2(sin_sum, cos_sum))
    return F.when((sin_sum != 0) | (cos_sum != 0), F.round(F.pmod(angle + 360.0, F.lit(360.0)), 6))


def age_mode(age_hours: Column) -> Column:
    age = F.greatest(age_hours, F.lit(0.0))
    return F.when(age <= 6, "assimilated").when(age <= 24, "propagated").otherwise("weather_only")


def transform(value: Column, kind: str) -> Column:
    """Response transforms of an intensity; negative values count as 0."""
    v = F.greatest(value, F.lit(0.0))
    return {"identity": v, "cube_root": F.cbrt(v), "sqrt": F.sqrt(v), "log1p": F.log1p(v)}[kind]


def inverse(value: Column, kind: str) -> Column:
    v = F.greatest(value, F.lit(0.0))
    return {"identity": v, "cube_root": v * v * v, "sqrt": v * v, "log1p": F.expm1(v)}[kind]


def sample_weight(profiles: Column, mtr: Column, kind: str, power: float = 0.5) -> Column:
    """Weights of training rows; profile counts are at least 1 and rates at least 0.01."""
    rate = F.greatest(mtr, F.lit(0.01))
    return {
        "profile_count": F.greatest(profiles.cast("double"), F.lit(1.0)), "uniform": F.lit(1.0), "mtr": rate,
        "sqrt_mtr": F.sqrt(rate), "mtr_power": F.pow(rate, F.lit(power)),
    }[kind]


def wind_offset(target: Column, u: Column, v: Column) -> Column:
    """The wind component that belongs to a vector target; 0 for others."""
    return F.when(target == "bird_u_ms", u).when(target == "bird_v_ms", v).otherwise(0.0)


def covariate_support(values: list[Column], lows: list[Column], highs: list[Column]) -> Column:
    """Product of exp(-3 * excess / width) over covariates; a missing one gives 0."""
    out = F.lit(1.0)
    for x, lo, hi in zip(values, lows, highs):
        excess = F.greatest(lo - x, x - hi, F.lit(0.0))
        width = F.greatest(hi - lo, F.lit(1e-6))
        out = out * F.when(x.isNull(), 0.0).otherwise(F.exp(-3.0 * excess / width))
    return out


def max_uncertainty(*columns: Column) -> Column:
    """The largest finite value; 0 if there is none."""
    clean = [F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c) for c in columns]
    return F.coalesce(F.greatest(*clean) if len(clean) > 1 else clean[0], F.lit(0.0))


def match_class(offset_seconds: Column) -> Column:
    return F.when(offset_seconds == 0, "exact").otherwise("cadence-adjusted")


def required_fields(names: list[str]) -> Column:
    """Names of the fields that are null or blank in a row."""
    return F.array_compact(F.array(*[F.when(F.col(n).isNull() | (F.trim(F.col(n).cast("string")) == ""), F.lit(n)) for n in names]))
