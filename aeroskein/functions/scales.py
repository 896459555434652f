"""Nice bounds, ticks and positions of colour scales."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _decade(value: Column) -> Column:
    return F.pow(F.lit(10.0), F.floor(F.log10(value)))


def nice_floor(value: Column) -> Column:
    """The largest of 1, 2, 5 times a power of ten that is not above a positive value."""
    base = _decade(value)
    part = value / base
    return base * F.when(part >= 5, 5.0).when(part >= 2, 2.0).otherwise(1.0)


def nice_ceil(value: Column) -> Column:
    """The smallest of 1, 2, 5, 10 times a power of ten that is not below a positive value."""
    base = _decade(value)
    part = value / base
    return base * F.when(part <= 1, 1.0).when(part <= 2, 2.0).when(part <= 5, 5.0).otherwise(10.0)


def log_ticks(low: Column, high: Column) -> Column:
    """Both bounds and all of 1, 2, 5 times powers of ten between them, sorted."""
    decades = F.sequence(F.floor(F.log10(low)).cast("int"), F.ceil(F.log10(high)).cast("int"))
    ticks = F.flatten(F.transform(decades, lambda e: F.transform(F.array(F.lit(1.0), F.lit(2.0), F.lit(5.0)), lambda m: m * F.pow(F.lit(10.0), e.cast("double")))))
    return F.array_sort(F.array_distinct(F.concat(F.array(low, high), F.filter(ticks, lambda t: (t >= low) & (t <= high)))))


def scale_position(value: Column, low: Column, high: Column, log: bool) -> Column:
    """Where a value is between two bounds, from 0 to 1."""
    if log:
        v = F.greatest(value, low)
        place = (F.log10(v) - F.log10(low)) / (F.log10(high) - F.log10(low))
    else:
        place = (value - low) / (high - low)
    return F.when(place.isNotNull(), F.least(F.lit(1.0), F.greatest(F.lit(0.0), place)))
