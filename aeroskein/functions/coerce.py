"""Coercion of text fields, safe in ANSI mode: what can't be read is null."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that mean true and false.
TRUE, FALSE = ("true", "t", "1", "yes", "y"), ("false", "f", "0", "no", "n")


def finite(c: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def num(*columns: Column) -> Column:
    """The first of the columns that reads as a finite number."""
    return F.coalesce(*[finite(F.trim(c.cast("string")).try_cast("double")) for c in columns])


def bool_token(c: Column) -> Column:
    """true, t, 1, yes, y or false, f, 0, no, n in any case; anything else is null."""
    word = F.lower(F.trim(c.cast("string")))
    return F.when(word.isin(*TRUE), True).when(word.isin(*FALSE), False)


def parse_ts(*columns: Column) -> Column:
    """The first of the columns that reads as a time; without a zone it is UTC."""
    return F.coalesce(*[F.trim(c.cast("string")).try_cast("timestamp") for c in columns])


def hour_key(ts: Column) -> Column:
    return F.date_trunc("hour", ts)


def iso(ts: Column) -> Column:
    """A time as text to the second."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
