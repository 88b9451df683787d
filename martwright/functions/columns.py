"""Small Column -> Column helpers. Everything here stays inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, scale: int = 2) -> Column:
    """Round halves away from zero.

    A double goes through decimal(38,10) first, so 1.005 becomes 1.01 and not 1.0.
    """
    return F.round(value.cast("decimal(38,10)"), scale).cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient as a double; NULL where the denominator is 0."""
    return numerator.cast("double") / F.nullif(denominator.cast("double"), F.lit(0.0))


def percent(numerator: Column, denominator: Column) -> Column:
    """Share in percent with two digits; NULL where the denominator is 0."""
    return round_half_up(ratio(numerator, denominator) * 100)


def mean(value: Column) -> Column:
    """Average of exact numbers as a double: the exact sum over the count of non-NULLs."""
    return ratio(F.sum(value), F.count(value))


def tidy(text: Column) -> Column:
    """Lower case without surrounding blanks."""
    return F.lower(F.trim(text))


def day_count(start: Column, end: Column) -> Column:
    """Midnights passed from start to end (23:00 to 01:00 is one day)."""
    return F.datediff(end, start)


def period_start(moment: Column, unit: str) -> Column:
    """First instant of the week (Monday), month, quarter or year around a moment.

    Goes through DATE, so the session time zone plays no part.
    """
    return F.trunc(F.to_date(moment), unit).cast("timestamp_ntz")


def surrogate_key(*parts: Column, null_token: str = "_null_") -> Column:
    """md5 over the parts as text. NULL has a token of its own, so (a, NULL, b) is not (a, b)."""
    texts = [F.coalesce(part.cast("string"), F.lit(null_token)) for part in parts]
    return F.md5(F.concat_ws("-", *texts))


def cents_to_dollars(cents: Column, scale: int = 2) -> Column:
    """Whole cents as an amount in dollars, rounded to the given number of digits."""
    return F.round(cents.cast("decimal(28,4)") / F.lit(100).cast("decimal(3,0)"), scale)


def as_column(value) -> Column:
    """A parameter that may be a Column, a Python value, or unset."""
    return value if isinstance(value, Column) else F.lit(value)


def as_of_day(as_of) -> Column:
    """The reporting day: the given date, else the day the query runs."""
    return F.current_date() if as_of is None else F.to_date(as_column(as_of))
