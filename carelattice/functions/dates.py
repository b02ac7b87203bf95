"""Lenient parsing and date arithmetic."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

DAY_MICROS = 86_400_000_000

# Tried in order after the ISO forms, which need no pattern.
OTHER_TIMESTAMP_PATTERNS = (
    "yyyy/MM/dd HH:mm:ss",
    "yyyy/MM/dd",
    "MM/dd/yyyy HH:mm:ss",
    "MM/dd/yyyy",
)


def lenient_timestamp(text: Column, patterns: Sequence[str] = OTHER_TIMESTAMP_PATTERNS) -> Column:
    """Text to timestamp; null where no form fits.

    ISO text (`T` or blank, with or without zone or time) goes through `try_cast`. The guard keeps
    a bare time of day from being read as today.
    """
    iso = F.when(text.rlike(r"^\s*\d{4}-"), text.try_cast("timestamp"))
    return F.coalesce(iso, *[F.try_to_timestamp(text, F.lit(p)) for p in patterns])


def lenient_date(text: Column, patterns: Sequence[str] = OTHER_TIMESTAMP_PATTERNS) -> Column:
    """Text to date; null where no form fits."""
    return F.to_date(lenient_timestamp(text, patterns))


def lenient_double(text: Column) -> Column:
    """Text to double; coded or malformed values become null."""
    return F.trim(text).try_cast("double")


def micros(ts: Column) -> Column:
    """Microseconds since the epoch; takes timestamps with or without zone, and dates."""
    return F.unix_micros(ts.cast("timestamp"))


def plus_days(ts: Column, days: int) -> Column:
    """`ts` moved by whole days of 24 hours."""
    return ts + F.make_dt_interval(days=F.lit(days))


def age_in_years(at: Column, birth: Column) -> Column:
    """Whole days lived at `at`, in years of 365.25 days."""
    return F.datediff(F.to_date(at), F.to_date(birth)) / F.lit(365.25)
