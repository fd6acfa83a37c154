"""Small column expressions shared by several jobs."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, functions as F

# The ratings a user can give.
HALF_STARS = [0.5, 1.0, 1.5, 2.0, 2.5, 3.0, 3.5, 4.0, 4.5, 5.0]

SECONDS_PER_DAY = 86400


def std_or_zero(value: Column) -> Column:
    """Sample deviation; a single observation has none and counts as 0."""
    return F.coalesce(F.stddev_samp(value), F.lit(0.0))


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_micros(F.round(seconds * 1_000_000).cast("long"))


def timestamp_to_epoch(ts: Column) -> Column:
    return F.unix_micros(ts) / 1_000_000


def iso_to_timestamp(text: Column) -> Column:
    """ISO-8601 text to a timestamp, null if it is not one."""
    return F.try_to_timestamp(text)


def timestamp_to_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def number_text(value: Column) -> Column:
    """A double in plain decimals, with at least one, where Spark's own text has an exponent."""
    def plain(scale: int) -> Column:
        digits = value.cast(f"decimal(38,{scale})").cast("string")
        return F.regexp_replace(digits, f"0{{1,{scale - 1}}}$", "")

    size = F.abs(value)
    return (F.when((value == 0) | size.between(0.001, 9_999_999), value.cast("string"))
            .when(size < 1, plain(30)).otherwise(plain(18)))


def micros(span: timedelta) -> int:
    return round(span.total_seconds() * 1_000_000)


def within(later: Column, earlier: Column, span: timedelta) -> Column:
    return F.unix_micros(later) - F.unix_micros(earlier) <= micros(span)


def activity_boost(score: Column, activity: Column, cap: int = 20, step: float = 0.01) -> Column:
    """Raise a score by ``step`` per recent event, up to ``cap`` events."""
    raised = score * (1 + F.least(activity, F.lit(cap)) * step)
    return F.when(activity > 0, raised).otherwise(score)


def milliseconds(seconds: Column) -> Column:
    return F.round(seconds * 1000, 2)
