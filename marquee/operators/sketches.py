"""Quantiles and distinct counts from mergeable sketches, stored per pane.

A pane of the log has one row per group: how many requests, a KLL sketch of
their latency, and an HLL sketch of their users. Panes are written once, merge
in any order, and give any longer window without the log: quantiles within a
rank error that the sketch size sets, whatever the number of requests.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from marquee.operators.monitor import QUANTILES, spread_panes

# Entries that a quantile sketch keeps; its rank error is about 1.6 % divided by this over 200.
QUANTILE_ENTRIES = 400
RANK_ERROR = 0.02
# Registers of a distinct sketch as a power of two; the error that is stated is six standard errors, as of
# hundreds of windows one lies beyond three.
DISTINCT_BITS = 14
DISTINCT_ERROR = 0.05


def panes(log: DataFrame, slide: str, by: Sequence[str] = (), value: str = "latency_s", user: str = "user_idx",
          lateness: str | None = None) -> DataFrame:
    """Per pane and group: ``window_start, requests, value_sketch, user_sketch``.

    Works on a table and on a stream, whose panes leave the state once the
    watermark has passed them. Null values and null users are not sketched; a
    group without any has a null sketch.
    """
    rows = log.withWatermark("ts", lateness) if log.isStreaming and lateness else log
    return rows.groupBy(F.window("ts", slide).alias("_pane"), *by).agg(
        F.count("*").alias("requests"),
        F.when(F.count(value) > 0, F.kll_sketch_agg_double(F.col(value).cast("double"), QUANTILE_ENTRIES))
        .alias("value_sketch"),
        F.when(F.count(user) > 0, F.hll_sketch_agg(user, DISTINCT_BITS)).alias("user_sketch"),
    ).select(F.col("_pane.start").alias("window_start"), *by, "requests", "value_sketch", "user_sketch")


def merged(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Panes put together by ``keys``, whatever part of them each has."""
    return rows.groupBy(*keys).agg(
        F.sum("requests").alias("requests"),
        F.kll_merge_agg_double("value_sketch", QUANTILE_ENTRIES).alias("value_sketch"),
        F.hll_union_agg("user_sketch").alias("user_sketch"))


def sliding(stored: DataFrame, window: str, slide: str, by: Sequence[str] = ()) -> DataFrame:
    """Panes merged into every sliding window that covers them."""
    return merged(spread_panes(stored, "window_start", window, slide), ["window_start", *by])


def quantile(p: float, sketch: str = "value_sketch") -> Column:
    return F.kll_sketch_get_quantile_double(F.col(sketch), F.lit(float(p)))


def quantiles(rows: DataFrame, keys: Sequence[str], probabilities: dict[str, float] = QUANTILES) -> DataFrame:
    """The sketched quantiles of each row."""
    known = F.col("value_sketch").isNotNull()
    return rows.select(*keys, "requests", *[F.when(known, quantile(p)).alias(n) for n, p in probabilities.items()])


def distinct_users(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The sketched number of distinct users of each row."""
    return rows.select(*keys, F.coalesce(F.hll_sketch_estimate("user_sketch"), F.lit(0)).alias("active_users"))


def rank_errors(found: DataFrame, log: DataFrame, keys: Sequence[str], value: str = "latency_s",
                probabilities: dict[str, float] = QUANTILES) -> DataFrame:
    """How far each quantile's rank in ``log``, which has the same keys, lies from what was asked for.

    One pass over the log beside the small table of quantiles; 0 where the rank is right.
    """
    joined = log.select(*keys, value).where(F.col(value).isNotNull()).join(found, list(keys))
    counted = joined.groupBy(*keys).agg(F.count("*").alias("_n"), *[
        F.count_if(F.col(value) < F.col(n)).alias(f"_under_{n}") for n in probabilities], *[
        F.count_if(F.col(value) <= F.col(n)).alias(f"_upto_{n}") for n in probabilities])

    def error(n: str, p: float) -> Column:
        low, high = F.col(f"_under_{n}") / F.col("_n"), F.col(f"_upto_{n}") / F.col("_n")
        return F.greatest(low - p, F.lit(p) - high, F.lit(0.0)).alias(n)

    return counted.select(*keys, *[error(n, p) for n, p in probabilities.items()])
