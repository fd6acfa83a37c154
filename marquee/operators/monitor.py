"""Service metrics from a request log (ts, endpoint, status, latency_s, user_idx)."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.scalars import milliseconds
from marquee.operators.ordering import cumulative, exact_quantiles

# Upper bounds of the latency and score buckets, the last one open.
LATENCY_BOUNDS = [0.005, 0.01, 0.025, 0.05, 0.075, 0.1, 0.25, 0.5, 0.75, 1.0, 2.5, 5.0, 7.5, 10.0]
QUANTILES = {"p50": 0.5, "p95": 0.95, "p99": 0.99}
# Alert thresholds.
LATENCY_YELLOW, LATENCY_RED = 0.1, 0.5
SUCCESS_YELLOW, SUCCESS_GREEN = 0.95, 0.99

def _ok() -> Column:
    return F.col("status") == 200


def seconds(span: str) -> float:
    return pd.Timedelta(span).total_seconds()


def _windowed(log: DataFrame, window: str, slide: str | None = None) -> DataFrame:
    frame = F.window("ts", window, slide) if slide else F.window("ts", window)
    return log.withColumn("window_start", frame.start)


def requests_by_endpoint(log: DataFrame) -> DataFrame:
    return log.groupBy("endpoint").agg(
        F.count("*").alias("requests"), F.count_if(_ok()).alias("successful"))


def errors_by_type(errors: DataFrame, kind: str = "type") -> DataFrame:
    return errors.groupBy(kind).agg(F.count("*").alias("errors"))


def request_rate(log: DataFrame, window: str = "5 minutes", by: Sequence[str] = (),
                 slide: str | None = None, per: str = "1 minute") -> DataFrame:
    """Successful requests per ``per`` in each window.

    With ``slide``, requests are counted per slide first and the counts, not
    the requests, are copied into the windows they belong to.
    """
    good = log.where(_ok())
    if slide:
        panes = (_windowed(good, slide).groupBy("window_start", *by).agg(F.count("*").alias("requests")))
        panes = spread_panes(panes, "window_start", window, slide)
    else:
        panes = _windowed(good, window).withColumn("requests", F.lit(1))
    counts = panes.groupBy("window_start", *by).agg(F.sum("requests").cast("long").alias("requests"))
    return counts.withColumn("rate", F.col("requests") * (seconds(per) / seconds(window)))


def spread_panes(panes: DataFrame, start: str, window: str, slide: str) -> DataFrame:
    """Copy each pre-aggregated pane into every sliding window that covers it."""
    steps = round(seconds(window) / seconds(slide))
    if steps * seconds(slide) != seconds(window):
        raise ValueError("the window must be a whole number of slides")
    step = F.expr(f"INTERVAL {round(seconds(slide))} SECOND")
    return panes.withColumn("_back", F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))).withColumn(
        start, F.col(start) - step * F.col("_back")).drop("_back")


def latency_quantiles(log: DataFrame, window: str = "5 minutes", by: Sequence[str] = ()) -> DataFrame:
    """Exact interpolated quantiles per window."""
    return exact_quantiles(_windowed(log, window), ["window_start", *by], "latency_s", QUANTILES)


def bucket_counts(df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Cumulative counts per upper bound, the last row (null bound) counting all."""
    counted = df.groupBy(*by).agg(
        *[F.count_if(F.col(value) <= b).alias(f"_le_{i}") for i, b in enumerate(bounds)],
        F.count(value).alias("_all"))
    rows = [F.struct(F.lit(float(b)).alias("le"), F.col(f"_le_{i}").alias("n")) for i, b in enumerate(bounds)]
    rows.append(F.struct(F.lit(None).cast("double").alias("le"), F.col("_all").alias("n")))
    return counted.select(*by, F.inline(F.array(*rows)))


def _bucket_counters(value: Column, bounds: Sequence[float]) -> list[Column]:
    return [*[F.count_if(value <= b).alias(f"_le_{i}") for i, b in enumerate(bounds)], F.count(value).alias("_all")]


def _bucket_estimate(bounds: Sequence[float], p: float) -> Column:
    """The quantile from those counters: linear inside the first bucket that reaches its rank."""
    rank = F.col("_all") * F.lit(p)
    found = None
    for i, b in enumerate(bounds):
        low = F.lit(float(bounds[i - 1]) if i else 0.0)
        below = F.col(f"_le_{i - 1}") if i else F.lit(0)
        inside = F.col(f"_le_{i}") - below
        here = low + (F.lit(float(b)) - low) * F.try_divide(rank - below, inside)
        hit = (F.col(f"_le_{i}") >= rank) & (inside > 0)
        found = F.when(hit, here) if found is None else found.when(hit, here)
    return F.when(F.col("_all") > 0, found.otherwise(F.lit(float(bounds[-1]))))


def bucket_quantiles(df: DataFrame, value: str, bounds: Sequence[float], by: Sequence[str] = (),
                     probabilities: dict[str, float] = QUANTILES) -> DataFrame:
    """Quantiles estimated inside fixed buckets, linear between the bounds.

    A fixed number of counters per group, whatever its size: the form for
    dashboards over very large logs. A rank beyond the last bound gives it.
    """
    counted = df.groupBy(*by).agg(*_bucket_counters(F.col(value), bounds))
    return counted.select(*by, *[_bucket_estimate(bounds, p).alias(n) for n, p in probabilities.items()])


def request_summary(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Success rate and latency figures of a run, in milliseconds over successes."""
    good = F.when(_ok(), F.col("latency_s"))
    return log.groupBy(*by).agg(
        F.count("*").alias("total"), F.count_if(_ok()).alias("success"),
        F.count_if(~_ok()).alias("errors"),
        (F.count_if(_ok()) * 100.0 / F.count("*")).alias("success_rate"),
        milliseconds(F.avg(good)).alias("avg_ms"), milliseconds(F.min(good)).alias("min_ms"),
        milliseconds(F.max(good)).alias("max_ms"))


def success_ratio(log: DataFrame, window: str = "5 minutes") -> DataFrame:
    return _windowed(log, window).groupBy("window_start").agg(
        (F.count_if(_ok()) / F.count("*")).alias("success_ratio"))


def errors_per_minute(log: DataFrame, window: str = "5 minutes") -> DataFrame:
    minutes = seconds(window) / 60
    return _windowed(log, window).groupBy("window_start").agg(
        (F.count_if(F.col("status") == 500) / minutes).alias("errors_per_minute"))


def alert_frames(log: DataFrame, window: str = "5 minutes", endpoint: str | None = None) -> DataFrame:
    """``alert_state`` with the whole window as ``frame``, from one aggregation that a stream can run, too."""
    timed = F.col("latency_s") if endpoint is None else F.when(F.col("endpoint") == endpoint, F.col("latency_s"))
    counted = log.groupBy(F.window("ts", window).alias("frame")).agg(
        *_bucket_counters(timed, LATENCY_BOUNDS), (F.count_if(_ok()) / F.count("*")).alias("success_ratio"))
    rated = counted.withColumn("p95", _bucket_estimate(LATENCY_BOUNDS, 0.95))
    latency, ratio = F.col("p95"), F.col("success_ratio")
    return rated.select(
        "frame", "p95", "success_ratio",
        F.when(latency >= LATENCY_RED, "red").when(latency >= LATENCY_YELLOW, "yellow")
        .when(latency.isNotNull(), "green").alias("latency_state"),
        F.when(ratio >= SUCCESS_GREEN, "green").when(ratio >= SUCCESS_YELLOW, "yellow")
        .when(ratio.isNotNull(), "red").alias("success_state"))


def alert_state(log: DataFrame, window: str = "5 minutes", endpoint: str | None = None) -> DataFrame:
    """Green, yellow or red per window, for p95 latency and for the success ratio.

    With ``endpoint``, latency is that of its requests only; success is always over all.
    """
    return alert_frames(log, window, endpoint).select(F.col("frame.start").alias("window_start"), "*").drop("frame")


def in_progress(log: DataFrame) -> DataFrame:
    """Requests running at each instant at which one starts or ends.

    Starts and ends are summed per instant, then summed in time order across
    range partitions, so no task sees the whole log.
    """
    end = F.timestamp_micros(F.unix_micros("ts") + F.round(F.col("latency_s") * 1_000_000).cast("long"))
    changes = log.select(F.inline(F.array(
        F.struct(F.col("ts").alias("instant"), F.lit(1).alias("change")),
        F.struct(end.alias("instant"), F.lit(-1).alias("change")))))
    per_instant = changes.groupBy("instant").agg(F.sum("change").alias("change"))
    return cumulative(per_instant, ["instant"], "change", "in_progress").select("instant", "in_progress")


def active_users(log: DataFrame, window: str = "1 hour", slide: str | None = None) -> DataFrame:
    """Distinct users per window.

    With ``slide``, a user is taken once per slide before being copied into the
    windows that cover it; ``sketches`` has the form whose size does not grow with users.
    """
    pairs = _windowed(log, slide or window).select("window_start", "user_idx").distinct()
    if slide:
        pairs = spread_panes(pairs, "window_start", window, slide).distinct()
    return pairs.groupBy("window_start").agg(F.count("user_idx").alias("active_users"))
