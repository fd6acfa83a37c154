"""Registered queries: service metrics over a request log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators import monitor, sketches
from marquee.plans.common import LOG, Query, rounded, sql, time_texts
from marquee.session import durable
from marquee.sources import proxies

HOUR = "1 hour"


def requests_by_endpoint(spark: SparkSession, folder: str) -> DataFrame:
    return monitor.requests_by_endpoint(proxies.request_log(spark, folder))


def request_rate_5m(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(rounded(monitor.request_rate(proxies.request_log(spark, folder))), "window_start")


def request_rate_sliding(spark: SparkSession, folder: str) -> DataFrame:
    """Five-minute rate every minute."""
    log = proxies.request_log(spark, folder)
    return time_texts(rounded(monitor.request_rate(log, slide="1 minute")), "window_start")


def request_rate_by_endpoint(spark: SparkSession, folder: str) -> DataFrame:
    log = proxies.request_log(spark, folder)
    return time_texts(rounded(monitor.request_rate(log, "1 minute", ["endpoint"], per="1 second")), "window_start")


def errors_by_type(spark: SparkSession, folder: str) -> DataFrame:
    failed = proxies.request_log(spark, folder).where(F.col("status") != 200)
    return monitor.errors_by_type(failed, "endpoint")


def latency_histogram(spark: SparkSession, folder: str) -> DataFrame:
    counted = monitor.bucket_counts(proxies.request_log(spark, folder), "latency_s",
                                    monitor.LATENCY_BOUNDS, ["endpoint"])
    return counted.withColumn("le", F.coalesce(F.col("le").cast("string"), F.lit("+Inf")))


def latency_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Exact, per hour and endpoint."""
    log = proxies.request_log(spark, folder)
    return time_texts(rounded(monitor.latency_quantiles(log, HOUR, ["endpoint"]), 8), "window_start")


def latency_quantiles_5m(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(rounded(monitor.latency_quantiles(proxies.request_log(spark, folder)), 8), "window_start")


def latency_bucket_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Estimated from buckets, per endpoint."""
    log = proxies.request_log(spark, folder)
    return rounded(monitor.bucket_quantiles(log, "latency_s", monitor.LATENCY_BOUNDS, ["endpoint"]))


def request_summary(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(monitor.request_summary(proxies.request_log(spark, folder)))


def success_ratio(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(rounded(monitor.success_ratio(proxies.request_log(spark, folder))), "window_start")


def errors_per_minute(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(rounded(monitor.errors_per_minute(proxies.request_log(spark, folder))), "window_start")


def alert_state(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(rounded(monitor.alert_state(proxies.request_log(spark, folder), HOUR)), "window_start")


def in_progress(spark: SparkSession, folder: str) -> DataFrame:
    """Latency taken in seconds rather than milliseconds, so that requests overlap."""
    log = proxies.request_log(spark, folder).withColumn("latency_s", F.col("latency_s") * 1000)
    running = monitor.in_progress(log)
    return running.select(F.unix_micros("instant").alias("instant_us"), "in_progress")


def active_users(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(monitor.active_users(proxies.request_log(spark, folder)), "window_start")


def _stored_panes(spark: SparkSession, folder: str) -> DataFrame:
    return durable(sketches.panes(proxies.request_log(spark, folder), HOUR, ["endpoint"]), "panes")


def latency_sketch_quantiles(spark: SparkSession, folder: str) -> DataFrame:
    """Six-hour windows every hour from stored hourly sketches: requests, and whether each rank is as near as stated."""
    keys = ["window_start", "endpoint"]
    found = sketches.quantiles(sketches.sliding(_stored_panes(spark, folder), "6 hours", HOUR, ["endpoint"]), keys)
    log = proxies.request_log(spark, folder).withColumn(
        "window_start", F.explode(F.transform(F.sequence(F.lit(0), F.lit(5)), lambda k: F.date_trunc("hour", "ts")
                                              - F.make_interval(hours=k))))
    errors = sketches.rank_errors(found, log, keys)
    return time_texts(found.select(*keys, "requests").join(errors, keys).select(
        *keys, "requests", *[(F.col(n) <= sketches.RANK_ERROR).alias(f"{n}_near") for n in monitor.QUANTILES]),
        "window_start")


def active_users_sliding(spark: SparkSession, folder: str) -> DataFrame:
    """Users active in the last six hours, every hour: counted, and whether the sketch is as near as stated."""
    exact = monitor.active_users(proxies.request_log(spark, folder), "6 hours", HOUR)
    windows = sketches.sliding(_stored_panes(spark, folder), "6 hours", HOUR)
    found = sketches.distinct_users(windows, ["window_start"]).withColumnRenamed("active_users", "sketched")
    near = F.abs(F.col("sketched") - F.col("active_users")) <= F.col("active_users") * sketches.DISTINCT_ERROR
    return time_texts(exact.join(found, "window_start").select("window_start", "active_users", near.alias("near")),
                      "window_start")


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    latency_sketch_quantiles, active_users_sliding,
    requests_by_endpoint, request_rate_5m, request_rate_sliding, request_rate_by_endpoint, errors_by_type,
    latency_histogram, latency_quantiles, latency_quantiles_5m, latency_bucket_quantiles, request_summary,
    success_ratio, errors_per_minute, alert_state, in_progress, active_users)}


def _window(seconds: int) -> str:
    return (f"strftime(to_timestamp(CAST(floor(epoch(ts) / {seconds}) AS BIGINT) * {seconds}) AT TIME ZONE 'UTC',"
            " '%Y-%m-%d %H:%M:%S') AS window_start")


_BUCKETS = "bounds(i, le) AS (VALUES " + ", ".join(
    f"({i}, CAST({b} AS DOUBLE))" for i, b in enumerate(monitor.LATENCY_BOUNDS)) + ")"


def _estimated(key: str, source: str, probabilities: dict[str, float]) -> str:
    """Quantiles by linear interpolation inside the first bucket that reaches the rank."""
    wanted = ", ".join(f"('{n}', CAST({p} AS DOUBLE))" for n, p in probabilities.items())
    return f"""cum AS (SELECT {key}, i, le, count(*) FILTER (WHERE latency_s <= le) AS n, count(latency_s) AS total
    FROM {source}, bounds GROUP BY {key}, i, le),
steps AS (SELECT *, coalesce(lag(n) OVER w, 0) AS before, coalesce(lag(le) OVER w, 0) AS low
    FROM cum WINDOW w AS (PARTITION BY {key} ORDER BY i)),
est AS (SELECT {key}, name, arg_min(low + (le - low) * (total * p - before) / (n - before), i) AS v
    FROM steps, (VALUES {wanted}) q(name, p) WHERE n >= total * p AND n > before GROUP BY {key}, name)"""


_SIX_HOURS = """spread AS (SELECT log.*, strftime(date_trunc('hour', ts) - to_hours(k), '%Y-%m-%d %H:%M:%S')
    AS window_start FROM log, (VALUES (0), (1), (2), (3), (4), (5)) b(k))"""

ORACLES: dict[str, str] = {
    "latency_sketch_quantiles": sql("""SELECT window_start, endpoint, count(*) AS requests, true AS p50_near,
        true AS p95_near, true AS p99_near FROM spread GROUP BY 1, 2""", LOG, _SIX_HOURS),
    "active_users_sliding": sql("""SELECT window_start, count(DISTINCT user_idx) AS active_users, true AS near
        FROM spread GROUP BY 1""", LOG, _SIX_HOURS),
    "requests_by_endpoint": sql("""SELECT endpoint, count(*) AS requests, count(*) FILTER (WHERE status = 200) AS successful
        FROM log GROUP BY 1""", LOG),
    "request_rate_5m": sql(f"""SELECT {_window(300)}, count(*) AS requests,
        round(count(*) / CAST(5 AS DOUBLE), 6) AS rate FROM log WHERE status = 200 GROUP BY 1""", LOG),
    "request_rate_sliding": sql("""SELECT strftime(to_timestamp(w) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')
        AS window_start, count(*) AS requests, round(count(*) / CAST(5 AS DOUBLE), 6) AS rate
        FROM (SELECT CAST(floor(epoch(ts) / 60) AS BIGINT) * 60 - 60 * k AS w
              FROM log, (VALUES (0), (1), (2), (3), (4)) b(k) WHERE status = 200) GROUP BY 1""", LOG),
    "request_rate_by_endpoint": sql(f"""SELECT {_window(60)}, endpoint, count(*) AS requests,
        round(count(*) / CAST(60 AS DOUBLE), 6) AS rate FROM log WHERE status = 200 GROUP BY 1, 2""", LOG),
    "errors_by_type": sql("SELECT endpoint, count(*) AS errors FROM log WHERE status <> 200 GROUP BY 1", LOG),
    "latency_histogram": sql("""SELECT endpoint, CAST(le AS VARCHAR) AS le, count(*) FILTER (WHERE latency_s <= le) AS n
        FROM log, bounds GROUP BY 1, 2
        UNION ALL SELECT endpoint, '+Inf', count(*) FROM log GROUP BY 1""", LOG, _BUCKETS),
    "latency_quantiles": sql(f"""SELECT {_window(3600)}, endpoint, {", ".join(
        f"round(quantile_cont(latency_s, {p}), 8) AS {n}" for n, p in monitor.QUANTILES.items())}
        FROM log GROUP BY 1, 2""", LOG),
    "latency_quantiles_5m": sql(f"""SELECT {_window(300)}, {", ".join(
        f"round(quantile_cont(latency_s, {p}), 8) AS {n}" for n, p in monitor.QUANTILES.items())}
        FROM log GROUP BY 1""", LOG),
    "latency_bucket_quantiles": sql("""SELECT endpoint, round(max(v) FILTER (name = 'p50'), 6) AS p50,
        round(max(v) FILTER (name = 'p95'), 6) AS p95, round(max(v) FILTER (name = 'p99'), 6) AS p99
        FROM est GROUP BY 1""", LOG, _BUCKETS, _estimated("endpoint", "log", monitor.QUANTILES)),
    "request_summary": sql("""SELECT count(*) AS total, count(*) FILTER (WHERE status = 200) AS success,
        count(*) FILTER (WHERE status <> 200) AS errors,
        round(count(*) FILTER (WHERE status = 200) * CAST(100 AS DOUBLE) / count(*), 6) AS success_rate,
        round(avg(latency_s) FILTER (status = 200) * 1000, 2) AS avg_ms,
        round(min(latency_s) FILTER (status = 200) * 1000, 2) AS min_ms,
        round(max(latency_s) FILTER (status = 200) * 1000, 2) AS max_ms FROM log""", LOG),
    "success_ratio": sql(f"""SELECT {_window(300)},
        round(count(*) FILTER (WHERE status = 200) / CAST(count(*) AS DOUBLE), 6) AS success_ratio FROM log GROUP BY 1""", LOG),
    "errors_per_minute": sql(f"""SELECT {_window(300)},
        round(count(*) FILTER (WHERE status = 500) / CAST(5 AS DOUBLE), 6) AS errors_per_minute FROM log GROUP BY 1""", LOG),
    "alert_state": sql("""SELECT window_start, round(p95, 6) AS p95, round(ratio, 6) AS success_ratio,
        CASE WHEN p95 >= 0.5 THEN 'red' WHEN p95 >= 0.1 THEN 'yellow' ELSE 'green' END AS latency_state,
        CASE WHEN ratio >= 0.99 THEN 'green' WHEN ratio >= 0.95 THEN 'yellow' ELSE 'red' END AS success_state
        FROM (SELECT window_start, count(*) FILTER (WHERE status = 200) / CAST(count(*) AS DOUBLE) AS ratio FROM hourly GROUP BY 1)
        JOIN (SELECT window_start, v AS p95 FROM est) USING (window_start)""",
                       LOG, f"hourly AS (SELECT *, {_window(3600)} FROM log)", _BUCKETS,
                       _estimated("window_start", "hourly", {"p95": 0.95})),
    "in_progress": sql("""SELECT t AS instant_us, CAST(sum(sum(c)) OVER (ORDER BY t) AS BIGINT) AS in_progress
        FROM (SELECT epoch_us(ts) AS t, 1 AS c FROM log UNION ALL
              SELECT epoch_us(ts) + CAST(round(latency_s * 1000 * 1000000) AS BIGINT), -1 FROM log)
        GROUP BY t""", LOG),
    "active_users": sql(f"SELECT {_window(3600)}, count(DISTINCT user_idx) AS active_users FROM log GROUP BY 1", LOG),
}
