"""Registered queries: the events table read as a stream of files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.functions.scalars import timestamp_to_iso
from marquee.plans import monitoring, validation
from marquee.plans.common import EVENTS, LOG, Query, rounded, sql, time_texts
from marquee.plans.featuring import GENRED
from marquee.session import scratch_path
from marquee.sources import kafka, proxies
from marquee.streaming import alerts, counters, jobs, sinks, windows

WINDOW, SLIDE = "24 hours", "6 hours"
COUNT_SIZE = 10
GAP = "6 hours"
LATENESS = "12 hours"
ALERT_WINDOW, ALERT_HOLD = "1 hour", "4 hours"


# Streams read the events in so many micro-batches.
FILES = 5


def _named(events: DataFrame) -> DataFrame:
    """Events naming a genre unless they are errors."""
    return events.withColumn("genres", F.when(F.col("event_type") != "error", F.col("event_type")))


# Where a session has already written them, and the files per micro-batch.
_written: dict[tuple, tuple[str, int]] = {}


def _stream(spark: SparkSession, folder: str, copies: int = 1, tick: str | None = None, even: bool = False) -> DataFrame:
    key = (spark.sparkContext.applicationId, folder, copies, tick, even)
    if key not in _written:
        path = scratch_path(spark, "events")
        _written[key] = path, proxies.event_files(spark, folder, path, FILES, copies, tick, even)
    path, each = _written[key]
    return _named(proxies.event_stream(spark, path, "*.parquet", files_per_batch=each))


def _keyed(spark: SparkSession, rows: DataFrame, keys: list[str]) -> DataFrame:
    table = sinks.KeyedTable(spark, scratch_path(spark, "keyed"), keys)
    sinks.drain(rows, table.write)
    return table.read()


def _appended(spark: SparkSession, rows: DataFrame) -> DataFrame:
    table = sinks.BatchTable(spark, scratch_path(spark, "appended"))
    sinks.drain(rows, table.write, "append")
    return table.read()


def stream_user_activity(spark: SparkSession, folder: str) -> DataFrame:
    rows = _keyed(spark, counters.user_activity(_stream(spark, folder)), ["user_idx"])
    return time_texts(rows, "event_timestamp")


def stream_user_activity_buckets(spark: SparkSession, folder: str) -> DataFrame:
    """The same pushed into buckets of users, of which each micro-batch writes those it touches."""
    table = sinks.BucketedTable(spark, scratch_path(spark, "buckets"), ["user_idx"])
    sinks.drain(counters.user_activity(_stream(spark, folder)), table.write)
    return time_texts(table.read(), "event_timestamp")


def stream_last_genre(spark: SparkSession, folder: str) -> DataFrame:
    rows = _keyed(spark, counters.last_genre(_stream(spark, folder)), ["user_idx"])
    return rows.select("user_idx", "user_last_genre")


def stream_movie_popularity(spark: SparkSession, folder: str) -> DataFrame:
    rows = _keyed(spark, counters.movie_stream_features(_stream(spark, folder)), ["movie_idx"])
    return time_texts(rows, "event_timestamp")


def stream_movie_popularity_all(spark: SparkSession, folder: str) -> DataFrame:
    """Movies with other events only are kept at 0."""
    rows = _keyed(spark, counters.movie_stream_features(_stream(spark, folder), include_zero=True), ["movie_idx"])
    return rows.select("movie_idx", "movie_popularity")


def stream_push(spark: SparkSession, folder: str) -> DataFrame:
    """Both views kept by one query, as rows of (entity, key)."""
    with sinks.rocksdb_state(spark):
        query, users, movies = jobs.update_features(_stream(spark, folder), scratch_path(spark, "views"))
        query.awaitTermination()
    user_side = users.read().select(F.lit("user").alias("entity"), F.col("user_idx").alias("key"),
                                    F.col("user_recent_activity").alias("n"),
                                    F.col("user_last_genre").alias("last_genre"))
    movie_side = movies.read().select(F.lit("movie").alias("entity"), F.col("movie_idx").alias("key"),
                                      F.col("movie_popularity").alias("n"), F.lit("").alias("last_genre"))
    return user_side.unionByName(movie_side)


def stream_windowed_24h(spark: SparkSession, folder: str) -> DataFrame:
    panes = _keyed(spark, counters.activity_panes(_stream(spark, folder), SLIDE, "60 days"),
                   ["window_start", "user_idx"])
    return time_texts(counters.sliding_activity(panes, WINDOW, SLIDE), "window_start")


def stream_windowed_features(spark: SparkSession, folder: str) -> DataFrame:
    """All four stream features per sliding window."""
    with sinks.rocksdb_state(spark):
        panes = _keyed(spark, counters.feature_panes(_stream(spark, folder), SLIDE, "60 days"),
                       ["window_start", "entity", "key"])
    return time_texts(counters.sliding_features(panes, WINDOW, SLIDE), "window_start")


def stream_event_types(spark: SparkSession, folder: str) -> DataFrame:
    return _keyed(spark, counters.event_types(_stream(spark, folder)), ["event_type"])


def stream_totals(spark: SparkSession, folder: str) -> DataFrame:
    query, users, movies = jobs.update_features(_stream(spark, folder), scratch_path(spark, "views"))
    query.awaitTermination()
    return counters.totals(users.read(), movies.read())


def stream_recent(spark: SparkSession, folder: str) -> DataFrame:
    """The newest ten events of the stream, carried from batch to batch."""
    table = sinks.BatchTable(spark, scratch_path(spark, "recent"))
    events = _stream(spark, folder).select("event_id", "user_idx", "event_type", "movie_idx", "ts")
    sinks.drain(events, lambda batch, i: table.write(counters.recent_events(batch), i), "append")
    return time_texts(counters.recent_events(table.read()), "ts")


def stream_summary(spark: SparkSession, folder: str) -> DataFrame:
    """One summary row per micro-batch; here all events come in one."""
    table = sinks.BatchTable(spark, scratch_path(spark, "summary"))
    sinks.drain(_named(proxies.event_stream(spark, folder)),
                lambda batch, i: table.write(counters.batch_summary(batch), i), "append")
    return table.read().select(
        "events", "active_users", "popular_movies",
        F.concat_ws(",", F.transform(F.map_entries("per_type"),
                                     lambda e: F.concat(e.key, F.lit("="), e.value))).alias("per_type"),
        F.concat_ws(",", F.transform("last_events", lambda e: F.concat(
            e.user_idx, F.lit(":"), e.event_type, F.lit(":"), e.movie_idx))).alias("last_events"))


def _listed(per_type: str) -> Column:
    return F.concat_ws(",", F.transform(F.map_entries(per_type), lambda e: F.concat(e.key, F.lit("="), e.value)))


def stream_summaries(spark: SparkSession, folder: str) -> DataFrame:
    """A row per micro-batch, one for each fifth of the time, with totals since the start."""
    query, table = jobs.keep_summaries(_stream(spark, folder, even=True), scratch_path(spark, "summaries"))
    query.awaitTermination()
    return table.read().select(
        "batch", "events", "active_users", "popular_movies", _listed("per_type").alias("per_type"),
        "total_events", _listed("total_per_type").alias("total_per_type"))


def stream_messages(spark: SparkSession, folder: str) -> DataFrame:
    """Every fifth event is cut short on its way, every seventh has no type; how many went where, by error."""
    path = scratch_path(spark, "messages")
    produced = proxies.events(spark, folder).select(
        F.col("event_id").cast("string").alias("event_id"), "user_idx", "movie_idx",
        F.when(F.col("event_id") % 7 != 0, F.lit("view")).alias("event_type"),
        timestamp_to_iso(F.col("ts")).alias("timestamp"), F.lit("s").alias("session_id"))
    whole = kafka.encode(produced).select(
        F.when(F.get_json_object("value", "$.event_id").cast("long") % 5 == 0,
               F.expr("left(value, length(value) - 2)")).otherwise(F.col("value")).alias("value"))
    whole.repartition(3).write.text(path)
    query, good, bad = jobs.split_messages(
        spark.readStream.option("maxFilesPerTrigger", 1).text(path), scratch_path(spark, "checked"), validation.NOW * 2)
    query.awaitTermination()
    rejected = bad.read().select(F.concat_ws("; ", "errors").alias("errors"), F.length("value").alias("size"))
    return rejected.unionByName(good.read().select(F.lit("").alias("errors"), F.lit(0).alias("size"))).groupBy(
        "errors").agg(F.count("*").alias("messages"))


def stream_arrivals(spark: SparkSession, folder: str) -> DataFrame:
    """Fifths of the time, each checked for users' repeated events of a kind on a movie, against all before it too."""
    query, index = jobs.check_arrivals(_stream(spark, folder, even=True), scratch_path(spark, "arrivals"),
                                       ["user_idx", "movie_idx", "event_type"])
    query.awaitTermination()
    return index.read()


def stream_json_roundtrip(spark: SparkSession, folder: str) -> DataFrame:
    """Events written as JSON messages, streamed back and parsed."""
    path = scratch_path(spark, "messages")
    produced = proxies.events(spark, folder).select(
        F.col("event_id").cast("string").alias("event_id"), "user_idx", "movie_idx", "event_type",
        timestamp_to_iso(F.col("ts")).alias("timestamp"),
        F.concat(F.lit("session_"), F.col("user_idx")).alias("session_id"),
        F.when(F.col("event_type") == "purchase", F.round("value", 1)).alias("rating"))
    kafka.encode(produced).select("value").write.text(path)
    messages = spark.readStream.text(path)
    return time_texts(_appended(spark, kafka.decode(messages)), "ts")


def stream_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Every event arrives twice, in different micro-batches, and is kept once."""
    with sinks.rocksdb_state(spark):
        rows = _appended(spark, counters.deduplicated(_stream(spark, folder, copies=2), "60 days"))
    return time_texts(rows.select("event_id", "user_idx", "event_type", "ts"), "ts")


def stream_sessions(spark: SparkSession, folder: str) -> DataFrame:
    """Sessions leave the stream once the watermark is past them; a tick at the end takes it past the last."""
    ticked = _stream(spark, folder, tick="2 days").withWatermark("ts", LATENESS)
    # Naming the time keeps the condition above the watermark, which ticks are there to move.
    real = ticked.where((F.col("event_type") != proxies.TICK) | F.col("ts").isNull())
    rows = _appended(spark, counters.session_rows(real, GAP, lateness=None))
    return time_texts(rows, "session_start", "session_end")


def batch_sessions(spark: SparkSession, folder: str) -> DataFrame:
    panes = counters.session_panes(proxies.events(spark, folder), GAP)
    return time_texts(counters.sessions(panes, GAP), "session_start", "session_end")


def stream_count_window(spark: SparkSession, folder: str) -> DataFrame:
    """From keyed state; the table takes the windows that each micro-batch touched."""
    with sinks.rocksdb_state(spark):
        rows = _keyed(spark, windows.keyed_count_windows(_stream(spark, folder), "movie_idx", COUNT_SIZE),
                      ["movie_idx", "window_no"])
    return time_texts(rows, "first_ts", "last_ts")


def stream_count_window_spread(spark: SparkSession, folder: str) -> DataFrame:
    """The same with a key's events of one micro-batch dealt over tasks."""
    table = windows.CountWindows(spark, scratch_path(spark, "count"), "movie_idx", COUNT_SIZE)
    sinks.drain(_stream(spark, folder), table.write, "append")
    return time_texts(table.read(), "first_ts", "last_ts")


def stream_features_24h(spark: SparkSession, folder: str) -> DataFrame:
    """Features of users and movies over the last 24 hours, as rows of (entity, key)."""
    with sinks.rocksdb_state(spark):
        query, kept = jobs.keep_features(_stream(spark, folder), scratch_path(spark, "views"), lateness=LATENESS)
        query.awaitTermination()
    users, movies = kept.users(), kept.movies()
    return time_texts(users.select(
        F.lit("user").alias("entity"), F.col("user_idx").alias("key"), F.col("user_recent_activity").alias("n"),
        F.col("user_last_genre").alias("last_genre"), "event_timestamp").unionByName(movies.select(
            F.lit("movie").alias("entity"), F.col("movie_idx").alias("key"), F.col("movie_popularity").alias("n"),
            F.lit("").alias("last_genre"), "event_timestamp")), "event_timestamp")


def stream_late_rows(spark: SparkSession, folder: str) -> DataFrame:
    """All events come again after the last: those that the watermark has passed are late, the rest repeated."""
    table = sinks.BatchTable(spark, scratch_path(spark, "late"))
    events = counters.deduplicated(_stream(spark, folder, copies=2), LATENESS, collapse=False)
    query = sinks.drain(events, table.write, "append")
    return table.read().agg(F.count("*").alias("kept"), F.lit(sinks.late_rows(query)).cast("long").alias("late_rows"))


def _ticked_log(spark: SparkSession, folder: str) -> DataFrame:
    """The request log as a stream whose watermark passes the last window."""
    ticked = _stream(spark, folder, tick="2 days").withWatermark("ts", LATENESS)
    return proxies.as_requests(ticked.where((F.col("event_type") != proxies.TICK) | F.col("ts").isNull()))


def stream_alert_state(spark: SparkSession, folder: str) -> DataFrame:
    """The states of each hour, as its window leaves the stream."""
    rows = _appended(spark, alerts.window_states(_ticked_log(spark, folder), ALERT_WINDOW, lateness=None))
    return time_texts(rounded(rows.select(F.col("frame.start").alias("window_start"), "p95", "success_ratio",
                                          "latency_state", "success_state")), "window_start")


def stream_alerts(spark: SparkSession, folder: str) -> DataFrame:
    """Alerts that fire when a panel stays red for four hours."""
    with sinks.rocksdb_state(spark):
        rows = _appended(spark, alerts.alert_changes(_ticked_log(spark, folder), ALERT_HOLD, ALERT_WINDOW,
                                                     lateness=None))
    return time_texts(rows, "at", "since")


def batch_count_window(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(windows.count_windows(proxies.events(spark, folder), "user_idx", COUNT_SIZE),
                      "first_ts", "last_ts")


def stream_validated(spark: SparkSession, folder: str) -> DataFrame:
    """Rejected events with their errors, and how many passed, from one query."""
    events = validation.service_events(_stream(spark, folder))
    query, good, bad = jobs.split_valid(events, scratch_path(spark, "checked"), validation.NOW)
    query.awaitTermination()
    rejected = bad.read().select("event_id", F.concat_ws("; ", "errors").alias("errors"))
    return rejected.unionByName(good.read().select("event_id", F.lit("").alias("errors")))


def event_rate(spark: SparkSession, folder: str) -> DataFrame:
    """Events per second over each day."""
    daily = proxies.events(spark, folder).groupBy(F.window("ts", "1 day").alias("w")).agg(
        F.count("*").alias("events"))
    return rounded(time_texts(daily.select(
        F.col("w.start").alias("window_start"), "events",
        (F.col("events") / 86400).alias("events_per_second")), "window_start"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    stream_user_activity, stream_last_genre, stream_movie_popularity, stream_movie_popularity_all,
    stream_push, stream_windowed_24h, stream_windowed_features, stream_event_types, stream_totals, stream_recent, stream_summary,
    stream_json_roundtrip, stream_dedup, stream_sessions, batch_sessions, stream_count_window,
    batch_count_window, stream_validated, event_rate, stream_count_window_spread, stream_features_24h,
    stream_late_rows, stream_summaries, stream_messages, stream_user_activity_buckets, stream_arrivals,
    stream_alert_state, stream_alerts)}

_SESSIONS = """marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_idx ORDER BY ts)
    <= INTERVAL 6 HOUR THEN 0 ELSE 1 END AS opens FROM ev),
grouped AS (SELECT *, sum(opens) OVER (PARTITION BY user_idx ORDER BY ts, event_id) AS s FROM marked),
sess AS (SELECT user_idx, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS session_start,
    strftime(max(ts) + INTERVAL 6 HOUR, '%Y-%m-%d %H:%M:%S') AS session_end, count(*) AS events
    FROM grouped GROUP BY user_idx, s)"""


# The fifths of the time that micro-batches hold.
_PARTED = """ends AS (SELECT epoch_us(min(ts)) AS a, epoch_us(max(ts)) AS b FROM ev),
parted AS (SELECT ev.*, CAST(floor((epoch_us(ts) - a) * 5 / (b - a + 1)) AS BIGINT) AS batch FROM ev, ends)"""


def _time(column: str) -> str:
    return f"strftime({column}, '%Y-%m-%d %H:%M:%S') AS {column}"


def _count_window(key: str) -> str:
    return f"""SELECT {key}, CAST(floor((nth - 1) / {COUNT_SIZE}) AS BIGINT) AS window_no, count(*) AS events,
        count(*) FILTER (WHERE event_type IN ('view', 'click')) AS watched,
        strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS first_ts, strftime(max(ts), '%Y-%m-%d %H:%M:%S') AS last_ts
        FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY ts, event_id) AS nth FROM ev) GROUP BY 1, 2"""


ORACLES: dict[str, str] = {
    "stream_user_activity": sql(f"""SELECT user_idx, user_recent_activity, {_time("event_timestamp")}
        FROM ustream""", EVENTS, GENRED),
    "stream_user_activity_buckets": sql(f"""SELECT user_idx, user_recent_activity, {_time("event_timestamp")}
        FROM ustream""", EVENTS, GENRED),
    "stream_last_genre": sql("SELECT user_idx, user_last_genre FROM ustream", EVENTS, GENRED),
    "stream_movie_popularity": sql(f"""SELECT movie_idx, movie_popularity, movie_recent_views,
        {_time("event_timestamp")} FROM mstream""", EVENTS, GENRED),
    "stream_movie_popularity_all": sql("""SELECT movie_idx, count(*) FILTER (WHERE event_type IN ('view', 'click'))
        AS movie_popularity FROM ev GROUP BY 1""", EVENTS),
    "stream_push": sql("""SELECT 'user' AS entity, user_idx AS "key", user_recent_activity AS n,
        user_last_genre AS last_genre FROM ustream UNION ALL
        SELECT 'movie', movie_idx, movie_popularity, '' FROM mstream""", EVENTS, GENRED),
    "stream_windowed_24h": sql("""SELECT strftime(to_timestamp(w) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')
        AS window_start, user_idx, count(*) AS events FROM (
            SELECT user_idx, CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 - 21600 * k AS w
            FROM ev, (VALUES (0), (1), (2), (3)) b(k)) GROUP BY 1, 2""", EVENTS),
    "stream_windowed_features": sql("""SELECT strftime(to_timestamp(w) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S')
        AS window_start, entity, "key", count(*) AS n, coalesce((list(event_type ORDER BY ts DESC, event_id DESC)
            FILTER (WHERE event_type <> 'error'))[1], 'Unknown') AS last_genre FROM (
            SELECT e.*, CAST(floor(epoch(ts) / 21600) AS BIGINT) * 21600 - 21600 * k AS w FROM (
                SELECT 'user' AS entity, user_idx AS "key", ts, event_id, event_type FROM ev UNION ALL
                SELECT 'movie', movie_idx, ts, event_id, event_type FROM ev WHERE event_type IN ('view', 'click')) e,
            (VALUES (0), (1), (2), (3)) b(k)) GROUP BY 1, 2, 3""", EVENTS),
    "stream_event_types": sql("SELECT event_type, count(*) AS events FROM ev GROUP BY 1", EVENTS),
    "stream_totals": sql("""SELECT (SELECT count(*) FROM ustream) AS active_users,
        (SELECT count(*) FROM mstream) AS active_movies,
        (SELECT count(*) FROM ev) AS total_user_events,
        (SELECT count(*) FROM ev WHERE event_type IN ('view', 'click')) AS total_movie_views""", EVENTS, GENRED),
    "stream_recent": sql(f"""SELECT event_id, user_idx, event_type, movie_idx, {_time("ts")} FROM
        (SELECT * FROM ev ORDER BY ts DESC, event_id DESC LIMIT 10)""", EVENTS),
    "stream_summary": sql("""SELECT count(*) AS events, count(DISTINCT user_idx) AS active_users,
        count(DISTINCT movie_idx) FILTER (event_type IN ('view', 'click')) AS popular_movies,
        (SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type)
         FROM (SELECT event_type, count(*) AS n FROM ev GROUP BY 1)) AS per_type,
        (SELECT string_agg(user_idx || ':' || event_type || ':' || movie_idx, ',' ORDER BY ts DESC, event_id DESC)
         FROM (SELECT * FROM ev ORDER BY ts DESC, event_id DESC LIMIT 3)) AS last_events FROM ev""", EVENTS),
    "stream_json_roundtrip": sql("""SELECT CAST(event_id AS VARCHAR) AS event_id, user_idx, movie_idx,
        event_type, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp", 'session_' || user_idx AS session_id,
        CASE WHEN event_type = 'purchase' THEN round("value", 1) END AS rating,
        strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM ev""", EVENTS),
    "stream_dedup": sql(f'SELECT event_id, user_idx, event_type, {_time("ts")} FROM ev', EVENTS),
    "stream_sessions": sql("SELECT * FROM sess", EVENTS, _SESSIONS),
    "batch_sessions": sql("SELECT * FROM sess", EVENTS, _SESSIONS),
    "stream_count_window": sql(_count_window("movie_idx"), EVENTS),
    "stream_count_window_spread": sql(_count_window("movie_idx"), EVENTS),
    "stream_features_24h": sql("""SELECT entity, "key", count(*) AS n, CASE WHEN entity = 'movie' THEN '' ELSE
        coalesce((list(event_type ORDER BY ts DESC, event_id DESC) FILTER (WHERE event_type <> 'error'))[1], 'Unknown')
        END AS last_genre, strftime(date_trunc('hour', max(ts)) + INTERVAL 1 HOUR, '%Y-%m-%d %H:%M:%S') AS event_timestamp
        FROM (SELECT 'user' AS entity, user_idx AS "key", ts, event_id, event_type FROM ev UNION ALL
              SELECT 'movie', movie_idx, ts, event_id, event_type FROM ev WHERE event_type IN ('view', 'click'))
        WHERE date_trunc('hour', ts) > (SELECT date_trunc('hour', max(ts)) FROM ev) - INTERVAL 24 HOUR
        GROUP BY 1, 2""", EVENTS),
    "stream_late_rows": sql("""SELECT count(*) AS kept, count(*) FILTER (WHERE epoch_us(ts) <=
        (SELECT epoch_ms(max(ts)) FROM ev) * 1000 - 12 * 3600000000) AS late_rows FROM ev""", EVENTS),
    "stream_summaries": sql("""SELECT batch, (SELECT sum(n) FROM counts c WHERE c.batch = b.batch)::BIGINT AS events,
        active_users, popular_movies,
        (SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type) FROM counts c WHERE c.batch = b.batch) AS per_type,
        (SELECT sum(n) FROM counts c WHERE c.batch <= b.batch)::BIGINT AS total_events,
        (SELECT string_agg(event_type || '=' || n, ',' ORDER BY event_type) FROM
            (SELECT event_type, sum(n)::BIGINT AS n FROM counts c WHERE c.batch <= b.batch GROUP BY 1)) AS total_per_type
        FROM (SELECT batch, count(DISTINCT user_idx) AS active_users,
                     count(DISTINCT movie_idx) FILTER (event_type IN ('view', 'click')) AS popular_movies
              FROM parted GROUP BY 1) b""", EVENTS, _PARTED, """counts AS (SELECT batch, event_type, count(*) AS n FROM parted GROUP BY 1, 2)"""),
    "stream_arrivals": sql("""SELECT batch AS arrival, sum(m)::BIGINT AS element_count,
        coalesce(sum(m) FILTER (WHERE lost), 0)::BIGINT AS missing_count,
        coalesce(sum(m) FILTER (WHERE NOT lost AND n > 1), 0)::BIGINT AS repeated_rows,
        coalesce(sum(CASE WHEN n > 1 THEN n ELSE 0 END - CASE WHEN n - m > 1 THEN n - m ELSE 0 END)
                 FILTER (WHERE NOT lost), 0)::BIGINT AS more_repeated
        FROM (SELECT *, sum(m) OVER (PARTITION BY user_idx, movie_idx, event_type ORDER BY batch) AS n,
                     user_idx IS NULL OR movie_idx IS NULL OR event_type IS NULL AS lost
              FROM (SELECT user_idx, movie_idx, event_type, batch, count(*) AS m FROM parted GROUP BY ALL)) GROUP BY 1""",
        EVENTS, _PARTED),
    "stream_messages": sql("""SELECT CASE WHEN event_id % 5 = 0 THEN 'Message holds no event'
        WHEN event_id % 7 = 0 THEN 'Missing required field: event_type' ELSE '' END AS errors, count(*) AS messages
        FROM ev GROUP BY 1""", EVENTS),
    "stream_alert_state": monitoring.ORACLES["alert_state"],
    "stream_alerts": sql(f"""SELECT panel, change, strftime(t, '%Y-%m-%d %H:%M:%S') AS "at", {_time("since")} FROM (
        SELECT panel, 'pending' AS change, since AS t, since FROM red
        UNION ALL SELECT panel, 'firing', since + INTERVAL {ALERT_HOLD}, since FROM red WHERE fires
        UNION ALL SELECT panel, CASE WHEN fires THEN 'resolved' ELSE 'cleared' END, til, since
        FROM red WHERE til IS NOT NULL)""",
        f"state AS ({monitoring.ORACLES['alert_state']})", f"""ends AS (
        SELECT 'latency' AS panel, CAST(window_start AS TIMESTAMP) + INTERVAL {ALERT_WINDOW} AS t, latency_state = 'red' AS bad
        FROM state WHERE latency_state IS NOT NULL UNION ALL
        SELECT 'success', CAST(window_start AS TIMESTAMP) + INTERVAL {ALERT_WINDOW}, success_state = 'red' FROM state),
    opened AS (SELECT *, CASE WHEN bad = lag(bad) OVER (PARTITION BY panel ORDER BY t) THEN 0 ELSE 1 END AS opens FROM ends),
    runs AS (SELECT panel, bad, n, min(t) AS since FROM
        (SELECT *, sum(opens) OVER (PARTITION BY panel ORDER BY t) AS n FROM opened) GROUP BY 1, 2, 3),
    red AS (SELECT *, til IS NULL OR til > since + INTERVAL {ALERT_HOLD} AS fires FROM
        (SELECT *, lead(since) OVER (PARTITION BY panel ORDER BY n) AS til FROM runs) WHERE bad)"""),
    "batch_count_window": sql(_count_window("user_idx"), EVENTS),
    "stream_validated": validation.ORACLES["validate_events"].replace(
        "SELECT event_id, errors = '' AS valid, errors FROM", "SELECT event_id, errors FROM", 1),
    "event_rate": sql("""SELECT strftime(date_trunc('day', ts), '%Y-%m-%d %H:%M:%S') AS window_start,
        count(*) AS events, round(count(*) / CAST(86400 AS DOUBLE), 6) AS events_per_second FROM ev GROUP BY 1""",
                      EVENTS),
}
