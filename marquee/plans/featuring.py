"""Registered queries: batch features and the feature store."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators import features, store
from marquee.operators.asof import asof_join
from marquee.plans.common import EVENTS, GENRES, MOVIES, RATINGS, Query, as_doubles, rounded, sql, time_text, time_texts
from marquee.session import scratch_path
from marquee.sources import files, proxies
from marquee.streaming import counters


def _utc(year: int, month: int, day: int) -> datetime:
    return datetime(year, month, day, tzinfo=timezone.utc)


AS_OF = _utc(2002, 1, 1)
NOW = _utc(2024, 2, 1)
SNAPSHOT_YEARS = (1996, 1997, 1998, 1999, 2000, 2001)


def user_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.user_features(proxies.ratings(spark, folder)))


def movie_features(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.movie_features(proxies.ratings(spark, folder), proxies.movies(spark, folder)))


def user_favorite_genre(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.favourite_genre(proxies.ratings(spark, folder), proxies.movies(spark, folder)))


def genre_affinity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(features.genre_affinity(proxies.ratings(spark, folder), proxies.movies(spark, folder)))


def genre_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return features.genre_vocabulary(proxies.movies(spark, folder))


def genre_one_hot(spark: SparkSession, folder: str) -> DataFrame:
    return features.genre_one_hot(proxies.movies(spark, folder))


def _widened(df: DataFrame, digits: int = 4) -> DataFrame:
    """Floats of a view back as rounded doubles."""
    return df.select(*[
        F.round(F.col(f.name).cast("double"), digits).alias(f.name)
        if f.dataType.typeName() == "float" else F.col(f.name) for f in df.schema])


def _user_batch(spark: SparkSession, folder: str) -> DataFrame:
    made = features.user_view_features(proxies.ratings(spark, folder), proxies.movies(spark, folder))
    return store.as_view(store.USER_BATCH, made.withColumn("event_timestamp", F.lit(AS_OF)))


def _movie_batch(spark: SparkSession, folder: str) -> DataFrame:
    made = features.movie_aggregates(proxies.ratings(spark, folder))
    return store.as_view(store.MOVIE_BATCH, made.withColumn("event_timestamp", F.lit(AS_OF)))


def user_feature_view(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(_widened(_user_batch(spark, folder)), "event_timestamp")


def user_feature_files(spark: SparkSession, folder: str) -> DataFrame:
    """The user view written to files of its day and read back."""
    path = scratch_path(spark, "views")
    files.write_features(_user_batch(spark, folder), f"{path}/{store.USER_BATCH.source}", AS_OF)
    return time_texts(_widened(store.read_view(spark, store.USER_BATCH, path)), "event_timestamp")


def _events(spark: SparkSession, folder: str) -> DataFrame:
    """Events naming a genre unless they are errors."""
    named = F.when(F.col("event_type") != "error", F.col("event_type"))
    return proxies.events(spark, folder).withColumn("genres", named)


def _daily(spark: SparkSession, folder: str) -> DataFrame:
    """Stream features of each user and day, as a table with history."""
    return _events(spark, folder).groupBy("user_idx", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("user_recent_activity"), F.max("event_type").alias("user_last_genre"),
        F.max("ts").alias("event_timestamp")).drop("day")


def online_user_features(spark: SparkSession, folder: str) -> DataFrame:
    users = proxies.table(spark, folder, "customer").select(F.col("c_custkey").alias("user_idx"))
    latest = {
        "user_batch_features": store.materialize(store.USER_BATCH, _user_batch(spark, folder), AS_OF),
        "user_stream_features": counters.user_stream_features(_events(spark, folder))}
    return as_doubles(_widened(store.user_bundle(users, latest)), "user_rating_count")


def online_movie_features(spark: SparkSession, folder: str) -> DataFrame:
    movies = proxies.movies(spark, folder).select("movie_idx")
    latest = {
        "movie_batch_features": store.materialize(store.MOVIE_BATCH, _movie_batch(spark, folder), AS_OF),
        "movie_stream_features": counters.movie_stream_features(_events(spark, folder))}
    return as_doubles(_widened(store.movie_bundle(movies, latest)), "movie_rating_count")


def materialize_latest(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(store.materialize(store.USER_STREAM, _daily(spark, folder), _utc(2024, 1, 25),
                                        _utc(2024, 1, 10)), "event_timestamp")


def materialize_stream(spark: SparkSession, folder: str) -> DataFrame:
    return time_texts(store.materialize(store.USER_STREAM, _daily(spark, folder), _utc(2024, 1, 25)),
                      "event_timestamp")


def materialize_ttl(spark: SparkSession, folder: str) -> DataFrame:
    latest = store.materialize(store.USER_STREAM, _daily(spark, folder), _utc(2024, 1, 30),
                               _utc(2024, 1, 1))
    fresh = store.expire(store.USER_STREAM, latest, _utc(2024, 1, 30))
    return as_doubles(time_texts(fresh, "event_timestamp"), "user_recent_activity")


def push_upsert(spark: SparkSession, folder: str) -> DataFrame:
    daily = _daily(spark, folder)
    online = store.materialize(store.USER_STREAM, daily, _utc(2024, 1, 20), _utc(2024, 1, 1))
    arriving = daily.where(F.col("event_timestamp") > F.lit(_utc(2024, 1, 15)))
    return time_texts(store.push(store.USER_STREAM, online, arriving), "event_timestamp")


def asof_features(spark: SparkSession, folder: str) -> DataFrame:
    events = proxies.events(spark, folder)
    watching = F.col("event_type").isin(counters.WATCHING)
    known = events.where(watching).select("user_idx", F.col("ts").alias("seen_at"),
                                          F.col("value").alias("last_value"),
                                          F.col("movie_idx").alias("last_movie"))
    rows = events.where(~watching).select("event_id", "user_idx", "ts")
    found = asof_join(rows, known, ["user_idx"], "ts", "seen_at", ["last_value", "last_movie"],
                      timedelta(hours=24), keep_time="seen_at")
    return as_doubles(time_texts(found, "ts", "seen_at"), "last_movie")


def historical_features(spark: SparkSession, folder: str) -> DataFrame:
    """User features of yearly snapshots, as known at each order."""
    cutoffs = [int(_utc(y, 1, 1).timestamp()) for y in SNAPSHOT_YEARS]
    snapshots = features.user_feature_history(proxies.ratings(spark, folder), cutoffs).select(
        "user_idx", "user_avg_rating", "user_rating_count",
        F.timestamp_seconds("as_of").alias("event_timestamp"))
    lacking = {f: F.lit(None) for f in store.USER_BATCH.features if f not in snapshots.columns}
    orders = proxies.table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("user_idx"),
        F.col("o_orderdate").cast("timestamp").alias("event_timestamp"))
    found = store.historical_features(
        orders, {"user_batch_features": snapshots.withColumns(lacking)},
        ["user_batch_features:user_avg_rating", "user_batch_features:user_rating_count"])
    return as_doubles(time_texts(_widened(found), "event_timestamp"), "user_rating_count")


def feature_view_stats(spark: SparkSession, folder: str) -> DataFrame:
    parts = [store.view_stats(view, rows, NOW) for view, rows in (
        (store.USER_BATCH, _user_batch(spark, folder)),
        (store.USER_STREAM, store.as_view(store.USER_STREAM, _daily(spark, folder))))]
    return time_texts(rounded(reduce(DataFrame.unionByName, parts)), "newest")


def feature_freshness(spark: SparkSession, folder: str) -> DataFrame:
    return store.freshness({
        "user_stream_features": counters.user_stream_features(_events(spark, folder)),
        "movie_stream_features": counters.movie_stream_features(_events(spark, folder)),
    }, NOW).withColumn("newest", time_text("newest"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    user_features, movie_features, user_favorite_genre, genre_affinity, genre_vocabulary, genre_one_hot,
    user_feature_view, user_feature_files, online_user_features, online_movie_features, materialize_latest,
    materialize_stream, materialize_ttl, push_upsert, asof_features, historical_features,
    feature_view_stats, feature_freshness)}


def _aggregates(key: str, prefix: str) -> str:
    return f"""SELECT {key}, avg(rating) AS {prefix}_avg_rating,
        coalesce(stddev_samp(rating), 0) AS {prefix}_rating_std, count(rating) AS {prefix}_rating_count,
        min(rating) AS {prefix}_min_rating, max(rating) AS {prefix}_max_rating,
        min("timestamp") AS {prefix}_first_rating_time, max("timestamp") AS {prefix}_last_rating_time,
        max(rating) - min(rating) AS {prefix}_rating_range FROM ratings GROUP BY 1"""


USER_AGG = f"""uagg AS (SELECT *, (user_last_rating_time - user_first_rating_time) / CAST(86400 AS DOUBLE)
    AS user_days_active FROM ({_aggregates("user_idx", "user")}))"""
MOVIE_AGG = f"""pagg AS ({_aggregates("movie_idx", "movie")}),
magg AS (SELECT pagg.*, ln(1 + movie_rating_count) AS movie_popularity_score,
    (c * m + movie_avg_rating * movie_rating_count) / (c + movie_rating_count) AS movie_quality_score
    FROM pagg, (SELECT avg(movie_rating_count) AS c FROM pagg), (SELECT avg(rating) AS m FROM ratings))"""
AFFINITY = """tokens AS (
  SELECT user_idx, rating, unnest(string_split(genres, '|')) AS genre
  FROM ratings JOIN movies USING (movie_idx)
  WHERE genres IS NOT NULL AND genres <> '(no genres listed)'),
aff AS (SELECT user_idx, genre, count(*) AS n, avg(rating) AS a FROM tokens GROUP BY 1, 2),
fav AS (
  SELECT u.user_idx, coalesce(f.genre, 'Unknown') AS user_favorite_genre,
         coalesce(n, 0) AS user_favorite_genre_count, coalesce(a, 0.0) AS user_favorite_genre_avg_rating
  FROM (SELECT DISTINCT user_idx FROM ratings) u
  LEFT JOIN (SELECT *, row_number() OVER (PARTITION BY user_idx ORDER BY n DESC, genre) AS k FROM aff) f
    ON u.user_idx = f.user_idx AND k = 1)"""
GENRED = """named AS (SELECT *, CASE WHEN event_type <> 'error' THEN event_type END AS genres FROM ev),
ustream AS (
  SELECT user_idx, count(*) AS user_recent_activity, max(ts) AS event_timestamp,
         coalesce(arg_max(genres, (ts, event_id)) FILTER (genres IS NOT NULL), 'Unknown') AS user_last_genre
  FROM named GROUP BY 1),
mstream AS (
  SELECT movie_idx, count(*) AS movie_popularity, count(*) AS movie_recent_views, max(ts) AS event_timestamp
  FROM ev WHERE event_type IN ('view', 'click') GROUP BY 1)"""
DAILY = """daily AS (SELECT user_idx, count(*) AS user_recent_activity, max(event_type) AS user_last_genre,
    max(ts) AS event_timestamp FROM ev GROUP BY user_idx, CAST(ts AS DATE))"""


def _float(column: str) -> str:
    return f"round(CAST(CAST({column} AS FLOAT) AS DOUBLE), 4) AS {column}"


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


def _latest(condition: str, columns: str = "user_idx, user_recent_activity, user_last_genre, "
            "strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp") -> str:
    return f"""SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY user_idx
        ORDER BY event_timestamp DESC) AS k FROM daily WHERE {condition}) WHERE k = 1"""


_FLAGS = ", ".join(
    f"CASE WHEN genres IS NOT NULL AND list_contains(string_split(genres, '|'), '{g}') THEN 1 ELSE 0 END"
    f" AS genre_{g}" for g in GENRES)
_USER_FLOATS = ["user_avg_rating", "user_rating_std", "user_min_rating", "user_max_rating",
                "user_rating_range", "user_days_active", "user_favorite_genre_avg_rating"]
_SNAPSHOTS = "snaps AS (" + " UNION ALL ".join(
    f"""SELECT user_idx, avg(rating) AS user_avg_rating, count(*) AS user_rating_count,
    TIMESTAMP '{y}-01-01' AS at FROM ratings WHERE "timestamp" <= epoch(TIMESTAMP '{y}-01-01') GROUP BY 1"""
    for y in SNAPSHOT_YEARS) + ")"

ORACLES: dict[str, str] = {
    "user_features": sql(f"""SELECT user_idx, {_round("user_avg_rating", "user_rating_std")}, user_rating_count,
        user_min_rating, user_max_rating, user_first_rating_time, user_last_rating_time, user_rating_range,
        round(user_days_active, 6) AS user_days_active FROM uagg""", RATINGS, USER_AGG),
    "movie_features": sql(f"""SELECT magg.* EXCLUDE (movie_avg_rating, movie_rating_std,
        movie_popularity_score, movie_quality_score),
        {_round("movie_avg_rating", "movie_rating_std", "movie_popularity_score", "movie_quality_score")},
        genres, {_FLAGS} FROM magg LEFT JOIN movies USING (movie_idx)""", RATINGS, MOVIES, MOVIE_AGG),
    "user_favorite_genre": sql("""SELECT user_idx, user_favorite_genre, user_favorite_genre_count,
        round(user_favorite_genre_avg_rating, 6) AS user_favorite_genre_avg_rating FROM fav""",
                               RATINGS, MOVIES, AFFINITY),
    "genre_affinity": sql("SELECT user_idx, genre, n, round(a, 6) AS avg_rating FROM aff",
                          RATINGS, MOVIES, AFFINITY),
    "genre_vocabulary": sql("""SELECT DISTINCT unnest(string_split(genres, '|')) AS genre FROM movies
        WHERE genres <> '(no genres listed)' ORDER BY 1""", MOVIES),
    "genre_one_hot": sql(f'SELECT movie_idx, "movieId", title, genres, {_FLAGS} FROM movies', MOVIES),
    "user_feature_view": sql(f"""SELECT uagg.user_idx, {", ".join(_float(c) for c in _USER_FLOATS)},
        user_rating_count, user_favorite_genre, user_favorite_genre_count,
        '2002-01-01 00:00:00' AS event_timestamp
        FROM uagg JOIN fav ON uagg.user_idx = fav.user_idx""", RATINGS, MOVIES, USER_AGG, AFFINITY),
    "online_user_features": sql(f"""SELECT c_custkey AS user_idx, {_float("user_avg_rating")},
        CAST(user_rating_count AS DOUBLE) AS user_rating_count, user_favorite_genre, coalesce(user_recent_activity, 0) AS user_recent_activity,
        coalesce(user_last_genre, 'Unknown') AS user_last_genre FROM customer
        LEFT JOIN uagg ON c_custkey = uagg.user_idx LEFT JOIN fav ON c_custkey = fav.user_idx
        LEFT JOIN ustream ON c_custkey = ustream.user_idx""",
                                RATINGS, MOVIES, EVENTS, USER_AGG, AFFINITY, GENRED),
    "online_movie_features": sql(f"""SELECT movies.movie_idx, {_float("movie_avg_rating")},
        CAST(movie_rating_count AS DOUBLE) AS movie_rating_count, {_float("movie_popularity_score")},
        coalesce(movie_popularity, 0) AS movie_popularity, coalesce(movie_recent_views, 0) AS movie_recent_views
        FROM movies LEFT JOIN magg ON movies.movie_idx = magg.movie_idx
        LEFT JOIN mstream ON movies.movie_idx = mstream.movie_idx""", RATINGS, MOVIES, EVENTS, MOVIE_AGG, GENRED),
    "materialize_latest": sql(_latest(
        "event_timestamp BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-25'"), EVENTS, DAILY),
    "materialize_stream": sql(_latest(
        "event_timestamp BETWEEN TIMESTAMP '2024-01-24' AND TIMESTAMP '2024-01-25'"), EVENTS, DAILY),
    "materialize_ttl": sql(_latest(
        "event_timestamp BETWEEN TIMESTAMP '2024-01-01' AND TIMESTAMP '2024-01-30'",
        """user_idx, CASE WHEN event_timestamp >= TIMESTAMP '2024-01-29' THEN CAST(user_recent_activity AS DOUBLE) END
           AS user_recent_activity,
           CASE WHEN event_timestamp >= TIMESTAMP '2024-01-29' THEN user_last_genre END AS user_last_genre,
           strftime(event_timestamp, '%Y-%m-%d %H:%M:%S') AS event_timestamp"""), EVENTS, DAILY),
    "push_upsert": sql(_latest("TRUE"), EVENTS, DAILY),
    "asof_features": sql("""SELECT e.event_id, e.user_idx, strftime(e.ts, '%Y-%m-%d %H:%M:%S') AS ts,
        CASE WHEN fresh THEN last_value END AS last_value, CASE WHEN fresh THEN CAST(last_movie AS DOUBLE) END AS last_movie,
        CASE WHEN fresh THEN strftime(seen_at, '%Y-%m-%d %H:%M:%S') END AS seen_at
        FROM (SELECT e.*, f.ts AS seen_at, f."value" AS last_value, f.movie_idx AS last_movie,
                     e.ts - f.ts <= INTERVAL 24 HOUR AS fresh
              FROM (SELECT * FROM ev WHERE event_type NOT IN ('view', 'click')) e
              ASOF LEFT JOIN (SELECT * FROM ev WHERE event_type IN ('view', 'click')) f
              ON e.user_idx = f.user_idx AND e.ts >= f.ts) e""", EVENTS),
    "historical_features": sql(f"""SELECT o_orderkey, o_custkey AS user_idx,
        strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS event_timestamp,
        CASE WHEN fresh THEN round(CAST(CAST(user_avg_rating AS FLOAT) AS DOUBLE), 4) END AS user_avg_rating,
        CASE WHEN fresh THEN CAST(user_rating_count AS DOUBLE) END AS user_rating_count
        FROM (SELECT o.*, s.*, o.o_orderdate - s.at <= INTERVAL 365 DAY AS fresh FROM orders o
              ASOF LEFT JOIN snaps s ON o.o_custkey = s.user_idx AND o.o_orderdate >= s.at)""",
                               RATINGS, _SNAPSHOTS),
    "feature_view_stats": sql(" UNION ALL ".join(
        [f"""SELECT 'user_batch_features' AS "view", count(*) AS n_rows, count(DISTINCT uagg.user_idx) AS n_entities,
            '2002-01-01 00:00:00' AS newest, CAST(1 AS DOUBLE) AS stale_share, '{f}' AS feature,
            round(count(*) FILTER (WHERE {f} IS NULL) / CAST(count(*) AS DOUBLE), 6) AS null_share
            FROM uagg JOIN fav ON uagg.user_idx = fav.user_idx"""
         for f in ["user_avg_rating", "user_rating_std", "user_rating_count", "user_min_rating",
                   "user_max_rating", "user_rating_range", "user_days_active", "user_favorite_genre",
                   "user_favorite_genre_count", "user_favorite_genre_avg_rating"]]
        + [f"""SELECT 'user_stream_features' AS "view", count(*) AS n_rows, count(DISTINCT user_idx) AS n_entities,
            strftime(max(event_timestamp), '%Y-%m-%d %H:%M:%S') AS newest,
            round(count(*) FILTER (WHERE TIMESTAMP '2024-02-01' - event_timestamp > INTERVAL 24 HOUR)
                  / CAST(count(*) AS DOUBLE), 6) AS stale_share, '{f}' AS feature,
            round(count(*) FILTER (WHERE {f} IS NULL) / CAST(count(*) AS DOUBLE), 6) AS null_share FROM daily"""
           for f in ["user_recent_activity", "user_last_genre"]]),
        RATINGS, MOVIES, EVENTS, USER_AGG, AFFINITY, DAILY),
    "feature_freshness": sql(" UNION ALL ".join(
        f"""SELECT '{name}' AS "view", strftime(max(event_timestamp), '%Y-%m-%d %H:%M:%S') AS newest,
            (epoch_us(TIMESTAMP '2024-02-01') - epoch_us(max(event_timestamp))) / CAST(1000000 AS DOUBLE) AS age_s
            FROM {table}""" for name, table in (("user_stream_features", "ustream"),
                                                ("movie_stream_features", "mstream"))), EVENTS, GENRED),
}

ORACLES["user_feature_files"] = ORACLES["user_feature_view"]
