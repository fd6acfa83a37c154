"""Registered queries: cleaning, profiling, splitting, interactions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators import clean, profile, split
from marquee.operators.ordering import file_positions
from marquee.plans.common import MOVIES, RATINGS, Query, rounded, sql, time_texts
from marquee.session import durable, scratch_path
from marquee.sources import files, proxies

LEAST = 30

KEPT = f"""active AS (SELECT user_idx FROM ratings GROUP BY 1 HAVING count(*) >= {LEAST}),
mine AS (SELECT * FROM ratings WHERE user_idx IN (SELECT user_idx FROM active)),
popular AS (SELECT movie_idx FROM mine GROUP BY 1 HAVING count(*) >= {LEAST}),
kept AS (SELECT * FROM mine WHERE movie_idx IN (SELECT movie_idx FROM popular)),
users AS (SELECT u AS "userId", row_number() OVER (ORDER BY u) - 1 AS user_idx
          FROM (SELECT DISTINCT user_idx AS u FROM kept)),
items AS (SELECT m AS "movieId", row_number() OVER (ORDER BY m) - 1 AS movie_idx
          FROM (SELECT DISTINCT movie_idx AS m FROM kept))"""

PARTS = """placed AS (
  SELECT *, row_number() OVER (ORDER BY "timestamp", user_idx, movie_idx, rating) AS place,
         count(*) OVER () AS n FROM ratings),
parts AS (SELECT user_idx, movie_idx, rating, "timestamp",
                 CASE WHEN place <= floor(CAST(0.8 AS DOUBLE) * n) THEN 'train' ELSE 'test' END AS part
          FROM placed),
train AS (SELECT * FROM parts WHERE part = 'train'),
test AS (SELECT * FROM parts WHERE part = 'test')"""


def _kept(spark: SparkSession, folder: str) -> DataFrame:
    return clean.filter_min_interactions(proxies.raw_ratings(spark, folder), LEAST, LEAST)


def _cleaned(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    kept = durable(_kept(spark, folder), "kept")
    return kept, clean.dense_ids(kept, "userId", "user_idx"), clean.dense_ids(kept, "movieId", "movie_idx")


def clean_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return clean.apply_id_maps(*_cleaned(spark, folder))


def clean_movies(spark: SparkSession, folder: str) -> DataFrame:
    items = clean.dense_ids(_kept(spark, folder), "movieId", "movie_idx")
    return clean.clean_movies(proxies.raw_movies(spark, folder), items)


def rated_movies(spark: SparkSession, folder: str) -> DataFrame:
    return clean.rated_movies(proxies.raw_movies(spark, folder), proxies.raw_ratings(spark, folder))


def dense_user_ids(spark: SparkSession, folder: str) -> DataFrame:
    return clean.id_map(clean.dense_ids(_kept(spark, folder), "userId", "user_idx"), "userId", "user_idx")


def dense_movie_ids(spark: SparkSession, folder: str) -> DataFrame:
    return clean.id_map(clean.dense_ids(_kept(spark, folder), "movieId", "movie_idx"), "movieId", "movie_idx")


def dense_ids_first_seen(spark: SparkSession, folder: str) -> DataFrame:
    return clean.dense_ids(proxies.raw_ratings(spark, folder), "userId", "user_idx", "timestamp")


def table_shape(spark: SparkSession, folder: str) -> DataFrame:
    return profile.shape(proxies.raw_ratings(spark, folder))


def null_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.null_counts(proxies.raw_ratings(spark, folder))


def duplicate_rows(spark: SparkSession, folder: str) -> DataFrame:
    return profile.duplicate_rows(proxies.raw_ratings(spark, folder))


def distinct_counts(spark: SparkSession, folder: str) -> DataFrame:
    return profile.distinct_counts(proxies.raw_ratings(spark, folder), ["userId", "movieId", "rating"])


def describe_ratings(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.describe(proxies.raw_ratings(spark, folder)), 6)


def rating_histogram(spark: SparkSession, folder: str) -> DataFrame:
    return profile.histogram(proxies.raw_ratings(spark, folder))


def ratings_per_user(spark: SparkSession, folder: str) -> DataFrame:
    return profile.value_counts(proxies.raw_ratings(spark, folder), "userId")


def top_genres(spark: SparkSession, folder: str) -> DataFrame:
    return profile.top_values(proxies.raw_movies(spark, folder), "genres")


def sparsity(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(profile.sparsity(proxies.raw_ratings(spark, folder), "userId", "movieId"))


def _split(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    return split.chronological_split(proxies.ratings(spark, folder))


def chrono_split(spark: SparkSession, folder: str) -> DataFrame:
    return split.labelled_split(proxies.ratings(spark, folder))


def ratings_by_time(spark: SparkSession, folder: str) -> DataFrame:
    """Every rating with its place in files written in the order of time."""
    written = durable(split.sorted_by_time(proxies.ratings(spark, folder)), "by_time")
    return file_positions(written, "place")


def ratings_csv(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings written as CSV and read back."""
    path = scratch_path(spark, "csv")
    files.write_csv(proxies.raw_ratings(spark, folder), path)
    return files.read_ratings(spark, path)


def movies_csv(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "csv")
    files.write_csv(proxies.raw_movies(spark, folder), path)
    return files.read_movies(spark, path)


def split_ranges(spark: SparkSession, folder: str) -> DataFrame:
    ranges = split.split_ranges(split.labelled_split(proxies.ratings(spark, folder)))
    return time_texts(rounded(ranges), "first_time", "last_time")


def known_test_rows(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(spark, folder)
    return split.restrict_to_known(test, train)


def interactions(spark: SparkSession, folder: str) -> DataFrame:
    return split.interactions(_split(spark, folder)[0])


def interaction_shape(spark: SparkSession, folder: str) -> DataFrame:
    train, test = _split(spark, folder)
    return split.interaction_shape(train, split.restrict_to_known(test, train))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    clean_ratings, clean_movies, rated_movies, dense_user_ids, dense_movie_ids, dense_ids_first_seen,
    table_shape, null_counts, duplicate_rows, distinct_counts, describe_ratings, rating_histogram,
    ratings_per_user, top_genres, sparsity, chrono_split, ratings_by_time, ratings_csv, movies_csv, split_ranges, known_test_rows,
    interactions, interaction_shape)}

_COLUMNS = [("userId", "user_idx", "bigint"), ("movieId", "movie_idx", "bigint"),
            ("rating", "rating", "double"), ("timestamp", '"timestamp"', "bigint")]

ORACLES: dict[str, str] = {
    "clean_ratings": sql("""SELECT k.user_idx AS "userId", k.movie_idx AS "movieId", rating, "timestamp",
        u.user_idx AS user_idx, i.movie_idx AS movie_idx
        FROM kept k JOIN users u ON k.user_idx = u."userId" JOIN items i ON k.movie_idx = i."movieId" """,
                         RATINGS, KEPT),
    "clean_movies": sql("""SELECT m."movieId", title, genres, i.movie_idx AS movie_idx
        FROM movies m JOIN items i ON m."movieId" = i."movieId" """, RATINGS, MOVIES, KEPT),
    "rated_movies": sql("""SELECT "movieId", title, genres FROM movies
        WHERE movie_idx IN (SELECT movie_idx FROM ratings)""", RATINGS, MOVIES),
    "dense_user_ids": sql('SELECT "userId" AS "original_userId", user_idx FROM users', RATINGS, KEPT),
    "dense_movie_ids": sql('SELECT "movieId" AS "original_movieId", movie_idx FROM items', RATINGS, KEPT),
    "dense_ids_first_seen": sql("""SELECT u AS "userId", row_number() OVER (ORDER BY f, u) - 1 AS user_idx
        FROM (SELECT user_idx AS u, min("timestamp") AS f FROM ratings GROUP BY 1)""", RATINGS),
    "table_shape": sql("SELECT count(*) AS n_rows, 4 AS n_columns FROM ratings", RATINGS),
    "null_counts": sql(" UNION ALL ".join(
        f"""SELECT '{name}' AS "column", '{kind}' AS "type", count({column}) AS non_null,
            count(*) - count({column}) AS nulls FROM ratings""" for name, column, kind in _COLUMNS), RATINGS),
    "duplicate_rows": sql("""SELECT (SELECT count(*) FROM ratings) -
        (SELECT count(*) FROM (SELECT DISTINCT * FROM ratings)) AS duplicates""", RATINGS),
    "distinct_counts": sql(" UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count(DISTINCT {column}) AS n_distinct FROM ratings"""
        for name, column, _ in _COLUMNS[:3]), RATINGS),
    "describe_ratings": sql(" UNION ALL ".join(
        f"""SELECT '{name}' AS "column", count({column}) AS "count", round(avg({column}), 6) AS mean,
            round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS "min",
            round(quantile_cont({column}, 0.25), 6) AS q25, round(quantile_cont({column}, 0.5), 6) AS q50,
            round(quantile_cont({column}, 0.75), 6) AS q75, CAST(max({column}) AS DOUBLE) AS "max"
            FROM ratings""" for name, column, _ in _COLUMNS), RATINGS),
    "rating_histogram": sql("SELECT rating, count(*) AS n FROM ratings GROUP BY 1", RATINGS),
    "ratings_per_user": sql('SELECT user_idx AS "userId", count(*) AS n FROM ratings GROUP BY 1', RATINGS),
    "top_genres": sql("SELECT genres, count(*) AS n FROM movies GROUP BY 1 ORDER BY n DESC, genres LIMIT 10",
                      MOVIES),
    "sparsity": sql("""SELECT count(*) AS n_ratings, count(DISTINCT user_idx) AS n_users,
        count(DISTINCT movie_idx) AS n_items,
        round(1 - count(*) / (CAST(count(DISTINCT user_idx) AS DOUBLE) * count(DISTINCT movie_idx)), 6) AS sparsity
        FROM ratings""", RATINGS),
    "chrono_split": sql("SELECT * FROM parts", RATINGS, PARTS),
    "ratings_by_time": sql("""SELECT *, row_number() OVER (ORDER BY "timestamp", user_idx, movie_idx, rating) - 1
        AS place FROM ratings""", RATINGS),
    "ratings_csv": sql("""SELECT user_idx AS "userId", movie_idx AS "movieId", rating, "timestamp" FROM ratings""",
                       RATINGS),
    "movies_csv": sql('SELECT "movieId", title, genres FROM movies', MOVIES),
    "split_ranges": sql("""SELECT part, count(*) AS n_rows,
        round(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM parts), 6) AS share,
        strftime(to_timestamp(min("timestamp")) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS first_time,
        strftime(to_timestamp(max("timestamp")) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M:%S') AS last_time
        FROM parts GROUP BY part""", RATINGS, PARTS),
    "known_test_rows": sql("""SELECT user_idx, movie_idx, rating, "timestamp" FROM test
        WHERE user_idx IN (SELECT user_idx FROM train) AND movie_idx IN (SELECT movie_idx FROM train)""",
                           RATINGS, PARTS),
    "interactions": sql("""SELECT user_idx, movie_idx, sum(rating) AS weight, count(*) AS n_ratings
        FROM train GROUP BY 1, 2""", RATINGS, PARTS),
    "interaction_shape": sql("""SELECT (SELECT count(DISTINCT user_idx) FROM train) AS n_users,
        (SELECT count(DISTINCT movie_idx) FROM train) AS n_items, count(*) AS nnz,
        count(DISTINCT (user_idx, movie_idx)) AS n_pairs FROM test
        WHERE user_idx IN (SELECT user_idx FROM train) AND movie_idx IN (SELECT movie_idx FROM train)""",
                             RATINGS, PARTS),
}
