"""Declared table schemas; nothing is inferred from files."""

from pyspark.sql import types as T

RAW_RATINGS = T.StructType([
    T.StructField("userId", T.LongType()),
    T.StructField("movieId", T.LongType()),
    T.StructField("rating", T.DoubleType()),
    T.StructField("timestamp", T.LongType()),
])

RAW_MOVIES = T.StructType([
    T.StructField("movieId", T.LongType()),
    T.StructField("title", T.StringType()),
    T.StructField("genres", T.StringType()),
])

CLEAN_RATINGS = T.StructType(RAW_RATINGS.fields + [
    T.StructField("user_idx", T.LongType()),
    T.StructField("movie_idx", T.LongType()),
])

CLEAN_MOVIES = T.StructType(RAW_MOVIES.fields + [
    T.StructField("movie_idx", T.LongType()),
])

# JSON events as produced: ISO timestamps, a rating only on rating events.
PRODUCED_EVENT = T.StructType([
    T.StructField("event_id", T.StringType()),
    T.StructField("user_idx", T.LongType()),
    T.StructField("movie_idx", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.StringType()),
    T.StructField("session_id", T.StringType()),
    T.StructField("rating", T.DoubleType()),
])

# Events handed to a service: epoch seconds, genres and rating optional.
SERVICE_EVENT = T.StructType([
    T.StructField("user_idx", T.LongType()),
    T.StructField("movie_idx", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("timestamp", T.DoubleType()),
    T.StructField("genres", T.StringType()),
    T.StructField("rating", T.DoubleType()),
])

REQUEST_LOG = T.StructType([
    T.StructField("ts", T.TimestampType()),
    T.StructField("endpoint", T.StringType()),
    T.StructField("status", T.IntegerType()),
    T.StructField("latency_s", T.DoubleType()),
    T.StructField("user_idx", T.LongType()),
])
