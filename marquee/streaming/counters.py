"""Running features of an event stream: activity, popularity, last genre.

Events carry event_id, user_idx, movie_idx, event_type, ts and, where known,
genres. Every function works on a stream and on a table alike.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import datetime

import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.functions.scalars import micros
from marquee.operators.monitor import spread_panes

# Event types that count as watching.
WATCHING = ["view", "click"]
LATENESS = "1 hour"


def _is_watching() -> Column:
    return F.col("event_type").isin(WATCHING)


def _last_genre() -> Column:
    """Genre of the newest event that names one."""
    named = F.when(F.col("genres").isNotNull(), F.struct("ts", "event_id"))
    return F.coalesce(F.max_by("genres", named), F.lit("Unknown"))


def user_activity(events: DataFrame) -> DataFrame:
    return events.groupBy("user_idx").agg(
        F.count("*").alias("user_recent_activity"), F.max("ts").alias("event_timestamp"))


def last_genre(events: DataFrame) -> DataFrame:
    return events.groupBy("user_idx").agg(
        _last_genre().alias("user_last_genre"), F.max("ts").alias("event_timestamp"))


def user_stream_features(events: DataFrame) -> DataFrame:
    return events.groupBy("user_idx").agg(
        F.count("*").alias("user_recent_activity"), _last_genre().alias("user_last_genre"),
        F.max("ts").alias("event_timestamp"))


def movie_stream_features(events: DataFrame, include_zero: bool = False) -> DataFrame:
    """Views and clicks per movie; ``include_zero`` keeps movies with other events only."""
    rows = events if include_zero else events.where(_is_watching())
    watched = F.count_if(_is_watching())
    return rows.groupBy("movie_idx").agg(
        watched.alias("movie_popularity"), watched.alias("movie_recent_views"),
        F.max("ts").alias("event_timestamp"))


def _by_entity(events: DataFrame) -> DataFrame:
    """Every event as a row ``_of`` its user and, for views and clicks, one of its movie."""
    movie = F.when(_is_watching(), F.struct(F.lit("movie").alias("entity"), F.col("movie_idx").alias("key")))
    user = F.struct(F.lit("user").alias("entity"), F.col("user_idx").alias("key"))
    return events.withColumn("_of", F.explode(F.array_compact(F.array(user, movie))))


def entity_features(events: DataFrame) -> DataFrame:
    """User and movie features in one aggregation, as rows of (entity, key).

    A stream needs one state store for both views this way. Movies get a row
    for views and clicks only.
    """
    return _by_entity(events).groupBy(F.col("_of.entity").alias("entity"), F.col("_of.key").alias("key")).agg(
        F.count("*").alias("n"), _last_genre().alias("last_genre"), F.max("ts").alias("event_timestamp"))


def user_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("entity") == "user").select(
        F.col("key").alias("user_idx"), F.col("n").alias("user_recent_activity"),
        F.col("last_genre").alias("user_last_genre"), "event_timestamp")


def movie_rows(features: DataFrame) -> DataFrame:
    return features.where(F.col("entity") == "movie").select(
        F.col("key").alias("movie_idx"), F.col("n").alias("movie_popularity"),
        F.col("n").alias("movie_recent_views"), "event_timestamp")


def activity_panes(events: DataFrame, slide: str, lateness: str = LATENESS) -> DataFrame:
    """Events per user and pane of one slide; old panes leave the state."""
    rows = events.withWatermark("ts", lateness) if events.isStreaming else events
    return rows.groupBy(F.window("ts", slide).alias("pane"), "user_idx").agg(
        F.count("*").alias("events")).select(
            F.col("pane.start").alias("window_start"), "user_idx", "events")


def sliding_activity(panes: DataFrame, window: str, slide: str) -> DataFrame:
    """Events per user in each sliding window, summed from its panes."""
    return spread_panes(panes, "window_start", window, slide).groupBy("window_start", "user_idx").agg(
        F.sum("events").alias("events"))


def feature_panes(events: DataFrame, slide: str, lateness: str = LATENESS) -> DataFrame:
    """All stream features per entity and pane of one slide; old panes leave the state."""
    rows = events.withWatermark("ts", lateness) if events.isStreaming else events
    newest = F.max(F.when(F.col("genres").isNotNull(), F.struct("ts", "event_id", "genres")))
    return _by_entity(rows).groupBy(F.window("ts", slide).alias("pane"), "_of").agg(
        F.count("*").alias("n"), newest.alias("newest")).select(
            F.col("pane.start").alias("window_start"), "_of.entity", "_of.key", "n", "newest")


def sliding_features(panes: DataFrame, window: str, slide: str) -> DataFrame:
    """Activity, popularity, recent views and last genre in each sliding window, from its panes.

    ``n`` is a user's activity, or a movie's popularity and recent views.
    """
    spread = spread_panes(panes, "window_start", window, slide)
    return spread.groupBy("window_start", "entity", "key").agg(
        F.sum("n").alias("n"), F.coalesce(F.max("newest")["genres"], F.lit("Unknown")).alias("last_genre"))


def window_features(panes: DataFrame, window: str, slide: str, as_of: datetime | None = None) -> DataFrame:
    """Features over the one ``window`` that ends with the pane of ``as_of``, or with the newest pane.

    Columns as ``entity_features`` gives them. The time of a row is that of its last pane's end.
    """
    width, length = micros(pd.Timedelta(slide)), micros(pd.Timedelta(window))
    start = F.unix_micros("window_start")
    newest = (F.unix_micros(panes.agg(F.max("window_start")).scalar()) if as_of is None else
              F.floor(F.unix_micros(F.lit(as_of)) / width) * width)
    own = panes.where((start > newest - length) & (start <= newest))
    return own.groupBy("entity", "key").agg(
        F.sum("n").alias("n"), F.coalesce(F.max("newest")["genres"], F.lit("Unknown")).alias("last_genre"),
        F.timestamp_micros(F.unix_micros(F.max("window_start")) + width).alias("event_timestamp"))


def event_types(events: DataFrame) -> DataFrame:
    return events.groupBy("event_type").agg(F.count("*").alias("events"))


def totals(users: DataFrame, movies: DataFrame) -> DataFrame:
    """Active users and movies and their summed counters."""
    by_user = users.agg(F.count("*").alias("active_users"),
                        F.sum("user_recent_activity").alias("total_user_events"))
    by_movie = movies.agg(F.count_if(F.col("movie_popularity") > 0).alias("active_movies"),
                          F.sum("movie_popularity").alias("total_movie_views"))
    return by_user.select(
        "active_users", by_movie.select("active_movies").scalar().alias("active_movies"),
        "total_user_events", by_movie.select("total_movie_views").scalar().alias("total_movie_views"))


def recent_events(events: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` events, newest first."""
    return events.orderBy(F.desc("ts"), F.desc("event_id")).limit(n)


def batch_summary(batch: DataFrame, last: int = 3) -> DataFrame:
    """One row about a micro-batch: sizes, events per type, the last few events."""
    per_type = batch.groupBy("event_type").agg(F.count("*").alias("n"))
    users = batch.select("user_idx").distinct().agg(F.count("*")).scalar()
    movies = batch.where(_is_watching()).select("movie_idx").distinct().agg(F.count("*")).scalar()
    newest = recent_events(batch, last).agg(F.collect_list(
        F.struct("ts", "user_idx", "event_type", "movie_idx")))
    # At most one entry per event type and ``last`` events.
    return per_type.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("events"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n")))).alias("per_type"),
    ).select("events", "per_type", users.alias("active_users"), movies.alias("popular_movies"),
             newest.scalar().alias("last_events"))


def batch_metrics(events: DataFrame, name: str = "summary") -> DataFrame:
    """``events``, counted as they pass: rows, watched ones and the newest time, whatever is done with them.

    On a stream each micro-batch's figures come with its progress under
    ``name``; nothing is read twice.
    """
    return events.observe(name, F.count("*").alias("events"), F.count_if(_is_watching()).alias("watched"),
                          F.unix_micros(F.max("ts")).alias("newest_us"))


def with_totals(summary: DataFrame, before: DataFrame | None) -> DataFrame:
    """A micro-batch's summary row, with its number ``batch``, and the events and events per type since the start.

    ``before`` is the row of the micro-batch before, if there was one.
    """
    if before is None:
        return summary.withColumns({"total_events": F.col("events"), "total_per_type": F.col("per_type")})

    def both(_, a: Column, b: Column) -> Column:
        return F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))

    earlier = before.select((F.col("batch") + 1).alias("batch"), F.col("total_events").alias("_events"),
                            F.col("total_per_type").alias("_per_type"))
    sums = F.map_zip_with("per_type", "_per_type", both)
    return summary.join(earlier, "batch").withColumns({
        "total_events": F.col("events") + F.col("_events"),
        "total_per_type": F.map_from_entries(F.array_sort(F.map_entries(sums)))}).drop("_events", "_per_type")


def _collapsed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of an id's copies in a batch the newest, so none that is late stands for one in time, and one without a time."""
    for batch in batches:
        order = pa.compute.sort_indices(batch["ts"], sort_keys=[("", "descending")])
        copies = pa.table({"id": batch["event_id"].take(order), "timed": batch["ts"].is_valid().take(order), "at": order})
        first = copies.group_by(["id", "timed"], use_threads=False).aggregate([("at", "first")])["at_first"]
        yield batch.take(first.combine_chunks().sort())


def deduplicated(events: DataFrame, lateness: str = LATENESS, spread: int = 1, collapse: bool = True) -> DataFrame:
    """Drop repeats of an event id, within the watermark on a stream.

    A table collapses copies before its shuffle. So does a stream, in each batch
    of rows a task reads and without state, unless ``collapse`` is off, as it
    must be to count late rows. With ``spread``, copies of one id are also
    dropped in so many groups first; that takes another shuffle and as much
    state again.
    """
    if not events.isStreaming:
        return events.dropDuplicates(["event_id"])
    rows = events.mapInArrow(_collapsed, events.schema) if collapse else events
    rows = rows.withWatermark("ts", lateness)
    if spread > 1:
        rows = (rows.withColumn("_group", F.spark_partition_id() % spread)
                .dropDuplicatesWithinWatermark(["event_id", "_group"]).drop("_group"))
    return rows.dropDuplicatesWithinWatermark(["event_id"])


def session_rows(events: DataFrame, gap: str = "30 minutes", key: str = "user_idx",
                 lateness: str | None = LATENESS) -> DataFrame:
    """Runs of a key's events with no pause longer than ``gap``, from merging session state.

    On a stream in append mode a session comes out once the watermark is past
    its end, and then its state goes; events without a key are one group. With
    a ``lateness`` of None the stream already has a watermark.
    """
    rows = events.withWatermark("ts", lateness) if events.isStreaming and lateness else events
    return rows.groupBy(F.session_window("ts", gap).alias("session"), key).agg(F.count("*").alias("events")).select(
        key, F.col("session.start").alias("session_start"), F.col("session.end").alias("session_end"), "events")


def session_panes(events: DataFrame, gap: str = "30 minutes", key: str = "user_idx",
                  lateness: str = LATENESS) -> DataFrame:
    """Per key and stretch of one ``gap``: events, first and last time.

    Events in one stretch are closer than the gap, so they share a session and
    can be counted before anything is shuffled, however many a key has.
    """
    rows = events.withWatermark("ts", lateness) if events.isStreaming else events
    return rows.groupBy(F.window("ts", gap).alias("pane"), key).agg(
        F.count("*").alias("events"), F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts")).select(
            key, F.col("pane.start").alias("pane_start"), "events", "first_ts", "last_ts")


def sessions(panes: DataFrame, gap: str = "30 minutes", key: str = "user_idx") -> DataFrame:
    """Runs of a key's events with no pause longer than ``gap``, from their panes."""
    in_order = Window.partitionBy(key).orderBy("first_ts")
    pause = F.unix_micros("first_ts") - F.unix_micros(F.lag("last_ts").over(in_order))
    opens = F.when(pause <= micros(pd.Timedelta(gap)), 0).otherwise(1)
    numbered = panes.withColumn("_opens", opens).withColumn("_session", F.sum("_opens").over(in_order))
    end = F.timestamp_micros(F.unix_micros(F.max("last_ts")) + micros(pd.Timedelta(gap)))
    return numbered.groupBy(key, "_session").agg(
        F.min("first_ts").alias("session_start"), end.alias("session_end"),
        F.sum("events").alias("events")).drop("_session")
