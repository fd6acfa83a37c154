"""Streaming queries from events to feature tables."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from marquee.functions.scalars import micros
from marquee.operators.validate import EVENT_TYPES, good_and_bad, validate_events
from marquee.sources import kafka
from marquee.streaming.arrivals import KeyIndex
from marquee.streaming.counters import (
    LATENESS, batch_metrics, batch_summary, entity_features, feature_panes, movie_rows, user_rows, window_features,
    with_totals)
from marquee.streaming.sinks import BatchTable, KeyedTable, start

# How long an event counts for the features that a stream keeps.
FEATURE_WINDOW, FEATURE_SLIDE = "24 hours", "1 hour"


class WindowedFeatures:
    """Stream features over the last ``window``, from the panes that a query keeps."""

    def __init__(self, panes: KeyedTable, window: str, slide: str):
        self.panes, self.window, self.slide = panes, window, slide

    def _read(self, as_of: datetime | None) -> DataFrame:
        return window_features(self.panes.read(), self.window, self.slide, as_of)

    def users(self, as_of: datetime | None = None) -> DataFrame:
        """As of the end of the pane that holds ``as_of``, or of the newest one."""
        return user_rows(self._read(as_of))

    def movies(self, as_of: datetime | None = None) -> DataFrame:
        return movie_rows(self._read(as_of))


def keep_features(events: DataFrame, path: str, window: str = FEATURE_WINDOW, slide: str = FEATURE_SLIDE,
                  lateness: str = LATENESS, checkpoint: str | None = None, every: str | None = None
                  ) -> tuple[StreamingQuery, WindowedFeatures]:
    """Keep the features of users and movies over the last ``window``: what a job should run.

    The state holds panes of one ``slide`` and drops those that the watermark
    has passed, so it does not grow with the stream. The table of panes drops
    those that no window from the newest one on needs whenever it compacts
    itself. ``update_features`` counts since the start instead, and never
    forgets a key.
    """
    length = micros(pd.Timedelta(window))

    def recent(panes: DataFrame) -> DataFrame:
        newest = panes.agg(F.max("window_start")).scalar()
        return panes.where(F.unix_micros("window_start") > F.unix_micros(newest) - length)

    panes = KeyedTable(events.sparkSession, f"{path}/feature_panes", ["window_start", "entity", "key"], keep=recent)
    query = start(feature_panes(events, slide, lateness), panes.write, "update", checkpoint, every)
    return query, WindowedFeatures(panes, window, slide)


def update_features(events: DataFrame, path: str, checkpoint: str | None = None,
                    every: str | None = None) -> tuple[StreamingQuery, KeyedTable, KeyedTable]:
    """Keep both stream views current: one state store, two tables written per batch.

    Returns the query and the user and movie tables.
    """
    spark = events.sparkSession
    users = KeyedTable(spark, f"{path}/user_stream_features", ["user_idx"])
    movies = KeyedTable(spark, f"{path}/movie_stream_features", ["movie_idx"])

    def write(changed: DataFrame, batch_id: int) -> None:
        changed = changed.persist()
        users.write(user_rows(changed), batch_id)
        movies.write(movie_rows(changed), batch_id)
        changed.unpersist()

    return start(entity_features(events), write, "update", checkpoint, every), users, movies


def keep_summaries(events: DataFrame, path: str, last: int = 3, checkpoint: str | None = None,
                   every: str | None = None) -> tuple[StreamingQuery, BatchTable]:
    """One row per micro-batch: its summary, and the totals since the start.

    Totals go on from the one row that the micro-batch before has written, so a
    replay gives the same. Plain counts also come with the query's progress
    (``batch_metrics``), without another pass.
    """
    spark = events.sparkSession
    table = BatchTable(spark, f"{path}/summaries")

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        summary = batch_summary(kept, last).withColumn("batch", F.lit(batch_id).cast("long"))
        table.write(with_totals(summary, table.read_batch(batch_id - 1) if batch_id else None), batch_id)
        kept.unpersist()

    return start(batch_metrics(events), write, "append", checkpoint, every), table


def check_arrivals(rows: DataFrame, path: str, keys: Sequence[str], bucket: Column | None = None,
                   checkpoint: str | None = None, every: str | None = None) -> tuple[StreamingQuery, KeyIndex]:
    """Check each micro-batch's keys against all rows that came before it."""
    index = KeyIndex(rows.sparkSession, path, keys, bucket)
    return start(rows, index.write, "append", checkpoint, every), index


def split_messages(messages: DataFrame, path: str, now: float | None = None,
                   allowed_types: Sequence[str] = EVENT_TYPES, checkpoint: str | None = None,
                   every: str | None = None) -> tuple[StreamingQuery, BatchTable, BatchTable]:
    """Raw messages of a topic to valid events and to rejected ones: ``value, errors``.

    Messages that hold no event are rejected too, with that as their error, so
    every message that came in is in one of the two tables.
    """
    spark = messages.sparkSession
    good_table, bad_table = BatchTable(spark, f"{path}/valid"), BatchTable(spark, f"{path}/rejected")
    clock = F.unix_micros(F.current_timestamp()) / 1_000_000 if now is None else now

    def write(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        checked = validate_events(kafka.service_form(kafka.decode(kept, keep_value=True)), clock,
                                  allowed_types).persist()
        good, bad = good_and_bad(checked)
        unread = kafka.malformed(kept).withColumn("errors", F.array(F.lit(kafka.NO_EVENT)))
        good_table.write(good.drop("value"), batch_id)
        bad_table.write(bad.select("value", "errors").unionByName(unread), batch_id)
        checked.unpersist()
        kept.unpersist()

    return start(messages, write, "append", checkpoint, every), good_table, bad_table


def split_valid(events: DataFrame, path: str, now: float | None = None,
                allowed_types: Sequence[str] = EVENT_TYPES, checkpoint: str | None = None,
                every: str | None = None) -> tuple[StreamingQuery, BatchTable, BatchTable]:
    """Validated events to one table, broken ones with their errors to another.

    ``now`` fixes the clock for replays; a live stream uses each batch's time.
    """
    spark = events.sparkSession
    good_table, bad_table = BatchTable(spark, f"{path}/valid"), BatchTable(spark, f"{path}/rejected")
    clock = F.unix_micros(F.current_timestamp()) / 1_000_000 if now is None else now

    def write(batch: DataFrame, batch_id: int) -> None:
        checked = validate_events(batch, clock, allowed_types).persist()
        good, bad = good_and_bad(checked)
        good_table.write(good, batch_id)
        bad_table.write(bad, batch_id)
        checked.unpersist()

    return start(events, write, "append", checkpoint, every), good_table, bad_table
