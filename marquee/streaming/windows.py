"""Count windows: every ``size`` events of a key make one window."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from marquee.operators.ordering import numbered
from marquee.sources.files import MissingTable
from marquee.streaming.counters import WATCHING
from marquee.streaming.sinks import BatchTable, KeyedTable


def _window_rows(placed: DataFrame, key: str, nth: Column, size: int) -> DataFrame:
    return placed.groupBy(key, F.floor((nth - 1) / size).alias("window_no")).agg(
        F.count("*").alias("events"),
        F.count_if(F.col("event_type").isin(WATCHING)).alias("watched"),
        F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"))


def count_windows(events: DataFrame, key: str, size: int) -> DataFrame:
    """Windows of a table, events in order of (ts, event_id); those without a key are one group."""
    return _window_rows(numbered(events, [key], ["ts", "event_id"], "_nth"), key, F.col("_nth"), size)


class CountWindows:
    """The same over a stream: later micro-batches continue each key's count.

    Within a micro-batch events are numbered across range partitions, so a hot
    key does not run through one task. A replayed batch continues from the
    counts before it.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, size: int):
        self.key, self.size = key, size
        self.counts = KeyedTable(spark, f"{path}/counts", [key])
        self.parts = BatchTable(spark, f"{path}/windows")

    def write(self, batch: DataFrame, batch_id: int) -> None:
        placed = numbered(batch, [self.key], ["ts", "event_id"], "_nth")
        grown = placed.groupBy(self.key).agg(F.count("*").alias("_new"))
        try:
            prior = self.counts.read(before=batch_id) if batch_id > 0 else None
        except MissingTable:
            prior = None
        if prior is None:
            totals = grown.withColumn("seen", F.col("_new"))
        else:
            # Events without a key are counted as one group.
            prior = prior.withColumnRenamed(self.key, "_key")
            totals = grown.join(prior, F.col(self.key).eqNullSafe(F.col("_key")), "left").withColumn(
                "seen", F.coalesce("seen", F.lit(0)) + F.col("_new"))
        before = totals.select(F.col(self.key).alias("_key"), (F.col("seen") - F.col("_new")).alias("_before"))
        placed = placed.join(before, F.col(self.key).eqNullSafe(F.col("_key")))
        nth = F.col("_before") + F.col("_nth")
        self.parts.write(_window_rows(placed, self.key, nth, self.size), batch_id)
        self.counts.write(totals.select(self.key, "seen"), batch_id)

    def read(self) -> DataFrame:
        """Windows with the parts of all micro-batches put together."""
        return self.parts.read().groupBy(self.key, "window_no").agg(
            F.sum("events").alias("events"), F.sum("watched").alias("watched"),
            F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"))


class _OpenWindow(StatefulProcessor):
    """Per key: how many events came so far, and the window they have not filled yet."""

    STATE = "seen long, events long, watched long, first_us long, last_us long"

    def __init__(self, key: str, size: int):
        self.key, self.size = key, size

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.open = handle.getValueState("open", self.STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timers) -> Iterator[pd.DataFrame]:
        seen, events, watched, first, last = self.open.get() if self.open.exists() else (0, 0, 0, None, None)
        batch = pd.concat(rows).sort_values(["us", "event_id"])
        batch["window_no"] = (seen + pd.RangeIndex(len(batch))) // self.size
        found = batch.groupby("window_no").agg(
            events=("us", "size"), watched=("watched", "sum"), first_us=("us", "min"), last_us=("us", "max"))
        if events % self.size:
            # The first one goes on with what the window had before.
            at = found.index[0]
            found.loc[at, ["events", "watched"]] += [events, watched]
            found.loc[at, "first_us"] = min(first, found.loc[at, "first_us"])
            found.loc[at, "last_us"] = max(last, found.loc[at, "last_us"])
        end = [int(v) for v in found.iloc[-1][["events", "watched", "first_us", "last_us"]]]
        self.open.update((int(seen + len(batch)), *end))
        found = found.reset_index().astype("int64")
        found.insert(0, self.key, pd.Series([None if pd.isna(key[0]) else key[0]] * len(found), dtype=object))
        yield found

    def close(self) -> None:
        pass


def keyed_count_windows(events: DataFrame, key: str, size: int) -> DataFrame:
    """Count windows of a stream from keyed state; needs ``sinks.rocksdb_state`` and update mode.

    Each micro-batch gives the windows it touched, the last one of a key as far
    as it is filled, so a table keyed by ``key`` and ``window_no`` holds all. The
    state is one small row per key, and no table is read. Events are in order
    within a micro-batch, and those without a key are one group. A task holds a
    key's events of one micro-batch, which the intake limit of the source
    bounds; ``CountWindows`` spreads those of one key over tasks.
    """
    kind = dict(events.dtypes)[key]
    read = events.select(key, "event_id", F.unix_micros("ts").alias("us"),
                         F.coalesce(F.col("event_type").isin(WATCHING), F.lit(False)).cast("long").alias("watched"))
    made = read.groupBy(key).transformWithStateInPandas(
        _OpenWindow(key, size), f"{key} {kind}, window_no long, events long, watched long, first_us long, last_us long",
        "Update", "None")
    return made.select(key, "window_no", "events", "watched", F.timestamp_micros("first_us").alias("first_ts"),
                       F.timestamp_micros("last_us").alias("last_ts"))
