"""Alerts over a stream of requests: states per window, and what changes as they last."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from marquee.operators.monitor import alert_frames, seconds
from marquee.streaming.counters import LATENESS

PENDING, FIRING, RESOLVED, CLEARED = "pending", "firing", "resolved", "cleared"
NONE = -1


class _Alert(StatefulProcessor):
    """Per panel: when its red windows began, when the alert is due, and whether it fires."""

    def __init__(self, hold_ms: int):
        self.hold = hold_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.run = handle.getValueState("run", "since long, firing boolean")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        since, firing = self.run.get() if self.run.exists() else (NONE, False)
        began, changes = since, []
        for at, state in pd.concat(rows).sort_values("at")[["at", "state"]].itertuples(index=False):
            due = since + self.hold
            if since != NONE and not firing and at > due:
                changes.append((FIRING, due, since))
                firing = True
            if state == "red" and since == NONE:
                since, firing = at, False
                changes.append((PENDING, at, since))
            elif state != "red" and since != NONE:
                changes.append((RESOLVED if firing else CLEARED, at, since))
                since, firing = NONE, False
        if began != NONE:
            self.handle.deleteTimer(began + self.hold)
        if since == NONE:
            self.run.clear()
        else:
            self.run.update((int(since), bool(firing)))
            if not firing:
                self.handle.registerTimer(int(since + self.hold))
        if changes:
            yield self._rows(key, changes)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """No window said otherwise until the watermark was past the time the alert was due."""
        if self.run.exists():
            since, firing = self.run.get()
            if not firing and since + self.hold == expiredTimerInfo.getExpiryTimeInMs():
                self.run.update((since, True))
                yield self._rows(key, [(FIRING, since + self.hold, since)])

    def _rows(self, key, changes: list[tuple[str, int, int]]) -> pd.DataFrame:
        made = pd.DataFrame(changes, columns=["change", "at", "since"]).astype({"at": "int64", "since": "int64"})
        made.insert(0, "panel", key[0])
        return made

    def close(self) -> None:
        pass


def window_states(log: DataFrame, window: str = "5 minutes", endpoint: str | None = None,
                  lateness: str | None = LATENESS) -> DataFrame:
    """``monitor.alert_state`` of a stream: in append mode a window's row comes once the watermark is past it.

    A fixed number of counters per open window is held. With a ``lateness`` of
    None the stream already has a watermark.
    """
    return alert_frames(log.withWatermark("ts", lateness) if lateness else log, window, endpoint)


def alert_changes(log: DataFrame, hold: str, window: str = "5 minutes", endpoint: str | None = None,
                  lateness: str | None = LATENESS) -> DataFrame:
    """What happens to the alert of each panel: rows ``panel, change, at, since``; append mode, RocksDB state.

    A panel's first red window makes its alert pending at the window's end, and
    ``since`` is that time. It fires ``hold`` later, unless a window that ends
    by then is yellow or green, which clears it; such a window afterwards
    resolves it. A timer fires it when no window comes at all, and a window
    without a state (no latency) changes nothing. One row per closed window and
    panel reaches the state, so a panel is no hot key, whatever the requests.
    """
    states = window_states(log, window, endpoint, lateness)
    panels = F.explode(F.array(
        F.struct(F.lit("latency").alias("panel"), F.col("latency_state").alias("state")),
        F.struct(F.lit("success").alias("panel"), F.col("success_state").alias("state"))))
    read = states.withColumn("_panel", panels).where(F.col("_panel.state").isNotNull()).select(
        F.col("_panel.panel").alias("panel"), F.col("_panel.state").alias("state"),
        F.unix_millis(F.col("frame.end")).alias("at"), F.window_time("frame").alias("closed"))
    made = read.groupBy("panel").transformWithStateInPandas(
        _Alert(round(seconds(hold) * 1000)), "panel string, change string, at long, since long", "Append", "EventTime")
    return made.select("panel", "change", F.timestamp_millis("at").alias("at"),
                       F.timestamp_millis("since").alias("since"))
