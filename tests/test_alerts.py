"""Alerts from a stream of requests, beside a slow walk over the windows."""

from datetime import datetime, timedelta, timezone

import pytest

from marquee.operators import monitor
from marquee.session import scratch_path
from marquee.streaming import alerts, sinks

DAY = datetime(2024, 5, 1, tzinfo=timezone.utc)
SCHEMA = "ts timestamp, endpoint string, status int, latency_s double"
# Per minute the statuses and latencies of its requests; minutes that are not named have none.
RED, GREEN, SLOW = [(500, 0.02), (200, 0.02)], [(200, 0.02)] * 3, [(200, 0.9)] * 4


def minutes(*runs):
    """(first minute, how many, requests) to rows of the log."""
    return [(DAY + timedelta(minutes=first + k, seconds=5 * n), "rec", status, latency)
            for first, many, requests in runs for k in range(many) for n, (status, latency) in enumerate(requests)]


def walk(states, hold, end):
    """Window by window: what a person with a list of states would write down."""
    out = set()
    for panel in ("latency", "success"):
        since, firing = None, False
        for at, state in sorted((r["window_start"] + timedelta(minutes=1), r[f"{panel}_state"]) for r in states):
            if state is None:
                continue
            if since and not firing and at > since + hold:
                out.add((panel, "firing", since + hold, since))
                firing = True
            if state == "red" and not since:
                since = at
                out.add((panel, "pending", at, at))
            elif state != "red" and since:
                out.add((panel, "resolved" if firing else "cleared", at, since))
                since, firing = None, False
        if since and not firing and end >= since + hold:
            out.add((panel, "firing", since + hold, since))
    return out


def as_stream(spark, batches):
    path = scratch_path(spark, "log")
    for rows in batches:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)


CASES = {
    # Fires between windows, is resolved, is cleared in time, is cleared at the very instant.
    "states": minutes((0, 2, GREEN), (2, 6, RED), (8, 3, GREEN), (11, 2, RED), (13, 2, GREEN), (15, 3, RED), (18, 1, GREEN)),
    # No request for half an hour: only a timer can fire it; minutes without latency change nothing.
    "silence": minutes((0, 1, GREEN), (1, 1, RED), (30, 1, [(500, None)]), (31, 2, GREEN)),
    "both": minutes((0, 3, SLOW), (3, 1, GREEN), (4, 9, [(500, 0.9)]), (13, 1, SLOW), (14, 1, GREEN)),
}


@pytest.mark.parametrize("name", CASES)
@pytest.mark.parametrize("cuts", [1, 5])
def test_changes_equal_a_slow_walk(spark, name, cuts):
    rows, hold = CASES[name], timedelta(minutes=3)
    size = -(-len(rows) // cuts)
    later = [(DAY + timedelta(minutes=40), "rec", 200, 0.02)], [(DAY + timedelta(minutes=41), "rec", 200, 0.02)]
    stream = as_stream(spark, [rows[k:k + size] for k in range(0, len(rows), size)] + list(later))
    table = sinks.BatchTable(spark, scratch_path(spark, "changes"))
    with sinks.rocksdb_state(spark):
        sinks.drain(alerts.alert_changes(stream, "3 minutes", "1 minute", lateness="1 minute"), table.write, "append")
    log = spark.createDataFrame(rows, SCHEMA)
    # Naive times in both.
    states = [r.asDict() for r in monitor.alert_state(log, "1 minute").collect()]
    want = walk(states, hold, max(r["window_start"] for r in states) + timedelta(minutes=9))
    got = {tuple(r) for r in table.read().collect()}
    assert got == want and len(got) == table.read().count()


def test_states_of_the_stream_equal_those_of_the_table(spark):
    rows = CASES["states"]
    ticks = [[(DAY + timedelta(minutes=m), "rec", 200, 0.02)] for m in (40, 41)]
    stream = as_stream(spark, [rows[:7], rows[7:20], rows[20:], *ticks])
    table = sinks.BatchTable(spark, scratch_path(spark, "states"))
    sinks.drain(alerts.window_states(stream, "1 minute", "rec", "1 minute"), table.write, "append")
    got = sorted(tuple(r) for r in table.read().selectExpr("frame.start", "p95", "success_ratio", "latency_state",
                                                            "success_state").collect())
    assert got == sorted(tuple(r) for r in monitor.alert_state(
        spark.createDataFrame(rows, SCHEMA), "1 minute", "rec").collect())


def test_other_endpoints_count_for_success_only(spark):
    rows = minutes((0, 1, GREEN), (1, 1, GREEN)) + [(DAY, "other", 500, 9.0)]
    first, second = monitor.alert_state(spark.createDataFrame(rows, SCHEMA), "1 minute", "rec").orderBy("window_start").collect()
    assert (first["latency_state"], first["success_state"], first["success_ratio"]) == ("green", "red", 0.75)
    assert (second["latency_state"], second["success_state"]) == ("green", "green")
    none = monitor.alert_state(spark.createDataFrame(rows, SCHEMA), "1 minute", "absent").collect()
    assert {(r["p95"], r["latency_state"]) for r in none} == {(None, None)} and len(none) == 2
