import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import monitor
from tests.conftest import tuples

START = datetime(2024, 1, 1)
LOG = "ts timestamp, endpoint string, status int, latency_s double, user_idx long"


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(7)
    return [(START + timedelta(seconds=pick.randrange(3600)), pick.choice("aab"), pick.choice([200, 200, 200, 500]),
             round(pick.expovariate(3), 3), pick.randrange(9)) for _ in range(400)]


@pytest.fixture
def log(frame, rows):
    return frame(rows, LOG)


def test_sliding_rate_equals_sliding_windows(log):
    ours = monitor.request_rate(log, "5 minutes", ["endpoint"], slide="1 minute")
    plain = (log.where("status = 200").groupBy(F.window("ts", "5 minutes", "1 minute").start.alias("w"), "endpoint")
             .agg(F.count("*").alias("n")))
    assert tuples(ours, "window_start", "endpoint", "requests") == tuples(plain, "w", "endpoint", "n")
    row = ours.first()
    assert row["rate"] == pytest.approx(row["requests"] / 5)
    with pytest.raises(ValueError):
        monitor.request_rate(log, "5 minutes", slide="2 minutes")


def test_exact_quantiles_per_window(log, rows):
    for r in monitor.latency_quantiles(log, "30 minutes").collect():
        mine = [x[3] for x in rows if r["window_start"] <= x[0] < r["window_start"] + timedelta(minutes=30)]
        np.testing.assert_allclose((r["p50"], r["p95"], r["p99"]), np.quantile(mine, [0.5, 0.95, 0.99]))


def test_bucket_quantiles(frame):
    df = frame([(v,) for v in [0.02] * 50 + [0.2] * 45 + [20.0] * 5], "v double")
    got = monitor.bucket_quantiles(df, "v", [0.1, 0.5, 1.0], probabilities={"p25": 0.25, "p50": 0.5, "p90": 0.9, "p99": 0.99})
    assert [round(x, 6) for x in got.first()] == [0.05, 0.1, round(0.1 + 0.4 * 40 / 45, 6), 1.0]
    counts = [(r["le"], r["n"]) for r in monitor.bucket_counts(df, "v", [0.1, 0.5]).collect()]
    assert counts == [(0.1, 50), (0.5, 95), (None, 100)]


def test_in_progress_equals_brute_force(log, rows):
    spans = [(t, t + timedelta(seconds=l)) for t, _, _, l, _ in rows]
    for r in monitor.in_progress(log).collect():
        assert r["in_progress"] == sum(a <= r["instant"] < b for a, b in spans)


def test_ratios_errors_and_summary(log, rows):
    good = [r for r in rows if r[2] == 200]
    one = monitor.request_summary(log).first()
    assert (one["total"], one["success"], one["errors"]) == (400, len(good), 400 - len(good))
    assert one["max_ms"] == pytest.approx(max(r[3] for r in good) * 1000)
    assert monitor.success_ratio(log, "1 hour").first()["success_ratio"] == pytest.approx(len(good) / 400)
    assert monitor.errors_per_minute(log, "1 hour").first()["errors_per_minute"] == pytest.approx((400 - len(good)) / 60)
    assert monitor.active_users(log).first()["active_users"] == len({r[4] for r in rows})
    assert {r["endpoint"]: r["requests"] for r in monitor.requests_by_endpoint(log).collect()} == {
        e: sum(r[1] == e for r in rows) for e in "ab"}


@pytest.mark.parametrize("latency, statuses, states", [
    (0.001, [200] * 100, ("green", "green")),
    (0.2, [200] * 96 + [500] * 4, ("yellow", "yellow")),
    (3.0, [200] * 90 + [500] * 10, ("red", "red"))])
def test_alerts(frame, latency, statuses, states):
    df = frame([(START, "a", s, latency, 1) for s in statuses], LOG)
    row = monitor.alert_state(df, "1 hour").first()
    assert (row["latency_state"], row["success_state"]) == states
