"""Micro-batches of several files, and copies collapsed before they meet the state."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.plans import streams
from marquee.sources import proxies
from marquee.streaming import counters, sinks

START = datetime(2024, 1, 1)
TABLE = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


@pytest.fixture
def folder(spark, tmp_path):
    """800 events in the first hours, 3 much later: most fifths of the time hold none."""
    rows = [(i, START + timedelta(seconds=9 * i + (10**6 if i >= 800 else 0)), i % 7, "view", 1.0, '{"k": %d}' % (i % 5))
            for i in range(803)]
    spark.createDataFrame(rows, TABLE).repartition(4).write.parquet(str(tmp_path / "sf" / "events.parquet"))
    return str(tmp_path / "sf")


def batches(spark, folder, tmp_path, **options):
    """Files per micro-batch, and the events of each micro-batch."""
    path = str(tmp_path / "events")
    each = proxies.event_files(spark, folder, path, 5, **options)
    table = sinks.BatchTable(spark, str(tmp_path / "out"))
    sinks.drain(proxies.event_stream(spark, path, "*.parquet", each), table.write, "append")
    found = spark.read.parquet(f"{table.path}/batches").groupBy("batch_id").agg(F.sort_array(F.collect_list("event_id")))
    return each, dict(map(tuple, found.collect()))


@pytest.mark.parametrize("even", [False, True])
def test_a_large_micro_batch_has_several_files(spark, folder, tmp_path, monkeypatch, even):
    once = batches(spark, folder, tmp_path / "one", even=even)
    monkeypatch.setattr(proxies, "FILE_EVENTS", 50)
    many = batches(spark, folder, tmp_path / "many", even=even)
    assert once[0] == 1 and many[0] == (16 if even else 4)
    assert many[1] == once[1] and sum(map(len, once[1].values())) == 803


def test_ticks_stay_micro_batches_of_their_own(spark, folder, tmp_path, monkeypatch):
    monkeypatch.setattr(proxies, "FILE_EVENTS", 50)
    each, found = batches(spark, folder, tmp_path, copies=2, tick="2 days")
    assert each == 4 and sorted(found) == list(range(12))
    assert all(found[k] == found[k + 5] for k in range(5)) and sum(len(found[k]) for k in range(10)) == 1606


def test_copies_collapse_before_the_state(spark, folder, tmp_path):
    """One shuffle and one state, and a late copy does not stand for one in time."""
    def rows(*events):
        return spark.createDataFrame([(i, START + timedelta(hours=h)) for i, h in events], "event_id long, ts timestamp").coalesce(1)

    path = str(tmp_path / "in")
    for k in (1, 2):
        rows((k, 50)).write.mode("append").parquet(path)
    rows((3, 0), (3, 49), (4, 0), (None, 50), (None, 50), (5, 50), (5, 50)).write.mode("append").parquet(path)
    stream = spark.readStream.schema("event_id long, ts timestamp").option("maxFilesPerTrigger", 1).parquet(path)
    table = sinks.BatchTable(spark, str(tmp_path / "out"))
    query = sinks.drain(counters.deduplicated(stream, "1 day"), table.write, "append")
    assert sorted(r["event_id"] or 0 for r in table.read().collect()) == [0, 1, 2, 3, 5]
    assert all(len(p["stateOperators"]) == 1 for p in query.recentProgress)


@pytest.mark.parametrize("name", ["stream_push", "stream_windowed_features", "stream_features_24h", "stream_dedup"])
def test_state_that_grows_with_events_is_off_the_heap(spark, folder, monkeypatch, name):
    started = []
    start = sinks.start

    def seen(stream, *args, **options):
        started.append({k: spark.conf.get(k, None) for k in sinks._ROCKSDB})
        return start(stream, *args, **options)

    monkeypatch.setattr(sinks, "start", seen)
    monkeypatch.setattr("marquee.streaming.jobs.start", seen)
    before = {k: spark.conf.get(k, None) for k in sinks._ROCKSDB}
    assert streams.QUERIES[name](spark, folder).count() > 0
    assert started == [sinks._ROCKSDB] and {k: spark.conf.get(k, None) for k in sinks._ROCKSDB} == before
