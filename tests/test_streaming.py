import time
import json
import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from marquee.sources import kafka
from marquee.streaming import counters, jobs, sinks, windows
from tests.conftest import tuples

START = datetime(2024, 1, 1)
SCHEMA = "event_id long, user_idx long, movie_idx long, event_type string, ts timestamp, genres string"


def make_events(n=200, seed=2):
    pick = random.Random(seed)
    return [(i, 0 if pick.random() < 0.5 else pick.randrange(1, 6), pick.randrange(8),
             pick.choice(["view", "click", "search", "rating"]), START + timedelta(seconds=60 * i),
             pick.choice([None, "A", "B|C"])) for i in range(n)]


@pytest.fixture(params=[1, 3, 7])
def parts(request):
    return request.param


def as_stream(spark, tmp_path, rows, parts):
    """The rows as ``parts`` files, one per micro-batch, in event order."""
    folder = tmp_path / "events"
    size = -(-len(rows) // parts)
    for p in range(parts):
        spark.createDataFrame(rows[p * size:(p + 1) * size], SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_features_equal_a_batch_whatever_the_files(spark, tmp_path, parts):
    rows = make_events()
    query, users, movies = jobs.update_features(as_stream(spark, tmp_path, rows, parts), str(tmp_path / "out"))
    query.awaitTermination()
    batch = spark.createDataFrame(rows, SCHEMA)
    assert tuples(users.read()) == tuples(counters.user_stream_features(batch))
    assert tuples(movies.read()) == tuples(counters.movie_stream_features(batch))
    assert len(sinks.throughput(query)) >= parts
    total = counters.totals(users.read(), movies.read()).first()
    assert total["total_user_events"] == len(rows)


def test_one_view_event(spark):
    event = spark.createDataFrame([(1, 100, 50, "view", START, "Action|Thriller")], SCHEMA)
    assert tuple(counters.user_stream_features(event).first())[:3] == (100, 1, "Action|Thriller")
    assert tuple(counters.movie_stream_features(event).first())[:3] == (50, 1, 1)


def test_null_genres_do_not_overwrite_and_zero_movies_are_optional(spark):
    rows = [(1, 1, 5, "search", START, "A"), (2, 1, 6, "view", START + timedelta(1), None)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert counters.user_stream_features(df).first()["user_last_genre"] == "A"
    assert tuples(counters.movie_stream_features(df), "movie_idx") == [(6,)]
    assert tuples(counters.movie_stream_features(df, include_zero=True), "movie_idx", "movie_popularity") == [(5, 0), (6, 1)]
    assert counters.last_genre(df.where("event_id = 2")).first()["user_last_genre"] == "Unknown"


@pytest.mark.parametrize("parts", [1, 3])
def test_count_windows_continue_over_batches(spark, tmp_path, parts):
    rows = make_events()
    table = windows.CountWindows(spark, str(tmp_path / "cw"), "user_idx", 10)
    sinks.drain(as_stream(spark, tmp_path, rows, parts), table.write, "append")
    want = windows.count_windows(spark.createDataFrame(rows, SCHEMA), "user_idx", 10)
    assert tuples(table.read()) == tuples(want)
    sizes = [r["events"] for r in want.where("user_idx = 0").orderBy("window_no").collect()]
    assert set(sizes[:-1]) == {10} and sum(sizes) == sum(r[1] == 0 for r in rows)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    rows = make_events(60)
    table = windows.CountWindows(spark, str(tmp_path / "cw"), "user_idx", 10)
    first, second = (spark.createDataFrame(r, SCHEMA) for r in (rows[:30], rows[30:]))
    table.write(first, 0)
    table.write(second, 1)
    before = tuples(table.read())
    table.write(second, 1)
    assert tuples(table.read()) == before


def test_compacted_table_reads_the_same(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), ["k"])
    for batch, rows in enumerate([[(1, "a"), (2, "a")], [(2, "b")], [(3, "c")]]):
        table.write(spark.createDataFrame(rows, "k long, v string"), batch)
    want = tuples(table.read())
    table.compact(1)
    assert tuples(table.read()) == want == [(1, "a"), (2, "b"), (3, "c")]
    assert tuples(table.read(before=1)) == [(1, "a"), (2, "a")]
    table.write(spark.createDataFrame([(1, "z")], "k long, v string"), 3)
    assert tuples(table.read()) == [(1, "z"), (2, "b"), (3, "c")]


def test_sliding_activity_equals_sliding_windows(spark, tmp_path):
    rows = make_events()
    table = sinks.KeyedTable(spark, str(tmp_path / "panes"), ["window_start", "user_idx"])
    sinks.drain(counters.activity_panes(as_stream(spark, tmp_path, rows, 3), "15 minutes", "1 day"), table.write)
    got = counters.sliding_activity(table.read(), "1 hour", "15 minutes")
    want = spark.createDataFrame(rows, SCHEMA).groupBy(
        F.window("ts", "1 hour", "15 minutes").start.alias("w"), "user_idx").count()
    assert tuples(got, "window_start", "user_idx", "events") == tuples(want, "w", "user_idx", "count")


def test_late_rows_are_dropped_and_counted(spark, tmp_path):
    late = (999, 1, 1, "view", START - timedelta(days=3), None)
    stream = as_stream(spark, tmp_path, make_events(40) + [late], 3)
    table = sinks.KeyedTable(spark, str(tmp_path / "late"), ["window_start", "user_idx"])
    progress = sinks.Progress()
    spark.streams.addListener(progress)
    query = sinks.drain(counters.activity_panes(stream, "15 minutes", "1 minute"), table.write)
    assert table.read().agg(F.sum("events")).first()[0] == 40
    for _ in range(100):  # the listener hears of a batch a little later
        if str(query.id) in progress.totals and progress.totals[str(query.id)]["rows"] == 41:
            break
        time.sleep(0.1)
    spark.streams.removeListener(progress)
    assert progress.late_rows(query) == 1
    assert progress.totals[str(query.id)]["batches"] >= 3 and progress.rows_per_second(query) > 0


def test_a_keyed_table_compacts_itself(spark, tmp_path):
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), ["k"], compact_every=2)
    for batch in range(5):
        table.write(spark.createDataFrame([(batch % 3, batch), (9, batch)], "k long, v long"), batch)
    assert tuples(table.read()) == [(0, 3), (1, 4), (2, 2), (9, 4)]
    assert len(list((tmp_path / "t" / "snapshots").glob("upto=*"))) == 2
    table.write(spark.createDataFrame([(1, 4), (9, 4)], "k long, v long"), 4)  # a replay
    assert tuples(table.read()) == [(0, 3), (1, 4), (2, 2), (9, 4)]
    assert tuples(table.read(before=3)) == [(0, 0), (1, 1), (2, 2), (9, 2)]


def test_malformed_messages_are_kept_apart(spark):
    raw = spark.createDataFrame([('{"event_id": "e1", "user_idx": 3}',), ("{not json",), ("",), (None,), ('{"user_idx": "x"}',)],
                                "value string")
    assert [r["event_id"] for r in kafka.decode(raw).collect()] == ["e1"]
    assert sorted(str(r["value"]) for r in kafka.malformed(raw).collect()) == ["", "None", '{"user_idx": "x"}', "{not json"]


def test_topic_options():
    options = kafka.topic_options("h:1", group="g", most_per_batch=500)
    assert options["kafka.group.id"] == "g" and options["maxOffsetsPerTrigger"] == "500"
    assert "kafka.group.id" not in kafka.topic_options("h:1")


@pytest.mark.parametrize("spread", [1, 4])
def test_repeated_events_are_dropped(spark, tmp_path, spread):
    rows = make_events(50)
    stream = as_stream(spark, tmp_path, rows + rows[-5:] * 3, 2)
    table = sinks.BatchTable(spark, str(tmp_path / "dedup"))
    sinks.drain(counters.deduplicated(stream, "1 day", spread), table.write, "append")
    assert tuples(table.read(), "event_id") == [(r[0],) for r in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    assert counters.deduplicated(df.union(df)).count() == 50


def test_sessions_equal_session_windows(spark, tmp_path):
    pick = random.Random(8)
    rows = [(i, pick.randrange(3), 1, "view", START + timedelta(minutes=pick.randrange(3000)), None) for i in range(150)]
    rows += [(900, 7, 1, "view", START, None), (901, 7, 1, "view", START + timedelta(minutes=30), None),
             (902, 7, 1, "view", START + timedelta(minutes=61), None)]
    df = spark.createDataFrame(rows, SCHEMA)
    native = df.groupBy(F.session_window("ts", "30 minutes").alias("s"), "user_idx").agg(F.count("*").alias("n"))
    want = tuples(native.select("user_idx", "s.start", "s.end", "n"))
    assert tuples(counters.sessions(counters.session_panes(df))) == want
    table = sinks.KeyedTable(spark, str(tmp_path / "panes"), ["user_idx", "pane_start"])
    sinks.drain(counters.session_panes(as_stream(spark, tmp_path, rows, 3), lateness="9 days"), table.write)
    assert tuples(counters.sessions(table.read())) == want


def test_recent_and_summary(spark):
    rows = make_events(30)
    df = spark.createDataFrame(rows, SCHEMA)
    assert [r["event_id"] for r in counters.recent_events(df).collect()] == list(range(29, 19, -1))
    one = counters.batch_summary(df).first()
    assert one["events"] == 30 and sum(one["per_type"].values()) == 30
    assert [e["user_idx"] for e in one["last_events"]] == [r[1] for r in rows[:-4:-1]]
    assert one["active_users"] == len({r[1] for r in rows})


def test_valid_and_rejected_events_part(spark, tmp_path):
    rows = [(1, 1, "view", 1.7e9, None, None), (2, 1, "like", 1.7e9, None, None), (None, 1, "view", 1.7e9, None, None)]
    schema = "user_idx long, movie_idx long, event_type string, timestamp double, genres string, rating double"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    query, good, bad = jobs.split_valid(stream, str(tmp_path / "out"), now=1.7e9)
    query.awaitTermination()
    assert tuples(good.read(), "user_idx") == [(1,)]
    errors = {e for r in bad.read().collect() for e in r["errors"]}
    assert errors == {"Invalid event_type: like", "Missing required field: user_idx"}


def test_messages_keep_their_values(spark):
    produced = [{"event_id": "e1", "user_idx": 3, "movie_idx": 4, "event_type": "rate",
                 "timestamp": "2024-01-02T03:04:05.678901", "session_id": "s", "rating": 4.5},
                {"event_id": "e2", "user_idx": 3, "movie_idx": 4, "event_type": "view",
                 "timestamp": "not a time", "session_id": "s"}]
    raw = spark.createDataFrame([(json.dumps(e).encode(),) for e in produced], "value binary")
    first, second = kafka.decode(raw).orderBy("event_id").collect()
    assert first["ts"] == datetime(2024, 1, 2, 3, 4, 5, 678901) and first["rating"] == 4.5
    assert second["ts"] is None and second["rating"] is None
    again = kafka.encode(kafka.decode(raw).drop("ts").where("event_id = 'e1'")).first()
    assert again["key"] == "3" and json.loads(again["value"]) == produced[0]


def test_messages_to_features(spark, tmp_path):
    """JSON in, broken events aside, both views kept from the good ones."""
    pick = random.Random(6)
    messages = [{"event_id": f"e{i}", "user_idx": pick.randrange(-1, 4), "movie_idx": pick.randrange(5),
                 "event_type": pick.choice(["view", "like", "search"]),
                 "timestamp": (START + timedelta(minutes=i)).isoformat(), "session_id": "s"} for i in range(60)]
    spark.createDataFrame([(json.dumps(m),) for m in messages], "value string").write.text(str(tmp_path / "topic"))
    events = kafka.service_form(kafka.decode(spark.readStream.text(str(tmp_path / "topic"))))
    query, good, bad = jobs.split_valid(events, str(tmp_path / "checked"), now=START.timestamp() + 1e6)
    query.awaitTermination()
    fine = [m for m in messages if m["user_idx"] >= 0 and m["event_type"] != "like"]
    assert good.read().count() == len(fine) and bad.read().count() == len(messages) - len(fine)
    stream = spark.readStream.schema(good.read().schema).parquet(good.path + "/batches/*").withColumn(
        "genres", F.lit(None).cast("string"))
    query, users, movies = jobs.update_features(stream, str(tmp_path / "views"))
    query.awaitTermination()
    assert dict(tuples(users.read(), "user_idx", "user_recent_activity")) == {
        u: sum(m["user_idx"] == u for m in fine) for u in {m["user_idx"] for m in fine}}
    assert dict(tuples(movies.read(), "movie_idx", "movie_popularity")) == {
        v: sum(m["movie_idx"] == v and m["event_type"] == "view" for m in fine)
        for v in {m["movie_idx"] for m in fine if m["event_type"] == "view"}}


def test_event_time_from_epoch_seconds(spark):
    df = spark.createDataFrame([(1704164645.25,)], "timestamp double")
    assert kafka.service_form(df).first()["ts"] == datetime(2024, 1, 2, 3, 4, 5, 250000)


def test_rocksdb_state_gives_the_same(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    try:
        sinks.use_rocksdb_state(spark)
        rows = make_events(60)
        query, users, _ = jobs.update_features(as_stream(spark, tmp_path, rows, 2), str(tmp_path / "out"))
        query.awaitTermination()
        assert tuples(users.read()) == tuples(counters.user_stream_features(spark.createDataFrame(rows, SCHEMA)))
    finally:
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", before)


def test_events_without_a_key_make_windows_too(spark, tmp_path):
    schema = "event_id long, user_idx long, event_type string, ts timestamp"
    rows = [(i, None if i % 2 else 7, "view", START + timedelta(seconds=i)) for i in range(12)]
    whole = windows.count_windows(spark.createDataFrame(rows, schema), "user_idx", 4)
    assert sorted((str(r["user_idx"]), r["window_no"], r["events"]) for r in whole.collect()) == [
        ("7", 0, 4), ("7", 1, 2), ("None", 0, 4), ("None", 1, 2)]
    table = windows.CountWindows(spark, str(tmp_path / "w"), "user_idx", 4)
    for batch, part in enumerate((rows[:5], rows[5:])):
        table.write(spark.createDataFrame(part, schema), batch)
    assert sorted(map(str, tuples(table.read().drop("user_idx")))) == sorted(map(str, tuples(whole.drop("user_idx"))))


def test_keyed_count_windows_go_on_after_a_restart(spark, tmp_path):
    """Same windows whatever the micro-batches, after a restart, and when the last one is replayed."""
    rows = make_events(120)
    want = tuples(windows.count_windows(spark.createDataFrame(rows, SCHEMA), "user_idx", 7))
    folder, table = tmp_path / "events", sinks.KeyedTable(spark, str(tmp_path / "t"), ["user_idx", "window_no"])

    def put(part):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))

    def run():
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
        with sinks.rocksdb_state(spark):
            sinks.drain(windows.keyed_count_windows(stream, "user_idx", 7), table.write, "update", str(tmp_path / "c"))

    for part in (rows[:25], rows[25:50]):
        put(part)
    run()
    for part in (rows[50:75], rows[75:100], rows[100:]):
        put(part)
    run()
    columns = ["user_idx", "window_no", "events", "watched", "first_ts", "last_ts"]
    assert tuples(table.read(), *columns) == sorted(want)
    commits = sorted((int(p.name), p) for p in (tmp_path / "c" / "commits").iterdir() if p.name.isdigit())
    assert len(commits) >= 5
    commits[-1][1].unlink()
    for crc in (tmp_path / "c" / "commits").glob(f".{commits[-1][0]}.crc"):
        crc.unlink()
    run()
    assert tuples(table.read(), *columns) == sorted(want)


def test_keyed_count_windows_without_a_key(spark, tmp_path):
    rows = [(i, None if i % 2 else 7, 1, "view" if i % 3 else None, START + timedelta(seconds=i), None) for i in range(12)]
    table = sinks.KeyedTable(spark, str(tmp_path / "t"), ["user_idx", "window_no"])
    with sinks.rocksdb_state(spark):
        sinks.drain(windows.keyed_count_windows(as_stream(spark, tmp_path, rows, 2), "user_idx", 4), table.write)
    assert sorted((str(r["user_idx"]), r["window_no"], r["events"], r["watched"]) for r in table.read().collect()) == [
        ("7", 0, 4, 2), ("7", 1, 2, 2), ("None", 0, 4, 3), ("None", 1, 2, 1)]


def test_state_of_kept_features_stops_growing(spark, tmp_path):
    """New users every day: the cumulative form holds them all, the windowed one those of the last panes."""
    rows = [(i, i, 1, "search", START + timedelta(days=i // 10, minutes=i % 10), "A") for i in range(60)]
    held = {}
    for name in ("kept", "since the start"):
        stream = as_stream(spark, tmp_path / name, rows, 6)
        out = str(tmp_path / name / "out")
        query = (jobs.keep_features(stream, out) if name == "kept" else jobs.update_features(stream, out))[0]
        query.awaitTermination()
        held[name] = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress]
    assert max(held["kept"]) <= 20 and held["kept"][-1] <= 20
    assert held["since the start"][-1] == 60


def test_kept_features_equal_a_batch(spark, tmp_path):
    rows = [(i, i % 4, i % 3, ["view", "search", "click"][i % 3], START + timedelta(minutes=25 * i), [None, "A", "B"][i % 3])
            for i in range(200)]
    query, kept = jobs.keep_features(as_stream(spark, tmp_path, rows, 4), str(tmp_path / "out"), "6 hours", "1 hour")
    query.awaitTermination()
    for as_of in (rows[-9][4], None):
        if as_of is None:
            # From here on only windows from the newest one on are whole.
            before = kept.panes.read().count()
            kept.panes.compact(100)
            assert kept.panes.read().count() < before
        end = (as_of or rows[-1][4]).replace(minute=0) + timedelta(hours=1)
        own = spark.createDataFrame([r for r in rows if end - timedelta(hours=6) <= r[4] < end], SCHEMA)
        assert tuples(kept.users(as_of), "user_idx", "user_recent_activity", "user_last_genre") == tuples(
            counters.user_stream_features(own), "user_idx", "user_recent_activity", "user_last_genre")
        assert tuples(kept.movies(as_of), "movie_idx", "movie_popularity") == tuples(
            counters.movie_stream_features(own), "movie_idx", "movie_popularity")


def test_sessions_leave_the_stream_and_its_state(spark, tmp_path):
    rows = [(i, i % 3, 1, "view", START + timedelta(hours=2 * (i // 30), minutes=i % 30), None) for i in range(90)]
    late = [(900, 1, 1, "view", START, None)]
    tick = [(901, None, None, "tick", START + timedelta(days=1), None)]
    folder = tmp_path / "events"
    for part in (rows[:30], rows[30:60], rows[60:], late, tick, tick):
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))
    stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(str(folder))
    real = stream.withWatermark("ts", "10 minutes").where("event_type <> 'tick' OR ts IS NULL")
    table = sinks.BatchTable(spark, str(tmp_path / "sessions"))
    query = sinks.drain(counters.session_rows(real, lateness=None), table.write, "append")
    want = counters.session_rows(spark.createDataFrame(rows, SCHEMA))
    assert tuples(table.read()) == tuples(want) and want.count() == 9
    assert sinks.late_rows(query) == 1
    assert query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 0


def test_summaries_go_on_and_counts_come_with_the_progress(spark, tmp_path):
    rows = make_events(90)
    query, table = jobs.keep_summaries(as_stream(spark, tmp_path, rows, 3), str(tmp_path / "out"))
    query.awaitTermination()
    got = table.read().orderBy("batch").collect()
    assert [r["total_events"] for r in got] == [30, 60, 90]
    assert got[-1]["total_per_type"] == {k: sum(r[3] == k for r in rows) for k in {r[3] for r in rows}}
    seen = [p.observedMetrics["summary"] for p in query.recentProgress if p.numInputRows]
    assert [m["events"] for m in seen] == [30, 30, 30]
    assert sum(m["watched"] for m in seen) == sum(r[3] in ("view", "click") for r in rows)


def test_every_message_is_kept_somewhere(spark, tmp_path):
    good = {"event_id": "e", "user_idx": 1, "movie_idx": 2, "event_type": "view", "timestamp": START.isoformat(),
            "session_id": "s"}
    values = [json.dumps(good), json.dumps({**good, "event_type": "like"}), "{cut", "", '{"user_idx": "x"}']
    spark.createDataFrame([(v,) for v in values], "value string").write.parquet(str(tmp_path / "topic"))
    stream = spark.readStream.schema("value string").parquet(str(tmp_path / "topic"))
    query, valid, rejected = jobs.split_messages(stream, str(tmp_path / "out"), now=START.timestamp() + 10)
    query.awaitTermination()
    assert tuples(valid.read(), "event_id", "event_type") == [("e", "view")]
    assert sorted((r["value"], r["errors"]) for r in rejected.read().collect()) == sorted([
        ("", [kafka.NO_EVENT]), ("{cut", [kafka.NO_EVENT]), ('{"user_idx": "x"}', [kafka.NO_EVENT]),
        (values[1], ["Invalid event_type: like"])])
