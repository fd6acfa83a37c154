from datetime import datetime, timedelta

import pytest

from marquee.operators import store
from marquee.sources.files import MissingTable
from marquee.streaming import sinks
from tests.conftest import tuples

NOON = datetime(2024, 1, 2, 12)
USER = "user_idx long, user_recent_activity long, user_last_genre string, event_timestamp timestamp"
MOVIE = "movie_idx long, movie_popularity long, movie_recent_views long, event_timestamp timestamp"


def users(frame, *rows):
    return frame(list(rows), USER)


def test_views_are_as_declared():
    assert {n: (v.keys, v.ttl, len(v.features)) for n, v in store.VIEWS.items()} == {
        "user_batch_features": (("user_idx",), timedelta(days=365), 10),
        "movie_batch_features": (("movie_idx",), timedelta(days=365), 8),
        "user_stream_features": (("user_idx",), timedelta(hours=24), 2),
        "movie_stream_features": (("movie_idx",), timedelta(hours=24), 2)}


def test_materialize_takes_the_latest_in_range(frame):
    hours = timedelta(hours=1)
    rows = users(frame, (1, 5, "A", NOON), (1, 9, "B", NOON - hours), (1, 99, "C", NOON + hours),
                 (2, 1, "A", NOON - 24 * hours), (3, 1, "A", NOON - 25 * hours))
    out = store.materialize(store.USER_STREAM, rows, NOON)
    assert tuples(out, "user_idx", "user_recent_activity") == [(1, 5), (2, 1)]
    wide = store.materialize(store.USER_STREAM, rows, NOON, NOON - 48 * hours)
    assert tuples(wide, "user_idx") == [(1,), (2,), (3,)]
    assert store.materialize_views({"user_stream_features": rows}, NOON).keys() == {"user_stream_features"}


def test_types_and_missing_columns(frame):
    made = store.as_view(store.MOVIE_STREAM, frame([(1, 2, 3, NOON)], MOVIE.replace("long", "int")))
    assert [t for _, t in made.dtypes] == ["bigint", "bigint", "bigint", "timestamp"]
    with pytest.raises(ValueError, match="user_last_genre"):
        store.as_view(store.USER_STREAM, frame([(1, 2, NOON)], "user_idx long, user_recent_activity long, event_timestamp timestamp"))


def test_expire_blanks_old_values_and_keeps_the_row(frame):
    rows = users(frame, (1, 5, "A", NOON - timedelta(hours=24)), (2, 6, "B", NOON - timedelta(hours=24, seconds=1)))
    assert tuples(store.expire(store.USER_STREAM, rows, NOON), "user_idx", "user_recent_activity") == [(1, 5), (2, None)]


def test_push_replaces_only_with_newer(frame):
    old = users(frame, (1, 5, "A", NOON), (2, 6, "B", NOON))
    new = users(frame, (1, 7, "C", NOON + timedelta(seconds=1)), (2, 1, "Z", NOON - timedelta(seconds=1)), (3, 1, "N", NOON))
    assert tuples(store.push(store.USER_STREAM, old, new), "user_idx", "user_recent_activity") == [(1, 7), (2, 6), (3, 1)]


def test_online_lookup(spark, frame):
    latest = {"user_stream_features": users(frame, (1, 5, "A", NOON)),
              "movie_stream_features": frame([(1, 2, 3, NOON)], MOVIE)}
    found = store.online_lookup(spark, latest, [1, 77], [1])
    assert found.columns == ["user_idx", "user_recent_activity", "user_last_genre"]
    assert tuples(found.fillna(-1)) == [(1, 5, "A"), (77, -1, None)]
    one = store.online_lookup(spark, latest, movie_ids=[1], refs=["movie_stream_features:movie_popularity"])
    assert tuples(one) == [(1, 2)]
    with pytest.raises(ValueError, match="unknown feature"):
        store.online_lookup(spark, latest, [1], refs=["user_stream_features:nope"])


def test_bundle_defaults(spark, frame):
    batch = store.as_view(store.USER_BATCH, spark.createDataFrame(
        [(1, *[1.0] * 2, 3, *[1.0] * 4, "Drama", 2, 1.0, NOON)],
        "user_idx long, user_avg_rating double, user_rating_std double, user_rating_count long,"
        "user_min_rating double, user_max_rating double, user_rating_range double, user_days_active double,"
        "user_favorite_genre string, user_favorite_genre_count long, user_favorite_genre_avg_rating double,"
        "event_timestamp timestamp"))
    latest = {"user_batch_features": batch, "user_stream_features": users(frame)}
    row = store.user_bundle(spark.createDataFrame([(1,)], "user_idx long"), latest).first()
    assert tuple(row) == (1, 1.0, 3, "Drama", 0, "Unknown")


def test_historical_lookup_over_two_views(spark, frame):
    entities = spark.createDataFrame([(1, 1, NOON), (1, 1, NOON + timedelta(days=2))],
                                     "user_idx long, movie_idx long, event_timestamp timestamp")
    tables = {"user_stream_features": users(frame, (1, 5, "A", NOON - timedelta(hours=1))),
              "movie_stream_features": frame([(1, 2, 3, NOON), (1, 8, 9, NOON + timedelta(hours=47))], MOVIE)}
    out = store.historical_features(entities, tables).orderBy("event_timestamp").collect()
    assert [tuple(r)[3:] for r in out] == [(5, "A", 2, 3), (None, None, 8, 9)]


def test_stats_and_freshness(frame):
    rows = users(frame, (1, 5, None, NOON), (1, 6, "A", NOON - timedelta(days=3)), (2, None, None, NOON - timedelta(days=2)))
    stats = {r["feature"]: r for r in store.view_stats(store.USER_STREAM, rows, NOON).collect()}
    row = stats["user_last_genre"]
    assert (row["n_rows"], row["n_entities"], row["null_share"], row["stale_share"], row["newest"]) == (
        3, 2, pytest.approx(2 / 3), pytest.approx(2 / 3), NOON)
    assert stats["user_recent_activity"]["null_share"] == pytest.approx(1 / 3)
    assert store.freshness({"user_stream_features": rows}, NOON + timedelta(seconds=90)).first()["age_s"] == 90.0


def test_a_push_writes_only_the_buckets_it_touches(spark, tmp_path):
    table = sinks.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=16)
    table.write(spark.range(1_000).selectExpr("id AS k", "0 AS v"), 0)
    table.write(spark.createDataFrame([(5, 1), (5, 1), (2_000, 1)], "k long, v int"), 1)

    def parts(version):
        return {p.name for p in (tmp_path / "t" / "data" / f"version={version}").glob("_part=*")}

    assert len(parts(0)) == 16 and 1 <= len(parts(1)) <= 2
    rows = dict(tuples(table.read()))
    assert len(rows) == 1_001 and rows[5] == 1 and rows[2_000] == 1 and rows[6] == 0
    assert tuples(table.lookup(spark.createDataFrame([(5,), (7,), (9_999,)], "k long"))) == [(5, 1), (7, 0)]


def test_a_replayed_push_gives_the_same(spark, tmp_path):
    table = sinks.BucketedTable(spark, str(tmp_path / "t"), ["k"], buckets=4)
    pushes = [[(1, "a"), (2, "a"), (None, "n")], [(2, "b"), (3, "b")], [(1, "c")]]
    for number, rows in enumerate(pushes):
        table.write(spark.createDataFrame(rows, "k long, v string"), number)
    want = sorted(map(str, tuples(table.read().fillna(-1))))
    assert want == ["(-1, 'n')", "(1, 'c')", "(2, 'b')", "(3, 'b')"]
    for number in (2, 1, 2):
        table.write(spark.createDataFrame(pushes[number], "k long, v string"), number)
    assert sorted(map(str, tuples(table.read().fillna(-1)))) == want
    # A push whose manifest was never written is not seen.
    for file in (tmp_path / "t" / "manifests" / "push=2").glob("*"):
        file.unlink()
    assert dict(tuples(table.read().where("k = 1"))) == {1: "a"}
    assert set(table.versions().values()) <= {0, 1} and set(table.unused()).isdisjoint(table.versions().values())


def test_an_empty_table_of_buckets_is_missing(spark, tmp_path):
    with pytest.raises(MissingTable):
        sinks.BucketedTable(spark, str(tmp_path / "none"), ["k"]).read()
