from collections import Counter

from marquee.operators import clean, profile
from tests.conftest import tuples

RAW = "userId long, movieId long, rating double, timestamp long"


def ratings(frame, pairs):
    return frame([(u, m, 3.0, i) for i, (u, m) in enumerate(pairs)], RAW)


# User 3 has two ratings but loses one when movie 9 goes.
PAIRS = [(1, 1), (1, 2), (2, 1), (2, 2), (3, 1), (3, 9), (4, 2)]


def test_single_pass_keeps_a_user_who_falls_below(frame):
    kept = clean.filter_min_interactions(ratings(frame, PAIRS), 2, 2)
    assert Counter(r["userId"] for r in kept.collect()) == {1: 2, 2: 2, 3: 1}


def test_iterating_reaches_a_core(frame):
    kept = clean.filter_min_interactions(ratings(frame, PAIRS), 2, 2, iterate=True)
    assert Counter(r["userId"] for r in kept.collect()) == {1: 2, 2: 2}


def test_dense_ids_by_key_and_by_first_seen(frame):
    df = ratings(frame, [(7, 1), (5, 1), (7, 2), (9, 3)])
    assert tuples(clean.dense_ids(df, "userId", "user_idx")) == [(5, 0), (7, 1), (9, 2)]
    assert tuples(clean.dense_ids(df, "userId", "user_idx", "timestamp")) == [(5, 1), (7, 0), (9, 2)]


def test_maps_attach_both_indexes(frame):
    df = ratings(frame, [(7, 30), (5, 20)])
    users, items = clean.dense_ids(df, "userId", "user_idx"), clean.dense_ids(df, "movieId", "movie_idx")
    out = clean.apply_id_maps(df, users, items)
    assert out.columns == ["userId", "movieId", "rating", "timestamp", "user_idx", "movie_idx"]
    assert tuples(out, "userId", "user_idx", "movie_idx") == [(5, 0, 0), (7, 1, 1)]
    assert clean.id_map(users, "userId", "user_idx").columns == ["original_userId", "user_idx"]


def test_movies_restricted(frame):
    df = ratings(frame, [(1, 30)])
    movies = frame([(30, "A", "X"), (31, "B", "Y")], "movieId long, title string, genres string")
    assert tuples(clean.rated_movies(movies, df), "movieId") == [(30,)]
    items = clean.dense_ids(df, "movieId", "movie_idx")
    assert tuples(clean.clean_movies(movies, items)) == [(30, "A", "X", 0)]


def test_profiles(frame):
    df = frame([(1, 1.0), (1, 1.0), (2, None), (None, float("nan"))], "k long, v double")
    assert {r["column"]: (r["non_null"], r["nulls"]) for r in profile.null_counts(df).collect()} == {
        "k": (3, 1), "v": (2, 2)}
    assert profile.duplicate_rows(df).first()["duplicates"] == 1
    assert dict(tuples(profile.distinct_counts(df, ["k"]))) == {"k": 2}
    assert tuples(profile.shape(df)) == [(4, 2)]
    assert dict(tuples(profile.distinct_counts(df, ["k"], approximate=True))) == {"k": 2}


def test_describe_and_sparsity(frame):
    df = frame([(u, m, float(u), u) for u in range(4) for m in range(2)], RAW)
    row = {r["column"]: r for r in profile.describe(df).collect()}["rating"]
    assert (row["count"], row["mean"], row["min"], row["q25"], row["q50"], row["q75"], row["max"]) == (
        8, 1.5, 0.0, 0.75, 1.5, 2.25, 3.0)
    assert profile.sparsity(df.limit(8), "userId", "movieId").first()["sparsity"] == 0.0
    assert [tuple(r) for r in profile.top_values(df, "rating", 2).collect()] == [(0.0, 2), (1.0, 2)]
