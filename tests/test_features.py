import math

import pytest

from marquee.operators import features
from tests.conftest import tuples

RATINGS = "user_idx long, movie_idx long, rating double, timestamp long"
MOVIES = "movie_idx long, movieId long, title string, genres string"

SOME = [(1, 10, 4.0, 0), (1, 11, 2.0, 86400), (2, 10, 5.0, 50), (3, 12, 1.0, 60), (3, 99, 1.0, 61)]
FILMS = [(10, 100, "A", "Drama|Action"), (11, 101, "B", "Comedy|Drama"), (12, 102, "C", "(no genres listed)")]


def test_user_features(frame):
    rows = {r["user_idx"]: r for r in features.user_features(frame(SOME, RATINGS)).collect()}
    assert rows[1]["user_avg_rating"] == 3.0
    assert rows[1]["user_rating_std"] == pytest.approx(math.sqrt(2))
    assert (rows[1]["user_rating_range"], rows[1]["user_days_active"]) == (2.0, 1.0)
    assert (rows[2]["user_rating_std"], rows[2]["user_days_active"], rows[2]["user_rating_range"]) == (0.0, 0.0, 0.0)


def test_movie_features(frame):
    made = features.movie_features(frame(SOME, RATINGS), frame(FILMS, MOVIES))
    rows = {r["movie_idx"]: r for r in made.collect()}
    # Four movies share five ratings: 1.25 each, mean 2.6.
    assert rows[10]["movie_quality_score"] == pytest.approx((1.25 * 2.6 + 4.5 * 2) / (1.25 + 2))
    assert rows[10]["movie_popularity_score"] == pytest.approx(math.log1p(2))
    assert [rows[10][f"genre_{g}"] for g in ("Action", "Comedy", "Drama")] == [1, 0, 1]
    assert rows[99]["genres"] is None
    for lonely in (12, 99):
        assert [rows[lonely][f"genre_{g}"] for g in ("Action", "Comedy", "Drama")] == [0, 0, 0]


def test_given_vocabulary_needs_no_look_at_the_movies(frame):
    made = features.genre_one_hot(frame(FILMS, MOVIES), ["Drama", "Horror"])
    assert tuples(made, "movie_idx", "genre_Drama", "genre_Horror") == [(10, 1, 0), (11, 1, 0), (12, 0, 0)]


def test_names_that_differ_in_case_only(frame):
    films = frame([(1, 1, "A", "War|war")], MOVIES)
    with pytest.raises(ValueError):
        features.genre_one_hot(films)
    assert features.genre_maps(films).first()["genre_flags"] == {"War": 1, "war": 1}


def test_favourite_genre(frame):
    found = {r["user_idx"]: tuple(r)[1:] for r in
             features.favourite_genre(frame(SOME, RATINGS), frame(FILMS, MOVIES)).collect()}
    assert found[1] == ("Drama", 2, 3.0)
    assert found[2] == ("Action", 1, 5.0)  # a tie goes to the first name
    assert found[3] == ("Unknown", 0, 0.0)


def test_a_users_ratings_meet_before_their_genres_are_counted(frame):
    """So that the map-side aggregation holds few rows, however many ratings a task reads."""
    ratings = frame([(u, m, 1.0, 0) for u in range(5) for m in range(4)],
                    "user_idx long, movie_idx long, rating double, timestamp long")
    movies = frame([(m, "a|b") for m in range(4)], "movie_idx long, genres string")
    found = features.genre_affinity(ratings, movies)
    assert "REBALANCE_PARTITIONS_BY_COL" in found._jdf.queryExecution().executedPlan().toString()
    assert tuples(found, "user_idx", "genre", "n") == [(u, g, 4) for u in range(5) for g in "ab"]


def test_repeated_genre_counts_again(frame):
    films = frame([(10, 1, "A", "B|B|A")], MOVIES)
    found = features.favourite_genre(frame([(1, 10, 4.0, 0)], RATINGS), films).first()
    assert tuple(found) == (1, "B", 2, 4.0)


def test_features_never_look_past_the_cutoff(frame):
    ratings = frame(SOME, RATINGS)
    rows = {r["user_idx"]: r for r in features.user_features(ratings, as_of=60).collect()}
    assert rows[1]["user_rating_count"] == 1 and rows[3]["user_rating_count"] == 1
    history = features.user_feature_history(ratings, [0, 60, 86400])
    for cutoff in (0, 60, 86400):
        alone = features.user_features(ratings, as_of=cutoff)
        assert tuples(history.where(f"as_of = {cutoff}").drop("as_of")) == tuples(alone)


def test_user_view_has_all_declared_features(frame):
    made = features.user_view_features(frame(SOME, RATINGS), frame(FILMS, MOVIES))
    assert {"user_avg_rating", "user_favorite_genre"} <= set(made.columns)
    assert made.count() == 3
    assert features.batch_features(frame(SOME, RATINGS), frame(FILMS, MOVIES)).keys() == {
        "user_features", "movie_features", "user_movie_features"}
