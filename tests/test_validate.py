from datetime import datetime

import pytest

from marquee.operators import validate
from marquee.sources.files import read_for_validation
from tests.conftest import tuples

RATINGS = "user_idx long, movie_idx long, rating double, timestamp long"
NOW = 1_700_000_000.0
EVENT = "id long, user_idx long, movie_idx long, event_type string, timestamp double, rating double"

EVENTS = [
    ((100, 50, "rating", NOW, 4.5), []),
    ((100, 50, "rating", NOW, 6.5), ["Rating out of range: 6.5"]),
    ((100, 50, "rating", NOW, 0.75), ["Rating not in 0.5 increments: 0.75"]),
    ((100, 50, "rating", NOW, None), ["Rating event missing 'rating' field"]),
    ((100, 50, "view", NOW, 9.9), []),
    ((100, 50, "like", NOW, None), ["Invalid event_type: like"]),
    ((-1, -2, "view", NOW, None), ["Invalid user_idx: -1", "Invalid movie_idx: -2"]),
    ((1, 2, "view", NOW + 60, None), []),
    ((1, 2, "view", NOW + 61, None), ["Timestamp in future: 1700000061.0"]),
    ((1, 2, "view", 788918400.0, None), []),
    ((1, 2, "view", 788918399.5, None), ["Timestamp too old: 788918399.5"]),
    ((None, 2, "like", None, None), ["Missing required field: user_idx", "Missing required field: timestamp"]),
]


def test_event_rules(spark):
    df = spark.createDataFrame([(i, *e) for i, (e, _) in enumerate(EVENTS)], EVENT)
    found = {r["id"]: (r["errors"], r["valid"]) for r in validate.validate_events(df, NOW).collect()}
    for i, (_, errors) in enumerate(EVENTS):
        assert found[i] == (errors, not errors)
    good, bad = validate.good_and_bad(validate.validate_events(df, NOW))
    assert (good.count(), bad.count()) == (4, 8)
    assert good.columns == df.columns and bad.columns == [*df.columns, "errors"]


def test_allowed_types_are_a_parameter(spark):
    df = spark.createDataFrame([(1, 1, 1, "like", NOW, None)], EVENT)
    assert validate.validate_events(df, NOW, ["like"]).first()["valid"]


def good_rows(n=1000):
    return [(i % 50, i, 3.5, 800_000_000 + i) for i in range(n)]


def test_six_columns_fail_one_of_twelve(frame):
    six = frame([(u, m, r, t, u, m) for u, m, r, t in good_rows()],
                "userId long, movieId long, rating double, timestamp long, user_idx long, movie_idx long")
    row = validate.validate(six, "ratings").first()
    assert (row["valid"], row["evaluated_expectations"], row["successful_expectations"], row["failed_expectations"]) \
        == (False, 12, 11, 1)
    assert round(row["success_rate"], 1) == 91.7
    assert [f["expectation_type"] for f in row["failures"]] == ["expect_table_columns_to_match_ordered_list"]
    assert validate.validate(six.select("user_idx", "movie_idx", "rating", "timestamp"), "ratings").first()["valid"]


def test_movies_pass_nine_of_nine(frame):
    movies = frame([(i, i + 100, f"T{i}", "A") for i in range(100)],
                   "movie_idx long, movieId long, title string, genres string")
    row = validate.validate(movies.select("genres", "title", "movieId", "movie_idx"), "movies").first()
    assert (row["valid"], row["evaluated_expectations"], row["success_rate"]) == (True, 9, 100.0)


def test_every_ratings_check_can_fail(frame):
    rows = [(None, None, None, None), (-1, -1, 9.0, 5), (1, 1, 0.75, 800_000_000), (2, 2, 1.0, 800_000_000),
            (2, 2, 1.0, 800_000_000)]
    results = validate.run_suite(frame(rows, RATINGS), validate.suite_for("ratings")).collect()
    by = {(r["expectation_type"], r["column"]): r for r in results}
    null = "expect_column_values_to_not_be_null"
    assert all(by[null, c]["unexpected_count"] == 1 for c in ("user_idx", "movie_idx", "rating", "timestamp"))
    between = "expect_column_values_to_be_between"
    assert by[between, "rating"]["unexpected_count"] == 1 and by[between, "rating"]["missing_count"] == 1
    assert by["expect_column_values_to_be_in_set", "rating"]["unexpected_count"] == 2
    assert by[between, "timestamp"]["unexpected_count"] == 1
    repeated = by["expect_compound_columns_to_be_unique", "user_idx,movie_idx,timestamp"]
    assert (repeated["unexpected_count"], repeated["unexpected_percent"]) == (2, 40.0)
    assert not by["expect_table_row_count_to_be_between", "N/A"]["success"]
    assert sum(r["success"] for r in results) == 1


def test_runs_by_key_equal_runs_alone(frame):
    rows = [(u, m, r, t, m % 2) for u, m, r, t in good_rows(60)] + [(1, 1, 9.0, 5, 0), (1, 1, 9.0, 5, 0)]
    df = frame(rows, RATINGS + ", run long")
    suite = validate.suite_for("ratings")
    together = validate.run_suite(df, suite, by=["run"])
    for run in (0, 1):
        alone = validate.run_suite(df.where(f"run = {run}").drop("run"), suite)
        assert tuples(together.where(f"run = {run}").drop("run")) == tuples(alone)


def test_empty_table(spark):
    results = validate.run_suite(spark.createDataFrame([], RATINGS), validate.suite_for("ratings"))
    assert [r["expectation_type"] for r in results.where("NOT success").collect()] == [
        "expect_table_row_count_to_be_between"]


def test_checks_of_absent_columns_fail(frame):
    results = validate.run_suite(frame([(1, 2.5)], "user_idx long, rating double"), validate.suite_for("ratings"))
    failed = {(r["expectation_type"], r["column"]) for r in results.where("NOT success").collect()}
    assert ("expect_column_values_to_not_be_null", "movie_idx") in failed
    assert ("expect_compound_columns_to_be_unique", "user_idx,movie_idx,timestamp") in failed
    assert ("expect_column_values_to_not_be_null", "user_idx") not in failed


def test_unknown_kind():
    with pytest.raises(ValueError, match="Invalid data_type: users"):
        validate.suite_for("users")


def test_history_keeps_every_run(spark, frame, tmp_path):
    path = str(tmp_path / "history")
    good, bad = frame(good_rows(), RATINGS), frame(good_rows(10), RATINGS)
    for df, hour in ((bad, 1), (good, 5)):
        validate.record_run(validate.validate(df, "ratings"), "ratings", datetime(2024, 1, 1, hour), path)
    runs = spark.read.parquet(path)
    assert [r["valid"] for r in validate.run_list(runs).collect()] == [True, False]
    row = validate.history(runs).first()
    assert (row["runs"], row["pass_rate"], row["latest_valid"]) == (2, 0.5, True)


def test_csv_with_an_unreadable_number_shows_as_null(spark, tmp_path):
    (tmp_path / "r.csv").write_text("user_idx,movie_idx,rating,timestamp\n1,2,bad,800000000\n1,3,2.5,800000000\n")
    df = read_for_validation(spark, str(tmp_path / "r.csv"))
    row = {r["column"]: r for r in validate.run_suite(df, validate.suite_for("ratings")).collect()
           if r["expectation_type"] == "expect_column_values_to_not_be_null"}
    assert row["rating"]["unexpected_count"] == 1 and row["user_idx"]["unexpected_count"] == 0
