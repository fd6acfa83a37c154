"""Registered queries: table expectations and event rules."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.functions.scalars import HALF_STARS
from marquee.operators import clean, validate
from marquee.plans.common import EVENTS, MOVIES, RATINGS, Query, rounded, sql
from marquee.session import scratch_path
from marquee.sources import proxies

NOW = 1706140800.0  # 2024-01-25

_RESULT = ["check", "expectation_type", "column", "success", "element_count", "missing_count",
           "unexpected_count", "unexpected_percent"]


def _ratings_with_ids(spark: SparkSession, folder: str) -> DataFrame:
    """Six columns, as cleaning leaves them."""
    raw = proxies.raw_ratings(spark, folder)
    return raw.withColumn("user_idx", F.col("userId")).withColumn("movie_idx", F.col("movieId"))


def validate_ratings(spark: SparkSession, folder: str) -> DataFrame:
    rows = clean.validated_form(_ratings_with_ids(spark, folder))
    return rounded(validate.run_suite(rows, validate.suite_for("ratings")).select(_RESULT))


def validate_ratings_six_columns(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(validate.run_suite(_ratings_with_ids(spark, folder),
                                      validate.suite_for("ratings")).select(_RESULT))


def validate_movies(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(validate.run_suite(proxies.movies(spark, folder), validate.suite_for("movies")).select(_RESULT))


def validation_summary(spark: SparkSession, folder: str) -> DataFrame:
    parts = [validate.validate(rows, kind).withColumn("dataset", F.lit(name)) for name, kind, rows in (
        ("ratings", "ratings", _ratings_with_ids(spark, folder)),
        ("movies", "movies", proxies.movies(spark, folder)))]
    named = parts[0].unionByName(parts[1])
    return rounded(named.withColumn("failures", F.concat_ws(";", "failures.expectation_type")))


def _yearly(spark: SparkSession, folder: str) -> DataFrame:
    """Each order year checked as a run of its own, at the year's end."""
    rows = proxies.ratings(spark, folder).withColumn(
        "run_year", F.year(F.timestamp_seconds("timestamp")))
    results = validate.run_suite(rows, validate.suite_for("ratings"), by=["run_year"])
    return validate.summarise(results, by=["run_year"]).withColumn(
        "dataset", F.lit("ratings")).withColumn(
        "run_time", F.make_timestamp(F.col("run_year"), F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0)))


def validation_by_year(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(_yearly(spark, folder).select(
        "run_year", "valid", "evaluated_expectations", "successful_expectations", "failed_expectations",
        "success_rate", F.concat_ws(";", "failures.expectation_type").alias("failures")))


def validation_history(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "history")
    _yearly(spark, folder).drop("run_year").write.parquet(path)
    return rounded(validate.history(spark.read.parquet(path)).select(
        "dataset", F.date_format("day", "yyyy-MM-dd").alias("day"), "runs", "pass_rate",
        "latest_valid", "latest_success_rate"))


def service_events(events: DataFrame) -> DataFrame:
    """Events in service form, with the faults the rules look for."""
    k = F.col("movie_idx")
    kind = F.when(F.col("event_type") == "purchase", "rating").when(
        F.col("event_type") == "signup", "search").otherwise(F.col("event_type"))
    seconds = F.unix_micros("ts") / 1_000_000
    return events.select(
        "event_id",
        (F.col("user_idx") - 3).alias("user_idx"),
        F.when(k != 13, k - 1).alias("movie_idx"),
        F.when(k != 14, kind).alias("event_type"),
        F.when(k == 5, seconds - 1_500_000_000).otherwise(seconds).alias("timestamp"),
        F.when(k % 7 != 0, F.when(k % 2 == 0, F.floor(F.col("value") / 10) * 0.5)
               .otherwise(F.col("value") / 20)).alias("rating"))


def validate_events(spark: SparkSession, folder: str) -> DataFrame:
    checked = validate.validate_events(service_events(proxies.events(spark, folder)), NOW)
    return checked.select("event_id", "valid", F.concat_ws("; ", "errors").alias("errors"))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    validate_ratings, validate_ratings_six_columns, validate_movies, validation_summary,
    validation_by_year, validation_history, validate_events)}


def _row(n: int, kind: str, column: str, table: str, bad: str = "0", missing: str = "0",
         success: str | None = None, by: str = "") -> str:
    """One result row; ``bad`` counts what breaks the check."""
    group = f" GROUP BY {by}" if by else ""
    keep = f"{by}, " if by else ""
    return f"""SELECT {keep}{n} AS "check", '{kind}' AS expectation_type, '{column}' AS "column",
        {success or f"({bad}) = 0"} AS success, count(*) AS element_count,
        CAST({missing} AS BIGINT) AS missing_count, CAST({bad} AS BIGINT) AS unexpected_count,
        round(coalesce(({bad}) * CAST(100 AS DOUBLE) / nullif(count(*), 0), 0), 6) AS unexpected_percent
        FROM {table}{group}"""


def _checks(table: str, entries: list[tuple], by: str = "") -> str:
    rows = []
    for n, (kind, columns, condition) in enumerate(entries):
        if kind in ("ordered_list", "set_columns"):
            name = {"ordered_list": "expect_table_columns_to_match_ordered_list",
                    "set_columns": "expect_table_columns_to_match_set"}[kind]
            rows.append(_row(n, name, "N/A", table, success=condition, by=by))
        elif kind == "rows":
            rows.append(_row(n, "expect_table_row_count_to_be_between", "N/A", table,
                             success=f"count(*) {condition}", by=by))
        elif kind == "unique":
            name = ("expect_column_values_to_be_unique" if "," not in columns
                    else "expect_compound_columns_to_be_unique")
            same = " AND ".join(f'd."{c}" = {table}."{c}"' for c in [by, *columns.split(",")] if c)
            keys = ", ".join(f'"{c}"' for c in [by, *columns.split(",")] if c)
            repeated = f"(SELECT {keys} FROM {table} GROUP BY {keys} HAVING count(*) > 1) d"
            bad = "coalesce(sum(CASE WHEN is_repeated THEN 1 ELSE 0 END), 0)"
            flagged = (f"(SELECT {table}.*, EXISTS (SELECT 1 FROM {repeated} WHERE {same}) AS is_repeated"
                       f" FROM {table})")
            rows.append(_row(n, name, columns, flagged, bad=bad, by=by))
        else:
            missing = f'count(*) FILTER (WHERE "{columns}" IS NULL)'
            rows.append(_row(n, kind, columns, table, bad=f"count(*) FILTER (WHERE {condition})", missing=missing, by=by))
    return " UNION ALL ".join(rows)


_NULL = "expect_column_values_to_not_be_null"
_BETWEEN = "expect_column_values_to_be_between"
_HALVES = ", ".join(str(v) for v in HALF_STARS)


def _ratings_entries(ordered: str) -> list[tuple]:
    return [
        ("ordered_list", "", ordered),
        *[(_NULL, c, f'"{c}" IS NULL') for c in ("user_idx", "movie_idx", "rating", "timestamp")],
        (_BETWEEN, "rating", "rating NOT BETWEEN 0.5 AND 5.0"),
        ("expect_column_values_to_be_in_set", "rating", f"rating NOT IN ({_HALVES})"),
        (_BETWEEN, "user_idx", "user_idx < 0"),
        (_BETWEEN, "movie_idx", "movie_idx < 0"),
        (_BETWEEN, "timestamp", '"timestamp" NOT BETWEEN 788918400 AND 1735689600'),
        ("unique", "user_idx,movie_idx,timestamp", ""),
        ("rows", "", "BETWEEN 1000 AND 30000000"),
    ]


_MOVIES_ENTRIES = [
    ("set_columns", "", "TRUE"),
    *[(_NULL, c, f'"{c}" IS NULL') for c in ("movie_idx", "movieId", "title")],
    ("unique", "movie_idx", ""),
    ("unique", "movieId", ""),
    (_BETWEEN, "movie_idx", "movie_idx < 0"),
    ("expect_column_value_lengths_to_be_between", "title", "length(title) < 1"),
    ("rows", "", "BETWEEN 100 AND 100000"),
]

_SUMMARY = """bool_and(success) AS valid, count(*) AS evaluated_expectations,
    count(*) FILTER (WHERE success) AS successful_expectations, count(*) FILTER (WHERE NOT success) AS failed_expectations,
    round(count(*) FILTER (WHERE success) * CAST(100 AS DOUBLE) / count(*), 6) AS success_rate,
    coalesce(string_agg(expectation_type, ';' ORDER BY "check") FILTER (NOT success), '') AS failures"""

_YEARS = """yr AS (SELECT *, year(to_timestamp("timestamp") AT TIME ZONE 'UTC') AS run_year FROM ratings)"""
_RUNS = f"""runs AS (SELECT run_year, {_SUMMARY}
    FROM ({_checks("yr", _ratings_entries("TRUE"), by="run_year")}) GROUP BY run_year)"""

_SERVICE = """svc0 AS (SELECT event_id, user_idx - 3 AS user_idx,
    CASE WHEN movie_idx <> 13 THEN movie_idx - 1 END AS movie_idx,
    CASE WHEN movie_idx <> 14 THEN CASE event_type WHEN 'purchase' THEN 'rating' WHEN 'signup' THEN 'search'
         ELSE event_type END END AS event_type,
    CASE WHEN movie_idx = 5 THEN epoch_us(ts) / CAST(1000000 AS DOUBLE) - 1500000000
         ELSE epoch_us(ts) / CAST(1000000 AS DOUBLE) END AS t,
    CASE WHEN movie_idx % 7 <> 0 THEN CASE WHEN movie_idx % 2 = 0 THEN floor("value" / 10) * 0.5
         ELSE "value" / 20 END END AS rating FROM ev),
svc AS (SELECT *, CAST(t AS VARCHAR) AS t_text FROM svc0)"""

ORACLES: dict[str, str] = {
    "validate_ratings": sql(_checks("ratings", _ratings_entries("TRUE")), RATINGS),
    "validate_ratings_six_columns": sql(_checks("ratings", _ratings_entries("FALSE")), RATINGS),
    "validate_movies": sql(_checks("movies", _MOVIES_ENTRIES), MOVIES),
    "validation_summary": sql(f"""SELECT 'ratings' AS dataset, {_SUMMARY}
        FROM ({_checks("ratings", _ratings_entries("FALSE"))})
        UNION ALL SELECT 'movies', {_SUMMARY} FROM ({_checks("movies", _MOVIES_ENTRIES)})""", RATINGS, MOVIES),
    "validation_by_year": sql("SELECT * FROM runs", RATINGS, _YEARS, _RUNS),
    "validation_history": sql("""SELECT 'ratings' AS dataset, run_year || '-12-31' AS "day",
        CAST(1 AS BIGINT) AS runs, CAST(valid::INT AS DOUBLE) AS pass_rate, valid AS latest_valid,
        success_rate AS latest_success_rate FROM runs""", RATINGS, _YEARS, _RUNS),
    "validate_events": sql("""SELECT event_id, errors = '' AS valid, errors FROM (
        SELECT event_id, CASE WHEN movie_idx IS NULL OR event_type IS NULL THEN concat_ws('; ',
            CASE WHEN movie_idx IS NULL THEN 'Missing required field: movie_idx' END,
            CASE WHEN event_type IS NULL THEN 'Missing required field: event_type' END)
        ELSE concat_ws('; ',
            CASE WHEN event_type NOT IN ('rating', 'view', 'click', 'search')
                 THEN 'Invalid event_type: ' || event_type END,
            CASE WHEN event_type = 'rating' THEN CASE
                 WHEN rating IS NULL THEN 'Rating event missing ''rating'' field'
                 WHEN rating < 0.5 OR rating > 5 THEN 'Rating out of range: ' || CAST(rating AS VARCHAR)
                 WHEN floor(rating * 2) <> rating * 2
                 THEN 'Rating not in 0.5 increments: ' || CAST(rating AS VARCHAR) END END,
            CASE WHEN user_idx < 0 THEN 'Invalid user_idx: ' || user_idx END,
            CASE WHEN movie_idx < 0 THEN 'Invalid movie_idx: ' || movie_idx END,
            CASE WHEN t > 1706140860 THEN 'Timestamp in future: ' || t_text END,
            CASE WHEN t < 788918400 THEN 'Timestamp too old: ' || t_text END) END AS errors
        FROM svc)""", EVENTS, _SERVICE),
}
