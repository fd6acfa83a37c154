"""Declared expectations over tables, and rules over events.

All row-level checks of a suite share one aggregation pass; only uniqueness
needs a shuffle of its own, over pre-counted keys.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.scalars import HALF_STARS, number_text

# Bounds the checks use, in epoch seconds.
TIME_1995 = 788918400
TIME_2025 = 1735689600
CLOCK_SKEW_SECONDS = 60
EVENT_TYPES = ["rating", "view", "click", "search"]
REQUIRED_FIELDS = ["user_idx", "movie_idx", "event_type", "timestamp"]

# The texts of event errors, most of them followed by the value found.
MISSING_FIELD = "Missing required field: "
BAD_TYPE = "Invalid event_type: "
NO_RATING = "Rating event missing 'rating' field"
RATING_RANGE = "Rating out of range: "
RATING_STEP = "Rating not in 0.5 increments: "
BAD_USER = "Invalid user_idx: "
BAD_MOVIE = "Invalid movie_idx: "
TOO_LATE = "Timestamp in future: "
TOO_OLD = "Timestamp too old: "


@dataclass(frozen=True)
class Expectation:
    """One check; ``kind`` says which of the fields below apply."""

    kind: str
    columns: tuple[str, ...] = ()
    low: float | None = None
    high: float | None = None
    values: tuple = ()

    @property
    def column(self) -> str:
        return ",".join(self.columns) if self.kind in _UNIQUE or self.kind in _ROW_CHECKS else "N/A"

    def detail(self) -> str:
        if self.values:
            return "in " + ", ".join(str(v) for v in self.values)
        if self.low is not None or self.high is not None:
            return f"between {self.low} and {self.high}"
        return "columns " + ", ".join(self.columns) if self.kind in _COLUMN_CHECKS else ""


def _outside(value: Column, check: Expectation) -> Column:
    bounds = []
    if check.low is not None:
        bounds.append(value < check.low)
    if check.high is not None:
        bounds.append(value > check.high)
    return reduce(Column.__or__, bounds)


# Row checks: which values break the expectation. Nulls never do, except for not-null.
_ROW_CHECKS: dict[str, Callable[[Column, Expectation], Column]] = {
    "expect_column_values_to_not_be_null": lambda c, _: c.isNull(),
    "expect_column_values_to_be_between": _outside,
    "expect_column_values_to_be_in_set": lambda c, e: ~c.isin(list(e.values)),
    "expect_column_value_lengths_to_be_between": lambda c, e: _outside(F.length(c), e),
}
_UNIQUE = ("expect_column_values_to_be_unique", "expect_compound_columns_to_be_unique")
_COLUMN_CHECKS: dict[str, Callable[[list[str], Expectation], bool]] = {
    "expect_table_columns_to_match_ordered_list": lambda have, e: have == list(e.columns),
    "expect_table_columns_to_match_set": lambda have, e: set(have) == set(e.columns),
}
_ROW_COUNT = "expect_table_row_count_to_be_between"


def not_null(column: str) -> Expectation:
    return Expectation("expect_column_values_to_not_be_null", (column,))


def between(column: str, low: float | None = None, high: float | None = None) -> Expectation:
    return Expectation("expect_column_values_to_be_between", (column,), low, high)


def in_set(column: str, values: Sequence) -> Expectation:
    return Expectation("expect_column_values_to_be_in_set", (column,), values=tuple(values))


def length_between(column: str, low: int | None = None, high: int | None = None) -> Expectation:
    return Expectation("expect_column_value_lengths_to_be_between", (column,), low, high)


def unique(*columns: str) -> Expectation:
    return Expectation(_UNIQUE[0] if len(columns) == 1 else _UNIQUE[1], columns)


def columns_in_order(*columns: str) -> Expectation:
    return Expectation("expect_table_columns_to_match_ordered_list", columns)


def columns_as_set(*columns: str) -> Expectation:
    return Expectation("expect_table_columns_to_match_set", columns)


def row_count(low: int | None = None, high: int | None = None) -> Expectation:
    return Expectation(_ROW_COUNT, (), low, high)


# Fixed values in both suites: the columns, bounds and row counts expected.
def ratings_suite(latest: int = TIME_2025) -> list[Expectation]:
    return [
        columns_in_order("user_idx", "movie_idx", "rating", "timestamp"),
        *[not_null(c) for c in ("user_idx", "movie_idx", "rating", "timestamp")],
        between("rating", 0.5, 5.0),
        in_set("rating", HALF_STARS),
        between("user_idx", 0),
        between("movie_idx", 0),
        between("timestamp", TIME_1995, latest),
        unique("user_idx", "movie_idx", "timestamp"),
        row_count(1_000, 30_000_000),
    ]


def movies_suite() -> list[Expectation]:
    return [
        columns_as_set("movie_idx", "movieId", "title", "genres"),
        *[not_null(c) for c in ("movie_idx", "movieId", "title")],
        unique("movie_idx"),
        unique("movieId"),
        between("movie_idx", 0),
        length_between("title", 1),
        row_count(100, 100_000),
    ]


SUITES: dict[str, Callable[[], list[Expectation]]] = {
    "ratings": ratings_suite, "movies": movies_suite}


def suite_for(data_type: str) -> list[Expectation]:
    if data_type not in SUITES:
        raise ValueError(f"Invalid data_type: {data_type}. Must be one of {sorted(SUITES)}")
    return SUITES[data_type]()


def _repeated(df: DataFrame, check: Expectation, number: int, by: Sequence[str]) -> DataFrame:
    """Rows whose key occurs more than once; keys with a null are left out."""
    complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in check.columns])
    keys = list(dict.fromkeys([*by, *check.columns]))
    groups = df.where(complete).groupBy(*keys).agg(F.count("*").alias("_n"))
    return groups.groupBy(*by).agg(
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).alias("_repeated")
    ).withColumn("check", F.lit(number))


def run_suite(df: DataFrame, suite: Sequence[Expectation], by: Sequence[str] = ()) -> DataFrame:
    """One row per expectation, and per value of ``by`` if given.

    ``by`` columns mark separate runs inside one table and do not count as
    columns of the data.
    """
    by = list(by)
    have = [c for c in df.columns if c not in by]
    # A check of a column that is not there fails without looking at rows.
    absent = {n for n, check in enumerate(suite)
              if check.kind not in _COLUMN_CHECKS and not set(check.columns) <= set(have)}
    aggregates = [F.count("*").alias("_rows")]
    for number, check in enumerate(suite):
        if number in absent:
            continue
        if check.kind in _ROW_CHECKS:
            value = F.col(check.columns[0])
            aggregates.append(F.count_if(_ROW_CHECKS[check.kind](value, check)).alias(f"_bad_{number}"))
            aggregates.append(F.count_if(value.isNull()).alias(f"_null_{number}"))
        elif check.kind in _UNIQUE:
            missing = reduce(Column.__or__, [F.col(c).isNull() for c in check.columns])
            aggregates.append(F.count_if(missing).alias(f"_null_{number}"))
    measured = df.groupBy(*by).agg(*aggregates)

    rows = F.col("_rows")
    entries = []
    for number, check in enumerate(suite):
        table_level = number in absent or check.kind in _COLUMN_CHECKS or check.kind == _ROW_COUNT
        if number in absent:
            good = F.lit(False)
        elif check.kind in _COLUMN_CHECKS:
            good = F.lit(_COLUMN_CHECKS[check.kind](have, check))
        elif check.kind == _ROW_COUNT:
            good = ~_outside(rows, check)
        else:
            good = F.lit(None).cast("boolean")
        entries.append(F.struct(
            F.lit(number).alias("check"),
            F.lit(check.kind).alias("expectation_type"),
            F.lit(check.column).alias("column"),
            F.lit(check.detail()).alias("detail"),
            good.alias("_good"),
            rows.alias("element_count"),
            (F.lit(0).cast("long") if table_level else F.col(f"_null_{number}")).alias("missing_count"),
            (F.col(f"_bad_{number}") if check.kind in _ROW_CHECKS and not table_level
             else F.lit(0).cast("long")).alias("_bad")))
    results = measured.select(*by, F.inline(F.array(*entries)))

    uniqueness = [_repeated(df, check, n, by) for n, check in enumerate(suite)
                  if check.kind in _UNIQUE and n not in absent]
    if uniqueness:
        repeated = reduce(DataFrame.unionByName, uniqueness)
        is_unique = F.col("expectation_type").isin(*_UNIQUE)
        results = results.join(repeated, [*by, "check"], "left").withColumn(
            "_bad", F.when(is_unique, F.coalesce("_repeated", F.lit(0))).otherwise(F.col("_bad")))
    bad = F.col("_bad")
    return results.select(
        *by, "check", "expectation_type", "column", "detail",
        F.coalesce("_good", bad == 0).alias("success"),
        "element_count", "missing_count", bad.alias("unexpected_count"),
        F.coalesce(F.try_divide(bad * 100.0, "element_count"), F.lit(0.0)).alias("unexpected_percent"))


def summarise(results: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Verdict, counts, success rate and the failed checks, per run."""
    failed = F.when(~F.col("success"), F.struct(
        "check", "expectation_type", "column",
        F.concat_ws("; ", "detail",
                    F.when(F.col("unexpected_count") > 0,
                           F.concat(F.lit("unexpected "), F.col("unexpected_count")))).alias("details")))
    return results.groupBy(*by).agg(
        F.bool_and("success").alias("valid"),
        F.count("*").alias("evaluated_expectations"),
        F.count_if("success").alias("successful_expectations"),
        F.count_if(~F.col("success")).alias("failed_expectations"),
        (F.count_if("success") * 100.0 / F.count("*")).alias("success_rate"),
        F.transform(F.array_sort(F.collect_list(failed)), lambda f: f.dropFields("check")).alias("failures"))


def validate(df: DataFrame, data_type: str) -> DataFrame:
    return summarise(run_suite(df, suite_for(data_type)))


def record_run(summary: DataFrame, dataset: str, run_time: datetime, path: str) -> None:
    """Append one validation result to the history table."""
    (summary.withColumn("dataset", F.lit(dataset))
     .withColumn("run_time", F.lit(run_time).cast("timestamp"))
     .write.mode("append").parquet(path))


def run_list(results: DataFrame) -> DataFrame:
    """All recorded runs, newest first."""
    return results.orderBy(F.desc("run_time"), "dataset")


def history(results: DataFrame) -> DataFrame:
    """Per dataset and day: runs, share that passed, and the latest run's figures."""
    latest = F.max_by(F.struct("run_time", "valid", "success_rate"), "run_time")
    return (results.groupBy("dataset", F.to_date("run_time").alias("day"))
            .agg(F.count("*").alias("runs"), F.avg(F.col("valid").cast("int")).alias("pass_rate"),
                 latest.alias("latest"))
            .select("dataset", "day", "runs", "pass_rate",
                    F.col("latest.run_time").alias("latest_run"),
                    F.col("latest.valid").alias("latest_valid"),
                    F.col("latest.success_rate").alias("latest_success_rate")))


def validate_events(events: DataFrame, now: float, allowed_types: Sequence[str] = EVENT_TYPES,
                    half_stars: Sequence[float] = HALF_STARS) -> DataFrame:
    """Add ``errors`` and ``valid``; a missing field hides all other errors.

    ``timestamp`` is epoch seconds. A null optional rating counts as missing.
    """
    kind, rating, time = F.col("event_type"), F.col("rating"), F.col("timestamp")

    def error(condition: Column, text: str, found: Column | None = None) -> Column:
        return F.when(condition, F.lit(text) if found is None else F.concat(F.lit(text), found))

    missing = F.array_compact(F.array(*[
        error(F.col(f).isNull(), MISSING_FIELD + f) for f in REQUIRED_FIELDS]))
    rating_error = F.when(kind == "rating", F.coalesce(
        error(rating.isNull(), NO_RATING),
        error(~rating.between(min(half_stars), max(half_stars)), RATING_RANGE, number_text(rating)),
        error(~rating.isin(list(half_stars)), RATING_STEP, number_text(rating))))
    broken = F.array_compact(F.array(
        error(~kind.isin(list(allowed_types)), BAD_TYPE, kind),
        rating_error,
        error(F.col("user_idx") < 0, BAD_USER, F.col("user_idx").cast("string")),
        error(F.col("movie_idx") < 0, BAD_MOVIE, F.col("movie_idx").cast("string")),
        error(time > now + CLOCK_SKEW_SECONDS, TOO_LATE, number_text(time)),
        error(time < TIME_1995, TOO_OLD, number_text(time))))
    return (events.withColumn("errors", F.when(F.size(missing) > 0, missing).otherwise(broken))
            .withColumn("valid", F.size("errors") == 0))


def good_and_bad(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    return checked.where("valid").drop("errors", "valid"), checked.where("NOT valid").drop("valid")
