"""Descriptive profiles of a table, each from one aggregation or pre-counted values."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import NumericType

from marquee.operators.ordering import exact_quantiles


def value_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def top_values(df: DataFrame, column: str, n: int = 10) -> DataFrame:
    return value_counts(df, column).orderBy(F.desc("n"), column).limit(n)


def histogram(df: DataFrame, column: str = "rating") -> DataFrame:
    return value_counts(df, column).orderBy(column)


def _is_missing(df: DataFrame, column: str) -> Column:
    kind = df.schema[column].dataType.typeName()
    missing = F.col(column).isNull()
    return missing | F.isnan(column) if kind in ("double", "float") else missing


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: its type, non-null and null rows."""
    counted = df.agg(F.count("*").alias("_rows"), *[
        F.count_if(_is_missing(df, c)).alias(f"_{c}") for c in df.columns])
    per_column = F.array(*[
        F.struct(F.lit(f.name).alias("column"), F.lit(f.dataType.simpleString()).alias("type"),
                 (F.col("_rows") - F.col(f"_{f.name}")).alias("non_null"),
                 F.col(f"_{f.name}").alias("nulls"))
        for f in df.schema])
    return counted.select(F.inline(per_column))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("n_rows")).withColumn("n_columns", F.lit(len(df.columns)))


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows beyond the first of each group of equal rows."""
    groups = df.groupBy(*df.columns).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates"))


def distinct_counts(df: DataFrame, columns: Sequence[str], approximate: bool = False) -> DataFrame:
    """Distinct non-null values per column, one row each."""
    if approximate:
        counted = df.agg(*[F.approx_count_distinct(c).alias(c) for c in columns])
        return counted.select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(c).alias("n_distinct")) for c in columns])))
    # One small aggregate per column beats expanding every row once per column.
    parts = [df.groupBy(c).agg(F.lit(1)).agg(F.count(c).alias("n_distinct"))
             .select(F.lit(c).alias("column"), "n_distinct") for c in columns]
    return reduce(DataFrame.unionByName, parts)


def sparsity(ratings: DataFrame, user: str, item: str) -> DataFrame:
    """Share of the user x item grid without a rating."""
    users = ratings.groupBy(user).agg(F.count("*").alias("n")).agg(
        F.count("*").alias("n_users"), F.sum("n").alias("n_ratings"))
    items = ratings.select(item).distinct().agg(F.count("*").alias("n_items"))
    cells = F.col("n_users").cast("double") * F.col("n_items")
    return (users.withColumn("n_items", items.scalar())
            .select("n_ratings", "n_users", "n_items", (1 - F.col("n_ratings") / cells).alias("sparsity")))


def describe(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Count, mean, deviation, extremes and exact quartiles per numeric column."""
    columns = list(columns or [f.name for f in df.schema if isinstance(f.dataType, NumericType)])
    long = df.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("value")) for c in columns])))
    moments = df.agg(*[
        F.struct(F.count(c).alias("count"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"),
                 F.min(c).cast("double").alias("min"), F.max(c).cast("double").alias("max")).alias(c)
        for c in columns])
    moments = moments.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{c}.{m}").alias(m)
                                             for m in ("count", "mean", "std", "min", "max")])
        for c in columns])))
    quartiles = exact_quantiles(long, ["column"], "value", {"q25": 0.25, "q50": 0.5, "q75": 0.75})
    return moments.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")
