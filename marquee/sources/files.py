"""CSV and Parquet tables: ratings, movies, id maps, features, models."""

from __future__ import annotations

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.ml.recommendation import ALSModel
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from marquee import schemas


class MissingTable(FileNotFoundError):
    """The named input path does not exist."""


def _open(read, path: str) -> DataFrame:
    try:
        return read(path)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise MissingTable(path) from error
        raise


def read_csv(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A CSV with a header, matched to the declared schema in column order."""
    reader = spark.read.schema(schema).option("header", True).option("enforceSchema", False)
    return _open(reader.csv, path)


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return _open(spark.read.parquet, path)


def read_ratings(spark: SparkSession, path: str) -> DataFrame:
    """Raw ratings; NaN ratings become null so that means skip them."""
    return read_csv(spark, path, schemas.RAW_RATINGS).withColumn(
        "rating", F.when(~F.isnan("rating"), F.col("rating")))


def read_movies(spark: SparkSession, path: str) -> DataFrame:
    return read_csv(spark, path, schemas.RAW_MOVIES)


def read_for_validation(spark: SparkSession, path: str) -> DataFrame:
    """A CSV with whatever columns its header names, for checks of its shape.

    Only the header line is read to learn the names; known columns get their
    declared type, others stay text.
    """
    known = {f.name: f.dataType for f in schemas.CLEAN_RATINGS.fields + schemas.CLEAN_MOVIES.fields}
    # Without inferSchema Spark looks at the first line only and calls all columns text.
    named = _open(spark.read.option("header", True).csv, path)
    return named.select(*[
        F.col(f"`{c}`").try_cast(known[c]).alias(c) if c in known else F.col(f"`{c}`")
        for c in named.columns])


def write_csv(df: DataFrame, path: str, mode: str = "error") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "error",
                  partition_by: list[str] | None = None) -> None:
    writer = df.write.mode(mode)
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def stamped(features: DataFrame, as_of: datetime) -> DataFrame:
    """Features with an ``event_timestamp``; one already there is kept."""
    if "event_timestamp" in features.columns:
        return features
    return features.withColumn("event_timestamp", F.lit(as_of).cast("timestamp"))


def write_features(features: DataFrame, path: str, as_of: datetime) -> None:
    """Append one feature run, in a folder per day of its event time.

    Re-running a day replaces that day only.
    """
    (stamped(features, as_of)
     .withColumn("as_of_date", F.to_date("event_timestamp"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("as_of_date").parquet(path))


def write_stream_features(features: DataFrame, path: str, as_of: datetime) -> bool:
    """As ``write_features``; an empty set is skipped and answers False."""
    if features.isEmpty():
        return False
    write_features(features, path, as_of)
    return True


def save_model(model: ALSModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> ALSModel:
    return ALSModel.load(path)
