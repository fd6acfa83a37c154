"""Ratings, movies, events and factors read out of the star-schema tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.functions.genres import NO_GENRES


# Columns the proxies read; declaring them saves a look at the files first.
TABLES = {
    "lineitem": "l_orderkey long, l_partkey long, l_quantity double",
    "orders": "o_orderkey long, o_custkey long, o_orderdate timestamp_ntz",
    "part": "p_partkey long, p_name string, p_type string, p_size int",
    "customer": "c_custkey long",
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "embeddings": "vec_id long, embedding array<float>, label int",
}


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    # The tables hold zone-less UTC times; event-time operators need instants.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.schema(TABLES[name]).parquet(f"{folder}/{name}.parquet")


def raw_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """One rating per order line: the customer rates the part by its quantity."""
    lines = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("o_orderkey"),
        F.col("l_partkey").alias("movieId"),
        (F.floor((F.col("l_quantity") - 1) / 5) * 0.5 + 0.5).cast("double").alias("rating"))
    orders = table(spark, folder, "orders").select(
        "o_orderkey", F.col("o_custkey").alias("userId"),
        F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("timestamp"))
    return lines.join(orders, "o_orderkey").select("userId", "movieId", "rating", "timestamp")


def ratings(spark: SparkSession, folder: str) -> DataFrame:
    """The same ratings under index names; the keys are already 0-based."""
    return raw_ratings(spark, folder).select(
        F.col("userId").alias("user_idx"), F.col("movieId").alias("movie_idx"),
        "rating", "timestamp")


def raw_movies(spark: SparkSession, folder: str) -> DataFrame:
    # Lower case, as column names that differ in case only would collide.
    words = F.concat_ws("|", F.lower("p_type"), F.translate("p_name", " ", "|"))
    return table(spark, folder, "part").select(
        F.col("p_partkey").alias("movieId"),
        F.col("p_name").alias("title"),
        F.when(F.col("p_size") % 17 == 0, NO_GENRES).otherwise(words).alias("genres"))


def movies(spark: SparkSession, folder: str) -> DataFrame:
    return raw_movies(spark, folder).select(
        F.col("movieId").alias("movie_idx"), "movieId", "title", "genres")


def _shape_events(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        F.col("user_id").alias("user_idx"),
        F.get_json_object("props", "$.k").cast("long").alias("movie_idx"),
        "event_type",
        F.col("ts").cast("timestamp").alias("ts"),
        "value")


def events(spark: SparkSession, folder: str) -> DataFrame:
    return _shape_events(table(spark, folder, "events"))


def event_stream(spark: SparkSession, folder: str, glob: str = "events.parquet",
                 files_per_batch: int | None = None) -> DataFrame:
    """The events table read as a stream of files."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    reader = spark.readStream.schema(TABLES["events"]).option("pathGlobFilter", glob)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return _shape_events(reader.parquet(folder))


# The type of an event that says no more than that time has gone on.
TICK = "tick"


# A micro-batch of more events than this has several files, so that several tasks write and read it.
FILE_EVENTS = 100_000


def event_files(spark: SparkSession, folder: str, path: str, files: int, copies: int = 1,
                tick: str | None = None, even: bool = False) -> int:
    """The events table below ``path``, in so many micro-batches by time, each copy after the last.

    Returns the files per micro-batch, the same for all: as many as the largest
    needs. Micro-batches are written one after the other, as a stream takes the
    oldest files first. They hold about as many events each, or, if ``even``,
    equal stretches of time. ``tick`` adds two more of one event of type
    ``TICK`` each, so long after the last.
    """
    rows = table(spark, folder, "events")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    if even:
        ends = rows.agg(F.min(at).alias("a"), F.max(at).alias("b")).first()
        part = F.floor((at - ends["a"]) * files / (ends["b"] - ends["a"] + 1))
    else:
        shares = [k / files for k in range(1, files)]
        edges = rows.agg(F.percentile_approx(at, shares)).first()[0] or []
        part = sum((F.when(at > edge, 1).otherwise(0) for edge in edges), F.lit(0))
    largest = rows.groupBy(part.alias("part")).count().agg(F.max("count")).first()[0] or 0
    each, due = -(-largest // FILE_EVENTS) or 1, 0

    def write(batch: DataFrame) -> None:
        nonlocal due
        (batch.repartition(each) if each > 1 else batch.coalesce(1)).write.mode("append").parquet(path)
        due += each
        # A task without rows writes no file unless it is the only one: empty ones make up the number.
        missing = due - len(spark.read.schema(TABLES["events"]).parquet(path).inputFiles()) if each > 1 else 0
        for _ in range(missing):
            rows.limit(0).coalesce(1).write.mode("append").parquet(path)

    for _ in range(copies):
        for k in range(files):
            write(rows.where(part == k))
    if tick:
        later = rows.agg((F.max("ts") + F.expr(f"INTERVAL {tick}")).alias("ts"), F.lit(TICK).alias("event_type"))
        ticks = rows.limit(0).unionByName(later, allowMissingColumns=True)
        # The first moves the watermark, which holds from the second on.
        for _ in range(2):
            write(ticks)
    return each


def as_requests(events: DataFrame) -> DataFrame:
    """Events as served requests: error events failed, latency from the value."""
    return events.select(
        F.col("event_id").alias("request_id"),
        "ts",
        F.col("event_type").alias("endpoint"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status"),
        (F.col("value") / 1000).alias("latency_s"),
        "user_idx")


def request_log(spark: SparkSession, folder: str) -> DataFrame:
    return as_requests(events(spark, folder))


def factors(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "embeddings").select("vec_id", "embedding", "label")
