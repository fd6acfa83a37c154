"""Event topics: JSON in the message value, newest offset first time only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import DataStreamWriter
from pyspark.sql.types import StringType, StructField, StructType

from marquee import schemas
from marquee.functions.scalars import epoch_to_timestamp, iso_to_timestamp, timestamp_to_epoch

TOPIC = "movie_events"
# The error of a message that is not read as an event.
NO_EVENT = "Message holds no event"


def topic_options(servers: str, topic: str = TOPIC, starting: str = "latest", group: str | None = None,
                  most_per_batch: int | None = None) -> dict[str, str]:
    """How a topic is read: where from, as which consumer group, how many messages a micro-batch."""
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if group:
        options["kafka.group.id"] = group
    if most_per_batch:
        options["maxOffsetsPerTrigger"] = str(most_per_batch)
    return options


def read_topic(spark: SparkSession, servers: str, topic: str = TOPIC, starting: str = "latest",
               group: str | None = None, most_per_batch: int | None = None) -> DataFrame:
    """Raw messages. The query's checkpoint holds the position after the start."""
    options = topic_options(servers, topic, starting, group, most_per_batch)
    return spark.readStream.format("kafka").options(**options).load()


def with_event_time(events: DataFrame) -> DataFrame:
    """Add ``ts``, whether ``timestamp`` holds ISO text or epoch seconds."""
    given = F.col("timestamp")
    is_text = isinstance(events.schema["timestamp"].dataType, StringType)
    return events.withColumn("ts", iso_to_timestamp(given) if is_text else epoch_to_timestamp(given))


def service_form(events: DataFrame) -> DataFrame:
    """Events with ``timestamp`` in epoch seconds, as the event rules read it."""
    return with_event_time(events).withColumn("timestamp", timestamp_to_epoch(F.col("ts")))


def decode(messages: DataFrame, schema: StructType = schemas.PRODUCED_EVENT, keep_value: bool = False) -> DataFrame:
    """JSON values to typed events with a real event time ``ts``; values that are none are left to ``malformed``.

    ``keep_value`` keeps the raw text beside what was read from it.
    """
    value = [F.col("value").cast("string").alias("value")] if keep_value else []
    read = messages.select(_parsed(messages, schema), *value).where(~_is_malformed())
    return with_event_time(read.select("event.*", *["value" for _ in value]).drop(_BAD))


_BAD = "_malformed"


def _parsed(messages: DataFrame, schema: StructType) -> Column:
    marked = StructType([*schema.fields, StructField(_BAD, StringType())])
    return F.from_json(F.col("value").cast("string"), marked, {"columnNameOfCorruptRecord": _BAD}).alias("event")


def _is_malformed() -> Column:
    return F.col("event").isNull() | F.col(f"event.{_BAD}").isNotNull()


def malformed(messages: DataFrame, schema: StructType = schemas.PRODUCED_EVENT) -> DataFrame:
    """The raw ``value`` of messages that hold no JSON of the schema, for the table of rejected events."""
    return messages.select(F.col("value").cast("string").alias("value"), _parsed(messages, schema)).where(
        _is_malformed()).select("value")


def encode(events: DataFrame) -> DataFrame:
    """Events as JSON messages keyed by user, so one user's events stay in order."""
    return events.select(
        F.col("user_idx").cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in events.columns])).alias("value"))


def write_topic(events: DataFrame, servers: str, checkpoint: str,
                topic: str = TOPIC) -> DataStreamWriter:
    return (encode(events).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers)
            .option("topic", topic)
            .option("checkpointLocation", checkpoint))
