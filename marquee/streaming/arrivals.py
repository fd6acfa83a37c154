"""Uniqueness of keys over arrivals: each one is checked against all before it."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.streaming.sinks import BatchTable, BucketedTable


class KeyIndex:
    """How often each key has come so far, in buckets, of which an arrival reads and writes those it touches.

    ``bucket`` is a whole number that follows from the key (by default one of 64,
    by its hash). Where keys hold a time that goes on with the arrivals, its day
    keeps all older buckets closed. Keys with a null are not compared. An arrival
    that comes again starts from what was before it and writes the same.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], bucket: Column | None = None):
        self.keys = list(keys)
        self.counts = BucketedTable(spark, f"{path}/keys", keys, bucket=bucket)
        self.results = BatchTable(spark, f"{path}/results")

    def write(self, rows: DataFrame, arrival: int) -> None:
        """Take the rows of an arrival; arrivals are numbered upwards."""
        whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in self.keys])
        # Summed before they meet the index, so a key with most rows is one row.
        own = rows.groupBy(*self.keys).agg(F.count("*").alias("came")).persist()
        kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema if f.name in self.keys)
        before = self.counts.lookup(own.where(whole), arrival, f"{kinds}, seen long")
        seen, earlier = F.col("seen"), F.col("seen") - F.col("came")
        met = own.join(before, self.keys, "left").select(
            *self.keys, "came", (F.coalesce("seen", F.lit(0)) + F.col("came")).alias("seen")).persist()
        self.counts.write(met.where(whole).select(*self.keys, "seen"), arrival)
        growth = F.when(seen > 1, seen).otherwise(0) - F.when(earlier > 1, earlier).otherwise(0)

        def total(value: Column) -> Column:
            return F.coalesce(F.sum(value), F.lit(0)).cast("long")

        self.results.write(met.agg(
            F.lit(arrival).cast("long").alias("arrival"), total(F.col("came")).alias("element_count"),
            total(F.when(~whole, F.col("came"))).alias("missing_count"),
            total(F.when(whole & (seen > 1), F.col("came"))).alias("repeated_rows"),
            total(F.when(whole, growth)).alias("more_repeated")), arrival)
        met.unpersist()
        own.unpersist()

    def read(self) -> DataFrame:
        """Per arrival: its rows, those without a key, those whose key came before or more than once, and the growth.

        ``more_repeated`` summed up is what a check of the whole table counts.
        """
        return self.results.read().select("arrival", "element_count", "missing_count", "repeated_rows", "more_repeated")

    def unexpected(self, upto: int | None = None) -> int:
        """Rows of all arrivals so far whose key is not unique among them."""
        found = self.read()
        found = found if upto is None else found.where(F.col("arrival") <= upto)
        return found.agg(F.sum("more_repeated")).first()[0] or 0
