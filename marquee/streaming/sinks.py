"""Starting streaming queries, and tables their micro-batches write to."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from marquee.operators.store import latest_per_key
from marquee.session import scratch_path
from marquee.sources.files import MissingTable, read_parquet

# A keyed table writes its state anew after so many micro-batches.
COMPACT_EVERY = 20

BatchWriter = Callable[[DataFrame, int], None]

_ROCKSDB = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # All stores of an executor share 500 MB; without it each may fill buffers of its own.
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
}


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep state off the heap, in bounded memory, with changes rather than snapshots checkpointed."""
    for name, value in _ROCKSDB.items():
        spark.conf.set(name, value)


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """Queries started inside keep their state as ``use_rocksdb_state`` says; afterwards all is as before."""
    before = {name: spark.conf.get(name, None) for name in _ROCKSDB}
    use_rocksdb_state(spark)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def start(stream: DataFrame, write: BatchWriter, mode: str = "update",
          checkpoint: str | None = None, every: str | None = None) -> StreamingQuery:
    """Run ``write`` per micro-batch; without ``every``, up to the data there now."""
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return (stream.writeStream.outputMode(mode).foreachBatch(write)
            .option("checkpointLocation", checkpoint or scratch_path(stream.sparkSession, "stream"))
            .trigger(**trigger).start())


def drain(stream: DataFrame, write: BatchWriter, mode: str = "update",
          checkpoint: str | None = None) -> StreamingQuery:
    """Process all data there now and return the ended query."""
    query = start(stream, write, mode, checkpoint)
    query.awaitTermination()
    return query


class BatchTable:
    """One folder per micro-batch; a replayed batch overwrites its own folder only."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def write(self, rows: DataFrame, batch_id: int) -> None:
        rows.write.mode("overwrite").parquet(f"{self.path}/batches/batch_id={batch_id}")

    def read(self) -> DataFrame:
        return read_parquet(self.spark, f"{self.path}/batches").drop("batch_id")

    def read_batch(self, batch_id: int) -> DataFrame:
        """What one micro-batch wrote."""
        return read_parquet(self.spark, f"{self.path}/batches/batch_id={batch_id}")


class KeyedTable(BatchTable):
    """The newest row per key of all micro-batches.

    Every ``compact_every`` batches the state is written anew, so a read takes
    one snapshot and fewer batches than that, however long the stream runs. A
    replayed batch writes the same snapshot again.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], compact_every: int = COMPACT_EVERY,
                 keep: Callable[[DataFrame], DataFrame] | None = None):
        """``keep`` says which rows a snapshot takes along; the others are left behind for good."""
        super().__init__(spark, path)
        self.keys, self.compact_every, self.keep = list(keys), compact_every, keep

    def write(self, rows: DataFrame, batch_id: int) -> None:
        super().write(rows, batch_id)
        if (batch_id + 1) % self.compact_every == 0:
            self.compact(batch_id)

    def _versions(self, before: int | None) -> DataFrame:
        """Rows with the batch they come from: the last snapshot and all later batches."""
        parts, since = [], None
        try:
            snapshots = read_parquet(self.spark, f"{self.path}/snapshots")
            usable = snapshots if before is None else snapshots.where(F.col("upto") < before)
            since = usable.agg(F.max("upto").alias("upto")).first()["upto"]
            if since is not None:
                parts.append(snapshots.where(F.col("upto") == since).withColumnRenamed("upto", "batch_id"))
        except MissingTable:
            pass
        batches = read_parquet(self.spark, f"{self.path}/batches")
        if since is not None:
            batches = batches.where(F.col("batch_id") > since)
        if before is not None:
            batches = batches.where(F.col("batch_id") < before)
        return reduce(DataFrame.unionByName, [*parts, batches])

    def read(self, before: int | None = None) -> DataFrame:
        """Latest rows, or those as they stood before a batch."""
        return latest_per_key(self._versions(before), self.keys, "batch_id").drop("batch_id")

    def compact(self, upto: int) -> None:
        """Write the state after batch ``upto`` so that reads can skip older batches."""
        rows = self.read(upto + 1)
        (self.keep(rows) if self.keep else rows).write.mode("overwrite").parquet(
            f"{self.path}/snapshots/upto={upto}")


class BucketedTable:
    """The newest row per key, in buckets of the key; a push writes only the buckets it touches.

    Each push has a version of its own: the touched buckets, written anew, and a
    manifest that says which version every bucket is of. A replayed push starts
    from the manifest before it and writes the same version again; readers see
    a push once its manifest is there, so never half of it. ``bucket`` is another
    whole number to go by, which must follow from the key: a day in it, for
    instance, where pushes hold few days.
    """

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64,
                 bucket: Column | None = None):
        self.spark, self.path, self.keys = spark, path, list(keys)
        self.bucket = F.pmod(F.xxhash64(*self.keys), F.lit(buckets)) if bucket is None else bucket

    def _bucketed(self, rows: DataFrame) -> DataFrame:
        return rows.withColumn("_bucket", self.bucket.cast("int"))

    def versions(self, before: int | None = None) -> dict[int, int]:
        """Bucket to version: one small number each."""
        try:
            manifests = read_parquet(self.spark, f"{self.path}/manifests")
        except MissingTable:
            return {}
        usable = manifests if before is None else manifests.where(F.col("push") < before)
        newest = usable.agg(F.max("push")).scalar()
        return dict(usable.where(F.col("push") == newest).select("bucket", "version").collect())

    def _folders(self, versions: dict[int, int]) -> list[str]:
        return [f"{self.path}/data/version={v}/_part={b}" for b, v in sorted(versions.items())]

    def write(self, rows: DataFrame, push: int) -> None:
        """Rows win over those of their keys so far; of several with a key in one push, any one."""
        new = self._bucketed(rows).persist()
        versions = self.versions(push)
        touched = [b for b, in new.select("_bucket").distinct().collect()]
        old = self._folders({b: versions[b] for b in touched if b in versions})
        both = new.withColumn("_new", F.lit(1))
        if old:
            kept = self._bucketed(self.spark.read.schema(rows.schema).parquet(*old))
            both = both.unionByName(kept.withColumn("_new", F.lit(0)))
        newest = latest_per_key(both, [*self.keys, "_bucket"], "_new").drop("_new")
        (newest.repartition("_bucket").withColumnRenamed("_bucket", "_part")
         .write.partitionBy("_part").mode("overwrite").parquet(f"{self.path}/data/version={push}"))
        new.unpersist()
        now = {**versions, **{b: push for b in touched}}
        self.spark.createDataFrame(sorted(now.items()), "bucket int, version long").coalesce(1).write.mode(
            "overwrite").parquet(f"{self.path}/manifests/push={push}")

    def read(self) -> DataFrame:
        versions = self.versions()
        if not versions:
            raise MissingTable(self.path)
        return self.spark.read.parquet(*self._folders(versions))

    def lookup(self, wanted: DataFrame, before: int | None = None, schema: str | None = None) -> DataFrame:
        """Rows of the keys in ``wanted``, from the buckets that can hold them; as they were ``before`` a push.

        With ``schema`` a table without rows so far gives none.
        """
        some = [b for b, in self._bucketed(wanted).select("_bucket").distinct().collect()]
        versions = {b: v for b, v in self.versions(before).items() if b in some}
        if versions:
            rows = self.spark.read.parquet(*self._folders(versions))
        else:
            rows = self.spark.createDataFrame([], schema) if schema else self.read().limit(0)
        return rows.join(wanted.select(*self.keys).distinct(), self.keys, "left_semi")

    def unused(self) -> list[int]:
        """Versions that the newest manifest names for no bucket; they may go once no replay can need them."""
        try:
            pushes = read_parquet(self.spark, f"{self.path}/manifests").select("push").distinct()
        except MissingTable:
            return []
        needed = set(self.versions().values())
        return sorted(v for v, in pushes.collect() if v not in needed)


class Progress(StreamingQueryListener):
    """Running totals of each query, over all of its micro-batches.

    Spark itself remembers the last hundred only. Add it with
    ``spark.streams.addListener`` before the query starts.
    """

    def __init__(self):
        self.totals: dict[str, dict[str, int]] = {}

    def onQueryStarted(self, event) -> None:
        self.totals.setdefault(str(event.id), {"batches": 0, "rows": 0, "milliseconds": 0, "late_rows": 0})

    def onQueryProgress(self, event) -> None:
        p = event.progress
        total = self.totals.setdefault(str(p.id), {"batches": 0, "rows": 0, "milliseconds": 0, "late_rows": 0})
        total["batches"] += 1
        total["rows"] += p.numInputRows
        total["milliseconds"] += p.batchDuration
        total["late_rows"] += sum(op.numRowsDroppedByWatermark for op in p.stateOperators)

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def rows_per_second(self, query: StreamingQuery) -> float:
        total = self.totals[str(query.id)]
        return total["rows"] * 1000 / max(total["milliseconds"], 1)

    def late_rows(self, query: StreamingQuery) -> int:
        """Rows dropped as later than the watermark."""
        return self.totals[str(query.id)]["late_rows"]


def late_rows(query: StreamingQuery) -> int:
    """Rows that an ended query of at most a hundred micro-batches dropped; ``Progress`` counts any number."""
    return sum(op["numRowsDroppedByWatermark"] for p in query.recentProgress for op in p["stateOperators"])


def throughput(query: StreamingQuery) -> list[dict]:
    """Rows and rows per second of the last micro-batches; ``Progress`` sums up all."""
    return [{"batch_id": p["batchId"], "rows": p["numInputRows"],
             "rows_per_second": p["processedRowsPerSecond"]} for p in query.recentProgress]
