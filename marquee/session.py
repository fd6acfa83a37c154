"""Where intermediate tables and stream checkpoints live."""

from __future__ import annotations

import gc
import tempfile
import threading
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

_local_folder: tempfile.TemporaryDirectory | None = None


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share, as the cluster names it.

    A temporary folder stands in only where nothing is named and the master is
    local, as in tests.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    global _local_folder
    if _local_folder is None:
        _local_folder = tempfile.TemporaryDirectory(prefix="marquee-")
    return _local_folder.name


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_folder(spark)}/marquee/{label}-{uuid4().hex}"


# Whether shuffle files go at the end of a query, and not when the driver happens to collect its garbage.
TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
# So often it is looked whether a job has ended since the last collection.
LOOK_SECONDS = 2


def durable(df: DataFrame, label: str = "table", tidy: bool = False) -> DataFrame:
    """Write ``df`` once and read it back.

    Cuts the lineage, fixes anything that depends on how rows were placed, and
    lets later passes prune columns; a lost executor only costs a re-read.
    ``tidy`` drops the shuffle files of the write as soon as it has ended.
    """
    spark = df.sparkSession
    path, before = scratch_path(spark, label), spark.conf.get(TIDY)
    if tidy:
        spark.conf.set(TIDY, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(TIDY, before)
    return spark.read.schema(df.schema).parquet(path)


def collect_garbage(spark: SparkSession) -> None:
    """Shuffle files and stored blocks that nothing refers to go when the driver collects its garbage: now."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


@contextmanager
def collecting(spark: SparkSession) -> Iterator[None]:
    """Meanwhile the driver collects its garbage after a job has ended, so that what finished jobs shuffled goes."""
    done, tracker = threading.Event(), spark.sparkContext.statusTracker()

    def look() -> None:
        last = None
        while not done.wait(LOOK_SECONDS):
            # Short jobs are seen among the known ones only, jobs of a group while they run.
            jobs = sorted(tracker.getActiveJobsIds()), max(tracker.getJobIdsForGroup(None), default=None)
            if jobs != last:
                spark.sparkContext._jvm.System.gc()
                last = jobs

    thread = threading.Thread(target=look, daemon=True)
    thread.start()
    try:
        yield
    finally:
        done.set()
        thread.join()


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Give MLlib's iterative fits the shared folder if they have none yet."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(f"{shared_folder(spark)}/marquee")
