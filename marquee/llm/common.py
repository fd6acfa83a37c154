"""Pieces that several operators here share."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.session import durable

# A key that more rows than this share, or more than one in HOT_SHARE of all
# rows, is hot. So at most HOT_SHARE keys can be, whatever the size of the table.
HOT_ROWS = 1_000
HOT_SHARE = 10_000

#: A-Z to a-z, byte by byte.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def free_name(df: DataFrame, name: str) -> str:
    """``name``, or the same with underscores in front if ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def with_row_number(df: DataFrame) -> tuple[DataFrame, str]:
    """A written copy with a column that tells every row, repeated ones too, and its name."""
    name = free_name(df, "_row")
    return durable(df.withColumn(name, F.monotonically_increasing_id()), "rows"), name


def attach(rows: DataFrame, per_key: DataFrame, key: str, size: str, total: int) -> DataFrame:
    """``rows`` with the columns of their key, of which ``per_key`` has one row each.

    ``size`` is a column of ``per_key``, the number of ``rows`` of the key, and
    ``total`` that of all rows. Hot keys, ``HOT_SHARE`` at most, are broadcast and
    their rows stay where they are; the others meet in a shuffled join, however small
    the files of ``per_key`` are.
    ``per_key`` should be a written table, as it is read for both.
    """
    limit = max(HOT_ROWS, -(-total // HOT_SHARE))
    hot = F.broadcast(per_key.where(F.col(size) > limit))
    rest = rows.join(F.broadcast(hot.select(key)), key, "left_anti")
    return (rows.join(hot, key)
            .unionByName(rest.join(per_key.where(F.col(size) <= limit).hint("merge"), key)))


def small_batches(spark: SparkSession) -> None:
    """From now on this session sends rows to Python in Arrow batches of about 4 MB, where Spark's default is 64.

    A batch is held on both sides and again for what comes back, by each task.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "4m")


def batches_by_size(batches: Iterator[pa.RecordBatch], column: str, most: int
                    ) -> Iterator[pa.RecordBatch]:
    """Cut batches so that ``column`` (binary) has about ``most`` bytes in each; rows stay whole."""
    for batch in batches:
        at, size = 0, 0
        for i, n in enumerate(pa.compute.binary_length(batch[column]).to_pylist()):
            size += n or 0
            if size >= most:
                yield batch.slice(at, i + 1 - at)
                at, size = i + 1, 0
        if at < batch.num_rows:
            yield batch.slice(at)


class WordIds(dict[str, int]):
    """Numbers of words, and the token ids that each stands for.

    A word that it does not have is given the next number and is fresh until ``learn``.
    """

    def __init__(self) -> None:
        super().__init__()
        self.clear()

    def clear(self) -> None:
        super().clear()
        self.fresh: list[str] = []
        self.known = self.used = 0
        self.ids = np.zeros(1 << 16, np.uint32)
        self.starts = np.zeros(1 << 14, np.int64)
        self.lengths = np.zeros(1 << 14, np.int64)

    def __missing__(self, word: str) -> int:
        number = self[word] = self.known
        self.known += 1
        self.fresh.append(word)
        return number

    def number(self, words: Sequence[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def learn(self, ids: np.ndarray, lengths: np.ndarray, order: np.ndarray | slice = slice(None)) -> None:
        """Take the ids of the fresh words, one after the other in ``order``, and how many each has."""
        first, starts = self.known - len(self.fresh), np.zeros(len(lengths), np.int64)
        starts[order] = self.used + np.cumsum(lengths[order]) - lengths[order]
        for name, new, at in (("ids", ids, self.used), ("starts", starts, first), ("lengths", lengths, first)):
            kept = getattr(self, name)
            if at + len(new) > len(kept):
                kept = np.concatenate([kept, np.zeros(max(len(kept), len(new)), kept.dtype)])
                setattr(self, name, kept)
            kept[at:at + len(new)] = new
        self.used += len(ids)
        self.fresh = []

    def ids_of(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words one after the other, and where each word's begin, with their end."""
        sizes = self.lengths[numbers]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[numbers] - ends + sizes, sizes) + np.arange(ends[-1] if len(numbers) else 0)
        return self.ids[places], np.concatenate([[0], ends])


def add_columns(batch: pa.RecordBatch, columns: Sequence[tuple[str, pa.Array]]) -> pa.RecordBatch:
    for name, values in columns:
        batch = batch.append_column(name, values)
    return batch
