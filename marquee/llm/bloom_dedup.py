"""Exact dedup by two passes over a Bloom filter.

The first pass sets, for every row's hash, some cells of a filter whose cells
count up to two. A hash that occurs twice has counted all its cells twice, so
the second pass knows rows that are certainly alone: they pass straight
through. Only the rest is shuffled by hash.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import attach
from marquee.session import durable, scratch_path

CELLS_PER_ROW = 8
PROBES = 4
# The filter as it is broadcast has one bit per cell.
FILTER_BYTES = 32 << 20
# Cells travel in blocks, so that a cell needs two bytes.
BLOCK_BITS = 16


def _cells(hashes: pa.Array, cells: int) -> np.ndarray:
    """The cells of each 32-byte hash, by double hashing: one row per hash."""
    words = np.frombuffer(b"".join(hashes.to_pylist()), dtype="<u8").reshape(-1, 4)
    first, step = words[:, 0], words[:, 1] | np.uint64(1)
    probes = np.arange(PROBES, dtype=np.uint64)
    return (first[:, None] + step[:, None] * probes) & np.uint64(cells - 1)


def _count(cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """First pass, per task: the cells set once and more than once, by block."""
    def run(batches):
        for batch in batches:
            found = _cells(batch["sha"], cells)
            # A row counts a cell once, even if two of its probes meet there.
            found.sort(axis=1)
            fresh = np.ones(found.shape, dtype=bool)
            fresh[:, 1:] = found[:, 1:] != found[:, :-1]
            cell, n = np.unique(found[fresh], return_counts=True)
            block = (cell >> np.uint64(BLOCK_BITS)).astype(np.int64)
            inside = (cell & np.uint64((1 << BLOCK_BITS) - 1)).astype("<u2")
            edges = np.flatnonzero(np.diff(block, prepend=-1))
            for a, b in zip(edges, [*edges[1:], len(block)]):
                once = n[a:b] == 1
                yield pa.RecordBatch.from_pydict({
                    "block": [int(block[a])], "once": [inside[a:b][once].tobytes()],
                    "more": [inside[a:b][~once].tobytes()]}, COUNTED)
    return run


COUNTED = pa.schema([("block", pa.int64()), ("once", pa.binary()), ("more", pa.binary())])


def _merge(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """The cells of one block that were set more than once, as bits."""
    seen = np.zeros(1 << BLOCK_BITS, dtype=bool)
    twice = np.zeros(1 << BLOCK_BITS, dtype=bool)
    for once, more in zip(rows["once"], rows["more"]):
        for cells, again in ((np.frombuffer(once, "<u2"), False), (np.frombuffer(more, "<u2"), True)):
            twice[cells] |= seen[cells] | again
            seen[cells] = True
    return pd.DataFrame({"block": [key[0]], "bits": [np.packbits(twice).tobytes()]})


def _flag(bits, cells: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Second pass: whether all cells of a row were set more than once."""
    def run(batches):
        known = np.frombuffer(bits.value, dtype=np.uint8)
        for batch in batches:
            cell = _cells(batch["sha"], cells)
            byte, bit = cell >> np.uint64(3), (cell & np.uint64(7)).astype(np.uint8)
            maybe = ((known[byte] << bit) & 0x80 != 0).all(axis=1)
            yield batch.append_column("maybe", pa.array(maybe))
    return run


def _round_up(cells: int) -> int:
    return max(1 << BLOCK_BITS, 1 << (cells - 1).bit_length())


def possibly_repeated(hashes: DataFrame, rows: int, filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """``hashes`` (``sha``, 32 bytes, and more) with ``maybe``: false where no other row has the hash.

    Where one filter would not hold all ``rows`` well, hashes are dealt into
    rounds, each with a filter of its own, so that memory stays bounded and no
    filter fills up.
    """
    spark = hashes.sparkSession
    cells = min(_round_up(max(1, rows) * CELLS_PER_ROW), _round_up(filter_bytes * 8))
    rounds = max(1, -(-rows * CELLS_PER_ROW // cells))
    path = scratch_path(spark, "hashes")
    (hashes.withColumn("round", F.pmod(F.xxhash64("sha"), F.lit(rounds)))
     .write.partitionBy("round").parquet(path))
    dealt = spark.read.schema(hashes.select("*", F.lit(0).alias("round")).schema).parquet(path)
    flagged = None
    for k in range(rounds):
        own = dealt.where(F.col("round") == k).drop("round")
        merged = (own.select("sha").mapInArrow(_count(cells), "block long, once binary, more binary")
                  .groupBy("block").applyInPandas(_merge, "block long, bits binary"))
        bits = bytearray(cells // 8)
        for block, part in merged.toLocalIterator():  # cells / 8 bytes in all
            at = block << (BLOCK_BITS - 3)
            bits[at:at + len(part)] = part
        schema = own.withColumn("maybe", F.lit(True)).schema
        found = own.mapInArrow(_flag(spark.sparkContext.broadcast(bytes(bits)), cells), schema)
        flagged = found if flagged is None else flagged.unionByName(found)
    return durable(flagged, "flagged")


def exact_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                     filter_bytes: int = FILTER_BYTES) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Texts are equal when they are once every run of blanks (space, and 9 to 13)
    is one space. A null text is empty, so null, empty and no others are alike.
    Of equal texts the smallest id stays, a null id last; of rows that share
    that id one stays. Other columns are not read, whatever their names. An
    empty table gives an empty result. Equal SHA-256 counts as equal.
    """
    normal = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), r"[\x20\x09-\x0D]+", " ")
    hashes = durable(docs.select(
        F.col(doc_id).alias("doc_id"), F.unhex(F.sha2(normal, 256)).alias("sha"),
        F.monotonically_increasing_id().alias("row")), "hashed")
    rows = hashes.count()
    flagged = possibly_repeated(hashes, rows, filter_bytes)
    alone = flagged.where(~F.col("maybe")).select(
        "doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
        F.lit(True).alias("kept"), "sha")
    suspects = flagged.where("maybe").drop("maybe")
    groups = durable(suspects.groupBy("sha").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"),
        F.count("*").alias("group_size")), "groups")
    met = attach(suspects, groups, "sha", "group_size", rows).select(
        "doc_id", F.col("first.doc_id").alias("keep_id"), "group_size",
        (F.col("row") == F.col("first.row")).alias("kept"), "sha")
    return (alone.unionByName(met)
            .withColumn("text_sha256", F.lower(F.hex("sha"))).drop("sha"))
