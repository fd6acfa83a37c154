"""Token ids in binary shards: fixed-size chunks of ids, cut into planes, each compressed.

A shard file holds, all numbers little-endian:

    magic "PLANES1\\n"
    the planes of chunk after chunk, each a zstandard frame (nothing if all zero)
    chunk index: per chunk u64 offset, u32 ids, and u32 bytes of each plane
    document table, zstandard: per document u8 null id, i64 id, u64 tokens
    footer: u64 index offset, u64 table offset, u32 chunks, u32 planes,
            u8 bytes per id, u8 1 for bit planes or 0 for byte planes, magic

A byte plane holds one byte of every id of the chunk, a bit plane one bit of each.
On word pieces byte planes take less room (1.34 against 1.55 bytes an id on the
test documents) and a third of the time, so they are the default.
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Callable, Iterator, Sequence
from itertools import chain
from uuid import uuid4

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import zstandard
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from marquee.llm.common import WordIds, batches_by_size
from marquee.session import durable, scratch_path

MAGIC = b"PLANES1\n"
FOOTER = struct.Struct("<QQIIBB8s")
DOCUMENT = np.dtype([("null", "u1"), ("id", "<i8"), ("tokens", "<u8")])
CHUNK_IDS = 1 << 16
# A file closes once it has so many ids; documents stay whole.
SHARD_IDS = 1 << 22
LEVEL = 3
END_ID = 2
# Bytes of text that are encoded at a time; a text stays whole.
BATCH_BYTES = 2 << 20
# Words whose ids a worker keeps; then it starts anew.
MEMO_WORDS = 1 << 20
# New words that are encoded as one text, and the word between them, which texts seldom have.
GROUP_WORDS = 256
MARK = "\x01"


def to_planes(ids: np.ndarray, width: int, bits: bool) -> list[bytes]:
    """The planes of some ids of ``width`` bytes, lowest first."""
    raw = np.ascontiguousarray(ids.astype(f"<u{width}")).view(np.uint8).reshape(-1, width)
    if not bits:
        return [p.tobytes() for p in np.ascontiguousarray(raw.T)]
    flat = np.unpackbits(raw, axis=1, bitorder="little")
    return [p.tobytes() for p in np.packbits(np.ascontiguousarray(flat.T), axis=1, bitorder="little")]


def from_planes(planes: Sequence[bytes], count: int, width: int, bits: bool) -> np.ndarray:
    """Ids, as unsigned 32-bit numbers, from their planes."""
    rows = np.stack([np.frombuffer(p, np.uint8) for p in planes])
    if bits:
        rows = np.unpackbits(rows, axis=1, count=count, bitorder="little")
        rows = np.packbits(np.ascontiguousarray(rows.T), axis=1, bitorder="little").T
    return np.ascontiguousarray(rows.T).view(f"<u{width}").ravel().astype(np.uint32)


def encode_shard(ids: np.ndarray, documents: np.ndarray, chunk_ids: int = CHUNK_IDS, bits: bool = False,
                 level: int = LEVEL) -> bytes:
    """A shard file with these ids, the documents one after the other."""
    width = 2 if ids.max(initial=0) < 1 << 16 else 4
    count = width * 8 if bits else width
    press = zstandard.ZstdCompressor(level=level)
    out, index = bytearray(MAGIC), bytearray()
    for at in range(0, len(ids), chunk_ids):
        part = ids[at:at + chunk_ids]
        frames = [press.compress(p) if p.strip(b"\0") else b"" for p in to_planes(part, width, bits)]
        index += struct.pack(f"<QI{count}I", len(out), len(part), *map(len, frames))
        out += b"".join(frames)
    index_at = len(out)
    out += index
    table_at = len(out)
    out += press.compress(documents.tobytes())
    return bytes(out + FOOTER.pack(index_at, table_at, -(-len(ids) // chunk_ids), count, width, bits, MAGIC))


class Shard:
    """Reads a shard file; ids come chunk by chunk, or of any range by the index."""

    def __init__(self, data: bytes):
        index_at, table_at, chunks, self.planes, self.width, self.bits, magic = FOOTER.unpack(data[-FOOTER.size:])
        if magic != MAGIC or data[:len(MAGIC)] != MAGIC:
            raise ValueError("not a shard of token planes")
        self.data = data
        kind = np.dtype([("offset", "<u8"), ("ids", "<u4"), ("bytes", "<u4", (self.planes,))])
        self.index = np.frombuffer(data, kind, chunks, index_at)
        self.firsts = np.concatenate([[0], np.cumsum(self.index["ids"], dtype=np.int64)])
        table = zstandard.ZstdDecompressor().decompress(data[table_at:-FOOTER.size])
        self.documents = np.frombuffer(table, DOCUMENT)

    def chunk(self, k: int) -> np.ndarray:
        entry = self.index[k]
        at, count, press, planes = int(entry["offset"]), int(entry["ids"]), zstandard.ZstdDecompressor(), []
        empty = bytes(-(-count // 8) if self.bits else count)
        for size in entry["bytes"].tolist():
            planes.append(press.decompress(self.data[at:at + size]) if size else empty)
            at += size
        return from_planes(planes, count, self.width, self.bits)

    def ids(self, start: int = 0, stop: int | None = None) -> np.ndarray:
        """Ids ``start`` to ``stop``; only the chunks that hold them are read."""
        stop = int(self.firsts[-1]) if stop is None else stop
        if start >= stop:
            return np.zeros(0, np.uint32)
        a = int(np.searchsorted(self.firsts, start, side="right")) - 1
        b = int(np.searchsorted(self.firsts, stop, side="left"))
        found = np.concatenate([self.chunk(k) for k in range(a, b)])
        return found[start - self.firsts[a]:stop - self.firsts[a]]

    def each(self) -> Iterator[np.ndarray]:
        """The ids of each document in turn, with few chunks in memory."""
        kept, k = np.zeros(0, np.uint32), 0
        for size in self.documents["tokens"].tolist():
            parts, have = [kept], len(kept)
            while have < size:
                parts.append(self.chunk(k))
                have, k = have + len(parts[-1]), k + 1
            whole = np.concatenate(parts)
            yield whole[:size]
            kept = whole[size:]


class WordEncoder:
    """Token ids of whole texts, remembering those of words.

    For tokenizers that never join characters across white space and drop it:
    then a text's ids are those of its words. White space is the six ASCII ones
    here; what else a tokenizer takes for it stays inside a word.
    """

    def __init__(self, path: str):
        # A task has one core; the library would start a thread for each of the machine's.
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        found = self._each([MARK])[0]
        self.mark = found[0] if len(found) == 1 else None
        self.memo = WordIds()

    def _each(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, fresh: list[str]) -> None:
        """Ids of fresh words, a joined group of which is one text to the tokenizer."""
        groups = [fresh[k:k + GROUP_WORDS] for k in range(0, len(fresh), GROUP_WORDS)]
        ids, lengths = [], []
        for words, made in zip(groups, self._each([f" {MARK} ".join(words) for words in groups])):
            flat = np.array(made, np.uint32)
            marks = np.flatnonzero(flat == self.mark) if self.mark is not None else []
            if len(marks) == len(words) - 1:
                ids.append(np.delete(flat, marks))
                lengths.append(np.diff(marks, prepend=-1, append=len(flat)) - 1)
            else:
                # A word has the mark's id, too, or the tokenizer none for it.
                lists = self._each(words)
                ids.append(np.fromiter(chain.from_iterable(lists), np.uint32))
                lengths.append(np.fromiter(map(len, lists), np.int64, len(lists)))
        self.memo.learn(np.concatenate(ids), np.concatenate(lengths))

    def encode(self, texts: Sequence[bytes | None]) -> list[np.ndarray]:
        cut = pa.compute.ascii_split_whitespace(pa.array(texts, pa.binary()).fill_null(b"").cast(pa.large_string()))
        words, sizes = cut.flatten(), pa.compute.list_value_length(cut).to_numpy()
        # Blanks at an end leave an empty word there.
        some = pa.compute.binary_length(words).to_numpy() > 0
        of_texts = np.concatenate([[0], np.cumsum(some)])[np.cumsum(sizes)]
        # Each word of the batch is looked up once.
        named = words.filter(pa.array(some)).dictionary_encode()
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        try:
            distinct = self.memo.number(named.dictionary.to_numpy(zero_copy_only=False).tolist())
            if self.memo.fresh:
                self._learn(self.memo.fresh)
        except BaseException:
            # Else the new words would pass for known ones.
            self.memo.clear()
            raise
        ids, bounds = self.memo.ids_of(distinct[named.indices.to_numpy()])
        return np.split(ids, bounds[of_texts][:-1]) if len(texts) else []


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def _put(folder: str, name: str, data: bytes) -> None:
    system, at = fs.FileSystem.from_uri(folder)
    system.create_dir(at, recursive=True)
    with system.open_output_stream(f"{at}/{name}") as out:
        out.write(data)


def _get(folder: str, name: str) -> bytes:
    system, at = fs.FileSystem.from_uri(folder)
    with system.open_input_file(f"{at}/{name}") as file:
        return file.read()


MANIFEST = "part int, shard int, name string, documents long, tokens long"


def _write(folder: str, tokenizer: str, end_id: int | None, bits: bool, shard_ids: int
           ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        part, shard = TaskContext.get().partitionId(), 0
        encoder, end = _encoder(tokenizer), [] if end_id is None else [end_id]
        kept: list[np.ndarray] = []
        rows: list[tuple] = []
        size = 0

        def flush() -> pa.RecordBatch:
            # Each attempt writes names of its own; the manifest has those that count.
            name = f"{part:06d}-{shard:06d}-{uuid4().hex}.planes"
            _put(folder, name, encode_shard(np.concatenate(kept), np.array(rows, DOCUMENT), bits=bits))
            return pa.RecordBatch.from_pydict({
                "part": pa.array([part], pa.int32()), "shard": pa.array([shard], pa.int32()), "name": [name],
                "documents": pa.array([len(rows)], pa.int64()), "tokens": pa.array([size], pa.int64())})

        for batch in batches_by_size(batches, "text", BATCH_BYTES):
            for number, ids in zip(batch["doc_id"].to_pylist(), encoder.encode(batch["text"])):
                ids = np.concatenate([ids, np.array(end, np.uint32)])
                kept.append(ids)
                rows.append((number is None, number or 0, len(ids)))
                size += len(ids)
                if size >= shard_ids:
                    yield flush()
                    shard, kept, rows, size = shard + 1, [], [], 0
        if rows:
            yield flush()
    return run


def write_tokens(docs: DataFrame, folder: str, tokenizer: str, doc_id: str = "doc_id", text: str = "text",
                 order: Sequence[str] | None = None, end_id: int | None = END_ID, bits: bool = False,
                 shard_ids: int = SHARD_IDS) -> DataFrame:
    """Write the ids of all texts below ``folder``, by ``order`` (else by id), and return the manifest.

    One row per shard: ``folder, name, documents, tokens, first``, the last the
    ids in all shards before it. A null or empty text has only ``end_id``; null
    ids come first, rows with one id follow each other. Other columns are not
    read. An empty table gives an empty manifest. ``folder`` must be one that all
    executors share, named as Arrow's file systems name it.
    """
    # Spark picks the range bounds; texts that share an id are told apart by a hash.
    keys = [*(order or [doc_id])]
    placed = (docs.repartitionByRange(*keys).sortWithinPartitions(*keys)
              .select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("binary").alias("text")))
    made = durable(placed.mapInArrow(_write(folder, tokenizer, end_id, bits, shard_ids), MANIFEST), "manifest")
    # One row per task is summed in one place, then one per shard within each task.
    tasks = made.groupBy("part").agg(F.sum("tokens").alias("n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    firsts = tasks.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return durable(made.join(F.broadcast(firsts), "part").select(
        F.lit(folder).alias("folder"), "name", "documents", "tokens",
        (F.col("base") + F.coalesce(F.sum("tokens").over(within), F.lit(0))).alias("first")), "manifest")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            shard, start, out = Shard(_get(row["folder"], row["name"])), row["first"], []
            for doc, ids in zip(shard.documents, shard.each()):
                number = None if doc["null"] else int(doc["id"])
                out.append((number, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                start += len(ids)
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out)], ["doc_id", "start", "n_tokens", "ids_crc32"])


def read_tokens(manifest: DataFrame) -> DataFrame:
    """Per document, from the files: ``doc_id, start, n_tokens, ids_crc32``."""
    # A task for each shard; rows are only names.
    shards = max(1, manifest.count())
    return manifest.repartition(min(shards, 10_000), "name").select("folder", "name", "first").mapInArrow(
        _read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def shard_folder(spark: SparkSession) -> str:
    """A fresh folder for shards below the one that executors share."""
    return scratch_path(spark, "tokens")
