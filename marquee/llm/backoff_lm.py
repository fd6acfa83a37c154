"""Scores of documents under a stupid-backoff language model of their own corpus.

S(w | context) = c(context w) / c(context) if that n-gram is in the count
tables, else ``ALPHA`` times the score with a context of one word less; a single
word scores c(w) / N. Counts are over all words of all documents, and nothing is
left out of them. So every n-gram of a document is in the tables, the document's
own occurrence at least, and no score backs off: in the sum over a document the
counts of its longest n-grams stand above, those of their contexts below, and
what a document's first words share cancels out.

N-grams go by 64-bit hashes, the longest by those of their context and last word.
Documents are exploded into their longest n-grams, which travel once, packed by
leading bits of the context's hash: a bucket then holds all that follows its
contexts, so the count tables of both are made there, joined to the exploded
rows there, and only a sum per document goes on. N-grams with a large share of
all are counted beforehand and added where the document is; what follows a
context of that kind goes by the hash of the whole, so it is spread.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import xxhash
import zstandard
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import HOT_ROWS, HOT_SHARE, batches_by_size
from marquee.session import durable

ORDER = 3
BATCH_BYTES = 4 << 20
# A bucket holds about so many n-grams, and a batch is dealt over 2 ** FAN_BITS buckets
# at a time at most; larger tables are dealt again by the next bits of the hash.
BUCKET_GRAMS = 1_000_000
FAN_BITS = 10
# Last words are told apart, among those after one context, by so many bits.
LAST_BITS = 40
# A task merges n-grams that are only counted until it has so many.
KEPT_GRAMS = 2_000_000
# Buckets below zero hold the documents themselves.
SPREAD = 1 << 10


def mixed(context: np.ndarray, last: np.ndarray) -> np.ndarray:
    """The hash of an n-gram by those of its context and its last word."""
    made = context * np.uint64(0x9E3779B97F4A7C15) + last
    made ^= made >> np.uint64(29)
    made *= np.uint64(0xBF58476D1CE4E5B9)
    return made ^ made >> np.uint64(32)


def last_word(words: np.ndarray) -> np.ndarray:
    return words >> np.uint64(64 - LAST_BITS)


class Grams:
    """The n-grams of some texts, a size at a time: their hashes, and the text and place of each."""

    def __init__(self, texts: pa.Array):
        split = pa.compute.ascii_split_whitespace(pa.compute.ascii_lower(texts.fill_null("")))
        words, text = split.flatten(), pa.compute.list_parent_indices(split)
        # Blanks at either end leave empty ones.
        kept = pa.compute.not_equal(words, "")
        coded = words.filter(kept).dictionary_encode()
        own = np.array([xxhash.xxh64_intdigest(w) for w in coded.dictionary.cast(pa.binary()).to_pylist()], np.uint64)
        self.text = text.filter(kept).to_numpy(zero_copy_only=False).astype(np.int64)
        self.total = len(self.text)
        self.words = own[coded.indices.to_numpy(zero_copy_only=False)] if self.total else own
        self.sizes = np.bincount(self.text, minlength=len(texts))
        self.place = np.arange(self.total) - (np.cumsum(self.sizes) - self.sizes)[self.text]

    def whole(self, size: int) -> np.ndarray:
        """Where an n-gram begins."""
        most = max(self.total - size + 1, 0)
        return np.flatnonzero(self.place[:most] + size <= self.sizes[self.text[:most]])

    def hashes(self, order: int) -> Iterator[tuple[int, np.ndarray]]:
        """Of all runs of 1 to ``order`` words, those over the end of a text as well."""
        made = mixed(np.zeros(self.total, np.uint64), self.words)
        yield 1, made
        for size in range(2, order + 1):
            last = self.words[size - 1:]
            made = mixed(made[:len(last)], last_word(last) if size == order else last)
            yield size, made


# Columns of a bucket's two groups. Longest n-grams: context, last word, document, how often, and
# whether one of them begins the text. Others: hash, document (none: only counted), how often.
_KINDS = (("<u8", "<u8", "<i8", "<i8", "u1"), ("<u8", "<i8", "<i8"))
Group = tuple[np.ndarray, ...]


def exploded(grams: Grams, order: int) -> tuple[Group, Group]:
    """The two groups of some texts, the first merged and in order of the context, by text instead of document."""
    low = np.uint64((1 << 24) - 1)
    others: list[tuple[np.ndarray, np.ndarray]] = []
    context = top = None
    for size, made in grams.hashes(order):
        at = grams.whole(size)
        text = grams.text[at]
        if size == order:
            top = (context[at], last_word(grams.words[at + order - 1]), text, grams.place[at] == 0)
            continue
        all_of_it = grams.sizes[text] == size
        if size == order - 1:
            # Contexts are counted with what follows them, but for those at the end.
            ends = grams.place[at] + size == grams.sizes[text]
            at, text, all_of_it, context = at[ends], text[ends], all_of_it[ends], made
        others.append((made[at], np.where(all_of_it, text, -1)))
    context, last, text, begins = top
    order_ = np.argsort(context & ~low | last & low, kind="stable")
    context, last, text, begins = context[order_], last[order_], text[order_], begins[order_]
    fresh = np.ones(len(context), bool)
    fresh[1:] = (context[1:] != context[:-1]) | (last[1:] != last[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(fresh)
    n = np.diff(first, append=len(context))
    started = np.add.reduceat(begins, first) if len(first) else begins
    gram, where = map(np.concatenate, zip(*others))
    return ((context[first], last[first], text[first], n, started.astype(np.uint8)),
            (gram, where, np.ones(len(gram), np.int64)))


def merged(group: Group) -> Group:
    """Others in order of hash, those that are only counted once each."""
    gram, row, n = group
    alone, at = np.unique(gram[row < 0], return_inverse=True)
    sums = np.bincount(at, n[row < 0], len(alone)).astype(np.int64)
    gram = np.concatenate([alone, gram[row >= 0]])
    order = np.argsort(gram, kind="stable")
    return (gram[order], np.concatenate([np.full(len(alone), -1), row[row >= 0]])[order],
            np.concatenate([sums, n[row >= 0]])[order])


def _planes(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _values(data: memoryview, count: int, kind: str) -> np.ndarray:
    rows = np.frombuffer(data, np.uint8).reshape(np.dtype(kind).itemsize, count)
    return np.ascontiguousarray(rows.T).view(kind).ravel()


def pack(groups: tuple[Group, Group]) -> bytes:
    """The sizes of both groups, then every column as byte planes, pressed."""
    sizes = np.array([len(g[0]) for g in groups], "<i8").tobytes()
    columns = [_planes(np.ascontiguousarray(c, kind)) for g, kinds in zip(groups, _KINDS) for c, kind in zip(g, kinds)]
    return zstandard.ZstdCompressor(level=1).compress(sizes + b"".join(columns))


def unpack(blob: bytes) -> tuple[Group, Group]:
    data = memoryview(zstandard.ZstdDecompressor().decompress(blob))
    at, out = 16, []
    for count, kinds in zip(np.frombuffer(data[:16], "<i8").tolist(), _KINDS):
        group = []
        for kind in kinds:
            size = count * np.dtype(kind).itemsize
            group.append(_values(data[at:at + size], count, kind))
            at += size
        out.append(tuple(group))
    return out[0], out[1]


def dealt(groups: tuple[Group, Group], done: int, bits: int) -> Iterator[tuple[int, bytes]]:
    """The buckets by the ``bits`` of the hash after the first ``done``, packed; both groups are in order of them."""
    numbers = [(g[0] << np.uint64(done) >> np.uint64(64 - bits) if bits else np.zeros(len(g[0]), np.uint64))
               for g in groups]
    edges = [np.searchsorted(b, np.arange((1 << bits) + 1, dtype=np.uint64)) for b in numbers]
    for b in sorted({int(x) for own in numbers for x in np.unique(own)}):
        yield b, pack(tuple(tuple(c[e[b]:e[b + 1]] for c in g) for g, e in zip(groups, edges)))


def _gathered(blobs: list[bytes]) -> list[Group]:
    return [tuple(map(np.concatenate, zip(*parts))) for parts in zip(*map(unpack, blobs))]


def _found(keys: np.ndarray, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each n-gram stands in ``keys``, and whether it does."""
    if not len(keys):
        return np.zeros(len(gram), np.int64), np.zeros(len(gram), bool)
    at = np.minimum(np.searchsorted(keys, gram), len(keys) - 1)
    return at, keys[at] == gram


def _frequent(order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """N-grams with a large share of their batch, as any with a large share of the table has in one; and all words.

    The words before the last, and those after the first, have a large share as well then.
    """
    def run(batches):
        for batch in batches_by_size(batches, "text", BATCH_BYTES):
            grams = Grams(batch["text"])
            found, counts, much = [np.zeros(0, np.uint64)], [grams.total], np.ones(grams.total + 1, bool)
            for size, made in grams.hashes(order):
                at = grams.whole(size)
                at = at[much[at] & much[at + 1]] if size > 1 else at
                kept, own, n = np.unique(made[at], return_inverse=True, return_counts=True)
                often = n * HOT_SHARE >= grams.total
                much[:] = False
                much[at[often[own]]] = True
                found.append(kept[often])
                counts += n[often].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array([None, *np.concatenate(found).view(np.int64).tolist()], pa.int64()),
                 pa.array(counts, pa.int64())], ["gram", "n"])
    return run


def _count_hot(shared, order: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        keys = shared.value
        counts = np.zeros(len(keys), np.int64)
        for batch in batches_by_size(batches, "text", BATCH_BYTES):
            grams = Grams(batch["text"])
            for size, made in grams.hashes(order):
                at, hot = _found(keys, made[grams.whole(size)])
                counts += np.bincount(at[hot], minlength=len(keys))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["gram", "n"])
    return run


PACKED = "bucket long, blob binary, row long, doc_id {}, words long, log double, shared long"


def _packed(bucket, blob, row, doc_id, words, log, shared) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(bucket, pa.int64()), pa.array(blob, pa.binary()), pa.array(row, pa.int64()), doc_id,
         pa.array(words, pa.int64()), pa.array(log, pa.float64()), pa.array(shared, pa.int64())],
        ["bucket", "blob", "row", "doc_id", "words", "log", "shared"])


def _blobs(made: Iterator[tuple[int, bytes]], kind: pa.DataType) -> pa.RecordBatch:
    found = list(made)
    none = pa.nulls(len(found), pa.int64())
    return _packed([b for b, _ in found], [x for _, x in found], none, pa.nulls(len(found), kind), none,
                   pa.nulls(len(found), pa.float64()), none)


def _explode(shared, order: int, total: int, bits: int
             ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A row per document with what its hot n-grams give, and a blob for each bucket."""
    def split(keys: np.ndarray, counts: np.ndarray, grams: Grams, log: np.ndarray, elsewhere: np.ndarray
              ) -> tuple[Group, Group]:
        """Both groups without what is hot; that goes into the documents' own sums."""
        (context, last, text, n, begins), (gram, where, m) = exploded(grams, order)
        logs = np.log(counts)

        def add(at: np.ndarray, text: np.ndarray, n: np.ndarray) -> None:
            log[:] += np.bincount(text, n * logs[at], len(log))
            wide = counts[at] > n
            elsewhere[:] += np.bincount(text[wide], n[wide], len(log)).astype(np.int64)

        at, hot = _found(keys, context)
        log -= np.bincount(text[hot], (n[hot] - begins[hot]) * logs[at[hot]], len(log))
        # What follows a hot context goes by its own hash.
        gram = np.concatenate([gram, mixed(context[hot], last[hot])])
        where, m = np.concatenate([where, text[hot]]), np.concatenate([m, n[hot]])
        cold = ~hot
        at, hot = _found(keys, gram)
        scored = hot & (where >= 0)
        add(at[scored], where[scored], m[scored])
        return (context[cold], last[cold], text[cold], n[cold], begins[cold]), (gram[~hot], where[~hot], m[~hot])

    def run(batches):
        keys, counts = shared.value
        waiting, kind = [], None
        for batch in batches_by_size(batches, "text", BATCH_BYTES):
            rows, kind = batch["row"].to_numpy(), batch["doc_id"].type
            grams = Grams(batch["text"])
            log = np.where(grams.sizes > 0, -np.log(max(total, 1)), 0.0)
            elsewhere = np.zeros(len(rows), np.int64)
            (context, last, text, n, begins), (gram, where, m) = split(keys, counts, grams, log, elsewhere)
            waiting.append((gram, np.where(where < 0, -1, rows[where]), m))
            yield _packed(-1 - rows % SPREAD, [None] * len(rows), rows, batch["doc_id"], grams.sizes, log, elsewhere)
            others = tuple(c[:0] for c in waiting[0])
            if sum(len(w[0]) for w in waiting) >= KEPT_GRAMS:
                others, waiting = merged(tuple(map(np.concatenate, zip(*waiting)))), []
            yield _blobs(dealt(((context, last, rows[text], n, begins), others), 0, bits), kind)
        if waiting:
            none = tuple(np.zeros(0, k) for k in _KINDS[0])
            yield _blobs(dealt((none, merged(tuple(map(np.concatenate, zip(*waiting))))), 0, bits), kind)
    return run


def _each_bucket(batches: Iterator[pa.RecordBatch], work: Callable[[int, list[bytes], pa.DataType], pa.RecordBatch],
                 most: int | None = None) -> Iterator[pa.RecordBatch]:
    """Documents' own rows as they are, and ``work`` on the blobs of each bucket, which come one after the other.

    With ``most``, on some of them at a time, of about so many bytes.
    """
    bucket, blobs, size, kind = None, [], 0, None
    for batch in batches:
        kind = batch["doc_id"].type
        own = batch.filter(pa.compute.less(batch["bucket"], 0))
        if own.num_rows:
            yield own
        for b, blob in zip(batch["bucket"].to_pylist(), batch["blob"].to_pylist()):
            if b < 0:
                continue
            if blobs and (b != bucket or most and size >= most):
                yield work(bucket, blobs, kind)
                blobs, size = [], 0
            bucket, size = b, size + len(blob)
            blobs.append(blob)
    if blobs:
        yield work(bucket, blobs, kind)


def _deal_again(done: int, bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Buckets by ``done`` bits into smaller ones by ``bits`` more."""
    def work(bucket, blobs, kind):
        groups = []
        for group in _gathered(blobs):
            order = np.argsort(group[0], kind="stable")
            groups.append(tuple(c[order] for c in group))
        return _blobs(((bucket << bits | b, blob) for b, blob in dealt(tuple(groups), done, bits)), kind)
    return lambda batches: _each_bucket(batches, work, 2 * BATCH_BYTES)


def bucket_sums(blobs: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Count tables of a bucket, joined to its n-grams: per document the logs and how many stand elsewhere, too."""
    (context, last, row, n, begins), (gram, where, m) = _gathered(blobs)
    size = len(context)
    _, at = np.unique(np.concatenate([context, gram]), return_inverse=True)
    counts = np.bincount(at, np.concatenate([n, m]))[at]
    _, at = np.unique(mixed(context, last), return_inverse=True)
    tops = np.bincount(at, n)[at] if size else np.zeros(0)
    scored = where >= 0
    logs = np.concatenate([n * np.log(tops) - (n - begins.astype(np.int64)) * np.log(counts[:size]),
                           (m * np.log(counts[size:]))[scored]])
    wide = np.concatenate([n * (tops > n), (m * (counts[size:] > m))[scored]])
    rows, own = np.unique(np.concatenate([row, where[scored]]), return_inverse=True)
    return rows, np.bincount(own, logs, len(rows)), np.bincount(own, wide, len(rows)).astype(np.int64)


def _sum(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def work(_, blobs, kind):
        rows, log, shared = bucket_sums(blobs)
        none = pa.nulls(len(rows), pa.int64())
        return _packed(none, pa.nulls(len(rows), pa.binary()), rows, pa.nulls(len(rows), kind), none, log, shared)
    return _each_bucket(batches, work)


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """One row per document: ``doc_id, n_words, n_shared, log_score``.

    Words are runs of non-blanks in the lower-cased text (A-Z). ``log_score`` is
    the sum of the natural logs of all words' scores with contexts of up to
    ``order`` - 1 words; a document's first words have shorter ones. ``n_shared``
    is how many of its n-grams of ``order`` words (of a shorter text: the whole
    sequence) stand elsewhere in the corpus, too. A null or empty text has no
    words and the score 0. Texts are read whole, however long; a very long one is
    a batch of its own. Rows, repeated ones too, are counted and answered one by
    one; other columns are not read. An empty table gives an empty result.
    """
    if order < 2:
        raise ValueError("order must be 2 or more")
    context = docs.sparkSession.sparkContext
    read = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    texts = read.select("text")
    often = durable(texts.mapInArrow(_frequent(order), "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n")),
                    "frequent")
    total = often.where(F.col("gram").isNull()).agg(F.sum("n")).first()[0] or 0
    # Less than 2 * HOT_SHARE n-grams of each size.
    hot = often.where(F.col("gram").isNotNull() & (F.col("n") > max(HOT_ROWS, total // (2 * HOT_SHARE)))).collect()
    keys = np.sort(np.array([r["gram"] for r in hot], np.int64).view(np.uint64))
    exact = (texts.mapInArrow(_count_hot(context.broadcast(keys), order), "gram long, n long")
             .groupBy("gram").agg(F.sum("n").alias("n")).collect()) if len(keys) else []
    known = {r["gram"]: r["n"] for r in exact}
    counts = np.array([known[k] for k in keys.view(np.int64).tolist()], np.int64)

    bits = max(0, (total * order // BUCKET_GRAMS).bit_length())
    done = min(bits, FAN_BITS)
    kind = read.schema["doc_id"].dataType.simpleString()
    schema = PACKED.format(kind)
    packed = read.withColumn("row", F.monotonically_increasing_id()).mapInArrow(
        _explode(context.broadcast((keys, counts)), order, total, done), schema)
    while done < bits:
        more = min(bits - done, FAN_BITS)
        packed = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
            _deal_again(done, more), schema)
        done += more
    sums = packed.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(_sum, schema)
    return sums.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("words").alias("n_words"), F.sum("shared").alias("n_shared"),
        F.sum("log").alias("log_score")).drop("row")
