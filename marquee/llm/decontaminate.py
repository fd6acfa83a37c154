"""Benchmark decontamination with an FM-index per shard of training documents.

Each task gathers whole documents into shards and builds an index over the
words of each: suffixes in order, the word before each, a wavelet matrix over
those words for ranks, and every few positions a sampled one. All benchmark
windows search backward through it at once; what they find is located by
walking to the next sampled position, and merged into spans to remove.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import LOWER, free_name

WINDOW_WORDS = 10
# A shard closes once it has so many words.
SHARD_WORDS = 1 << 20
# Every so many words of a run, a position is kept.
SAMPLE_EVERY = 8
# Occurrences that are located at a time.
LOCATE_AT_ONCE = 1 << 20
# Benchmark text that goes into one pass over the documents; its windows are in every worker's memory.
PASS_BYTES = 2 << 20

#: What is no word character becomes a blank; A-Z become a-z.
_WORDS = bytes(b if chr(b).isalnum() and b < 128 or b >= 128 else 32 for b in range(256))
_WORDS = bytes(LOWER[b] for b in _WORDS)
_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_WORD_CASED = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_WORDS).split()


class Phrases:
    """The distinct windows of some items, as numbers of the words they have."""

    def __init__(self, items: list[tuple[int | None, bytes | None]], window: int):
        self.codes: dict[bytes, int] = {}
        owners: dict[tuple[int, ...], set] = {}
        for item, text in items:
            found = [self.codes.setdefault(w, len(self.codes) + 1) for w in words_of(text)]
            size = min(window, len(found))
            for at in range(len(found) - size + 1 if size else 0):
                owners.setdefault(tuple(found[at:at + size]), set()).add(item)
        self.lengths = np.array([len(p) for p in owners], dtype=np.int64)
        #: Last word first, as the search reads them.
        self.backward = np.zeros((len(owners), window), dtype=np.int32)
        for row, phrase in enumerate(owners):
            self.backward[row, :len(phrase)] = phrase[::-1]
        self.owners = [sorted(i for i in o if i is not None) for o in owners.values()]


class FMIndex:
    """An index of the runs of positive numbers in ``text``; zeros part the runs.

    Rows are suffixes up to the end of their run, the empty ones included, in
    order; equal ones in the order of their places, which keeps the step from a
    row to that of the place before it exact.
    """

    def __init__(self, text: np.ndarray, sample_every: int = SAMPLE_EVERY):
        text = np.concatenate([text, [0]]).astype(np.int32)
        inside = text > 0
        follows = np.concatenate([[False], inside[:-1]])
        zeros = np.flatnonzero(~inside)
        to_end = zeros[np.searchsorted(zeros, np.arange(len(text)))] - np.arange(len(text))
        places = np.flatnonzero(inside | follows)
        order = self._sorted(text, places, to_end)
        self.rows = len(order)
        before = np.where(follows[order], text[order - 1], 0)
        self.before = before
        self.size = int(text.max(initial=0)) + 2
        self.first = np.searchsorted(text[order], np.arange(self.size + 1))
        starts = np.maximum.accumulate(np.where(inside & ~follows, np.arange(len(text)), 0))
        kept = inside[order] & ((order - starts[order]) % sample_every == 0)
        self.kept, self.kept_rank, self.sampled = kept, np.cumsum(kept), order[kept]
        self._wavelet(before)

    @staticmethod
    def _sorted(text: np.ndarray, places: np.ndarray, to_end: np.ndarray) -> np.ndarray:
        """Places in the order of their suffixes, by doubling what is compared."""
        order = places[np.argsort(text[places], kind="stable")]
        n = len(order)
        number = np.arange(n)
        fresh = np.ones(n, dtype=bool)
        fresh[1:] = text[order[1:]] != text[order[:-1]]
        group = np.maximum.accumulate(np.where(fresh, number, 0))
        rank = np.zeros(len(text), dtype=np.int64)
        rank[order] = np.where(text[order] > 0, group + 1, 0)
        compared = 1
        while n:
            tied = np.zeros(n, dtype=bool)
            tied[1:] = group[1:] == group[:-1]
            tied[:-1] |= tied[1:]
            # A suffix that has ended stays tied with its equals, in place order.
            open_ = np.flatnonzero(tied & (to_end[order] >= compared))
            if not len(open_):
                break
            at, own = order[open_], group[open_]
            follow = rank[at + compared]
            again = np.lexsort((follow, own))
            at, follow = at[again], follow[again]
            fresh = np.ones(len(at), dtype=bool)
            fresh[1:] = (own[1:] != own[:-1]) | (follow[1:] != follow[:-1])
            renewed = np.maximum.accumulate(np.where(fresh, open_, 0))
            order[open_], group[open_] = at, renewed
            rank[at] = renewed + 1
            compared *= 2
        return order

    def _wavelet(self, values: np.ndarray) -> None:
        """Per bit from the highest: zeros before each row, rows then parted by that bit."""
        self.levels = []
        for bit in range(max(1, (self.size - 1).bit_length()) - 1, -1, -1):
            ones = (values >> bit & 1).astype(bool)
            zeros = np.concatenate([[0], np.cumsum(~ones)]).astype(np.int32)
            self.levels.append((bit, zeros, int(zeros[-1])))
            values = np.concatenate([values[~ones], values[ones]])

    def rank(self, values: np.ndarray, *rows: np.ndarray) -> list[np.ndarray]:
        """How often each value stands before the suffixes above the given row."""
        rows = [np.zeros_like(values, dtype=np.int64), *rows]
        for bit, zeros, total in self.levels:
            one = (values >> bit & 1).astype(bool)
            for k, r in enumerate(rows):
                z = zeros[r]
                rows[k] = np.where(one, total + r - z, z)
        return [r - rows[0] for r in rows[1:]]

    def search(self, backward: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The rows [low, high) of each phrase; phrases are given last word first."""
        low = np.zeros(len(lengths), dtype=np.int64)
        high = np.full(len(lengths), self.rows, dtype=np.int64)
        for step in range(backward.shape[1]):
            live = np.flatnonzero((lengths > step) & (high > low))
            if not len(live):
                break
            word = backward[live, step].astype(np.int64)
            known = word < self.size - 1
            start = self.first[np.minimum(word, self.size - 1)]
            a, b = self.rank(np.where(known, word, 0), low[live], high[live])
            low[live] = np.where(known, start + a, 0)
            high[live] = np.where(known, start + b, 0)
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """The place of each row: steps back to a sampled one, plus their number."""
        found = np.empty(len(rows), dtype=np.int64)
        open_, at, steps = np.arange(len(rows)), rows, 0
        while len(open_):
            kept = self.kept[at]
            found[open_[kept]] = self.sampled[self.kept_rank[at[kept]] - 1] + steps
            open_, at = open_[~kept], at[~kept]
            word = self.before[at].astype(np.int64)
            at = self.first[word] + self.rank(word, at)[0]
            steps += 1
        return found


def _ranges(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All rows of the ranges, and the range of each."""
    size = high - low
    which = np.repeat(np.arange(len(low)), size)
    return low[which] + np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size), which


class Shard:
    """Whole documents, searched together."""

    def __init__(self, texts: list[list[int]]):
        self.sizes = np.array([len(t) for t in texts], dtype=np.int64)
        self.starts = np.cumsum(self.sizes + 1) - self.sizes - 1
        self.text = np.zeros(int((self.sizes + 1).sum()), dtype=np.int32)
        for start, words in zip(self.starts, texts):
            self.text[start:start + len(words)] = words

    def search(self, phrases: Phrases) -> tuple[list[set], list[list[tuple[int, int]]]]:
        """Per document: the items found, and merged spans of hit words."""
        items = [set() for _ in self.sizes]
        edges = np.zeros(len(self.text) + 1, dtype=np.int64)
        index = FMIndex(self.text)
        low, high = index.search(phrases.backward, phrases.lengths)
        found = np.flatnonzero(high > low)
        # As many phrases at a time as have about LOCATE_AT_ONCE occurrences.
        parts = np.cumsum(high[found] - low[found]) // LOCATE_AT_ONCE
        for part in np.unique(parts):
            own = found[parts == part]
            rows, which = _ranges(low[own], high[own])
            at, size = index.locate(rows), phrases.lengths[own][which]
            np.add.at(edges, at, 1)
            np.add.at(edges, at + size, -1)
            doc = np.searchsorted(self.starts, at, side="right") - 1
            for d, k in np.unique(np.stack([doc, own[which]], axis=1), axis=0):
                items[d].update(phrases.owners[k])
        hit = np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8)])
        change = np.flatnonzero(np.diff(hit)).reshape(-1, 2)
        spans = [[] for _ in self.sizes]
        for a, b in change:
            d = int(np.searchsorted(self.starts, a, side="right") - 1)
            spans[d].append((int(a - self.starts[d]), int(b - self.starts[d])))
        return items, spans


def _search(shared, window: int, columns: tuple[str, str, str, str], shard_words: int
            ) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Search one pass's phrases; found items and spans join those of earlier passes."""
    text, n_words, items, spans = columns

    def flush(batch: pa.RecordBatch, coded: list[list[int]], phrases: Phrases) -> pa.RecordBatch:
        got_items, got_spans = Shard(coded).search(phrases)
        old_items, old_spans = batch[items].to_pylist(), batch[spans].to_pylist()
        merged = [sorted({*(a or ()), *b}) for a, b in zip(old_items, got_items)]
        both = [_union([*((s["start"], s["end"]) for s in a or ()), *b]) for a, b in zip(old_spans, got_spans)]
        made = {n_words: [len(c) for c in coded], items: merged,
                spans: [[{"start": a, "end": b} for a, b in s] for s in both]}
        return pa.RecordBatch.from_arrays(
            [pa.array(made[f.name], f.type) if f.name in made else batch[f.name] for f in batch.schema],
            schema=batch.schema)

    def run(batches):
        phrases = Phrases(shared.value, window)
        code = phrases.codes.get
        for batch in batches:
            coded, begin, size = [], 0, 0
            for i, t in enumerate(batch[text].cast(pa.binary()).to_pylist()):
                coded.append([code(w, 0) for w in words_of(t)])
                size += len(coded[-1]) + 1
                if size >= shard_words:
                    yield flush(batch.slice(begin, i + 1 - begin), coded, phrases)
                    coded, begin, size = [], i + 1, 0
            if coded:
                yield flush(batch.slice(begin), coded, phrases)
    return run


def _union(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    merged: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if merged and a <= merged[-1][1]:
            merged[-1] = (merged[-1][0], max(b, merged[-1][1]))
        else:
            merged.append((a, b))
    return merged


def word_spans_to_chars(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as code points of the text, end exclusive."""
    places = [m.span() for m in _WORD_CASED.finditer(text)] if spans else []
    return [(places[a][0], places[b - 1][1]) for a, b in spans]


def find_windows(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id",
                 item_text: str = "text", window: int = WINDOW_WORDS, shard_words: int = SHARD_WORDS,
                 pass_bytes: int = PASS_BYTES, names: tuple[str, str, str] = ("n_words", "items", "spans"),
                 ) -> DataFrame:
    """``docs`` with the words of each text, the items found in it and the spans of words they hit.

    Words are runs of ASCII letters, digits and all characters beyond ASCII, A-Z
    lower-cased. An item's windows are all its runs of ``window`` words; a shorter
    item is one window. A null or empty text has no words, no items and no spans;
    so has everything if the benchmark is empty. Items without words are never
    found, items with a null id hit words but are not listed, several rows of one
    id are one item. Repeated rows are each answered. ``names`` are the three new
    columns, which must be free in ``docs``.

    Documents are not shuffled. A benchmark over ``pass_bytes`` is searched in as
    many passes as it takes, each broadcasting its own part; one item may be larger.
    """
    n_words, items, spans = names
    spark = docs.sparkSession
    wanted = benchmark.select(F.col(item_id).alias("item"), F.col(item_text).cast("binary").alias("words")).where(
        F.length("words") > 0)
    size = wanted.agg(F.sum(F.length("words"))).first()[0] or 0
    passes = max(1, -(-size // pass_bytes))
    kind = benchmark.schema[item_id].dataType.simpleString()
    found = docs.select(
        "*", F.lit(None).cast("long").alias(n_words), F.lit(None).cast(f"array<{kind}>").alias(items),
        F.lit(None).cast("array<struct<start:long,end:long>>").alias(spans))
    dealt = F.pmod(F.xxhash64("item", "words"), F.lit(passes))
    for k in range(passes):
        part = [(r["item"], bytes(r["words"])) for r in wanted.where(dealt == k).toLocalIterator()]
        shared = spark.sparkContext.broadcast(part)
        found = found.mapInArrow(_search(shared, window, (text, n_words, items, spans), shard_words), found.schema)
    return found


def hit_words(spans: str) -> Column:
    """The words that lie in some span."""
    return F.aggregate(spans, F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])


def _cut(text: str, spans: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            out = []
            for t, found in zip(batch[text].to_pylist(), batch[spans].to_pylist()):
                for a, b in reversed(word_spans_to_chars(t, [(s["start"], s["end"]) for s in found or ()])):
                    t = t[:a] + t[b:]
                out.append(t)
            at = batch.schema.get_field_index(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))
    return run


def cut_spans(found: DataFrame, text: str = "text", spans: str = "spans") -> DataFrame:
    """What ``find_windows`` returned, with the spans cut out of the texts."""
    return found.mapInArrow(_cut(text, spans), found.schema)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` in which no window occurs, with all their columns."""
    names = tuple(free_name(docs, n) for n in ("_n_words", "_items", "_spans"))
    found = find_windows(docs, benchmark, text, names=names)
    return found.where(F.size(names[2]) == 0).select(docs.columns)
