"""Byte-level BPE, encoded and decoded by DuckDB queries inside each partition.

A text is cut into words by the tokenizer's pattern. The bytes of new words are
rows (word, position, token); a recursive query joins neighbours with the merge
table and contracts the pair of least rank in every word, the leftmost first,
until no word has a pair. Decoding is one ordered aggregation of token bytes, over
the list of a document's tokens.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator, Sequence
from itertools import pairwise, repeat

import duckdb
import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  pa.compute
import regex
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import WordIds, batches_by_size

# Bytes of text that are worked on at a time; a text stays whole.
BATCH_BYTES = 4 << 20
# Bytes of words in one recursive query; a longer word has one of its own.
QUERY_BYTES = 1 << 17
# Ids in one query that decodes; the rest of a longer row comes in the next.
QUERY_IDS = 1 << 20
# Words whose ids a worker keeps; then it starts anew.
MEMO_WORDS = 1 << 19
MEMORY = "400MB"

# Words up to this many bytes go through the query for short ones.
SHORT_BYTES = 64

# A step has the rows of words that still change and nothing of the others: a
# word without a pair leaves as `done`. A key is word * 65536 + position, and a
# pick packs rank, position and the position after, so that one sort, one join
# and one minimum by numbers do a step: one contraction in every word.
_SHORT = """
WITH RECURSIVE state(key, token, done) AS (
  SELECT key, token, false FROM start
  UNION ALL (
  WITH live AS (
    SELECT key, token, lead(key) OVER w AS next_key, lead(token) OVER w AS next
    FROM state WHERE NOT done WINDOW w AS (ORDER BY key)),
  picked AS (
    SELECT key >> 16 AS word, min((merged::BIGINT << 32) | ((key & 65535) << 16) | (next_key & 65535)) AS pick
    FROM live JOIN merges ON pair = ((token::BIGINT << 32) | next) WHERE key >> 16 = next_key >> 16 GROUP BY word)
  SELECT key, CASE WHEN key & 65535 = (pick >> 16) & 65535 THEN (pick >> 32)::INT ELSE token END, pick IS NULL
  FROM live LEFT JOIN picked ON word = key >> 16 WHERE pick IS NULL OR key & 65535 <> pick & 65535))
SELECT (key >> 16)::INT AS word, token FROM state WHERE done ORDER BY key"""

# For long words, `state` has the rows that changed last, `recurring.state` all; a
# contracted pair leaves its second row without a token. Equal pairs that don't
# overlap are contracted in one step. A merge that can make a pair of a lower rank than its own ends the contractions
# of its word in that step; without one they come in any order to the same end.
_LONG = """
WITH RECURSIVE state(word, pos, token) USING KEY (word, pos) AS (
  SELECT word, pos, token FROM start
  UNION (
  WITH live AS (
    SELECT word, pos, token, lag(token) OVER w AS before, lead(pos) OVER w AS next_pos,
           lead(token) OVER w AS next, lead(token, 2) OVER w AS later, row_number() OVER w AS n
    FROM recurring.state WHERE token IS NOT NULL AND word IN (SELECT word FROM state)
    WINDOW w AS (PARTITION BY word ORDER BY pos)),
  pairs AS (
    SELECT word, pos, next_pos, before, later, n, merged, wary, min(merged) OVER (PARTITION BY word) AS least
    FROM live JOIN merges ON token = l AND next = r),
  leasts AS (
    SELECT *, n - row_number() OVER (PARTITION BY word ORDER BY n) AS run FROM pairs WHERE merged = least),
  apart AS (
    SELECT * FROM leasts QUALIFY row_number() OVER (PARTITION BY word, run ORDER BY n) % 2 = 1),
  made AS (
    SELECT word, n, unnest([before, merged, merged]) AS l, unnest([merged, merged, later]) AS r
    FROM apart WHERE wary),
  ends AS (SELECT word, min(n) AS last FROM made SEMI JOIN lowering USING (l, r) GROUP BY word),
  picked AS (
    SELECT word, pos, next_pos, merged FROM apart LEFT JOIN ends USING (word) WHERE last IS NULL OR n <= last)
  SELECT word, pos, merged FROM picked UNION ALL SELECT word, next_pos, NULL FROM picked))
SELECT word, token FROM state WHERE token IS NOT NULL ORDER BY word, pos"""

# The tokens of a row's ids, picked from the one list of all by their places.
_DECODE = "SELECT doc, list_aggregate(list_select(tokens, ids), 'string_agg', '') FROM ids, vocabulary"


def read_ranks(path: str) -> dict[bytes, int]:
    """Bytes to rank, which is the id, from a file of lines ``base64 rank``."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}


class Codec:
    """Ids of texts and back, by the ranks in a file."""

    def __init__(self, path: str, pattern: str):
        self.ranks = read_ranks(path)
        self.words = regex.compile(pattern)
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], np.int32)
        # Tokens that can be words, which are text.
        self.whole = {w: rank for t, rank in self.ranks.items() if (w := t.decode(errors="replace")).encode() == t}
        self.memo = WordIds()
        rows = [(self.ranks[t[:k]], self.ranks[t[k:]], rank) for t, rank in self.ranks.items()
                for k in range(1, len(t)) if t[:k] in self.ranks and t[k:] in self.ranks]
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": MEMORY, "temp_directory": ""})
        self._table("merges_read", dict(zip(("l", "r", "merged"), map(pa.array, zip(*rows)))) if rows else {
            n: pa.array([], pa.int64()) for n in ("l", "r", "merged")})
        self.db.execute("CREATE TABLE lowering AS SELECT l, r FROM merges_read WHERE merged < greatest(l, r)")
        self.db.execute("CREATE TABLE merges AS SELECT l::INT AS l, r::INT AS r, (l::BIGINT << 32) | r AS pair, "
                        "merged::INT AS merged, merged IN (SELECT l FROM lowering UNION SELECT r FROM lowering) AS wary FROM merges_read")
        tokens: list[str | None] = [None] * (max(self.ranks.values()) + 1)
        for token, rank in self.ranks.items():
            tokens[rank] = token.hex()
        self._table("vocabulary_read", {"tokens": pa.array([tokens], pa.list_(pa.string()))})
        self.db.execute("CREATE TABLE vocabulary AS FROM vocabulary_read")
        for name in ("merges_read", "vocabulary_read"):
            self.db.unregister(name)

    def _table(self, name: str, columns: dict[str, pa.Array]) -> None:
        self.db.register(name, pa.table(columns))

    def _contract(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words that are all short or all long, and how many each has; ``raw`` is their bytes."""
        word = np.repeat(np.arange(len(sizes)), sizes)
        pos = np.arange(len(raw)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        token = pa.array(self.of_byte[raw])
        short = sizes[0] <= SHORT_BYTES
        self._table("start", {"key": pa.array(word << 16 | pos), "token": token} if short else
                    {"word": pa.array(word.astype(np.int32)), "pos": pa.array(pos.astype(np.int32)), "token": token})
        made = self.db.sql(_SHORT if short else _LONG).to_arrow_table()
        return made["token"].to_numpy(), np.bincount(made["word"].to_numpy(), minlength=len(sizes))

    def _learn(self) -> None:
        """Ids of fresh words into the memo; a word that is a token is that token."""
        fresh = self.memo.fresh
        whole = np.fromiter(map(self.whole.get, fresh, repeat(-1)), np.int64, len(fresh))
        texts = pa.array(fresh, pa.large_binary())
        sizes = pa.compute.binary_length(texts).to_numpy()
        cut = np.flatnonzero(whole < 0)
        cut = cut[np.argsort(sizes[cut], kind="stable")]
        raw = np.frombuffer(b"".join(texts.take(pa.array(cut)).to_pylist()), np.uint8)
        sizes = sizes[cut]
        ends = np.cumsum(sizes)
        short = int(np.searchsorted(sizes, SHORT_BYTES, side="right"))
        ids, lengths, at = [], np.ones(len(fresh), np.int64), 0
        while at < len(cut):
            first = int(ends[at] - sizes[at])
            to = max(at + 1, int(np.searchsorted(ends, first + QUERY_BYTES, side="right")))
            to = min(to, short) if at < short else to
            made, lengths[cut[at:to]] = self._contract(raw[first:ends[to - 1]], sizes[at:to])
            ids.append(made)
            at = to
        order = np.concatenate([cut, np.flatnonzero(whole >= 0)])
        self.memo.learn(np.concatenate([*ids, whole[whole >= 0]]).astype(np.uint32), lengths, order)

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit numbers."""
        if len(self.memo) > MEMO_WORDS:
            self.memo.clear()
        try:
            # A text's words are numbered before the next is cut, and new ones learned together.
            at = [self.memo.number(self.words.findall(t or "")) for t in texts]
            if self.memo.fresh:
                self._learn()
        except BaseException:
            # Else the new words would pass for known ones.
            self.memo.clear()
            raise
        ids, bounds = self.memo.ids_of(np.concatenate([np.zeros(0, np.int64), *at]))
        raw = ids.astype("<u4").tobytes()
        cuts = 4 * bounds[np.cumsum([0, *map(len, at)])]
        return [raw[a:b] for a, b in pairwise(cuts.tolist())]

    def decode(self, rows: Sequence[bytes | None]) -> list[bytes]:
        """Per row of ids the bytes of its tokens."""
        out = [b""] * len(rows)
        ids = np.frombuffer(b"".join(r or b"" for r in rows), "<u4")
        ends = np.cumsum([0, *(len(r or b"") // 4 for r in rows)])
        for at in range(0, len(ids), QUERY_IDS):
            # Places count from 1.
            places = pa.array(ids[at:at + QUERY_IDS].astype(np.int64) + 1)
            bounds = pa.array(np.clip(ends - at, 0, len(places)))
            self._table("ids", {"doc": pa.array(np.arange(len(rows))),
                                "ids": pa.LargeListArray.from_arrays(bounds, places)})
            for doc, found in self.db.execute(_DECODE).fetchall():
                out[doc] += bytes.fromhex(found or "")
        return out


_codecs: dict[tuple[str, str], Codec] = {}


def _codec(path: str, pattern: str) -> Codec:
    if (path, pattern) not in _codecs:
        _codecs[path, pattern] = Codec(path, pattern)
    return _codecs[path, pattern]


Batches = Iterator[pa.RecordBatch]


def _encoded(path: str, pattern: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        codec = _codec(path, pattern)
        for whole in batches:
            for batch in batches_by_size([whole], "text", BATCH_BYTES):
                ids = codec.encode([t and t.decode() for t in batch["text"].to_pylist()])
                yield batch.drop_columns(["text"]).append_column("ids", pa.array(ids, pa.binary()))
    return run


def _decoded(path: str, pattern: str) -> Callable[[Batches], Batches]:
    def run(batches: Batches) -> Batches:
        codec = _codec(path, pattern)
        for whole in batches:
            for batch in batches_by_size([whole], "ids", 4 * BATCH_BYTES):
                yield batch.append_column("decoded", pa.array(codec.decode(batch["ids"].to_pylist()), pa.binary()))
    return run


def _read(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("binary").alias("text"))


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: ``doc_id, ids``, the ids as little-endian unsigned 32-bit numbers.

    Every match of ``pattern`` is a word; what it leaves out has no ids. A word
    that is a token is that token; any other is contracted from its bytes.
    Special tokens are ordinary text. A null or empty text has no ids; null and
    repeated ids and repeated rows have a row each; other columns are not read,
    whatever their names. Texts are encoded whole, however long, in memory that
    grows with the longest one. An empty table gives an empty result.
    """
    read = _read(docs, doc_id, text)
    return read.mapInArrow(_encoded(path, pattern), read.drop("text").withColumn("ids", F.lit(b"")).schema)


def decode(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """``tokens``, with a binary column ``ids``, and ``decoded``, the bytes they stand for.

    No ids, or null, are no bytes. An id without a token is left out.
    """
    return tokens.mapInArrow(_decoded(path, pattern), tokens.withColumn("decoded", F.lit(b"")).schema)


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one pass: ``doc_id, ids, decoded``."""
    read, to_ids, to_bytes = _read(docs, doc_id, text), _encoded(path, pattern), _decoded(path, pattern)
    schema = read.drop("text").withColumn("ids", F.lit(b"")).withColumn("decoded", F.lit(b"")).schema
    return read.mapInArrow(lambda batches: to_bytes(to_ids(batches)), schema)
