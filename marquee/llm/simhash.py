"""SimHash near-dedup by multi-index hashing.

Fingerprints that differ in few bits differ in very few within one of their
segments. Each distinct fingerprint is stored under each of its segments; each
looks up the small Hamming ball around each of its segments there, and what it
finds is verified on all bits. Verified links are joined into components.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from marquee.llm.common import HOT_SHARE, LOWER, attach, with_row_number
from marquee.session import durable

SHINGLE_WORDS = 4
MOST_BITS = 4
# Any number of segments finds every link: one of m segments differs in MOST_BITS // m
# bits at most. Three suit up to some 10^8 distinct fingerprints, two any more.
SEGMENTS = 3
HASH_SEED = 42
# Shingles whose bits are counted at a time.
COUNT_AT_ONCE = 1 << 16
# A table bucket with more fingerprints than this is dealt out over salts.
BUCKET_ROWS = 2_000
# Copies of a node's minimum, so that the links of a much linked node spread.
LINK_SALTS = 8
BITS = 64


def fingerprint(text: bytes | None, words: int = SHINGLE_WORDS) -> int:
    """A bit is 1 if it is set in over half of the shingles' hashes."""
    found = (text or b"").translate(LOWER).split()
    if not found:
        return 0
    joined = b" ".join(found)
    ends = np.cumsum([len(w) + 1 for w in found]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    size = min(words, len(found))
    spans = list(zip(starts[:len(found) - size + 1].tolist(), ends[size - 1:].tolist()))
    ones = np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for at in range(0, len(spans), COUNT_AT_ONCE):
        part = spans[at:at + COUNT_AT_ONCE]
        hashes = np.array([digest(joined[a:b], HASH_SEED) for a, b in part], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(spans), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        values = np.array([fingerprint(t) for t in batch["text"].to_pylist()], dtype=np.uint64)
        yield batch.drop_columns(["text"]).append_column("fp", pa.array(values.view(np.int64)))


def fingerprints(docs: DataFrame, doc_id: str, text: str, row: str | None = None) -> DataFrame:
    """``doc_id, row, fp`` of every document, written; ``row`` tells rows apart."""
    number = F.col(row) if row else F.monotonically_increasing_id()
    read = docs.select(F.col(doc_id).alias("doc_id"), number.alias("row"),
                       F.col(text).cast("binary").alias("text"))
    schema = read.drop("text").withColumn("fp", F.lit(0).cast("long")).schema
    return durable(read.mapInArrow(_fingerprints, schema), "fingerprints")


def _layout(segments: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment."""
    edges = [BITS * k // segments for k in range(segments + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _masks(width: int, radius: int) -> list[int]:
    return [sum(1 << b for b in bits) for k in range(radius + 1) for bits in combinations(range(width), k)]


def links(nodes: DataFrame, most_bits: int = MOST_BITS, segments: int = SEGMENTS,
          count: int | None = None) -> DataFrame:
    """Pairs ``a, b`` of distinct fingerprints ``fp`` that differ in 1 to ``most_bits`` bits.

    A pair may come several times. Of two segments that differ, the smaller one
    looks the larger up, so balls hold only what is not smaller than their centre.
    Both sides are shuffled: Spark sizes exploded rows as what they were exploded
    from, and would send tables of many times the rows it counts with to the driver.
    """
    count = nodes.count() if count is None else count
    stored = sought = None
    for k, (first, width) in enumerate(_layout(segments)):
        own = F.shiftrightunsigned("fp", first).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
        masks = F.array(*[F.lit(m).cast("long") for m in _masks(width, most_bits // segments)])
        ball = F.filter(F.transform(masks, lambda m: own.bitwiseXOR(m)), lambda v: v >= own)
        put = nodes.select(F.lit(k).alias("segment"), own.alias("slot"), F.col("fp").alias("b"))
        ask = nodes.select(F.lit(k).alias("segment"), F.explode(ball).alias("slot"), F.col("fp").alias("a"),
                           own.alias("own"))
        stored = put if stored is None else stored.unionByName(put)
        sought = ask if sought is None else sought.unionByName(ask)
    # At most HOT_SHARE buckets of each segment can be over this size.
    limit = max(BUCKET_ROWS, -(-count // HOT_SHARE))
    crowded = F.broadcast(stored.groupBy("segment", "slot").agg(F.count("*").alias("n"))
                          .where(F.col("n") > limit)
                          .select("segment", "slot", F.ceil(F.col("n") / limit).cast("int").alias("salts")))
    key = ["segment", "slot"]
    salts = F.coalesce("salts", F.lit(1))
    stored = (stored.join(crowded, key, "left")
              .select(*key, F.pmod(F.xxhash64("b"), salts).cast("int").alias("salt"), "b"))
    sought = (sought.join(crowded, key, "left")
              .select(*key, F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"), "a",
                      (F.col("slot") == F.col("own")).alias("same")))
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= most_bits
    once = (F.col("a") != F.col("b")) & (~F.col("same") | (F.col("a") < F.col("b")))
    return sought.join(stored.hint("merge"), [*key, "salt"]).where(near & once).select("a", "b")


def _ordered(pairs: DataFrame) -> DataFrame:
    """Pairs as (larger, smaller), once each."""
    return (pairs.where(F.col("u") != F.col("v"))
            .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())


def _with_least(pairs: DataFrame) -> DataFrame:
    """``u, v`` with ``m``, the least of ``u`` and all its ``v``; shuffled, as in ``links``."""
    least = (pairs.groupBy("u").agg(F.min("v").alias("m"))
             .select("u", F.least("u", "m").alias("m"),
                     F.explode(F.sequence(F.lit(0), F.lit(LINK_SALTS - 1))).alias("salt")))
    salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(LINK_SALTS)).cast("int"))
    return salted.join(least.hint("merge"), ["u", "salt"])


def components(pairs: DataFrame) -> DataFrame:
    """``node, root`` for every node that has a link; the root is its component's least node.

    Large-star and small-star steps in turn: each links a node's neighbours to
    the least of them, until every node is linked to its root alone. Every step
    is written, so nothing but two numbers reaches the driver.
    """
    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())

    edges = durable(_ordered(pairs.toDF("u", "v")), "links")
    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _ordered(large)
        met = _with_least(large)
        small = (met.select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(met.select("u", F.col("m").alias("v"))))
        edges = durable(_ordered(small), "links")
        after = state(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _classes(prints: DataFrame, most_bits: int, segments: int) -> tuple[DataFrame, int]:
    """Per distinct fingerprint: its rows, its component, and the row that stays of that."""
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")
    nodes = durable(prints.groupBy("fp").agg(F.min(first).alias("first"), F.count("*").alias("size")), "nodes")
    sizes = nodes.agg(F.count("*"), F.sum("size")).first()
    found = components(links(nodes.select("fp"), most_bits, segments, sizes[0]))
    rooted = (nodes.join(found.withColumnRenamed("node", "fp").hint("merge"), "fp", "left")
              .withColumn("root", F.coalesce("root", "fp")))
    # One row per distinct fingerprint; roots are as many as components. Files say little of rows in memory.
    least = rooted.groupBy("root").agg(F.min("first").alias("stays"))
    return durable(rooted.join(least.hint("merge"), "root").select("fp", "size", "stays"), "classes"), sizes[1] or 0


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                    most_bits: int = MOST_BITS, segments: int = SEGMENTS,
                    row: str | None = None) -> DataFrame:
    """One row per document: ``doc_id, row, fingerprint, component_id, stays``.

    Words are runs of non-blanks in the lower-cased text (A-Z), shingles are
    four words, repeats included; a text of fewer words is one shingle, one of
    none (null too) has fingerprint zero, which links like any other.
    ``component_id`` is the smallest id that links reach, itself included; null
    ids come last, so it is null only if the whole component has none. Of a
    component one row ``stays``: that of the smallest id, one of them if rows
    share it. ``row`` names a column that tells rows apart. Other columns are
    not read, whatever their names. An empty table gives an empty result.
    """
    prints = fingerprints(docs, doc_id, text, row)
    classes, rows = _classes(prints, most_bits, segments)
    met = attach(prints, classes, "fp", "size", rows)
    return met.select(
        "doc_id", "row", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        F.col("stays.doc_id").alias("component_id"), (F.col("row") == F.col("stays.row")).alias("stays"))


def drop_near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text",
                         most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` without all but one of each component, with all their columns."""
    numbered, row = with_row_number(docs)
    staying = (near_duplicates(numbered, doc_id, text, most_bits, row=row)
               .where("stays").select(F.col("row").alias(row)))
    return numbered.join(staying, row, "left_semi").drop(row)
