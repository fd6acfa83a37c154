"""Merkle manifest of a dataset, with proofs by octopus multiproofs.

Leaves are hashed where their rows are and put in order by one range sort. Trees
grow some levels at a time: a block of neighbouring nodes is one small group,
and its top goes on. All nodes are kept in one table by coordinate. To prove
leaves, each partition of them works out which coordinates it cannot derive from
its own leaves, fetches these once, derives the interior nodes that its leaves
share, and expands every leaf's proof from what it then has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marquee.llm.common import attach
from marquee.operators.ordering import positions
from marquee.session import durable

# Levels that one pass adds: a block has 2 ** LEVELS_AT_ONCE nodes at most.
LEVELS_AT_ONCE = 10
# Leaves that are proved together.
PART_LEAVES = 2_048
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# The tree over the roots of the others; no key of those is empty.
TOP = ""


def node_hash(*digests: str) -> str:
    return sha256("".join(digests).encode()).hexdigest()


def depth(leaves: int) -> int:
    """Levels above the leaves; none above a lone one."""
    return max(0, leaves - 1).bit_length()


def leaf_hash(fields: dict[str, Column]) -> Column:
    """Hash of the fields, each ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    def put(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[put(v) for v in fields.values()]), 256)


def tree_key(lang: Column) -> Column:
    """Never null or empty, and in the order of the values, null first."""
    return F.coalesce(F.concat(F.lit("="), lang), F.lit("-"))


def _grown(levels: int) -> Callable[[pa.Table], pa.Table]:
    """The nodes above one block, from its lowest level up."""
    def run(batch: pa.Table) -> pa.Table:
        found = sorted(zip(batch["at"].to_pylist(), batch["hash"].to_pylist()))
        tree, level = batch["tree"][0].as_py(), batch["level"][0].as_py()
        base, hashes = found[0][0], [h for _, h in found]
        out: list[tuple[str, int, int, str]] = []
        for up in range(1, min(levels, depth(batch["size"][0].as_py())) + 1):
            hashes = [node_hash(*hashes[k:k + 2]) for k in range(0, len(hashes), 2)]
            base >>= 1
            out += [(tree, level + up, base + k, h) for k, h in enumerate(hashes)]
        return pa.table(dict(zip(("tree", "level", "at", "hash"), [list(c) for c in zip(*out)])), schema=NODE_ARROW)
    return run


NODE = "tree string, level int, at long, hash string"
NODE_ARROW = pa.schema([("tree", pa.string()), ("level", pa.int32()), ("at", pa.int64()), ("hash", pa.string())])


def grow(leaves: DataFrame, levels_at_once: int = LEVELS_AT_ONCE) -> DataFrame:
    """All nodes ``tree, level, at, hash`` of the trees over ``leaves`` (``tree, at, hash, size``).

    ``at`` numbers a tree's leaves from 0, ``size`` is how many there are. Each
    two neighbours become one node, a last one alone too, until one is left.
    """
    tier = durable(leaves.select("tree", F.lit(0).alias("level"), "at", "hash", "size"), "nodes")
    nodes = tier.drop("size")
    levels = depth(tier.agg(F.max("size")).first()[0] or 0)
    step = 1 << levels_at_once
    for start in range(0, levels, levels_at_once):
        block = F.shiftright("at", levels_at_once).alias("block")
        above = durable(tier.where(F.col("size") > 1).groupBy("tree", block)
                        .applyInArrow(_grown(levels_at_once), NODE), "nodes")
        nodes = nodes.unionByName(above)
        # Tops of blocks go on where their tree has more than one.
        sizes = (tier.where((F.col("at") == 0) & (F.col("size") > step))
                 .select("tree", F.ceil(F.col("size") / step).cast("long").alias("size")))
        tops = above.where(F.col("level") == start + levels_at_once)
        tier = durable(attach(tops, durable(sizes, "sizes"), "tree", "size", tops.count()), "nodes")
    return nodes


class Coordinates(NamedTuple):
    """Places of nodes on the way from some leaves to the root, level by level."""

    missing: list[np.ndarray]  # siblings that can't be derived
    known: list[np.ndarray]    # what can, the leaves first
    sizes: list[int]


def octopus(leaves: np.ndarray, size: int) -> Coordinates:
    """The least set of nodes that, with these leaves, gives the root."""
    known, missing, sizes = [np.unique(leaves)], [], [size]
    for _ in range(depth(size)):
        beside = known[-1] ^ 1
        missing.append(np.setdiff1d(beside[beside < sizes[-1]], known[-1]))
        known.append(np.unique(known[-1] >> 1))
        sizes.append((sizes[-1] + 1) >> 1)
    return Coordinates(missing, known, sizes)


def _by_tree(rows: pa.Table) -> Iterator[tuple[str, np.ndarray, int, int]]:
    """(tree, row numbers, leaves in the tree, place among the trees) for each tree in a partition."""
    trees = np.array(rows["tree"].to_pylist(), object)
    for tree in dict.fromkeys(trees):
        at = np.flatnonzero(trees == tree)
        first = int(at[0])
        yield tree, at, rows["size"][first].as_py(), rows["place"][first].as_py()


def _wanted(trees: int):
    """What one partition has to fetch: siblings it can't derive, and the roots to compare with."""
    def run(rows: pa.Table) -> pa.Table:
        part, out, places = rows["part"][0].as_py(), [], []
        at = rows["at"].to_numpy()
        for tree, own, size, place in _by_tree(rows):
            found = octopus(at[own], size)
            out += [(tree, k, int(x)) for k, level in enumerate(found.missing) for x in level]
            out.append((tree, depth(size), 0))
            places.append(place)
        found = octopus(np.array(places), trees)
        out += [(TOP, k, int(x)) for k, level in enumerate(found.missing) for x in level]
        out.append((TOP, depth(trees), 0))
        tree, level, place = zip(*dict.fromkeys(out))
        return pa.table({"part": pa.array([part] * len(tree), pa.int64()), "tree": list(tree),
                         "level": pa.array(level, pa.int32()), "at": pa.array(place, pa.int64())})
    return run


def _derive(found: Coordinates, hashes: dict[tuple[int, int], str]) -> None:
    """Add all interior nodes that the known leaves and the fetched nodes give."""
    for level, places in enumerate(found.known[1:], 1):
        below = found.sizes[level - 1]
        for x in places.tolist():
            pair = [hashes[level - 1, y] for y in (2 * x, 2 * x + 1) if y < below]
            hashes[level, x] = node_hash(*pair)


def _path(at: int, size: int, hashes: dict[tuple[int, int], str]) -> list[tuple[str, bool]]:
    """(sibling or nothing, whether it stands left) per level, from the leaf up."""
    out = []
    for level in range(depth(size)):
        beside = at ^ 1
        out.append((hashes[level, beside] if beside < size else "", beside < at))
        at, size = at >> 1, (size + 1) >> 1
    return out


def fold(leaf: str, path: list[tuple[str, bool]]) -> str:
    for sibling, left in path:
        leaf = node_hash(sibling, leaf) if left else node_hash(leaf, sibling)
    return leaf


def _expanded(trees: int):
    """Proofs of one partition's leaves, from these and the nodes it fetched."""
    def run(rows: pa.Table, fetched: pa.Table) -> pa.Table:
        given: dict[str, dict[tuple[int, int], str]] = {}
        for tree, level, place, digest in zip(*(fetched[c].to_pylist() for c in ("tree", "level", "at", "hash"))):
            given.setdefault(tree, {})[level, place] = digest
        at, leaf = rows["at"].to_pylist(), rows["leaf"].to_pylist()
        claimed = rows["claimed"].to_pylist()
        count = rows.num_rows
        subroot, root, proof, folded = ([""] * count for _ in range(4))
        sides = list(_by_tree(rows))
        top = given[TOP]
        published = top[depth(trees), 0]
        for tree, own, size, place in sides:
            top[0, place] = given[tree][depth(size), 0]
        _derive(octopus(np.array([place for *_, place in sides]), trees), top)
        for tree, own, size, place in sides:
            hashes, numbers = given[tree], own.tolist()
            published_subroot = hashes[depth(size), 0]
            hashes.update({(0, at[k]): leaf[k] for k in numbers})
            _derive(octopus(np.array([at[k] for k in numbers]), size), hashes)
            above = _path(place, trees, top)
            for k in numbers:
                path = _path(at[k], size, hashes) + above
                subroot[k], root[k] = published_subroot, published
                proof[k] = node_hash(*[s for s, _ in path])
                folded[k] = fold(claimed[k], path)
        verified = [a == b for a, b in zip(folded, root)]
        return pa.table([rows["doc_id"], rows["leaf"], pa.array(subroot), pa.array(root), pa.array(proof),
                         pa.array(folded), pa.array(verified)],
                        names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"])
    return run


def manifest(docs: DataFrame, claimed: dict[str, Column] | None = None, part_leaves: int = PART_LEAVES,
             levels_at_once: int = LEVELS_AT_ONCE) -> tuple[DataFrame, DataFrame, int]:
    """The leaves in their places, all nodes, and the number of trees.

    Leaves have ``doc_id, lang, leaf, claimed, tree, at, size, place, part``;
    ``claimed`` is the hash with some fields replaced, as a holder of the row may
    claim them. Both tables are written.
    """
    fields = {name: F.col(name) for name in FIELDS}
    hashed = docs.select(
        "doc_id", "lang", leaf_hash(fields).alias("leaf"),
        leaf_hash({**fields, **(claimed or {})}).alias("claimed"), tree_key(F.col("lang")).alias("tree"))
    # Nulls come first; equal ids go by what the rows hold, so order is not left to chance.
    placed = durable(positions(hashed, ["tree", "doc_id", "leaf"], "position"), "leaves")
    trees = durable(positions(placed.groupBy("tree").agg(
        F.min("position").alias("first"), F.count("*").alias("size")), ["tree"], "place"), "trees")
    counts = trees.agg(F.count("*"), F.sum("size")).first()
    leaves = durable(attach(placed, trees, "tree", "size", counts[1] or 0).select(
        "doc_id", "lang", "leaf", "claimed", "tree", (F.col("position") - F.col("first")).alias("at"), "size", "place",
        F.floor(F.col("position") / part_leaves).alias("part")), "leaves")
    own = grow(leaves.select("tree", "at", F.col("leaf").alias("hash"), "size"), levels_at_once)
    # The root of a tree is its only node on its last level.
    last = F.when(F.col("size") > 1, F.length(F.bin(F.col("size") - 1))).otherwise(0)
    subroots = (own.where(F.col("at") == 0)
                .join(trees.select("tree", "place", last.alias("level")), ["tree", "level"])
                .select(F.lit(TOP).alias("tree"), F.col("place").alias("at"), "hash",
                        F.lit(counts[0]).cast("long").alias("size")))
    return leaves, own.unionByName(grow(subroots, levels_at_once)), counts[0]


def prove(leaves: DataFrame, nodes: DataFrame, trees: int) -> DataFrame:
    """Per leaf: ``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified``.

    ``leaves`` may be any of a manifest's, in any parts of bounded size.
    """
    wanted = leaves.groupBy("part").applyInArrow(
        _wanted(trees), "part long, tree string, level int, at long")
    fetched = durable(nodes.join(wanted, ["tree", "level", "at"]), "fetched")
    return leaves.groupBy("part").cogroup(fetched.groupBy("part")).applyInArrow(
        _expanded(trees), leaves.select(
            "doc_id", "leaf", *[F.lit("").alias(c) for c in ("subroot", "root", "proof_sha256", "folded_root")],
            F.lit(True).alias("verified")).schema)


def verify(docs: DataFrame, claimed: dict[str, Column] | None = None) -> DataFrame:
    """Proofs of all rows of ``docs`` against the root over all of them.

    A row is a leaf: the hash of its ``doc_id, source, lang, n_chars, text``,
    whole texts of any length, nulls told apart from empty ones. Each lang is a
    tree, null too, its leaves by id, null first; rows that share an id follow
    each other by their hash, and repeated rows are leaves of their own. The roots of
    the trees are the leaves of the top tree, by lang, null first.
    ``proof_sha256`` is the hash of all siblings from leaf to root;
    ``folded_root`` comes from these and the leaf as ``claimed``. Other columns
    are not read, whatever their names. An empty table gives an empty result.
    """
    return prove(*manifest(docs, claimed))
