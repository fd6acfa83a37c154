"""Hard negatives for anchors, found by walking lists that clusters of anchors share.

Anchors are clustered by direction. For each cluster every row has an upper
bound on its inner product with any member of unit length: its own length times
the cosine of its angle to the centre less the widest angle of a member. The
rows are sorted by that bound once per cluster and cut into pages. All members
of a cluster walk its pages from the top; one stops when no row further down
can change its result, which the bound of the next page certifies. Pages are
walked in rounds that grow by a factor, so rounds are few; a member that is done
takes no part in the next one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.operators.ordering import top_by
from marquee.session import durable

# Each cluster has a sorted list of all rows, so this many copies of the vectors are written.
CLUSTERS = 8
# The centres are fitted on this many anchors at most; any centres give the same result.
SAMPLE_ANCHORS = 4_096
FIT_STEPS = 10
PAGE_ROWS = 1_024
# Members of a cluster that meet a page together, and packs of them per copy of a page.
PACK_MEMBERS = 256
PACKS_PER_COPY = 16
ROUND_FACTOR = 4
# Bounds are worked out in floating point; this much, relative, is added to each.
SLACK = 1e-6
POSITIVES, NEGATIVES = 5, 10
LOW_PERCENT, HIGH_PERCENT = 30, 90
# Inner products below this are exact in floating point.
EXACT = float(1 << 52)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
# Components beyond this, 256 times larger than any 32-bit float, count as this.
LARGEST = 1e150


def _matrix(vectors: list[bytes], width: int | None = None) -> np.ndarray:
    """Rows of equal length; shorter ones end in zeros."""
    rows = [np.frombuffer(v, "<f8") for v in vectors]
    width = max([width or 0, *map(len, rows)])
    out = np.zeros((len(rows), width))
    for k, row in enumerate(rows):
        out[k, :len(row)] = row
    return out


def _lengths(matrix: np.ndarray) -> np.ndarray:
    return np.sqrt(np.einsum("ij,ij->i", matrix, matrix))


def inner(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows with rows as 64-bit numbers; what lies beyond is the least or largest of these."""
    if _lengths(a).max(initial=0) * _lengths(b).max(initial=0) < EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [[[int(x) for x in row] for row in side] for side in (a, b)]
    return np.array([[min(MOST, max(LEAST, sum(x * y for x, y in zip(u, v)))) for v in whole[1]] for u in whole[0]],
                    np.int64).reshape(len(a), len(b))


def _cosines(matrix: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cosine of each row with each centre of unit length, and the rows' lengths; a zero row has cosine 1."""
    width = max(matrix.shape[1], centres.shape[1])
    a, b = (np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (matrix, centres))
    lengths = _lengths(a)
    safe = np.where(lengths > 0, lengths, 1)[:, None]
    return np.where(lengths[:, None] > 0, np.clip(a / safe @ b.T, -1, 1), 1.0), lengths


def fit_centres(vectors: list[bytes], clusters: int = CLUSTERS) -> np.ndarray:
    """Centres of unit length, by spherical k-means from the first distinct directions."""
    matrix = _matrix(vectors)
    lengths = _lengths(matrix)
    unit = np.unique(matrix[lengths > 0] / lengths[lengths > 0, None], axis=0)
    if not len(unit):
        return np.eye(1, max(1, matrix.shape[1]))
    # Each further centre is the direction that is farthest from those before.
    chosen = [0]
    nearest = unit @ unit[0]
    while len(chosen) < min(clusters, len(unit)):
        chosen.append(int(nearest.argmin()))
        nearest = np.maximum(nearest, unit @ unit[chosen[-1]])
    centres = unit[chosen]
    for _ in range(FIT_STEPS):
        own = (unit @ centres.T).argmax(axis=1)
        for k in range(len(centres)):
            middle = unit[own == k].sum(axis=0)
            if (size := np.linalg.norm(middle)) > 0:
                centres[k] = middle / size
    return centres


def _batch_rows(batch: pa.RecordBatch) -> np.ndarray:
    return _matrix(batch["vector"].to_pylist())


def _assigned(centres: np.ndarray):
    """Each anchor's nearest centre, the angle to it, and its own length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosines, lengths = _cosines(_batch_rows(batch), centres)
            own = cosines.argmax(axis=1)
            angle = np.arccos(cosines[np.arange(len(own)), own])
            yield (batch.append_column("cluster", pa.array(own.astype(np.int32)))
                   .append_column("angle", pa.array(angle)).append_column("length", pa.array(lengths)))
    return run


def _bounded(centres: np.ndarray, clusters: dict[int, float]):
    """Every row once per cluster, with the bound on its product with a member of unit length."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cosines, lengths = _cosines(_batch_rows(batch), centres)
            for cluster, widest in clusters.items():
                angle = np.maximum(0, np.arccos(cosines[:, cluster]) - widest)
                bound = lengths * np.cos(angle) + SLACK * (1 + lengths)
                yield (batch.append_column("cluster", pa.array(np.full(len(bound), cluster, np.int32)))
                       .append_column("bound", pa.array(bound)))
    return run


PAGE = ("cluster int, part int, seq int, rows int, wide int, upper double, row binary, vec_id binary, "
        "label binary, vectors binary")
PAGE_TYPES = [pa.int32()] * 5 + [pa.float64()] + [pa.binary()] * 4


def _page(rows: list[dict], part: int, seq: int) -> pa.RecordBatch:
    """Sorted rows of one cluster as one row; a null id comes after all others."""
    matrix = _matrix([r["vector"] for r in rows])
    wide = 2 if np.abs(matrix).max(initial=0) < 1 << 15 else 8
    longs = [np.array([MOST if r[c] is None else r[c] for r in rows], "<i8").tobytes() for c in ("row", "vec_id", "label")]
    values = [rows[0]["cluster"], part, seq, len(rows), wide, rows[0]["bound"], *longs,
              matrix.astype("<i2" if wide == 2 else "<f8").tobytes()]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, PAGE_TYPES)],
                                      [c.split()[0] for c in PAGE.split(", ")])


def _paged(page_rows: int):
    """The sorted rows of a partition as pages, in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, kept = TaskContext.get().partitionId(), 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if kept and (kept[0]["cluster"] != row["cluster"] or len(kept) == page_rows):
                    yield _page(kept, part, seq)
                    kept, seq = [], seq + 1
                kept.append(row)
        if kept:
            yield _page(kept, part, seq)
    return run


def shared_lists(rows: DataFrame, centres: np.ndarray, widest: dict[int, float], page_rows: int = PAGE_ROWS
                 ) -> DataFrame:
    """The sorted list of every cluster as pages ``cluster, page, upper, ...``, written."""
    spread = rows.select("row", "vec_id", "label", "vector").mapInArrow(
        _bounded(centres, widest), "row long, vec_id long, label long, vector binary, cluster int, bound double")
    # Equal bounds are told apart, so that many equal vectors spread over partitions too.
    order = [F.col("cluster"), F.col("bound").desc(), F.col("row")]
    made = durable(spread.repartitionByRange(*order).sortWithinPartitions(*order)
                   .mapInArrow(_paged(page_rows), PAGE), "pages")
    # One row per partition and cluster; a partition has one cluster unless it holds an edge.
    counts = made.groupBy("cluster", "part").agg(F.count("*").alias("n"), F.min("seq").alias("first"))
    earlier = Window.partitionBy("cluster").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("cluster", "part", "first", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    return durable(made.join(F.broadcast(starts), ["cluster", "part"])
                   .withColumn("page", F.col("base") + F.col("seq") - F.col("first"))
                   .drop("part", "seq", "base", "first"), "pages")


FOUND = "anchor long, win int, row long, vec_id long, score long"
FOUND_ARROW = pa.schema([("anchor", pa.int64()), ("win", pa.int32()), ("row", pa.int64()), ("vec_id", pa.int64()),
                         ("score", pa.int64())])


def _meet(same_label: bool, most: int):
    """Packs of members with one page of their list: the best rows in every window that is still open."""
    def run(packs: pa.Table, pages: pa.Table) -> pa.Table:
        out: list[tuple] = []
        for page in pages.to_pylist():
            row, vec_id, label = (np.frombuffer(page[c], "<i8") for c in ("row", "vec_id", "label"))
            own = np.frombuffer(page["vectors"], "<i2" if page["wide"] == 2 else "<f8").reshape(page["rows"], -1)
            for members in packs["members"].to_pylist():
                sought = _matrix([m["vector"] for m in members], own.shape[1])
                scores = inner(sought, np.pad(own.astype(float), ((0, 0), (0, sought.shape[1] - own.shape[1]))))
                for member, score in zip(members, scores):
                    fits = ((label == member["label"]) == same_label) & (row != member["anchor"])
                    for win in member["wins"]:
                        if page["upper"] * member["length"] < win["least"]:
                            continue
                        at = np.flatnonzero(fits & (score >= win["least"]) & (score <= win["hi"]))
                        if len(at) > most:
                            # All that tie with the last one stay until ids decide.
                            at = at[score[at] >= np.partition(score[at], -most)[-most]]
                        at = at[np.lexsort((row[at], vec_id[at], -score[at].astype(float), -score[at]))[:most]]
                        out += [(member["anchor"], win["win"], *x) for x in
                                zip(row[at].tolist(), vec_id[at].tolist(), score[at].tolist())]
        columns = zip(*out) if out else [[]] * 5
        return pa.table([pa.array(list(c), f.type) for c, f in zip(columns, FOUND_ARROW)], schema=FOUND_ARROW)
    return run


def walk(members: DataFrame, windows: DataFrame, pages: DataFrame, same_label: bool, most: int) -> DataFrame:
    """The first ``most`` rows in each window of each member: ``anchor, win, row, vec_id, score, rank``.

    ``windows`` has ``anchor, win, lo, hi``: scores from ``lo`` to ``hi``, higher
    ones first, ties by ``vec_id``. A window is done once the next page's bound
    is below its last row, or below ``lo``.
    """
    # One row per cluster, of which there are CLUSTERS at most.
    lists = {c: (n, p) for c, n, p in members.groupBy("cluster").agg(F.max("pack"))
             .join(pages.groupBy("cluster").agg(F.count("*").alias("pages")), "cluster")
             .select("cluster", "pages", "max(pack)").collect()}
    spark = members.sparkSession
    shape = F.broadcast(spark.createDataFrame([(c, n, p // PACKS_PER_COPY) for c, (n, p) in lists.items()],
                                              "cluster int, pages long, last_copy long"))
    order = [F.col("score").desc(), F.col("vec_id"), F.col("row")]
    best = None
    open_now = windows.where(F.col("lo") <= F.col("hi")).withColumn("least", F.col("lo"))
    start, count = 0, 1
    while lists and start < max(n for n, _ in lists.values()):
        wins = open_now.groupBy("anchor").agg(F.collect_list(F.struct("win", "least", "hi")).alias("wins"))
        packs = (members.join(wins, "anchor").groupBy("cluster", "pack")
                 .agg(F.collect_list(F.struct("anchor", "label", "length", "vector", "wins")).alias("members")))
        stop = F.least(F.lit(start + count), F.col("pages")) - 1
        asked = (packs.join(shape, "cluster").where(stop >= start)
                 .select("cluster", F.floor(F.col("pack") / PACKS_PER_COPY).alias("copy"),
                         F.explode(F.sequence(F.lit(start).cast("long"), stop)).alias("page"), "members"))
        shown = (pages.where(F.col("page").between(start, start + count - 1)).join(shape.drop("pages"), "cluster")
                 .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), "last_copy"))).drop("last_copy"))
        cell = ["cluster", "page", "copy"]
        found = (asked.groupBy(*cell).cogroup(shown.groupBy(*cell))
                 .applyInArrow(_meet(same_label, most), FOUND))
        best = durable(top_by(found if best is None else best.drop("rank").unionByName(found),
                              ["anchor", "win"], order, most), "best")
        start, count = start + count, count * ROUND_FACTOR
        # What the next page could still add to.
        last = best.groupBy("anchor", "win").agg(F.count("*").alias("n"), F.min("score").alias("last"))
        upper = F.broadcast(pages.where(F.col("page") == start).select("cluster", "upper"))
        open_now = durable(
            windows.where(F.col("lo") <= F.col("hi")).join(last, ["anchor", "win"], "left")
            .withColumn("least", F.when(F.col("n") >= most, F.col("last")).otherwise(F.col("lo")))
            .join(members.select("anchor", "cluster", "length"), "anchor").join(upper, "cluster")
            .where(F.col("length") * F.col("upper") >= F.col("least"))
            .select("anchor", "win", "lo", "hi", "least"), "open")
        if open_now.isEmpty():
            break
    return best if best is not None else spark.createDataFrame([], FOUND + ", rank int")


def _quantised(factor: float):
    """Components times ``factor``, rounded down, as binary doubles."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.clip(np.floor(np.array(v, float) * factor), -LARGEST, LARGEST).astype("<f8").tobytes()
                     for v in batch["vector"].to_pylist()]
            yield batch.drop_columns(["vector"]).append_column("vector", pa.array(found, pa.binary()))
    return run


def read_vectors(table: DataFrame, vec_id: str | Column, label: str | Column, vector: str | Column,
                 anchor: Column, factor: float) -> DataFrame:
    """The rows that take part, as ``row, vec_id, label, is_anchor, vector``, written."""
    given = table.select(
        F.monotonically_increasing_id().alias("row"), (F.col(vec_id) if isinstance(vec_id, str) else vec_id)
        .cast("long").alias("vec_id"), (F.col(label) if isinstance(label, str) else label).cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("is_anchor"),
        (F.col(vector) if isinstance(vector, str) else vector).cast("array<double>").alias("vector"))
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = given.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & ~bad)
    return durable(kept.mapInArrow(
        _quantised(factor), "row long, vec_id long, label long, is_anchor boolean, vector binary"), "vectors")


def mine(table: DataFrame, anchor: Column, vec_id: str | Column = "vec_id", label: str | Column = "label",
         vector: str | Column = "embedding", factor: float = 256.0, positives: int = POSITIVES,
         negatives: int = NEGATIVES, low: int = LOW_PERCENT, high: int = HIGH_PERCENT, clusters: int = CLUSTERS,
         page_rows: int = PAGE_ROWS) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    A score is the inner product of two rows' vectors, each component times
    ``factor`` and rounded down; vectors of fewer components end in zeros. Higher
    scores come first, ties by smaller id, null ids last (2^63-1 is taken for
    null), then any order. An anchor's positives are its first other rows of the same
    label; for each, the first rows of another label whose score lies between
    ``low`` and ``high`` percent of its own are returned, none if its score is
    negative. A null label, a null vector, or a null or non-finite component
    leaves a row out. Repeated rows count each for itself. Scores beyond 64 bits are the
    largest or smallest there are. Other columns are not read, whatever their
    names. Without rows or anchors the result is empty.
    """
    rows = read_vectors(table, vec_id, label, vector, anchor, factor)
    anchors = rows.where("is_anchor")
    sample = [r["vector"] for r in anchors.orderBy(F.xxhash64("row")).limit(SAMPLE_ANCHORS).select("vector").collect()]
    centres = fit_centres(sample, clusters)
    assigned = durable(anchors.select(F.col("row").alias("anchor"), "vec_id", "label", "vector").mapInArrow(
        _assigned(centres), "anchor long, vec_id long, label long, vector binary, cluster int, angle double, "
        "length double"), "anchors")
    # One row per cluster.
    sizes = {c: (angle, n) for c, angle, n in
             assigned.groupBy("cluster").agg(F.max("angle"), F.count("*")).collect()}
    packs = F.coalesce(*[F.when(F.col("cluster") == c, -(-n // PACK_MEMBERS)) for c, (_, n) in sizes.items()], F.lit(1))
    members = durable(assigned.withColumn("pack", F.pmod(F.xxhash64("anchor"), packs)), "members")
    pages = shared_lists(rows, centres, {c: angle for c, (angle, _) in sizes.items()}, page_rows)
    every = members.select("anchor", F.lit(1).alias("win"), F.lit(LEAST).alias("lo"), F.lit(MOST).alias("hi"))
    found = walk(members, every, pages, True, positives)
    # Percent of a score without going beyond 64 bits.
    tens, ones = F.expr("score div 100"), F.col("score") % 100
    lo = tens * low + F.floor((ones * low + 99) / 100)
    hi = tens * high + F.floor(ones * high / 100)
    windows = durable(found.where("score >= 0").select(
        "anchor", F.col("rank").alias("win"), lo.alias("lo"), hi.alias("hi"),
        F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score")), "windows")
    chosen = walk(members, windows.select("anchor", "win", "lo", "hi"), pages, False, negatives)

    def known(name: str) -> Column:
        return F.when(F.col(name) != MOST, F.col(name)).alias(name)

    return (chosen.select("anchor", "win", "rank", F.col("vec_id").alias("negative_id"),
                          F.col("score").alias("negative_score"))
            .join(windows, ["anchor", "win"])
            .join(members.select("anchor", F.col("vec_id").alias("anchor_id")), "anchor")
            .select(known("anchor_id"), known("positive_id"), "rank", known("negative_id"), "positive_score",
                    "negative_score"))
