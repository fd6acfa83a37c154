import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.llm import hard_negatives

SCHEMA = "vec_id long, label int, embedding array<float>, row string, anchor int, rank string"


def brute(rows):
    kept = [(k, i, label, [math.floor(256 * float(x)) for x in v]) for k, (i, label, v) in enumerate(rows)
            if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(k, i, (label + 1) % 10 if i is not None and i % 7 == 0 else label, v) for k, i, label, v in kept]
    limit, out = hard_negatives.MOST, []
    for k, i, label, v in kept:
        if i is None or i % 100:
            continue
        scored = sorted((-min(limit, max(-limit - 1, sum(a * b for a, b in zip(v, w)))), j is None, j or 0, m != label)
                        for n, j, m, w in kept if n != k)
        for score, none, positive, _ in [s for s in scored if not s[3]][:5]:
            found = [s for s in scored if s[3] and 30 * -score <= 100 * -s[0] <= 90 * -score][:10]
            out += [(i, None if none else positive, rank, None if s[1] else s[2], -score, -s[0])
                    for rank, s in enumerate(found, 1)]
    return sorted(out, key=repr)


def mined(table, **kw):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.mine(table, F.col("vec_id") % 100 == 0, label=label, **kw)
    return sorted((tuple(r) for r in found.collect()), key=repr)


NAN = float("nan")
ODD = [(0, 1, [0.5, 0.5]), (0, 1, [0.5, 0.5]), (100, 1, [1.0, 0.0]), (3, 1, [1.0]), (4, 2, [0.5, 0.1]),
       (5, 2, [0.4, 0.4, 7.0]), (6, 3, [0.0, 0.0]), (None, 2, [0.4, 0.4]), (9, None, [1.0, 1.0]), (10, 2, None),
       (11, 2, [NAN, 1.0]), (12, 2, [None, 1.0]), (14, 2, [float("inf"), 1.0]), (200, 4, []), (300, 5, [0.0, 0.0]),
       (13, 5, [0.0, 0.0]), (400, 6, [3e38, 3e38]), (401, 6, [3e38, 1e38]), (402, 8, [3e38, -1.0]),
       (500, 9, [-0.5, -0.5])] + [(1000 + k % 5, 2 + k % 3, [0.45, 0.45]) for k in range(40)]


@pytest.mark.parametrize("data", [ODD, ODD[:1], ODD[6:8], []])
def test_odd_rows(frame, data):
    table = frame([(*r, "r", 1, None) for r in data], SCHEMA)
    assert mined(table, page_rows=4) == brute(data)


@pytest.mark.parametrize("clusters, page_rows", [(1, 8), (3, 16), (8, 1_000)])
def test_any_clusters_and_pages_give_the_same(spark, clusters, page_rows):
    rng = np.random.default_rng(1)
    middles = rng.normal(size=(6, 8))
    rows = [(k, int(k % 4), [float(x) for x in middles[k % 6] + rng.normal(size=8) * 0.3]) for k in range(900)]
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(4)
    assert mined(table, clusters=clusters, page_rows=page_rows) == brute(rows)


def test_bounds_hold_and_lists_are_sorted(spark):
    rng = np.random.default_rng(2)
    rows = [(k, k % 3, [float(x) for x in rng.normal(size=5) * rng.exponential()]) for k in range(300)]
    read = hard_negatives.read_vectors(spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>"),
                                       "vec_id", "label", "embedding", F.col("vec_id") % 10 == 0, 256.0)
    vectors = {r["row"]: np.frombuffer(r["vector"], "<f8") for r in read.collect()}
    anchors = [r["row"] for r in read.where("is_anchor").collect()]
    centres = hard_negatives.fit_centres([vectors[k].tobytes() for k in anchors], 4)
    cosines, _ = hard_negatives._cosines(np.array([vectors[k] for k in anchors]), centres)
    own = cosines.argmax(axis=1)
    widest = {int(c): float(np.arccos(cosines[own == c, c]).max()) for c in set(own)}
    pages = hard_negatives.shared_lists(read, centres, widest, 32).orderBy("cluster", "page").collect()
    for cluster in widest:
        mine = [p for p in pages if p["cluster"] == cluster]
        assert [p["page"] for p in mine] == list(range(len(mine)))
        assert [p["upper"] for p in mine] == sorted((p["upper"] for p in mine), reverse=True)
        assert sum(p["rows"] for p in mine) == len(rows)
        for page in mine:
            for a in (k for k, c in zip(anchors, own) if c == cluster):
                length = np.linalg.norm(vectors[a])
                assert all(vectors[a] @ vectors[b] <= page["upper"] * length
                           for b in np.frombuffer(page["row"], "<i8").tolist())


def test_walks_stop_early_on_clustered_rows(spark, monkeypatch):
    """Rows far from an anchor's cluster are on pages that nobody asks for."""
    rng = np.random.default_rng(3)
    middles = rng.normal(size=(8, 16)) * 5
    rows = [(k, int(k // 8 % 3), [float(x) for x in middles[k % 8] + rng.normal(size=16) * 0.1]) for k in range(3_200)]
    rounds = []
    real = hard_negatives.top_by
    monkeypatch.setattr(hard_negatives, "top_by", lambda *a: rounds.append(1) or real(*a))
    table = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert mined(table, page_rows=50) == brute(rows)
    # 64 pages are four rounds a walk, 1 + 4 + 16 + 43.
    assert len(rounds) < 8
