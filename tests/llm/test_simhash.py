import random
from collections import Counter

import xxhash
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from marquee.llm import simhash
from marquee.llm.common import LOWER, attach
from marquee.session import durable


def slow_fingerprint(text):
    words = [w for w in (text or "").encode().translate(LOWER).split()]
    if not words:
        return 0
    size = min(4, len(words))
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + size]), 42) for i in range(len(words) - size + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@settings(max_examples=60, deadline=None)
@given(st.text(alphabet="aB cd\t\n\x0bé", max_size=60))
def test_fingerprint_equals_the_rule(text):
    assert simhash.fingerprint(text.encode()) == slow_fingerprint(text)


def test_fingerprint_in_pieces(monkeypatch):
    text = " ".join(str(k * k % 37) for k in range(500))
    whole = simhash.fingerprint(text.encode())
    monkeypatch.setattr(simhash, "COUNT_AT_ONCE", 64)
    assert simhash.fingerprint(text.encode()) == whole == slow_fingerprint(text)


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def near_values(seed, count):
    draw, values = random.Random(seed), set()
    while len(values) < count:
        value = draw.getrandbits(64)
        for _ in range(draw.randint(1, 6)):
            values.add(value)
            for _ in range(draw.randint(1, 5)):
                value ^= 1 << draw.randrange(64)
    return sorted(values)


def brute_links(values):
    return {(a, b) for i, a in enumerate(values) for b in values[i + 1:] if 0 < (a ^ b).bit_count() <= 4}


def test_links_equal_brute_force(spark, monkeypatch):
    values = near_values(3, 400)
    wanted = brute_links(values)
    assert len(wanted) > 100
    nodes = spark.createDataFrame([(signed(v),) for v in values], "fp long")
    for segments, bucket in ((2, 2_000), (3, 2_000), (4, 3), (5, 3)):
        monkeypatch.setattr(simhash, "BUCKET_ROWS", bucket)
        found = {tuple(sorted((r["a"] % (1 << 64), r["b"] % (1 << 64))))
                 for r in simhash.links(nodes, segments=segments).collect()}
        assert found == wanted


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


def test_no_exploded_rows_are_broadcast(spark):
    """Spark counts exploded rows as those they come from, so small files would be sent to the driver many times over."""
    nodes = durable(spark.range(3_000).select(F.xxhash64("id").alias("fp")), "nodes")
    plan = final_plan(simhash.links(nodes))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    pairs = durable(spark.range(3_000).select(F.xxhash64("id").alias("u"), F.col("id").alias("v")), "pairs")
    plan = final_plan(simhash._with_least(pairs))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_no_table_of_all_fingerprints_is_broadcast(spark):
    rows = spark.range(3_000).select("id", F.xxhash64("id").alias("fp"))
    classes = durable(rows.groupBy("fp").agg(F.count("*").alias("size"), F.min("id").alias("least")), "classes")
    plan = final_plan(attach(rows, classes, "fp", "size", 3_000))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def union_find(pairs):
    parent = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in pairs:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent}


def test_components_of_chains_stars_and_pairs(spark):
    pairs = [(k, k + 1) for k in range(0, 40)] + [(100, 100 + k) for k in range(1, 30)] + [(-5, 300), (300, 200)]
    random.Random(4).shuffle(pairs)
    found = {r["node"]: r["root"] for r in simhash.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    wanted = union_find(pairs)
    assert found == {n: r for n, r in wanted.items() if n != r}
    assert simhash.components(spark.createDataFrame([], "a long, b long")).count() == 0


def brute(rows):
    prints = [simhash.fingerprint(t.encode() if t else None) for _, t in rows]
    pairs = [(i, j) for i in range(len(rows)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= 4]
    roots = union_find(pairs)
    groups = {}
    for i, (number, _) in enumerate(rows):
        groups.setdefault(roots.get(i, i), []).append(number)
    return sorted(((n, f"{prints[i]:016x}", min((m for m in groups[roots.get(i, i)] if m is not None), default=None))
                   for i, (n, _) in enumerate(rows)), key=repr), len(groups)


def edited(draw, words):
    words = list(words)
    words[draw.randrange(len(words))] = "edited"
    return " ".join(words)


def test_near_copies_equal_brute_force(frame):
    draw, rows = random.Random(8), []
    for base in range(12):
        words = [f"w{draw.randrange(4000)}" for _ in range(150)]
        rows += [(len(rows) + k, edited(draw, words) if k else " ".join(words)) for k in range(1 + base)]
    out = simhash.near_duplicates(frame(rows, "doc_id long, text string"))
    wanted, groups = brute(rows)
    got = [(r["doc_id"], r["fingerprint"], r["component_id"], r["stays"]) for r in out.collect()]
    assert sorted((g[:3] for g in got), key=repr) == wanted
    assert sum(g[3] for g in got) == groups < len(rows)


def test_awkward_texts(awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    wanted, groups = brute(rows)
    got = simhash.near_duplicates(awkward).collect()
    assert sorted(((r["doc_id"], r["fingerprint"], r["component_id"]) for r in got), key=repr) == wanted
    kept = simhash.drop_near_duplicates(awkward)
    assert kept.columns == awkward.columns and kept.count() == groups
    assert not Counter(map(tuple, kept.collect())) - Counter(map(tuple, awkward.collect()))


def test_empty_table(empty):
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.drop_near_duplicates(empty).count() == 0
