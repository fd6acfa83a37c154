import random
from collections import Counter, defaultdict
from fractions import Fraction
from math import ceil, floor

import pytest

from marquee.llm import mixing


def brute(sizes, weights, block):
    """Slot by slot: the source of each, with release and deadline."""
    whole = mixing.whole_weights(weights)
    order = sorted((s for s in sizes if sizes[s]), key=lambda s: (s is not None, s))
    left = {s: -(-sizes[s] // block) for s in order}
    out, start, taken = [], 0, dict.fromkeys(order, 0)
    while any(left.values()):
        live = [s for s in order if left[s] and s in whole] or [s for s in order if left[s]]
        total = sum(whole.get(s, 1) for s in live)
        now = len(out) - start
        ready = []
        for n, s in enumerate(live):
            share = Fraction(total, whole.get(s, 1))
            if floor(taken[s] * share) <= now:
                ready.append((ceil((taken[s] + 1) * share), n, s, floor(taken[s] * share)))
        due, _, s, released = min(ready)
        out.append((s, start + released, start + due))
        taken[s] += 1
        left[s] -= 1
        if not left[s]:
            start, taken = len(out), dict.fromkeys(order, 0)
    return out


@pytest.mark.parametrize("weights", [[1], [3, 1], [500, 300, 199, 1], [7, 7, 7], [333] * 3 + [1], [1] * 9 + [50]])
def test_one_period_keeps_every_window(spark, weights):
    total = sum(weights)
    # Twice the blocks of a period, so that no source runs out in it.
    made = mixing.slots(spark, [(w, 2 * w) for w in weights]).where(f"slot < {total}").orderBy("slot").collect()
    order = [r["number"] for r in made]
    assert [r["slot"] for r in made] == list(range(total)) and Counter(order) == dict(enumerate(weights))
    taken = [0] * len(weights)
    for slot, s in enumerate(order):
        assert floor(Fraction(taken[s] * total, weights[s])) <= slot < ceil(Fraction((taken[s] + 1) * total, weights[s]))
        taken[s] += 1
        assert all(abs(n - Fraction((slot + 1) * w, total)) < 1 for n, w in zip(taken, weights))


def test_weights_are_exact():
    assert mixing.whole_weights({"a": 0.99999, "b": 0.00001}) == {"a": 99999, "b": 1}
    assert mixing.whole_weights({"a": 6, "b": 1.5, None: 0, "c": -1.0}) == {"a": 4, "b": 1}
    assert mixing.whole_weights({n: n for n in range(1, 3001)}) == {n: n for n in range(1, 3001)}
    root = mixing.whole_weights({"a": 2 ** 0.5, "b": 1})
    assert Fraction(root["a"], root["b"]) == Fraction("1.4142135623730951")
    assert mixing.whole_weights({}) == {}
    with pytest.raises(ValueError):
        mixing.whole_weights({"a": 1e-20, "b": 1e20})


@pytest.mark.parametrize("weights, blocks", [
    # A thousand sources, a weight far below a thousandth, weights without a short period.
    (list(range(1, 1001)), [2] * 1000), ([99999, 1], [700, 1]), ([14142135623730951, 10 ** 16, 3 * 10 ** 22], [5, 6, 600])])
def test_less_than_one_block_from_the_given_weights(spark, monkeypatch, weights, blocks):
    monkeypatch.setattr(mixing, "STEP", 1024)
    made = mixing.slots(spark, list(zip(weights, blocks))).orderBy("slot").collect()
    assert [r["slot"] for r in made] == list(range(sum(blocks)))
    assert Counter(r["number"] for r in made) == dict(enumerate(blocks))
    total, taken = sum(weights), [0] * len(weights)
    for r in made:
        assert r["block"] == taken[r["number"]] and r["release"] <= r["slot"] < r["deadline"]
        taken[r["number"]] += 1
        # Exactly, and until one runs out: |taken - slots * weight / total| < 1.
        assert all(abs(n * total - (r["slot"] + 1) * w) < total for n, w in zip(taken, weights))
        if taken[r["number"]] == blocks[r["number"]]:
            break


def documents(frame, sizes):
    rows = [(k, s) for s, n in sizes.items() for k in range(n)]
    random.Random(1).shuffle(rows)
    return frame([(k, s, n) for n, (k, s) in enumerate(rows)], "doc_id long, source string, slot long")


@pytest.mark.parametrize("sizes, weights, block", [
    ({"a": 100, "b": 37, "c": 5, None: 11}, {"a": 0.5, "b": 0.3, "c": 0.15, None: 0.05}, 4),
    ({"hot": 300, "x": 20, "y": 20}, {"hot": 1, "x": 1, "y": 1}, 3),
    ({"a": 30, "b": 30, "none": 9, "zero": 4}, {"a": 2.5, "b": 1.0, "zero": 0.0, "absent": 3.0}, 2),
    ({"a": 90, "b": 3, "c": 3}, {"a": 0.99999, "b": 0.00001, "c": 2 ** -0.5}, 2),
    ({"a": 10}, {}, 3)])
def test_schedule_equals_slot_by_slot(frame, sizes, weights, block):
    docs = documents(frame, sizes)
    names = ("block", "offset", "_slot", "release", "deadline")
    out = mixing.schedule(docs, weights, block_docs=block, names=names).collect()
    assert len(out) == sum(sizes.values())
    slots = defaultdict(list)
    for r in out:
        slots[r["_slot"]].append(r)
        assert (r["block"], r["offset"]) == divmod(r["doc_id"], block)
    wanted = brute(sizes, weights, block)
    assert sorted(slots) == list(range(len(wanted)))
    for slot, (source, released, due) in enumerate(wanted):
        assert {r["source"] for r in slots[slot]} == {source} and len({r["block"] for r in slots[slot]}) == 1
        assert {(r["release"], r["deadline"]) for r in slots[slot]} == {(released, due)}
        assert released <= slot < due


def test_nothing_but_dataframes(frame):
    docs = documents(frame, {"a": 10, "b": 5})
    plan = mixing.schedule(docs.drop("slot"), {"a": 1, "b": 1})._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_written_order_is_the_schedule(spark, frame, tmp_path):
    docs = documents(frame, {"a": 50, "b": 20})
    weights = mixing.tempered_weights(docs)
    assert weights == {"a": 50 ** 0.5, "b": 20 ** 0.5}
    mixing.in_order(docs, weights, block_docs=2).write.parquet(f"{tmp_path}/out")
    read = spark.read.parquet(f"{tmp_path}/out")
    assert read.columns == docs.columns
    rows = read.selectExpr("*", "_metadata.file_path AS f", "_metadata.row_index AS i").orderBy("f", "i").collect()
    slots = {(r["source"], r["doc_id"]): (r["_s"], r["offset"]) for r in mixing.schedule(
        docs, weights, block_docs=2, names=("block", "offset", "_s", "release", "deadline")).collect()}
    keys = [slots[r["source"], r["doc_id"]] for r in rows]
    assert keys == sorted(keys) and len(keys) == 70


def test_nulls_repeats_and_no_rows(frame):
    docs = frame([(None, None), (None, None), (1, None), (1, "a"), (1, "a")], "doc_id long, source string")
    out = mixing.schedule(docs, mixing.tempered_weights(docs), block_docs=2).collect()
    assert Counter((r["doc_id"], r["source"]) for r in out) == {(None, None): 2, (1, None): 1, (1, "a"): 2}
    empty = docs.limit(0)
    assert mixing.schedule(empty, mixing.tempered_weights(empty)).count() == 0
    assert mixing.in_order(empty, {}).columns == ["doc_id", "source"]
