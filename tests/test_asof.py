import random
from datetime import datetime, timedelta

import pytest

from marquee.operators.asof import asof_join

DAY = datetime(2024, 1, 1)


def at(seconds):
    return DAY + timedelta(seconds=seconds)


def brute(entities, features, ttl):
    out = []
    for i, k, t in entities:
        seen = [(ft, a is not None, a, b is not None, b) for fk, ft, a, b in features
                if fk == k and ft is not None and t is not None and ft <= t]
        best = max(seen, key=lambda s: (s[0], s[1], s[2] or 0, s[3], s[4] or 0), default=None)
        if best is None or (ttl is not None and t - best[0] > ttl):
            out.append((i, k, t, None, None, None))
        else:
            out.append((i, k, t, best[2], best[4], best[0]))
    return sorted(out, key=lambda r: r[0])


def run(frame, entities, features, ttl, **more):
    e = frame(entities, "id long, k long, t timestamp")
    f = frame(features, "k long, ft timestamp, a long, b long")
    out = asof_join(e, f, ["k"], "t", "ft", ["a", "b"], ttl, keep_time="seen", **more)
    return sorted((tuple(r) for r in out.collect()), key=lambda r: r[0])


@pytest.mark.parametrize("ttl", [None, timedelta(seconds=400)])
def test_equals_brute_force_with_hot_and_cold_keys(frame, ttl):
    """Key 0 holds most rows, with copies, ties and features with null values."""
    pick = random.Random(3)
    keys = [0] * 8 + [1, 2]
    entities = [(i, pick.choice(keys), at(pick.randrange(5000))) for i in range(400)]
    entities += [(1000 + i, 0, at(2500)) for i in range(100)]
    features = [(pick.choice(keys), at(pick.randrange(5000)), pick.choice([None, 1, 2]), pick.choice([None, 3, 4]))
                for _ in range(150)] + [(0, at(2400), 9, 9)] * 50
    got = run(frame, entities, features, ttl)
    assert got == brute(entities, features, ttl)


def test_boundaries(frame):
    features = [(1, at(100), 7, 8)]
    entities = [(1, 1, at(99)), (2, 1, at(100)), (3, 1, at(160)), (4, 1, at(161)), (5, 2, at(100)), (6, 1, at(100)),
                (7, 1, None)]
    got = [(r[0], r[3]) for r in run(frame, entities, features, timedelta(seconds=60))]
    assert got == [(1, None), (2, 7), (3, 7), (4, None), (5, None), (6, 7), (7, None)]


def test_values_of_two_rows_never_mix(frame):
    features = [(1, at(10), 1, 2), (1, at(20), None, 5)]
    assert run(frame, [(1, 1, at(30))], features, None)[0][3:5] == (None, 5)


def test_identical_entity_rows_all_come_back(frame):
    got = run(frame, [(1, 1, at(30))] * 3 + [(2, 1, None)] * 2, [(1, at(10), 1, 2)], None)
    assert [r[3] for r in got] == [1, 1, 1, None, None]


def test_no_group_is_as_large_as_a_key(frame):
    """Neither side is shuffled or joined by the key."""
    e = frame([(1, 1, at(30))], "id long, k long, t timestamp")
    f = frame([(1, at(10), 1, 2)], "k long, ft timestamp, a long, b long")
    plan = asof_join(e, f, ["k"], "t", "ft", ["a"])._jdf.queryExecution().toString()
    assert "hashpartitioning(k" not in plan and "SortMergeJoin" not in plan


def test_several_keys_and_one_crowded_instant(frame):
    e = frame([(i, i % 3, "x" if i % 2 else None, at(30)) for i in range(300)], "id long, k long, c string, t timestamp")
    f = frame([(k, "x", at(k), k) for k in range(2)] + [(1, None, at(1), 99)], "k long, c string, ft timestamp, a long")
    got = asof_join(e, f, ["k", "c"], "t", "ft", ["a"]).collect()
    assert {r["id"]: r["a"] for r in got} == {i: i % 3 if i % 2 and i % 3 < 2 else None for i in range(300)}


def test_rows_without_a_key_match_nothing(frame):
    got = run(frame, [(i, None, at(30)) for i in range(5)] + [(9, 1, at(30))], [(None, at(1), 5, 5), (1, at(1), 6, 6)], None)
    assert [r[3] for r in got] == [None] * 5 + [6]
