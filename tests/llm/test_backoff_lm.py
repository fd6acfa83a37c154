import math
import random
from collections import Counter

import numpy as np
import pytest

from marquee.llm import backoff_lm


def brute(rows, order):
    texts = [[w.decode() for w in (t or "").encode().lower().split()] for _, t in rows]
    total = sum(map(len, texts))
    tables = [Counter(tuple(t[k:k + size]) for t in texts for k in range(len(t) - size + 1))
              for size in range(1, order + 1)]

    def score(gram):
        seen = tables[len(gram) - 1][gram]
        if len(gram) == 1:
            return seen / total
        return seen / tables[len(gram) - 2][gram[:-1]] if seen else 0.4 * score(gram[1:])

    out = []
    for (number, _), t in zip(rows, texts):
        logs = sum(math.log(score(tuple(t[max(0, k - order + 1):k + 1]))) for k in range(len(t)))
        size = min(order, len(t))
        own = Counter(tuple(t[k:k + size]) for k in range(len(t) - size + 1)) if size else {}
        out.append((number, len(t), sum(n for g, n in own.items() if tables[size - 1][g] > n), logs))
    return out


def compare(df, wanted):
    found = [(r["doc_id"], r["n_words"], r["n_shared"], r["log_score"]) for r in df.collect()]
    assert len(found) == len(wanted)
    key = lambda r: (r[0] is not None, r[0] or 0, *r[1:3], round(r[3], 3))
    for a, b in zip(sorted(found, key=key), sorted(wanted, key=key)):
        assert a[:3] == b[:3] and a[3] == pytest.approx(b[3], rel=1e-9, abs=1e-6)


def texts(seed, count=80):
    draw = random.Random(seed)
    return [(k, " ".join(draw.choice("the of and a cat dog Sat ran zebra".split() + [f"r{draw.randrange(400)}"])
                         for _ in range(draw.randrange(0, 40)))) for k in range(count)]


@pytest.mark.parametrize("order", [2, 3, 4])
def test_equals_brute_force(frame, order):
    rows = texts(order) + [(900, "once"), (901, "once"), (902, "alone here"), (903, "the"), (904, "of the")]
    compare(backoff_lm.score(frame(rows, "doc_id long, text string"), order=order), brute(rows, order))


@pytest.mark.parametrize("hot_rows", [10, 1_000])
def test_hot_ngrams_are_added_where_they_are(frame, monkeypatch, hot_rows):
    monkeypatch.setattr(backoff_lm, "HOT_ROWS", hot_rows)
    rows = texts(9, 300) + [(1000 + k, "the the the of the the") for k in range(300)]
    compare(backoff_lm.score(frame(rows, "doc_id long, text string")), brute(rows, 3))


@pytest.mark.parametrize("fan", [10, 3, 2])
def test_buckets_are_dealt_again(frame, monkeypatch, fan):
    monkeypatch.setattr(backoff_lm, "BUCKET_GRAMS", 50)
    monkeypatch.setattr(backoff_lm, "FAN_BITS", fan)
    rows = texts(5, 120)
    compare(backoff_lm.score(frame(rows, "doc_id long, text string")), brute(rows, 3))


def test_packed_groups_come_back():
    draw = np.random.default_rng(3)
    for sizes in [(0, 0), (5, 0), (0, 4), (300, 20)]:
        groups = tuple(tuple(draw.integers(0, 200, n).astype(kind) for kind in kinds)
                       for n, kinds in zip(sizes, backoff_lm._KINDS))
        for found, wanted in zip(backoff_lm.unpack(backoff_lm.pack(groups)), groups):
            assert all((a == b).all() for a, b in zip(found, wanted))


def test_nothing_is_left_out(frame):
    """Words and n-grams of one document only are counted like any others, whatever the size of the table."""
    few = [(1, "rare words only here"), (2, "the cat sat")]
    many = few + [(k, "the cat sat") for k in range(10, 400)]
    score = {r["doc_id"]: r["log_score"] for r in backoff_lm.score(frame(many, "doc_id long, text string")).collect()}
    total = 4 + 391 * 3
    assert score[1] == pytest.approx(-math.log(total))
    assert score[2] == pytest.approx(math.log(391 / total))


def test_awkward_texts(awkward, empty):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    compare(backoff_lm.score(awkward), brute(rows, 3))
    assert backoff_lm.score(empty).count() == 0


def test_other_orders_are_refused(empty):
    with pytest.raises(ValueError):
        backoff_lm.score(empty, order=1)
