import random
import re

import numpy as np
from hypothesis import given, settings, strategies as st

from marquee.llm import decontaminate
from marquee.llm.common import LOWER

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall((text or "").encode().translate(LOWER).decode())


def brute(text, items, window=10):
    own, hit, found = words(text), set(), set()
    for number, item in items:
        parts = words(item)
        size = min(window, len(parts))
        for at in range(len(parts) - size + 1 if size else 0):
            phrase = parts[at:at + size]
            for k in range(len(own) - size + 1):
                if own[k:k + size] == phrase:
                    hit.update(range(k, k + size))
                    if number is not None:
                        found.add(number)
    return len(own), len(hit), sorted(found)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=70), st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=6),
                                                          min_size=1, max_size=8))
def test_index_finds_and_locates_all_places(text, phrases):
    index = decontaminate.FMIndex(np.array(text, dtype=np.int32), sample_every=3)
    lengths = np.array([len(p) for p in phrases])
    backward = np.zeros((len(phrases), max(lengths)), np.int32)
    for row, p in enumerate(phrases):
        backward[row, :len(p)] = p[::-1]
    low, high = index.search(backward, lengths)
    for p, a, b in zip(phrases, low, high):
        places = [k for k in range(len(text) - len(p) + 1) if text[k:k + len(p)] == p]
        assert sorted(index.locate(np.arange(a, b))) == places


def test_word_characters():
    text = "It's A-B c3PO Ünïcode 漢字, x_y z"
    assert [w.decode() for w in decontaminate.words_of(text.encode())] == words(text)


def collected(df):
    return [(r["doc_id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), list(r["items"]))
            for r in df.collect()]


def planted(seed):
    draw = random.Random(seed)
    items = [(k, " ".join(f"b{draw.randrange(30)}" for _ in range(draw.choice([1, 3, 9, 10, 11, 40])))) for k in range(15)]
    items += [(None, "null id words here"), (90, None), (91, ""), (92, "!!"), (3, "b1 b2 b3")]
    rows = []
    for k in range(60):
        parts = [draw.choice(items)[1] or "?" if draw.random() < 0.3 else f"b{draw.randrange(30)} z{draw.randrange(9)}"
                 for _ in range(draw.randrange(0, 30))]
        rows.append((k % 50, " -- ".join(parts).upper() if k % 2 else " ".join(parts)))
    return rows + [(None, None), (None, "")], items


def test_equals_brute_force_in_one_pass_or_many(frame):
    rows, items = planted(5)
    docs, benchmark = frame(rows, "doc_id long, text string"), frame(items, "item_id long, text string")
    wanted = sorted(((n, *brute(t, items)) for n, t in rows), key=repr)
    for shard, part in ((1 << 20, 1 << 24), (50, 200)):
        found = decontaminate.find_windows(docs, benchmark, shard_words=shard, pass_bytes=part)
        assert sorted(collected(found), key=repr) == wanted


def test_many_occurrences_are_located_in_parts(frame, monkeypatch):
    monkeypatch.setattr(decontaminate, "LOCATE_AT_ONCE", 7)
    docs = frame([(1, "the cat " * 40), (2, "the the dog")], "doc_id long, text string")
    found = decontaminate.find_windows(docs, frame([(5, "the"), (6, "the cat the")], "item_id long, text string"))
    assert sorted(collected(found)) == [(1, 80, 79, [5, 6]), (2, 3, 2, [5])]


def test_spans_are_cut_from_texts(frame):
    docs = frame([(1, "Keep. The QUICK, brown fox! stays"), (2, "none")], "doc_id long, text string")
    found = decontaminate.find_windows(docs, frame([(5, "the quick brown fox")], "item_id long, text string"))
    assert {r["doc_id"]: r["text"] for r in decontaminate.cut_spans(found).collect()} == {1: "Keep. ! stays", 2: "none"}


def test_awkward_texts_and_clashing_names(awkward, empty, frame):
    benchmark = frame([(1, "c d e"), (2, "ONE")], "item_id long, text string")
    kept = decontaminate.drop_contaminated(awkward, benchmark)
    assert kept.columns == awkward.columns
    texts = [r["text"] for r in awkward.collect()]
    assert sorted(repr(r["text"]) for r in kept.collect()) == sorted(
        repr(t) for t in texts if not brute(t, [(1, "c d e"), (2, "ONE")])[1])
    assert decontaminate.drop_contaminated(empty, benchmark).count() == 0
    nothing = decontaminate.drop_contaminated(awkward, benchmark.limit(0))
    assert nothing.count() == len(texts)
