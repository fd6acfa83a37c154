import random
import zlib

import numpy as np
import pytest

from marquee.llm import quality_cnn
from tests.conftest import tuples


def slow_probability(model, text):
    """Every filter position of every chunk by itself."""
    gap = quality_cnn.GAP
    size = -(-(len(text) + gap) // quality_cnn.BLOCK) * quality_cnn.BLOCK
    data = np.frombuffer((b"\0" * gap + text).ljust(size + gap, b"\0"), np.uint8)
    seen = [data[p] > 0 and any(p >= k and bytes(data[max(0, p - 3):p + 1]) == bytes(data[max(0, p - 3 - k):p + 1 - k])
                                for k in range(1, quality_cnn.LAGS + 1)) for p in range(len(data))]
    inputs = np.concatenate([model.embedding[data], np.array(seen, np.float32)[:, None]], axis=1)
    answers = np.array([inputs[p:p + quality_cnn.WIDTH].ravel() @ model.filters
                        for p in range(0, size, quality_cnn.STRIDE)])
    steps, blocks = quality_cnn.STEPS, size // quality_cnn.BLOCK
    chunks = np.array([np.maximum(answers[k * steps:min(k + 2, blocks) * steps].max(axis=0) + model.bias, 0)
                       for k in range(blocks)])
    inner = np.maximum(np.concatenate([chunks.mean(axis=0), chunks.max(axis=0)]) @ model.hidden + model.hidden_bias, 0)
    return 1 / (1 + np.exp(-(inner @ model.weights + model.offset)))


def random_model(seed):
    draw, f, h = np.random.default_rng(seed), quality_cnn.FILTERS, quality_cnn.HIDDEN
    shapes = [(256, quality_cnn.DIM), (quality_cnn.WIDTH * quality_cnn.CHANNELS, f), (f,), (2 * f, h), (h,), (h,)]
    return quality_cnn.Model(*[draw.normal(0, 0.3, s) for s in shapes], 0.1)


@pytest.mark.parametrize("piece", [quality_cnn.BLOCK, quality_cnn.PIECE])
def test_scores_equal_the_slow_ones_whatever_stands_beside(piece, monkeypatch):
    monkeypatch.setattr(quality_cnn, "PIECE", piece)
    model, draw = random_model(1), random.Random(3)
    texts = [b"", b"a", b"ab ab ab ab ab", bytes(draw.randrange(32, 99) for _ in range(95)),
             bytes(draw.randrange(32, 99) for _ in range(700)), b"word " * 200]
    wanted = [slow_probability(model, t) for t in texts]
    np.testing.assert_allclose(quality_cnn.probabilities(model, texts), wanted, rtol=1e-5)
    np.testing.assert_allclose(quality_cnn.probabilities(model, texts[::-1]), wanted[::-1], rtol=1e-5)


def test_gradients_equal_differences():
    model, draw = random_model(2), np.random.default_rng(5)
    texts = [bytes(draw.integers(32, 90, n, dtype=np.uint8)) for n in (3, 250, 600, 0)]
    labels, weights = np.array([0, 1, 1, 0]), np.array([1.0, 2.0, 1.0, 1.0])

    def loss():
        p = quality_cnn.probabilities(model, texts)
        return -np.mean(weights * (labels * np.log(p) + (1 - labels) * np.log(1 - p)))

    names = ("embedding", "filters", "bias", "hidden", "hidden_bias", "weights")
    for name, gradient in zip(names, quality_cnn._gradients(model, texts, labels, weights)):
        array = getattr(model, name)
        at = np.unravel_index(np.abs(gradient).argmax(), array.shape)
        kept = array[at]
        ends = []
        for step in (1e-6, -1e-6):
            array[at] = kept + step
            ends.append(loss())
        array[at] = kept
        assert gradient[at] == pytest.approx((ends[0] - ends[1]) / 2e-6, rel=2e-2)


def corpus(count):
    draw, rows = random.Random(6), []
    for k in range(count):
        good = k % 4 != 0
        words = ["".join(draw.choice("abcdefg") for _ in range(draw.randint(2, 7))) for _ in range(draw.randint(5, 120))]
        rows.append((k, " ".join(words) if good else "$$ ".join(w.upper() for w in words), int(good)))
    return rows


def test_held_out_accuracy_and_what_is_learned_from(spark, frame):
    rows = corpus(500)
    docs = frame([r[:2] for r in rows], "doc_id long, text string")
    # Labels of held-out rows are wrong, and must not be seen.
    held = {k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0}
    labels = frame([(k, 1 - y if k in held else y) for k, _, y in rows] + [(None, 1), (3, None), (9_999, 0)],
                   "doc_id long, quality int")
    model = quality_cnn.fit(docs, labels, rows_per_class=100)
    found = {r["doc_id"]: r["score"] for r in quality_cnn.add_score(docs, model).collect()}
    right = [(found[k] >= 0.3) == (y == 1) for k, _, y in rows if k in held]
    assert len(right) > 60 and sum(right) / len(right) > 0.97
    shares = docs.select("doc_id", (quality_cnn.remainder("doc_id") == 0).alias("held")).collect()
    assert {r["doc_id"] for r in shares if r["held"]} == held


def test_fit_is_stable(frame):
    rows = corpus(60)
    docs, labels = frame([r[:2] for r in rows], "doc_id long, text string"), frame(
        [(k, y) for k, _, y in rows], "doc_id long, quality int")
    a, b = (quality_cnn.probabilities(quality_cnn.fit(docs, labels), [b"some text"]) for _ in range(2))
    assert a == b


def test_awkward_texts_and_few_labels(awkward, empty, frame):
    for rows, level in (([], 0.5), ([(1, 1), (5, 1)], 0.99), ([(1, 0)], 0.01)):
        model = quality_cnn.fit(awkward, frame(rows, "doc_id long, quality int"))
        out = quality_cnn.add_score(awkward, model, score="own")
        assert out.columns == [*awkward.columns, "own"]
        assert tuples(out.drop("own").na.fill("?").na.fill(-1)) == tuples(awkward.na.fill("?").na.fill(-1))
        scores = [r["own"] for r in out.collect()]
        assert all(s == pytest.approx(level, abs=0.01) for s in scores)
    assert quality_cnn.add_score(empty, model, score="own").count() == 0
