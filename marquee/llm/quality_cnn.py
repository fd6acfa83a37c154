"""Quality classifier: a convolutional network over bytes, in numpy.

Bytes are embedded, learned filters slide over them, and each filter's largest answer
in every chunk is kept; chunks overlap by half and cover the whole document.
The mean and the maximum over all chunks are combined into one probability.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

WIDTH, STRIDE, DIM, FILTERS, HIDDEN = 12, 4, 8, 32, 16
# Besides its embedding a byte carries whether it repeats what stood up to LAGS bytes earlier.
CHANNELS, LAGS = DIM + 1, 24
# Over WIDTH - STRIDE and LAGS + 3.
GAP = 32
# A chunk is two blocks; the next one starts a block later.
BLOCK = 128
STEPS = BLOCK // STRIDE
# Bytes of texts that are scored at a time, and of those that are convolved at a time: what the filters
# see of them takes 28 times their room.
SCORED, PIECE = 1 << 19, 1 << 16
# The model is fitted on so many labelled rows of each class at most, and in
# each on whole texts, or on WINDOWS pieces spread over texts longer than those.
ROWS_PER_CLASS = 1_500
WINDOWS, WINDOW_CHARS = 8, 512
EPOCHS, BATCH, RATE, SEED = 8, 32, 0.005, 7
HELD_OUT = 5
KEEP_FROM = 0.3


@dataclass
class Model:
    embedding: np.ndarray  # 256, DIM
    filters: np.ndarray    # WIDTH * CHANNELS, FILTERS
    bias: np.ndarray       # FILTERS
    hidden: np.ndarray     # 2 * FILTERS, HIDDEN
    hidden_bias: np.ndarray
    weights: np.ndarray    # HIDDEN
    offset: float

    def combined(self, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hidden layer over mean and maximum, and the logit."""
        inner = np.maximum(joined @ self.hidden + self.hidden_bias, 0)
        return inner, inner @ self.weights + self.offset


def lay_out(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes in blocks of their own, and the blocks of each text.

    Zeros before each text keep filters and lags from seeing two texts at once.
    """
    gap = b"\0" * GAP
    blocks = np.array([-(-(len(t) + len(gap)) // BLOCK) for t in texts], dtype=np.int64)
    padded = b"".join((gap + t).ljust(int(n) * BLOCK, b"\0") for t, n in zip(texts, blocks))
    return np.frombuffer(padded + gap, np.uint8), blocks


def _windows(model: Model, data: np.ndarray, start: int, end: int) -> np.ndarray:
    """One row per filter position from ``start`` to ``end``, the embedded bytes it sees."""
    before, own = max(0, start - GAP), data[start:end + WIDTH - STRIDE]
    flat = np.empty((len(own), CHANNELS), np.float32)
    flat[:, :DIM] = model.embedding[own]
    flat[:, DIM] = _seen_lately(data[before:start + len(own)])[start - before:]
    flat = flat.ravel()
    return np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(flat, WIDTH * CHANNELS)[::STRIDE * CHANNELS])


def _seen_lately(data: np.ndarray) -> np.ndarray:
    """Whether the four bytes that end here also end a few bytes earlier."""
    four = np.zeros(len(data), np.uint32)
    wide = data.astype(np.uint32)
    four[3:] = wide[3:] | wide[2:-1] << 8 | wide[1:-2] << 16 | wide[:-3] << 24
    seen = np.zeros(len(data), bool)
    for lag in range(1, LAGS + 1):
        seen[lag:] |= four[lag:] == four[:-lag]
    return seen & (data > 0)


def _block_peaks(model: Model, data: np.ndarray) -> np.ndarray:
    size, out = len(data) - GAP, []
    for at in range(0, size, PIECE):
        answers = _windows(model, data, at, min(at + PIECE, size)) @ model.filters
        out.append(answers.reshape(-1, STEPS, FILTERS).max(axis=1))
    return np.concatenate(out)


def _next_block(blocks: np.ndarray) -> np.ndarray:
    """The block after each one in its text; the last of a text is its own."""
    after = np.arange(1, int(blocks.sum()) + 1)
    after[np.cumsum(blocks) - 1] -= 1
    return after


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -50, 50)))


def probabilities(model: Model, texts: list[bytes]) -> np.ndarray:
    if not texts:
        return np.zeros(0)
    data, blocks = lay_out(texts)
    peaks = _block_peaks(model, data)
    chunks = np.maximum(np.maximum(peaks, peaks[_next_block(blocks)]) + model.bias, 0)
    first = np.cumsum(blocks) - blocks
    mean = np.add.reduceat(chunks, first, axis=0) / blocks[:, None]
    most = np.maximum.reduceat(chunks, first, axis=0)
    _, logits = model.combined(np.concatenate([mean, most], axis=1))
    return _sigmoid(logits.astype(np.float64))


def _gradients(model: Model, texts: list[bytes], labels: np.ndarray, weights: np.ndarray) -> list[np.ndarray]:
    data, blocks = lay_out(texts)
    seen = _windows(model, data, 0, len(data) - GAP)
    answers = (seen @ model.filters).reshape(-1, STEPS, FILTERS)
    best = answers.argmax(axis=1)
    peaks = np.take_along_axis(answers, best[:, None, :], axis=1)[:, 0, :]
    after = _next_block(blocks)
    own = peaks >= peaks[after]
    block = np.where(own, np.arange(len(peaks))[:, None], after[:, None])
    chunks = np.maximum(np.where(own, peaks, peaks[after]) + model.bias, 0)
    text = np.repeat(np.arange(len(blocks)), blocks)
    first = np.cumsum(blocks) - blocks
    mean = np.add.reduceat(chunks, first, axis=0) / blocks[:, None]
    most = np.maximum.reduceat(chunks, first, axis=0)
    joined = np.concatenate([mean, most], axis=1)
    inner, logits = model.combined(joined)
    slope = (_sigmoid(logits) - labels) * weights / len(labels)
    d_inner = slope[:, None] * model.weights * (inner > 0)
    back = d_inner @ model.hidden.T
    is_most = chunks == most[text]
    shared = np.add.reduceat(is_most.astype(np.float32), first, axis=0)
    d_chunks = back[text, :FILTERS] / blocks[text, None] + is_most * (back[:, FILTERS:] / shared)[text]
    d_chunks = (d_chunks * (chunks > 0)).astype(np.float32)
    # Only the position that won a chunk has a part in it.
    at = block * STEPS + np.take_along_axis(best, block, axis=0)
    d_answers = np.zeros((len(seen), FILTERS), dtype=np.float32)
    np.add.at(d_answers, (at, np.arange(FILTERS)), d_chunks)
    d_seen = (d_answers @ model.filters.T).reshape(-1, WIDTH, CHANNELS)
    d_embedded = np.zeros((len(data), DIM), dtype=np.float32)
    for k in range(WIDTH):
        d_embedded[k:k + STRIDE * len(seen):STRIDE] += d_seen[:, k, :DIM]
    d_embedding = np.stack([np.bincount(data, d_embedded[:, j], 256) for j in range(DIM)], axis=1)
    return [d_embedding, seen.T @ d_answers, d_chunks.sum(axis=0), joined.T @ d_inner, d_inner.sum(axis=0),
            inner.T @ slope, slope.sum()]


def train(texts: list[bytes], labels: np.ndarray, epochs: int = EPOCHS, seed: int = SEED) -> Model:
    """Fit with both classes weighing alike; with one class only, or none, every score is that class or 0.5."""
    random = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return random.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    model = Model(random.normal(0, 0.5, (256, DIM)).astype(np.float32), draw(WIDTH * CHANNELS, FILTERS),
                  np.zeros(FILTERS, np.float32), draw(2 * FILTERS, HIDDEN), np.zeros(HIDDEN, np.float32),
                  np.zeros(HIDDEN, np.float32), 0.0)
    ones = int(labels.sum())
    if not 0 < ones < len(labels):
        model.offset = 0.0 if not len(labels) else 7.0 if ones else -7.0
        return model
    model.weights = draw(HIDDEN)
    weights = np.where(labels == 1, len(labels) / (2 * ones), len(labels) / (2 * (len(labels) - ones)))
    names = ("embedding", "filters", "bias", "hidden", "hidden_bias", "weights", "offset")
    moments = {n: (0.0, 0.0) for n in names}
    step = 0
    for _ in range(epochs):
        order = random.permutation(len(texts))
        for at in range(0, len(order), BATCH):
            own, step = order[at:at + BATCH], step + 1
            grads = _gradients(model, [texts[i] for i in own], labels[own], weights[own])
            for name, g in zip(names, grads):
                a, b = moments[name]
                a, b = 0.9 * a + 0.1 * g, 0.999 * b + 0.001 * np.square(g)
                moments[name] = (a, b)
                move = RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
                setattr(model, name, np.asarray(getattr(model, name) - move, dtype=np.float32))
    return model


def remainder(doc_id: str | Column) -> Column:
    return F.pmod(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(HELD_OUT))


def fit(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality",
        rows_per_class: int = ROWS_PER_CLASS) -> Model:
    """A model from labelled documents that are not held out, ``rows_per_class`` of each label at most."""
    usable = (labels.where(F.col(label).isin(0, 1) & (remainder(doc_id) != 0))
              .select(F.col(doc_id).alias("id"), F.col(label).cast("int").alias("y")))
    chosen = None
    for y in (0, 1):
        part = usable.where(F.col("y") == y).orderBy(F.xxhash64("id"), "id").limit(rows_per_class)
        chosen = part if chosen is None else chosen.unionByName(part)
    whole = F.coalesce(F.col(text), F.lit(""))
    pieces = F.transform(
        F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda k: F.substring(
            whole, (k * (F.length(whole) - WINDOW_CHARS) / (WINDOWS - 1)).cast("int") + 1, F.lit(WINDOW_CHARS)))
    seen = F.when(F.length(whole) <= WINDOWS * WINDOW_CHARS, whole).otherwise(F.concat_ws("\n", pieces))
    # Twice rows_per_class ids at most are broadcast, and as many texts come back, however often ids repeat.
    rows = (docs.select(F.col(doc_id).alias("id"), seen.alias("seen")).join(F.broadcast(chosen), "id")
            .groupBy("id", "y").agg(F.min("seen").alias("seen")).collect())
    known = sorted({(r["y"], r["seen"]) for r in rows})
    return train([t.encode() for _, t in known], np.array([y for y, _ in known], dtype=np.int64))


def _score(model, text: str, score: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        own = model.value
        for batch in batches:
            values, kept, size = [], [], 0
            for t in batch[text].cast(pa.binary()).to_pylist():
                kept.append(t or b"")
                size += len(kept[-1])
                if size >= SCORED:
                    values.append(probabilities(own, kept))
                    kept, size = [], 0
            values.append(probabilities(own, kept))
            yield batch.append_column(score, pa.array(np.concatenate(values)))
    return run


def add_score(docs: DataFrame, model: Model, text: str = "text", score: str = "score") -> DataFrame:
    """``docs`` with the probability of label 1 in ``score``, which must be a free name.

    Every text is read whole; a null one counts as empty, and empty ones have a
    score like any other. Rows, repeated ones too, and columns stay as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return docs.mapInArrow(_score(shared, text, score), docs.withColumn(score, F.lit(0.0)).schema)
