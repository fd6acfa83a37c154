"""Personal data: fixed patterns, and a character-level tagger that adds to them.

The tagger is a bidirectional LSTM with CRF transitions, trained in numpy from
labelled spans. It reads overlapping windows; each character takes its tag from
the window in whose middle it lies, and runs of tags over the whole text become
spans where the tags are probable enough. A span must hold a digit, or an at sign
or its like (`` at ``, ``(at)``, ``[at]``) between a name and a host, so windows that
hold none of these nor a part of such a name and host are not read. Beside the
patterns' own spans the tagger learns the same ones written as no pattern knows
them; an added span has the shape that the tags give it, and need only hold the
numbers of its kind.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from marquee.session import durable

KINDS = ("email", "ip", "card", "phone")
# The patterns of the contract, digit runs without backtracking.
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]*")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TRIGGER = re.compile(r"[0-9@]")

WINDOW, STEP = 96, 48
EDGE = (WINDOW - STEP) // 2
CHARS, DIM, HIDDEN = 129, 12, 16
TAGS = 1 + 2 * len(KINDS)  # outside, then begin and inside of each kind
# The tagger is fitted on so many windows at most.
TRAIN_WINDOWS = 1_500
EPOCHS, BATCH, RATE, SEED = 12, 32, 0.01, 11
# Windows that are read at a time.
READ_AT_ONCE = 2_048
# An added span is one whose characters are of its kind with this probability, less sure ones at its ends cut off.
CONFIDENT = 0.8

Span = tuple[int, int, int]  # kind, start, end


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2]) % 10 == sum(-sum(divmod(2 * d, 10)) for d in values[1::2]) % 10


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches, sought from each at sign, so that long words cost nothing."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and _LOCAL.fullmatch(text[start - 1]):
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            done = found.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[Span]:
    """Spans of the patterns, by kind and place; matches that fail their check are dropped."""
    if not _TRIGGER.search(text):
        return []
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 8 <= sum(c in "0123456789" for c in m[0]) <= 15:
            out.append((3, *m.span()))
    return out


# The network.

@dataclass
class Tagger:
    chars: np.ndarray
    into: list[np.ndarray]     # per direction: DIM, 4 * HIDDEN
    along: list[np.ndarray]    # per direction: HIDDEN, 4 * HIDDEN
    gates: list[np.ndarray]    # per direction: 4 * HIDDEN
    out: np.ndarray            # 2 * HIDDEN, TAGS
    out_bias: np.ndarray
    moves: np.ndarray          # TAGS, TAGS
    starts: np.ndarray
    trained: bool = field(default=False)

    def arrays(self) -> list[np.ndarray]:
        return [self.chars, *self.into, *self.along, *self.gates, self.out, self.out_bias, self.moves, self.starts]


def new_tagger(seed: int = SEED) -> Tagger:
    random = np.random.default_rng(seed)

    def draw(*shape: int) -> np.ndarray:
        return random.normal(0, 1 / np.sqrt(shape[0]), shape).astype(np.float32)

    gates = np.zeros(4 * HIDDEN, np.float32)
    gates[HIDDEN:2 * HIDDEN] = 1  # remember at first
    return Tagger(draw(CHARS, DIM) * np.float32(3), [draw(DIM, 4 * HIDDEN) for _ in "lr"],
                  [draw(HIDDEN, 4 * HIDDEN) for _ in "lr"], [gates.copy() for _ in "lr"],
                  draw(2 * HIDDEN, TAGS), np.zeros(TAGS, np.float32),
                  np.zeros((TAGS, TAGS), np.float32), np.zeros(TAGS, np.float32))


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * z) + 0.5


def _lstm(inputs: np.ndarray, along: np.ndarray, keep: bool) -> tuple[np.ndarray, list]:
    """Hidden states, time first; with ``keep`` also what the way back needs."""
    steps, count, _ = inputs.shape
    h = c = np.zeros((count, HIDDEN), np.float32)
    out, kept = np.empty((steps, count, HIDDEN), np.float32), []
    for t in range(steps):
        z = inputs[t] + h @ along
        gate = _sigmoid(z[:, :3 * HIDDEN])
        i, f, o, g = gate[:, :HIDDEN], gate[:, HIDDEN:2 * HIDDEN], gate[:, 2 * HIDDEN:], np.tanh(z[:, 3 * HIDDEN:])
        before = c
        c = f * c + i * g
        level = np.tanh(c)
        if keep:
            kept.append((h, before, i, f, o, g, level))
        h = o * level
        out[t] = h
    return out, kept


def _lstm_back(d_out: np.ndarray, kept: list, along: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d_inputs = np.empty((*d_out.shape[:2], 4 * HIDDEN), np.float32)
    d_along, dh, dc = np.zeros_like(along), 0, 0
    for t in range(len(kept) - 1, -1, -1):
        h, before, i, f, o, g, level = kept[t]
        dh = d_out[t] + dh
        dc = dc + dh * o * (1 - level * level)
        dz = np.concatenate([dc * g * i * (1 - i), dc * before * f * (1 - f),
                             dh * level * o * (1 - o), dc * i * (1 - g * g)], axis=1)
        d_inputs[t] = dz
        d_along += h.T @ dz
        dh, dc = dz @ along.T, dc * f
    return d_inputs, d_along


def _emissions(tagger: Tagger, chars: np.ndarray, keep: bool = False) -> tuple[np.ndarray, tuple]:
    """Scores of each tag, time first, for windows of character numbers (count, time)."""
    seen = tagger.chars[chars.T]
    left, kept_left = _lstm(seen @ tagger.into[0] + tagger.gates[0], tagger.along[0], keep)
    right, kept_right = _lstm((seen @ tagger.into[1] + tagger.gates[1])[::-1], tagger.along[1], keep)
    both = np.concatenate([left, right[::-1]], axis=2)
    return both @ tagger.out + tagger.out_bias, (seen, both, kept_left, kept_right)


def _log_sum(values: np.ndarray, axis: int) -> np.ndarray:
    top = values.max(axis=axis, keepdims=True)
    return np.log(np.exp(values - top).sum(axis=axis)) + top.squeeze(axis)


def _passes(tagger: Tagger, emitted: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Log-sums over all tags before and after each place, and over whole windows."""
    steps = len(emitted)
    ahead, behind = np.empty_like(emitted), np.zeros_like(emitted)
    ahead[0] = emitted[0] + tagger.starts
    for t in range(1, steps):
        ahead[t] = emitted[t] + _log_sum(ahead[t - 1][:, :, None] + tagger.moves, 1)
    for t in range(steps - 2, -1, -1):
        behind[t] = _log_sum(tagger.moves + (emitted[t + 1] + behind[t + 1])[:, None, :], 2)
    return ahead, behind, _log_sum(ahead[-1], 1)


def _gradients(tagger: Tagger, chars: np.ndarray, tags: np.ndarray) -> list[np.ndarray]:
    """Of the CRF's negative log-likelihood, in the order of ``Tagger.arrays``."""
    emitted, (seen, both, kept_left, kept_right) = _emissions(tagger, chars, True)
    steps, count, _ = emitted.shape
    ahead, behind, total = _passes(tagger, emitted)
    true = np.eye(TAGS, dtype=np.float32)[tags.T]
    likely = np.exp(ahead + behind - total[None, :, None])
    d_emitted = (likely - true) / count
    d_moves = np.zeros_like(tagger.moves)
    for t in range(1, steps):
        pair = np.exp(ahead[t - 1][:, :, None] + tagger.moves + (emitted[t] + behind[t])[:, None, :]
                      - total[:, None, None])
        d_moves += pair.sum(axis=0) - true[t - 1].T @ true[t]
    d_both = d_emitted @ tagger.out.T
    d_out = both.reshape(-1, 2 * HIDDEN).T @ d_emitted.reshape(-1, TAGS)
    d_left, along_left = _lstm_back(d_both[:, :, :HIDDEN], kept_left, tagger.along[0])
    d_right, along_right = _lstm_back(d_both[::-1, :, HIDDEN:], kept_right, tagger.along[1])
    d_right = d_right[::-1]
    flat = seen.reshape(-1, DIM)
    d_into = [flat.T @ d.reshape(-1, 4 * HIDDEN) for d in (d_left, d_right)]
    d_seen = d_left @ tagger.into[0].T + d_right @ tagger.into[1].T
    d_chars = np.zeros_like(tagger.chars)
    np.add.at(d_chars, chars.T, d_seen)
    return [d_chars, *d_into, along_left, along_right, *(d.sum(axis=(0, 1)) for d in (d_left, d_right)),
            d_out, d_emitted.sum(axis=(0, 1)), d_moves / count, d_emitted[0].sum(axis=0)]


def decode(tagger: Tagger, chars: np.ndarray) -> np.ndarray:
    """The best tags of each window."""
    return _best(tagger, _emissions(tagger, chars)[0])


def decode_sure(tagger: Tagger, chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The best tags, and for each character that has one how probable its kind is."""
    emitted, _ = _emissions(tagger, chars)
    tags = _best(tagger, emitted)
    sure = np.zeros(tags.shape, np.float32)
    rows = np.flatnonzero(tags.any(axis=1))
    if len(rows):
        ahead, behind, total = _passes(tagger, emitted[:, rows])
        likely = np.exp(ahead + behind - total[None, :, None])
        kinds = likely[:, :, 1::2] + likely[:, :, 2::2]
        own = np.maximum(tags[rows].T.astype(int) - 1, 0) // 2
        sure[rows] = np.take_along_axis(kinds, own[:, :, None], 2)[:, :, 0].T
    return tags, sure


def _best(tagger: Tagger, emitted: np.ndarray) -> np.ndarray:
    steps, count, _ = emitted.shape
    score, came = emitted[0] + tagger.starts, np.empty((steps, count, TAGS), np.int8)
    for t in range(1, steps):
        ways = score[:, :, None] + tagger.moves
        came[t] = ways.argmax(axis=1)
        score = ways.max(axis=1) + emitted[t]
    tags = np.empty((count, steps), np.int8)
    tags[:, -1] = score.argmax(axis=1)
    for t in range(steps - 1, 0, -1):
        tags[:, t - 1] = came[t][np.arange(count), tags[:, t]]
    return tags


def char_numbers(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    return np.minimum(codes, CHARS - 1).astype(np.uint8)


def tags_of(size: int, spans: list[Span]) -> np.ndarray:
    tags = np.zeros(size, np.int8)
    for kind, a, b in spans:
        tags[a:b] = 2 + 2 * kind
        tags[a] = 1 + 2 * kind
    return tags


# Ways of writing that the patterns do not know: at and dot, between the parts of an address, of a card, of a phone.
_ADDRESS = ((" at ", " dot "), ("(at)", "(dot)"), (" [at] ", " [dot] "), (" @ ", "."), (" (at) ", "."), ("[at]", "."))
_PARTS = (" . ", "[.]", "(.)", " dot ")
_GROUPS = (".", "/", " - ", "  ", "_")
_PIECES = ("/", ".", " / ", " - ")


def _variant(text: str, spans: list[Span], random: np.random.Generator) -> tuple[str, list[Span]]:
    """The same text with one of its spans written as the patterns do not know it."""
    n = int(random.integers(len(spans)))
    kind, a, b = spans[n]
    own = text[a:b]

    def some(ways):
        return ways[int(random.integers(len(ways)))]
    if kind == 0:
        name, _, host = own.rpartition("@")
        at, dot = some(_ADDRESS)
        new = name + at + host.replace(".", dot)
    elif kind == 1:
        new = own.replace(".", some(_PARTS))
    elif kind == 2:
        digits = re.sub("[^0-9]", "", own)
        new = some(_GROUPS).join(digits[k:k + 4] for k in range(0, len(digits), 4))
    else:
        bare = own.lstrip("+0123456789").strip() if random.random() < 0.5 else f"00{own[1:]}"
        new = bare if random.random() < 0.5 else re.sub("[^0-9]+", some(_PIECES), bare.strip("(")).strip(" ./-")
    new = new or own
    moved = len(new) - len(own)
    rest = [(k, s + moved * (s > a), e + moved * (e > a)) for k, s, e in spans]
    rest[n] = (kind, a, a + len(new))
    return text[:a] + new + text[b:], rest


def train(windows: list[tuple[str, list[Span]]], epochs: int = EPOCHS, seed: int = SEED) -> Tagger:
    """Fit on texts of ``WINDOW`` characters at most with their spans; none gives a tagger that adds nothing."""
    tagger, random = new_tagger(seed), np.random.default_rng(seed)
    if not windows:
        return tagger
    known = [*windows, *(_variant(t, s, random) for t, s in windows if s for _ in range(2))]
    chars = np.zeros((len(known), WINDOW), np.uint8)
    tags = np.zeros((len(known), WINDOW), np.int8)
    for row, (text, spans) in enumerate(known):
        own = char_numbers(text)[:WINDOW]
        chars[row, :len(own)] = own
        tags[row] = tags_of(WINDOW, [(k, a, min(b, WINDOW)) for k, a, b in spans if a < WINDOW])
    arrays, step = tagger.arrays(), 0
    first, second = [np.zeros_like(a) for a in arrays], [np.zeros_like(a) for a in arrays]
    for _ in range(epochs):
        order = random.permutation(len(known))
        for at in range(0, len(order), BATCH):
            own, step = order[at:at + BATCH], step + 1
            for array, g, a, b in zip(arrays, _gradients(tagger, chars[own], tags[own]), first, second):
                g = np.clip(g, -1, 1)
                a += 0.1 * (g - a)
                b += 0.001 * (g * g - b)
                array -= RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    tagger.trained = True
    return tagger


# Whole texts.

# At signs as they are written, wherever one begins, and what may stand on both sides.
_AT = re.compile(r"(?=(@|(?i: at |\(at\)|\[at\])))")
_NAME = re.compile(r"[\w.%+-]")
_DIGITS = re.compile(r"[+(]?[0-9][0-9 ().-]*[0-9]")
_HOST = re.compile(r" ?[\w-]+(?: ?(?:\.|(?i: dot |\(dot\)|\[dot\])) ?[\w-]+)+")


def stretches(text: str) -> list[tuple[int, int]]:
    """Where a span can lie that is wider than the windows around a digit or an at sign, or holds neither."""
    out = [m.span() for m in _DIGITS.finditer(text)]
    for m in _AT.finditer(text):
        host = _HOST.match(text, m.end(1))
        end = m.start() - (text[m.start() - 1:m.start()] == " ")
        start = end
        while host and start and _NAME.match(text, start - 1):
            start -= 1
        if start < end:
            out.append((start, host.end()))
    return out


def window_starts(codes: np.ndarray, spans: list[tuple[int, int]] | None = None) -> np.ndarray:
    """Starts of the windows that hold a digit or an at sign, or part of ``spans`` in their middle.

    Window k starts at k * STEP - EDGE.
    """
    at = np.flatnonzero(((codes >= 48) & (codes <= 57)) | (codes == 64))
    last = (at + EDGE) // STEP
    own = [np.arange(a // STEP, (b - 1) // STEP + 1) for a, b in spans or []]
    found = np.unique(np.concatenate([last, last - 1, *own]))
    return found[found >= 0] * STEP - EDGE


_SIGN = re.compile(r"\w ?(?:@|(?i:\bat\b|\(at\)|\[at\])) ?\w")
_DOT = re.compile(r"\w ?(?:\.|(?i:\bdot\b|\(dot\)|\[dot\])) ?\w")
_LETTERS = re.compile(r"[^\W0-9_]")
_RUNS = re.compile("[0-9]+")


def holds_numbers(kind: int, own: str) -> bool:
    """Whether a span holds what its kind must, however it is written."""
    runs = _RUNS.findall(own)
    digits = "".join(runs)
    if kind == 0:
        sign = _SIGN.search(own)
        return bool(sign and _DOT.search(own, sign.end() - 1))
    if kind == 1:
        return len(runs) == 4 and all(len(r.lstrip("0")) <= 3 and int(r) <= 255 for r in runs)
    if _LETTERS.search(own):
        return False
    return 13 <= len(digits) <= 19 and luhn(digits) if kind == 2 else 8 <= len(digits) <= 15


def _whole(text: str, start: int, end: int) -> tuple[int, int] | None:
    """A tagged run without signs at its ends and with the whole of the words there, if they end nearby."""
    while start < end and not text[start].isalnum() and text[start] not in "+(":
        start += 1
    while end > start and not text[end - 1].isalnum():
        end -= 1
    if start == end:
        return None
    first, last = max(0, start - EDGE), min(len(text), end + EDGE)
    while start > first and text[start].isalnum() and text[start - 1].isalnum():
        start -= 1
    while end < last and text[end].isalnum():
        end += 1
    alone = not text[max(start - 1, 0):start].isalnum() and not text[end:end + 1].isalnum()
    return (start, end) if alone else None


def _reconciled(text: str, base: list[Span], starts: np.ndarray, tags: np.ndarray,
                sure: np.ndarray | None = None) -> list[Span]:
    """Spans that the windows' middles spell and that meet no base span."""
    at = (starts[:, None] + np.arange(EDGE, EDGE + STEP)).ravel()
    own = tags[:, EDGE:EDGE + STEP].ravel()
    inside = (own > 0) & (at >= 0) & (at < len(text))
    likely = np.ones(len(at), np.float32) if sure is None else sure[:, EDGE:EDGE + STEP].ravel()
    at, own, likely = at[inside], own[inside].astype(int), likely[inside]
    if not len(at):
        return []
    kind, begins = (own - 1) // 2, own % 2 == 1
    # Where windows differ on the kind of a run, it is that of the greater sum.
    fresh = np.ones(len(at), bool)
    fresh[1:] = (at[1:] != at[:-1] + 1) | begins[1:]
    first = np.flatnonzero(fresh)
    out = []
    for a, b in zip(first, [*first[1:], len(at)]):
        chosen = int(np.bincount(kind[a:b], likely[a:b], len(KINDS)).argmax())
        agreed = np.where(kind[a:b] == chosen, likely[a:b], 0)
        firm = np.flatnonzero(agreed >= CONFIDENT)
        if not len(firm) or agreed[firm[0]:firm[-1] + 1].mean() < CONFIDENT:
            continue
        found = _whole(text, int(at[a + firm[0]]), int(at[a + firm[-1]]) + 1)
        if found is None or not holds_numbers(chosen, text[found[0]:found[1]]):
            continue
        if not any(s < found[1] and found[0] < e for _, s, e in [*base, *out]):
            out.append((chosen, *found))
    return out


def find_all(tagger: Tagger, texts: list[str]) -> list[tuple[list[Span], list[Span]]]:
    """Base spans and added spans of each text."""
    base = [base_spans(t) for t in texts]
    added: list[list[Span]] = [[] for _ in texts]
    waiting: list[tuple[int, np.ndarray, np.ndarray]] = []
    count = 0

    def read() -> None:
        nonlocal waiting, count
        rows = np.concatenate([w for _, _, w in waiting])
        read = [decode_sure(tagger, rows[k:k + READ_AT_ONCE]) for k in range(0, len(rows), READ_AT_ONCE)]
        tags, sure = (np.concatenate(r) for r in zip(*read))
        k = 0
        for n, starts, _ in waiting:
            own = slice(k, k + len(starts))
            added[n] = _reconciled(texts[n], base[n], starts, tags[own], sure[own])
            k += len(starts)
        waiting, count = [], 0

    for n, text in enumerate(texts):
        if not tagger.trained:
            continue
        spans = stretches(text)
        if not spans and not _TRIGGER.search(text):
            continue
        codes = char_numbers(text)
        starts = window_starts(codes, spans)
        padded = np.concatenate([np.zeros(EDGE, np.uint8), codes, np.zeros(WINDOW, np.uint8)])
        waiting.append((n, starts, padded[(starts + EDGE)[:, None] + np.arange(WINDOW)]))
        count += len(starts)
        if count >= READ_AT_ONCE:
            read()
    if waiting:
        read()
    return list(zip(base, added))


def spelled(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))


def _examples(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Training windows of each text: one around each base span, and some that only hold digits."""
    for batch in batches:
        out = []
        for text in batch["text"].to_pylist():
            spans = base_spans(text or "")
            for n, (_, a, b) in enumerate(spans):
                start = max(0, a - (a * 7 + n) % (WINDOW // 2))
                out.append((text[start:start + WINDOW], True))
            for m in list(_TRIGGER.finditer(text or ""))[::40][:4]:
                start = max(0, m.start() - m.start() % WINDOW)
                out.append((text[start:start + WINDOW], False))
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in out]), pa.array([s for _, s in out])], ["piece", "holds"])


def fit(docs: DataFrame, text: str = "text", rows: int = TRAIN_WINDOWS) -> Tagger:
    """A tagger trained on ``rows`` windows at most, half of them around spans of the patterns."""
    pieces = durable(docs.where(F.col(text).rlike("[0-9@]")).select(F.col(text).alias("text"))
                     .mapInArrow(_examples, "piece string, holds boolean").distinct(), "pieces")
    chosen = None
    for holds in (True, False):
        part = pieces.where(F.col("holds") == holds).orderBy(F.xxhash64("piece"), "piece").limit(rows // 2)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = sorted({r["piece"] for r in chosen.collect()})
    return train([(t, base_spans(t)) for t in texts])


FOUND = ("n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_added long")


def _find(shared) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches):
        for batch in batches:
            found = find_all(shared.value, [t or "" for t in batch["text"].to_pylist()])
            columns = [pa.array([sum(k == kind for k, _, _ in base) for base, _ in found], pa.int64())
                       for kind in range(len(KINDS))]
            columns += [pa.array([sha256(spelled(base).encode()).hexdigest() for base, _ in found], pa.string()),
                        pa.array([spelled(base + added) for base, added in found], pa.string()),
                        pa.array([len(added) for _, added in found], pa.int64())]
            names = [f"n_{k}" for k in KINDS] + ["base_sha256", "spans", "n_added"]
            yield pa.RecordBatch.from_arrays([batch["doc_id"], *columns], ["doc_id", *names])
    return run


def find_personal_data(docs: DataFrame, tagger: Tagger, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: counts of base spans by kind, their digest, all spans, and how many were added.

    Spans are ``kind:start:end`` in code points, end exclusive, by kind and then
    start. A null or empty text has none. Rows, repeated ones too, are answered
    one by one; other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tagger)
    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        _find(shared), f"doc_id {kind}, {FOUND}")
