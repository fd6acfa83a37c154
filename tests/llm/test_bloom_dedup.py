import hashlib
import re
from collections import defaultdict

import pyarrow as pa
import pytest

from marquee.llm import bloom_dedup
from tests.conftest import tuples

COLUMNS = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def brute(rows):
    groups = defaultdict(list)
    for number, text in rows:
        normal = re.sub("[\x20\x09-\x0D]+", " ", text or "")
        groups[hashlib.sha256(normal.encode()).hexdigest()].append(number)
    return groups


def compare(found, rows):
    groups = brute(rows)
    assert len(found) == len(rows)
    for number, keep, size, _, sha in found:
        assert number in groups[sha] and size == len(groups[sha])
        known = [n for n in groups[sha] if n is not None]
        assert keep == (min(known) if known else None)
    for sha in groups:
        kept = [n for n, _, _, kept, s in found if s == sha and kept]
        assert kept == [min((n for n in groups[sha] if n is not None), default=None)]


def collected(df):
    return [tuple(r[c] for c in COLUMNS) for r in df.collect()]


def test_awkward_texts(awkward):
    rows = [(r["doc_id"], r["text"]) for r in awkward.collect()]
    compare(collected(bloom_dedup.exact_duplicates(awkward)), rows)


def test_empty_table(empty):
    out = bloom_dedup.exact_duplicates(empty)
    assert out.columns == list(COLUMNS) and out.count() == 0


@pytest.mark.parametrize("filter_bytes", [1, 1 << 20])
def test_many_copies_in_one_round_or_several(frame, filter_bytes, monkeypatch):
    monkeypatch.setattr(bloom_dedup, "BLOCK_BITS", 10)
    rows = [(k, f"text {k % 700}" if k % 3 else "hot  copy") for k in range(3_000)]
    out = bloom_dedup.exact_duplicates(frame(rows, "doc_id long, text string"), filter_bytes=filter_bytes)
    compare(collected(out), rows)


def test_hot_groups_are_broadcast(frame, monkeypatch):
    monkeypatch.setattr("marquee.llm.common.HOT_ROWS", 5)
    rows = [(k, "same" if k % 2 else f"own {k // 4}") for k in range(60)]
    compare(collected(bloom_dedup.exact_duplicates(frame(rows, "doc_id long, text string"))), rows)


def test_lonely_rows_mostly_pass_straight_through(frame):
    rows = [(k, f"{k:032d}") for k in range(5_000)] + [(-1, f"{7:032d}")]
    df = frame(rows, "doc_id long, text string")
    hashes = df.selectExpr("unhex(sha2(text, 256)) AS sha", "doc_id", "0L AS row")
    flagged = bloom_dedup.possibly_repeated(hashes, len(rows))
    maybe = {r["doc_id"] for r in flagged.where("maybe").collect()}
    assert {7, -1} <= maybe and len(maybe) < 500


def test_cells_are_within_the_filter():
    sha = pa.array([hashlib.sha256(bytes([k])).digest() for k in range(50)])
    cells = bloom_dedup._cells(sha, 1 << 12)
    assert cells.shape == (50, bloom_dedup.PROBES) and cells.max() < 1 << 12


def test_result_is_stable(awkward):
    assert tuples(bloom_dedup.exact_duplicates(awkward).na.fill(-1)) == tuples(
        bloom_dedup.exact_duplicates(awkward).na.fill(-1))
