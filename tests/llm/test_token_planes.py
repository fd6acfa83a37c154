import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from marquee.llm import token_planes
from marquee.llm.queries import tokenizer_path
from tests.llm.conftest import AWKWARD

PATH = tokenizer_path()


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(PATH)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, (1 << 32) - 1), max_size=50), st.booleans(), st.sampled_from([1, 7, 8, 64]))
def test_round_trip_of_any_ids(ids, bits, chunk):
    for ids in (np.array(ids, np.uint32), np.array(ids, np.uint32) & np.uint32(0xFFFF)):
        documents = np.array([(0, 5, len(ids))], token_planes.DOCUMENT)
        shard = token_planes.Shard(token_planes.encode_shard(ids, documents, chunk, bits))
        assert np.array_equal(shard.ids(), ids)
        assert np.array_equal(next(shard.each()), ids)
        for a, b in ((0, 1), (3, 9), (len(ids) // 2, len(ids))):
            assert np.array_equal(shard.ids(min(a, len(ids)), min(b, len(ids))), ids[a:b])


def test_planes_are_transposed():
    ids = np.array([1, 2, 3, 0x8001], np.uint32)
    low, *_, high = token_planes.to_planes(ids, 2, True)
    assert low == bytes([0b1101]) and high == bytes([0b1000])
    assert token_planes.to_planes(ids, 2, False) == [bytes([1, 2, 3, 1]), bytes([0, 0, 0, 0x80])]


def test_a_file_of_another_kind_is_refused():
    with pytest.raises(ValueError):
        token_planes.Shard(b"x" * 100)


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=40) | st.text(alphabet="aB'́é Σ\t\n\x1c\x85\xa0 <|endofx>1", max_size=40))
def test_words_have_the_ids_of_the_whole_text(text):
    encoder = token_planes._encoder(PATH)
    whole = encoder.tokenizer.encode(text, add_special_tokens=False).ids
    assert encoder.encode([text.encode()])[0].tolist() == whole


def brute(rows, tokenizer):
    out, start = [], 0
    for number, text in rows:
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [2], "<u4")
        out.append((number, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


@pytest.mark.parametrize("bits, shard_ids", [(True, 1 << 22), (False, 100)])
def test_files_hold_the_ids_in_order(spark, tokenizer, bits, shard_ids):
    draw = random.Random(2)
    rows = [(k, " ".join(draw.choice(["Hello", "wörld", "naïve", "x1", "42", "it's"]) for _ in range(draw.randrange(90))))
            for k in range(70)]
    rows += [(100 + k, t) for k, t in enumerate(AWKWARD)]
    shuffled = rows[:]
    draw.shuffle(shuffled)
    docs = spark.createDataFrame(shuffled, "doc_id long, text string").repartition(5)
    manifest = token_planes.write_tokens(docs, token_planes.shard_folder(spark), PATH, bits=bits, shard_ids=shard_ids)
    found = token_planes.read_tokens(manifest).orderBy("start").collect()
    assert [tuple(r) for r in found] == brute(rows, tokenizer)
    total = manifest.selectExpr("sum(documents)", "sum(tokens)").first()
    assert tuple(total) == (len(rows), sum(r["n_tokens"] for r in found))


def test_null_ids_and_clashing_names(spark, awkward, empty):
    found = token_planes.read_tokens(token_planes.write_tokens(awkward, token_planes.shard_folder(spark), PATH)).collect()
    found.sort(key=lambda r: r["start"])
    assert len(found) == awkward.count()
    ids = [r["doc_id"] for r in found]
    nulls = ids.count(None)
    assert ids[:nulls] == [None] * nulls and ids[nulls:] == sorted(ids[nulls:])
    assert [r["start"] for r in found[1:]] == list(np.cumsum([r["n_tokens"] for r in found])[:-1])
    out = token_planes.read_tokens(token_planes.write_tokens(empty, token_planes.shard_folder(spark), PATH))
    assert out.count() == 0 and out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, inner):
        self.inner, self.texts = inner, 0

    def encode_batch_fast(self, texts, **options):
        self.texts += len(texts)
        return self.inner.encode_batch_fast(texts, **options)


def test_new_words_are_few_texts_to_the_tokenizer(tokenizer):
    encoder = token_planes.WordEncoder(PATH)
    encoder.tokenizer = counted = Counted(tokenizer)
    text = " ".join(f"wörd{k:x}, {k}th" for k in range(3_000))
    assert encoder.encode([text.encode()])[0].tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert 0 < counted.texts < 100


@pytest.mark.parametrize("mark", ["\x01", "", "two words", "naïve"])
def test_words_with_the_mark_between_words(tokenizer, monkeypatch, mark):
    monkeypatch.setattr(token_planes, "MARK", mark)
    monkeypatch.setattr(token_planes, "GROUP_WORDS", 5)
    encoder, draw = token_planes.WordEncoder(PATH), random.Random(7)
    words = ["\x01", "a\x01b", "\x01\x01", "x\x01", "<|endoftext|>", "\u0301e", "\x85", "ok\xa0", "ΣΑΣ", "naïve", "it's", "42"]
    texts = [" ".join(draw.choice(words) + draw.choice(["", str(k)]) for _ in range(draw.randrange(30))) for k in range(60)]
    for _ in range(2):
        found = encoder.encode([t.encode() for t in texts])
        assert [f.tolist() for f in found] == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


def test_a_failed_text_leaves_no_words_without_ids(tokenizer):
    encoder = token_planes.WordEncoder(PATH)
    encoder.tokenizer = None
    with pytest.raises(AttributeError):
        encoder.encode([b"some words"])
    encoder.tokenizer = tokenizer
    assert encoder.encode([b"words"])[0].tolist() == tokenizer.encode("words", add_special_tokens=False).ids
