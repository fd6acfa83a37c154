import random
import time
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from marquee.llm import byte_bpe, queries
from tests.llm.conftest import AWKWARD

PATH, PATTERN = queries.tokenizer_path(queries.BYTE_RANKS), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def codec():
    return byte_bpe.Codec(PATH, PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=codec.ranks, special_tokens={})


def check(codec, library, texts):
    made = codec.encode(texts)
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == [library.encode_ordinary(t or "") for t in texts]
    assert codec.decode(made) == [(t or "").encode() for t in texts]


def test_awkward_texts(codec, library):
    check(codec, library, [*AWKWARD, "<|endoftext|>", "it's  we'LL  x\r\n\n", "\x00\x1c\u0085 1234567 ١٢٣",
                           " " * 3_000, "=" * 9_000, "x" * 5_000, "ab" * 2_000, "漢字" * 400])


def test_random_texts(codec, library):
    rng = random.Random(3)
    for letters in ("abehtin gsor", "ACGT", "aab ", "é漢x😀 \n'", "0123456789.,-"):
        check(codec, library, ["".join(rng.choices(letters, k=rng.randrange(90))) for _ in range(300)])


def test_a_long_word_of_few_letters(codec, library):
    check(codec, library, ["".join(random.Random(4).choices("ACGT", k=20_000))])


def test_small_queries_and_a_full_memo(codec, library, monkeypatch):
    monkeypatch.setattr(byte_bpe, "QUERY_BYTES", 8)
    monkeypatch.setattr(byte_bpe, "MEMO_WORDS", 3)
    codec.memo.clear()
    for _ in range(2):
        check(codec, library, ["zqxj vwkq pfff", "zqxj uuqx", None])


def test_merges_that_lower_the_rank(tmp_path):
    """Ranks under which a contraction makes a pair of lower rank than its own."""
    import base64
    tokens = [bytes([b]) for b in range(256)] + [b"abc", b"bc", b"aa", b"aab", b"ab", b"caa"]
    path = tmp_path / "ranks"
    path.write_bytes(b"\n".join(base64.b64encode(t) + b" " + str(k).encode() for k, t in enumerate(tokens)))
    own = byte_bpe.Codec(str(path), r"\S+|\s+")
    library = tiktoken.Encoding("few", pat_str=r"\S+|\s+", mergeable_ranks=own.ranks, special_tokens={})
    rng = random.Random(5)
    check(own, library, ["".join(rng.choices("abc", k=rng.randrange(40))) for _ in range(500)])


def test_documents(awkward, empty, library):
    rows = byte_bpe.round_trip(awkward, PATH, PATTERN).collect()
    want = sorted((r["doc_id"], np.array(library.encode_ordinary(r["text"] or ""), "<u4").tobytes(),
                   (r["text"] or "").encode()) for r in awkward.fillna(-1, "doc_id").collect())
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], bytes(r["ids"]), bytes(r["decoded"])) for r in rows) == want
    two = byte_bpe.decode(byte_bpe.encode(awkward, PATH, PATTERN), PATH, PATTERN)
    assert two.where(F.sha2("decoded", 256) == F.lit("")).count() == 0 and two.count() == awkward.count()
    assert byte_bpe.round_trip(empty, PATH, PATTERN).count() == 0


def test_query_equals_the_library(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").collect()
    want = []
    for r in docs:
        ids = np.array(library.encode_ordinary(r["text"] or ""), "<u4")
        want.append((r["doc_id"], len(ids), sha256(ids.tobytes()).hexdigest(),
                     sha256((r["text"] or "").encode()).hexdigest()))
    assert sorted(tuple(r) for r in queries.op12_byte_bpe(spark, folder).collect()) == sorted(want)


def test_a_step_costs_only_the_words_that_still_change(codec, monkeypatch):
    """One word of many contractions beside many of few, all in one query."""
    monkeypatch.setattr(byte_bpe, "QUERY_BYTES", 1 << 20)
    rng = random.Random(6)
    few = " ".join("".join(rng.choices("qxzjvkwpfbghmydu", k=4)) for _ in range(40_000))
    many = " " + "ationing" * 7

    def seconds(text):
        spent = []
        for _ in range(3):
            codec.memo.clear()
            start = time.process_time()
            codec.encode([text])
            spent.append(time.process_time() - start)
        return min(spent)

    assert seconds(few + many) < 1.3 * seconds(few) + 0.02


def test_decoding_has_a_row_for_each_document(codec):
    made = codec.encode(["some words and more of them", None, "", "one"])
    unknown = np.array([max(codec.ranks.values()) + 1, (1 << 32) - 1], "<u4").tobytes()
    rows = [made[0] + unknown, None, b"", unknown, made[3]]
    assert codec.decode(rows) == [b"some words and more of them", b"", b"", b"", b"one"]
    assert codec.db.sql("FROM ids").to_arrow_table().num_rows == len(rows)


def test_a_failed_text_leaves_no_words_without_ids(codec, library):
    with pytest.raises(TypeError):
        codec.encode(["zqqv wvvq", 5])
    check(codec, library, ["zqqv wvvq", "kzzv zqqv"])


def test_long_rows_are_decoded_in_parts(codec, monkeypatch):
    texts = ["some words and more of them", None, "one", "", "漢字 " * 20]
    made = codec.encode(texts)
    for size in (1, 7, 1 << 20):
        monkeypatch.setattr(byte_bpe, "QUERY_IDS", size)
        assert codec.decode(made) == [(t or "").encode() for t in texts]
    long = codec.encode(["few words " * 2_500_000])
    monkeypatch.undo()
    assert codec.decode(long) == [b"few words " * 2_500_000]
