"""The registered queries beside their SQL, and the pipeline beside a slow one."""

import os
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from check import TABLES, normal
from marquee.llm import mixing, quality_cnn, queries, simhash
from marquee.llm.common import table
from marquee.session import durable
from tests.llm import test_decontaminate, test_mixing, test_simhash

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="tables not here")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{FOLDER}/{t}.parquet')")
    return connection


def test_all_operators_and_the_pipeline_are_registered():
    numbers = Counter(int(n[2:].split("_")[0]) for n in contract.queries() if n.startswith("op"))
    assert numbers == {k: 1 for k in range(1, 14)} and "pipeline" in contract.queries()
    assert [n for n, _ in corpus_pipeline.STAGES] == list(dict(corpus_pipeline.STAGES))


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, db, name):
    got = queries.QUERIES[name](spark, FOLDER).toPandas()
    want = db.execute(queries.ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and normal(got) == normal(want)


@pytest.fixture(scope="module")
def documents(spark):
    return table(spark, FOLDER, "documents").orderBy("doc_id").collect()


def test_token_planes_equal_brute_force(spark, documents):
    tokenizer, start, wanted = Tokenizer.from_file(queries.tokenizer_path()), 0, []
    for r in documents:
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        wanted.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = queries.op2_token_planes(spark, FOLDER).orderBy("start")
    assert [tuple(r) for r in found.collect()] == wanted


def test_simhash_equals_brute_force(spark, documents):
    wanted, _ = test_simhash.brute([(r["doc_id"], r["text"]) for r in documents])
    assert sorted((tuple(r) for r in queries.op3_simhash(spark, FOLDER).collect()), key=repr) == wanted


def test_quality_is_right_on_held_out_rows(spark):
    labels = {r["doc_id"]: r["quality"] for r in table(spark, FOLDER, "labels").collect()}
    rows = queries.op4_quality_cnn(spark, FOLDER).collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in rows)
    right = [labels[r["doc_id"]] == r["predicted"] for r in rows if r["held_out"] and r["doc_id"] in labels]
    assert sum(right) / len(right) > 0.8


def test_mixing_equals_slot_by_slot(spark, documents):
    sizes = Counter(r["source"] for r in documents)
    wanted = test_mixing.brute(sizes, {s: n ** mixing.TEMPER for s, n in sizes.items()}, mixing.BLOCK_DOCS)
    rows = queries.op5_mixing(spark, FOLDER).collect()
    assert {(r["slot"], r["source"], r["release"], r["deadline"]) for r in rows} == {
        (k, *w) for k, w in enumerate(wanted)}
    assert len(rows) == len(documents)


def test_personal_data_counts(spark, documents):
    found = {r["doc_id"]: r for r in queries.op10_personal_data(spark, FOLDER).collect()}
    assert len(found) == len(documents)
    assert sum(r["n_email"] + r["n_ip"] + r["n_card"] + r["n_phone"] for r in found.values()) > 0


def test_pipeline_equals_a_slow_one(spark, documents):
    """Stage by stage; the classifier's scores are taken from the operator."""
    model = quality_cnn.fit(table(spark, FOLDER, "documents"), table(spark, FOLDER, "labels"))
    scores = quality_cnn.probabilities(model, [(r["text"] or "").encode() for r in documents])
    kept = [r for r, s in zip(documents, scores) if s >= quality_cnn.KEEP_FROM]
    components, _ = test_simhash.brute([(r["doc_id"], r["text"]) for r in kept])
    first = {n for n, _, c in components if n == c}
    kept = [r for r in kept if r["doc_id"] in first]
    items = [(r["item_id"], r["text"]) for r in table(spark, FOLDER, "benchmark").collect()]
    kept = [r for r in kept if not test_decontaminate.brute(r["text"], items)[1]]
    sizes = Counter(r["source"] for r in kept)
    slots = test_mixing.brute(sizes, {s: n ** mixing.TEMPER for s, n in sizes.items()}, mixing.BLOCK_DOCS)
    own = {s: iter([r for r in kept if r["source"] == s]) for s in sizes}
    placed = [r for s, _, _ in slots for r in [x for _, x in zip(range(mixing.BLOCK_DOCS), own[s])]]
    tokenizer, start, wanted = Tokenizer.from_file(queries.tokenizer_path()), 0, []
    for r in placed:
        ids = np.array(tokenizer.encode(r["text"] or "", add_special_tokens=False).ids + [2], "<u4")
        wanted.append((r["doc_id"], start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    found = corpus_pipeline.run(spark, FOLDER).orderBy("start").collect()
    assert [tuple(r) for r in found] == wanted and 0 < len(wanted) < len(documents)


def test_stages_keep_columns_and_take_awkward_tables(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, _row string, _slot string, _file int"
    rows = [(None, None, None, None, None, "a", "b", 1), (1, "", "en", "s", 0, "a", "b", 1),
            (1, "", "en", "s", 0, "a", "b", 1), (2, "word " * 3000, "en", None, 9, "a", "b", 1),
            (3, "other words here", "en", "t", 9, None, None, None)]
    for data in (rows, []):
        docs = durable(spark.createDataFrame(data, schema), "awkward")
        for name, stage in corpus_pipeline.STAGES[:-1]:
            docs = durable(stage(spark, docs, FOLDER), name)
            assert docs.schema.names == [f.strip().split()[0] for f in schema.split(",")]
        out = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER)
        assert out.count() == docs.count() <= len(data)
        assert simhash.near_duplicates(docs).count() == docs.count()
