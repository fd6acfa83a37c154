import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import quality_cnn

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_stages_send_texts_in_small_batches(spark):
    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"bytes": pa.array([batch.nbytes], pa.int64())})

    before = spark.conf.get(LIMIT)
    try:
        docs = spark.createDataFrame([(1, "a b c d e"), (2, "a b c d e"), (3, None)], "doc_id long, text string")
        kept = corpus_pipeline.near_dedup(spark, docs, "")
        assert sorted(r["doc_id"] for r in kept.collect()) == [1, 3]
        wide = spark.range(0, 10_000, 1, 1).select(F.repeat(F.lit("x"), 1_500).alias("text"))
        found = [r["bytes"] for r in wide.mapInArrow(sizes, "bytes long").collect()]
        assert sum(found) >= 15_000_000 and max(found) < 5_000_000
    finally:
        spark.conf.set(LIMIT, before)


def test_scores_do_not_depend_on_the_bytes_convolved_at_a_time(monkeypatch):
    texts = [(f"word{i} " * (i % 97) * 40).encode() for i in range(60)]
    model = quality_cnn.train(texts[:20], np.arange(20) % 2, epochs=1)
    small = quality_cnn.probabilities(model, texts)
    # What the filters see of a piece: a float per embedded byte and filter position.
    assert quality_cnn.PIECE // quality_cnn.STRIDE * quality_cnn.WIDTH * quality_cnn.CHANNELS * 4 < 8 << 20
    monkeypatch.setattr(quality_cnn, "PIECE", 1 << 19)
    assert np.allclose(small, quality_cnn.probabilities(model, texts), rtol=0, atol=1e-6)
