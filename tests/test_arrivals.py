import os
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from marquee.operators import validate
from marquee.streaming.arrivals import KeyIndex
from tests.conftest import tuples

KEYS = ["user_idx", "movie_idx", "timestamp"]
SCHEMA = "user_idx long, movie_idx long, timestamp long, day int"


def rows(seed=1, days=5, most=60):
    """Keys repeat within a day and over neighbouring days; some are null."""
    draw = random.Random(seed)
    return [(draw.choice([None, *range(4)]), draw.randrange(4), 1000 * (day - draw.randrange(2)) + draw.randrange(3), day)
            for day in range(days) for _ in range(draw.randrange(most // 2, most))]


def whole(df):
    found = validate.run_suite(df.drop("day"), [validate.unique(*KEYS)]).first()
    return found["unexpected_count"], found["missing_count"]


@pytest.mark.parametrize("by_day", [False, True])
def test_day_by_day_equals_the_whole_table(spark, frame, tmp_path, by_day):
    df = frame(rows(), SCHEMA).persist()
    index = KeyIndex(spark, str(tmp_path), KEYS, F.floor(F.col("timestamp") / 1000) if by_day else None)
    for day in range(5):
        index.write(df.where(F.col("day") == day), day)
        assert index.unexpected() == whole(df.where(F.col("day") <= day))[0]
    assert index.read().agg(F.sum("missing_count")).first()[0] == whole(df)[1]
    seen = Counter()
    for r in sorted(index.read().collect()):
        own = Counter(x[:3] for x in rows() if x[3] == r["arrival"])
        seen.update(own)
        assert r["element_count"] == sum(own.values())
        assert r["repeated_rows"] == sum(n for k, n in own.items() if None not in k and seen[k] > 1)


def test_a_replayed_arrival_changes_nothing(spark, frame, tmp_path):
    df = frame(rows(2, 3), SCHEMA).persist()
    index = KeyIndex(spark, str(tmp_path), KEYS)
    for day in range(3):
        index.write(df.where(F.col("day") == day), day)
    before, kept = tuples(index.read()), tuples(index.counts.read())
    index.write(df.where("day = 2"), 2)
    assert tuples(index.read()) == before and tuples(index.counts.read()) == kept
    assert index.unexpected(1) == whole(df.where("day <= 1"))[0]


def test_only_touched_buckets_are_written(spark, frame, tmp_path):
    """Six days of keys, one bucket each; an arrival writes its own two and leaves the others."""
    df = frame(rows(3, 6), SCHEMA).persist()
    index = KeyIndex(spark, str(tmp_path), KEYS, F.floor(F.col("timestamp") / 1000))
    for day in range(6):
        index.write(df.where(F.col("day") == day), day)
    parts = [p for p in os.listdir(f"{tmp_path}/keys/data/version=5") if p.startswith("_part=")]
    assert set(parts) <= {"_part=4", "_part=5"}
    assert len(index.counts.versions()) == 7


def test_no_rows_and_no_keys(spark, tmp_path):
    index = KeyIndex(spark, str(tmp_path), KEYS)
    index.write(spark.createDataFrame([], SCHEMA), 0)
    index.write(spark.createDataFrame([(None, 1, 1, 1), (None, 1, 1, 1)], SCHEMA), 1)
    index.write(spark.createDataFrame([(1, 1, 1, 2)], SCHEMA), 2)
    assert tuples(index.read(), "arrival", "element_count", "missing_count", "more_repeated") == [
        (0, 0, 0, 0), (1, 2, 2, 0), (2, 1, 0, 0)]
    assert index.unexpected() == 0
