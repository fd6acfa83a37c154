"""What stays on the disk while models are trained and evaluated."""

import gc
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee import session
from marquee.operators import recommend, scoring
from tests.conftest import tuples


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {files.apply(k).getName() for k in range(files.size()) if files.apply(k).getName().startswith("shuffle_")}


def gone(spark, names, seconds=30):
    end = time.time() + seconds
    while names & shuffle_files(spark) and time.time() < end:
        time.sleep(0.1)
    return not names & shuffle_files(spark)


def grouped(spark):
    return spark.range(1_000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))


def test_a_tidy_table_leaves_no_shuffle_files(spark):
    before, setting = shuffle_files(spark), spark.conf.get(session.TIDY)
    made = session.durable(grouped(spark), "tidy", tidy=True)
    assert gone(spark, shuffle_files(spark) - before)
    assert spark.conf.get(session.TIDY) == setting
    assert tuples(made) == tuples(grouped(spark))


def test_what_past_jobs_shuffled_goes_while_collecting(spark, monkeypatch):
    monkeypatch.setattr(session, "LOOK_SECONDS", 0.1)
    before = shuffle_files(spark)
    rdd = spark.sparkContext.parallelize(range(1_000), 4).map(lambda x: (x % 7, 1)).reduceByKey(lambda a, b: a + b)
    assert rdd.count() == 7
    past = shuffle_files(spark) - before
    assert past
    with session.collecting(spark):
        assert past <= shuffle_files(spark)
        del rdd
        gc.collect()
        spark.range(10).count()
        end = time.time() + 30
        while past & shuffle_files(spark) and time.time() < end:
            spark.range(10).count()
            time.sleep(0.3)
    assert not past & shuffle_files(spark)


def test_a_fit_is_done_while_collecting(spark, monkeypatch):
    entered = []
    monkeypatch.setattr(recommend, "collecting", lambda s: entered.append(s) or session.collecting(s))
    pairs = [(u, (u * 7 + j) % 20, 1.0) for u in range(30) for j in range(5)]
    recommend.train(spark.createDataFrame(pairs, "user_idx long, movie_idx long, weight double"), rank=2, maxIter=1)
    assert entered == [spark]


@pytest.fixture
def vectors(spark):
    """Users 3 and items 5 come twice."""
    rng = np.random.default_rng(2)
    def side(name, n, twice):
        rows = [(k, [float(x) for x in rng.integers(-3, 4, 4)]) for k in range(n)]
        return rows + [(twice, rows[twice][1])], f"{name} long, features array<float>"
    left, right = side("user_idx", 23, 3), side("movie_idx", 31, 5)
    return left[0], right[0], spark.createDataFrame(*left), spark.createDataFrame(*right)


@pytest.mark.parametrize("most", [None, -1])
def test_listed_pairs_are_scored_without_copies_of_vectors(spark, vectors, monkeypatch, most):
    if most is not None:
        monkeypatch.setattr(scoring, "BROADCAST_BYTES", most)
        monkeypatch.setattr(scoring, "ITEM_BLOCK", 7)
    monkeypatch.setattr(scoring, "PAIRS_AT_ONCE", 4)
    left, right, users, items = vectors
    listed = [(u, (u * 5 + j * 3) % 40) for u in range(27) for j in range(1 + u % 4)]
    pairs = spark.createDataFrame(listed, "user_idx long, movie_idx long")
    scores = scoring.pair_scores(pairs, users, items)
    plan = scores._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    want = sorted((u, i, float(np.dot(a, b))) for u, i in listed for v, a in left if v == u for w, b in right if w == i)
    assert tuples(scores, "user_idx", "movie_idx", "score") == want


def test_large_item_sets_are_written_once_and_not_shuffled_to_the_users(spark, vectors, monkeypatch):
    monkeypatch.setattr(scoring, "BROADCAST_BYTES", -1)
    monkeypatch.setattr(scoring, "USER_BLOCK", 5)
    monkeypatch.setattr(scoring, "ITEM_BLOCK", 7)
    _, _, users, items = vectors
    cells = scoring._cells(users, items, "user_idx", "movie_idx", "features", ())
    plan = cells._jdf.queryExecution().executedPlan().toString()
    # Only the users are gathered into blocks.
    assert plan.count("Exchange") == 1
    order = [bool(r["user_keys"]) for r in cells.where(F.spark_partition_id() == 0).collect()]
    assert order == sorted(order, reverse=True) and not all(order)
