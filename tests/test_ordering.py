import random

import numpy as np
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from marquee.operators.ordering import cumulative, exact_quantiles, file_positions, numbered, positions, top_by
from tests.conftest import tuples

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


@FEW
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60, unique=True))
def test_positions_are_a_bijection_in_order(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v long").repartition(3)
    found = dict(tuples(positions(df, ["v"])))
    assert [found[v] for v in sorted(values)] == list(range(len(values)))


def test_positions_with_equal_rows_stay_a_bijection(frame):
    df = frame([(1,)] * 40 + [(0,)] * 3, "v long")
    rows = tuples(positions(df, ["v"]), "position", "v")
    assert [p for p, _ in rows] == list(range(43))
    assert [v for _, v in rows] == [0] * 3 + [1] * 40


def test_places_in_files_without_a_sort(spark, tmp_path):
    spark.range(1000).select((F.col("id") * 7 % 1000).alias("v")).repartitionByRange(5, "v").sortWithinPartitions(
        "v").write.parquet(str(tmp_path / "ordered"))
    found = file_positions(spark.read.parquet(str(tmp_path / "ordered")), "place")
    assert tuples(found) == [(k, k) for k in range(1000)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "SortMergeJoin" not in plan


def test_cumulative_crosses_partitions(frame):
    values = list(range(1, 200))
    random.Random(1).shuffle(values)
    out = dict(tuples(cumulative(frame([(v, v) for v in values], "k long, v long"), ["k"], "v"), "k", "running"))
    assert out == {k: k * (k + 1) // 2 for k in range(1, 200)}


def test_numbered_with_a_hot_key(frame):
    rows = [("hot", i) for i in range(300)] + [("cold", 5), ("cold", 2), ("one", 9)]
    out = tuples(numbered(frame(rows, "k string, t long"), ["k"], ["t"], "n"))
    assert [n for k, _, n in out if k == "hot"] == list(range(1, 301))
    assert [(k, t, n) for k, t, n in out if k != "hot"] == [("cold", 2, 1), ("cold", 5, 2), ("one", 9, 1)]


@FEW
@given(st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 9)), min_size=1, max_size=50))
def test_exact_quantiles_equal_numpy(spark, rows):
    df = spark.createDataFrame([(k, v / 2) for k, v in rows], "k string, v double")
    out = {r["k"]: (r["a"], r["b"], r["c"]) for r in exact_quantiles(
        df, ["k"], "v", {"a": 0.1, "b": 0.5, "c": 0.99}).collect()}
    for k in {k for k, _ in rows}:
        mine = [v / 2 for key, v in rows if key == k]
        np.testing.assert_allclose(out[k], np.quantile(mine, [0.1, 0.5, 0.99]))


def test_exact_quantiles_without_keys_skip_nulls(frame):
    df = frame([(1.0,), (None,), (3.0,)], "v double")
    assert exact_quantiles(df, [], "v", {"m": 0.5}).first()["m"] == 2.0


def test_top_by_limits_before_the_shuffle(frame):
    df = frame([("a", i) for i in range(50)], "k string, v long")
    top = top_by(df, ["k"], [F.desc("v")], 3)
    assert tuples(top, "v", "rank") == [(47, 3), (48, 2), (49, 1)]
    plan = top._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan
