import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from marquee.operators import evaluate, recommend, scoring
from tests.conftest import tuples

N_USERS, N_ITEMS, WIDTH = 37, 53, 4


@pytest.fixture(params=["one block", "many blocks", "many blocks, shuffled"])
def blocks(request, monkeypatch):
    if request.param != "one block":
        monkeypatch.setattr(scoring, "USER_BLOCK", 5)
        monkeypatch.setattr(scoring, "ITEM_BLOCK", 7)
    if request.param.endswith("shuffled"):
        monkeypatch.setattr(scoring, "BROADCAST_BYTES", -1)


@pytest.fixture(scope="module")
def world(spark):
    """Whole-number factors, so that many scores tie; user 0 has seen nearly everything."""
    rng = np.random.default_rng(5)
    left, right = rng.integers(-3, 4, (N_USERS, WIDTH)), rng.integers(-3, 4, (N_ITEMS, WIDTH))
    scores = left @ right.T
    seen = {(u, i) for u in range(N_USERS) for i in range(N_ITEMS) if rng.random() < (0.95 if u == 0 else 0.2)}
    schema = "{} long, features array<float>"
    return {
        "scores": scores, "seen_set": seen,
        "users": spark.createDataFrame([(u, [float(x) for x in left[u]]) for u in range(N_USERS)], schema.format("user_idx")),
        "items": spark.createDataFrame([(i, [float(x) for x in right[i]]) for i in range(N_ITEMS)], schema.format("movie_idx")),
        "seen": spark.createDataFrame(sorted(seen), "user_idx long, movie_idx long"),
        "movies": spark.createDataFrame([(i, i + 1000, f"T{i}", "A") for i in range(N_ITEMS)],
                                        "movie_idx long, movieId long, title string, genres string"),
    }


def best(world, u, n, exclude=()):
    order = sorted((i for i in range(N_ITEMS) if (u, i) not in exclude), key=lambda i: (-world["scores"][u, i], i))
    return [(u, k + 1, i, float(world["scores"][u, i])) for k, i in enumerate(order[:n])]


def test_top_n_equals_brute_force(world, blocks):
    for seen, excluded in ((None, ()), (world["seen"], world["seen_set"])):
        got = recommend.recommend_unseen(world["users"], world["items"], 6, seen)
        want = [r for u in range(N_USERS) for r in best(world, u, 6, excluded)]
        assert tuples(got, "user_idx", "rank", "movie_idx", "score") == want


def test_more_asked_than_there_is(world):
    got = recommend.recommend_unseen(world["users"], world["items"], 500, world["seen"])
    assert got.count() == N_USERS * N_ITEMS - len(world["seen_set"])


@pytest.mark.parametrize("decimals", [None, 3])
def test_blocks_that_cannot_matter_are_spared(spark, decimals):
    """Vectors of a trained model: the same rows as all products give, with fewer products."""
    rng = np.random.default_rng(8)
    pairs = {(int(u), int(i)) for u, i in zip(rng.integers(0, 120, 4000), 300 * rng.random(4000) ** 3)}
    model = recommend.train(spark.createDataFrame([(u, i, 1.0) for u, i in sorted(pairs)],
                                                  "user_idx long, movie_idx long, weight double"), rank=6, maxIter=4)
    users, items = recommend.user_factors(model), recommend.item_factors(model)
    left, right = ({r[0]: np.array(r[1]) for r in side.collect()} for side in (users, items))
    spared = spark.sparkContext.accumulator(0)
    some = scoring.best_items(users, items, 5, decimals=decimals, item_block=20, spared=spared)
    got = {}
    for u, i, score in recommend.top_n(some, 5).select("user_idx", "movie_idx", "score").collect():
        got.setdefault(u, []).append((-score, i))
    for u, vector in left.items():
        scores = {i: float(vector @ v) for i, v in right.items()}
        scores = {i: s if decimals is None else round(s, decimals) for i, s in scores.items()}
        want = sorted((-s, i) for i, s in scores.items())[:5]
        assert np.allclose(sorted(s for s, _ in got[u]), [s for s, _ in want], atol=1e-9)
        assert {i for _, i in got[u]} == {i for _, i in want}
    assert 0 < spared.value < len(left) * -(-len(right) // 20)


def test_a_task_has_each_block_once(world, blocks, spark):
    """However many pairs of blocks a task has, no vector comes to it twice, and every pair of keys meets in one task."""
    lists = recommend.with_seen(world["users"], world["seen"])
    met = []
    cells = scoring._cells(lists, world["items"], "user_idx", "movie_idx", "features", ("seen",), "seen")
    rows = cells.withColumn("task", F.spark_partition_id()).collect()
    for task in {r["task"] for r in rows}:
        mine = [u for r in rows if r["task"] == task for u in r["user_keys"] or ()]
        theirs = [i for r in rows if r["task"] == task for i in r["item_keys"] or ()]
        assert len(mine) == len(set(mine)) and len(theirs) == len(set(theirs))
        met += [(u, i) for u in mine for i in theirs]
    assert sorted(met) == [(u, i) for u in range(N_USERS) for i in range(N_ITEMS)]


def test_auc_equals_all_pairs(world, blocks, spark):
    positives = {(u, (u * 7 + j * 11) % N_ITEMS) for u in range(N_USERS - 1) for j in range(1 + u % 4)}
    pos = spark.createDataFrame(sorted(positives), "user_idx long, movie_idx long")
    for seen, excluded in ((None, set()), (world["seen"], world["seen_set"])):
        got = {r["user_idx"]: r for r in evaluate.auc(world["users"], world["items"], pos, seen).collect()}
        for u in range(N_USERS):
            mine = [i for i in range(N_ITEMS) if (u, i) in positives and (u, i) not in excluded]
            others = [i for i in range(N_ITEMS) if (u, i) not in positives and (u, i) not in excluded]
            if not mine:
                assert u not in got
                continue
            s = world["scores"][u]
            share = np.mean([[(s[p] > s[o]) + (s[p] == s[o]) / 2 for o in others] for p in mine]) if others else 0.5
            assert got[u]["auc"] == pytest.approx(share)
            assert (got[u]["n_positives"], got[u]["n_negatives"]) == (len(mine), len(others))


def test_precision_and_recall(frame):
    ranked = frame([(1, 10, 1), (1, 11, 2), (1, 12, 3), (2, 10, 1)], "user_idx long, movie_idx long, rank int")
    positives = frame([(1, 10), (1, 12), (1, 99), (2, 55), (3, 1)], "user_idx long, movie_idx long")
    out = evaluate.precision_recall(ranked, positives, 2)
    assert tuples(out, "user_idx", "hits", "precision", "recall") == [
        (1, 1, 0.5, pytest.approx(1 / 3)), (2, 0, 0.0, 0.0), (3, 0, 0.0, 0.0)]
    assert evaluate.mean_metrics(out, "precision").first()["precision"] == pytest.approx(1 / 6)


REQUEST = "request_id long, user_idx long, n_recommendations int, exclude_rated boolean, use_features boolean"


def test_request_edge_cases(spark):
    rows = [(1, 999999, 10, True, True), (2, -1, 10, True, True), (3, 3, 0, True, True), (4, 3, 1000, True, True),
            (5, 3, 1, True, True), (6, None, 1, True, True)]
    checked = recommend.check_requests(spark.createDataFrame(rows, REQUEST), N_USERS)
    assert dict(tuples(checked, "request_id", "error")[:5]) == {
        1: "user_not_found", 2: "invalid_input", 3: "invalid_input", 4: "invalid_input", 5: None}
    assert tuples(recommend.accepted(checked), "request_id") == [(5,)]
    assert dict(tuples(recommend.error_counts(checked))) == {"invalid_input": 4, "user_not_found": 1}


def test_requests_are_answered(world, spark, frame):
    rows = [(i, u, 3, True, False) for i, u in enumerate((5, 6, 7, 8))]
    rows += [(10 + i, 0, 9, True, True) for i in range(50)]  # one user asks again and again
    rows += [(90, 5, 1, True, True), (91, 5, 2, False, True), (92, 6, 2, False, False), (99, 4000, 1, True, True)]
    activity = frame([(5, 35), (0, 0)], "user_idx long, user_recent_activity long")
    found, rejected = recommend.recommend(
        world["users"], world["items"], spark.createDataFrame(rows, REQUEST),
        world["seen"].withColumnRenamed("x", "y"), world["movies"], activity)
    by = {}
    for r in found.collect():
        by.setdefault(r["request_id"], []).append((r["rank"], r["movie_idx"], r["score"]))
    seen = world["seen_set"]
    for i, u in enumerate((5, 6, 7, 8)):
        assert sorted(by[i]) == [r[1:] for r in best(world, u, 3, seen)]
    left_for_0 = best(world, 0, 9, seen)
    assert all(sorted(by[10 + i]) == [r[1:] for r in left_for_0] for i in range(50))
    rank, movie, score = by[90][0]
    assert (rank, movie) == best(world, 5, 1, seen)[0][1:3]
    assert score == pytest.approx(best(world, 5, 1, seen)[0][3] * 1.2)
    assert [m for _, m, _ in sorted(by[91])] == [r[2] for r in best(world, 5, 2)]
    assert [s for _, _, s in sorted(by[92])] == [r[3] for r in best(world, 6, 2)]
    assert tuples(rejected, "request_id", "error") == [(99, "user_not_found")]


def test_every_accepted_request_has_a_response(world, spark, frame):
    rows = [(1, 5, 3, None, None), (2, 20, 4, True, True), (3, 6, 2, True, False), (4, 30, 2, False, True),
            (5, -3, 2, True, True), (6, 5, 1, False, False)]
    users = world["users"].where("user_idx <> 20")
    seen = world["seen"].union(world["items"].selectExpr("6L", "movie_idx"))
    requests = spark.createDataFrame(rows, REQUEST)
    found, rejected = recommend.recommend(users, world["items"], requests, seen, world["movies"], n_users=N_USERS)
    good = recommend.accepted(recommend.check_requests(requests, N_USERS))
    bundle = frame([(5, 3.5, "A"), (6, 2.0, "B"), (20, 1.0, None)], "user_idx long, mean double, genre string")
    out = {r["request_id"]: r for r in recommend.responses(good, found, users, bundle).collect()}
    assert {k: (r["count"], r["warning"]) for k, r in out.items()} == {
        1: (3, None), 2: (0, "prediction_error"), 3: (0, None), 4: (2, "feast_unavailable"), 6: (1, None)}
    assert [e["movie_idx"] for e in out[1]["recommendations"]] == [r[2] for r in best(world, 5, 3, world["seen_set"])]
    assert out[2]["recommendations"] == [] and out[1]["features"]["mean"] == 3.5 and out[6]["features"] is None
    history = frame([(5, 1, 7, "t", "A", 4.0)], "user_idx long, rank int, movieId long, title string, genres string, rating double")
    both = {r["request_id"]: r for r in recommend.batch_recommend(
        recommend.responses(good, found, users), history).collect()}
    assert len(both) == 5 and len(both[1]["user_history"]) == 1 and both[3]["user_history"] == []
    assert tuples(rejected, "request_id", "error") == [(5, "invalid_input")]


def test_score_histogram_equals_brute_force(world, blocks, frame):
    activity = frame([(1, 4), (2, 50)], "user_idx long, user_recent_activity long")
    bounds = [-4.0, 0.0, 2.5, 9.0]
    got = {r["le"]: r["n"] for r in recommend.score_histogram(
        world["users"], world["items"], bounds, world["seen"], activity).collect()}
    raised = [world["scores"][u, i] * {1: 1.04, 2: 1.2}.get(u, 1) for u in range(N_USERS) for i in range(N_ITEMS)
              if (u, i) not in world["seen_set"]]
    assert got == {**{b: sum(s <= b for s in raised) for b in bounds}, None: len(raised)}


@pytest.mark.parametrize("activity, factor", [(0, 1.0), (20, 1.2), (35, 1.2), (None, 1.0), (5, 1.05)])
def test_boost(frame, activity, factor):
    scores = frame([(1, 2, 10.0)], "user_idx long, movie_idx long, score double")
    recent = frame([(1, activity)], "user_idx long, user_recent_activity long")
    assert recommend.boost(scores, recent).first()["score"] == pytest.approx(10 * factor)


def test_metadata_drops_unknown_items_after_ranking(world, frame):
    ranked = frame([(1, 2, 1, 5.0), (1, 4000, 2, 4.0)], "user_idx long, movie_idx long, rank int, score double")
    assert tuples(recommend.with_metadata(ranked, world["movies"]), "movie_idx", "movieId") == [(2, 1002)]


def test_history(world, frame):
    ratings = frame([(1, m, float(m % 3), m) for m in range(20)] + [(1, 4000, 9.0, 0)],
                    "user_idx long, movie_idx long, rating double, timestamp long")
    rows = recommend.user_history(ratings, world["movies"], 10).orderBy("rank").collect()
    assert [r["movie_idx"] for r in rows] == [2, 5, 8, 11, 14, 17, 1, 4, 7, 10]


def test_training_leaves_few_shuffle_files(spark):
    """The files of an iteration go with it, however many there are."""
    def held():
        files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        return {files.apply(k).getName() for k in range(files.size())}

    rng = np.random.default_rng(3)
    pairs = sorted({(int(u), int(i), 1.0) for u, i in zip(rng.integers(0, 60, 500), rng.integers(0, 40, 500))})
    rows, before = spark.createDataFrame(pairs, "user_idx long, movie_idx long, weight double"), held()
    model = recommend.train(rows, rank=3, maxIter=8)
    for _ in range(100):
        shuffles = {n.split("_")[1] for n in held() - before if n.startswith("shuffle_")}
        if len(shuffles) <= 10:
            break
        time.sleep(0.1)
    # Six of the ratings and their blocks, two of an iteration; eight iterations have sixteen.
    assert len(shuffles) <= 10 and model.rank == 3


def test_trained_model_beats_popularity(spark):
    """Two tastes: users of one group like items of one half."""
    rng = np.random.default_rng(1)
    train, test = [], []
    for u in range(40):
        for i in range(30):
            if i % 2 == u % 2 and rng.random() < 0.7:
                (test if rng.random() < 0.25 else train).append((u, i, 4.0))
    schema = "user_idx long, movie_idx long, weight double"
    train, test = spark.createDataFrame(train, schema), spark.createDataFrame(test, schema)
    model = recommend.train(train, rank=4, maxIter=5)
    users, items = recommend.user_factors(model), recommend.item_factors(model)
    metrics = {r["part"]: r for r in evaluate.evaluate_model(users, items, train, test, 5).collect()}
    # Unrated items of the right half look like held-out ones, so about 0.885 is
    # the most a model can reach on test: (15 + 4.5 / 2) of 19.5 negatives.
    assert metrics["test"]["auc"] > 0.85 and metrics["train"]["auc"] > 0.85
    popular = train.groupBy("movie_idx").count()
    by_popularity = recommend.top_n(
        recommend.exclude_seen(users.select("user_idx").join(popular).withColumnRenamed("count", "score"),
                               recommend.seen_pairs(train)), 5)
    base = evaluate.mean_metrics(evaluate.precision_recall(by_popularity, test.drop("weight"), 5), "precision").first()
    assert metrics["test"]["precision"] > base["precision"]
