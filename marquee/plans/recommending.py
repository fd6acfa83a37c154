"""Registered queries: ranking, recommendation, evaluation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.operators import evaluate, recommend, split, store
from marquee.plans import featuring
from marquee.plans.cleaning import PARTS
from marquee.plans.common import EVENTS, FACTORS, MOVIES, RATINGS, Query, as_doubles, rounded, sql
from marquee.session import collect_garbage, durable
from marquee.sources import proxies
from marquee.streaming import counters

# Scores are rounded to nine decimals, raised ones have eleven: no value lies half-way between two roundings.
SCORE_DECIMALS = 9
DECIMALS = 12
SCORE_BOUNDS = [-1.0, -0.5, -0.25, 0.0, 0.25, 0.5, 1.0, 2.0]


def _factors(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Every vector as a user and as an item."""
    vectors = proxies.factors(spark, folder)
    return (vectors.select(F.col("vec_id").alias("user_idx"), F.col("embedding").alias("features")),
            vectors.select(F.col("vec_id").alias("movie_idx"), F.col("embedding").alias("features")))


def _known_ratings(spark: SparkSession, folder: str) -> DataFrame:
    """Ratings whose user and item have a vector."""
    users, items = _factors(spark, folder)
    return (proxies.ratings(spark, folder).join(users, "user_idx", "left_semi")
            .join(items, "movie_idx", "left_semi"))


def _positives(ratings: DataFrame) -> DataFrame:
    return recommend.seen_pairs(ratings.where(F.col("rating") >= 4))


def recommend_topn(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(recommend.recommend_unseen(*_factors(spark, folder), n=10, decimals=SCORE_DECIMALS), DECIMALS)


def exclude_seen(spark: SparkSession, folder: str) -> DataFrame:
    seen = recommend.seen_pairs(_known_ratings(spark, folder))
    return rounded(recommend.recommend_unseen(*_factors(spark, folder), n=10, seen=seen, decimals=SCORE_DECIMALS), DECIMALS)


def recommend_boosted(spark: SparkSession, folder: str) -> DataFrame:
    ranked = recommend.recommend_unseen(*_factors(spark, folder), n=10, decimals=SCORE_DECIMALS)
    activity = counters.user_activity(proxies.events(spark, folder))
    return rounded(recommend.with_metadata(recommend.boost(ranked, activity), proxies.movies(spark, folder)), DECIMALS)


# One user in ten has no factors, and one has seen every item.
LACKING, SATED = 8, 6


def _requests(spark: SparkSession, folder: str) -> DataFrame:
    """Events as requests, some of them out of bounds, some without a flag."""
    kind = F.col("event_type")
    return proxies.events(spark, folder).select(
        F.col("event_id").alias("request_id"),
        (F.col("user_idx") * 4 - 2).alias("user_idx"),
        F.floor(F.col("value") / 3).cast("int").alias("n_recommendations"),
        F.when(kind != "error", kind != "view").alias("exclude_rated"),
        F.when(kind != "signup", kind == "click").alias("use_features"))


def request_errors(spark: SparkSession, folder: str) -> DataFrame:
    users, _ = _factors(spark, folder)
    checked = recommend.check_requests(_requests(spark, folder), recommend.user_bound(users))
    return recommend.error_counts(checked)


def _answered(spark: SparkSession, folder: str) -> DataFrame:
    """One row per accepted request, with the five features."""
    users, items = _factors(spark, folder)
    bound = recommend.user_bound(users)
    users = users.where(F.col("user_idx") % 10 != LACKING)
    events = proxies.events(spark, folder)
    seen = recommend.seen_pairs(_known_ratings(spark, folder)).unionByName(
        items.select(F.lit(SATED).cast("long").alias("user_idx"), "movie_idx"))
    requests = _requests(spark, folder)
    found, _ = recommend.recommend(users, items, requests, seen, proxies.movies(spark, folder),
                                   counters.user_activity(events), bound, SCORE_DECIMALS)
    good = recommend.accepted(recommend.check_requests(requests, bound))
    return recommend.responses(good, found, users, featuring.online_user_features(spark, folder))


FEATURES = [f.split(":")[1] for f in store.USER_BUNDLE]


def recommend_requests(spark: SparkSession, folder: str) -> DataFrame:
    """Every accepted request with its items, one row without any where nothing was found."""
    rows = _answered(spark, folder).select(
        "request_id", "user_idx", "count", "warning", *[F.col(f"features.{f}").alias(f) for f in FEATURES],
        F.inline_outer("recommendations"))
    return as_doubles(rounded(rows, DECIMALS), "rank", "movie_idx", "movieId", "user_recent_activity")


def batch_recommend(spark: SparkSession, folder: str) -> DataFrame:
    """One row per accepted request, with history and features, the lists written as text."""
    history = recommend.user_history(proxies.ratings(spark, folder), proxies.movies(spark, folder))
    answered = recommend.batch_recommend(_answered(spark, folder), history)
    rows = answered.select(
        "request_id", "user_idx", "count", "warning",
        F.concat_ws(",", F.transform("recommendations", lambda e: e.movie_idx.cast("string"))).alias("recommended"),
        F.concat_ws(",", F.transform("user_history", lambda e: F.concat(
            e.movieId, F.lit(":"), e.rating))).alias("history"),
        *[F.col(f"features.{f}").alias(f) for f in FEATURES])
    return as_doubles(rows, "user_recent_activity")


def user_history_top10(spark: SparkSession, folder: str) -> DataFrame:
    return recommend.user_history(proxies.ratings(spark, folder), proxies.movies(spark, folder))


def score_histogram(spark: SparkSession, folder: str) -> DataFrame:
    """Scores that answers choose from: unseen items of every user, after the boost, in cumulative buckets."""
    counted = recommend.score_histogram(
        *_factors(spark, folder), SCORE_BOUNDS, recommend.seen_pairs(_known_ratings(spark, folder)),
        counters.user_activity(proxies.events(spark, folder)), SCORE_DECIMALS)
    return counted.withColumn("le", F.coalesce(F.col("le").cast("string"), F.lit("+Inf")))


def precision_recall_at_10(spark: SparkSession, folder: str) -> DataFrame:
    known = _known_ratings(spark, folder)
    seen = recommend.seen_pairs(known.where(F.col("rating") < 2))
    positives = _positives(known).join(seen, ["user_idx", "movie_idx"], "left_anti")
    ranked = recommend.recommend_unseen(*_factors(spark, folder), n=10, seen=seen, decimals=SCORE_DECIMALS)
    return rounded(evaluate.precision_recall(ranked, positives, 10))


def auc_per_user(spark: SparkSession, folder: str) -> DataFrame:
    known = _known_ratings(spark, folder)
    seen = recommend.seen_pairs(known.where(F.col("rating") < 2))
    return rounded(evaluate.auc(*_factors(spark, folder), _positives(known), seen, SCORE_DECIMALS))


def mean_ranking_metrics(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.mean_metrics(precision_recall_at_10(spark, folder), "precision", "recall"), 5)


def _trained(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    train, test = split.chronological_split(proxies.ratings(spark, folder))
    pairs = durable(split.interactions(train), "train", tidy=True)
    model = recommend.train(pairs)
    users, items = (durable(side(model), "factors") for side in (recommend.user_factors, recommend.item_factors))
    # With the model go the shuffle files and stored blocks of the fit.
    del model
    collect_garbage(spark)
    return users, items, pairs, split.interactions(split.restrict_to_known(test, train))


def evaluate_factors(spark: SparkSession, folder: str) -> DataFrame:
    """Precision, recall and AUC of the given factors, on train and on test with train items left out."""
    train, test = split.chronological_split(_known_ratings(spark, folder))
    return rounded(evaluate.evaluate_model(*_factors(spark, folder), train, split.restrict_to_known(test, train),
                                           decimals=SCORE_DECIMALS))


def als_properties(spark: SparkSession, folder: str) -> DataFrame:
    """Facts that hold of any trained model and its recommendations."""
    users, items, train, _ = _trained(spark, folder)
    ranked = durable(recommend.recommend_unseen(users, items, 10, recommend.seen_pairs(train)), "ranked", tidy=True)
    per_user = ranked.groupBy("user_idx").agg(F.count("*").alias("n"), F.max("rank").alias("last"))
    unknown = train.select("user_idx").distinct().join(users, "user_idx", "left_anti")
    return spark.range(1).select(
        (unknown.agg(F.count("*")).scalar() == 0).alias("every_user_has_factors"),
        (ranked.join(train, ["user_idx", "movie_idx"], "left_semi").agg(F.count("*")).scalar() == 0)
        .alias("nothing_seen_is_recommended"),
        per_user.agg(F.coalesce(F.bool_and(F.col("n") == F.col("last")), F.lit(True))).scalar()
        .alias("ranks_have_no_gaps"),
        (per_user.agg(F.count("*")).scalar() == users.agg(F.count("*")).scalar()).alias("every_user_is_answered"))


def als_recommend(spark: SparkSession, folder: str) -> DataFrame:
    """Fit on train, then ten unseen movies with metadata for every user."""
    users, items, train, _ = _trained(spark, folder)
    ranked = recommend.recommend_unseen(users, items, 10, recommend.seen_pairs(train))
    return rounded(recommend.with_metadata(ranked, proxies.movies(spark, folder)), DECIMALS)


def als_evaluate(spark: SparkSession, folder: str) -> DataFrame:
    return rounded(evaluate.evaluate_model(*_trained(spark, folder)))


QUERIES: dict[str, Query] = {f.__name__: f for f in (
    recommend_topn, exclude_seen, recommend_boosted, request_errors, recommend_requests, batch_recommend,
    user_history_top10, score_histogram, precision_recall_at_10, auc_per_user, mean_ranking_metrics,
    evaluate_factors, als_properties, als_recommend, als_evaluate)}

_RANK = "row_number() OVER (PARTITION BY user_idx ORDER BY score DESC, movie_idx)"
_SEEN = "seen AS (SELECT DISTINCT user_idx, movie_idx FROM known)"
_LOW = "low AS (SELECT DISTINCT user_idx, movie_idx FROM known WHERE rating < 2)"
_HIGH = "high AS (SELECT DISTINCT user_idx, movie_idx FROM known WHERE rating >= 4)"
_UNSEEN = """unseen AS (SELECT * FROM scores s WHERE NOT EXISTS (
    SELECT 1 FROM seen WHERE seen.user_idx = s.user_idx AND seen.movie_idx = s.movie_idx))"""
_CLEAN_HIGH = """pos AS (SELECT h.user_idx, h.movie_idx FROM high h WHERE NOT EXISTS (
    SELECT 1 FROM low WHERE low.user_idx = h.user_idx AND low.movie_idx = h.movie_idx))"""
_ACTIVITY = "act AS (SELECT user_idx, count(*) AS a FROM ev GROUP BY 1)"
_REQUESTS = """req AS (SELECT event_id AS request_id, user_idx * 4 - 2 AS user_idx,
    CAST(floor("value" / 3) AS INT) AS n,
    CASE WHEN event_type = 'error' THEN TRUE ELSE event_type <> 'view' END AS exclude_rated,
    CASE WHEN event_type = 'signup' THEN TRUE ELSE event_type = 'click' END AS use_features FROM ev),
checked AS (SELECT *, CASE WHEN user_idx < 0 THEN 'invalid_input' WHEN user_idx > (SELECT max(vec_id) FROM embeddings)
    THEN 'user_not_found'
    WHEN n < 1 OR n > 100 THEN 'invalid_input' END AS error FROM req)"""
_AT_10 = f"""ranked AS (SELECT *, {_RANK} AS rank FROM scores s WHERE NOT EXISTS (
    SELECT 1 FROM low WHERE low.user_idx = s.user_idx AND low.movie_idx = s.movie_idx)),
at10 AS (SELECT p.user_idx, count(*) AS n_positives, count(r.rank) AS hits
    FROM pos p LEFT JOIN ranked r ON p.user_idx = r.user_idx AND p.movie_idx = r.movie_idx AND r.rank <= 10
    GROUP BY 1)"""

_HISTORY = """SELECT user_idx, row_number() OVER (PARTITION BY user_idx
    ORDER BY rating DESC, movie_idx, "timestamp" DESC) AS rank, movie_idx, "movieId", title, genres, rating
    FROM ratings JOIN movies USING (movie_idx) QUALIFY rank <= 10"""
_ITEMS = f"""items_of AS (
    SELECT s.user_idx, s.movie_idx, s.score, TRUE AS x, {_RANK} AS rank FROM scores s
    WHERE user_idx % 10 <> {LACKING} AND user_idx <> {SATED} AND NOT EXISTS (
        SELECT 1 FROM seen WHERE seen.user_idx = s.user_idx AND seen.movie_idx = s.movie_idx)
    UNION ALL SELECT user_idx, movie_idx, score, FALSE, {_RANK} FROM scores WHERE user_idx % 10 <> {LACKING}),
bundle AS (SELECT * FROM ({featuring.ORACLES["online_user_features"]})),
found AS (SELECT request_id, rank, r.movie_idx, "movieId", title, genres,
    round(score * CASE WHEN use_features AND a > 0 THEN 1 + least(a, 20) * CAST(0.01 AS DOUBLE)
          ELSE 1 END, 12) AS score
    FROM checked c JOIN items_of r ON c.user_idx = r.user_idx AND c.exclude_rated = r.x AND r.rank <= c.n
    LEFT JOIN act ON act.user_idx = c.user_idx JOIN movies m ON m.movie_idx = r.movie_idx WHERE error IS NULL),
asked AS (SELECT c.request_id, c.user_idx, coalesce(f.n, 0) AS "count",
    CASE WHEN c.user_idx % 10 = {LACKING} THEN 'prediction_error'
         WHEN use_features AND b.user_idx IS NULL THEN 'feast_unavailable' END AS warning,
    {", ".join(f"CASE WHEN use_features THEN b.{f} END AS {f}" for f in FEATURES)}
    FROM checked c LEFT JOIN (SELECT request_id, count(*) AS n FROM found GROUP BY 1) f ON f.request_id = c.request_id
    LEFT JOIN bundle b ON b.user_idx = c.user_idx WHERE error IS NULL)"""
_SERVING = (RATINGS, FACTORS, EVENTS, MOVIES, _SEEN, _ACTIVITY, _REQUESTS, _ITEMS)
_AS_DOUBLE = "CAST(user_recent_activity AS DOUBLE) AS user_recent_activity"



def _measured(part: str) -> str:
    """The metrics of one part."""
    return f"""SELECT '{part}' AS part, (SELECT count(*) FROM n_{part}) AS n_users,
        (SELECT round(avg(hits / CAST(10 AS DOUBLE)), 6) FROM at_{part}) AS precision,
        (SELECT round(avg(hits / CAST(n AS DOUBLE)), 6) FROM at_{part}) AS recall,
        (SELECT round(avg(auc), 6) FROM auc_{part}) AS auc"""


def _part(part: str, positives: str, left_out: str) -> str:
    """Tables of one part: positives per user, hits among the first ten, area per user."""
    return f"""n_{part} AS (SELECT user_idx, count(*) AS n FROM {positives} GROUP BY 1),
ranked_{part} AS (SELECT *, {_RANK} AS rank FROM scores s WHERE NOT ({left_out})),
at_{part} AS (SELECT n.user_idx, n.n AS n, count(r.rank) AS hits FROM n_{part} n
    JOIN {positives} p ON p.user_idx = n.user_idx
    LEFT JOIN ranked_{part} r ON r.user_idx = p.user_idx AND r.movie_idx = p.movie_idx AND r.rank <= 10 GROUP BY 1, 2),
auc_{part} AS (SELECT a.user_idx,
    avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0.0 END) AS auc
    FROM (SELECT r.* FROM ranked_{part} r JOIN {positives} USING (user_idx, movie_idx)) a
    JOIN (SELECT * FROM ranked_{part} r WHERE NOT EXISTS (SELECT 1 FROM {positives} p
          WHERE p.user_idx = r.user_idx AND p.movie_idx = r.movie_idx)) b ON a.user_idx = b.user_idx GROUP BY 1)"""


_EVALUATED = (
    PARTS.replace("FROM ratings", "FROM known"),
    "tr AS (SELECT DISTINCT user_idx, movie_idx FROM train)",
    """te AS (SELECT DISTINCT user_idx, movie_idx FROM test WHERE user_idx IN (SELECT user_idx FROM train)
        AND movie_idx IN (SELECT movie_idx FROM train))""",
    _part("train", "tr", "FALSE"),
    _part("test", "te", "EXISTS (SELECT 1 FROM tr t WHERE t.user_idx = s.user_idx AND t.movie_idx = s.movie_idx)"))

ORACLES: dict[str, str] = {
    "evaluate_factors": sql(" UNION ALL ".join(_measured(p) for p in ("train", "test")),
                            RATINGS, FACTORS, *_EVALUATED),
    "als_properties": """SELECT TRUE AS every_user_has_factors, TRUE AS nothing_seen_is_recommended,
        TRUE AS ranks_have_no_gaps, TRUE AS every_user_is_answered""",
    "recommend_topn": sql(f"""SELECT user_idx, movie_idx, round(score, 12) AS score, {_RANK} AS rank FROM scores
        QUALIFY rank <= 10""", RATINGS, FACTORS),
    "exclude_seen": sql(f"""SELECT user_idx, movie_idx, round(score, 12) AS score, {_RANK} AS rank FROM unseen
        QUALIFY rank <= 10""", RATINGS, FACTORS, _SEEN, _UNSEEN),
    "recommend_boosted": sql(f"""SELECT user_idx, r.movie_idx, rank, "movieId", title, genres,
        round(score * CASE WHEN a > 0 THEN 1 + least(a, 20) * CAST(0.01 AS DOUBLE) ELSE 1 END, 12) AS score
        FROM (SELECT *, {_RANK} AS rank FROM scores QUALIFY rank <= 10) r
        LEFT JOIN act USING (user_idx) JOIN movies m ON m.movie_idx = r.movie_idx""",
                             RATINGS, FACTORS, EVENTS, MOVIES, _ACTIVITY),
    "request_errors": sql("SELECT error AS type, count(*) AS n FROM checked WHERE error IS NOT NULL GROUP BY 1",
                          EVENTS, _REQUESTS),
    "recommend_requests": sql(f"""SELECT a.* REPLACE ({_AS_DOUBLE}), CAST(rank AS DOUBLE) AS rank,
        CAST(movie_idx AS DOUBLE) AS movie_idx, CAST("movieId" AS DOUBLE) AS "movieId", title, genres, score
        FROM asked a LEFT JOIN found f ON a.request_id = f.request_id""", *_SERVING),
    "batch_recommend": sql(f"""SELECT a.* REPLACE ({_AS_DOUBLE}), coalesce(l.recommended, '') AS recommended,
        coalesce(h.history, '') AS history FROM asked a
        LEFT JOIN (SELECT request_id, string_agg(movie_idx, ',' ORDER BY rank) AS recommended
                   FROM found GROUP BY 1) l ON l.request_id = a.request_id
        LEFT JOIN (SELECT user_idx, string_agg("movieId" || ':' || rating, ',' ORDER BY rank) AS history
                   FROM ({_HISTORY}) GROUP BY 1) h ON a.user_idx = h.user_idx""", *_SERVING),
    "user_history_top10": sql(_HISTORY, RATINGS, MOVIES),
    "score_histogram": sql("""SELECT le, count(*) FILTER (WHERE bound IS NULL OR score <= bound) AS n FROM
        (SELECT score * CASE WHEN a > 0 THEN 1 + least(a, 20) * CAST(0.01 AS DOUBLE) ELSE 1 END AS score
         FROM unseen LEFT JOIN act USING (user_idx)), (VALUES """ + ", ".join(
            f"('{b}', CAST({b} AS DOUBLE))" for b in SCORE_BOUNDS) + """, ('+Inf', NULL)) b(le, bound)
        GROUP BY le""", RATINGS, FACTORS, EVENTS, _SEEN, _UNSEEN, _ACTIVITY),
    "precision_recall_at_10": sql("""SELECT user_idx, n_positives, hits, round(hits / CAST(10 AS DOUBLE), 6) AS precision,
        round(hits / CAST(n_positives AS DOUBLE), 6) AS recall FROM at10""",
                                  RATINGS, FACTORS, _LOW, _HIGH, _CLEAN_HIGH, _AT_10),
    "mean_ranking_metrics": sql("""SELECT count(*) AS n_users, round(avg(hits / CAST(10 AS DOUBLE)), 5) AS precision,
        round(avg(round(hits / CAST(n_positives AS DOUBLE), 6)), 5) AS recall FROM at10""",
                                RATINGS, FACTORS, _LOW, _HIGH, _CLEAN_HIGH, _AT_10),
    "auc_per_user": sql("""SELECT p.user_idx, count(DISTINCT p.movie_idx) AS n_positives,
        count(DISTINCT n.movie_idx) AS n_negatives,
        round(avg(CASE WHEN p.score > n.score THEN 1.0 WHEN p.score = n.score THEN 0.5 ELSE 0.0 END), 6) AS auc
        FROM (SELECT * FROM scores JOIN pos USING (user_idx, movie_idx)) p
        JOIN (SELECT * FROM scores s WHERE NOT EXISTS (SELECT 1 FROM pos
                WHERE pos.user_idx = s.user_idx AND pos.movie_idx = s.movie_idx)
              AND NOT EXISTS (SELECT 1 FROM low
                WHERE low.user_idx = s.user_idx AND low.movie_idx = s.movie_idx)) n
          ON p.user_idx = n.user_idx GROUP BY 1""", RATINGS, FACTORS, _LOW, _HIGH, _CLEAN_HIGH),
}
