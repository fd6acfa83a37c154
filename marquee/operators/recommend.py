"""Recommendations for whole tables of users."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.recommendation import ALS, ALSModel
from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.scalars import activity_boost
from marquee.operators.ordering import top_by
from marquee.operators.scoring import best_items, score_counts
from marquee.session import collecting, durable, ensure_checkpoint_dir

# Most recommendations per request, and the error labels.
MOST_PER_REQUEST = 100
INVALID_INPUT, USER_NOT_FOUND = "invalid_input", "user_not_found"
PREDICTION_ERROR, FEATURES_UNAVAILABLE = "prediction_error", "feast_unavailable"

# The fit is cut into blocks of about this many pairs.
PAIRS_PER_BLOCK = 2_000_000


def train(interactions: DataFrame, **settings) -> ALSModel:
    """Fit the factor model on (user_idx, movie_idx, weight) rows.

    Pairs must be distinct, which also bounds what one user or item adds to a
    block. The number of blocks follows the number of pairs. Each iteration sends
    the factors to the blocks anew. As the item factors are checkpointed every
    time, nothing needs the shuffle files of the iterations before: MLlib drops
    those towards the items, the driver's garbage collection those towards the users.
    """
    ensure_checkpoint_dir(interactions.sparkSession)
    blocks = max(10, -(-interactions.count() // PAIRS_PER_BLOCK))
    chosen = {"rank": 30, "maxIter": 10, "seed": 42, "implicitPrefs": True, "coldStartStrategy": "drop",
              "numUserBlocks": blocks, "numItemBlocks": blocks, "checkpointInterval": 1, **settings}
    with collecting(interactions.sparkSession):
        return ALS(userCol="user_idx", itemCol="movie_idx", ratingCol="weight", **chosen).fit(interactions)


def user_factors(model: ALSModel) -> DataFrame:
    return model.userFactors.select(F.col("id").cast("long").alias("user_idx"), "features")


def item_factors(model: ALSModel) -> DataFrame:
    return model.itemFactors.select(F.col("id").cast("long").alias("movie_idx"), "features")


def user_bound(users: DataFrame) -> Column:
    """One above the greatest known index."""
    return users.agg(F.max("user_idx") + 1).scalar()


def check_requests(requests: DataFrame, n_users: int | Column) -> DataFrame:
    """Add ``error``: the label of the first broken rule, or null; flags that are null become true."""
    user, n = F.col("user_idx"), F.col("n_recommendations")
    bound = n_users if isinstance(n_users, Column) else F.lit(n_users)
    # A flag that is not given is set.
    return requests.withColumns({f: F.coalesce(F.col(f), F.lit(True)) for f in ("exclude_rated", "use_features")
                                 if f in requests.columns}).withColumn(
        "error",
        F.when(user.isNull() | (user < 0), INVALID_INPUT)
        .when(user >= bound, USER_NOT_FOUND)
        .when(n.isNull() | (n < 1) | (n > MOST_PER_REQUEST), INVALID_INPUT))


def accepted(checked: DataFrame) -> DataFrame:
    return checked.where(F.col("error").isNull()).drop("error")


def error_counts(checked: DataFrame) -> DataFrame:
    return (checked.where(F.col("error").isNotNull())
            .groupBy(F.col("error").alias("type")).agg(F.count("*").alias("n")))


def seen_pairs(ratings: DataFrame) -> DataFrame:
    return ratings.select("user_idx", "movie_idx").distinct()


def exclude_seen(scores: DataFrame, seen: DataFrame) -> DataFrame:
    return scores.join(seen, ["user_idx", "movie_idx"], "left_anti")


def top_n(scores: DataFrame, n: int = 10) -> DataFrame:
    """Best ``n`` per user, equal scores by movie_idx."""
    return top_by(scores, ["user_idx"], [F.desc("score"), F.asc("movie_idx")], n)


def recommend_unseen(users: DataFrame, items: DataFrame, n: int = 10,
                     seen: DataFrame | None = None, decimals: int | None = None,
                     wanted: str | None = None) -> DataFrame:
    """Best ``n`` items per user from factor tables, without ``seen`` pairs.

    Seen items are taken out where they are scored, so each user leaves its
    task with ``n`` rows at most, or with as many as its own array column
    ``wanted`` says. A user's list holds an item once.
    """
    if seen is None:
        return top_n(best_items(users, items, n, wanted=wanted, decimals=decimals), n)
    return top_n(best_items(with_seen(users, seen), items, n, "seen", wanted=wanted, decimals=decimals), n)


def with_seen(users: DataFrame, seen: DataFrame) -> DataFrame:
    """Users with the array ``seen`` of their items, each once."""
    lists = seen.groupBy("user_idx").agg(F.collect_set(F.col("movie_idx").cast("long")).alias("seen"))
    return users.join(lists, "user_idx", "left").withColumn(
        "seen", F.coalesce("seen", F.array().cast("array<long>")))


def score_histogram(users: DataFrame, items: DataFrame, bounds: Sequence[float], seen: DataFrame,
                    activity: DataFrame | None = None, decimals: int | None = None) -> DataFrame:
    """Cumulative counts of the scores that answers choose from: unseen items, after the boost."""
    asked = with_seen(users, seen)
    if activity is not None:
        asked = asked.join(activity.select("user_idx", "user_recent_activity"), "user_idx", "left")
        factor = activity_boost(F.lit(1.0), F.col("user_recent_activity"))
        asked = asked.withColumn("factor", F.array(factor)).drop("user_recent_activity")
    return score_counts(asked, items, bounds, "seen", "factor" if activity is not None else None, decimals=decimals)


def boost(scores: DataFrame, activity: DataFrame, cap: int = 20, step: float = 0.01) -> DataFrame:
    """Raise each user's scores by recent activity; users without any keep theirs."""
    joined = scores.join(activity.select("user_idx", "user_recent_activity"), "user_idx", "left")
    raised = activity_boost(F.col("score"), F.col("user_recent_activity"), cap, step)
    return joined.withColumn("score", raised).drop("user_recent_activity")


def with_metadata(ranked: DataFrame, movies: DataFrame) -> DataFrame:
    """Title and genres of ranked items; an item without metadata drops out."""
    known = movies.select("movie_idx", "movieId", "title", "genres")
    return ranked.join(known, "movie_idx")


def recommend(users: DataFrame, items: DataFrame, requests: DataFrame, ratings: DataFrame,
              movies: DataFrame, activity: DataFrame | None = None,
              n_users: int | Column | None = None, decimals: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Answer a table of requests; returns (recommendations, rejected requests).

    Requests are (request_id, user_idx, n_recommendations, exclude_rated,
    use_features). Each user is scored once however often requested, for as many
    items as its largest request. A request that finds nothing has no rows here;
    ``responses`` gives it an empty list.
    """
    if n_users is None:
        n_users = user_bound(users)
    checked = durable(check_requests(requests, n_users), "requests")
    good = accepted(checked)
    asked = durable(good.groupBy("user_idx", "exclude_rated").agg(
        F.max("n_recommendations").alias("_n")), "asked")

    def ranked(exclude: bool) -> DataFrame:
        own = asked.where(F.col("exclude_rated") == exclude).select("user_idx", F.array("_n").alias("wanted"))
        seen = seen_pairs(ratings) if exclude else None
        found = recommend_unseen(users.join(own, "user_idx"), items, MOST_PER_REQUEST, seen, decimals, "wanted")
        return found.withColumn("exclude_rated", F.lit(exclude))

    both = ranked(True).unionByName(ranked(False))
    # Rows beyond the largest request of a user go before the requests multiply them.
    both = both.join(asked, ["user_idx", "exclude_rated"]).where(F.col("rank") <= F.col("_n")).drop("_n")
    answers = good.join(both, ["user_idx", "exclude_rated"]).where(
        F.col("rank") <= F.col("n_recommendations"))
    if activity is not None:
        recent = activity.select("user_idx", "user_recent_activity")
        raised = activity_boost(F.col("score"), F.col("user_recent_activity"))
        answers = answers.join(recent, "user_idx", "left").withColumn(
            "score", F.when(F.col("use_features"), raised).otherwise(F.col("score")))
    rejected = checked.where(F.col("error").isNotNull())
    columns = ["request_id", "user_idx", "rank", "movie_idx", "movieId", "title", "genres", "score"]
    return with_metadata(answers, movies).select(columns), rejected


def responses(requests: DataFrame, recommendations: DataFrame, users: DataFrame,
              bundle: DataFrame | None = None) -> DataFrame:
    """One row per accepted request: ``request_id, user_idx, recommendations, count, features, warning``.

    The list has the best first, 100 entries at most; it is empty, and ``count``
    0, where nothing was found. ``features`` is the user's row of ``bundle``, or
    null where the request does not use features. ``warning`` labels users
    without factors and, else, users without a row in the bundle.
    """
    entry = F.struct("rank", "movie_idx", "movieId", "title", "genres", "score")
    lists = recommendations.groupBy("request_id").agg(
        F.array_sort(F.collect_list(entry)).alias("recommendations"))
    none = F.array().cast(lists.schema["recommendations"].dataType)
    known = users.select("user_idx", F.lit(True).alias("_known")).distinct()
    answered = (requests.join(lists, "request_id", "left").join(known, "user_idx", "left")
                .withColumn("recommendations", F.coalesce("recommendations", none)))
    lacks = F.lit(False)
    if bundle is None:
        answered = answered.withColumn("features", F.lit(None).cast("string"))
    else:
        fields = [c for c in bundle.columns if c != "user_idx"]
        rows = bundle.select("user_idx", F.struct(*fields).alias("_features"))
        answered = answered.join(rows, "user_idx", "left").withColumn(
            "features", F.when(F.col("use_features"), F.col("_features")))
        lacks = F.col("use_features") & F.col("_features").isNull()
    return answered.select(
        "request_id", "user_idx", "recommendations", F.size("recommendations").alias("count"), "features",
        F.when(F.col("_known").isNull(), PREDICTION_ERROR).when(lacks, FEATURES_UNAVAILABLE).alias("warning"))


def batch_recommend(answered: DataFrame, history: DataFrame) -> DataFrame:
    """Each response with the user's best rated movies, an empty list if there are none."""
    entry = F.struct("rank", "movieId", "title", "genres", "rating")
    lists = history.groupBy("user_idx").agg(
        F.array_sort(F.collect_list(entry)).alias("user_history"))
    none = F.array().cast(lists.schema["user_history"].dataType)
    return answered.join(lists, "user_idx", "left").withColumn("user_history", F.coalesce("user_history", none))


def user_history(ratings: DataFrame, movies: DataFrame, n: int = 10) -> DataFrame:
    """Each user's best rated movies, equal ratings by movie, then newest.

    Only ratings of movies with metadata count, as the history shows titles.
    """
    known = ratings.join(movies.select("movie_idx"), "movie_idx", "left_semi")
    best = top_by(known, ["user_idx"],
                  [F.desc("rating"), F.asc("movie_idx"), F.desc("timestamp")], n)
    return with_metadata(best, movies).select(
        "user_idx", "rank", "movie_idx", "movieId", "title", "genres", "rating")
