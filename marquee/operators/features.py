"""Batch features per user, per movie, and each user's favourite genre."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from marquee.functions.genres import genre_flag, genre_list, genre_map
from marquee.functions.scalars import SECONDS_PER_DAY, std_or_zero
from marquee.session import durable


def _known_at(ratings: DataFrame, as_of: int | None) -> DataFrame:
    """Ratings up to a cutoff in epoch seconds, so features never look ahead."""
    return ratings if as_of is None else ratings.where(F.col("timestamp") <= as_of)


def _rating_aggregates(ratings: DataFrame, keys: Sequence[str], prefix: str) -> DataFrame:
    rating, time = F.col("rating"), F.col("timestamp")
    return ratings.groupBy(*keys).agg(
        F.avg(rating).alias(f"{prefix}_avg_rating"),
        std_or_zero(rating).alias(f"{prefix}_rating_std"),
        F.count(rating).alias(f"{prefix}_rating_count"),
        F.min(rating).alias(f"{prefix}_min_rating"),
        F.max(rating).alias(f"{prefix}_max_rating"),
        F.min(time).alias(f"{prefix}_first_rating_time"),
        F.max(time).alias(f"{prefix}_last_rating_time"),
    ).withColumn(f"{prefix}_rating_range", F.col(f"{prefix}_max_rating") - F.col(f"{prefix}_min_rating"))


def _user_aggregates(ratings: DataFrame, keys: Sequence[str]) -> DataFrame:
    days = (F.col("user_last_rating_time") - F.col("user_first_rating_time")) / SECONDS_PER_DAY
    return _rating_aggregates(ratings, keys, "user").withColumn("user_days_active", days)


def user_features(ratings: DataFrame, as_of: int | None = None) -> DataFrame:
    return _user_aggregates(_known_at(ratings, as_of), ["user_idx"])


def user_feature_history(ratings: DataFrame, cutoffs: Sequence[int]) -> DataFrame:
    """``user_features`` as of each cutoff, with ``as_of`` in epoch seconds.

    One pass: a rating counts towards every cutoff it precedes, and the copies
    meet the map-side aggregation at once.
    """
    reached = F.filter(F.array(*[F.lit(c).cast("long") for c in cutoffs]), lambda c: c >= F.col("timestamp"))
    return _user_aggregates(ratings.withColumn("as_of", F.explode(reached)), ["user_idx", "as_of"])


def genre_vocabulary(movies: DataFrame) -> DataFrame:
    """All genres, sorted."""
    return (movies.select(F.explode(genre_list(F.col("genres"))).alias("genre"))
            .distinct().orderBy("genre"))


def vocabulary_list(movies: DataFrame) -> list[str]:
    """The vocabulary as names, needed before one column per genre can be planned."""
    return [row["genre"] for row in genre_vocabulary(movies).collect()]


def genre_one_hot(movies: DataFrame, vocabulary: Sequence[str] | None = None) -> DataFrame:
    """Add one 0/1 column per genre; no genres means all 0."""
    names = vocabulary_list(movies) if vocabulary is None else vocabulary
    if len({n.lower() for n in names}) < len(names):
        raise ValueError("genres differ in case only; use genre_maps")
    flags = [genre_flag(F.col("_genres"), g).alias(f"genre_{g}") for g in names]
    return movies.withColumn("_genres", genre_list(F.col("genres"))).select(*movies.columns, *flags)


def genre_maps(movies: DataFrame) -> DataFrame:
    """The same membership as one map column, for very wide vocabularies."""
    return movies.withColumn("genre_flags", genre_map(F.col("genres")))


def movie_aggregates(ratings: DataFrame, as_of: int | None = None) -> DataFrame:
    """Rating aggregates, popularity and the weighted quality score per movie.

    The score pulls a movie's mean towards the global mean with the weight of
    an average movie's rating count. Both come from the per-movie rows, which
    are written once so that the ratings are read and aggregated once only.
    """
    per_movie = durable(_rating_aggregates(_known_at(ratings, as_of), ["movie_idx"], "movie"), "per-movie")
    count, mean = F.col("movie_rating_count"), F.col("movie_avg_rating")
    typical = per_movie.agg(F.avg(count)).scalar()
    overall = per_movie.agg(F.sum(mean * count) / F.sum(count)).scalar()
    return per_movie.select(
        "*",
        F.log1p(count).alias("movie_popularity_score"),
        ((typical * overall + mean * count) / (typical + count)).alias("movie_quality_score"))


def movie_features(ratings: DataFrame, movies: DataFrame, as_of: int | None = None,
                   vocabulary: Sequence[str] | None = None) -> DataFrame:
    """Movie aggregates with genres and one 0/1 column per genre.

    ``movies`` must hold each ``movie_idx`` once. Movies without metadata keep
    their row with null genres and all flags 0.
    """
    known = movies.select("movie_idx", "genres")
    joined = movie_aggregates(ratings, as_of).join(known, "movie_idx", "left")
    return genre_one_hot(joined, vocabulary_list(known) if vocabulary is None else vocabulary)


def _genre_counts(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Rows and mean rating per (user, genre); a null genre counts ratings without any.

    Each movie's genres are split once, before the join; they multiply rows only
    between the join and the map-side aggregation. That one meets a user's ratings
    together, in partitions of bounded size, so that it holds few rows; the
    rebalancing spreads a user with very many.
    """
    listed = movies.select("movie_idx", genre_list(F.col("genres")).alias("_genres"))
    together = (ratings.join(listed, "movie_idx", "left").select("user_idx", "rating", "_genres")
                .hint("rebalance", F.col("user_idx")))
    return (together.select("user_idx", "rating", F.explode_outer("_genres").alias("genre"))
            .groupBy("user_idx", "genre")
            .agg(F.count("*").alias("n"), F.avg("rating").alias("avg_rating")))


def genre_affinity(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Count and mean rating per (user, genre); a repeated genre counts again."""
    return _genre_counts(ratings, movies).where(F.col("genre").isNotNull())


def favourite_genre(ratings: DataFrame, movies: DataFrame) -> DataFrame:
    """Each user's most rated genre, ties to the first name; else Unknown, 0, 0."""
    named = F.when(F.col("genre").isNotNull(), F.struct((-F.col("n")).alias("neg"), "genre", "avg_rating"))
    best = _genre_counts(ratings, movies).groupBy("user_idx").agg(F.min(named).alias("best"))
    return best.select(
        "user_idx",
        F.coalesce("best.genre", F.lit("Unknown")).alias("user_favorite_genre"),
        F.coalesce(-F.col("best.neg"), F.lit(0)).alias("user_favorite_genre_count"),
        F.coalesce("best.avg_rating", F.lit(0.0)).alias("user_favorite_genre_avg_rating"))


def user_view_features(ratings: DataFrame, movies: DataFrame, as_of: int | None = None) -> DataFrame:
    """User aggregates completed by the favourite genre."""
    known = _known_at(ratings, as_of)
    return user_features(known).join(favourite_genre(known, movies), "user_idx", "left")


def batch_features(ratings: DataFrame, movies: DataFrame, as_of: int | None = None,
                   vocabulary: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """The three feature tables of the batch job."""
    known = _known_at(ratings, as_of)
    return {
        "user_features": user_features(known),
        "movie_features": movie_features(known, movies, vocabulary=vocabulary),
        "user_movie_features": favourite_genre(known, movies),
    }
