"""Cleaning: minimum interactions, dense ids, metadata restricted to what remains."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from marquee.operators.ordering import positions
from marquee.session import durable


def _frequent(ratings: DataFrame, key: str, least: int) -> DataFrame:
    return ratings.groupBy(key).agg(F.count("*").alias("n")).where(F.col("n") >= least).select(key)


def filter_min_interactions(ratings: DataFrame, min_user: int = 5, min_item: int = 5,
                            user: str = "userId", item: str = "movieId",
                            iterate: bool = False) -> DataFrame:
    """Keep active users, then items still popular among their ratings.

    One pass by default, so a kept user may end below the minimum; ``iterate``
    repeats until both minimums hold.
    """
    def one_pass(rows: DataFrame) -> DataFrame:
        active = rows.join(_frequent(rows, user, min_user), user, "left_semi")
        return active.join(_frequent(active, item, min_item), item, "left_semi").select(rows.columns)

    if not iterate:
        return one_pass(ratings)
    rows = durable(ratings, "core")
    size = rows.count()
    while True:
        rows = durable(one_pass(rows), "core")
        left = rows.count()
        if left == size:
            return rows
        size = left


def dense_ids(df: DataFrame, key: str, index: str, first_seen: str | None = None) -> DataFrame:
    """Map each distinct key to 0..n-1, by key or by its earliest ``first_seen``; null has no index."""
    df = df.where(F.col(key).isNotNull())
    if first_seen is None:
        return positions(df.select(key).distinct(), [key], index)
    met = df.groupBy(key).agg(F.min(first_seen).alias("_first"))
    return positions(met, ["_first", key], index).select(key, index)


def id_map(mapping: DataFrame, key: str, index: str) -> DataFrame:
    """The stored form of an id map."""
    return mapping.select(F.col(key).alias(f"original_{key}"), index)


def apply_id_maps(ratings: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Attach both indexes, after the original columns."""
    return (ratings.join(users, "userId").join(items, "movieId")
            .select(*ratings.columns, "user_idx", "movie_idx"))


def rated_movies(movies: DataFrame, ratings: DataFrame, key: str = "movieId") -> DataFrame:
    return movies.join(ratings.select(key).distinct(), key, "left_semi").select(movies.columns)


def clean_movies(movies: DataFrame, items: DataFrame) -> DataFrame:
    """Metadata of the items that kept an index, with that index."""
    return movies.join(items, "movieId").select(*movies.columns, "movie_idx")


def validated_form(ratings: DataFrame) -> DataFrame:
    """The four columns, in the order the ratings checks expect."""
    return ratings.select("user_idx", "movie_idx", "rating", "timestamp")
