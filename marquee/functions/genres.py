"""Column expressions over pipe-separated genre strings."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: the marker of a movie without genres.
NO_GENRES = "(no genres listed)"


def has_genres(genres: Column) -> Column:
    return genres.isNotNull() & (genres != NO_GENRES)


def genre_list(genres: Column) -> Column:
    """Genres as an array; empty for null or the no-genres marker."""
    return F.when(has_genres(genres), F.split(genres, "[|]")).otherwise(
        F.array().cast("array<string>"))


def genre_flag(listed: Column, genre: str) -> Column:
    """1 if the array of genres holds this one, else 0."""
    return F.array_contains(listed, genre).cast("int")


def genre_map(genres: Column) -> Column:
    """Genres as a map to 1, for vocabularies too wide for one column each."""
    names = F.array_distinct(genre_list(genres))
    return F.map_from_arrays(names, F.transform(names, lambda _: F.lit(1)))
