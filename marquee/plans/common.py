"""Shared pieces of the registered queries and of the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that summation order does not show."""
    return df.select(*[
        F.round(f.name, digits).alias(f.name) if f.dataType.typeName() == "double" else F.col(f.name)
        for f in df.schema])


def as_doubles(df: DataFrame, *columns: str) -> DataFrame:
    """Counts that may be null, in a type that keeps nulls in every client."""
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def time_text(ts: str | Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd HH:mm:ss")


def time_texts(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: time_text(c) for c in columns})


# The proxy tables again, for the checking SQL.
RATINGS = """ratings AS (
  SELECT o_custkey AS user_idx, l_partkey AS movie_idx,
         CAST(floor((l_quantity - 1) / 5) * 0.5 + 0.5 AS DOUBLE) AS rating,
         CAST(epoch(o_orderdate) AS BIGINT) AS "timestamp"
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

MOVIES = """movies AS (
  SELECT p_partkey AS movie_idx, p_partkey AS "movieId", p_name AS title,
         CASE WHEN p_size % 17 = 0 THEN '(no genres listed)'
              ELSE lower(p_type) || '|' || replace(p_name, ' ', '|') END AS genres
  FROM part)"""

EVENTS = """ev AS (
  SELECT event_id, user_id AS user_idx,
         CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS BIGINT) AS movie_idx,
         event_type, ts, "value"
  FROM events)"""

LOG = """log AS (
  SELECT event_id AS request_id, ts, event_type AS endpoint,
         CASE WHEN event_type = 'error' THEN 500 ELSE 200 END AS status,
         "value" / 1000 AS latency_s, user_id AS user_idx
  FROM events)"""

# Every vector is a user and an item here; ratings between known vectors link them.
FACTORS = """vecs AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
known AS (SELECT r.* FROM ratings r
  WHERE r.user_idx IN (SELECT vec_id FROM vecs) AND r.movie_idx IN (SELECT vec_id FROM vecs)),
scores AS (SELECT u.vec_id AS user_idx, i.vec_id AS movie_idx,
                  round(list_inner_product(u.v, i.v), 9) AS score
           FROM vecs u CROSS JOIN vecs i)"""

# The genres of the movies proxy.
GENRES = ["anvil", "blue", "bolt", "cold", "economy", "gear", "gizmo", "hot", "large", "medium",
          "new", "old", "plate", "promo", "red", "ring", "rod", "small", "standard", "widget"]


def sql(select: str, *tables: str) -> str:
    return (f"WITH {', '.join(tables)} " if tables else "") + select
