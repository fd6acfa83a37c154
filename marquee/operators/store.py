"""Feature views, their latest values per entity, and lookups over them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from marquee.functions.scalars import micros
from marquee.operators.asof import asof_join
from marquee.sources.files import read_parquet


@dataclass(frozen=True)
class FeatureView:
    """Named features of one entity, how they are typed and how long they hold."""

    name: str
    keys: tuple[str, ...]
    features: Mapping[str, str]
    ttl: timedelta
    source: str
    timestamp: str = "event_timestamp"
    online: bool = True
    tags: Mapping[str, str] = field(default_factory=dict)

    def refs(self) -> list[str]:
        return [f"{self.name}:{f}" for f in self.features]


# View names, feature names, types and lifetimes that callers refer to.
USER_BATCH = FeatureView(
    "user_batch_features", ("user_idx",),
    {"user_avg_rating": "float", "user_rating_std": "float", "user_rating_count": "long",
     "user_min_rating": "float", "user_max_rating": "float", "user_rating_range": "float",
     "user_days_active": "float", "user_favorite_genre": "string",
     "user_favorite_genre_count": "long", "user_favorite_genre_avg_rating": "float"},
    timedelta(days=365), "user_features.parquet", tags={"type": "batch", "entity": "user"})
MOVIE_BATCH = FeatureView(
    "movie_batch_features", ("movie_idx",),
    {"movie_avg_rating": "float", "movie_rating_std": "float", "movie_rating_count": "long",
     "movie_min_rating": "float", "movie_max_rating": "float", "movie_rating_range": "float",
     "movie_popularity_score": "float", "movie_quality_score": "float"},
    timedelta(days=365), "movie_features.parquet", tags={"type": "batch", "entity": "movie"})
USER_STREAM = FeatureView(
    "user_stream_features", ("user_idx",),
    {"user_recent_activity": "long", "user_last_genre": "string"},
    timedelta(hours=24), "user_stream_features.parquet", tags={"type": "stream", "entity": "user"})
MOVIE_STREAM = FeatureView(
    "movie_stream_features", ("movie_idx",),
    {"movie_popularity": "long", "movie_recent_views": "long"},
    timedelta(hours=24), "movie_stream_features.parquet", tags={"type": "stream", "entity": "movie"})
VIEWS = {v.name: v for v in (USER_BATCH, MOVIE_BATCH, USER_STREAM, MOVIE_STREAM)}

# What serving asks for per user and per movie.
USER_BUNDLE = [
    "user_batch_features:user_avg_rating", "user_batch_features:user_rating_count",
    "user_batch_features:user_favorite_genre",
    "user_stream_features:user_recent_activity", "user_stream_features:user_last_genre"]
MOVIE_BUNDLE = [
    "movie_batch_features:movie_avg_rating", "movie_batch_features:movie_rating_count",
    "movie_batch_features:movie_popularity_score",
    "movie_stream_features:movie_popularity", "movie_stream_features:movie_recent_views"]
STREAM_DEFAULTS = {"user_recent_activity": 0, "user_last_genre": "Unknown",
                   "movie_popularity": 0, "movie_recent_views": 0}


def as_view(view: FeatureView, df: DataFrame) -> DataFrame:
    """Keys, declared features at their declared types, and the event time."""
    needed = [*view.keys, *view.features, view.timestamp]
    lacking = [c for c in needed if c not in df.columns]
    if lacking:
        raise ValueError(f"{view.name} lacks columns {lacking}")
    return df.select(
        *[F.col(k).cast("long").alias(k) for k in view.keys],
        *[F.col(f).cast(kind).alias(f) for f, kind in view.features.items()],
        F.col(view.timestamp).cast("timestamp").alias(view.timestamp))


def read_view(spark: SparkSession, view: FeatureView, folder: str) -> DataFrame:
    return as_view(view, read_parquet(spark, f"{folder}/{view.source}"))


def latest_per_key(rows: DataFrame, keys: Sequence[str], timestamp: str) -> DataFrame:
    """The newest row per key; of rows at one instant the greatest values.

    A struct maximum is combined map-side, so a hot key sends one row per task.
    """
    values = [c for c in rows.columns if c not in keys and c != timestamp]
    best = rows.groupBy(*keys).agg(F.max(F.struct(timestamp, *values)).alias("_best"))
    return best.select(*keys, "_best.*").select(rows.columns)


def materialize(view: FeatureView, rows: DataFrame, end: datetime,
                start: datetime | None = None) -> DataFrame:
    """Latest row per entity within [start, end]; by default one lifetime back."""
    start = end - view.ttl if start is None else start
    inside = F.col(view.timestamp).between(F.lit(start), F.lit(end))
    return latest_per_key(as_view(view, rows).where(inside), view.keys, view.timestamp)


def materialize_views(tables: Mapping[str, DataFrame], end: datetime, start: datetime | None = None,
                      names: Sequence[str] | None = None) -> dict[str, DataFrame]:
    """Materialise the named views, or all given ones."""
    return {n: materialize(VIEWS[n], tables[n], end, start) for n in (names or tables)}


def expire(view: FeatureView, latest: DataFrame, now: datetime) -> DataFrame:
    """Blank the features of rows older than the view's lifetime."""
    age = F.unix_micros(F.lit(now).cast("timestamp")) - F.unix_micros(view.timestamp)
    return latest.select(*view.keys, *[
        F.when(age <= micros(view.ttl), F.col(f)).alias(f) for f in view.features], view.timestamp)


def push(view: FeatureView, latest: DataFrame, rows: DataFrame) -> DataFrame:
    """The online table after new rows arrived; an older row never wins."""
    return latest_per_key(as_view(view, latest).unionByName(as_view(view, rows)), view.keys, view.timestamp)


def _by_view(refs: Sequence[str]) -> dict[str, list[str]]:
    grouped: dict[str, list[str]] = {}
    for ref in refs:
        name, _, feature = ref.partition(":")
        if name not in VIEWS or feature not in VIEWS[name].features:
            raise ValueError(f"unknown feature {ref}")
        grouped.setdefault(name, []).append(feature)
    return grouped


def default_refs(columns: Sequence[str], names: Sequence[str]) -> list[str]:
    """All features of the given views whose entity the rows carry."""
    return [r for n in names if set(VIEWS[n].keys) <= set(columns) for r in VIEWS[n].refs()]


def online_features(entities: DataFrame, latest: Mapping[str, DataFrame],
                    refs: Sequence[str] | None = None,
                    defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Entity rows with features from the online tables; unknown entities get nulls."""
    refs = default_refs(entities.columns, list(latest)) if refs is None else refs
    out = entities
    for name, features in _by_view(refs).items():
        keys = list(VIEWS[name].keys)
        out = out.join(latest[name].select(*keys, *features), keys, "left")
    return out.fillna(dict(defaults)) if defaults else out


def online_lookup(spark: SparkSession, latest: Mapping[str, DataFrame],
                  user_ids: Sequence[int] | None = None, movie_ids: Sequence[int] | None = None,
                  refs: Sequence[str] | None = None,
                  defaults: Mapping[str, object] | None = None) -> DataFrame:
    """Look up listed ids; users win if both are given."""
    key, ids = ("user_idx", user_ids) if user_ids else ("movie_idx", movie_ids or [])
    entities = spark.createDataFrame([(i,) for i in ids], f"{key} long")
    return online_features(entities, latest, refs, defaults)


def user_bundle(users: DataFrame, latest: Mapping[str, DataFrame]) -> DataFrame:
    """What serving needs per user; stream counters default to 0 and Unknown."""
    return online_features(users, latest, USER_BUNDLE, {
        k: STREAM_DEFAULTS[k] for k in ("user_recent_activity", "user_last_genre")})


def movie_bundle(movies: DataFrame, latest: Mapping[str, DataFrame]) -> DataFrame:
    return online_features(movies, latest, MOVIE_BUNDLE, {
        k: STREAM_DEFAULTS[k] for k in ("movie_popularity", "movie_recent_views")})


def historical_features(entities: DataFrame, tables: Mapping[str, DataFrame],
                        refs: Sequence[str] | None = None, time: str = "event_timestamp",
                        **asof) -> DataFrame:
    """Entity rows with each view's features as they were known at the row's time."""
    refs = default_refs(entities.columns, list(tables)) if refs is None else refs
    out = entities
    for name, features in _by_view(refs).items():
        view = VIEWS[name]
        out = asof_join(out, as_view(view, tables[name]), view.keys, time, view.timestamp,
                        features, ttl=view.ttl, **asof)
    return out


def view_stats(view: FeatureView, rows: DataFrame, now: datetime) -> DataFrame:
    """One row per feature: view size, entities, nulls, newest time, share past lifetime."""
    moment = F.lit(now).cast("timestamp")
    age = F.unix_micros(moment) - F.unix_micros(view.timestamp)
    # Rolling rows up per entity first keeps the distinct count a plain count.
    per_key = rows.groupBy(*view.keys).agg(
        F.count("*").alias("_rows"), F.max(view.timestamp).alias("_newest"),
        F.count_if(age > micros(view.ttl)).alias("_stale"),
        *[F.count_if(F.col(f).isNull()).alias(f) for f in view.features])
    total = per_key.agg(
        F.sum("_rows").alias("n_rows"), F.count("*").alias("n_entities"),
        F.max("_newest").alias("newest"), F.sum("_stale").alias("_stale"),
        *[F.sum(f).alias(f) for f in view.features])
    share = [F.struct(F.lit(f).alias("feature"), (F.col(f) / F.col("n_rows")).alias("null_share"))
             for f in view.features]
    return total.select(
        F.lit(view.name).alias("view"), "n_rows", "n_entities", "newest",
        (F.col("_stale") / F.col("n_rows")).alias("stale_share"), F.inline(F.array(*share)))


def freshness(tables: Mapping[str, DataFrame], now: datetime) -> DataFrame:
    """Seconds since the newest row, per view."""
    moment = F.lit(now).cast("timestamp")
    parts = []
    for name, rows in tables.items():
        newest = F.max(VIEWS[name].timestamp)
        parts.append(rows.agg(
            F.lit(name).alias("view"), newest.alias("newest"),
            ((F.unix_micros(moment) - F.unix_micros(newest)) / 1_000_000).alias("age_s")))
    return reduce(DataFrame.unionByName, parts)
