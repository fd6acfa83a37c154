"""Point-in-time join: the latest feature row at or before each entity row."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from marquee.functions.scalars import within
from marquee.operators.ordering import carried


def asof_join(entities: DataFrame, features: DataFrame, keys: Sequence[str], entity_time: str,
              feature_time: str, values: Sequence[str], ttl: timedelta | None = None,
              keep_time: str | None = None) -> DataFrame:
    """Every entity row with the ``values`` known at its time, null past ``ttl``.

    Entity and feature rows meet in one total order of key, time and side, in
    range partitions, and the last feature row is carried forward, over a
    partition's edge too. So a key with most of the rows is spread like any
    other. All values of a feature row travel as one struct, so rows never mix.
    Of feature rows at one instant the greatest values win. Rows without a key or
    a time match nothing.
    """
    keys = list(keys)
    known = features.dropna(subset=[*keys, feature_time]).select(
        *keys, F.col(feature_time).alias("_ts"), F.lit(0).alias("_side"),
        F.struct(F.struct(*[F.col(v) for v in values]).alias("values"), F.col(feature_time).alias("known"),
                 *[F.col(k).alias(f"key_{n}") for n, k in enumerate(keys)]).alias("_feature"))
    payload = F.struct(*[F.col(c) for c in entities.columns])
    asked = entities.select(
        *keys, F.col(entity_time).alias("_ts"), F.lit(1).alias("_side"), payload.alias("_entity"),
        # So many rows of one key and instant still fall into several partitions.
        F.xxhash64(payload).alias("_spread"))
    both = asked.unionByName(known, allowMissingColumns=True)
    met = carried(both, [*keys, "_ts", "_side", "_feature", "_spread"], "_feature", "_found").where(F.col("_side") == 1)

    found, at = F.col("_found"), F.col("_ts")
    fresh = found.isNotNull() & at.isNotNull() & reduce(
        Column.__and__, [F.col(k) == F.col(f"_found.key_{n}") for n, k in enumerate(keys)])
    if ttl is not None:
        fresh = fresh & within(at, F.col("_found.known"), ttl)
    picked = [F.when(fresh, F.col(f"_found.values.{v}")).alias(v) for v in values]
    if keep_time:
        picked.append(F.when(fresh, F.col("_found.known")).alias(keep_time))
    return met.select("_entity.*", *picked)
