"""Total orders over whole tables without a single-task window.

Rows are range-partitioned on the order, so one hot key spreads over many
partitions, and only one small row per partition is combined across them.
Range bounds come from sampling and may differ between runs of a plan; each
function therefore writes its placed rows once and works from that table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from marquee.session import durable

# monotonically_increasing_id: partition number above 33 bits of row number.
_ROW_BITS = 33


def _starts(per_part: DataFrame, size: str) -> DataFrame:
    """Sum of all earlier partitions; one row per partition, so one task is enough."""
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return per_part.select("_part", F.coalesce(F.sum(size).over(earlier), F.lit(0)).alias("_start"))


def _ranged(df: DataFrame, order: Sequence[str | Column]) -> DataFrame:
    """Rows in range partitions, written, with their partition and their place in it."""
    placed = durable(
        df.repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("_row", F.monotonically_increasing_id()), "positions")
    return (placed.withColumn("_part", F.shiftright("_row", _ROW_BITS))
            .withColumn("_place", F.col("_row").bitwiseAND((1 << _ROW_BITS) - 1)).drop("_row"))


def _placed(df: DataFrame, order: Sequence[str | Column], name: str) -> DataFrame:
    """The same with each row's place in the total order."""
    placed = _ranged(df, order)
    starts = _starts(placed.groupBy("_part").agg(F.count("*").alias("_size")), "_size")
    return (placed.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + F.col("_place")).drop("_start"))


def carried(df: DataFrame, order: Sequence[str | Column], value: str, name: str) -> DataFrame:
    """Add the last non-null ``value`` at or before each row in the total order.

    What is carried over a partition's edge comes from one row per partition.
    """
    placed = _ranged(df, order)
    so_far = (Window.partitionBy("_part").orderBy("_place")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    known = F.when(F.col(value).isNotNull(), F.col("_place"))
    lasts = placed.groupBy("_part").agg(F.max_by(value, known).alias("_last"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    came = lasts.select("_part", F.last("_last", ignorenulls=True).over(earlier).alias("_came"))
    return (placed.withColumn(name, F.last(value, ignorenulls=True).over(so_far))
            .join(F.broadcast(came), "_part")
            .select(*df.columns, F.coalesce(name, "_came").alias(name)))


def positions(df: DataFrame, order: Sequence[str | Column], name: str = "position") -> DataFrame:
    """Add each row's 0-based place in the total order."""
    return _placed(df, order, name).select(*df.columns, name)


def file_positions(written: DataFrame, name: str = "position") -> DataFrame:
    """Add each row's 0-based place in Parquet files that follow each other by name.

    Rows know their place in their file, so they are neither sorted nor shuffled;
    what comes before a file is worked out from one row per file.
    """
    at = written.select("*", F.col("_metadata.file_path").alias("_part"), F.col("_metadata.row_index").alias("_place"))
    starts = _starts(at.groupBy("_part").agg((F.max("_place") + 1).alias("_size")), "_size")
    return (at.join(F.broadcast(starts), "_part")
            .select(*written.columns, (F.col("_start") + F.col("_place")).alias(name)))


def cumulative(df: DataFrame, order: Sequence[str], value: str, name: str = "running") -> DataFrame:
    """Add the running sum of ``value`` in the order, the row itself included.

    ``order`` must be unique per row. Meant for pre-aggregated tables.
    """
    placed = durable(
        df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "cumulative")
    starts = _starts(placed.groupBy("_part").agg(F.sum(value).alias("_size")), "_size")
    so_far = (Window.partitionBy("_part").orderBy(*order)
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    return (placed.withColumn(name, F.sum(value).over(so_far))
            .join(F.broadcast(starts), "_part")
            .select(*df.columns, (F.col(name) + F.col("_start")).alias(name)))


def _run_starts(placed: DataFrame, keys: Sequence[str], name: str, position: str) -> DataFrame:
    """Add ``name``, the position at which the run of rows with equal ``keys`` begins.

    ``placed`` comes from ``_placed``. A run begins inside its partition or was
    carried into it; what is carried is worked out from one row per partition, so
    no key is joined on and a hot one stays spread. Null keys are a run too.
    """
    key = F.struct(*[F.col(k) for k in keys])
    within = Window.partitionBy("_part").orderBy("_place")
    opens = ~key.eqNullSafe(F.lag(key).over(within))
    so_far = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    began = (placed.withColumn("_opens", F.when(opens | (F.col("_place") == 0), F.col(position)))
             .withColumn("_began", F.max("_opens").over(so_far)))
    edge = placed.groupBy("_part").agg(
        F.min_by(key, "_place").alias("_first_key"), F.max_by(key, "_place").alias("_last_key"),
        F.min(position).alias("_from"))
    last = began.groupBy("_part").agg(F.max("_began").alias("_last_began"))
    by_part = Window.orderBy("_part")
    carried = F.col("_first_key").eqNullSafe(F.lag("_last_key").over(by_part)) & (F.lag("_part").over(by_part).isNotNull())
    # A partition that only carries on an earlier run passes that run's start along.
    parts = (edge.join(last, "_part").withColumn("_carried", carried)
             .withColumn("_hands_on", F.when(F.col("_carried") & (F.col("_last_began") == F.col("_from")), None)
                         .otherwise(F.col("_last_began")))
             .withColumn("_came", F.last("_hands_on", ignorenulls=True).over(
                 by_part.rowsBetween(Window.unboundedPreceding, -1)))
             .select("_part", "_from", F.when(F.col("_carried"), F.col("_came")).alias("_came")))
    return (began.join(F.broadcast(parts), "_part")
            .withColumn(name, F.when(F.col("_began") == F.col("_from"), F.coalesce("_came", "_began"))
                        .otherwise(F.col("_began"))))


def numbered(df: DataFrame, keys: Sequence[str], order: Sequence[str],
             name: str = "row_number") -> DataFrame:
    """1-based row number per key; a hot key's rows stay spread over partitions.

    Rows whose key is null are numbered as one group.
    """
    placed = _placed(df, [*keys, *order], "_position")
    return (_run_starts(placed, keys, "_first", "_position")
            .select(*df.columns, (F.col("_position") - F.col("_first") + 1).alias(name)))


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str,
                    probabilities: dict[str, float]) -> DataFrame:
    """Linearly interpolated quantiles of ``value`` per key, nulls left out.

    Equal values are counted first and get the range of places they hold in the
    total order. The places that are asked for, a few per key, are put among
    them and take the value carried up to there, so no key is joined on and no
    task holds a whole group.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ranked = durable(cumulative(counts, [*keys, value], "_n", "_upto")
                     .withColumn("_at", F.col("_upto") - F.col("_n")), "ranked")
    groups = ranked.groupBy(*keys).agg(F.min("_at").alias("_base"), F.sum("_n").alias("_total"))
    asked = []
    for name, p in probabilities.items():
        place = (F.col("_total") - 1) * F.lit(p)
        for end, at in (("lo", F.floor(place)), ("hi", F.ceil(place))):
            asked.append(F.struct(F.lit(f"{end}_{name}").alias("_which"), (F.col("_base") + at).alias("_at"),
                                  (place - F.floor(place)).alias("_w")))
    places = groups.select(*keys, F.inline(F.array(*asked))).withColumn("_side", F.lit(1))
    values = ranked.select("_at", F.lit(0).alias("_side"), F.col(value).alias("_value"))
    met = carried(values.unionByName(places, allowMissingColumns=True), ["_at", "_side"], "_value", "_got")

    def picked(column: str, which: str) -> Column:
        return F.max(F.when(F.col("_which") == which, F.col(column)))

    found = met.where(F.col("_side") == 1).groupBy(*keys).agg(
        *[picked("_got", f"{end}_{n}").alias(f"_{end}_{n}") for n in probabilities for end in ("lo", "hi")],
        *[picked("_w", f"lo_{n}").alias(f"_w_{n}") for n in probabilities])
    return found.select(*keys, *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
        for n in probabilities])


def top_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
           rank: str = "rank") -> DataFrame:
    """The first ``n`` rows per key.

    Spark cuts each partition to ``n`` rows per key before the shuffle, so a
    hot key sends at most ``n`` rows per task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(window)).where(F.col(rank) <= n)
