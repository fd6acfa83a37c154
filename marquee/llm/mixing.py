"""Mixing sources to target weights by Pfair scheduling, in DataFrames only.

Documents of each source are cut into blocks, and one block is scheduled per
slot. With whole weights that add up to Q, block k of a source of weight w is
released at slot floor(k Q / w) and due before slot ceil((k + 1) Q / w). Of the
released blocks the one with the earliest deadline goes first, so after every
slot each source is less than one block away from its share. When a source runs
out, a new schedule begins among those that are left.

Weights are taken as they are given: whole numbers of any size in their exact
ratios, so that the deviation holds against the given weights. Which block comes
next depends on all that came before, so slots are worked out one after the
other, ``STEP`` of them a job, from a state of one entry per source that is
written with the slots. What grows with the documents is a table of blocks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction
from math import gcd, lcm

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marquee.llm.common import free_name
from marquee.operators.ordering import positions
from marquee.session import durable, scratch_path

BLOCK_DOCS = 32
# Slots that a job works out, and how many of them are gathered at a time.
STEP, GATHERED = 32_768, 256
# Weights must add up to less than this, so that products with block numbers fit 38 digits.
MOST_PARTS = 10 ** 28
# Sizes to this power are the weights of tempered mixing.
TEMPER = 0.5

WHOLE = "decimal(38,0)"
SLOT = "struct<number:int,block:long,slot:long,release:long,deadline:long>"
# Per source: its number and weight, blocks left and taken, those taken in this phase, and the window of the next.
OWN = "struct<number:int,weight:decimal(38,0),left:long,block:long,k:long,release:long,deadline:long>"


def tempered_weights(docs: DataFrame, source: str = "source", power: float = TEMPER) -> dict[str | None, float]:
    """A weight per source: its number of documents to ``power``. One row per source is collected."""
    return {r[0]: float(r[1]) ** power for r in docs.groupBy(source).count().collect()}


def whole_weights(weights: Mapping[str | None, float]) -> dict[str | None, int]:
    """The weights above zero as whole numbers in the same ratios; a float is the decimal it is written as."""
    exact = {s: Fraction(str(w)) for s, w in weights.items() if w > 0}
    parts = lcm(*(w.denominator for w in exact.values()))
    whole = {s: int(w * parts) for s, w in exact.items()}
    common = gcd(*whole.values()) or 1
    if sum(whole.values()) // common >= MOST_PARTS:
        raise ValueError("the weights have no common measure of 28 digits: give fewer digits or whole numbers")
    return {s: w // common for s, w in whole.items()}


def release(k: Column, weight: Column, total: Column) -> Column:
    return F.call_function("div", k.cast(WHOLE) * total, weight)


def deadline(k: Column, weight: Column, total: Column) -> Column:
    return F.call_function("div", (k + 1).cast(WHOLE) * total + (weight - 1), weight)


def _once(value: Column, use) -> Column:
    """``use`` of a value that is worked out once."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _next(state: Column) -> Column:
    """One slot more: the earliest deadline among the released blocks; nothing changes once no block is left."""
    now = state["now"] - state["start"]
    ready = F.filter(state["own"], lambda s: (s["left"] > 0) & (s["release"] <= now))
    first = F.array_min(F.transform(ready, lambda s: F.struct(s["deadline"], s["number"])))["number"]

    def taken(number: Column) -> Column:
        mine = F.element_at(state["own"], number + 1)
        runs_out = mine["left"] == 1
        rest = (state["total"] - mine["weight"]).cast(WHOLE)

        def entry(s: Column, took: int, k: Column, total: Column) -> Column:
            return F.struct(s["number"], s["weight"], (s["left"] - took).alias("left"), (s["block"] + took).alias("block"),
                            k.alias("k"), release(k, s["weight"], total).alias("release"),
                            deadline(k, s["weight"], total).alias("deadline"))

        def after(s: Column) -> Column:
            it, zero = s["number"] == number, F.lit(0).cast("long")
            return (F.when(it & runs_out, entry(s, 1, zero, rest)).when(it, entry(s, 1, s["k"] + 1, state["total"]))
                    .when(runs_out, entry(s, 0, zero, rest)).otherwise(s))

        slot = F.struct(number.alias("number"), mine["block"].alias("block"), state["now"].alias("slot"),
                        (state["start"] + mine["release"]).alias("release"),
                        (state["start"] + mine["deadline"]).alias("deadline"))
        return F.struct((state["now"] + 1).alias("now"),
                        F.when(runs_out, state["now"] + 1).otherwise(state["start"]).alias("start"),
                        F.when(runs_out, rest).otherwise(state["total"]).alias("total"),
                        F.transform(state["own"], after).alias("own"),
                        F.concat(state["order"], F.array(slot)).alias("order"))

    return _once(first, lambda number: F.when(number.isNull(), state).otherwise(taken(number)))


def _with_order(state: Column, order: Column) -> Column:
    return F.struct(*[state[c].alias(c) for c in ("now", "start", "total", "own")], order.alias("order"))


def slots(spark: SparkSession, sources: Sequence[tuple[int, int]], start: int = 0) -> DataFrame:
    """``number, block, slot, release, deadline`` of all blocks of sources given as (whole weight, blocks).

    Slots count from ``start``. Ties of deadlines go to the source named first.
    A job of ``STEP`` slots reads the state that the one before it wrote, and
    only whether a block is left reaches the driver.
    """
    total = sum(w for w, n in sources if n)
    own = [(i, w, n, 0, 0, 0, -(-total // w)) for i, (w, n) in enumerate(sources)]
    none = F.array().cast(f"array<{SLOT}>")
    state = spark.createDataFrame(
        [((start, start, str(total), [(i, str(w), *rest) for i, w, *rest in own]),)],
        f"state struct<now:long,start:long,total:string,own:array<{OWN.replace(WHOLE, 'string')}>>").select(
        F.col("state").cast(f"struct<now:long,start:long,total:{WHOLE},own:array<{OWN}>>"))

    def some(state: Column, _: Column) -> Column:
        inner = F.aggregate(F.sequence(F.lit(1), F.lit(GATHERED)), _with_order(state, none), lambda s, _: _next(s))
        return _once(inner, lambda made: _with_order(made, F.concat(state["order"], made["order"])))

    folder, left = scratch_path(spark, "slots"), sum(n for _, n in sources)
    for step in range(max(1, -(-left // STEP))):
        rounds = F.sequence(F.lit(1), F.lit(-(-min(left, STEP) // GATHERED) or 1))
        made = state.select(F.aggregate(rounds, _with_order(F.col("state"), none), some).alias("state"))
        made.write.parquet(f"{folder}/step={step}")
        state = spark.read.schema(made.schema).parquet(f"{folder}/step={step}")
        left -= STEP
    return spark.read.schema(made.schema).parquet(folder + "/*").select(F.inline("state.order"))


def plan(spark: SparkSession, blocks: Sequence[tuple[str | None, int]], weights: Mapping[str | None, float]) -> DataFrame:
    """``slots`` of the sources in ``blocks``; sources without a weight come last, and alike."""
    whole = whole_weights(weights)
    made, start = None, 0
    for weighted in (True, False):
        # A source that this turn is not about has no block in it.
        own = [(whole.get(s, 1), n if (s in whole) == weighted else 0) for s, n in blocks]
        if made is None or any(n for _, n in own):
            part = slots(spark, own, start)
            made, start = part if made is None else made.unionByName(part), start + sum(n for _, n in own)
    return made


def schedule(docs: DataFrame, weights: Mapping[str | None, float], doc_id: str = "doc_id", source: str = "source",
             block_docs: int = BLOCK_DOCS, names: tuple[str, ...] = ("block", "offset", "slot", "release", "deadline"),
             ) -> DataFrame:
    """``docs`` with their block in their source, the place in it, and the block's slot, release and deadline.

    Each source is read by id (null ids first; rows that share one stay next to
    each other). Every row is scheduled once, whatever the weights: while all
    sources last, their shares are the weights, and when one runs out the others
    share its part. A null source is a source like any other. Sources without a
    weight, or with none above zero, come after all others. A block has
    ``block_docs`` rows but for the last of each source. ``names`` are the new
    columns, which must be free in ``docs``. An empty table gives an empty result.

    Only the number of rows per source reaches the driver. Rows are numbered over
    range partitions, so a source that holds most of them is spread as well, and
    meet the table of blocks by source and block, of which each has ``block_docs``
    rows at most.
    """
    spark = docs.sparkSession
    # Their own columns travel as one, so that no name can clash.
    packed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("whole"),
                         F.col(source).cast("string").alias("key"), F.col(doc_id).alias("id"))
    placed = positions(packed, ["key", "id"], "place")
    sizes = durable(placed.groupBy("key").agg(F.count("*").alias("n"), F.min("place").alias("first")), "sources")
    blocks = sorted(((r["key"], -(-r["n"] // block_docs)) for r in sizes.collect()), key=lambda b: (b[0] is not None, b[0]))
    numbers = spark.createDataFrame([(s, i) for i, (s, _) in enumerate(blocks)], "source string, number int")
    # One row per source.
    known = F.broadcast(sizes.join(numbers, F.col("key").eqNullSafe(F.col("source"))).select("source", "first", "number"))
    met = placed.join(known, F.col("key").eqNullSafe(F.col("source")))
    at = F.col("place") - F.col("first")
    met = met.select("whole", "number", F.floor(at / block_docs).cast("long").alias("block"),
                     (at % block_docs).alias("offset"))
    made = met.join(plan(spark, blocks, weights), ["number", "block"])
    return made.select("whole.*", *[F.col(c).alias(n) for c, n in zip(
        ("block", "offset", "slot", "release", "deadline"), names)])


def in_order(docs: DataFrame, weights: Mapping[str | None, float], doc_id: str = "doc_id", source: str = "source",
             block_docs: int = BLOCK_DOCS) -> DataFrame:
    """``docs`` with its own columns, in the order of the schedule, ready to be written so."""
    names = tuple(free_name(docs, n) for n in ("_block", "_offset", "_slot", "_release", "_deadline"))
    placed = schedule(docs, weights, doc_id, source, block_docs, names)
    order = [names[2], names[1]]
    return placed.repartitionByRange(*order).sortWithinPartitions(*order).select(docs.columns)
