"""Mixing sources to target weights by capped water-filling.

Every source gets a target in words in proportion to its weight.  A target is
clamped at ``max_epochs`` times the source's size and the excess is dealt out
again by weight to the sources below their cap, until none is above: the
targets are ``min(cap, weight * level)`` for the one level at which they add up
to the budget, found by a single running sum over the sources.

A source's target is taken as whole repetitions of all its documents and one
fractional repetition: its documents in a seeded hash order until the rest of
the target is used up, the last of them in part (its first words).
"""

from __future__ import annotations

from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Slices of the seeded order of a source; only one of them is ordered row by row.
SLICES = 4096


def cycle_weights(sources: DataFrame, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """Adds ``weight``: the cycle of weights over the sources by code point, null last.

    One row per source; the rank needs the distinct names in order only.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    return sources.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int")))


def water_fill(sources: DataFrame, share: float, max_epochs: float) -> DataFrame:
    """``target`` per row of (source, source_size, weight); the input has one row per source.

    Sources are put in the order in which they reach their cap as the level
    rises.  With the first i of them clamped, the others share what is left;
    a source is clamped if the level that its share implies is above its own.
    The total of all targets is ``share`` times all sizes (no more than
    ``max_epochs`` of them).  A source of size 0 has target 0.
    """
    cap = F.col("source_size") * F.lit(float(max_epochs))
    at = cap / F.col("weight")
    filled = Window.orderBy("__at", F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy(F.lit(1))
    budget = F.least(F.lit(float(share)), F.lit(float(max_epochs))) * F.sum("source_size").over(every)
    ranked = (sources.withColumn("__at", at)
              .withColumn("__left", budget - F.coalesce(F.sum(cap).over(filled), F.lit(0.0)))
              .withColumn("__weight", F.sum("weight").over(every)
                          - F.coalesce(F.sum("weight").over(filled), F.lit(0.0))))
    # The first source below its cap fixes the level; when all are clamped there is none.
    ranked = ranked.withColumn("__level", F.when(F.col("__left") < F.col("__at") * F.col("__weight"),
                                                 F.col("__left") / F.col("__weight")))
    level = F.first("__level", ignorenulls=True).over(
        filled.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return ranked.withColumn("target", F.when(level.isNull(), cap)
                             .otherwise(F.least(cap, F.col("weight") * level))
                             ).drop("__at", "__left", "__weight", "__level")


def exact_targets(sizes: dict, weights: dict, share: Fraction, max_epochs: int) -> dict:
    """The same targets by clamping round after round, for tests on few sources."""
    left, open_, out = share * sum(sizes.values()), set(sizes), {}
    while open_:
        level = left / sum(weights[s] for s in open_)
        over = {s for s in open_ if weights[s] * level > max_epochs * sizes[s]}
        if not over:
            return out | {s: weights[s] * level for s in open_}
        for s in over:
            out[s] = Fraction(max_epochs * sizes[s])
            left -= out[s]
        open_ -= over
    return out


def mix(docs: DataFrame, size: Column, *, source: str = "source", key: str = "doc_id", seed: int = 7,
        share: float = 1.5, max_epochs: int = 2, weights: tuple[int, ...] = (3, 1, 2)) -> DataFrame:
    """One row per document: key, source, size, source_size, target, copies, tail, taken.

    ``copies`` whole repetitions and the first ``tail`` words of another are
    taken, ``taken`` words together, never above ``max_epochs`` times the size.
    A source's taken words add up to its target, rounded to a word.  Null and
    repeated keys are ordinary rows; a null source is a source of its own; a
    document without words takes nothing.  Same rows, same result, in any
    order of the input; an empty table gives an empty table.

    No source is brought together: sizes are summed before the shuffle, the
    seeded order is cut into slices, and only the one slice of a source in
    which its target ends is ordered row by row.
    """
    order = F.xxhash64(F.lit(seed), F.col(key))
    sized = docs.select(F.col(key).alias("doc_id"), F.col(source).cast("string").alias("source"),
                        size.alias("size"), order.alias("__order"),
                        F.shiftrightunsigned(order, 64 - 12).cast("int").alias("__slice"))
    slices = sized.groupBy("source", "__slice").agg(F.sum("size").alias("__in"))
    sources = slices.groupBy("source").agg(F.sum("__in").alias("source_size"))
    targets = water_fill(cycle_weights(sources, weights), share, max_epochs)
    goal = F.round("target").cast("bigint")
    some = F.greatest(F.col("source_size"), F.lit(1))
    targets = (targets.withColumn("copies", F.floor(goal / some).cast("bigint"))
               .withColumn("__rest", goal - F.col("copies") * F.col("source_size")).drop("weight"))
    before = Window.partitionBy("source").orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.withColumn("__before", F.coalesce(F.sum("__in").over(before), F.lit(0)))
    slices = (slices.join(targets.withColumnRenamed("source", "__s"), F.col("source").eqNullSafe(F.col("__s")))
              .drop("__s").withColumnsRenamed({"source": "__s", "__slice": "__t"}))
    placed = (sized.join(slices, F.col("source").eqNullSafe(F.col("__s")) & (F.col("__slice") == F.col("__t")))
              .drop("__s", "__t"))
    ends_here = (F.col("__before") < F.col("__rest")) & (F.col("__rest") < F.col("__before") + F.col("__in"))
    within = (Window.partitionBy("source", "__slice").orderBy("__order", "doc_id", "size")
              .rowsBetween(Window.unboundedPreceding, -1))
    cut = placed.filter(ends_here).withColumn(
        "__left", F.col("__rest") - F.col("__before") - F.coalesce(F.sum("size").over(within), F.lit(0)))
    cut = cut.withColumn("tail", F.greatest(F.lit(0), F.least("size", "__left"))).drop("__left")
    clear = placed.filter(~ends_here).withColumn(
        "tail", F.when(F.col("__rest") > F.col("__before"), F.col("size")).otherwise(F.lit(0)))
    return clear.unionByName(cut).select(
        "doc_id", "source", "size", "source_size", "target", "copies", F.col("tail").cast("bigint").alias("tail"),
        (F.col("copies") * F.col("size") + F.col("tail")).cast("bigint").alias("taken"))
