"""Chat formatting with collapse of cumulative snapshots, in Spark's own functions.

Logged conversations are often saved after every turn, so that one is a prefix
of the next.  Every prefix of turns has a rolling hash: the number of turns and
the exclusive or of two 64-bit hashes of (position, role, text).  A
conversation whose whole hash is a proper prefix of another one is left out, of
equal ones the least id is kept, and what is left is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Turns of one rendered part, and of one slice of the numbering.
PART_TURNS = 256
TEMPLATE = "<|{role}|>\n{text}<|end|>\n"


def numbered_turns(turns: DataFrame) -> DataFrame:
    """Adds ``place``: 1, 2, ... along a conversation, by (turn, role, text), nulls first.

    Turns are numbered within slices of ``PART_TURNS`` turn numbers; the turns
    of earlier slices are added from per-slice counts.
    """
    sliced = turns.withColumn("slice", F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(-1 << 40)))
    w = Window.partitionBy("conv_id", "slice").orderBy(
        F.col("turn").asc_nulls_first(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    before = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    counts = (sliced.groupBy(F.col("conv_id").alias("c"), F.col("slice").alias("s")).agg(F.count("*").alias("n"))
              .withColumn("earlier", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n"))
    return (sliced.withColumn("in_slice", F.row_number().over(w))
            .join(counts, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("slice") == F.col("s")))
            .withColumn("place", F.col("in_slice") + F.col("earlier")).drop("c", "s", "in_slice", "earlier"))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """(conv_id, place, x, y) of every prefix: the hashes of its turns taken together.

    The running hash is kept per slice; the slices before come in as one row each.
    """
    turn = [F.col("place"), F.coalesce(F.col("role"), F.lit("\x00")), F.coalesce(F.col("text"), F.lit("\x00"))]
    hashed = numbered_turns(turns).select("conv_id", "slice", "place", F.xxhash64(F.lit(1), *turn).alias("p"),
                                          F.xxhash64(F.lit(2), *turn).alias("q"))
    here = Window.partitionBy("conv_id", "slice").orderBy("place").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("c").orderBy("s").rowsBetween(Window.unboundedPreceding, -1)
    slices = hashed.groupBy(F.col("conv_id").alias("c"), F.col("slice").alias("s")).agg(
        F.bit_xor("p").alias("sp"), F.bit_xor("q").alias("sq"))
    slices = slices.select("c", "s", F.coalesce(F.bit_xor("sp").over(before), F.lit(0)).alias("bp"),
                           F.coalesce(F.bit_xor("sq").over(before), F.lit(0)).alias("bq"))
    return (hashed.withColumn("hp", F.bit_xor("p").over(here)).withColumn("hq", F.bit_xor("q").over(here))
            .join(slices, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("slice") == F.col("s")))
            .select("conv_id", "place", F.col("hp").bitwiseXOR(F.col("bp")).alias("x"),
                    F.col("hq").bitwiseXOR(F.col("bq")).alias("y")))


def maximal(turns: DataFrame) -> DataFrame:
    """(conv_id, n_turns) of the conversations that no other one continues or equals with a lesser id.

    Whole hashes are folded to the least id and prefixes to one row each
    before they meet, so neither a common first turn nor many equal
    conversations make a hot key.
    """
    prefixes = prefix_hashes(turns)
    length = prefixes.groupBy("conv_id").agg(F.max("place").alias("n_turns"))
    named = length.withColumnRenamed("conv_id", "c")
    placed = prefixes.join(named, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c")
    # No id first among equals: a null id is kept only where no other is there.
    whole = placed.filter(F.col("place") == F.col("n_turns")).groupBy("n_turns", "x", "y").agg(
        F.min("conv_id").alias("conv_id"))
    continued = (placed.filter(F.col("place") < F.col("n_turns"))
                 .select(F.col("place").alias("n_turns"), "x", "y").distinct())
    return whole.join(continued, ["n_turns", "x", "y"], "left_anti").select("conv_id", "n_turns")


def rendered_turn(role: Column, text: Column, template: str = TEMPLATE) -> Column:
    """One turn in the template; a null role is 'user', a null text is empty."""
    role, text = F.coalesce(role, F.lit("user")), F.coalesce(text, F.lit(""))
    head, _, rest = template.partition("{role}")
    between, _, tail = rest.partition("{text}")
    return F.concat(F.lit(head), role, F.lit(between), text, F.lit(tail))


def render(turns: DataFrame, template: str = TEMPLATE) -> DataFrame:
    """Maximal conversations as text: conv_id, part, n_turns, chat.

    A conversation of up to ``PART_TURNS`` turns is one part, 0; a longer one
    goes on in further parts of that many turns, so no cell grows without
    bound.  Turns with equal numbers keep the order (turn, role, text); rows
    with a null conv_id are one conversation; other columns are ignored; an
    empty table gives an empty table.
    """
    turns = turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.col("role").cast("string").alias("role"),
                         F.col("text").cast("string").alias("text"))
    kept = maximal(turns).withColumnRenamed("conv_id", "c")
    placed = numbered_turns(turns).join(kept, F.col("conv_id").eqNullSafe(F.col("c"))).drop("c", "slice")
    part = F.floor((F.col("place") - 1) / PART_TURNS)
    said = F.array_sort(F.collect_list(F.struct(
        "place", rendered_turn(F.col("role"), F.col("text"), template).alias("said"))))
    return (placed.groupBy("conv_id", part.alias("part"), "n_turns")
            .agg(F.array_join(F.transform(said, lambda s: s["said"]), "").alias("chat")))
