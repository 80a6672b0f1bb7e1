"""Document fingerprints: bottom-k sketches of word-shingle hashes, in Spark's own functions.

A sketch is the sorted array of the k least distinct shingle hashes of a text.
Sketches of parts merge into the sketch of the whole; two sketches estimate
resemblance, containment and the number of distinct shingles.  Hashes keep 48
bits, so a sketch is written as 12 hex digits per hash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

K = 128
WIDTH = 5
#: Slices of the id order per shuffle partition.
SLICES = 4


def text_sketch(text: Column, k: int = K, width: int = WIDTH) -> Column:
    """Sketch of a text's ``width``-word shingles; null and blank texts have an empty one.

    Words are runs of other characters than ASCII white space, with A-Z in
    lower case.  A text of fewer words has its whole sequence as one shingle.
    """
    blank = r"[\x20\x09-\x0D]+"
    lower = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    found = F.filter(F.split(F.coalesce(lower, F.lit("")), blank), lambda w: w != "")
    hashes = F.transform(found, lambda w: F.xxhash64(w))
    # Bound by a one-element transform, so that the array is built once.
    every = F.flatten(F.transform(F.array(hashes), lambda h: F.when(
        F.size(h) == 0, F.array().cast("array<bigint>")).otherwise(F.transform(
            F.sequence(F.lit(1), F.greatest(F.size(h) - (width - 1), F.lit(1))),
            lambda i: F.shiftrightunsigned(F.xxhash64(F.slice(h, i, width)), 16)))))
    return F.slice(F.array_sort(F.array_distinct(every)), 1, k)


def merge(a: Column, b: Column, k: int = K) -> Column:
    """Sketch of two parts together, from their sketches."""
    return F.slice(F.array_sort(F.array_union(a, b)), 1, k)


def resemblance(a: Column, b: Column, k: int = K) -> Column:
    """Estimated Jaccard likeness: the share of the merged sketch that both have.

    Exact while both texts have fewer than k shingles.  Two empty sketches are
    alike (1.0), an empty and another one are not (0.0).
    """
    both = F.size(F.array_intersect(merge(a, b, k), F.array_intersect(a, b)))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).otherwise(
        both / F.greatest(F.size(merge(a, b, k)), F.lit(1)))


def distinct_count(a: Column, k: int = K) -> Column:
    """Estimated number of distinct shingles: exact below k, else from the k-th hash."""
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise(
        (k - 1) / (F.element_at(a, -1) / F.lit(float(2 ** 48))))


def containment(a: Column, b: Column, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1.0 for an empty a."""
    shared = resemblance(a, b, k) * distinct_count(merge(a, b, k), k)
    return F.when(F.size(a) == 0, F.lit(1.0)).otherwise(
        F.least(F.lit(1.0), shared / F.greatest(distinct_count(a, k), F.lit(1.0))))


def as_text(a: Column) -> Column:
    return F.array_join(F.transform(a, lambda h: F.lpad(F.lower(F.hex(h)), 12, "0")), "")


def from_text(s: Column) -> Column:
    return F.transform(F.filter(F.split(s, "(?<=\\G.{12})"), lambda x: x != ""),
                       lambda x: F.conv(x, 16, 10).cast("bigint"))


def slice_cuts(ids: Column, docs: DataFrame, slices: int) -> list[int]:
    """Ids at which about equal numbers of rows begin; an id of many rows is there more than once."""
    at = [i / slices for i in range(1, slices)]
    cuts = docs.select(F.percentile_approx(ids, at, 100 * slices)).first()[0] if at else None
    return sorted(cuts or [])


def slice_of(key: Column, tie: Column, cuts: list[int]) -> Column:
    """Number of a row's slice of the order by (key, tie), which never falls along it.

    It is the number of cuts below the key, counted in two steps.  Where
    several cuts are the key itself, its rows are dealt to as many slices by
    ranges of the tie, so no key has to fit in one.
    """
    step = max(1, math.isqrt(len(cuts)))
    parts = [cuts[i:i + step] for i in range(0, len(cuts), step)]
    held = F.array(*[F.array(*[F.lit(c).cast("bigint") for c in part]) for part in parts] or [F.array().cast("array<bigint>")])
    lasts = F.array(*[F.lit(part[-1]).cast("bigint") for part in parts]) if parts else F.array().cast("array<bigint>")

    def below(test) -> Column:
        whole = F.size(F.filter(lasts, test))
        within = F.coalesce(F.size(F.filter(F.get(held, whole), test)), F.lit(0))
        return whole * step + F.greatest(within, F.lit(0))
    under, upto = below(lambda c: c < key), below(lambda c: c <= key)
    # A tie's place among all 64-bit numbers, in 2**20 steps.
    place = F.shiftright(tie, 44) + (1 << 19)
    return under + F.shiftright((upto - under + 1) * place, 20).cast("int")


def fingerprints(docs: DataFrame, k: int = K, width: int = WIDTH) -> DataFrame:
    """Fingerprint of every text of ``docs`` (doc_id, text) and of its edited text.

    The edited text has its last quarter replaced by as many first characters
    of the next document; after the last comes the first.  A null text is
    empty, a null id comes before all others, and rows with one id follow each
    other by a hash of their texts.  Other columns are ignored; an empty table
    gives an empty table.

    Texts are shuffled once, by slices of the id order, in which the next
    document is the next row.  Only the first row of a slice travels to the
    last one of the slice before.
    """
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                       F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    key = F.coalesce("doc_id", F.lit(-2 ** 63).cast("bigint"))
    cuts = slice_cuts(key, docs, SLICES * parts)
    keyed = docs.withColumns({"key": key, "tie": F.xxhash64("text")})
    keyed = keyed.withColumn("slice", slice_of(F.col("key"), F.col("tie"), cuts)).repartition(parts, "slice")

    along = Window.partitionBy("slice").orderBy("key", "tie")
    own = keyed.withColumn("own", text_sketch(F.col("text"), k, width))
    led = own.select("*", F.lead(F.struct("text", "own")).over(along).alias("next"), F.lead("doc_id").over(along).alias("lead_id"))
    # All columns are asked for, so that both readers share one shuffle.
    firsts = keyed.groupBy("slice").agg(F.min_by(F.struct("doc_id", "text"), F.struct("key", "tie")).alias("one"))
    firsts = firsts.select("slice", F.col("one.text").alias("head"), F.col("one.doc_id").alias("head_id"))
    order = Window.orderBy("slice")
    after = firsts.select(F.col("slice").alias("at"), F.coalesce(F.lead("slice").over(order), F.first("slice").over(order)).alias("to"))
    heads = after.join(firsts, F.col("to") == F.col("slice")).select(
        "at", F.struct(F.col("head").alias("text"), text_sketch(F.col("head"), k, width).alias("own")).alias("first_after"), "head_id")
    joined = led.join(heads, (F.col("slice") == F.col("at")) & F.col("next").isNull(), "left").withColumn(
        "next_id", F.when(F.col("next").isNull(), F.col("head_id")).otherwise(F.col("lead_id")))
    joined = joined.select("doc_id", "text", "own", F.coalesce("next", "first_after").alias("next"), "next_id")
    n = F.char_length("text")
    quarter = F.floor(n / 4).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - quarter),
                      F.substring(F.col("next.text"), F.lit(1), quarter))
    made = joined.select("doc_id", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "own", F.col("next.own").alias("next_own"), "next_id")
    made = made.withColumn("theirs", text_sketch(F.col("edited"), k, width))
    return made.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("theirs")).alias("edited_fingerprint"),
        resemblance(F.col("own"), F.col("theirs"), k).alias("near_edited"),
        resemblance(F.col("own"), F.col("next_own"), k).alias("near_next"),
        distinct_count(F.col("own"), k).alias("n_shingles_estimate"),
        containment(F.col("own"), F.col("theirs"), k).alias("kept_estimate"), "next_id")
