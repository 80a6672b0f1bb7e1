"""Helpers that keep one hot key from becoming one hot task.

* keep-first / keep-last / top-n per key use ``row_number() <= n`` so Spark
  plans a WindowGroupLimit: every map task drops all but n rows per key before
  the shuffle, however many rows the key has.
* numbering and looking back *inside* a key are done per (key, slice), where
  the slice is a coarse monotone function of the ordering (a day, a range of
  ids); only one small row per slice is ever handled per key.
* no join is hinted: adaptive execution broadcasts a side by its measured bytes.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

LITERAL_ROWS = 1_000
#: Rows that one task numbers, where their number is known and large.
TASK_ROWS = 500_000
_RANK = "__rank"


def _cols(names) -> list:
    names = [names] if isinstance(names, (str, Column)) else list(names)
    return [F.col(n) if isinstance(n, str) else n for n in names]


def _reversed(order) -> list:
    return [c.desc() for c in _cols(order)]


def top_n_by_key(df: DataFrame, keys, order, n: int) -> DataFrame:
    ranked = df.withColumn(_RANK, F.row_number().over(
        Window.partitionBy(*_cols(keys)).orderBy(*_cols(order))))
    return ranked.filter(F.col(_RANK) <= n).drop(_RANK)


def first_by_key(df: DataFrame, keys, order) -> DataFrame:
    return top_n_by_key(df, keys, order, 1)


def last_by_key(df: DataFrame, keys, order) -> DataFrame:
    return top_n_by_key(df, keys, _reversed(order), 1)


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows of a few large splits to all cores before heavy row work.

    Only a plain scan with fewer splits than cores is dealt out (one file with
    one row group is one task otherwise); a table that already has enough
    splits, or comes out of a shuffle, is left as it is.
    """
    plan = df._jdf.queryExecution().executedPlan()
    if plan.nodeName().startswith("AdaptiveSparkPlan"):
        return df
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if plan.execute().getNumPartitions() < cores else df


def exploded(df: DataFrame, cell: Column, out: str, *keep: str, pos: str | None = None) -> DataFrame:
    """One row per element of an array; empty and missing ones give none.

    An inner explode would first be guarded by a filter on the size of the
    array, into which its whole expression is copied and worked out again.
    """
    made = F.posexplode_outer("__cell").alias(pos or "__pos", out)
    rows = df.select(*keep, cell.alias("__cell")).select(*keep, made).filter(F.col(pos or "__pos").isNotNull())
    return rows if pos else rows.drop("__pos")


def local_frame(spark, columns: dict, schema: str) -> DataFrame:
    """A few driver-side rows as a local relation, whose size Spark knows."""
    import pyarrow as pa
    from pyspark.sql.types import _parse_datatype_string
    from pyspark.sql.pandas.types import to_arrow_schema
    shape = to_arrow_schema(_parse_datatype_string(schema))
    return spark.createDataFrame(pa.table(columns, schema=shape))


#: Longer cells are not looked up, so a table of looked-up values stays small.
LOOKED_UP_LENGTH = 200


def by_distinct_values(df: DataFrame, column: str, value, out: str, seen: DataFrame | None = None) -> DataFrame:
    """``out``: ``value`` of a text column, worked out once per distinct cell where these are few.

    The values of at most ``LITERAL_ROWS`` distinct cells become a literal; with
    more of them, and for a cell that is not among them, the row works for itself.
    Cells are looked for in ``seen``, a table with that column that is cheaper to read.
    """
    full = value(F.col(column))
    kind = df.select(full.alias("v")).schema["v"].dataType.simpleString()
    cells = (df if seen is None else seen).select(F.col(column).alias("k")).filter(F.length("k") <= LOOKED_UP_LENGTH).distinct()
    rows = rows_if_small(cells.select("k", F.to_json(F.struct(value(F.col("k")).alias("v"))).alias("v")))
    if not rows:
        return df.withColumn(out, full)
    known = F.from_json(F.lit("{" + ",".join(f"{json.dumps(r.k)}:{r.v}" for r in rows) + "}"), f"map<string,struct<v:{kind}>>")
    return df.withColumn(out, F.coalesce(F.try_element_at(known, F.col(column))["v"], full))


def rows_if_small(df: DataFrame, rows: int = LITERAL_ROWS) -> list | None:
    """The rows of a small rule table, or None when it is not small."""
    got = df.limit(rows + 1).collect()
    return got if len(got) <= rows else None


def quantile_slices(df: DataFrame, column: str, slices: int = 64) -> Column:
    """A monotone slice number of a numeric column with even row counts.

    Only ``slices`` numbers reach the driver; they come back as literals, so a
    recomputed task cuts at the same places.
    """
    return slices_and_rows(df, column, slices)[0]


def slices_and_rows(df: DataFrame, column: str, slices: int = 64) -> tuple[Column, int]:
    """The same, and how many rows there are."""
    cuts, rows = df.agg(F.percentile_approx(F.col(column).cast("double"), [i / slices for i in range(1, slices)], 1000),
                        F.count("*")).first()
    edges = [float(edge) for edge in sorted(set(cuts or []))]
    if not edges:
        return F.lit(0), rows
    # Halving steps over one literal; a sum of as many comparisons is no longer compiled by the JVM.
    table, value = F.array(*map(F.lit, edges)), F.col(column).cast("double")
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(len(edges).bit_length()))])
    return F.aggregate(halves, F.lit(0), lambda at, step: at + F.when(
        value > F.get(table, at + step - 1), step).otherwise(0)), rows


def number_within(df: DataFrame, keys: Sequence[str], order, slice_by: Column,
                  name: str, rows: int | None = None) -> DataFrame:
    """1, 2, 3, ... inside every key, without bringing a key together.

    ``slice_by`` must never decrease along ``order``.  Rows are numbered per
    (key, slice); the rows of earlier slices are added from per-slice counts.
    With their number known, many ``rows`` are dealt to more tasks, so what a
    task sorts does not grow with the table.
    """
    keys = list(keys)
    tasks = -(-(rows or 0) // TASK_ROWS)
    more = tasks > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def dealt(part: DataFrame, *by: str) -> DataFrame:
        return part.repartition(tasks, *by) if more else part
    # One column, in which NULL keys are equal too, so one shuffle and one sort serve window and join.
    sliced = df.withColumn("__part", F.struct(*keys, slice_by.alias("__slice")))
    local = dealt(sliced, "__part").withColumn("__local", F.row_number().over(
        Window.partitionBy("__part").orderBy(*_cols(order))))
    before = (Window.partitionBy(*keys).orderBy("__slice")
              .rowsBetween(Window.unboundedPreceding, -1))
    counts = dealt(sliced.select("__part"), "__part").groupBy("__part").agg(F.count("*").alias("__n"))
    offsets = (dealt(counts.select("__part", "__part.*", "__n"), *keys)
               .select("__part", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before")))
    return (local.join(offsets, "__part")
            .withColumn(name, (F.col("__local") + F.col("__before")).cast("bigint"))
            .drop("__local", "__before", "__part"))


def previous_within(df: DataFrame, keys: Sequence[str], order, slice_by: Column,
                    values: dict[str, str]) -> DataFrame:
    """Value of the row before, inside every key; ``values`` is {source: new}.

    The first row of a slice takes the last value of the nearest earlier slice
    that has rows.
    """
    keys = list(keys)
    sliced = df.withColumn("__slice", slice_by)
    w = Window.partitionBy(*keys, "__slice").orderBy(*_cols(order))
    row = F.struct(*[F.col(c) for c in values])
    local = sliced.withColumn("__prev", F.lag(row).over(w))
    tail = F.max_by(row, F.struct(*_cols(order)))
    back = Window.partitionBy(*keys).orderBy("__slice")
    carry = (sliced.groupBy(*keys, "__slice").agg(tail.alias("__last"))
             .withColumn("__carry", F.lag("__last").over(back)).drop("__last"))
    joined = _join_null_safe(local, carry, [*keys, "__slice"])
    prev = F.coalesce(F.col("__prev"), F.col("__carry"))
    for source, new in values.items():
        joined = joined.withColumn(new, prev[source])
    return joined.drop("__prev", "__carry", "__slice")


def _join_null_safe(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Inner join on ``keys`` where NULL keys meet too, keeping one copy."""
    renamed = right.withColumnsRenamed({k: "__r_" + k for k in keys})
    on = [F.col(k).eqNullSafe(F.col("__r_" + k)) for k in keys]
    cond = on[0]
    for c in on[1:]:
        cond = cond & c
    return left.join(renamed, cond, "inner").drop(*["__r_" + k for k in keys])


def number_all(df: DataFrame, order: str, slice_by: Column, name: str) -> DataFrame:
    """One running number over a whole table, by slices."""
    return (number_within(df.withColumn("__all", F.lit(1)), ["__all"], order, slice_by, name)
            .drop("__all"))


def joined_values(df: DataFrame, keys: Sequence[str], value: str, order: str,
                  name: str, sep: str = " | ") -> DataFrame:
    """Distinct values of a key as one delimited cell, in first-seen order.

    Duplicates are folded on the map side first, so a key ships each distinct
    value once per task, not once per row.
    """
    keys = list(keys)
    once = df.groupBy(*keys, value).agg(F.min(order).alias("__ord"))
    pairs = F.array_sort(F.collect_list(F.struct("__ord", F.col(value).alias("v"))))
    return once.groupBy(*keys).agg(
        F.array_join(F.transform(pairs, lambda p: p["v"]), sep).alias(name))
