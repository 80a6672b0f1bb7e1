"""Capped price history per product."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine import vocab as V
from vitrine.functions.dates import jalali_text, older_than
from vitrine.functions.prices import signed_percent
from vitrine.operators.scale import top_n_by_key

HISTORY_SCHEMA = ("sku string, product_name string, change_date date, persian_date string, "
                  "old_price bigint, new_price bigint, change_amount bigint, "
                  "change_percent double, change_type string, timestamp timestamp")


def history_rows(changes: DataFrame, at: Column) -> DataFrame:
    """History records of (sku, product_name, old_price, new_price) rows.

    The kind of change follows from the prices: none before is new, none now
    is removed, otherwise an increase or a decrease.
    """
    old, new = (F.coalesce(F.col(c), F.lit(0)).cast("bigint") for c in ("old_price", "new_price"))
    both = (old != 0) & (new != 0)
    return changes.select(
        "sku", "product_name", F.to_date(at).alias("change_date"),
        jalali_text(at).alias("persian_date"), old.alias("old_price"), new.alias("new_price"),
        F.when(both, new - old).otherwise(new).alias("change_amount"),
        F.when(both & (old > 0), (new - old) / F.nullif(old, F.lit(0)) * 100).otherwise(0.0)
        .alias("change_percent"),
        F.when(old == 0, "new").when(new == 0, "removed").when(new > old, "increase")
        .otherwise("decrease").alias("change_type"),
        at.alias("timestamp"))


def history_sheet(history: DataFrame) -> DataFrame:
    return history.withColumn("change_percent", F.when(
        F.col("change_percent") == 0, "+0.00%").otherwise(signed_percent("change_percent", 2)))


def cap_history(history: DataFrame, rows: int = V.HISTORY_ROWS_PER_KEY, key: str = "sku",
                at: str = "timestamp", tie: tuple = ()) -> DataFrame:
    """The latest ``rows`` records of every product."""
    newest_first = [F.col(at).desc(), *[F.col(t).desc() for t in tie]]
    return top_n_by_key(history, key, newest_first, rows)


def append_history(history: DataFrame, new: DataFrame, rows: int = V.HISTORY_ROWS_PER_KEY,
                   tie: tuple = ()) -> DataFrame:
    return cap_history(history.unionByName(new), rows, tie=tie)


def product_history(history: DataFrame, sku) -> DataFrame:
    return history.filter(F.col("sku") == sku).orderBy(F.col("timestamp").desc())


def history_statistics(history: DataFrame) -> DataFrame:
    kinds = ("increase", "decrease", "new", "removed")
    return history.agg(
        F.count("*").alias("total_records"), F.count_distinct("sku").alias("total_products"),
        F.min("change_date").alias("first_date"), F.max("change_date").alias("last_date"),
        *[F.count_if(F.col("change_type") == k).alias(f"{k}_rows") for k in kinds])


def expired_snapshots(snapshots: DataFrame, run_date: Column,
                      days: int = V.SNAPSHOT_DAYS) -> DataFrame:
    """Snapshot dates with whether retention drops them."""
    dates = snapshots.select("snapshot_date").distinct()
    return dates.withColumn("expired", older_than("snapshot_date", run_date, days))


def daily_average(observations: DataFrame, at: str, price: str, last_day: Column,
                  days: int = 7) -> DataFrame:
    """Average price of each of the last ``days`` days; 0 rows where none."""
    day = F.to_date(at)
    recent = observations.filter((day > F.date_sub(last_day, days)) & (day <= last_day))
    means = recent.groupBy(day.alias("day")).agg(
        F.avg(price).alias("average"), F.count("*").alias("observations"))
    spine = (observations.sparkSession.range(days)
             .select(F.date_sub(last_day, (days - 1 - F.col("id")).cast("int")).alias("day")))
    return (spine.join(F.broadcast(means), "day", "left")
            .withColumn("observations", F.coalesce("observations", F.lit(0))))


def chart_struct(counts: DataFrame) -> DataFrame:
    """Counters of one run as the single JSON object a chart reads."""
    return counts.select(F.to_json(F.struct(*counts.columns)).alias("chart"))
