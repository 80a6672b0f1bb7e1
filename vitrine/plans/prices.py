"""Price tracking end to end: listing, history records, counters, chart."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.operators import history as H
from vitrine.operators import tracking as K


@dataclass(frozen=True)
class Tracked:
    current: DataFrame
    removed: DataFrame
    history: DataFrame
    counts: DataFrame


def track_prices(listing: DataFrame, previous: DataFrame, at: Column) -> Tracked:
    """Statuses, removed products and the history records they lead to."""
    tracked = K.track(K.read_listing(listing, F.to_date(at)), previous)
    removed = K.removed_since(tracked, previous, F.to_date(at))
    seen = tracked.filter("status <> 'unchanged'").select(
        F.col("code").alias("sku"), F.col("name").alias("product_name"),
        F.when(F.col("status") == "price_changed", F.col("prev_price")).alias("old_price"),
        F.col("price").alias("new_price"))
    gone = removed.select(F.col("code").alias("sku"), F.col("name").alias("product_name"),
                          F.col("last_price").alias("old_price"),
                          F.lit(None).cast("bigint").alias("new_price"))
    return Tracked(tracked, removed, H.history_rows(seen.unionByName(gone), at),
                   K.tracker_counts(tracked, removed))


def dashboard(counts: DataFrame, history: DataFrame, last_day: Column, price: str = "new_price",
              at: str = "timestamp") -> tuple[DataFrame, DataFrame]:
    """Counters as one JSON object, and the daily averages behind the trend."""
    return H.chart_struct(counts), H.daily_average(history, at, price, last_day)
