"""Price tracking: listing against the previous snapshot, by product URL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine import vocab as V
from vitrine.functions.dates import jalali_text
from vitrine.functions.prices import largest_number, parse_price, tracked_percent
from vitrine.functions.text import code_after_word, name_through_code
from vitrine.operators.scale import last_by_key, previous_within


def read_listing(listing: DataFrame, run_date: Column) -> DataFrame:
    """Listing rows as tracker rows: name, code, current price, URL, date."""
    price_text = "price" if "price" in listing.columns else "product_name"
    return listing.select(
        "ord", name_through_code("product_name").alias("name"),
        code_after_word("product_name").alias("code"),
        largest_number(price_text, min_digits=5).alias("price"),
        F.col("product_url").alias("url"), jalali_text(run_date).alias("check_date"))


def previous_snapshot(snapshot: DataFrame) -> DataFrame:
    """One row per URL of the previous snapshot; the last one wins."""
    def either(*names):
        got = [F.col(n) for n in names if n in snapshot.columns]
        return F.coalesce(*got) if got else F.lit(None).cast("string")

    rows = snapshot.select(either("url", "product_url").alias("prev_url"),
                           either("name", "product_name").alias("prev_name"),
                           either("code").alias("prev_code"),
                           parse_price(either("price").cast("string")).alias("prev_price"), "ord")
    return last_by_key(rows, "prev_url", "ord").drop("ord")


def track(current: DataFrame, previous: DataFrame) -> DataFrame:
    """Every current row with its status against the previous snapshot.

    A left join, not a full outer one: a URL repeated many times on the
    current side can then be split by the adaptive skew join.
    """
    joined = current.join(previous_snapshot(previous),
                          F.col("url").eqNullSafe(F.col("prev_url")), "left")
    known = F.col("prev_found")
    comparable = F.col("price").isNotNull() & F.col("prev_price").isNotNull()
    differs = comparable & (F.col("price").cast("double") != F.col("prev_price"))
    percent = F.round(tracked_percent(F.col("prev_price"), F.col("price").cast("double")), 2)
    return (joined.withColumn("prev_found", F.col("prev_url").isNotNull())
            .withColumn("status", F.when(~known, "new").when(differs, "price_changed")
                        .otherwise("unchanged"))
            .withColumn("listed_unchanged", known & comparable & ~differs)
            .withColumn("delta", F.when(F.col("status") == "price_changed", (
                F.col("price").cast("double") - F.col("prev_price")).cast("bigint")))
            .withColumn("percent", F.when(F.col("status") == "price_changed", percent))
            .withColumn("prev_price", F.col("prev_price").cast("bigint"))
            .drop("prev_found", "prev_url", "prev_name", "prev_code"))


def removed_since(current: DataFrame, previous: DataFrame, run_date: Column) -> DataFrame:
    gone = previous_snapshot(previous).join(
        current.select(F.col("url").alias("prev_url")).distinct(), "prev_url", "left_anti")
    return gone.select(F.col("prev_name").alias("name"), F.col("prev_code").alias("code"),
                       F.col("prev_url").alias("url"),
                       F.nullif(F.col("prev_price").cast("bigint"), F.lit(0)).alias("last_price"),
                       jalali_text(run_date).alias("removed_date"))


def tracker_counts(tracked: DataFrame, removed: DataFrame) -> DataFrame:
    """Counters of the report and the status breakdown of its charts."""
    changed = F.col("status") == "price_changed"
    now = tracked.agg(
        F.count("*").alias("total"), F.count_if(F.col("status") == "new").alias("new"),
        F.count_if(changed).alias("changed"),
        F.count_if(F.col("status") == "unchanged").alias("unchanged"),
        F.count_if(changed & (F.col("delta") > 0)).alias("increased"),
        F.count_if(changed & (F.col("delta") < 0)).alias("decreased"))
    # Both sides are one row, so this pairs exactly two rows.
    gone = removed.agg(F.count("*").alias("removed"))
    return now.join(gone, F.lit(True))


def tracker_manifest(tracked: DataFrame, removed: DataFrame) -> DataFrame:
    changed = tracked.filter("status = 'price_changed'").select(
        F.col("code").alias("sku"), "name", F.lit("price").alias("change_type"),
        F.format_string("%d -> %d", "prev_price", "price").alias("details"))
    gone = removed.select(F.col("code").alias("sku"), "name",
                          F.lit("removed").alias("change_type"), F.lit("").alias("details"))
    return changed.unionByName(gone)


def listing_extract(df: DataFrame) -> DataFrame:
    """Product name and URL in listing shape, from whatever the fields are called."""
    def either(*names):
        got = [F.nullif(F.col(n), F.lit("")) for n in names if n in df.columns]
        return F.coalesce(*got, F.lit(""))
    return df.select(either("product_name", "name").alias("product_name"),
                     either("product_url", "url", "link").alias("product_url"))


def price_steps(observations: DataFrame, key: str, order, slice_by: Column,
                price: str = "price") -> DataFrame:
    """Every observation of a key whose price differs from the one before."""
    seen = previous_within(observations, [key], order, slice_by, {price: "prev_price"})
    return (seen.filter(F.col("prev_price").isNotNull() & (F.col("prev_price") != F.col(price)))
            .withColumn("delta", F.col(price) - F.col("prev_price"))
            .withColumn("percent", tracked_percent(F.col("prev_price"), F.col(price))))


def significant_changes(df: DataFrame, percent: str = "percent",
                        threshold: float = V.SIGNIFICANT_CHANGE_PERCENT) -> DataFrame:
    """Rows whose change, up or down, reaches the threshold in percent."""
    return df.filter(F.abs(percent) >= threshold)
