"""Catalogue comparison: what a new scan changes in the catalogue.

Both sides are cut to one row per key before they meet, so the full outer
join has one row per key whatever the duplication, and every report below is
a projection of that one joined table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.prices import (effective_price, price_change, signed_amount,
                                      signed_percent, thousands)
from vitrine.functions.text import nullify_blank, numeric_code, split_values, strip_invisible
from vitrine.operators.scale import first_by_key, joined_values, last_by_key


def color_set(cell) -> Column:
    """Sorted distinct colours of a cell, invisible characters ignored."""
    clean = split_values(strip_invisible(cell))
    return F.coalesce(F.sort_array(F.array_distinct(clean)), F.array().cast("array<string>"))


def _keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("sku", nullify_blank("sku")).filter(F.col("sku").isNotNull())


def new_rows(scan: DataFrame, catalog: DataFrame) -> DataFrame:
    """Scan rows whose key the catalogue lacks."""
    return _keyed(scan).join(_keyed(catalog).select("sku").distinct(), "sku", "left_anti")


def rows_of_class(rows: DataFrame, diff: DataFrame, change_class: str) -> DataFrame:
    """Rows of either table whose key is of a class; of the scan, ``new`` are its ``new_rows``."""
    if "__class" in rows.columns:
        return rows.filter(F.col("__class") == change_class).drop("__class", "__colors")
    return _keyed(rows).join(diff.filter(F.col("change_class") == change_class).select("sku"), "sku", "left_semi")


def reported_rows(scan: DataFrame, diff: DataFrame) -> DataFrame:
    """Scan rows of new products and of known ones with a new colour, with their class and the colours of the latter.

    The reports take such a table for the scan; what they ask of it is then a filter, no join.
    """
    marks = diff.filter("change_class = 'new' or color_added").select(
        "sku", F.col("change_class").alias("__class"),
        F.when(F.col("color_added"), F.array_join("colors_after", " | ")).alias("__colors"))
    return _keyed(scan).join(marks, "sku")


def removed_rows(scan: DataFrame, catalog: DataFrame) -> DataFrame:
    return (_keyed(catalog).join(_keyed(scan).select("sku").distinct(), "sku", "left_anti")
            .select("sku", "name", "regular_price", "sale_price", "colors", "ord"))


def _side(df: DataFrame, mark: str, with_colors: bool) -> DataFrame:
    """One row per key with only what the comparison needs."""
    wanted = ["sku", "name", "regular_price", "sale_price", "ord"] + ["colors"] * with_colors
    first = first_by_key(_keyed(df).select(*[c for c in wanted if c in df.columns]), "sku", "ord")
    out = first.select(
        F.col("sku").alias(f"{mark}_sku"),
        *([F.col("name").alias(f"{mark}_name")] if "name" in df.columns else []),
        effective_price("regular_price", "sale_price").alias(f"{mark}_price"),
        *([F.col("colors").alias(f"{mark}_colors")] if with_colors else []))
    return out


def diff_catalog(scan: DataFrame, catalog: DataFrame, colors: bool = True) -> DataFrame:
    """One row per key of either table.

    ``change_class`` is new, removed or common.  For common keys: the prices
    differ when both sides have one and they are unequal, and the colour sets
    are compared element by element.  ``changed`` is a price change or an
    added colour; a colour that only went away does not count as a change.
    """
    joined = _side(scan, "scan", colors).join(
        _side(catalog, "cat", colors), F.col("scan_sku") == F.col("cat_sku"), "full_outer")
    common = F.col("scan_sku").isNotNull() & F.col("cat_sku").isNotNull()
    moved = common & (F.col("cat_price") != F.col("scan_price"))
    has_name = "name" in scan.columns and "name" in catalog.columns
    base = joined.select(
        F.coalesce("scan_sku", "cat_sku").alias("sku"),
        *([F.coalesce("scan_name", "cat_name").alias("name")] if has_name else []),
        F.when(F.col("cat_sku").isNull(), "new").when(F.col("scan_sku").isNull(), "removed")
        .otherwise("common").alias("change_class"),
        F.col("cat_price").alias("old_price"), F.col("scan_price").alias("new_price"),
        F.coalesce(moved, F.lit(False)).alias("price_changed"),
        *([F.when(common | F.col("scan_sku").isNull(), color_set("cat_colors")).alias("colors_before"),
           F.when(common | F.col("cat_sku").isNull(), color_set("scan_colors")).alias("colors_after")]
          if colors else []))
    if not colors:
        return base
    is_common = F.col("change_class") == "common"
    return (base
            .withColumn("added", F.when(is_common, F.array_except("colors_after", "colors_before")))
            .withColumn("removed", F.when(is_common, F.array_except("colors_before", "colors_after")))
            .withColumn("color_added", F.coalesce(F.size("added") > 0, F.lit(False)))
            .withColumn("color_removed", F.coalesce(F.size("removed") > 0, F.lit(False)))
            .withColumn("changed", F.col("price_changed") | F.col("color_added")))


def change_counts(diff: DataFrame) -> DataFrame:
    return diff.agg(
        F.count_if(F.col("change_class") == "new").alias("new"),
        F.count_if("changed").alias("changed"),
        F.count_if("price_changed").alias("price"),
        F.count_if("color_added").alias("color"),
        F.count_if(F.col("color_added") | F.col("color_removed")).alias("color_rows"),
        F.count_if(F.col("change_class") == "removed").alias("removed"),
        F.count_if(F.col("change_class") == "common").alias("common"))


def price_changes(diff: DataFrame) -> DataFrame:
    change = price_change("old_price", "new_price")
    return (diff.filter("price_changed")
            .select("sku", "name", "old_price", "new_price",
                    change["amount"].alias("delta"), change["percent"].alias("percent")))


def price_sheet(changes: DataFrame) -> DataFrame:
    """The same as text, the way the change report shows it."""
    return changes.select("sku", "name", thousands(F.col("old_price")).alias("before"),
                          thousands(F.col("new_price")).alias("after"),
                          signed_amount("delta").alias("difference"),
                          signed_percent("percent", 1).alias("percent"))


# ---- variants of removed products and colours -------------------------------

def variant_keys(variants: DataFrame) -> DataFrame:
    """(parent, colour) -> variant key; the last row of a pair wins.  A table of keys stays as it is."""
    if "variant_sku" in variants.columns:
        return variants
    keyed = (variants.select(strip_invisible("parent_sku").alias("parent_sku"),
                             strip_invisible("color").alias("color"),
                             nullify_blank("sku").alias("variant_sku"), "ord")
             .filter("parent_sku <> '' and color <> '' and variant_sku is not null"))
    return last_by_key(keyed, ["parent_sku", "color"], "ord")


def lost_variants(diff: DataFrame, variants: DataFrame) -> DataFrame:
    """Variant keys that go, by their product or by their colour.

    The reports take such a table for the variants and only filter it.
    """
    marks = diff.filter("change_class = 'removed' or color_removed").select(
        F.col("sku").alias("__sku"), F.when(F.col("color_removed"), F.col("removed")).alias("__gone"))
    return (variant_keys(variants).join(marks, F.col("parent_sku") == F.col("__sku"))
            .filter(F.col("__gone").isNull() | F.array_contains("__gone", F.col("color")))
            .withColumn("lost_by", F.when(F.col("__gone").isNull(), "product").otherwise("color"))
            .drop("__sku", "__gone"))


def removed_product_variants(diff: DataFrame, variants: DataFrame) -> DataFrame:
    """One row per variant of every removed product."""
    if "lost_by" in variants.columns:
        return variants.filter("lost_by = 'product'").drop("lost_by")
    gone = diff.filter("change_class = 'removed'").select(F.col("sku").alias("parent_sku"))
    return variant_keys(variants).join(gone, "parent_sku", "left_semi")


def removed_color_variants(diff: DataFrame, variants: DataFrame) -> DataFrame:
    """One row per removed colour of a common product, its variant if any."""
    lost = diff.filter("color_removed").select(
        F.col("sku").alias("parent_sku"), F.explode("removed").alias("color"))
    return lost.join(variant_keys(variants), ["parent_sku", "color"], "left")


def found_color_variants(diff: DataFrame, variants: DataFrame) -> DataFrame:
    """The same where there is a variant."""
    if "lost_by" in variants.columns:
        return variants.filter("lost_by = 'color'").drop("lost_by")
    return removed_color_variants(diff, variants).filter("variant_sku is not null")


def removed_products(diff: DataFrame, catalog: DataFrame, variants: DataFrame) -> DataFrame:
    rows = first_by_key(_keyed(catalog), "sku", "ord").join(
        diff.filter("change_class = 'removed'").select("sku"), "sku", "left_semi")
    joined = joined_values(removed_product_variants(diff, variants), ["parent_sku"],
                           "variant_sku", "ord", "variant_skus")
    return (rows.join(joined, F.col("sku") == F.col("parent_sku"), "left")
            .select("sku", "name", "regular_price", "sale_price", "colors",
                    F.coalesce("variant_skus", F.lit("")).alias("variant_skus")))


def color_changes(diff: DataFrame, variants: DataFrame) -> DataFrame:
    gone = (found_color_variants(diff, variants)
            .groupBy("parent_sku").agg(F.array_sort(F.collect_list(
                F.struct("color", "variant_sku"))).alias("pairs"))
            .select(F.col("parent_sku"), F.array_join(
                F.transform("pairs", lambda p: p["variant_sku"]), " | ").alias("gone")))

    def cell(c):
        return F.array_join(c, " | ")

    return (diff.filter("color_added or color_removed")
            .join(gone, F.col("sku") == F.col("parent_sku"), "left")
            .select("sku", "name", cell("colors_before").alias("before"),
                    cell("colors_after").alias("after"), cell("added").alias("added"),
                    cell("removed").alias("removed"),
                    F.coalesce("gone", F.lit("")).alias("removed_variant_skus")))


def delete_list(diff: DataFrame, variants: DataFrame) -> DataFrame:
    """Keys to delete in their print order, one row each; nothing is collected."""
    def rows(df, part, sku, *order):
        keys = [F.lit(part).alias("part")] + [o.alias(f"k{i}") for i, o in enumerate(order)]
        return df.select(F.col(sku).alias("sku"), *keys)

    of_product = removed_product_variants(diff, variants)
    of_color = found_color_variants(diff, variants)
    nothing = F.lit("")
    parents = diff.filter("change_class = 'removed'")
    return (rows(parents, 1, "sku", F.col("sku"), F.lit(0).cast("long"), nothing)
            .unionByName(rows(of_product, 1, "variant_sku", F.col("parent_sku"),
                              F.col("ord").cast("long") + 1, F.col("color")))
            .unionByName(rows(of_color, 2, "variant_sku", F.col("parent_sku"),
                              F.lit(0).cast("long"), F.col("color"))))


# ---- links and manifests ----------------------------------------------------

def links_by_code(listing: DataFrame) -> DataFrame:
    """Listing rows keyed by the code in their name; the last one wins."""
    keyed = listing.withColumn("code", numeric_code("product_name")).filter("code is not null")
    return (last_by_key(keyed, "code", "ord")
            .select("code", F.col("product_name").alias("link_name"),
                    F.col("product_url").alias("link_url"), F.col("price").alias("link_price")))


def with_link(df: DataFrame, links: DataFrame, *columns: str) -> DataFrame:
    """Attach listing columns through the code inside ``sku``."""
    wanted = links.select(F.col("code").alias("__code"), *columns)
    return (df.withColumn("__c", numeric_code("sku"))
            .join(wanted, F.col("__c") == F.col("__code"), "left")
            .drop("__c", "__code"))


def link_sheet(rows: DataFrame, links: DataFrame) -> DataFrame:
    """New products and new colours in listing shape."""
    linked = with_link(rows, links, "link_name", "link_url", "link_price")
    return linked.select(
        "sku", F.coalesce(F.nullif("link_name", F.lit("")), "name").alias("product_name"),
        F.coalesce("link_url", F.lit("")).alias("product_url"),
        F.coalesce("link_price", F.lit("")).alias("price"),
        (F.col("link_url").isNotNull() | F.col("link_name").isNotNull()).alias("matched"))


def new_sheet(diff: DataFrame, scan: DataFrame) -> DataFrame:
    """New products with all they have, then known products with the colours they gained.

    ``kind`` is new_product or new_color; of the latter only key, name and the
    added colours are filled in.
    """
    fresh = rows_of_class(scan, diff, "new").withColumn("kind", F.lit("new_product"))
    gained = diff.filter("color_added").select(
        "sku", "name", F.array_join("added", " | ").alias("colors"), F.lit("new_color").alias("kind"))
    return fresh.unionByName(gained, allowMissingColumns=True)


def ready_sheet(diff: DataFrame, scan: DataFrame) -> DataFrame:
    """Scan rows ready to be imported: new products, and known ones with a new colour and all colours they now have."""
    if "__class" in scan.columns:
        rows = first_by_key(scan.filter("__class = 'common'"), "sku", "ord").drop("__class")
    else:
        gained = diff.filter("color_added").select(F.col("sku").alias("__sku"), F.array_join("colors_after", " | ").alias("__colors"))
        rows = first_by_key(_keyed(scan), "sku", "ord").join(gained, F.col("sku") == F.col("__sku"))
    known = rows.withColumn("colors", F.col("__colors")).drop("__sku", "__colors")
    return rows_of_class(scan, diff, "new").unionByName(known)


def image_urls_by_sku(scan: DataFrame) -> DataFrame:
    return (last_by_key(_keyed(scan).select("sku", "image_urls", "ord"), "sku", "ord")
            .select(F.col("sku").alias("__img_sku"), "image_urls"))


def with_image_urls(df: DataFrame, scan: DataFrame) -> DataFrame:
    return (df.join(image_urls_by_sku(scan), F.col("sku") == F.col("__img_sku"), "left")
            .withColumn("image_urls", F.coalesce("image_urls", F.lit("")))
            .drop("__img_sku"))


def new_manifest(scan: DataFrame, catalog: DataFrame, links: DataFrame, diff: DataFrame | None = None) -> DataFrame:
    """New products in manifest shape; a comparison at hand spares another look at the catalogue."""
    bare = scan.drop("image_urls")
    rows = new_rows(bare, catalog) if diff is None else rows_of_class(bare, diff, "new")
    linked = with_link(rows, links, "link_url")
    out = linked.select("sku", "name", F.col("regular_price").alias("price"),
                        F.coalesce("link_url", F.lit("")).alias("url"), "ord")
    return with_image_urls(out, scan) if "image_urls" in scan.columns else out


def update_manifest(diff: DataFrame, links: DataFrame) -> DataFrame:
    """Price rows and colour rows of the update, one row per kind of change."""
    price = diff.filter("price_changed").select(
        "sku", "name", F.lit("price").alias("change_type"),
        F.concat(thousands(F.col("old_price")), F.lit(" -> "),
                 thousands(F.col("new_price"))).alias("details"))
    color = diff.filter("color_added or color_removed").select(
        "sku", "name", F.lit("color").alias("change_type"),
        F.concat(F.lit("added: "), F.array_join("added", " | "),
                 F.lit("; removed: "), F.array_join("removed", " | ")).alias("details"))
    return (with_link(price.unionByName(color), links, "link_url")
            .withColumn("url", F.coalesce("link_url", F.lit(""))).drop("link_url"))


def image_subset(diff: DataFrame, scan: DataFrame, links: DataFrame) -> DataFrame:
    """Keys whose images are needed again: new products and new colours."""
    subset = diff.filter("change_class = 'new' or color_added").select(
        "sku", F.when(F.col("change_class") == "new", "new").otherwise("color").alias("reason"))
    linked = (with_link(subset, links, "link_url")
              .withColumn("url", F.coalesce("link_url", F.lit(""))).drop("link_url"))
    return with_image_urls(linked, scan).select("sku", "url", "image_urls", "reason")


def changed_keys(diff: DataFrame) -> DataFrame:
    return diff.filter("changed").select("sku")
