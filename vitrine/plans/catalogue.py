"""Import catalogue end to end: products to parent and variant rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from vitrine.operators import export as X
from vitrine.operators.images import copy_statistics, find_sources
from vitrine.operators.scale import exploded


@dataclass(frozen=True)
class Catalogue:
    rows: DataFrame
    mapping: DataFrame
    products: DataFrame


def export_catalog(df: DataFrame, files: DataFrame, colors: DataFrame, names: DataFrame,
                   excluded: DataFrame | None = None, site: X.Site = X.Site(),
                   social: bool = False, use_general: bool = True, default_stock: str = "",
                   pattern: str | None = None, attributes_as_columns: bool = True) -> Catalogue:
    """Parent and variant rows in one ragged table, and the picture mapping."""
    products = X.with_pictures(X.products_for_export(df, colors, names, excluded), files, site, pattern)
    rows = X.parent_rows(products, site, social, default_stock).unionByName(
        X.child_rows(products, site, use_general, default_stock), allowMissingColumns=True)
    mapping = exploded(products, F.col("mapping"), "m").select("m.*")
    return Catalogue(X.attribute_columns(rows) if attributes_as_columns else rows, mapping, products)


def picture_gate(catalogue: Catalogue, files: DataFrame) -> DataFrame:
    """One row: nothing may be published while a mapped picture is missing."""
    stats = copy_statistics(find_sources(catalogue.mapping, files))
    return stats.withColumn("passed", F.col("missing") == 0)
