"""The import manifest and what importing its files does to a catalogue."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

# --- fixed values: the three kinds of import file ----------------------------
FILE_KINDS = {
    "full": ("full_catalog", "all_fields", 1),
    "new": ("new_products", "create_only", 2),
    "update": ("updated_products", "price|color_variants|stock", 3),
}
UPDATED_FIELDS = ("regular_price", "sale_price", "stock_quantity")


def file_counts(files: dict[str, DataFrame]) -> DataFrame:
    """Rows and distinct keys of every import file, each counted itself."""
    parts = [df.agg(F.count("*").alias("row_count"), F.count_distinct("sku").alias("sku_count"))
             .select(F.lit(kind).alias("kind"), "row_count", "sku_count")
             for kind, df in files.items()]
    counted = reduce(DataFrame.unionByName, parts)

    def field(i):
        out = None
        for kind, spec in FILE_KINDS.items():
            hit = F.col("kind") == kind
            out = F.when(hit, F.lit(spec[i])) if out is None else out.when(hit, F.lit(spec[i]))
        return out

    return counted.select("kind", field(0).alias("purpose"), field(1).alias("update_scope"),
                          field(2).alias("import_priority"), "sku_count", "row_count")


def import_manifest(counts: DataFrame, names: dict[str, str], images: Column, mode: str,
                    generated_at: Column) -> DataFrame:
    """One JSON document; it lists at most one entry per kind of file.

    The copy log grows with the number of pictures, so it is a table of its
    own (see ``sources.writers.write_manifest``) and not part of the document.
    """
    name = F.create_map(*[F.lit(x) for kv in names.items() for x in kv])
    entry = F.struct(
        "import_priority", F.try_element_at(name, F.col("kind")).alias("file_name"), "purpose",
        "update_scope", F.date_format(generated_at, "yyyy-MM-dd").alias("generated_date"),
        "sku_count", "row_count")
    return (counts.agg(F.array_sort(F.collect_list(entry)).alias("files"))
            .select(F.to_json(F.struct(
                F.date_format(generated_at, "yyyy-MM-dd'T'HH:mm:ss").alias("generated_at"),
                F.lit(mode).alias("mode"), "files", images.alias("images"))).alias("value")))


def files_to_run(kinds: set[str]) -> list[str]:
    """A full file runs alone; otherwise new before update."""
    if "full" in kinds:
        return ["full"]
    return [k for k in ("new", "update") if k in kinds]


def _matched(catalog: DataFrame, file: DataFrame, how: str) -> DataFrame:
    names = [c for c in file.columns if c != "sku"]
    right = file.select(F.col("sku").alias("__sku"), *[F.col(f"`{c}`").alias(f"__f_{c}") for c in names])
    return catalog.join(right, F.col("sku") == F.col("__sku"), how)


def apply_full(catalog: DataFrame, file: DataFrame, delete_missing: bool = False) -> DataFrame:
    """Every field of every file row; keys not in the file stay or go."""
    if delete_missing:
        return file
    kept = catalog.join(file.select("sku"), "sku", "left_anti")
    return kept.unionByName(file, allowMissingColumns=True)


def apply_new(catalog: DataFrame, file: DataFrame) -> DataFrame:
    """Only keys the catalogue lacks are created; known keys are skipped."""
    fresh = file.join(catalog.select("sku"), "sku", "left_anti")
    return catalog.unionByName(fresh, allowMissingColumns=True)


def apply_update(catalog: DataFrame, file: DataFrame, fields=UPDATED_FIELDS) -> DataFrame:
    """Price and stock of known keys, plus new colour variants of known parents."""
    fields = [f for f in fields if f in file.columns and f in catalog.columns]
    slim = file.select("sku", *fields)
    joined = _matched(catalog, slim, "left")
    updated = joined.select(*[
        F.when(F.col("__sku").isNotNull(), F.col(f"__f_{c}")).otherwise(F.col(f"`{c}`")).alias(c)
        if c in fields else F.col(f"`{c}`") for c in catalog.columns])
    if "parent_sku" not in file.columns or "parent_sku" not in catalog.columns:
        return updated
    parents = catalog.select(F.col("sku").alias("parent_sku")).distinct()
    variants = (file.filter(F.coalesce(F.col("parent_sku"), F.lit("")) != "")
                .join(catalog.select("sku"), "sku", "left_anti")
                .join(parents, "parent_sku", "left_semi"))
    return updated.unionByName(variants, allowMissingColumns=True)


def apply_manifest(catalog: DataFrame, files: dict[str, DataFrame],
                   delete_missing: bool = False) -> DataFrame:
    out = catalog
    for kind in files_to_run(set(files)):
        if kind == "full":
            out = apply_full(out, files[kind], delete_missing)
        elif kind == "new":
            out = apply_new(out, files[kind])
        else:
            out = apply_update(out, files[kind])
    return out


def import_log(catalog: DataFrame, file: DataFrame, kind: str) -> DataFrame:
    """What an import does with every file row."""
    known = catalog.select(F.col("sku").alias("__sku")).distinct()
    there = F.col("__sku").isNotNull()
    action = {"full": F.when(there, "update").otherwise("create"),
              "new": F.when(there, "skip").otherwise("create"),
              "update": F.when(there, "update").otherwise("skip")}[kind]
    return file.join(known, F.col("sku") == F.col("__sku"), "left").select("sku", action.alias("action"))
