"""Raw product table to a clean one, as a single lazy chain."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from vitrine import vocab as V
from vitrine.functions import text as T
from vitrine.functions.colors import longest_phrase, standards_by_key
from vitrine.operators import dictionary as D
from vitrine.operators.categorize import Taxonomy, categorize
from vitrine.operators.columns import copy_where_present, drop_unusable
from vitrine.operators.pricing import apply_brackets
from vitrine.operators.scale import by_distinct_values, exploded, spread


@dataclass(frozen=True)
class Rules:
    """Reference tables of one run; a missing one skips its step."""
    standard_colors: tuple = V.STANDARD_COLORS
    price_rules: DataFrame | None = None
    taxonomy: Taxonomy = Taxonomy()
    words: DataFrame | None = None
    stock_quantity: int = 10
    extra_discount: float = 0.0


@dataclass(frozen=True)
class Standardized:
    table: DataFrame
    unknown_colors: DataFrame
    unknown_words: DataFrame
    metrics: DataFrame


def raw_colors(cell):
    """Colour words of a cell: plain-marker and sold-out words dropped."""
    words = F.transform(T.split_values(cell, "|,-"), lambda c: T.drop_word(c, V.PLAIN_WORD))
    kept = F.filter(words, lambda c: (c != "") & (c != V.OUT_OF_STOCK_WORD))
    return F.transform(kept, T.color_text)


def standardize_colors(df: DataFrame, standards=V.STANDARD_COLORS, colors: str = "colors",
                       seen: DataFrame | None = None) -> DataFrame:
    """``colors_std``: matched standard colours, unmatched ones as written.

    ``color_misses`` keeps the unmatched words for the report.  ``seen`` is
    where to look for distinct cells, if not in ``df`` itself.
    """
    keys = standards_by_key(standards)
    longest = max(map(len, keys), default=0)

    def matched(cell):
        pairs = F.transform(raw_colors(T.nullify_blank(cell)), lambda c: F.struct(
            c.alias("raw"), longest_phrase(c, keys, longest).alias("std")))
        return T.let(pairs, lambda ps: F.when(ps.isNotNull(), F.struct(
            F.array_distinct(F.transform(ps, lambda p: F.coalesce(p["std"], p["raw"]))).alias("std"),
            F.transform(F.filter(ps, lambda p: p["std"].isNull()), lambda p: p["raw"]).alias("misses"))))
    return (by_distinct_values(spread(df), colors, matched, "__matched", df if seen is None else seen)
            .withColumn("colors_std", F.col("__matched.std")).withColumn("color_misses", F.col("__matched.misses"))
            .drop("__matched"))


def unknown_color_report(df: DataFrame, name: str = "name", order: str = "ord") -> DataFrame:
    misses = exploded(df, F.col("color_misses"), "color", name, order)
    return D.term_report(misses, "color", name, order)


def tidy_usages(df: DataFrame, columns=("usage", "suitable_for")) -> DataFrame:
    return df.withColumns({c: T.unify_separators(c) for c in columns if c in df.columns})


def standard_color_names(entries: DataFrame) -> tuple:
    """Standard colours of a mapping table; like every vocabulary they become part of the plan."""
    return tuple(r.term for r in entries.orderBy("ord").collect())


def standardize(raw: DataFrame, rules: Rules) -> Standardized:
    source, raw = raw, spread(raw)
    kept = drop_unusable(raw, "name", "regular_price")
    table = standardize_colors(kept.withColumn("stock", F.lit(rules.stock_quantity)),
                               rules.standard_colors, seen=source)
    table = tidy_usages(copy_where_present(table, "model", "sku"))
    if rules.price_rules is not None:
        table = apply_brackets(table, rules.price_rules, extra_discount=rules.extra_discount)
    else:
        table = table.withColumns({"price_updated": F.lit(False), "discounted": F.lit(False)})
    table = categorize(table, rules.taxonomy)
    texts = [f.name for f in table.schema.fields
             if f.dataType.typeName() == "string" and f.name not in ("sku", "model")]
    translated = table.withColumn("__words", F.lit(0))
    unknown_words = table.select(F.lit("").alias("token")).filter(F.lit(False))
    if rules.words is not None:
        unknown_words = D.unknown_tokens(table, texts, rules.words)
        translated = D.translate_columns(table, texts, rules.words, counted="__words")
    metrics = translated.agg(
        F.count("*").alias("rows_kept"), F.count_if(F.size("colors_std") > 0).alias("rows_with_colors"),
        F.count_if("price_updated").alias("prices_updated"),
        F.count_if("discounted").alias("discounts_applied"),
        F.count_if(F.col("category") != "").alias("rows_categorized"),
        F.count_if(F.col("sale_tag") != "").alias("rows_tagged"),
        F.coalesce(F.sum("__words"), F.lit(0)).alias("words_translated"))
    before = raw.agg(F.count("*").alias("rows_read"))
    metrics = before.join(metrics, F.lit(True)).withColumn(
        "rows_removed", F.col("rows_read") - F.col("rows_kept"))
    return Standardized(translated.drop("__words", "color_misses"),
                        unknown_color_report(table), unknown_words, metrics)
