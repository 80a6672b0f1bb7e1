"""The import catalogue: parent rows, variant rows, attributes, texts."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from vitrine import vocab as V
from vitrine.functions import text as T
from vitrine.operators.columns import require_columns
from vitrine.operators.dictionary import translate_color, translate_name
from vitrine.operators.images import assign_images, variant_images
from vitrine.operators.scale import exploded, first_by_key, spread


@dataclass(frozen=True)
class Site:
    """Addresses and wording of the shop the catalogue is made for."""
    images_url: str = "https://shop.example/images/"
    product_url: str = "https://shop.example/product/"
    shop_name: str = "فروشگاه"
    extension: str = ".webp"


# Attribute slug -> product column it is read from.
ATTRIBUTE_COLUMNS = {
    "application": "usage", "bag-compartments": "compartments", "bag-type": "bag_type",
    "closure-style": "closure", "lining-material": "lining", "long-strap": "long_strap",
    "number-of-inside-pockets": "inner_pockets", "number-of-outside-pockets": "outer_pockets",
    "number-of-straps": "strap_count", "outer-material": "outer_material",
    "suitable-for": "suitable_for",
}


def expand_colors(df: DataFrame, colors: str = "colors", out: str = "color") -> DataFrame:
    """One row per colour of a product; a product without colours keeps one."""
    values = T.split_values(T.plain_text(T.nullify_blank(colors)))
    # A column of its own: inside the generator it would be worked out for every use.
    return (df.withColumn("__values", values)
            .select("*", F.posexplode_outer("__values").alias("color_pos", out)).drop("__values"))


def variant_rows(df: DataFrame, colors_dict: DataFrame) -> DataFrame:
    """Distinct (product, colour) rows with English colour and variant key."""
    kept = [c for c in ("sku", "colors", "regular_price", "sale_price", "stock", "ord")
            if c in df.columns]
    rows = expand_colors(df.select(*kept).filter("sku is not null")) \
        .withColumn("color", F.coalesce("color", F.lit(""))) \
        .withColumn("color_pos", F.coalesce("color_pos", F.lit(0)))
    once = first_by_key(rows.drop("colors"), ["sku", "color"], ["ord", "color_pos"])
    return (translate_color(once, "color", colors_dict)
            .withColumn("variant_sku", F.concat_ws("-", "sku", "color_en")))


def listed_keys(excluded: DataFrame) -> DataFrame:
    """Distinct keys of an exclusion list, as ``__x``, to be joined by sorting.

    A list that is exploded from a small table is planned by the size of that
    table, and then broadcast whatever it grows to.
    """
    return excluded.select(F.col("sku").alias("__x")).distinct().hint("merge")


def drop_excluded(variants: DataFrame, excluded: DataFrame) -> DataFrame:
    """Variants whose key is not on the exclusion list (sku)."""
    return variants.join(listed_keys(excluded), F.col("variant_sku") == F.col("__x"), "left_anti")


def fully_excluded(variants: DataFrame, excluded: DataFrame) -> DataFrame:
    """Products that lose every variant."""
    return (variants.join(listed_keys(excluded), F.col("variant_sku") == F.col("__x"), "left")
            .groupBy("sku").agg(F.bool_and(F.col("__x").isNotNull()).alias("gone"))
            .filter("gone").select("sku"))


def attribute_map(df: DataFrame, colors: Column, columns=ATTRIBUTE_COLUMNS) -> Column:
    """slug -> value of the attributes a product has."""
    def entry(slug, value):
        return F.struct(F.lit(slug).alias("key"), value.alias("value"))

    dims = [F.col(c) if c in df.columns else F.lit(None).cast("string")
            for c in ("length", "width", "depth")]
    entries = [entry("color", colors)]
    entries += [entry(s, T.plain_text(T.nullify_blank(c))) for s, c in columns.items()
                if c in df.columns]
    entries.append(entry("dimention", F.nullif(T.dimension_text(*dims), F.lit(""))))
    return F.map_from_entries(F.filter(F.array(*entries), lambda e: e["value"].isNotNull()))


def attribute_columns(df: DataFrame, slugs=None) -> DataFrame:
    """The map as ``attribute:<slug>`` and ``attribute_name:<slug>`` columns.

    The slugs are named up front; no pass over the data looks for them.
    """
    slugs = list(V.ATTRIBUTE_LABELS) if slugs is None else slugs
    out = df
    for slug in slugs:
        value = F.try_element_at("attributes", F.lit(slug))
        out = (out.withColumn(f"attribute:{slug}", value)
               .withColumn(f"attribute_name:{slug}", F.when(
                   value.isNotNull(), V.ATTRIBUTE_LABELS.get(slug, slug))))
    return out.drop("attributes")


def seo_texts(name: Column, model: Column, colors: Column, short: Column, name_en: Column,
              site: Site) -> dict[str, Column]:
    keyword = F.concat_ws(" ", name, F.lit(V.CODE_WORD), model)
    some = F.array_join(F.slice(colors, 1, 3), V.AND_WORD)
    made = T.filled(V.SEO_TEXT, keyword, some, F.lit(site.shop_name))
    description = T.truncate(F.when(short != "", short).otherwise(made), 155)
    return {
        "meta:_yoast_wpseo_title": T.truncate(keyword, 60),
        "meta:_yoast_wpseo_metadesc": description,
        "meta:_yoast_wpseo_focuskw": keyword,
        "meta:_yoast_wpseo_canonical": F.concat(
            F.lit(site.product_url), name_en, F.lit("-"), T.model_slug(model), F.lit("/")),
    }


def social_texts(name: Column, model: Column, description: Column) -> dict[str, Column]:
    keyword = F.concat_ws(" ", name, F.lit(V.CODE_WORD), model)
    return {
        "meta:_yoast_wpseo_opengraph-title": T.truncate(
            F.concat(keyword, F.lit(V.SOCIAL_TAIL)), 95),
        "meta:_yoast_wpseo_opengraph-description": T.truncate(description, 200),
        "meta:_yoast_wpseo_twitter-title": T.truncate(keyword, 70),
        "meta:_yoast_wpseo_twitter-description": T.truncate(description, 200),
    }


def described(df: DataFrame, name="name", model="model", colors="colors",
              material="outer_material", usage="usage") -> DataFrame:
    """Rule-based short and full description where a product has none."""
    n, m, c, x, u = (T.render_text(col) if col in df.columns else F.lit("")
                     for col in (name, model, colors, material, usage))

    short = T.filled(V.SHORT_TEXT, n, m, x, u, c)
    full = T.filled(V.FULL_TEXT, n, m, u, x, c, n)

    def where_blank(column, made):
        if column not in df.columns:
            return made
        return F.when(F.col(column).isNull() | (F.col(column) == ""), made).otherwise(F.col(column))

    return df.withColumns({"short_description": where_blank("short_description", short),
                           "description": where_blank("description", full)})


def packaged_texts(name: Column, model: Column, colors: Column, short: Column,
                   full: Column) -> dict[str, Column]:
    """Title, descriptions and keyword cut to the lengths a shop accepts."""
    first = T.trim_any(F.split_part(colors, F.lit(","), F.lit(1)))
    meta = T.filled(V.META_TEXT, name, model, first)
    return {"title": T.truncate(F.concat(name, F.lit(" "), model, F.lit(V.TITLE_TAIL)), 60),
            "short_description": T.truncate(short, 300), "description": full,
            "meta_description": T.truncate(meta, 155),
            "focus_keyword": F.concat_ws(" ", name, F.lit(V.CODE_WORD), model)}


def products_for_export(df: DataFrame, colors_dict: DataFrame, names_dict: DataFrame,
                        excluded: DataFrame | None = None) -> DataFrame:
    """One row per product: first-row values, distinct colours, kept variants."""
    require_columns(df, "sku", "name", "model", "colors", "ord")
    df = spread(df).withColumn("sku", T.nullify_blank("sku")).filter("sku is not null")
    variants = variant_rows(df, colors_dict)
    every = F.struct(*[c for c in ("ord", "color_pos", "color", "color_en", "variant_sku",
                                   "regular_price", "sale_price", "stock") if c in variants.columns])
    if excluded is None:
        tagged = variants.withColumn("kept", F.lit(True))
    else:
        tagged = (variants.join(listed_keys(excluded), F.col("variant_sku") == F.col("__x"), "left")
                  .withColumn("kept", F.col("__x").isNull()).drop("__x"))
    grouped = tagged.groupBy("sku").agg(
        F.array_sort(F.collect_list(every)).alias("all_variants"),
        F.array_sort(F.collect_list(F.when(F.col("kept"), every))).alias("variants"))
    first = first_by_key(df, "sku", "ord").withColumn(
        "clean_name", T.strip_code(T.plain_text("name"))).withColumn(
        "model_text", T.render_text(T.trim_any(F.col("model").cast("string"))))
    named = translate_name(first, "clean_name", names_dict)
    return (named.join(grouped, "sku").filter(F.size("variants") > 0)
            .withColumn("color_list", F.filter(F.transform(
                "all_variants", lambda v: v["color"]), lambda c: c != ""))
            .withColumn("colors_en", F.transform(F.filter(
                "all_variants", lambda v: v["color"] != ""), lambda v: v["color_en"])))


def with_pictures(products: DataFrame, files: DataFrame, site: Site,
                  pattern: str | None = None) -> DataFrame:
    asked = products.select("sku", F.col("clean_name").alias("name_fa"), "name_en",
                            F.col("model_text").alias("model"), F.col("colors_en").alias("colors"))
    extra = {"pattern": pattern} if pattern else {}
    assigned = assign_images(asked, files, site.extension, **extra).select(
        F.col("sku").alias("__s"), "main_image", "color_images", "general_images", "gallery",
        "mapping")
    return products.join(assigned, F.col("sku") == F.col("__s"), "left").drop("__s")


def parent_rows(products: DataFrame, site: Site = Site(), social: bool = False,
                default_stock: str = "") -> DataFrame:
    n, m = F.col("clean_name"), F.col("model_text")

    def cell(c):
        return T.plain_text(T.render_text(c)) if c in products.columns else F.lit("")

    short = cell("short_description")
    texts = seo_texts(n, m, F.col("color_list"), short, F.col("name_en"), site)
    if social:
        texts |= social_texts(n, m, texts["meta:_yoast_wpseo_metadesc"])
    files = F.transform("gallery", lambda g: g["file"])
    alts = F.transform("gallery", lambda g: g["alt"])
    tag = T.plain_text(T.nullify_blank("sale_tag")) if "sale_tag" in products.columns else F.lit(None)
    return products.select(
        F.lit("product").alias("post_type"),
        F.concat_ws(" ", n, F.lit(V.CODE_WORD), T.persian_digits(m)).alias("post_title"),
        F.lit("publish").alias("post_status"), "sku", F.lit("").alias("parent_sku"),
        "regular_price", "sale_price", F.lit("yes").alias("manage_stock"),
        F.lit(default_stock).alias("stock_quantity"), cell("category").alias("categories"),
        cell("description").alias("description"), short.alias("short_description"),
        *[c.alias(k) for k, c in texts.items()],
        F.concat(F.lit(site.images_url), "main_image").alias("images"),
        F.array_join(F.transform(files, lambda f: F.concat(F.lit(site.images_url), f)), "|")
        .alias("gallery_images"),
        F.array_join(alts, "|").alias("gallery_image_alt"),
        F.array_join(files, "|").alias("image_filename"), F.lit("").alias("image_titles"),
        F.get(alts, F.lit(0)).alias("image_alt"),
        F.coalesce(tag, F.lit("")).alias("sale_tag"),
        attribute_map(products, F.array_join("color_list", "|")).alias("attributes"))


def child_rows(products: DataFrame, site: Site = Site(), use_general: bool = True,
               default_stock: str = "") -> DataFrame:
    images = variant_images(F.transform("variants", lambda v: v["color_en"]),
                            F.col("color_images"), F.col("general_images"), F.col("main_image"),
                            use_general)
    one = exploded(products, F.arrays_zip(F.col("variants").alias("v"), images.alias("image")), "z",
                   "sku", "clean_name", "model_text", pos="pos")
    v = F.col("z.v")
    alt = F.concat(F.concat_ws(" ", "clean_name", F.lit(V.CODE_WORD), T.persian_digits("model_text")),
                   F.lit(" - "), v["color"])
    has_stock = "stock" in one.select("z.v.*").columns
    stock = F.coalesce(T.nullify_blank(v["stock"]), F.lit(default_stock)) if has_stock \
        else F.lit(default_stock)
    blank = F.lit("")
    return one.select(
        F.lit("product_variation").alias("post_type"), blank.alias("post_title"),
        F.lit("publish").alias("post_status"), v["variant_sku"].alias("sku"),
        F.col("sku").alias("parent_sku"), v["regular_price"].alias("regular_price"),
        v["sale_price"].alias("sale_price"), F.lit("yes").alias("manage_stock"),
        stock.alias("stock_quantity"), blank.alias("categories"), blank.alias("description"),
        blank.alias("short_description"),
        F.concat(F.lit(site.images_url), F.col("z.image")).alias("images"),
        blank.alias("gallery_images"), blank.alias("gallery_image_alt"),
        F.col("z.image").alias("image_filename"), alt.alias("image_titles"),
        alt.alias("image_alt"), blank.alias("sale_tag"),
        F.create_map(F.lit("color"), v["color"]).alias("attributes"))


def split_by_manifest(catalog: DataFrame, manifest: DataFrame, with_variants: bool = True) -> DataFrame:
    """Catalogue rows of the listed products, variants included by default."""
    wanted = manifest.select(F.col("sku").alias("__m")).distinct()
    key = F.coalesce(F.nullif("parent_sku", F.lit("")), "sku") if with_variants else F.col("sku")
    return catalog.join(wanted, key == F.col("__m"), "left_semi")
