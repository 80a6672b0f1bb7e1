"""Shop tables derived from the order tables, in Spark and in SQL.

One line item is one observed offer of a product: part and supplier make the
key, the line makes the row order, the ship date decides whether the row is
part of the old catalogue or of the new scan.  Both derivations cover the
whole tables and stay independent of the operators under test.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

# The first observation day that belongs to the new scan.
SCAN_FROM = "1998-06-01"
KINDS = ("کیف پول", "کوله\u200cپشتی", "کیف زنانه", "کیف مردانه", "چمدان", "کیف ساک", "کیف")
STYLES = {"A": "روزمره", "N": "اداری", "R": "دستی"}
USAGES = {"A": "daily, sport", "N": "office - formal", "R": "کیف باشگاه; travel"}
COLORS = ("مشکی", "سفید", "آبی", "سرمه\u200cای", "قرمز", "قهوه\u200cای تیره", "Sky Blue", "طوسی ساده")
SITE = "http://shop.example/p/"
E = "\u200c"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def pick(words, index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(w) for w in words]), index.cast("int") + 1)


def pick_sql(words, index: str) -> str:
    return "([" + ", ".join(f"'{w}'" for w in words) + f"])[CAST({index} AS BIGINT) + 1]"


def case(column: str, words: dict) -> Column:
    out = None
    for k, v in words.items():
        out = F.when(F.col(column) == k, v) if out is None else out.when(F.col(column) == k, v)
    return out


def case_sql(column: str, words: dict) -> str:
    return f"CASE {column} " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in words.items()) + " END"


def offers(spark: SparkSession, folder: str) -> DataFrame:
    line = F.col("l_linenumber")
    quantity = F.col("l_quantity").cast("int")
    code = (F.col("l_partkey") + 1000).cast("string")
    is_old = F.col("l_shipdate") < F.lit(SCAN_FROM).cast("timestamp")
    cell = F.concat(pick(COLORS, line % 8), F.lit(" | "), pick(COLORS, quantity % 8),
                    F.when(F.col("l_tax") >= 0.05, F.concat(F.lit(", "), pick(COLORS, (line + 3) % 8)))
                    .otherwise(""))
    # Unit prices in steps of 5000, so that some offers keep their price.
    price = F.floor(F.col("l_extendedprice") / F.col("l_quantity") / 500).cast("bigint") * 5000
    discounted = F.floor(price * (1 - F.col("l_discount"))).cast("bigint")
    sale = (F.when(F.col("l_discount") < 0.03, "0").when(F.col("l_discount") < 0.05, None)
            .when(F.col("l_discount") < 0.06, "nan")
            .otherwise(F.concat(discounted.cast("string"), F.lit(".0"))))
    return table(spark, folder, "lineitem").select(
        F.concat_ws("-", code, F.col("l_suppkey").cast("string")).alias("sku"),
        (F.col("l_orderkey") * 10 + line).alias("ord"), is_old.alias("is_old"), code.alias("model"),
        F.concat_ws(" ", pick(KINDS, line - 1), case("l_returnflag", STYLES), F.lit("کد"), code)
        .alias("name"),
        price.cast("string").alias("regular_price"),
        sale.alias("sale_price"),
        F.when(is_old, F.replace(cell, F.lit(E), F.lit(""))).otherwise(cell).alias("colors"),
        case("l_returnflag", USAGES).alias("usage"),
        F.when(F.col("l_linestatus") == "F", "مجلسی / مهمانی").otherwise("ceremonial،daily")
        .alias("suitable_for"),
        F.when(F.col("l_tax") == 0.08, "OUT_OF_STOCK").otherwise("OK").alias("status"),
        F.concat(F.lit(SITE), code, F.lit("/"), line.cast("string"), F.lit(".jpg?x=1#f"))
        .alias("image_urls"))


_PRICE = "CAST(floor(l_extendedprice / l_quantity / 500) AS BIGINT) * 5000"
_DISCOUNTED = f"CAST(floor({_PRICE} * (1 - l_discount)) AS BIGINT)"
_CELL = (f"{pick_sql(COLORS, 'l_linenumber % 8')} || ' | ' || "
         f"{pick_sql(COLORS, 'CAST(l_quantity AS BIGINT) % 8')} || "
         f"CASE WHEN l_tax >= 0.05 THEN ', ' || {pick_sql(COLORS, '(l_linenumber + 3) % 8')} ELSE '' END")
OFFERS_SQL = f"""
offers AS (
  SELECT CAST(l_partkey + 1000 AS VARCHAR) || '-' || CAST(l_suppkey AS VARCHAR) AS sku,
         l_orderkey * 10 + l_linenumber AS ord,
         l_shipdate < TIMESTAMP '{SCAN_FROM} 00:00:00' AS is_old,
         CAST(l_partkey + 1000 AS VARCHAR) AS model,
         {pick_sql(KINDS, 'l_linenumber - 1')} || ' ' || {case_sql('l_returnflag', STYLES)}
           || ' کد ' || CAST(l_partkey + 1000 AS VARCHAR) AS name,
         CAST({_PRICE} AS VARCHAR) AS regular_price,
         CASE WHEN l_discount < 0.03 THEN '0' WHEN l_discount < 0.05 THEN NULL
              WHEN l_discount < 0.06 THEN 'nan'
              ELSE CAST({_DISCOUNTED} AS VARCHAR) || '.0' END AS sale_price,
         CASE WHEN l_shipdate < TIMESTAMP '{SCAN_FROM} 00:00:00'
              THEN replace({_CELL}, '{E}', '') ELSE {_CELL} END AS colors,
         {case_sql('l_returnflag', USAGES)} AS usage,
         CASE WHEN l_linestatus = 'F' THEN 'مجلسی / مهمانی' ELSE 'ceremonial،daily' END AS suitable_for,
         CASE WHEN l_tax = 0.08 THEN 'OUT_OF_STOCK' ELSE 'OK' END AS status,
         '{SITE}' || CAST(l_partkey + 1000 AS VARCHAR) || '/' || CAST(l_linenumber AS VARCHAR)
           || '.jpg?x=1#f' AS image_urls
  FROM lineitem)"""


def scan(spark, folder) -> DataFrame:
    return offers(spark, folder).filter("not is_old")


def catalog(spark, folder) -> DataFrame:
    return offers(spark, folder).filter("is_old")


def variants(spark, folder) -> DataFrame:
    """One variant row per colour word of every catalogue row."""
    words = F.split(F.regexp_replace("colors", " ?[|,] ?", "|"), r"\|")
    return (catalog(spark, folder).select("sku", "ord", F.explode(words).alias("color"))
            .select(F.col("sku").alias("parent_sku"), "color",
                    F.concat_ws("-", "sku", F.lower(F.replace("color", F.lit(" "), F.lit("_"))),
                                F.col("ord").cast("string")).alias("sku"), "ord"))


VARIANTS_SQL = """
variants AS (
  SELECT sku AS parent_sku, color, ord,
         sku || '-' || lower(replace(color, ' ', '_')) || '-' || CAST(ord AS VARCHAR) AS sku
  FROM (SELECT sku, ord, unnest(string_split(regexp_replace(colors, ' ?[|,] ?', '|', 'g'), '|')) AS color
        FROM offers WHERE is_old))"""


def listing(spark, folder) -> DataFrame:
    """Listing rows of the parts, in the shape a shop shows them."""
    key = F.col("p_partkey")
    code = (key + 1000).cast("string")
    price = F.floor(F.col("p_retailprice") * 100).cast("bigint") + 10000
    return table(spark, folder, "part").select(
        key.alias("ord"),
        F.concat_ws(" ", "p_name", F.lit("کد"), F.translate(code, "0123456789", "۰۱۲۳۴۵۶۷۸۹"),
                    F.format_string("%,d", price), F.lit("تومان")).alias("product_name"),
        F.concat(F.lit(SITE), code, F.lit("?x=1#f")).alias("product_url"),
        F.concat(F.format_string("%,d", price), F.lit(" تومان")).alias("price"))


PRICE_SQL = "CAST(floor(p_retailprice * 100) AS BIGINT) + 10000"
LISTING_SQL = f"""
listing AS (
  SELECT p_partkey AS ord,
         p_name || ' کد ' || translate(CAST(p_partkey + 1000 AS VARCHAR), '0123456789', '۰۱۲۳۴۵۶۷۸۹')
           || ' ' || format('{{:,}}', {PRICE_SQL}) || ' تومان' AS product_name,
         '{SITE}' || CAST(p_partkey + 1000 AS VARCHAR) || '?x=1#f' AS product_url,
         format('{{:,}}', {PRICE_SQL}) || ' تومان' AS price
  FROM part)"""


def positive_sql(c: str) -> str:
    n = f"TRY_CAST({c} AS DOUBLE)"
    return f"CASE WHEN NOT isnan({n}) AND {n} >= 1 THEN CAST(floor({n}) AS BIGINT) END"


def effective_sql(regular: str, sale: str) -> str:
    return f"COALESCE({positive_sql(sale)}, {positive_sql(regular)})"


def color_set_sql(cell: str) -> str:
    return (f"list_sort(list_distinct(list_filter(list_transform(regexp_split_to_array({cell}, '[-|,]'), "
            f"lambda x: trim(regexp_replace(x, '\\p{{Cf}}', '', 'g'))), lambda x: x <> '')))")


# One row per key of either side, as the comparison sees it.
DIFF_SQL = f"""
firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY is_old, sku ORDER BY ord) AS rn
           FROM offers) WHERE rn = 1),
old_side AS (SELECT sku, name, {effective_sql('regular_price', 'sale_price')} AS price,
             {color_set_sql('colors')} AS colors FROM firsts WHERE is_old),
new_side AS (SELECT sku, name, {effective_sql('regular_price', 'sale_price')} AS price,
             {color_set_sql('colors')} AS colors FROM firsts WHERE NOT is_old),
diff AS (SELECT COALESCE(n.sku, o.sku) AS sku, COALESCE(n.name, o.name) AS name,
           CASE WHEN o.sku IS NULL THEN 'new' WHEN n.sku IS NULL THEN 'removed' ELSE 'common' END AS change_class,
           o.price AS old_price, n.price AS new_price,
           COALESCE(o.price <> n.price, FALSE) AS price_changed,
           o.colors AS colors_before, n.colors AS colors_after,
           list_sort(list_filter(n.colors, lambda x: NOT list_contains(o.colors, x))) AS added,
           list_sort(list_filter(o.colors, lambda x: NOT list_contains(n.colors, x))) AS removed
         FROM new_side n FULL OUTER JOIN old_side o ON n.sku = o.sku)"""
