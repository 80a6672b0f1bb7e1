"""Sources and sinks as round trips: written to the shared folder, read back, compared."""

from __future__ import annotations

import uuid

from pyspark.sql import Window, functions as F

from vitrine.functions.prices import render_number
from vitrine.operators import columns as R
from vitrine.session import shared_folder
from vitrine.showcase import shop as S
from vitrine.sources import readers as I
from vitrine.sources import writers as W


def _fresh(spark, name):
    return f"{shared_folder(spark).rstrip('/')}/vitrine-{name}-{uuid.uuid4().hex}"


def listing_file(spark, d):
    """A listing written as CSV, quotes and commas in its cells, and read back."""
    rows = S.table(spark, d, "part").select(
        F.col("p_partkey").alias("No"), F.concat(F.lit('"'), "p_name", F.lit('", '), "p_brand").alias("Product Name"),
        F.concat(F.lit("https://shop.example/"), "p_partkey").alias("Product URL"),
        F.when(F.col("p_size") > 10, F.col("p_size").cast("string")).alias("Price"))
    path = _fresh(spark, "listing") + ".csv"
    W.write_csv(rows, path)
    return I.read_listing(spark, path).select("No", "product_name", "product_url", "price")


def seed_file(spark, d):
    """Seed addresses of a CSV: trimmed, blanks dropped."""
    urls = S.table(spark, d, "pages").select("page_id", F.when(F.col("page_id") % 5 == 0, F.lit("  ")).otherwise(
        F.concat(F.lit(" "), "url", F.lit("  "))).alias("URL"))
    path = _fresh(spark, "seeds") + ".csv"
    W.write_csv(urls, path, bom=False)
    return I.seed_urls(I.read_table(spark, path)).groupBy("url").agg(F.count("*").alias("rows"))


def catalog_file(spark, d):
    """A catalogue of products and variants, split on reading."""
    part = S.table(spark, d, "part")
    rows = part.select(F.lit("product").alias("post_type"), F.col("p_name").alias("post_title"),
                       F.concat(F.lit(" "), "p_partkey").alias("sku"), F.lit(None).cast("string").alias("parent_sku"),
                       F.lit("a|b").alias("attribute:color")).unionByName(part.select(
                           F.lit(" product_variation").alias("post_type"), F.lit("").alias("post_title"),
                           F.concat("p_partkey", F.lit("-a")).alias("sku"), F.concat("p_partkey", F.lit(" ")).alias("parent_sku"),
                           F.lit("a").alias("attribute:color")))
    path = _fresh(spark, "catalog")
    rows.write.parquet(path)
    products, variants = I.read_catalog(spark, path)
    return products.select("sku", "parent_sku", F.col("name").alias("text"), "colors").unionByName(
        variants.select("sku", "parent_sku", F.lit("variant").alias("text"), F.col("color").alias("colors")))


def dictionary_file(spark, d):
    """Persian/English table from CSV; rows without one side are left out."""
    rows = S.table(spark, d, "part").select(F.col("p_name").alias("Persian"), F.when(F.col("p_size") > 5, F.col("p_type"))
                                            .otherwise("").alias("English"), F.lit("n").alias("Notes"))
    path = _fresh(spark, "colors") + ".csv"
    W.write_csv(rows, path)
    return I.read_dictionary(spark, path).groupBy("term", "translation").agg(F.count("*").alias("rows"))


def word_index_file(spark, d):
    rows = S.table(spark, d, "part").select(F.concat("p_brand", F.lit(" "), "p_partkey").alias("en"), F.col("p_type").alias("fa"))
    path = _fresh(spark, "words") + ".csv"
    W.write_csv(rows, path)
    return I.read_word_index(spark, path).select("term", "translation")


def price_rule_file(spark, d):
    """Brackets by their header words; a cell that is no number counts 0."""
    rows = S.table(spark, d, "part").select(
        F.col("p_partkey").alias("مقدار_از"), (F.col("p_partkey") + 10).alias("مقدار_تا"),
        F.when(F.col("p_size") > 9, F.col("p_size").cast("string")).otherwise("x").alias("درصد_افزایش"),
        F.lit("").alias("درصد_تخفیف"))
    path = _fresh(spark, "rules") + ".csv"
    W.write_csv(rows, path)
    return I.read_price_rules(spark, path).drop("rule_ord")


def excluded_file(spark, d):
    rows = S.table(spark, d, "part").select(F.when(F.col("p_size") > 25, F.concat(F.lit(" "), "p_partkey", F.lit("-red ")))
                                            .otherwise("").alias("sku"), "p_partkey")
    path = _fresh(spark, "excluded")
    W.write_lines(rows, "sku", ["p_partkey"], path)
    return I.excluded_keys(spark, path)


def sorted_lines(spark, d):
    """Lines of all part files together, in the order asked for."""
    rows = S.table(spark, d, "orders").select(F.col("o_orderkey").cast("string").alias("sku"), (-F.col("o_custkey")).alias("k"), "o_orderkey")
    path = _fresh(spark, "lines")
    W.write_lines(rows, "sku", ["k", "o_orderkey"], path)
    lines = spark.read.text(path).select("value", F.element_at(F.split("_metadata.file_name", "-"), 2).cast("int").alias("part"))
    ends = lines.join(rows, F.col("value") == F.col("sku")).groupBy("part").agg(
        F.min(F.struct("k", "o_orderkey")).alias("low"), F.max(F.struct("k", "o_orderkey")).alias("high"), F.count("*").alias("n"))
    after = F.lead("low").over(Window.orderBy("part"))
    return ends.withColumn("ok", F.coalesce(after > F.col("high"), F.lit(True))).agg(
        F.sum("n").alias("lines"), F.bool_and("ok").alias("in_order"))


def expected_key_file(spark, d):
    """Numeric prefixes of a key column, cut to a listed scope."""
    rows = S.table(spark, d, "part").select(F.concat(F.lit(" "), "p_partkey", F.lit("-black")).alias("SKU "))
    path = _fresh(spark, "keys") + ".csv"
    W.write_csv(rows, path)
    keys = I.expected_keys(I.read_table(spark, path))
    return I.keys_to_import(keys, "7, 8-red, x, 99999999, 12")


def manifest_file(spark, d):
    rows = S.table(spark, d, "part").select(F.col("p_partkey").alias("sku"), F.when(F.col("p_size") > 20, F.col("p_name")).alias("name"),
                                            F.when(F.col("p_size") > 3, F.concat(F.lit(" http://x.example/"), "p_partkey")).alias("url"))
    path = _fresh(spark, "manifest")
    W.write_manifests(rows, rows.limit(0), rows.limit(0), path)
    return I.manifest_urls(I.tidy_headers(spark.read.csv(path + "/new_products_list", header=True)))


def picture_folder(spark, d):
    """Files of a folder by name only: their numbers and folders."""
    rows = S.table(spark, d, "part").select(F.concat((F.col("p_partkey") % 7).cast("string"), F.lit("a")).alias("k"), "p_name")
    path = _fresh(spark, "pictures")
    rows.write.partitionBy("k").option("compression", "none").csv(path)
    files = I.inventory(spark, path, "*.csv")
    return files.select(F.regexp_extract("path", r"k=([0-9]+)a/", 1).alias("product_no"), (F.col("length") > 0).alias("filled")).distinct()


def image_files(spark, d):
    """Pictures of a tree by their extension, with their folder; other files are left out."""
    rows = S.table(spark, d, "part").select(F.concat((F.col("p_partkey") % 7).cast("string"), F.lit("x")).alias("k"), "p_name")
    path = _fresh(spark, "images")
    for ending in ("jpg", "PNG", "txt"):
        rows.write.partitionBy("k").option("compression", "none").option("extension", ending).mode("append").csv(path)
    found = I.image_inventory(spark, path)
    return found.select("folder", F.lower(F.regexp_extract("path", r"\.([^.]+)$", 1)).alias("ending"), "product_no").distinct()


def term_log(spark, d):
    """Terms of '[time] term -> suggestion' lines, once each."""
    lines = S.table(spark, d, "part").select(F.concat(F.lit("[10:00] "), "p_name", F.when(F.col("p_size") % 2 == 0, F.lit(" → x"))
                                                      .otherwise(" -> y")).alias("value"), "p_partkey").unionByName(
        S.table(spark, d, "region").select(F.lit("no arrow here").alias("value"), F.col("r_regionkey").cast("bigint").alias("p_partkey")))
    path = _fresh(spark, "log")
    W.write_lines(lines, "value", ["p_partkey"], path)
    return I.missing_term_log(spark, path)


def daily_snapshots(spark, d):
    """One partition a day, the first of a day kept; the newest is read, old ones go."""
    events = S.table(spark, d, "events").select("user_id", "event_type")
    path = _fresh(spark, "snapshots")
    for day, kind in (("2024-01-01", "view"), ("2024-02-20", "purchase"), ("2024-02-20", "error")):
        W.write_daily_snapshot(events.filter(F.col("event_type") == kind), path, day)
    W.drop_old_snapshots(spark, path, "2024-02-21")
    days = spark.read.parquet(path).select(F.countDistinct("snapshot_date").alias("days"))
    return I.read_snapshot(spark, path).groupBy("event_type").agg(F.count("*").alias("rows")).join(days, F.lit(True))


def dated_and_latest(spark, d):
    orders = S.table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    path = _fresh(spark, "dated")
    for day, status in (("2024-01-01", "O"), ("2024-01-02", "F")):
        W.write_dated(orders.filter(F.col("o_orderstatus") == status), path, day)
    dated = spark.read.parquet(path + "/archive").groupBy(F.col("run_date").cast("string").alias("at")).agg(F.count("*").alias("rows"))
    latest = spark.read.parquet(path + "/latest").agg(F.lit("latest").alias("at"), F.count("*").alias("rows"))
    return dated.unionByName(latest)


def saved_history(spark, d):
    """History saved in versions with a gap between their numbers; capped at 10 a key."""
    rows = S.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("sku"), F.to_date("ts").alias("change_date"), F.col("ts").alias("timestamp"), "event_id")
    path = _fresh(spark, "history")
    for version, kind in ((1, 0), (2, 1), (5, 2)):
        W.save_history(spark, path, rows.filter(F.col("event_id") % 3 == kind), version)
    return spark.read.parquet(path + "/version=5").groupBy("sku").agg(F.count("*").alias("rows"))


def download_report(spark, d):
    rows = S.table(spark, d, "part").select(F.col("p_partkey").alias("sku"), F.when(F.col("p_size") % 3 == 0, "OK")
                                            .when(F.col("p_size") % 3 == 1, "Failed (2 images)").otherwise("No Images Found").alias("status"))
    path = _fresh(spark, "downloads")
    W.write_download_report(rows, path)
    sheets = [spark.read.csv(f"{path}/{n}", header=True).agg(F.lit(n).alias("sheet"), F.count("*").alias("rows"))
              for n in ("all", "failed", "no_images")]
    return sheets[0].unionByName(sheets[1]).unionByName(sheets[2])


def products_and_failures(spark, d):
    """A retry's failures, with the earlier ones it did not try again."""
    part = S.table(spark, d, "part").select(F.concat(F.lit("u"), "p_partkey").alias("url"), "p_size")
    path = _fresh(spark, "products")
    W.write_products_and_failures(part.filter("p_size > 40"), part.filter("p_size between 30 and 40"), path,
                                  part.filter("p_size > 20"))
    return I.tidy_headers(spark.read.csv(path + "/failed", header=True)).select("url")


def tracking_report(spark, d):
    rows = S.table(spark, d, "orders").select("o_orderkey", F.when(F.col("o_orderstatus") == "F", "new").when(
        F.col("o_orderstatus") == "O", "price_changed").otherwise("same").alias("status"))
    path = _fresh(spark, "tracking")
    W.write_tracking_report(rows, rows.filter("o_orderkey % 2 = 0"), rows, path)
    out = None
    for name in ("current", "new", "changes", "removed", "previous"):
        sheet = spark.read.csv(f"{path}/{name}", header=True).agg(F.lit(name).alias("sheet"), F.count("*").alias("rows"))
        out = sheet if out is None else out.unionByName(sheet)
    return out


def resolved_columns(spark, d):
    """Columns found by a part of their header, read, and checked for."""
    part = R.tidy_headers(S.table(spark, d, "part").withColumnRenamed("p_size", " Size (cm) "))
    size = R.resolve_column(part, "size", ignore_case=True)
    name = R.resolve_column(part, "name", without=("brand",))
    try:
        R.require_columns(part, "no such column")
        refused = False
    except R.MissingColumns:
        refused = True
    return R.require_columns(part, size, name).groupBy(F.col(f"`{size}`").alias("size"), F.lit(refused).alias("refused")).agg(
        F.countDistinct(name).alias("names"))


def numbers_as_text(spark, d):
    value = F.when(F.col("l_linenumber") % 2 == 0, F.col("l_quantity")).otherwise(F.col("l_quantity") + 0.5)
    return S.table(spark, d, "lineitem").select(render_number(value).alias("text")).groupBy("text").agg(F.count("*").alias("rows"))


QUERIES = {
    "listing_file": (listing_file, """
SELECT CAST(p_partkey AS VARCHAR) AS "No", '"' || p_name || '", ' || p_brand AS product_name, 'https://shop.example/' || p_partkey AS product_url,
  CASE WHEN p_size > 10 THEN CAST(p_size AS VARCHAR) END AS price FROM part"""),
    "seed_file": (seed_file, "SELECT url, count(*) AS rows FROM pages WHERE page_id % 5 <> 0 GROUP BY url"),
    "catalog_file": (catalog_file, """
SELECT CAST(p_partkey AS VARCHAR) AS sku, '' AS parent_sku, p_name AS text, 'a|b' AS colors FROM part
UNION ALL SELECT p_partkey || '-a', CAST(p_partkey AS VARCHAR), 'variant', 'a' FROM part"""),
    "dictionary_file": (dictionary_file, """
SELECT p_name AS term, p_type AS translation, count(*) AS rows FROM part WHERE p_size > 5 GROUP BY 1, 2"""),
    "word_index_file": (word_index_file, "SELECT p_brand || ' ' || p_partkey AS term, p_type AS translation FROM part"),
    "price_rule_file": (price_rule_file, """
SELECT CAST(p_partkey AS DOUBLE) AS from_price, CAST(p_partkey + 10 AS DOUBLE) AS to_price,
  CASE WHEN p_size > 9 THEN CAST(p_size AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS increase_percent, CAST(0 AS DOUBLE) AS discount_percent FROM part"""),
    "excluded_file": (excluded_file, "SELECT p_partkey || '-red' AS sku FROM part WHERE p_size > 25"),
    "sorted_lines": (sorted_lines, "SELECT count(*) AS lines, TRUE AS in_order FROM orders"),
    "expected_key_file": (expected_key_file, "SELECT CAST(p_partkey AS VARCHAR) AS sku FROM part WHERE p_partkey IN (7, 8, 12)"),
    "manifest_file": (manifest_file, """
SELECT CAST(p_partkey AS VARCHAR) AS sku, CASE WHEN p_size > 20 THEN p_name ELSE 'کد ' || p_partkey END AS name,
  'http://x.example/' || p_partkey AS url FROM part WHERE p_size > 3"""),
    "picture_folder": (picture_folder, "SELECT DISTINCT CAST(p_partkey % 7 AS VARCHAR) AS product_no, TRUE AS filled FROM part"),
    "image_files": (image_files, """
SELECT DISTINCT 'k=' || (p_partkey % 7) || 'x' AS folder, unnest(['jpg', 'png']) AS ending, CAST(NULL AS VARCHAR) AS product_no FROM part"""),
    "term_log": (term_log, "SELECT DISTINCT p_name AS term FROM part"),
    "daily_snapshots": (daily_snapshots, """
SELECT event_type, count(*) AS rows, CAST(1 AS BIGINT) AS days FROM events WHERE event_type = 'purchase' GROUP BY 1"""),
    "dated_and_latest": (dated_and_latest, """
SELECT CASE o_orderstatus WHEN 'O' THEN '2024-01-01' ELSE '2024-01-02' END AS at, count(*) AS rows FROM orders WHERE o_orderstatus IN ('O', 'F') GROUP BY 1
UNION ALL SELECT 'latest', count(*) FROM orders WHERE o_orderstatus = 'F'"""),
    "saved_history": (saved_history, """
SELECT CAST(user_id AS VARCHAR) AS sku, least(count(*), 10) AS rows FROM events GROUP BY 1"""),
    "download_report": (download_report, """
SELECT 'all' AS sheet, count(*) AS rows FROM part UNION ALL SELECT 'failed', count(*) FROM part WHERE p_size % 3 = 1
UNION ALL SELECT 'no_images', count(*) FROM part WHERE p_size % 3 = 2"""),
    "products_and_failures": (products_and_failures, "SELECT 'u' || p_partkey AS url FROM part WHERE p_size > 20 AND p_size <= 40"),
    "tracking_report": (tracking_report, """
SELECT 'current' AS sheet, count(*) AS rows FROM orders UNION ALL SELECT 'previous', count(*) FROM orders
UNION ALL SELECT 'new', count(*) FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'changes', count(*) FROM orders WHERE o_orderstatus = 'O'
UNION ALL SELECT 'removed', count(*) FROM orders WHERE o_orderkey % 2 = 0"""),
    "resolved_columns": (resolved_columns, "SELECT p_size AS size, TRUE AS refused, count(DISTINCT p_name) AS names FROM part GROUP BY 1"),
    "numbers_as_text": (numbers_as_text, """
SELECT CASE WHEN l_linenumber % 2 = 0 THEN CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '.5' END AS text,
  count(*) AS rows FROM lineitem GROUP BY 1"""),
}
