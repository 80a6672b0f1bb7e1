"""Comparison, manifests and price tracking over the derived shop."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vitrine.functions import prices as P
from vitrine.operators import diff as X
from vitrine.operators import tracking as K
from vitrine.operators.dedupe import unprocessed
from vitrine.operators.scale import first_by_key
from vitrine.plans import changes
from vitrine.session import shared_folder
from vitrine.showcase import shop as S
from vitrine.sources.readers import tidy_headers


def _diff(spark, d, colors=True):
    return X.diff_catalog(S.scan(spark, d), S.catalog(spark, d), colors)


def diff_summary(spark, d):
    return X.change_counts(_diff(spark, d))


def diff_new(spark, d):
    return X.new_rows(S.scan(spark, d), S.catalog(spark, d)).select(
        "sku", "name", "regular_price", "ord")


def diff_removed(spark, d):
    return X.removed_products(_diff(spark, d), S.catalog(spark, d), S.variants(spark, d)).select(
        "sku", "name", "regular_price", F.array_join(F.array_sort(F.split("variant_skus", r" \| ")),
                                                     " | ").alias("variant_skus"))


def diff_price(spark, d):
    # Only keys and prices are read for this one; the colour cells are pruned.
    return X.price_changes(_diff(spark, d, colors=False)).select(
        "sku", "name", "old_price", "new_price", "delta", F.round("percent", 6).alias("percent"))


def diff_color(spark, d):
    return X.color_changes(_diff(spark, d), S.variants(spark, d))


def delete_list(spark, d):
    return X.delete_list(_diff(spark, d), S.variants(spark, d)).select("part", "sku")


def update_manifest(spark, d):
    return X.update_manifest(_diff(spark, d), X.links_by_code(S.listing(spark, d)))


def new_manifest(spark, d):
    return X.new_manifest(S.scan(spark, d), S.catalog(spark, d), X.links_by_code(S.listing(spark, d)))


def image_subset(spark, d):
    return X.image_subset(_diff(spark, d), S.scan(spark, d), X.links_by_code(S.listing(spark, d)))


def changed_keys(spark, d):
    return X.changed_keys(_diff(spark, d))


def link_sheet(spark, d):
    wanted = _diff(spark, d).filter("change_class = 'new' or color_added")
    return X.link_sheet(wanted, X.links_by_code(S.listing(spark, d)))


def report_sheets(spark, d):
    """The change report written as sheets; the new and the ready one read back."""
    scan, catalog = S.scan(spark, d), S.catalog(spark, d)
    path = f"{shared_folder(spark).rstrip('/')}/vitrine-report-{uuid.uuid4().hex}"
    changes.write_changes(changes.detect_changes(scan, catalog, S.variants(spark, d), S.listing(spark, d)), path, "gzip")
    new, ready = (tidy_headers(spark.read.csv(f"{path}/report/{name}", header=True, escape='"')) for name in ("new", "ready"))
    return new.select(F.lit("new").alias("sheet"), "kind", "sku", "name", "colors", F.col("ord").cast("bigint").alias("ord")).union(
        ready.select(F.lit("ready"), F.lit(""), "sku", "name", "colors", F.col("ord").cast("bigint")))


def listing_shape(spark, d):
    """Products of two sources, each with its own field names, as name and address."""
    part = S.table(spark, d, "part")
    ours = part.select(F.when(F.col("p_size") > 9, F.col("p_name")).otherwise("").alias("product_name"), F.col("p_brand").alias("name"),
                       F.concat(F.lit("/p/"), "p_partkey").alias("url"))
    theirs = part.select(F.col("p_type").alias("name"), F.concat(F.lit("/q/"), "p_partkey").alias("link"))
    return K.listing_extract(ours).unionAll(K.listing_extract(theirs))


def run_mode(spark, d):
    """What a run has to do, for all that may be asked of it."""
    counts = X.change_counts(_diff(spark, d))
    none = counts.select(*[F.lit(0).cast(t).alias(c) for c, t in counts.dtypes])
    priced = counts.select(*[(F.col(c) if c in ("changed", "price") else F.lit(0)).cast(t).alias(c) for c, t in counts.dtypes])
    cases = {"found": (counts, True, "auto"), "nothing": (none, True, "auto"), "prices": (priced, True, "auto"),
             "no_catalog": (none, False, "auto"), "asked": (counts, True, "full")}
    rows = [(name, *changes.choose_mode(*case).values()) for name, case in cases.items()]
    return spark.createDataFrame(rows, "case string, mode string, stop boolean, images boolean")


def resume_unprocessed(spark, d):
    """Scan rows whose key the catalogue ledger has not seen."""
    return unprocessed(S.scan(spark, d), S.catalog(spark, d), "sku").groupBy("status").agg(
        F.count("*").alias("rows"), F.count_distinct("sku").alias("keys"))


_WITH = f"WITH {S.OFFERS_SQL}, {S.DIFF_SQL}"
_LAST_VARIANT = f"""{S.VARIANTS_SQL},
var_keys AS (SELECT * FROM (
  SELECT regexp_replace(parent_sku, '\\p{{Cf}}', '', 'g') AS parent_sku,
         trim(regexp_replace(color, '\\p{{Cf}}', '', 'g')) AS color, sku AS variant_sku, ord,
         row_number() OVER (PARTITION BY parent_sku, trim(regexp_replace(color, '\\p{{Cf}}', '', 'g'))
                            ORDER BY ord DESC) AS rn
  FROM variants WHERE color <> '') WHERE rn = 1)"""
_CODE = "regexp_extract({}, '([0-9]{{3,6}})', 1)"
_ASCII = "translate({}, '۰۱۲۳۴۵۶۷۸۹', '0123456789')"
_LINKS = f"""{S.LISTING_SQL},
links AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY code ORDER BY ord DESC) AS rn FROM (
  SELECT {_CODE.format(_ASCII.format('product_name'))} AS code, product_name, product_url, price, ord
  FROM listing) WHERE code <> '') WHERE rn = 1)"""
_LINK_ON = f"LEFT JOIN links ON links.code = {_CODE.format('q.sku')}"
_IMG = """img AS (SELECT * FROM (SELECT sku, image_urls, row_number() OVER (PARTITION BY sku ORDER BY ord DESC) AS rn
  FROM offers WHERE NOT is_old) WHERE rn = 1)"""

_SCAN_NEW = "SELECT * FROM offers WHERE NOT is_old AND sku NOT IN (SELECT sku FROM offers WHERE is_old)"

QUERIES = {
    "report_sheets": (report_sheets, f"""{_WITH}, scan_new AS ({_SCAN_NEW}), gained AS (SELECT * FROM diff WHERE change_class = 'common' AND len(added) > 0)
SELECT 'new' AS sheet, 'new_product' AS kind, sku, name, colors, CAST(ord AS BIGINT) AS ord FROM scan_new
UNION ALL SELECT 'new', 'new_color', sku, name, array_to_string(added, ' | '), NULL FROM gained
UNION ALL SELECT 'ready', '', sku, name, colors, CAST(ord AS BIGINT) FROM scan_new
UNION ALL SELECT 'ready', '', f.sku, f.name, array_to_string(list_sort(g.colors_after), ' | '), CAST(f.ord AS BIGINT) FROM gained g JOIN firsts f ON f.sku = g.sku AND NOT f.is_old"""),
    "listing_shape": (listing_shape, """
SELECT CASE WHEN p_size > 9 THEN p_name ELSE p_brand END AS product_name, '/p/' || p_partkey AS product_url FROM part
UNION ALL SELECT p_type, '/q/' || p_partkey FROM part"""),
    "run_mode": (run_mode, f"""{_WITH}, c AS (SELECT count(*) FILTER (change_class = 'new') AS new,
  count(*) FILTER (price_changed OR COALESCE(len(added) > 0, FALSE)) AS changed, count(*) FILTER (change_class = 'common' AND len(added) > 0) AS color FROM diff)
SELECT 'found' AS "case", 'incremental' AS mode, new + changed = 0 AS stop, new + color > 0 AS images FROM c
UNION ALL SELECT 'nothing', 'incremental', TRUE, FALSE UNION ALL SELECT 'prices', 'incremental', changed = 0, FALSE FROM c
UNION ALL SELECT 'no_catalog', 'full', FALSE, TRUE UNION ALL SELECT 'asked', 'full', FALSE, TRUE"""),
    "diff_summary": (diff_summary, f"""{_WITH}
SELECT count(*) FILTER (change_class = 'new') AS new,
       count(*) FILTER (price_changed OR COALESCE(len(added) > 0, FALSE)) AS changed,
       count(*) FILTER (price_changed) AS price,
       count(*) FILTER (change_class = 'common' AND len(added) > 0) AS color,
       count(*) FILTER (change_class = 'common' AND (len(added) > 0 OR len(removed) > 0)) AS color_rows,
       count(*) FILTER (change_class = 'removed') AS removed,
       count(*) FILTER (change_class = 'common') AS common
FROM (SELECT * EXCLUDE (added, removed), CASE WHEN change_class = 'common' THEN added END AS added,
             CASE WHEN change_class = 'common' THEN removed END AS removed FROM diff)"""),
    "diff_new": (diff_new, f"""WITH {S.OFFERS_SQL}
SELECT sku, name, regular_price, ord FROM offers n WHERE NOT is_old
  AND NOT EXISTS (SELECT 1 FROM offers o WHERE o.is_old AND o.sku = n.sku)"""),
    "diff_removed": (diff_removed, f"""{_WITH}, {_LAST_VARIANT}
SELECT f.sku, f.name, f.regular_price,
       COALESCE((SELECT string_agg(variant_sku, ' | ' ORDER BY variant_sku) FROM var_keys v
                 WHERE v.parent_sku = f.sku), '') AS variant_skus
FROM firsts f JOIN diff ON diff.sku = f.sku AND diff.change_class = 'removed' WHERE f.is_old"""),
    "diff_price": (diff_price, f"""{_WITH}
SELECT sku, name, old_price, new_price, new_price - old_price AS delta,
       round((new_price - old_price) / CAST(old_price AS DOUBLE) * 100, 6) AS percent
FROM diff WHERE price_changed"""),
    "diff_color": (diff_color, f"""{_WITH}, {_LAST_VARIANT}
SELECT d.sku, d.name, array_to_string(colors_before, ' | ') AS before,
       array_to_string(colors_after, ' | ') AS after, array_to_string(added, ' | ') AS added,
       array_to_string(removed, ' | ') AS removed,
       COALESCE((SELECT string_agg(variant_sku, ' | ' ORDER BY color) FROM var_keys v
                 WHERE v.parent_sku = d.sku AND list_contains(d.removed, v.color)), '') AS removed_variant_skus
FROM diff d WHERE change_class = 'common' AND (len(added) > 0 OR len(removed) > 0)"""),
    "delete_list": (delete_list, f"""{_WITH}, {_LAST_VARIANT}
SELECT 1 AS part, sku FROM diff WHERE change_class = 'removed'
UNION ALL SELECT 1, variant_sku FROM var_keys v JOIN diff d ON d.sku = v.parent_sku AND d.change_class = 'removed'
UNION ALL SELECT 2, variant_sku FROM (SELECT sku, unnest(removed) AS color FROM diff WHERE change_class = 'common') r
  JOIN var_keys v ON v.parent_sku = r.sku AND v.color = r.color"""),
    "update_manifest": (update_manifest, f"""{_WITH}, {_LINKS}
SELECT q.sku, q.name, q.change_type, q.details, COALESCE(links.product_url, '') AS url FROM (
  SELECT sku, name, 'price' AS change_type,
         format('{{:,}}', old_price) || ' -> ' || format('{{:,}}', new_price) AS details
  FROM diff WHERE price_changed
  UNION ALL SELECT sku, name, 'color', 'added: ' || array_to_string(added, ' | ')
         || '; removed: ' || array_to_string(removed, ' | ')
  FROM diff WHERE change_class = 'common' AND (len(added) > 0 OR len(removed) > 0)) q {_LINK_ON}"""),
    "new_manifest": (new_manifest, f"""WITH {S.OFFERS_SQL}, {_LINKS}, {_IMG}
SELECT q.sku, q.name, q.regular_price AS price, q.ord, COALESCE(links.product_url, '') AS url,
       COALESCE(img.image_urls, '') AS image_urls
FROM offers q {_LINK_ON} LEFT JOIN img ON img.sku = q.sku
WHERE NOT q.is_old AND NOT EXISTS (SELECT 1 FROM offers o WHERE o.is_old AND o.sku = q.sku)"""),
    "image_subset": (image_subset, f"""{_WITH}, {_LINKS}, {_IMG}
SELECT q.sku, COALESCE(links.product_url, '') AS url, COALESCE(img.image_urls, '') AS image_urls,
       CASE WHEN q.change_class = 'new' THEN 'new' ELSE 'color' END AS reason
FROM diff q {_LINK_ON} LEFT JOIN img ON img.sku = q.sku
WHERE q.change_class = 'new' OR (q.change_class = 'common' AND len(q.added) > 0)"""),
    "changed_keys": (changed_keys, f"""{_WITH}
SELECT sku FROM diff WHERE price_changed
UNION SELECT sku FROM diff WHERE change_class = 'common' AND len(added) > 0"""),
    "link_sheet": (link_sheet, f"""{_WITH}, {_LINKS}
SELECT q.sku, COALESCE(links.product_name, q.name) AS product_name,
       COALESCE(links.product_url, '') AS product_url, COALESCE(links.price, '') AS price,
       links.code IS NOT NULL AS matched
FROM diff q {_LINK_ON}
WHERE q.change_class = 'new' OR (q.change_class = 'common' AND len(q.added) > 0)"""),
    "resume_unprocessed": (resume_unprocessed, f"""WITH {S.OFFERS_SQL}
SELECT status, count(*) AS rows, count(DISTINCT sku) AS keys FROM offers n
WHERE NOT is_old AND sku NOT IN (SELECT sku FROM offers WHERE is_old) GROUP BY status"""),
}


# ---- tracker: the newest listing of an offer against its earlier one -----------------

def _tracked(spark, d):
    rows = S.offers(spark, d)
    shaped = rows.select("is_old", "ord", F.concat(F.lit(S.SITE), "sku").alias("url"), "name",
                         F.col("model").alias("code"),
                         F.col("regular_price").cast("bigint").alias("price"))
    current = shaped.filter("not is_old").drop("is_old")
    previous = shaped.filter("is_old").drop("is_old")
    return K.track(current, previous), K.removed_since(current, previous, F.lit("2001-12-01").cast("date"))


def track_status(spark, d):
    return _tracked(spark, d)[0].select("ord", "url", "price", "prev_price", "status", "delta", "percent",
                                        "listed_unchanged")


def track_removed(spark, d):
    return _tracked(spark, d)[1]


def track_counts(spark, d):
    return K.tracker_counts(*_tracked(spark, d))


def track_manifest(spark, d):
    return K.tracker_manifest(*_tracked(spark, d))


def listing_parse(spark, d):
    return K.read_listing(S.listing(spark, d), F.lit("2024-03-20").cast("date"))


def price_lag_changes(spark, d):
    """Every line of a part priced differently from the line shipped before."""
    seen = S.table(spark, d, "lineitem").select(
        "l_partkey", "l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey",
        F.round(F.col("l_extendedprice") * 100).cast("bigint").alias("cents"))
    steps = K.price_steps(seen, "l_partkey", ["l_shipdate", "l_orderkey", "l_linenumber", "l_suppkey"],
                          F.date_trunc("month", "l_shipdate"), "cents")
    return steps.select("l_partkey", "l_orderkey", "l_linenumber", "cents",
                        F.col("prev_price").alias("prev_cents"), "delta",
                        F.round("percent", 6).alias("percent"))


def significant_changes(spark, d):
    """Price changes of at least five percent, counted by direction."""
    steps = _diff(spark, d, colors=False).filter("price_changed").select(
        P.price_change("old_price", "new_price")["percent"].alias("percent"))
    return (K.significant_changes(steps)
            .groupBy((F.col("percent") > 0).alias("is_increase")).agg(F.count("*").alias("changes")))


def effective_price(spark, d):
    return S.offers(spark, d).select(
        "sku", "ord", P.effective_price("regular_price", "sale_price").alias("price"),
        P.parse_price("sale_price").cast("bigint").alias("sale"),
        P.price_digits("regular_price").alias("digits"))


def keep_first_rows(spark, d):
    return first_by_key(S.offers(spark, d), "sku", "ord").select("sku", "ord", "name")


def upsert_rows(spark, d):
    from vitrine.operators.dedupe import upsert
    return upsert(S.catalog(spark, d), S.scan(spark, d), "sku").select("sku", "ord", "regular_price", "is_old")


_TRACK = f"""WITH {S.OFFERS_SQL},
cur AS (SELECT ord, '{S.SITE}' || sku AS url, name, model AS code, CAST(regular_price AS BIGINT) AS price
        FROM offers WHERE NOT is_old),
prev AS (SELECT * FROM (SELECT '{S.SITE}' || sku AS url, name, model AS code, CAST(regular_price AS BIGINT) AS price,
        row_number() OVER (PARTITION BY sku ORDER BY ord DESC) AS rn FROM offers WHERE is_old) WHERE rn = 1),
tracked AS (SELECT c.*, p.price AS prev_price,
   CASE WHEN p.url IS NULL THEN 'new' WHEN c.price <> p.price THEN 'price_changed' ELSE 'unchanged' END AS status
   FROM cur c LEFT JOIN prev p ON c.url = p.url),
gone AS (SELECT p.* FROM prev p WHERE p.url NOT IN (SELECT url FROM cur))"""

QUERIES |= {
    "track_status": (track_status, f"""{_TRACK}
SELECT ord, url, price, prev_price, status,
       CASE WHEN status = 'price_changed' THEN price - prev_price END AS delta,
       CASE WHEN status <> 'price_changed' THEN NULL WHEN prev_price > 0
            THEN round((price - prev_price) / CAST(prev_price AS DOUBLE) * 100, 2) ELSE 0 END AS percent,
       status = 'unchanged' AS listed_unchanged
FROM tracked"""),
    "track_removed": (track_removed, f"""{_TRACK}
SELECT name, code, url, nullif(price, 0) AS last_price, '1380/09/10' AS removed_date FROM gone"""),
    "track_counts": (track_counts, f"""{_TRACK}
SELECT count(*) AS total, count(*) FILTER (status = 'new') AS new,
       count(*) FILTER (status = 'price_changed') AS changed, count(*) FILTER (status = 'unchanged') AS unchanged,
       count(*) FILTER (status = 'price_changed' AND price > prev_price) AS increased,
       count(*) FILTER (status = 'price_changed' AND price < prev_price) AS decreased,
       (SELECT count(*) FROM gone) AS removed FROM tracked"""),
    "track_manifest": (track_manifest, f"""{_TRACK}
SELECT code AS sku, name, 'price' AS change_type, CAST(prev_price AS VARCHAR) || ' -> ' || CAST(price AS VARCHAR) AS details
FROM tracked WHERE status = 'price_changed'
UNION ALL SELECT code, name, 'removed', '' FROM gone"""),
    "listing_parse": (listing_parse, f"""
SELECT p_partkey AS ord, p_name || ' کد ' || CAST(p_partkey + 1000 AS VARCHAR) AS name,
       CAST(p_partkey + 1000 AS VARCHAR) AS code, {S.PRICE_SQL} AS price,
       '{S.SITE}' || CAST(p_partkey + 1000 AS VARCHAR) || '?x=1#f' AS url, '1403/01/01' AS check_date
FROM part"""),
    "price_lag_changes": (price_lag_changes, """
SELECT l_partkey, l_orderkey, l_linenumber, cents, prev_cents, cents - prev_cents AS delta,
       round((cents - prev_cents) / CAST(prev_cents AS DOUBLE) * 100, 6) AS percent
FROM (SELECT *, lag(cents) OVER (PARTITION BY l_partkey
        ORDER BY l_shipdate, l_orderkey, l_linenumber, l_suppkey) AS prev_cents
      FROM (SELECT *, CAST(round(l_extendedprice * 100) AS BIGINT) AS cents FROM lineitem))
WHERE prev_cents <> cents"""),
    "significant_changes": (significant_changes, f"""{_WITH}
SELECT new_price > old_price AS is_increase, count(*) AS changes FROM diff
WHERE price_changed AND abs((new_price - old_price) / CAST(old_price AS DOUBLE) * 100) >= 5 GROUP BY 1"""),
    "effective_price": (effective_price, f"""WITH {S.OFFERS_SQL}
SELECT sku, ord, {S.effective_sql('regular_price', 'sale_price')} AS price,
       CASE WHEN sale_price IS NOT NULL AND sale_price <> 'nan' THEN CAST(CAST(sale_price AS DOUBLE) AS BIGINT) END AS sale,
       regular_price AS digits FROM offers"""),
    "keep_first_rows": (keep_first_rows, f"""WITH {S.OFFERS_SQL}
SELECT sku, ord, name FROM (SELECT *, row_number() OVER (PARTITION BY sku ORDER BY ord) AS rn FROM offers) WHERE rn = 1"""),
    "upsert_rows": (upsert_rows, f"""WITH {S.OFFERS_SQL}
SELECT sku, ord, regular_price, is_old FROM (SELECT *, row_number() OVER (
  PARTITION BY sku ORDER BY is_old, ord DESC) AS rn FROM offers) WHERE rn = 1"""),
}
