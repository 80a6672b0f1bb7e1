"""Catalogue export, image naming and import over the derived shop."""

from __future__ import annotations

from pyspark.sql import functions as F

from vitrine import vocab as V
from vitrine.functions import text as T
from vitrine.functions.urls import rewrite_images
from vitrine.operators import dictionary as D
from vitrine.operators import export as X
from vitrine.operators import images as I
from vitrine.operators import manifest as M
from vitrine.operators.scale import exploded
from vitrine.plans.catalogue import export_catalog, picture_gate
from vitrine.showcase import shop as S
from vitrine.showcase.cleaning import _ENGLISH, map_sql

SITE = X.Site(shop_name="ویترین")
ENGLISH = ("black", "white", "blue", "navy-blue", "red", "dark-brown", "sky-blue", "tosi-sadh")


def _products(spark, d):
    """All offers as products of the part; several offers share one key."""
    return (S.offers(spark, d).withColumn("supp", F.split_part("sku", F.lit("-"), F.lit(2)).cast("bigint"))
            .withColumn("ord", F.col("ord") * 100000 + F.col("supp"))
            .withColumn("sku", F.col("model")).drop("supp"))


def _files(spark, d):
    """One picture file per order line, named by part, letters (a to ax) and colour.

    Most parts have more than 26 files, and several with one letter."""
    return S.table(spark, d, "lineitem").select(F.concat(
        F.lit("img/"), F.col("l_partkey") + 1000, T.letter_for_index(F.col("l_quantity").cast("bigint") - 1),
        F.lit("_"), S.pick(ENGLISH, F.col("l_linenumber") % 8), F.lit(".webp")).alias("path"))


def _colors(spark):
    return D.pairs_frame(spark, V.COLOR_ENGLISH)


def _names(spark):
    return D.pairs_frame(spark, V.PRODUCT_ENGLISH)


def _excluded(spark, d):
    """Variant keys on the exclusion list: some colours, or all of a part."""
    some = F.when(F.col("p_size") > 45, F.array(*[F.lit(c) for c in ENGLISH])).when(
        F.col("p_size") <= 10, F.array(F.lit("black"), F.lit("white")))
    return S.table(spark, d, "part").select((F.col("p_partkey") + 1000).alias("m"), F.explode(some).alias("c")) \
        .select(F.concat_ws("-", "m", "c").alias("sku"))


def _catalogue(spark, d, excluded=True, **options):
    return export_catalog(_products(spark, d), _files(spark, d), _colors(spark), _names(spark),
                          _excluded(spark, d) if excluded else None, SITE, **options)


def explode_variants(spark, d):
    return X.expand_colors(S.offers(spark, d)).select("sku", "ord", "color_pos", "color")


def export_parents(spark, d):
    rows = _catalogue(spark, d).rows.filter("post_type = 'product'")
    return rows.select("sku", "post_title", "regular_price", "sale_price", F.col("`attribute:color`").alias("colors"),
                       F.col("`attribute:application`").alias("usage"), F.col("`attribute_name:application`").alias("usage_label"),
                       F.col("`meta:_yoast_wpseo_title`").alias("seo_title"),
                       F.col("`meta:_yoast_wpseo_metadesc`").alias("seo_text"),
                       F.col("`meta:_yoast_wpseo_canonical`").alias("canonical"), "images")


def export_variants(spark, d):
    rows = _catalogue(spark, d).rows.filter("post_type = 'product_variation'")
    return rows.select("sku", "parent_sku", "regular_price", "image_filename", "image_alt",
                       F.col("`attribute:color`").alias("color"))


def export_gallery(spark, d):
    rows = _catalogue(spark, d, excluded=False, social=True, attributes_as_columns=False).products
    return exploded(rows, F.col("gallery"), "g", "sku", pos="pos").select("sku", "pos", "g.file", "g.alt")


def excluded_variants(spark, d):
    return X.drop_excluded(X.variant_rows(_products(spark, d), _colors(spark)), _excluded(spark, d)) \
        .select("sku", "color", "variant_sku")


def excluded_products(spark, d):
    return X.fully_excluded(X.variant_rows(_products(spark, d), _colors(spark)), _excluded(spark, d))


def export_split(spark, d):
    """Catalogue rows of the products the update manifest names."""
    rows = _catalogue(spark, d, excluded=False).rows
    listed = S.table(spark, d, "orders").select((F.col("o_custkey") + 1000).cast("string").alias("sku"))
    return X.split_by_manifest(rows, listed).select("post_type", "sku", "parent_sku")


def dimensions(spark, d):
    rows = S.table(spark, d, "part").select("p_partkey", F.concat(
        "p_size", F.when(F.col("p_size") > 20, F.concat(F.lit(" × "), (F.col("p_size") % 7).cast("string"))).otherwise(""),
        F.lit(" x 4.5 cm")).alias("text"))
    parts = T.split_dimensions("text")
    return rows.select("p_partkey", parts["length"].alias("length"), parts["width"].alias("width"),
                       parts["depth"].alias("depth"),
                       T.dimension_text(parts["length"], parts["width"], parts["depth"]).alias("cell"))


def descriptions(spark, d):
    rows = X.described(_products(spark, d).withColumn("outer_material", F.lit("چرم"))).select(
        "name", "model", "colors", "short_description", "description")
    texts = X.packaged_texts(F.col("name"), F.col("model"), F.col("colors"), F.col("short_description"),
                             F.col("description"))
    # Digests first: the aggregate of texts sorts its rows, which then hold no whole description.
    out = rows.select("model", *[c.alias(k) for k, c in texts.items()]).withColumn("full_md5", F.md5("description"))
    return out.select("model", "title", "full_md5", "focus_keyword").groupBy("model").agg(
        F.count("*").alias("rows"), F.max("title").alias("title"), F.max("full_md5").alias("full_md5"),
        F.max("focus_keyword").alias("keyword"))


def assign_images(spark, d):
    rows = _catalogue(spark, d, excluded=False).products
    named = rows.select("sku", F.col("clean_name").alias("name_fa"), "name_en", F.col("model_text").alias("model"),
                        F.col("colors_en").alias("colors"))
    return exploded(I.assign_images(named, _files(spark, d)), F.col("matches"), "m", "sku").select(
        "sku", "m.color", "m.source", "m.kind")


def image_mapping(spark, d):
    return _catalogue(spark, d, excluded=False).mapping


def image_gate(spark, d):
    return picture_gate(_catalogue(spark, d, excluded=False), _files(spark, d))


def rename_plan(spark, d):
    """New names of all order-line pictures of a part, squares first."""
    lines = S.table(spark, d, "lineitem").select(
        F.concat(F.col("l_partkey") + 1, F.lit("_"), "l_orderkey", F.lit("_"), "l_linenumber", F.lit("_"),
                 "l_suppkey", F.lit(".jpg")).alias("path"),
        F.col("l_quantity").cast("int").alias("width"), F.when(F.col("l_returnflag") == "R", F.col("l_quantity").cast("int"))
        .otherwise(0).alias("height"),
        ((F.col("l_orderkey") * 10 + F.col("l_linenumber")) * 100000 + F.col("l_suppkey")).alias("ord"))
    scope = S.table(spark, d, "part").filter("p_size <= 40").select((F.col("p_partkey") + 1).cast("string").alias("sku"))
    return I.rename_plan(lines, scope)


def folder_pick(spark, d):
    files = S.table(spark, d, "lineitem").select(
        F.concat(F.lit("2024-01-"), F.lpad((F.col("l_suppkey") % 28 + 1).cast("string"), 2, "0")).alias("folder"),
        F.concat((F.col("l_partkey") + 1000).cast("string"), F.lit("a.webp")).alias("path"),
        (F.col("l_suppkey") % 28 < 20).alias("marked"))
    expected = S.table(spark, d, "part").filter("p_size > 25").select(
        F.concat((F.col("p_partkey") + 1000).cast("string"), F.lit("-black")).alias("sku"))
    cover = I.folder_coverage(files, expected)
    best = I.pick_folder(cover).select(F.col("folder").alias("best"))
    return cover.join(F.broadcast(best), F.lit(True)).select("folder", "coverage", "marked",
                                                             (F.col("folder") == F.col("best")).alias("picked"))


def image_sources(spark, d):
    """The file behind every part and letter: exact stem, else by prefix."""
    wanted = S.table(spark, d, "part").select(F.explode(F.array(*[F.concat(
        (F.col("p_partkey") + 1000).cast("string"), F.lit(x)) for x in "abz"])).alias("source"), F.lit("t").alias("target"))
    return I.find_sources(wanted, _files(spark, d)).select("source", "path", "found")


def existing_files(spark, d):
    """Files of plain keys and of keys that begin with a letter."""
    keys = S.table(spark, d, "part").filter("p_size > 25").select(F.concat(
        F.when(F.col("p_size") % 2 == 1, F.lit("A")).otherwise(""), F.col("p_partkey") + 1000).alias("sku"))
    plain = _files(spark, d)
    lettered = plain.select(F.replace("path", F.lit("img/"), F.lit("img/A")).alias("path"))
    return I.existing_files(plain.unionByName(lettered), keys).groupBy("sku").agg(F.count("*").alias("files"))


def _sizes(spark, d):
    docs = S.table(spark, d, "documents")
    before = docs.select(F.concat("doc_id", F.lit(".jpg")).alias("path"), F.col("n_chars").alias("length"))
    after = docs.select(F.concat("doc_id", F.lit(".webp")).alias("path"), (F.col("doc_id") * 3).alias("length"))
    return before, after


def size_reduction(spark, d):
    return I.size_reduction(*_sizes(spark, d)).withColumn("reduction_percent", F.round("reduction_percent", 6))


def size_pairs(spark, d):
    return I.size_pairs(*_sizes(spark, d)).withColumn("reduction_percent", F.round("reduction_percent", 6))


def dominant_colors(spark, d):
    """Order lines as pixel clusters of their order's picture."""
    rows = S.table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("image"), (F.col("l_partkey") * 37 % 256).alias("r"),
        (F.col("l_suppkey") * 91 % 256).alias("g"), (F.col("l_quantity").cast("bigint") * 5 % 256).alias("b"),
        (F.col("l_quantity") / 100).alias("share"), (F.col("l_orderkey") % 2 == 0).alias("dark_product"))
    return I.dominant_color(rows).select("image", "r", "g", "b")


def image_letters(spark, d):
    return S.table(spark, d, "orders").select("o_orderkey", T.letter_for_index(F.col("o_orderkey") * 7).alias("letter"),
                                              T.colors_in_filename(F.concat("o_orderkey", F.lit("ab_"), F.lower("o_orderpriority"), F.lit(".webp")))[0].alias("color"))


def rewritten_urls(spark, d):
    known = F.create_map(F.lit("a.webp"), F.lit("https://cdn.example/a.webp"))
    cell = F.when(F.col("p_size") > 25, F.concat(F.lit("https://x.example/i/a.webp| https://x.example/i/"), "p_partkey", F.lit(".webp"))) \
        .when(F.col("p_size") > 10, F.lit("u/a.webp")).otherwise("")
    return S.table(spark, d, "part").select("p_partkey", rewrite_images(cell, known).alias("images"))


# ---- import ----------------------------------------------------------------------------

def _sides(spark, d):
    from vitrine.operators.scale import first_by_key
    def one(df):
        return first_by_key(df.select("sku", "name", "regular_price", "sale_price", "ord"), "sku", "ord").drop("ord")
    return one(S.catalog(spark, d)), one(S.scan(spark, d))


def apply_full(spark, d):
    return M.apply_full(*_sides(spark, d))


def apply_new(spark, d):
    return M.apply_new(*_sides(spark, d))


def apply_update(spark, d):
    return M.apply_update(*_sides(spark, d))


def apply_manifest(spark, d):
    cat, file = _sides(spark, d)
    return M.apply_manifest(cat, {"new": file, "update": file})


def import_log(spark, d):
    cat, file = _sides(spark, d)
    logs = [M.import_log(cat, file, k).withColumn("kind", F.lit(k)) for k in ("full", "new", "update")]
    return logs[0].unionByName(logs[1]).unionByName(logs[2]).groupBy("kind", "action").agg(F.count("*").alias("rows"))


def manifest_counts(spark, d):
    cat, file = S.catalog(spark, d), S.scan(spark, d)
    return M.file_counts({"full": S.offers(spark, d), "new": cat, "update": file})


def manifest_json(spark, d):
    counts = M.file_counts({"new": S.catalog(spark, d), "update": S.scan(spark, d)})
    names = {"new": "new.csv", "update": "update.csv"}
    return M.import_manifest(counts, names, F.struct(F.lit(True).alias("copied")), "incremental",
                             F.lit("2024-01-02 03:04:05").cast("timestamp"))


_P = f"""{S.OFFERS_SQL},
prod AS (SELECT * REPLACE (model AS sku, ord * 100000 + CAST(split_part(sku, '-', 2) AS BIGINT) AS ord) FROM offers),
words AS (SELECT sku, ord, regular_price, sale_price, unnest(w) AS color, generate_subscripts(w, 1) AS pos
  FROM (SELECT *, regexp_split_to_array(colors, ' ?[|,] ?') AS w FROM prod)),
vars AS (SELECT *, {map_sql(_ENGLISH)}[color] AS en, sku || '-' || {map_sql(_ENGLISH)}[color] AS vsku FROM (
  SELECT *, row_number() OVER (PARTITION BY sku, color ORDER BY ord, pos) AS rn FROM words) WHERE rn = 1),
excl AS (SELECT CAST(p_partkey + 1000 AS VARCHAR) || '-' || c AS sku FROM (SELECT p_partkey, unnest(
   CASE WHEN p_size > 45 THEN {list(ENGLISH)} WHEN p_size <= 10 THEN ['black', 'white'] END) AS c FROM part)),
heads AS (SELECT *, regexp_replace(name, ' کد [0-9]+', '') AS bare FROM (
  SELECT *, row_number() OVER (PARTITION BY sku ORDER BY ord) AS rn FROM prod) WHERE rn = 1),
latin AS (SELECT * FROM (VALUES ('کیف پول', 'kif-pol'), ('کوله\u200cپشتی', 'kolh-pshti'), ('کیف زنانه', 'kif-znanh'),
   ('کیف مردانه', 'kif-mrdanh'), ('چمدان', 'chmdan'), ('کیف ساک', 'kif-sak'), ('کیف', 'kif')) t(k, e)),
style AS (SELECT * FROM (VALUES ('روزمره', 'rozmrh'), ('اداری', 'adari'), ('دستی', 'dsti')) t(s, es)),
named AS (SELECT h.*, CASE bare WHEN 'کیف دستی' THEN 'handbag' ELSE e || '-' || es END AS name_en
   FROM heads h, latin, style WHERE bare = k || ' ' || s)"""
_FA = "translate({}, '0123456789', '۰۱۲۳۴۵۶۷۸۹')"
_FILES_SQL = f"""files AS (SELECT *, sku || letter || '_' || tail AS stem FROM (SELECT DISTINCT CAST(l_partkey + 1000 AS VARCHAR) AS sku,
   CASE WHEN l_quantity <= 26 THEN chr(CAST(96 + l_quantity AS INTEGER)) ELSE 'a' || chr(CAST(70 + l_quantity AS INTEGER)) END AS letter,
   {S.pick_sql(ENGLISH, 'l_linenumber % 8')} AS tail FROM lineitem)),
pics AS (SELECT *, CASE WHEN row_number() OVER (PARTITION BY sku, letter ORDER BY stem) = 1 THEN sku || letter ELSE stem END AS source,
   row_number() OVER (PARTITION BY sku ORDER BY length(letter), letter, stem) - 1 AS i FROM files)"""
_FOLD = f"""{_FILES_SQL},
pal AS (SELECT unnest({list(ENGLISH)}) AS c),
steps AS (SELECT a.c AS norm, b.c AS tail, CASE WHEN contains(a.c, b.c) OR contains(b.c, a.c) THEN 1
   WHEN list_bool_or(list_transform(string_split(a.c, '-'), lambda w: contains(b.c, w))) THEN 2
   WHEN (a.c, b.c) IN (('blue', 'navy-blue'), ('navy-blue', 'blue'), ('blue', 'sky-blue'), ('sky-blue', 'blue')) THEN 3 END AS step
   FROM pal a, pal b),
cols AS (SELECT sku, en AS norm, row_number() OVER (PARTITION BY sku ORDER BY ord, pos) AS k FROM vars),
fold AS (SELECT sku, CAST(0 AS BIGINT) AS k, [CAST(0 AS BIGINT)] AS used, CAST(NULL AS VARCHAR) AS norm, CAST(NULL AS BIGINT) AS i, CAST(NULL AS INTEGER) AS step FROM heads
  UNION ALL
  SELECT sku, k, CASE WHEN b IS NULL THEN used ELSE list_append(used, b.i) END, norm, b.i, b.step FROM (
    SELECT f.sku, c.k, f.used, c.norm, (SELECT min({{'step': s.step, 'i': p.i}}) FROM pics p JOIN steps s ON s.tail = p.tail
       WHERE p.sku = f.sku AND s.norm = c.norm AND s.step IS NOT NULL AND NOT list_contains(f.used, p.i)) AS b
    FROM fold f JOIN cols c ON c.sku = f.sku AND c.k = f.k + 1))"""
_REC = f"WITH RECURSIVE {_P}, {_FOLD}"
_BASE = "n.name_en || '-' || n.model"
_MAPPED = f"""mapped AS (
  SELECT n.sku, p.i, p.source, {_BASE} || '-' || CASE WHEN p.i = 0 THEN 'main' WHEN f.norm IS NOT NULL THEN f.norm
     ELSE lpad(CAST(sum(CASE WHEN p.i > 0 AND f.norm IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY n.sku ORDER BY p.i) AS VARCHAR), 2, '0') END || '.webp' AS target
  FROM named n JOIN pics p ON p.sku = n.sku LEFT JOIN fold f ON f.sku = p.sku AND f.i = p.i)"""
_ONE = "SELECT *, row_number() OVER (PARTITION BY is_old, sku ORDER BY ord) AS rn FROM offers"
_SIDES = f"""{S.OFFERS_SQL}, one AS (SELECT * FROM ({_ONE}) WHERE rn = 1),
cat AS (SELECT sku, name, regular_price, sale_price FROM one WHERE is_old),
fil AS (SELECT sku, name, regular_price, sale_price FROM one WHERE NOT is_old)"""

QUERIES = {
    "explode_variants": (explode_variants, f"""WITH {S.OFFERS_SQL}
SELECT sku, ord, CAST(unnest(range(len(w))) AS INTEGER) AS color_pos, unnest(w) AS color
FROM (SELECT sku, ord, regexp_split_to_array(colors, ' ?[|,] ?') AS w FROM offers)"""),
    "export_parents": (export_parents, f"""WITH {_P},
cl AS (SELECT sku, string_agg(color, '|' ORDER BY ord, pos) AS colors, list(color ORDER BY ord, pos) AS l,
       bool_and(vsku IN (SELECT sku FROM excl)) AS gone FROM vars GROUP BY sku)
SELECT n.sku, bare || ' کد ' || {_FA.format('model')} AS post_title, regular_price, sale_price, cl.colors, usage,
  'کاربرد' AS usage_label, bare || ' کد ' || model AS seo_title,
  substring('خرید ' || bare || ' کد ' || model || ' به رنگ ' || array_to_string(cl.l[1:3], ' و ') || ' با کیفیت عالی و قیمت مناسب از فروشگاه ویترین', 1, 155) AS seo_text,
  'https://shop.example/product/' || name_en || '-' || model || '/' AS canonical,
  'https://shop.example/images/' || name_en || '-' || model || '-main.webp' AS images
FROM named n JOIN cl ON cl.sku = n.sku WHERE NOT gone"""),
    "export_variants": (export_variants, f"""{_REC}, {_MAPPED},
kept AS (SELECT v.*, row_number() OVER (PARTITION BY sku ORDER BY ord, pos) AS k FROM vars v WHERE vsku NOT IN (SELECT sku FROM excl)),
hits AS (SELECT sku, norm, k FROM fold WHERE i IS NOT NULL),
own AS (SELECT kept.*, (SELECT min({{'r': CASE WHEN h.norm = kept.en THEN 0 ELSE 1 END, 'k': h.k, 'norm': h.norm}}) FROM hits h
   WHERE h.sku = kept.sku AND (contains(h.norm, kept.en) OR contains(kept.en, h.norm))) AS h FROM kept),
lft AS (SELECT *, sum(CASE WHEN h IS NULL THEN 1 ELSE 0 END) OVER (PARTITION BY sku ORDER BY k) AS g FROM own),
gen AS (SELECT m.sku, m.target, row_number() OVER (PARTITION BY m.sku ORDER BY m.i) AS g FROM mapped m
   LEFT JOIN fold f ON f.sku = m.sku AND f.i = m.i WHERE m.i > 0 AND f.i IS NULL)
SELECT o.vsku AS sku, o.sku AS parent_sku, o.regular_price,
  COALESCE({_BASE} || '-' || o.h.norm || '.webp', gen.target, {_BASE} || '-main.webp') AS image_filename,
  bare || ' کد ' || {_FA.format('n.model')} || ' - ' || o.color AS image_alt, o.color
FROM lft o JOIN named n ON n.sku = o.sku LEFT JOIN gen ON gen.sku = o.sku AND gen.g = o.g AND o.h IS NULL"""),
    "export_gallery": (export_gallery, f"""{_REC}, {_MAPPED},
h AS (SELECT m.*, f.norm, CASE WHEN m.i = 0 THEN 0 WHEN f.norm IS NOT NULL THEN f.k ELSE 1000 + m.i END AS o
  FROM mapped m LEFT JOIN fold f ON f.sku = m.sku AND f.i = m.i),
g AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY sku, target ORDER BY o) AS once FROM h) WHERE once = 1)
SELECT g.sku, CAST(row_number() OVER (PARTITION BY g.sku ORDER BY o) - 1 AS INTEGER) AS pos, target AS file,
  n.bare || ' کد ' || n.model || CASE WHEN g.i = 0 THEN '' WHEN g.norm IS NULL THEN ' - نمای ' || regexp_extract(target, '([0-9]+).webp$', 1)
    ELSE ' رنگ ' || (SELECT arg_min(c.norm, c.k) FROM cols c WHERE c.sku = g.sku AND (c.norm = g.norm OR suffix(g.norm, '-' || c.norm))) END AS alt
FROM g JOIN named n ON n.sku = g.sku"""),
    "excluded_variants": (excluded_variants, f"""WITH {_P}
SELECT sku, color, vsku AS variant_sku FROM vars WHERE vsku NOT IN (SELECT sku FROM excl)"""),
    "excluded_products": (excluded_products, f"""WITH {_P}
SELECT sku FROM vars GROUP BY sku HAVING bool_and(vsku IN (SELECT sku FROM excl))"""),
    "export_split": (export_split, f"""WITH {_P}, listed AS (SELECT CAST(o_custkey + 1000 AS VARCHAR) AS sku FROM orders)
SELECT 'product' AS post_type, sku, '' AS parent_sku FROM heads WHERE sku IN (SELECT sku FROM listed)
UNION ALL SELECT 'product_variation', vsku, sku FROM vars WHERE sku IN (SELECT sku FROM listed)"""),
    "dimensions": (dimensions, f"""
SELECT p_partkey, p_size || 'cm' AS length, '4.5cm' AS width, CASE WHEN p_size > 20 THEN (p_size % 7) || 'cm' END AS depth,
  'طول: ' || {_FA.format('CAST(p_size AS VARCHAR)')} || 'cm|عرض: ۴.۵cm' || CASE WHEN p_size > 20
    THEN '|کف: ' || {_FA.format('CAST(p_size % 7 AS VARCHAR)')} || 'cm' ELSE '' END AS cell FROM part"""),
    "descriptions": (descriptions, f"""WITH {_P}
SELECT model, count(*) AS rows, max(substring(name || ' ' || model || ' | فروشگاه آنلاین', 1, 60)) AS title,
  max(md5(chr(10) || name || ' مدل ' || model || ' یک انتخاب عالی برای استفاده ' || usage || ' است. این محصول با جنس باکیفیت چرم ساخته شده و در رنگ\u200cهای متنوع ' || colors
   || ' در دسترس می\u200cباشد.' || chr(10) || chr(10) || 'با توجه به طراحی زیبا و کاربردی، این ' || name || ' می\u200cتواند همراه ایده\u200cآل شما در فعالیت\u200cهای روزمره باشد. '
   || chr(10) || chr(10) || 'برای خرید و کسب اطلاعات بیشتر با ما تماس بگیرید.' || chr(10))) AS full_md5,
  max(name || ' کد ' || model) AS keyword FROM prod GROUP BY model"""),
    "assign_images": (assign_images, f"""{_REC}
SELECT f.sku, f.norm AS color, p.source, CASE f.step WHEN 1 THEN 'exact' WHEN 2 THEN 'word' ELSE 'similar' END AS kind
FROM fold f JOIN pics p ON p.sku = f.sku AND p.i = f.i WHERE f.i IS NOT NULL"""),
    "image_mapping": (image_mapping, f"{_REC}, {_MAPPED} SELECT source, target FROM mapped"),
    "image_gate": (image_gate, f"""{_REC}, {_MAPPED}
SELECT count(*) AS expected, count(*) AS copied, CAST(0 AS BIGINT) AS missing, '' AS missing_sources, TRUE AS passed FROM mapped"""),
    "rename_plan": (rename_plan, """
WITH f AS (SELECT (l_partkey + 1) || '_' || l_orderkey || '_' || l_linenumber || '_' || l_suppkey || '.jpg' AS path,
    CAST(l_partkey + 1 AS VARCHAR) AS product_no, row_number() OVER (PARTITION BY l_partkey
      ORDER BY CASE WHEN l_returnflag = 'R' THEN 0 ELSE 1 END, l_orderkey, l_linenumber, l_suppkey) AS position
    FROM lineitem WHERE l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 40)),
n AS (SELECT *, CASE WHEN position <= 26 THEN chr(CAST(96 + position AS INTEGER))
    ELSE chr(CAST(96 + (position - 1) // 26 AS INTEGER)) || chr(CAST(97 + (position - 1) % 26 AS INTEGER)) END AS letter FROM f)
SELECT path, product_no, position, letter, product_no || letter || '.webp' AS new_name, CASE WHEN letter = 'a' THEN 100 ELSE 50 END AS limit_kb FROM n"""),
    "folder_pick": (folder_pick, """
WITH f AS (SELECT DISTINCT '2024-01-' || lpad(CAST(l_suppkey % 28 + 1 AS VARCHAR), 2, '0') AS folder, l_partkey, l_suppkey % 28 < 20 AS marked FROM lineitem),
c AS (SELECT folder, count(*) FILTER (l_partkey IN (SELECT p_partkey FROM part WHERE p_size > 25)) AS coverage, bool_or(marked) AS marked FROM f GROUP BY folder)
SELECT *, row_number() OVER (ORDER BY marked DESC, coverage DESC, folder DESC) = 1 AS picked FROM c"""),
    "image_sources": (image_sources, f"""WITH {_FILES_SQL},
w AS (SELECT CAST(p_partkey + 1000 AS VARCHAR) AS sku, unnest(['a', 'b', 'z']) AS letter FROM part)
SELECT w.sku || w.letter AS source, 'img/' || w.sku || w.letter || '_' || tail || '.webp' AS path, tail IS NOT NULL AS found
FROM w LEFT JOIN (SELECT sku, letter, min(tail) AS tail FROM files GROUP BY sku, letter) USING (sku, letter)"""),
    "existing_files": (existing_files, """
SELECT CASE WHEN p_size % 2 = 1 THEN 'A' ELSE '' END || (l_partkey + 1000) AS sku, count(*) AS files
FROM lineitem JOIN part ON p_partkey = l_partkey WHERE p_size > 25 GROUP BY 1"""),
    "size_reduction": (size_reduction, """
SELECT n AS input_files, b AS input_bytes, n AS output_files, a AS output_bytes, b - a AS saved_bytes, round((b - a) / CAST(b AS DOUBLE) * 100, 6) AS reduction_percent
FROM (SELECT count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS b, CAST(sum(doc_id * 3) AS BIGINT) AS a FROM documents)"""),
    "size_pairs": (size_pairs, """
WITH o AS (SELECT substring(CAST(doc_id AS VARCHAR), 1, 2) AS lead, min(doc_id || '.jpg') AS path, arg_min(n_chars, doc_id || '.jpg') AS length FROM documents GROUP BY 1)
SELECT d.doc_id || '.webp' AS path, d.doc_id * 3 AS length, o.path AS original_path, o.length AS original_length,
  CASE WHEN o.length > 0 THEN round((o.length - d.doc_id * 3) / CAST(o.length AS DOUBLE) * 100, 6) ELSE 0 END AS reduction_percent,
  CASE WHEN d.doc_id * 3 < o.length THEN 'DOWN' WHEN d.doc_id * 3 > o.length THEN 'UP' ELSE 'SAME' END AS status
FROM documents d JOIN o ON o.lead = substring(CAST(d.doc_id AS VARCHAR), 1, 2)"""),
    "dominant_colors": (dominant_colors, """
WITH c AS (SELECT l_orderkey AS image, l_partkey * 37 % 256 AS r, l_suppkey * 91 % 256 AS g, CAST(l_quantity AS BIGINT) * 5 % 256 AS b,
   l_quantity / 100 AS share, l_orderkey % 2 = 0 AS dark FROM lineitem),
s AS (SELECT *, (r + g + b) / 3.0::DOUBLE AS light, greatest(r, g, b) AS mx, least(r, g, b) AS mn FROM c),
k AS (SELECT *, CASE WHEN mx = 0 THEN 0 ELSE (mx / 255.0::DOUBLE - mn / 255.0::DOUBLE) / (mx / 255.0::DOUBLE) END AS sat FROM s
   WHERE share > 0.05 AND NOT (r > 235 AND g > 235 AND b > 235) AND NOT (mx - mn < 25 AND light > 200)),
z AS (SELECT *, sat * 2.0::DOUBLE + share * 4.0::DOUBLE + CASE WHEN dark THEN CASE WHEN light < 60 THEN 5.0::DOUBLE WHEN light < 100 THEN 3 ELSE -2 END
   ELSE CASE WHEN sat > 0.3 THEN 2.0::DOUBLE WHEN light > 200 THEN -3 ELSE 0 END END AS score FROM k)
SELECT image, r, g, b FROM (SELECT *, row_number() OVER (PARTITION BY image ORDER BY score DESC, share DESC, r, g, b) AS rn FROM z) WHERE rn = 1"""),
    "image_letters": (image_letters, """
WITH RECURSIVE w AS (SELECT o_orderkey, o_orderpriority, CAST(o_orderkey * 7 AS BIGINT) AS i, '' AS letter FROM orders
  UNION ALL SELECT o_orderkey, o_orderpriority, i // 26 - 1, chr(CAST(97 + i % 26 AS INTEGER)) || letter FROM w WHERE i >= 0)
SELECT o_orderkey, letter, lower(o_orderpriority) AS color FROM w WHERE i < 0"""),
    "rewritten_urls": (rewritten_urls, """
SELECT p_partkey, CASE WHEN p_size > 25 THEN 'https://cdn.example/a.webp|https://x.example/i/' || p_partkey || '.webp'
  WHEN p_size > 10 THEN 'https://cdn.example/a.webp' ELSE '' END AS images FROM part"""),
    "apply_full": (apply_full, f"""WITH {_SIDES}
SELECT * FROM fil UNION ALL SELECT * FROM cat WHERE sku NOT IN (SELECT sku FROM fil)"""),
    "apply_new": (apply_new, f"""WITH {_SIDES}
SELECT * FROM cat UNION ALL SELECT * FROM fil WHERE sku NOT IN (SELECT sku FROM cat)"""),
    "apply_update": (apply_update, f"""WITH {_SIDES}
SELECT c.sku, c.name, COALESCE(f.regular_price, c.regular_price) AS regular_price,
  CASE WHEN f.sku IS NULL THEN c.sale_price ELSE f.sale_price END AS sale_price FROM cat c LEFT JOIN fil f ON f.sku = c.sku"""),
    "apply_manifest": (apply_manifest, f"""WITH {_SIDES}
SELECT COALESCE(c.sku, f.sku) AS sku, COALESCE(c.name, f.name) AS name, COALESCE(f.regular_price, c.regular_price) AS regular_price,
  CASE WHEN f.sku IS NULL THEN c.sale_price ELSE f.sale_price END AS sale_price FROM cat c FULL OUTER JOIN fil f ON f.sku = c.sku"""),
    "import_log": (import_log, f"""WITH {_SIDES}, t AS (SELECT count(*) FILTER (sku IN (SELECT sku FROM cat)) AS k, count(*) FILTER (sku NOT IN (SELECT sku FROM cat)) AS u FROM fil)
SELECT kind, action, CASE WHEN known THEN k ELSE u END AS rows FROM t, (VALUES ('full', 'update', TRUE), ('full', 'create', FALSE),
  ('new', 'skip', TRUE), ('new', 'create', FALSE), ('update', 'update', TRUE), ('update', 'skip', FALSE)) x(kind, action, known)"""),
    "manifest_counts": (manifest_counts, f"""WITH {S.OFFERS_SQL}
SELECT 'full' AS kind, 'full_catalog' AS purpose, 'all_fields' AS update_scope, 1 AS import_priority, count(DISTINCT sku) AS sku_count, count(*) AS row_count FROM offers
UNION ALL SELECT 'new', 'new_products', 'create_only', 2, count(DISTINCT sku), count(*) FROM offers WHERE is_old
UNION ALL SELECT 'update', 'updated_products', 'price|color_variants|stock', 3, count(DISTINCT sku), count(*) FROM offers WHERE NOT is_old"""),
    "manifest_json": (manifest_json, f"""WITH {S.OFFERS_SQL}, c AS (SELECT is_old, count(DISTINCT sku) AS s, count(*) AS r FROM offers GROUP BY is_old)
SELECT '{{"generated_at":"2024-01-02T03:04:05","mode":"incremental","files":[{{"import_priority":2,"file_name":"new.csv","purpose":"new_products","update_scope":"create_only","generated_date":"2024-01-02","sku_count":'
 || (SELECT s FROM c WHERE is_old) || ',"row_count":' || (SELECT r FROM c WHERE is_old)
 || '}},{{"import_priority":3,"file_name":"update.csv","purpose":"updated_products","update_scope":"price|color_variants|stock","generated_date":"2024-01-02","sku_count":'
 || (SELECT s FROM c WHERE NOT is_old) || ',"row_count":' || (SELECT r FROM c WHERE NOT is_old) || '}}],"images":{{"copied":true}}}}' AS value"""),
}
