"""Readers.  Text tables arrive all-string; types are set by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from vitrine import vocab as V
from vitrine.functions.text import found, is_blank, leading_number, numeric_code, trim_any
from vitrine.operators.columns import resolve_column, tidy_headers
from vitrine.operators.dictionary import pairs_frame, usable_entries
from vitrine.operators.images import expected_scope
from vitrine.operators.scale import last_by_key

EXCEL_SUFFIXES = (".xlsx", ".xls")


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


LISTING = strings("No", "Product Name", "Product URL", "Price")


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None,
               multi_line: bool = False) -> DataFrame:
    """Table by its suffix: CSV, JSON lines, else Parquet.

    A CSV file is split among tasks.  Where quoted cells hold line breaks pass
    ``multi_line=True``, which keeps a file in one task.
    """
    low = path.lower().rstrip("/")
    if low.endswith(EXCEL_SUFFIXES):
        raise ValueError("land spreadsheets as CSV or Parquet first")
    reader = spark.read.schema(schema) if schema is not None else spark.read
    if low.endswith(".csv"):
        df = reader.csv(path, header=True, multiLine=multi_line, quote='"', escape='"',
                        enforceSchema=True)
        return tidy_headers(df)
    if low.endswith((".json", ".jsonl")):
        return reader.json(path)
    return reader.parquet(path)


def read_catalog(spark: SparkSession, path: str, multi_line: bool = True) -> tuple[DataFrame, DataFrame]:
    """Previous catalogue as (products, variants), keys trimmed, names English.

    Descriptions hold line breaks; a CSV known to have none can be split.
    """
    df = read_table(spark, path, multi_line=multi_line)
    if "ord" not in df.columns:
        df = with_file_order(df)
    df = df.withColumns({c: F.coalesce(trim_any(c), F.lit("")) for c in ("sku", "parent_sku")})
    kind = trim_any("post_type")
    named = df.withColumnsRenamed({"post_title": "name", "attribute:color": "colors"})
    variants = df.withColumnRenamed("attribute:color", "color").filter(kind == "product_variation")
    return named.filter(kind == "product"), variants


def with_file_order(df: DataFrame) -> DataFrame:
    """Input position as ``ord``: unique and increasing within a file."""
    return df.withColumn("ord", F.monotonically_increasing_id())


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    df = read_table(spark, path)
    got = {"Product Name": "product_name", "Product URL": "product_url", "Price": "price"}
    return with_file_order(df.withColumnsRenamed({k: v for k, v in got.items() if k in df.columns}))


def listing_by_code(listing: DataFrame) -> DataFrame:
    keyed = listing.withColumn("code", numeric_code("product_name")).filter("code is not null")
    return last_by_key(keyed, "code", "ord")


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found_any = fs.globStatus(hadoop)
    return found_any is not None and len(found_any) > 0


def read_dictionary(spark: SparkSession, path: str | None, default: dict | None = None) -> DataFrame:
    """(ord, term, translation) from a Persian/English table, else the default."""
    if path is None or not exists(spark, path):
        return pairs_frame(spark, default or {})
    df = with_file_order(read_table(spark, path))
    columns = {c.strip().lower(): c for c in df.columns}
    term = columns.get("persian", df.columns[0])
    target = columns.get("english", df.columns[1])
    return usable_entries(df.select("ord", F.col(term).alias("term"),
                                    F.col(target).alias("translation")))


def read_word_index(spark: SparkSession, path: str) -> DataFrame:
    """(ord, term, translation) from an English/Persian two-column table."""
    df = with_file_order(read_table(spark, path))
    return usable_entries(df.select("ord", F.col(df.columns[0]).alias("term"),
                                    F.col(df.columns[1]).alias("translation")))


def read_colors(spark, path=None) -> DataFrame:
    return read_dictionary(spark, path, V.COLOR_ENGLISH)


def read_product_names(spark, path=None) -> DataFrame:
    return read_dictionary(spark, path, V.PRODUCT_ENGLISH)


def read_price_rules(spark: SparkSession, path: str) -> DataFrame:
    """Brackets by their header words, in file order."""
    df = read_table(spark, path)
    parts = {"from_price": "مقدار_از", "to_price": "مقدار_تا",
             "increase_percent": "درصد_افزایش", "discount_percent": "درصد_تخفیف"}

    def number(name, part):
        column = name if name in df.columns else resolve_column(df, part)
        value = F.col(f"`{column}`").try_cast("double") if column else F.lit(None)
        return F.coalesce(value, F.lit(0.0)).alias(name)

    return df.select(F.monotonically_increasing_id().alias("rule_ord"),
                     *[number(n, p) for n, p in parts.items()])


# ---- files by name -----------------------------------------------------------------

def latest_by_stamp(files: DataFrame, pattern: str, path: str = "path") -> DataFrame:
    """File with the greatest stamp its name yields for ``pattern``."""
    stamped = files.withColumn("stamp", found(F.regexp_replace(path, r"^.*/", ""), pattern))
    best = F.max_by(F.struct(path, "stamp"), F.struct("stamp", path))
    return (stamped.filter("stamp is not null").agg(best.alias("best"))
            .filter("best is not null").select("best.*"))


def read_latest_stamped(spark: SparkSession, folder: str, glob: str, pattern: str,
                        recursive: bool = False, fmt: str = "csv", **options) -> DataFrame | None:
    """Newest of the dated tables in a folder, None when there is none.

    Only file names are looked at to find it.
    """
    files = inventory(spark, folder, glob, recursive)
    newest = latest_by_stamp(files, pattern).first()
    if newest is None:
        return None
    return tidy_headers(spark.read.format(fmt).options(**options).load(newest.path))


def inventory(spark: SparkSession, folder: str, glob: str = "*", recursive: bool = True) -> DataFrame:
    """path, length and modification time of files; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", str(recursive).lower()).load(folder)
            .select("path", "length", "modificationTime"))


def image_inventory(spark: SparkSession, folder: str, extensions=(
        "jpg", "jpeg", "png", "gif", "bmp", "tiff", "webp")) -> DataFrame:
    files = inventory(spark, folder)
    kept = files.filter(F.lower("path").rlike(r"\.(" + "|".join(extensions) + ")$"))
    name = F.regexp_replace("path", r"^.*/", "")
    return kept.withColumn("product_no", leading_number(name)).withColumn(
        "folder", F.regexp_extract("path", r"([^/]+)/[^/]+$", 1))


# ---- key lists -----------------------------------------------------------------------

def seed_urls(df: DataFrame) -> DataFrame:
    """URL column, else url, else the first one; blanks dropped, trimmed."""
    name = next((c for c in ("URL", "url") if c in df.columns), df.columns[0])
    return df.select(trim_any(F.col(f"`{name}`")).alias("url")).filter("url <> ''")


def manifest_urls(df: DataFrame) -> DataFrame:
    """Download source: URL, key and a name made up from the key if needed."""
    def pick(*names):
        return next((F.col(f"`{c}`") for c in names if c in df.columns), F.lit(None).cast("string"))
    sku = pick("sku")
    named = F.coalesce(pick("name", "Product Name"), F.concat(F.lit(V.CODE_WORD + " "), sku))
    return df.select(sku.alias("sku"), named.alias("name"),
                     trim_any(pick("url", "Product URL")).alias("url")).filter("url <> ''")


def image_key(df: DataFrame, row_number: str = "ord") -> Column:
    """Key image files are named by: sku, else the code in the name, else the row."""
    from vitrine.functions.text import code_or_first_number, nullify_blank
    got = []
    if "sku" in df.columns:
        got.append(nullify_blank("sku"))
    if "product_name" in df.columns:
        got.append(code_or_first_number("product_name"))
    return F.coalesce(*got, F.col(row_number).cast("string"))


def excluded_keys(spark: SparkSession, path: str) -> DataFrame:
    if not exists(spark, path):
        return spark.createDataFrame([], "sku string")
    return spark.read.text(path).select(trim_any("value").alias("sku")).filter("sku <> ''")


def expected_keys(df: DataFrame) -> DataFrame:
    """Distinct numeric prefixes of a table's sku column, empty without one."""
    name = resolve_column(df, equal="sku", ignore_case=True)
    if name is None:
        return df.sparkSession.createDataFrame([], "sku string")
    key = found(trim_any(F.col(f"`{name}`")), r"^([0-9]+)")
    return df.select(key.alias("sku")).filter("sku is not null").distinct()


def keys_to_import(file_keys: DataFrame, listed: str | None) -> DataFrame:
    """File keys cut to the listed scope; the scope itself if the file has none."""
    scope = expected_scope(file_keys.sparkSession, listed)
    if scope is None:
        return file_keys
    if file_keys.isEmpty():
        return scope
    return file_keys.join(scope, "sku", "left_semi")


def missing_term_log(spark: SparkSession, path: str) -> DataFrame:
    """Distinct terms of '[time] term -> suggestion' lines."""
    lines = spark.read.text(path).filter(F.col("value").rlike("→|->"))
    term = trim_any(found("value", r"^[^\]]*\](.*?)(?:→|->)"))
    return lines.select(term.alias("term")).filter(~is_blank("term")).distinct()


def read_snapshot(spark: SparkSession, path: str, date: str | None = None) -> DataFrame:
    """A daily snapshot partition, the latest one by default."""
    df = spark.read.parquet(path)
    if date is None:
        # A partition column: answered from folder names.
        date = df.agg(F.max("snapshot_date")).first()[0]
    return df.filter(F.col("snapshot_date") == F.lit(date))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path).select("page_id", "url", "html")
