"""Sources, sinks, plans and streams on files."""

import datetime
import os
import pathlib

import pytest
from pyspark.sql import functions as F

from vitrine import vocab as V
from vitrine.operators import manifest as M
from vitrine.operators.tracking import listing_extract
from vitrine.plans.catalogue import export_catalog, picture_gate
from vitrine.plans.changes import choose_mode, detect_changes, write_changes
from vitrine.plans.prices import track_prices
from vitrine.operators.dictionary import pairs_frame
from vitrine.session import shared_folder, shuffles_dropped
from vitrine.sources import readers as I
from vitrine.sources import writers as W
from vitrine.streaming import ingest as G
from tests.test_operators import _catalogue


def _lines(folder):
    out = []
    for name in sorted(os.listdir(folder)):
        if name.startswith("part-"):
            with open(os.path.join(folder, name), encoding="utf-8") as f:
                out += f.read().splitlines()
    return out


def test_catalogue_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "cat.csv")
    rows = spark.createDataFrame([
        ("product", "کیف, \"x\"", " 1 ", "", 7.0, "آبی"), ("product_variation ", "", "1-b", "1", None, "آبی\nتیره")],
        ["post_type", "post_title", "sku", "parent_sku", "regular_price", "attribute:color"])
    W.write_csv(rows, path)
    assert _lines(path)[0].startswith("\ufeff")
    products, variants = I.read_catalog(spark, path)
    p = products.collect()
    assert [(r.sku, r.name, r.regular_price, r.colors) for r in p] == [("1", 'کیف, "x"', "7", "آبی")]
    assert [(r.sku, r.parent_sku, r.color) for r in variants.collect()] == [("1-b", "1", "آبی\nتیره")]
    with pytest.raises(ValueError):
        I.read_table(spark, "x.xlsx")


def test_empty_manifest_keeps_its_header(spark, tmp_path):
    empty = spark.createDataFrame([], "sku string, name string")
    W.write_manifests(empty, empty, empty, str(tmp_path))
    assert _lines(tmp_path / "new_products_list") == ["\ufeffsku,name"]


def test_key_sources(spark, tmp_path):
    (tmp_path / "x.txt").write_text(" 9266-red \n\n 12 \n", encoding="utf-8")
    assert {r.sku for r in I.excluded_keys(spark, str(tmp_path / "x.txt")).collect()} == {"9266-red", "12"}
    assert I.excluded_keys(spark, str(tmp_path / "none.txt")).count() == 0
    table = spark.createDataFrame([("9266-a",), ("9321",), ("9266",), ("x",), (None,)], ["SKU "])
    keys = I.expected_keys(table)
    assert {r.sku for r in keys.collect()} == {"9266", "9321"}
    assert I.expected_keys(spark.range(3)).count() == 0
    assert {r.sku for r in I.keys_to_import(keys, "9266, 9280-black").collect()} == {"9266"}
    assert {r.sku for r in I.keys_to_import(keys, " ").collect()} == {"9266", "9321"}
    (tmp_path / "log").write_text("[2024-01-01 00:00:00] کیف نو → kif-no\n[t] b -> c\n[t] b -> c\nx\n", encoding="utf-8")
    assert {r.term for r in I.missing_term_log(spark, str(tmp_path / "log")).collect()} == {"کیف نو", "b"}
    seeds = spark.createDataFrame([(" a ", "z"), (None, "z"), (" ", "z")], ["url", "n"])
    assert [r.url for r in I.seed_urls(seeds).collect()] == ["a"]
    man = spark.createDataFrame([("7", None, " u "), ("8", "n", "")], "sku string, name string, url string")
    assert [tuple(r) for r in I.manifest_urls(man).collect()] == [("7", "کد 7", "u")]


def test_image_key_priority(spark):
    df = spark.createDataFrame([("1", "x", "کد 5"), ("2", None, "کیف کد 9280"), ("3", "", "کیف")],
                               "ord string, sku string, product_name string")
    assert [r.k for r in df.select(I.image_key(df).alias("k")).collect()] == ["x", "9280", "3"]


def test_latest_file_and_inventory(spark, tmp_path):
    for name in ("product_details_20240101_000000.csv", "product_details_20240301_000000.csv", "other.csv"):
        (tmp_path / name).write_text("sku\n" + name, encoding="utf-8")
    df = I.read_latest_stamped(spark, str(tmp_path), "*.csv", r"product_details_([0-9]{8}_[0-9]{6})\.csv$", header=True)
    assert df.first().sku == "product_details_20240301_000000.csv"
    assert I.read_latest_stamped(spark, str(tmp_path), "*.csv", "nothing(.)") is None
    (tmp_path / "9266a_red.JPG").write_bytes(b"12345")
    inv = I.image_inventory(spark, str(tmp_path)).collect()
    assert [(r.product_no, r.length) for r in inv] == [("9266", 5)]


def test_dictionary_source(spark, tmp_path):
    path = str(tmp_path / "colors.csv")
    W.write_csv(spark.createDataFrame([("آبی", "blue"), ("", "x"), ("nan", "y")], ["Persian", "English"]), path)
    assert [r.translation for r in I.read_colors(spark, path).collect()] == ["blue"]
    assert I.read_colors(spark, None).count() == len(V.COLOR_ENGLISH)


def test_snapshots_are_kept_once_and_expire(spark, tmp_path):
    path = str(tmp_path / "snap")
    assert W.write_daily_snapshot(spark.range(3), path, "2024-01-01")
    assert not W.write_daily_snapshot(spark.range(9), path, "2024-01-01")
    W.write_daily_snapshot(spark.range(5), path, "2024-02-10")
    assert I.read_snapshot(spark, path).count() == 5
    assert W.drop_old_snapshots(spark, path, "2024-02-11") == ["2024-01-01"]
    assert spark.read.parquet(path).count() == 5


def test_change_detection_end_to_end(spark, tmp_path):
    scan, catalog, variants = _catalogue(spark)
    listing = spark.createDataFrame([(1, "کیف کد 300", "http://u/300", "5"), (2, "کیف کد ۳۰۰", "http://u/last", "6")],
                                    "ord int, product_name string, product_url string, price string")
    changes = detect_changes(scan, catalog, variants, listing)
    assert changes.images.filter("sku = '300'").first().url == "http://u/last"
    assert {r.change_type for r in changes.updated.filter("sku = '100'").collect()} == {"price", "color"}
    assert choose_mode(changes.counts, True) == {"mode": "incremental", "stop": False, "images": True}
    assert choose_mode(changes.counts, False)["mode"] == "full"
    write_changes(changes, str(tmp_path))
    assert _lines(tmp_path / "skus_to_delete") == ["400", "400-b", "200-y"]


def test_compressed_sheets_have_the_same_rows_and_settings_stay(spark, tmp_path):
    scan, catalog, variants = _catalogue(spark)
    listing = spark.createDataFrame([], "ord int, product_name string, product_url string, price string")
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, changes = spark.conf.get(key), detect_changes(scan, catalog, variants, listing)
    for name, codec in (("plain", None), ("small", "gzip")):
        write_changes(changes, str(tmp_path / name), codec)
    assert spark.conf.get(key) == before
    with shuffles_dropped(spark):
        assert spark.conf.get(key) == "true"
    folders = {f.parent.relative_to(tmp_path / "plain") for f in (tmp_path / "plain").rglob("part-*")}
    assert len(folders) == 11
    for folder in folders:
        assert all(f.name.endswith(".gz") for f in (tmp_path / "small" / folder).glob("part-*"))
        rows = [sorted(r.value for r in spark.read.text(str(tmp_path / n / folder)).collect()) for n in ("plain", "small")]
        assert len(set(rows[0])) > 0 and set(rows[0]) == set(rows[1])


def test_report_sheets_are_stored_compressed(spark):
    from vitrine.showcase.changes import report_sheets
    folder = pathlib.Path(shared_folder(spark))
    before = set(folder.glob("vitrine-report-*"))
    report_sheets(spark, "/root/testdata/sf0.001")
    made, = set(folder.glob("vitrine-report-*")) - before
    files = list(made.rglob("part-*"))
    assert {f.name.split(".", 1)[1] for f in files} == {"csv.gz", "txt.gz"}


def test_tracking_and_history_files(spark, tmp_path):
    listing = spark.createDataFrame([(1, "کیف کد 11", "u1", "20,000 تومان"), (2, "کیف کد 12", "u2", "90,000"), (3, "کیف کد 13", "u3", None)],
                                    "ord int, product_name string, product_url string, price string")
    previous = spark.createDataFrame([("u1", "a", "11", "10000", 1), ("u3", "c", "13", "5", 2), ("u4", "d", "14", "0", 3)],
                                     "url string, name string, code string, price string, ord int")
    at = F.lit("2024-03-19 10:00:00").cast("timestamp")
    out = track_prices(listing, previous, at)
    assert {r.url: (r.status, r.percent, r.listed_unchanged) for r in out.current.collect()} == {
        "u1": ("price_changed", 100.0, False), "u2": ("new", None, False), "u3": ("unchanged", None, False)}
    assert [(r.url, r.last_price) for r in out.removed.collect()] == [("u4", None)]
    kinds = {r.sku: (r.change_type, r.persian_date) for r in out.history.collect()}
    assert kinds["11"] == ("increase", "1402/12/29") and kinds["12"][0] == "new"
    for version in (1, 2, 3):
        path = W.save_history(spark, str(tmp_path / "h"), out.history, version, rows=2)
    assert spark.read.parquet(path).filter("sku = '11'").count() == 2
    assert listing_extract(spark.createDataFrame([("n", "l")], ["name", "link"])).first().product_url == "l"


def test_catalogue_export_small(spark):
    df = spark.createDataFrame([
        ("9266", "کیف پول کد ۹۲۶۶", "9266", "مشکی | آبی", "5", "4", 3, "چرم", 1, "20cm"),
        ("77", "کیف کد 77", "77", "", "5", "", 3, None, 2, None)],
        "sku string, name string, model string, colors string, regular_price string, sale_price string, stock int, "
        "outer_material string, ord int, length string")
    files = spark.createDataFrame([("i/9266a_x.webp",), ("i/9266b_blue.webp",), ("i/9266c_y.webp",)], "path string")
    gone = spark.createDataFrame([("77-",)], "sku string")
    out = export_catalog(df, files, pairs_frame(spark, V.COLOR_ENGLISH), pairs_frame(spark, V.PRODUCT_ENGLISH), gone)
    rows = {r.sku: r for r in out.rows.collect()}
    assert set(rows) == {"9266", "9266-black", "9266-blue"}
    parent = rows["9266"]
    assert parent.post_title == "کیف پول کد ۹۲۶۶" and parent["attribute:color"] == "مشکی|آبی"
    assert parent["attribute:outer-material"] == "چرم" and parent["attribute:dimention"] == "طول: ۲۰cm"
    assert parent.image_filename == "wallet-9266-main.webp|wallet-9266-blue.webp|wallet-9266-01.webp"
    assert rows["9266-blue"].image_filename == "wallet-9266-blue.webp"
    assert rows["9266-black"].image_filename == "wallet-9266-01.webp"
    assert picture_gate(out, files).first().passed
    assert not picture_gate(out, files.filter("path not like '%c_y%'").limit(1)).first().passed


def test_manifest_document(spark, tmp_path):
    counts = M.file_counts({"full": spark.createDataFrame([("a",), ("a",)], ["sku"])})
    doc = M.import_manifest(counts, {"full": "f.csv"}, F.struct(F.lit(0).alias("file_count")), "full",
                            F.lit("2024-01-01 00:00:00").cast("timestamp"))
    W.write_manifest(doc, spark.range(3), str(tmp_path / "a"), str(tmp_path / "b"))
    assert '"sku_count":1,"row_count":2' in _lines(tmp_path / "a" / "import_manifest")[0]


# ---- streams over several batches -----------------------------------------------------

def _feed(spark, folder, n, rows):
    spark.createDataFrame(rows, "k string, price bigint, at timestamp").coalesce(1).write.mode("append").parquet(folder)


def _at(h):
    return datetime.datetime(2024, 1, 1, h)


def test_upsert_stream_resumes(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _feed(spark, src, 1, [("a", 1, _at(1)), ("b", 1, _at(1)), ("a", 2, _at(2))])
    schema = spark.read.parquet(src).schema
    def run():
        G.upsert_stream(G.file_stream(spark, src, schema), out, "k", ["at"], out + "/cp").awaitTermination()
        return {r.k: r.price for r in G.read_latest(spark, out, "k", ["at"]).collect()}
    assert run() == {"a": 2, "b": 1}
    assert run() == {"a": 2, "b": 1}
    _feed(spark, src, 2, [("a", 9, _at(0)), ("b", 5, _at(3))])
    assert run() == {"a": 2, "b": 5}
    assert {r.batch for r in spark.read.parquet(out + "/rows").select("batch").distinct().collect()} == {0, 1}


def test_stream_of_one_file_and_of_a_table_of_files(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 3) for i in range(20)], "at int, k int")
    rows.repartition(4).write.parquet(str(tmp_path / "many.parquet"))
    part = next((tmp_path / "many.parquet").glob("part-*.parquet"))
    rows.coalesce(1).write.parquet(str(tmp_path / "one"))
    next((tmp_path / "one").glob("part-*.parquet")).rename(tmp_path / "one.parquet")
    for name in ("many.parquet", "one.parquet"):
        out = str(tmp_path / f"out-{name}")
        stream = G.file_stream(spark, str(tmp_path / name), rows.schema)
        G.upsert_stream(stream, out, "k", ["at"], out + "-cp").awaitTermination()
        assert sorted(r.at for r in G.read_latest(spark, out, "k", ["at"]).collect()) == [17, 18, 19]
    assert part.exists()


def test_price_history_stream_spans_batches(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    batches = [[("a", 1, _at(1)), ("a", 1, _at(2))], [("a", 3, _at(3)), ("b", 1, _at(3))], [("a", 3, _at(4)), ("a", 2, _at(5))]]
    for n, rows in enumerate(batches):
        _feed(spark, src, n, rows)
        schema = spark.read.parquet(src).schema
        G.price_history_stream(G.file_stream(spark, src, schema), out, "k", "price", ["at"], F.hour("at"),
                               out + "/cp").awaitTermination()
    got = sorted((r.k, r.prev_price, r.price) for r in G.read_history(spark, out, "k", ["at"]).collect())
    assert got == [("a", 1, 3), ("a", 3, 2)]


def test_retry_stream_keeps_outcomes_apart(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    _feed(spark, src, 1, [("a", 1, _at(1)), ("b", 2, _at(1)), ("c", 3, _at(2))])
    stream = G.file_stream(spark, src, spark.read.parquet(src).schema)
    G.retry_stream(stream, lambda df: df.withColumns({"failed": F.col("price") > 1, "hard": F.col("price") > 2}),
                   out + "/t", out + "/cp").awaitTermination()
    assert [r.k for r in G.read_outcome(spark, out + "/t", "retry").collect()] == ["b"]


def test_shared_folder_is_the_configured_one(spark):
    assert shared_folder(spark) == shared_folder(spark)


def test_retry_rounds_resume_and_give_up(spark, tmp_path):
    src, out = f"{tmp_path}/src", f"{tmp_path}/t"
    schema = "k int, v int"

    def run():
        stream = G.file_stream(spark, src, spark.createDataFrame([], schema).schema)
        G.retry_stream(stream, lambda df: df.withColumns({
            "failed": F.col("v") >= F.col("attempt"), "hard": F.col("k") == 9}), out, f"{tmp_path}/cp", limit=3).awaitTermination()
        return {r.k: (r.outcome, r.attempt) for r in G.read_outcomes(spark, out, "k").collect()}
    spark.createDataFrame([(1, 0), (2, 1), (3, 5), (9, 5)], schema).write.parquet(src)
    assert run() == {1: ("done", 1), 2: ("retry", 1), 3: ("retry", 1), 9: ("hard_failure", 1)}
    assert sorted(r.k for r in G.read_retries(spark, out, "k").collect()) == [2, 3]
    spark.createDataFrame([(4, 0)], schema).write.mode("append").parquet(src)
    assert run() == {1: ("done", 1), 2: ("done", 2), 3: ("retry", 2), 4: ("done", 1), 9: ("hard_failure", 1)}
    assert run()[3] == ("given_up", 3)
    again = run()
    assert again[3] == ("given_up", 3) and spark.read.parquet(out).count() == 8


def test_state_of_few_keys_is_read_from_their_buckets(spark, tmp_path):
    src, schema = f"{tmp_path}/src", "k int, price int, at timestamp"
    for day in (1, 2):
        rows = [(k, k * day, f"2024-01-0{day} 00:00:00") for k in (range(200) if day == 1 else [5, 7])]
        spark.createDataFrame(rows, "k int, price int, at string").withColumn("at", F.to_timestamp("at")).write.mode("append").parquet(src)
        stream = G.file_stream(spark, src, spark.createDataFrame([], schema).schema)
        G.price_history_stream(stream, f"{tmp_path}/t", "k", "price", ["at"], F.hour("at"), f"{tmp_path}/cp").awaitTermination()
    state, batch = spark.read.parquet(f"{tmp_path}/t/state"), spark.createDataFrame([(5,), (7,)], "k int")
    read = G.earlier_state(state, batch, "k", 1)
    buckets = {r.b for r in batch.select(G.bucket_of("k").alias("b")).collect()}
    assert {r.bucket for r in read.select("bucket").distinct().collect()} <= buckets and len(buckets) <= 2
    files = [f for f in read.inputFiles()]
    assert files and "PartitionFilters: [" in read._jdf.queryExecution().executedPlan().toString()
    assert "bucket" in read._jdf.queryExecution().executedPlan().toString().split("PartitionFilters: [")[1].split("]")[0]
    assert sorted(r.k for r in G.read_history(spark, f"{tmp_path}/t", "k", ["at"]).collect()) == [5, 7]
