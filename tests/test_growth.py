"""What a query does per row must not be done again for every use of the result."""

from pyspark.sql import functions as F

from vitrine.functions import text as T
from vitrine.operators import diff as X
from vitrine.operators import export as E
from vitrine.plans.changes import detect_changes


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_variant_keys_are_made_once_for_all_sheets(spark):
    rows = "sku string, name string, regular_price string, sale_price string, colors string, ord long, image_urls string"
    catalog = spark.createDataFrame([("11111", "a", "10", None, "red | blue", 1, ""), ("22222", "b", "10", None, "red", 2, "")], rows)
    scan = spark.createDataFrame([("11111", "a", "20", None, "red", 1, "u"), ("33333", "c", "10", None, "red", 2, "u"),
                                  ("33333", "d", "10", None, "red", 3, "v")], rows)
    variants = spark.createDataFrame([("11111", "blue", "v1", 1), ("11111", "blue", "v2", 2), ("22222", "red", "v3", 3)],
                                     "parent_sku string, color string, sku string, ord long")
    listing = spark.createDataFrame([], "ord long, product_name string, product_url string, price string")
    got = detect_changes(scan, catalog, variants, listing)
    for sheet in (got.deletions, got.colors):
        assert "row_number" not in _plan(sheet)
    assert sorted(r.sku for r in got.deletions.collect()) == ["22222", "v2", "v3"]
    assert sorted(map(tuple, got.new.collect())) == sorted(map(tuple, X.new_manifest(scan, catalog, X.links_by_code(listing)).collect()))
    assert sorted((r.kind, r.sku, r.name) for r in got.fresh.collect()) == [("new_product", "33333", "c"), ("new_product", "33333", "d")]


def test_colours_are_split_before_they_are_exploded(spark):
    rows = spark.createDataFrame([("a", " red |,  Sky   Blue- - "), ("b", " - "), ("c", None)], "sku string, colors string")
    out = E.expand_colors(rows)
    assert "posexplode(__values" in _plan(out)
    assert sorted(map(tuple, out.select("sku", "color_pos", "color").collect()), key=str) == [
        ("a", 0, "red"), ("a", 1, "Sky Blue"), ("b", None, None), ("c", None, None)]


def test_stems_of_odd_paths(spark):
    paths = ["img/a.webp", "a", ".a", "a.", "x/.b.c", "x\\y.z\\k.png", "a\nb/c.d", "", "d.e/f", "..", "a.b\n"]
    df = spark.createDataFrame([(p,) for p in paths], "path string")
    name = T.replace_pattern("path", r"^.*[/\\]")
    want = T.replace_pattern(name, r"(?<=.)\.[^.]*$")
    assert df.filter(~F.coalesce(T.file_stem("path") == want, F.lit(False))).count() == 0


def test_colours_look_at_distinct_tails_and_unasked_names_are_not_made(spark):
    from vitrine.operators.images import assign_images
    files = [(f"i/7{a}_{c}.webp",) for a, c in zip("abcdefg", ("red", "red", "navy-blue", "red", "dark-red", "blue", ""))] + [("i/7b_red.webp",)]
    products = spark.createDataFrame([("7", "n", "bag", "M 1", ["red", "blue", "red", "sky-blue", "Dark Red", "green"]), ("8", "n", "x", "m", ["red"])],
                                     "sku string, name_fa string, name_en string, model string, colors array<string>")
    out = assign_images(products, spark.createDataFrame(files, "path string"))
    got = {r.sku: [(m.color, m.source, m.kind) for m in r.matches] for r in out.collect()}
    assert got == {"8": [], "7": [("red", "7b", "exact"), ("blue", "7c", "exact"), ("red", "7d", "exact"),
                                  ("sky-blue", "7f", "exact"), ("Dark Red", "7e", "exact"), ("green", "7g", "blank")]}
    assert "aggregate(" in _plan(out.select("matches")) and "aggregate(" not in _plan(out.select("sku", "main_image"))


def test_distinct_colour_cells_are_matched_once_and_others_by_row(spark):
    from vitrine.plans.standardize import standardize_colors
    cells = ["مشکی | Sky Blue", " - ", None, "سفید,سفید", "nan", "", "a\"b\\c d | \x01", "x" * 300]
    df = spark.createDataFrame([(c,) for c in cells], "colors string")
    few = standardize_colors(df)
    # Cells that were never looked at go the full way and give the same.
    none = standardize_colors(df, seen=spark.createDataFrame([("z",)], "colors string"))
    many = standardize_colors(df, seen=spark.range(2000).select(F.col("id").cast("string").alias("colors")))
    assert "regexp_replace" in _plan(many) and "entries" not in _plan(few) and "from_json" not in _plan(few)
    want = [(["مشکی", "Sky Blue"], ["Sky Blue"]), ([], []), (None, None), (["سفید"], []), (None, None), (None, None)]
    got = [[(r.colors_std, r.color_misses) for r in out.collect()] for out in (few, none, many)]
    assert got[0][:6] == want and got[0] == got[1] == got[2]


def test_cells_are_worked_out_once_by_the_row_filter(spark):
    from vitrine.operators.columns import drop_unusable
    cells = ["OUT_OF_STOCK", " ناموجود \n", "\x1cFailed", "not Failed", None, "", "No Color", "ok"]
    df = spark.createDataFrame([(c, c) for c in cells], "a string, regular_price string").select(
        F.substring_index("a", "@", 1).alias("name"), "regular_price")
    kept = drop_unusable(df, "name", "regular_price")
    assert [r.name for r in kept.collect()] == ["\x1cFailed", "not Failed", "ok"]
    assert "(?U)" not in _plan(kept)


def test_separators_are_unified_in_one_pass(spark):
    cells = ["a , - b", " | a||b | ", "a", " a ", "|", "a /\n b;", "", None, "a |\n", "x\u0085-\u0085y"]
    df = spark.createDataFrame([(c,) for c in cells], "c string")
    out = df.select(T.unify_separators("c").alias("c"))
    assert [r.c for r in out.collect()] == ["a|b", "a|b", "a", " a ", "", "a|b", "", None, "a", "x|y"]
    assert _plan(out).count("regexp_replace") == 1


def test_numbering_many_rows_takes_more_tasks_with_one_sort_each(spark, monkeypatch):
    from pyspark.sql import Window
    from vitrine.operators import scale as S
    monkeypatch.setattr(S, "TASK_ROWS", 100)
    df = spark.range(3000).select(F.when(F.col("id") % 50 > 0, F.when(F.col("id") % 5 < 2, "hot").otherwise(
        F.concat(F.lit("k"), F.col("id") % 40))).alias("k"), (F.col("id") * 7919 % 3000).alias("at"), "id")
    slices, rows = S.slices_and_rows(df, "at", 16)
    got = S.number_within(df, ["k"], ["at", "id"], slices, "n", rows)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert rows == 3000 and plan.count("REPARTITION_BY_NUM") >= 3 and ", 30)" in plan
    want = df.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("at", "id")).cast("bigint"))
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(*got.columns).collect()))


def test_slices_by_halving_equal_counted_edges(spark):
    from vitrine.operators import scale as S
    df = spark.createDataFrame([(x,) for x in [None, -5.5, 0.0, 0.0, 1.0, 2.0, 2.0, 3.5, 9.0, float("inf")]], "v double")
    for slices in (1, 2, 3, 5, 8, 64):
        cuts = df.select(F.percentile_approx("v", [i / slices for i in range(1, slices)] or [0.5], 1000)).first()[0]
        edges = sorted(set(cuts)) if slices > 1 else []
        got = [r.s for r in df.select(S.quantile_slices(df, "v", slices).alias("s")).collect()]
        assert got == [0 if r.v is None else sum(r.v > e for e in edges) for r in df.collect()]
    assert df.limit(0).select(S.quantile_slices(df.limit(0), "v")).count() == 0


def test_an_exclusion_list_made_of_a_small_table_is_not_broadcast(spark):
    colors = spark.createDataFrame([(0, "red", "red"), (1, "blue", "blue")], "ord int, term string, translation string")
    products = spark.createDataFrame([("a", "n", "1", "red | blue", 1), ("b", "n", "2", "red", 2), ("c", "n", "3", "green", 3)],
                                     "sku string, name string, model string, colors string, ord long")
    listed = spark.range(3).select(F.element_at(F.array(*map(F.lit, "abx")), F.col("id").cast("int") + 1).alias("s"), F.explode(
        F.array(F.lit("red"), F.lit("red"), F.lit("black"))).alias("c")).select(F.concat_ws("-", "s", "c").alias("sku"))
    variants = E.variant_rows(products, colors)
    kept = E.products_for_export(products, colors, colors, listed).select("sku", F.transform("variants", lambda v: v["color"]).alias("v"))
    left, gone = E.drop_excluded(variants, listed).select("sku", "color"), E.fully_excluded(variants, listed)
    for out in (kept, left, gone):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert not [line for line in plan.splitlines() if "BroadcastHashJoin" in line and "__x" in line] and "SortMergeJoin [variant_sku" in plan
    assert sorted(map(tuple, kept.collect())) == [("a", ["blue"]), ("c", ["green"])]
    assert sorted(map(tuple, left.collect())) == [("a", "blue"), ("c", "green")] and [r.sku for r in gone.collect()] == ["b"]


def test_sheets_filter_what_was_stored_for_them(spark):
    rows = "ord long, sku string, name string, regular_price string, sale_price string, colors string, image_urls string"
    catalog = spark.createDataFrame([(1, "11111", "a", "10", None, "red | blue", ""), (2, "22222", "b", "10", None, "red", ""),
                                     (3, "44444", "e", "7", "5", "red-green", ""), (4, "55555", "f", "7", "5", "red", "")], rows)
    scan = spark.createDataFrame([(1, " 11111", "a", "20", None, "red", "u"), (2, "33333", "c", "10", None, "red", "u"), (3, "33333", "d", "10", None, None, "v"),
                                  (4, "44444", "e", "7", "5", "red | black", "w"), (5, "44444", "e2", "8", "5", "pink", "x"), (6, "nan", "g", "1", None, "red", "z"),
                                  (7, "55555", "f", "7", "5", "red", "y")], rows)
    variants = spark.createDataFrame([("11111", "blue", "v1", 1), ("11111", "blue", "v2", 2), ("11111", "red", "v3", 3), ("22222", "red", "v4", 4), ("22222", "", "v5", 5),
                                      ("44444", "green\u200b", "v6", 6), ("55555", "red", "v7", 7)], "parent_sku string, color string, sku string, ord long")
    listing = spark.createDataFrame([(1, "x 33333", "l", "5")], "ord long, product_name string, product_url string, price string")
    got, want = (detect_changes(scan, catalog, variants, listing, materialize=m) for m in (True, False))
    for sheet in (got.fresh, got.ready, got.deletions):
        assert "Join" not in _plan(sheet) and "Join" in _plan(want.fresh)
    for name, df in vars(want).items():
        mine = getattr(got, name)
        assert mine.columns == df.columns and sorted(map(repr, mine.collect())) == sorted(map(repr, df.collect())), name
    assert sorted(r.sku for r in got.deletions.collect()) == ["22222", "v2", "v4", "v6"]
    assert [(r.sku, r.name, r.colors) for r in got.ready.filter("sku = '44444'").collect()] == [("44444", "e", "black | red")]
