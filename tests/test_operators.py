"""Operators on small fixtures, large-table paths and invariants."""

import random

import pytest
from pyspark.sql import Window, functions as F

from vitrine.operators import columns as R
from vitrine.operators import dedupe as DD
from vitrine.operators import dictionary as D
from vitrine.operators import diff as X
from vitrine.operators import images as I
from vitrine.operators import manifest as M
from vitrine.operators import pricing as B
from vitrine.operators import quality as Q
from vitrine.operators import scale as S
from vitrine.operators.categorize import Taxonomy, categorize, with_first_keyword
from vitrine.plans.standardize import Rules, standardize


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows under one key, with gaps between slices."""
    rng = random.Random(7)
    rows = [(("hot" if rng.random() < 0.4 else f"k{rng.randrange(40)}") if i % 50 else None,
             rng.randrange(10_000), i, rng.randrange(5)) for i in range(3000)]
    return spark.createDataFrame(rows, "k string, at int, id int, v int").cache()


def test_number_within_equals_a_window(skewed):
    got = S.number_within(skewed, ["k"], ["at", "id"], S.quantile_slices(skewed, "at", 16), "n")
    want = skewed.withColumn("n", F.row_number().over(Window.partitionBy("k").orderBy("at", "id")).cast("bigint"))
    assert sorted(map(str, got.select("id", "n").collect())) == sorted(map(str, want.select("id", "n").collect()))


def test_previous_within_equals_lag(skewed):
    got = S.previous_within(skewed, ["k"], ["at", "id"], F.floor(F.col("at") / 500), {"v": "p"})
    want = skewed.withColumn("p", F.lag("v").over(Window.partitionBy("k").orderBy("at", "id")))
    assert sorted(map(str, got.select("id", "p").collect())) == sorted(map(str, want.select("id", "p").collect()))


def test_top_n_is_cut_before_the_shuffle(skewed):
    top = S.top_n_by_key(skewed, "k", [F.col("at").desc(), "id"], 3)
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2
    assert top.groupBy("k").count().agg(F.max("count")).first()[0] == 3


def test_rule_rows_are_read_only_if_few(spark):
    assert len(S.rows_if_small(spark.range(10), 50)) == 10
    assert S.rows_if_small(spark.range(200), 50) is None


def test_pictures_of_any_number_are_kept(spark):
    from vitrine.operators import images as I
    names = [f"77{a}{b}" for a in ("", "a") for b in "abcdefghijklmnopqrstuvwxyz"] + ["77a_red", "77a_red"]
    files = spark.createDataFrame([(f"img/{n}.webp",) for n in names], "path string")
    got = I.pictures_by_product(files).first().pictures
    assert [p.source for p in got][:3] == ["77a", "77a_red", "77b"] and len(got) == 53


def test_files_of_keys_with_letters_and_zeros(spark):
    from vitrine.operators import images as I
    files = spark.createDataFrame([("A123a.webp",), ("A123.webp",), ("9x.webp",)], "path string")
    keys = spark.createDataFrame([("A123",), ("9",)], "sku string")
    assert sorted((r.sku, r.path) for r in I.existing_files(files, keys).collect()) == [
        ("9", "9x.webp"), ("A123", "A123a.webp")]
    pics = spark.createDataFrame([("007_x.jpg", 1, 1, 0), ("7_y.jpg", 1, 1, 1)], "path string, width int, height int, ord int")
    assert sorted(r.new_name for r in I.rename_plan(pics, slice_by=F.lit(0)).collect()) == ["7a.webp", "7b.webp"]


def test_repeated_order_numbers_do_not_mix_cells(spark):
    from vitrine.operators import dictionary as D
    words = spark.createDataFrame([(0, "daily", "D"), (1, "sport", "S")] + [(i, f"w{i}", "x") for i in range(2, 1502)],
                                  "ord int, term string, translation string")
    rows = spark.createDataFrame([(1, "daily"), (1, "sport"), (1, None)], "ord int, cell string")
    got = D.translate_columns(rows, ["cell"], words, counted="n").collect()
    assert sorted((r.cell or "", r.n) for r in got) == [("", 0), ("D", 1), ("S", 1)]


def test_upsert_and_resume(spark):
    old = spark.createDataFrame([("a", 9, "old"), ("b", 1, "old")], "k string, ord int, v string")
    new = spark.createDataFrame([("a", 1, "n1"), ("a", 2, "n2"), ("c", 1, "n")], "k string, ord int, v string")
    assert {r.k: r.v for r in DD.upsert(old, new, "k").collect()} == {"a": "n2", "b": "old", "c": "n"}
    assert [r.k for r in DD.unprocessed(new, old, "k").collect()] == ["c"]


def test_bracket_paths_agree(spark):
    rng = random.Random(3)
    rules = [(lo, lo + rng.choice((0, 10, 500, 70_000)), i, 0) for i, lo in
             enumerate(rng.randrange(0, 90_000) for _ in range(60))]
    df = spark.range(0, 100_000, 37).select((F.col("id") + 0.5 * (F.col("id") % 2)).alias("p"))
    table = B.rules_frame(spark, rules)
    case = df.withColumn("bracket", B.bracket_by_case(F.col("p"), table.collect()))
    cells = B.bracket_by_sweep(df, "p", table)
    def flat(x):
        return sorted((r.p, r.n if r.n is not None else -1) for r in x.select("p", F.col("bracket.rule_ord").alias("n")).collect())
    brute = sorted((r.p, next((i for i, (lo, hi, *_) in enumerate(rules) if lo <= r.p <= hi), -1)) for r in df.collect())
    assert flat(case) == brute
    assert flat(cells) == brute


def test_pricing_rules(spark):
    rows = [("90,000", None), ("0", "5"), ("nan", "7"), ("500000", "1"), ("70000", "")]
    df = spark.createDataFrame(rows, "regular_price string, sale_price string")
    got = B.apply_brackets(df, B.rules_frame(spark, [(1, 100_000, 10, 20), (400_000, 600_000, 0, 150)]))
    out = {r.regular_before: (r.regular_price, r.sale_price, r.discounted, r.clamped) for r in got.collect()}
    assert out["90,000"] == ("124000", "99000", True, False)
    assert out["0"] == ("0", "5", False, False)
    assert out["nan"] == ("nan", "7", False, False)
    assert out["500000"] == ("50000000", "500000", True, True)
    assert out["70000"] == ("96000", "77000", True, False)


def test_keyword_paths_agree(spark):
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcd") for _ in range(rng.randrange(0, 30))) for _ in range(300)]
    words = ["".join(rng.choice("abcd") for _ in range(rng.randrange(3, 6))) for _ in range(60)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, text string")
    rules = spark.createDataFrame([(i, w, f"v{i}") for i, w in enumerate(words)],
                                  "rule_ord int, keyword string, value string")
    brute = {i: next((f"v{n}" for n, w in enumerate(words) if w in t), None) for i, t in enumerate(texts)}
    for limit in (1000, 10):
        got = {r.id: r.out for r in with_first_keyword(df, "text", rules, "out", limit).collect()}
        assert got == brute


def test_very_many_keywords_in_long_texts(spark):
    from vitrine.operators import categorize as K
    rng = random.Random(7)
    keys = [f"the {rng.randrange(10**6)} end" for _ in range(300)] + ["é", "ab", "😀x\n", "z" * 400]
    texts = ["".join(rng.choice(["the ", " end", "x", "😀", "\n", "1", "e"]) for _ in range(rng.randrange(700))) for _ in range(60)]
    texts = [t[:i] + rng.choice(keys) + t[i:] for t in texts for i in (min(len(t), 254), rng.randrange(len(t) + 1))]
    df = spark.createDataFrame([*enumerate(texts + ["", "é" * 256 + "ab"]), (999, None)], "id int, text string")
    rules = spark.createDataFrame([(-i, k, f"v{i}") for i, k in enumerate(keys)], "rule_ord int, keyword string, value string")
    brute = {i: next((f"v{n}" for n, k in reversed([*enumerate(keys)]) if t and k in t), None) for i, t in ((r.id, r.text) for r in df.collect())}
    assert {r.id: r.out for r in with_first_keyword(df, "text", rules, "out", 10).collect()} == brute
    # What begins like a keyword and does not end like one is not shuffled.
    sizes = sorted({len(k) for k in keys})
    sent = K.possible_keywords(spark.createDataFrame([(1, "the 12 endless " * 500)], "id int, text string"), sizes, K.keyword_filter(rules))
    assert sent.count() < 5


def test_translation_paths_agree(spark, monkeypatch):
    df = spark.createDataFrame([(1, " red | Blue bag ، x1;کیف"), (2, "red,,red "), (3, None), (4, "سبز")],
                               "ord int, cell string")
    entries = D.pairs_frame(spark, {"red": "قرمز", "blue bag": "کیف آبی", "X1": "y"})
    want = {1: " قرمز | کیف آبی ، y;کیف", 2: "قرمز,,قرمز ", 3: None, 4: "سبز"}
    assert {r.ord: r.cell for r in D.translate_columns(df, ["cell"], entries).collect()} == want
    monkeypatch.setattr(D, "translation_map", lambda e: None)
    assert {r.ord: r.cell for r in D.translate_columns(df, ["cell"], entries).collect()} == want


def test_color_lookup_order(spark):
    df = spark.createDataFrame([("سرمه ای",), (" مشکی",), ("بنفش یاسی",), ("",), ("!",)], "c string")
    entries = D.pairs_frame(spark, {"سرمه\u200cای": "Navy-Blue", "مشکی": "black", "قرمز": "nan"})
    got = {r.c: (r.en, r.known) for r in D.translate_color(df, "c", entries, "en", "known").collect()}
    assert got == {"سرمه ای": ("navy-blue", True), " مشکی": ("black", True), "بنفش یاسی": ("bnfsh-iasi", False),
                   "": ("", False), "!": ("!", False)}


def test_term_report_keeps_all_counts(spark):
    rows = [(f"p{i:03d}", i, "red") for i in range(30)] + [("q", 1, "blue")]
    df = spark.createDataFrame(rows, "name string, ord int, color string")
    got = {r.color: (r.product_count, r.sample_products) for r in D.term_report(df, "color", "name").collect()}
    assert got == {"red": (30, "p000 | p001 | p002 | p003 | p004"), "blue": (1, "q")}


def test_categories(spark):
    rows = [("کیف پول چرمی", "", "", "اکسسوری>کیف پول"), ("کوله\u200cپشتی لپ تاپ", "", "", "کوله\u200cپشتی>کوله\u200cپشتی لپ\u200cتاپ"),
            ("کیف ساک بزرگ", "", "", "سفر و ورزش>ساک"), ("کیف زنانه", "رسمی", "", "کیف زنانه>کیف اداری زنانه"),
            ("کیف مردانه دوشی روزانه", "", "", "کیف مردانه>کیف روزمره مردانه"), ("کیف زنانه", "", "x", "کیف زنانه"),
            ("کلاه", "باشگاه", "", ""), ("کلاه", "کیف باشگاه", "", "سفر و ورزش>کیف باشگاه"), ("کلاه", "", "", "")]
    df = spark.createDataFrame(rows, "name string, usage string, suitable_for string, want string") \
        .withColumn("sale_price", F.lit("1,000"))
    for r in categorize(df).collect():
        assert r.category == r.want, r
        assert r.sale_tag == "تخفیف خورده\u200cها" and "کیف ساک" not in r.name
    rules = spark.createDataFrame([(0, "کیف زنانه", "کیف نو", "تازه", "کیف نو")],
                                  "ord int, main string, sub string, expression string, equivalent string")
    got = categorize(df.filter("usage = 'رسمی'").withColumn("name", F.lit("کیف زنانه تازه")), Taxonomy.from_rules(rules))
    assert got.first().category == "کیف زنانه>کیف نو"


def _catalogue(spark):
    scan = spark.createDataFrame([
        (" 100 ", "n100", "100", "80", "آبی | قرمز", 1, "u1"), ("100", "dup", "1", "1", "x", 2, "u2"),
        ("200", "n200", "50", None, "سرمه\u200cای - سبز", 3, ""), ("300", "n300", "0", "0", "", 4, "u4"),
        (None, "void", "1", "1", "", 5, "")],
        "sku string, name string, regular_price string, sale_price string, colors string, ord int, image_urls string")
    catalog = spark.createDataFrame([
        ("100", "o100", "100", "0", "آبی", 1), ("200", "o200", "50", "nan", "سرمهای,سبز,زرد", 2),
        ("400", "o400", "9", "", "آبی", 3)],
        "sku string, name string, regular_price string, sale_price string, colors string, ord int")
    variants = spark.createDataFrame([
        ("200", "زرد", "200-old", 1), ("200", "زرد", "200-y", 2), ("400", "آبی", "400-b", 3), ("400", "", "400-x", 4)],
        "parent_sku string, color string, sku string, ord int")
    return scan, catalog, variants


def test_diff_classes(spark):
    scan, catalog, variants = _catalogue(spark)
    diff = X.diff_catalog(scan, catalog).cache()
    rows = {r.sku: r for r in diff.collect()}
    assert {k: r.change_class for k, r in rows.items()} == {
        "100": "common", "200": "common", "300": "new", "400": "removed"}
    assert rows["100"].price_changed and rows["100"].old_price == 100 and rows["100"].new_price == 80
    assert rows["100"].added == ["قرمز"] and rows["100"].changed
    assert not rows["200"].price_changed and rows["200"].removed == ["زرد"] and not rows["200"].changed
    assert [r.removed_variant_skus for r in X.color_changes(diff, variants).filter("sku = '200'").collect()] == ["200-y"]
    assert [r.variant_skus for r in X.removed_products(diff, catalog, variants).collect()] == ["400-b"]
    deletions = X.delete_list(diff, variants).orderBy("part", "k0", "k1", "k2")
    assert [r.sku for r in deletions.collect()] == ["400", "400-b", "200-y"]
    same = X.change_counts(X.diff_catalog(catalog, catalog)).first()
    assert (same.new, same.changed, same.removed, same.common) == (0, 0, 0, 3)
    assert X.price_sheet(X.price_changes(diff)).first().difference == "-20"


def test_assign_images_against_plain_python(spark):
    rng = random.Random(11)
    names = ["black", "dark-gray", "sky-blue", "navy", "light blue", "green", "", "zzz", "brown"]
    products, files = [], []
    for p in range(60):
        products.append((str(100 + p), "نام", "bag", "M 1", rng.sample(names, rng.randrange(0, 6))))
        for letter in rng.sample("abcdefgh", rng.randrange(0, 8)):
            color = rng.choice(["black", "blue", "gray", "", "forest-green", "navy-blue", "tan"])
            files.append((f"d/{100 + p}{letter}" + (f"_{color}" if color else "") + ".jpg",))
    df = spark.createDataFrame(products, "sku string, name_fa string, name_en string, model string, colors array<string>")
    got = {r.sku: r for r in I.assign_images(df, spark.createDataFrame(files, "path string")).collect()}

    from vitrine.vocab import SIMILAR_COLORS as near
    def similar(a, b):
        return a in b or b in a or b in near.get(a, ()) or a in near.get(b, ())
    for sku, _, _, _, colors in products:
        pics = sorted(f[0][2:-4] for f in files if f[0].startswith("d/" + sku))
        tails = [p[4:].lstrip("_") for p in pics]
        used, matches = {0}, []
        for color in colors:
            norm = color.replace(" ", "-")
            tests = (lambda t: norm in t or t in norm, lambda t: any(w in t for w in norm.split("-")),
                     lambda t: similar(norm, t))
            hit = next(((i, n) for n, test in enumerate(tests) for i, t in enumerate(tails)
                        if norm and i not in used and test(t)), None)
            if hit:
                used.add(hit[0])
                kind = "blank" if hit[1] == 0 and not tails[hit[0]] else ("exact", "word", "similar")[hit[1]]
                matches.append((color, pics[hit[0]][:4], kind))
        assert [tuple(m) for m in got[sku].matches] == matches, sku
        if pics:
            assert got[sku].main_image == "bag-m-1-main.webp"
            assert len(got[sku].mapping) == len(pics)
            assert len(got[sku].general_images) == len(pics) - 1 - len(matches)
        else:
            assert got[sku].mapping == [] and len(got[sku].gallery) == 1 + sum(1 for c in colors if c)


def test_variant_images_take_general_ones_in_turn(one):
    value = I.variant_images(F.array(*map(F.lit, ("red", "zz", "blue", "yy", "xx"))),
                             F.array(F.struct(F.lit("sky-blue").alias("norm"), F.lit("S").alias("file")),
                                     F.struct(F.lit("red").alias("norm"), F.lit("R").alias("file"))),
                             F.array(F.lit("g1"), F.lit("g2")), F.lit("main"))
    assert one(value) == ["R", "g1", "S", "g2", "main"]


@pytest.mark.parametrize("marks, expected, best", [
    (("a", "b"), ("1", "2"), "b"), ((), ("1",), "c"), (("a",), ("1", "2", "3"), "a"), (("a", "b"), ("9",), "b")])
def test_folder_choice(spark, marks, expected, best):
    have = {"a": "1", "b": "12", "c": "123"}
    files = spark.createDataFrame([(f, f"{f}/{n}a.webp", f in marks) for f, ns in have.items() for n in ns],
                                  "folder string, path string, marked boolean")
    want = spark.createDataFrame([(e,) for e in expected], "sku string")
    assert I.pick_folder(I.folder_coverage(files, want)).first().folder == best


def test_gates(spark):
    rows = spark.createDataFrame([("a", 1), (" ", 2)], "sku string, n int")
    gate = Q.gate_row(rows, ("sku",))
    assert gate.first().blank_keys == 1 and not gate.first().passed
    with pytest.raises(Q.GateFailed):
        Q.check(gate)
    Q.check(Q.gate_row(rows.limit(0).unionByName(rows.filter("n = 1")), ("sku",)))
    assert not Q.gate_row(rows.limit(0)).first().passed
    with pytest.raises(R.MissingColumns):
        R.require_columns(rows, "شماره")


def test_table_difference_counts_repetition(spark):
    a = spark.createDataFrame([("x",), ("x",), ("y",)], "sku string")
    b = spark.createDataFrame([("x",), ("y",), ("z",)], "sku string")
    got = {(r.sku, r.side, r.surplus) for r in Q.table_difference(a, b).collect()}
    assert got == {("x", "only_left", 1), ("z", "only_right", 1)}
    assert Q.compare_tables(a, a).first().equal and not Q.compare_tables(a, b).first().equal


def test_run_status_follows_the_latest_step(spark):
    def status(*events):
        df = spark.createDataFrame([("r", s, st, i) for i, (s, st) in enumerate(events)],
                                   "run_id string, step string, status string, at int")
        return Q.run_status(df).first().status
    assert status(("a", "failed"), ("a", "done")) == "running"
    assert status(("a", "done"), ("b", "failed")) == "failed"
    assert status(("a", "done"), ("end", "complete")) == "complete"


def test_import_rules(spark):
    columns = "sku string, parent_sku string, name string, regular_price string, sale_price string, stock_quantity string"
    cat = spark.createDataFrame([("1", "", "old", "5", "", "1"), ("2", "", "keep", "6", "", "1")], columns)
    file = spark.createDataFrame([("1", "", "new", "7", "6", "2"), ("3", "", "third", "8", "", "1"),
                                  ("1-red", "1", "", "7", "", "1"), ("9-red", "9", "", "7", "", "1")], columns)
    def rows(df):
        return {r.sku: (r.name, r.regular_price) for r in df.collect()}
    assert rows(M.apply_update(cat, file)) == {"1": ("old", "7"), "2": ("keep", "6"), "1-red": ("", "7")}
    assert set(rows(M.apply_new(cat, file))) == {"1", "2", "3", "1-red", "9-red"}
    assert rows(M.apply_full(cat, file))["2"] == ("keep", "6")
    assert "2" not in rows(M.apply_full(cat, file, delete_missing=True))
    assert M.files_to_run({"full", "new"}) == ["full"] and M.files_to_run({"update", "new"}) == ["new", "update"]


def test_standardize_small(spark):
    raw = spark.createDataFrame([
        (1, "کیف پول", "A1", "", "10000", None, "سرمه\u200c ای ساده | Violet - مشکی", "daily, sport", "x", ""),
        (2, "کیف", "A2", "", "10000", None, "- ناموجود | ساده", "", "", ""),
        (3, " ", "A3", "", "", None, "", "", "", "")],
        "ord int, name string, model string, sku string, regular_price string, sale_price string, colors string, "
        "usage string, suitable_for string, status string")
    rules = Rules(price_rules=B.rules_frame(spark, [(0, 20000, 20, 0)]), words=D.pairs_frame(spark, {"daily": "روزانه"}))
    out = standardize(raw, rules)
    row = out.table.collect()
    assert [r.ord for r in row] == [1, 2]
    assert row[0].colors_std == ["سرمه\u200cای", "Violet", "مشکی"] and row[1].colors_std == []
    assert row[0].sku == "A1" and row[0].usage == "روزانه|sport" and row[0].regular_price == "12000"
    assert row[0].stock == 10 and row[0].category == "اکسسوری>کیف پول"
    assert [(r.color, r.product_count) for r in out.unknown_colors.collect()] == [("Violet", 1)]
    assert {"sport", "x"} <= {r.token for r in out.unknown_words.collect()}
    metrics = out.metrics.first()
    assert (metrics.rows_read, metrics.rows_removed, metrics.words_translated) == (3, 1, 1)


def test_nested_markup_is_taken_whole(spark):
    from vitrine.operators import pages as G
    rows = [('<div class="tabs description"><div>one</div><p>two</p><div><div>three</div></div></div><div>out</div>', "one two three"),
            ('<div class="description">x</div>', "x"), ('<p>no</p>', None), ('<section class="a description b"><p>y', "y"), (None, None)]
    df = spark.createDataFrame(rows, "html string, want string")
    got = G.page_tokens(df).select("want", G.text_of("tokens", G.first("tokens", ".description")).alias("got")).collect()
    assert all(r.want == r.got for r in got)


def test_labels_of_many_spellings(spark):
    from vitrine import vocab as V
    from vitrine.operators import pages as G
    a, b, c, e = (V.SPEC_LABELS[k][0] for k in ("closure", "lining", "usage", "strap_count"))
    html = (f"<dl><dt>{a}</dt><dd>zip</dd></dl><ul><li>{b}: silk</li></ul><div><label>{c}</label><span>travel</span></div>"
            f"<p>{e} 3</p><table><tr><td>{a}</td><td>wrong</td></tr></table>"
            f"<table class=\"shop_attributes\"><tr><th>{V.SPEC_LABELS['long_strap'][0]}</th><td>yes</td></tr></table>")
    df = spark.createDataFrame([(1, "http://x.example/p", html)], "page_id int, url string, html string")
    got = G.page_fields(df).first()
    assert (got.closure, got.lining, got.usage, got.strap_count, got.long_strap) == ("zip", "silk", "travel", "3", "yes")


def test_markup_is_read_as_browsers_do(spark):
    from vitrine.operators import pages as G
    html = ("<meta name=closure content='zip &amp; button'><div class = 'price box'><p class=price>1</p><img alt=\"a > b\" class='main-image' src=a.jpg>"
            "<ul><li>one<li>two: x<ul><li>in</ul></ul><p title=it's>Caf&eacute; &#8217;s &mdash; &#x21;<p>z</div><!-- <b>no</b> --><script>'<b>'</script>tail")
    df = spark.createDataFrame([(1, html), (2, None), (3, "")], "page_id int, html string")
    rows = {r.page_id: r for r in G.page_tokens(df, keep_html=True).select(
        "page_id", "html", "page_text", G.text_of("tokens", G.first("tokens", "p.price")).alias("price"),
        G.image_source(G.first("tokens", ".box img")).alias("image"), F.size(G.select("tokens", "li")).alias("items"),
        F.size(G.select("tokens", "ul ul li")).alias("inner"), F.size(G.select("tokens", "b")).alias("bold")).collect()}
    one = rows[1]
    assert (one.price, one.image, one.items, one.inner, one.bold) == ("1", "a.jpg", 3, 1, 0)
    assert one.page_text.split("\n")[-3:] == ["Café ’s — !", "z", "tail"] and one.html == html
    assert rows[2].page_text == rows[3].page_text == "" and rows[2].price is None


@pytest.mark.parametrize("page,want", [
    ('<div class="main-image"><span><img src="/m.jpg"></span></div>', "http://x.example/m.jpg"),
    ("<div class=featured-image><img data-src=/f.png src=/logo.png></div><div class=main-image><img src=/m.jpg></div>", "http://x.example/f.png"),
    ("<img id='hero-main' src=h.webp><div class='gallery-main'><img src=/g.jpg></div>", "http://x.example/p/h.webp"),
    ("<div><p>x</p><div class='woocommerce-product-gallery__image'><img src=/b.jpg></div></div>"
     "<div><div class='woocommerce-product-gallery__image'><img src=/a.jpg></div></div>", "http://x.example/a.jpg"),
    ("<figure class=woocommerce-product-gallery__image><img src=/1.jpg></figure><div class='wd-carousel-item wd-active'>"
     "<figure class='woocommerce-product-gallery__image'><img src=/2.jpg></figure></div>", "http://x.example/2.jpg"),
    ("<div class='product__main-photos'><img src='/v.mp4'></div><meta property=og:image content=/og.jpg>", "http://x.example/og.jpg"),
    ("<img src=/plain.jpg>", None)])
def test_main_image_selectors(spark, page, want):
    from vitrine.operators import pages as G
    df = spark.createDataFrame([("http://x.example/p/q", page)], "url string, html string")
    assert G.page_tokens(df).select(G.main_image("tokens", "url").alias("x")).first().x == want


def test_labels_and_values_of_any_length(spark):
    from vitrine import vocab as V
    from vitrine.operators import pages as G
    lining, usage, closure = (V.SPEC_LABELS[k][0] for k in ("lining", "usage", "closure"))
    long = "v" * 250
    html = f"<ul><li>{lining}: {long}</li></ul><h4>{usage}</h4><section><b>all</b> day</section><meta name='{closure}' content='zip'>"
    got = G.page_fields(spark.createDataFrame([(1, "http://x.example/", html)], "page_id int, url string, html string")).first()
    assert (got.lining, got.usage, got.closure) == (long, "all day", "zip")
    got = G.page_fields(spark.createDataFrame([(1, "http://x.example/", f"<p>{lining} silk and wool</p>")], "page_id int, url string, html string")).first()
    assert got.lining == "silk and wool"


def test_overlapping_brackets_become_disjoint(spark):
    import random
    from vitrine.operators import pricing as B
    rng = random.Random(9)
    rules = [(a, a + rng.choice([0, 1, 7, 40, -1]), float(i), 0.0) for i, a in enumerate(rng.choices(range(60), k=90))]
    frame = B.rules_frame(spark, rules)
    pieces = sorted((r.low, r.high, r.point, r.bracket.rule_ord) for r in B.disjoint_brackets(frame).collect())
    assert all(p[0] == p[1] if p[2] else p[0] < p[1] for p in pieces)
    assert all(a[1] <= b[0] for a, b in zip(pieces, pieces[1:]))
    prices = [x / 2 for x in range(-4, 240)] + [None]
    got = {r.p: r.bracket and r.bracket.rule_ord for r in B.bracket_by_sweep(
        spark.createDataFrame([(p,) for p in prices], "p double"), "p", frame).collect()}
    want = {p: next((i for i, r in enumerate(rules) if p is not None and r[0] <= p <= r[1]), None) for p in prices}
    assert got == want
    assert B.disjoint_brackets(frame.limit(0)).count() == 0
    assert B.bracket_by_sweep(spark.createDataFrame([(1.0,)], "p double"), "p", frame.limit(0)).first().bracket is None


def test_only_differing_buckets_are_compared(spark):
    from vitrine.operators import quality as Q
    a = spark.range(3000).select("id", (F.col("id") % 7).alias("v")).union(spark.createDataFrame([(None, 1), (None, 1), (5, 5)], "id bigint, v bigint"))
    assert Q.differing_buckets(a, a.repartition(7, "v"), ["id", "v"]) == [] and Q.table_difference(a, a.repartition(3)).count() == 0
    b = a.filter("id is null or id <> 17").union(spark.createDataFrame([(17, 99), (40, 5), (None, 1)], "id bigint, v bigint"))
    assert 2 <= len(Q.differing_buckets(a, b, ["id", "v"])) <= 4
    got = sorted(map(tuple, Q.table_difference(a, b).select("side", "surplus", "id", "v").collect()), key=str)
    assert got == sorted([("only_left", 1, 17, 3), ("only_right", 1, 17, 99), ("only_right", 1, 40, 5), ("only_right", 1, None, 1)], key=str)
    assert Q.table_difference(a, a.limit(0)).agg(F.sum("surplus")).first()[0] == a.count()


def test_titles_may_keep_other_references(spark):
    from vitrine.operators import pages as G
    html = "<h1>a &quot;b&lt; &amp;amp; c&amp</h1>"
    df = spark.createDataFrame([(1, "http://x.example/", html)], "page_id int, url string, html string")
    for references, want in (("all", 'a "b< &amp; c&'), ("markup", "a &quot;b< &amp; c&amp")):
        assert G.page_fields(df, references=references).first().name == want
        assert G.page_tokens(df, references=references).select(G.title("tokens").alias("t")).first().t == want


def test_existing_files_offer_only_beginnings_as_long_as_keys(spark):
    from vitrine.operators import images as I
    files = spark.createDataFrame([("img/A1234a_blue.jpg",), ("img/12b.png",), ("img/x.png",), (None,)], "path string")
    keys = spark.createDataFrame([("A1234",), ("12",), ("A1234a_b",), ("",), (None,)], "sku string")
    found = I.existing_files(files, keys)
    assert sorted((r.sku, r.path[4:]) for r in found.collect()) == [
        ("12", "12b.png"), ("A1234", "A1234a_blue.jpg"), ("A1234a_b", "A1234a_blue.jpg")]
    none = keys.limit(0)
    assert I.existing_files(files, none).count() == 0


def test_a_large_dictionary_is_only_sent_tokens_with_a_key(spark):
    cells = spark.createDataFrame([(" red ; x|RED, no",), ("مشکی|red",), ("; |",), ("no",), (None,)], "cell string")
    words = spark.createDataFrame([(0, "red", "سرخ"), (1, "x", "ایکس")], "ord int, term string, translation string")
    out = D.translated_cells(cells, ["cell"], words)
    assert sorted((r.cell, r.new, r.known) for r in out.collect()) == [
        (" red ; x|RED, no", " سرخ ; ایکس|سرخ, no", 3), ("مشکی|red", "مشکی|سرخ", 1)]
    # Tokens without a key would all go to one task; only an inner join leaves them out.
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" in plan and "Join LeftOuter" not in plan
