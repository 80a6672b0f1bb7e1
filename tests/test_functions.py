"""Scalar rules on Persian and Latin literals."""

import datetime

import pytest
from pyspark.sql import functions as F

from vitrine.functions import colors as C
from vitrine.functions import dates as DT
from vitrine.functions import prices as P
from vitrine.functions import text as T
from vitrine.functions import urls as U


@pytest.mark.parametrize("fn, given, wanted", [
    (T.ascii_digits, "کد ۱۲۳ و ٤٥٦", "کد 123 و 456"),
    (T.persian_digits, "a19", "a۱۹"),
    (T.strip_invisible, "\u200eآبی\u200cتیره\ufeff ", "آبیتیره"),
    (T.squeeze, "\xa0 a \t b\u3000c ", "a b c"),
    (T.color_text, " سرمه\u200cاي  كرم", "سرمه ای کرم"),
    (T.plain_text, "كيف  زنانه", "کیف زنانه"),
    (T.color_key, "Sky - Blue_\u200cX\t", "skybluex"),
    (T.slug, " Sky! Blue (x) ", "sky-blue-x"),
    (T.dash_slug, " Sky_Blue--x ", "sky-blue-x"),
    (T.unify_separators, "a , b/c؛ d |", "a|b|c|d"),
    (T.tidy_multi, "a , b, a", "a | b"),
    (T.code_after_word, "کیف کد ۹۲۶۶", "9266"),
    (T.code_or_first_number, "x 77 کد 12", "12"),
    (T.numeric_code, "ab12 9266-black", "9266"),
    (T.trailing_code, "کیف مدل A۹۳۶۰ ", "A۹۳۶۰"),
    (T.strip_price_suffix, "کیف کد 9266 1,250,000 تومان", "کیف کد"),
    (T.name_through_code, "کیف کد ۹۲۶۶ ۱٬۲۰۰٬۰۰۰", "کیف کد 9266"),
    (T.strip_code, "کیف کد ۹۲۶۶ زنانه", "کیفزنانه"),
    (T.transliterate, "آبی کاربنی", "abi-karbni"),
    (T.transliterate, "چمدان\u200cخاص ۵!", "chmdan-khas-5"),
    (T.with_centimetres, "12.5", "12.5cm"),
    (T.with_centimetres, "12 in", "12 in"),
    (T.file_stem, "a/b/9266a_sky.blue.webp", "9266a_sky.blue"),
    (T.filename_tail, "9266a_black", "black"),
])
def test_text(one, fn, given, wanted):
    assert one(fn("c"), c=given) == wanted


@pytest.mark.parametrize("given, wanted", [
    ("کیف کد ۱۰۰۳۰ 1,200,000 تومان", "کیف کد 10030"), ("کیف کد  1234567", "کیف کد 1234567"),
    ("کیف 120000 کد 55", "کیف"), ("کیف 120000", "کیف"), ("کیف کد12345 9", "کیف کد12345")])
def test_long_codes_are_no_prices(one, given, wanted):
    assert one(T.name_through_code("c"), c=given) == wanted


def test_blank_spellings_become_null(one):
    for word in ("", "  ", "NaN", " none ", "\xa0"):
        assert one(T.nullify_blank("c"), c=word) is None
    assert one(T.nullify_blank("c"), c=" x ") == "x"


@pytest.mark.parametrize("index, letter", [(0, "a"), (25, "z"), (26, "aa"), (27, "ab"), (701, "zz"), (702, "aaa")])
def test_letters(one, index, letter):
    assert one(T.letter_for_index("i"), i=index) == letter


@pytest.mark.parametrize("name, wanted", [
    ("4721e_sky-blue.jpg", ["sky-blue"]), ("4721a-Black.webp", ["black"]), ("4721a.jpg", []), ("x.jpg", [])])
def test_colors_in_filename(one, name, wanted):
    assert one(T.colors_in_filename("c"), c=name) == wanted


def test_dimensions(one):
    got = one(T.split_dimensions("c"), c="35 × 11 × 25 سانتیمتر")
    assert (got.length, got.depth, got.width) == ("35cm", "11cm", "25cm")
    got = one(T.split_dimensions("c"), c="35x25cm")
    assert (got.length, got.depth, got.width) == ("35cm", None, "25cm")
    assert one(T.dimension_text("a", "b", "c"), a="35cm", b="-", c="۷") == "طول: ۳۵cm|کف: ۷cm"
    assert one(T.dimension_text("a", "b", "c", loose=True), a="ab CM", b="", c="7") == "طول: abcm|کف: ۷cm"


@pytest.mark.parametrize("status, todo", [
    ("OK", False), ("Pending", True), ("Incomplete (2 failed)", True), ("Failed (1 images)", True),
    ("No Images Found", True), ("", True)])
def test_status(one, status, todo):
    assert one(T.needs_work_status("c"), c=status) is todo


@pytest.mark.parametrize("regular, sale, wanted", [
    ("100", "80", 80), ("100", "0", 100), ("100", "0.0", 100), ("100", "nan", 100), ("100", " ", 100),
    ("0", "0", None), (None, None, None), ("abc", "80.9", 80), ("100", "0.5", 100)])
def test_effective_price(one, regular, sale, wanted):
    assert one(P.effective_price(F.col("r").cast("string"), F.col("s").cast("string")), r=regular, s=sale) == wanted


@pytest.mark.parametrize("price, wanted", [(80400, 80000), (80500, 81000), (0, 0), (499.9, 0)])
def test_round_to_thousand(one, price, wanted):
    assert one(P.round_to_thousand("p"), p=price) == wanted


def test_price_text(one):
    text = "کد ۹۲۶۶ قیمت ۱٬۲۵۰٬۰۰۰ یا 900,000"
    assert one(P.largest_number("c"), c=text) == 1250000
    assert one(P.largest_number("c"), c="1000") is None
    assert one(P.largest_number("c", min_digits=5), c="9266") is None
    assert one(P.price_digits("c"), c="۱٬۲۵۰ تومان") == "1250"
    assert one(P.parse_price("c"), c=" 1,250.5 ") == 1250.5
    assert one(P.parse_price("c"), c="x") is None
    assert one(P.thousands("c"), c=1234567) == "1,234,567"
    assert one(P.thousands_text("c"), c="12٬345.9") == "12,345"
    assert one(P.thousands_text("c"), c="n/a") == "n/a"
    assert one(P.persian_thousands("c"), c="12345") == "12٬345"
    change = one(P.price_change("a", "b"), a=0, b=5)
    assert (change.amount, change.percent) == (0, 0.0)
    assert one(P.signed_amount("c"), c=1500) == "+1,500"
    assert one(P.signed_percent("c", 1), c=-12.34) == "-12.3%"
    assert one(P.render_number("c"), c=9321.0) == "9321"


def test_jalali_against_day_count(spark):
    days = spark.range(0, 366 * 60).select(F.date_add(F.lit("1990-03-21").cast("date"), F.col("id").cast("int")).alias("d"))
    rows = days.select("d", DT.jalali("d").alias("j")).orderBy("d").collect()
    assert tuple(rows[0].j) == (1369, 1, 1)
    for before, after in zip(rows, rows[1:]):
        y, m, d = before.j
        length = 31 if m <= 6 else 30 if m < 12 else None
        new_month = (y, m + 1, 1) if m < 12 else (y + 1, 1, 1)
        allowed = {(y, m, d + 1)} if length and d < length else {new_month} if length else (
            {(y, m, d + 1)} if d < 29 else {(y, m, 30), new_month} if d == 29 else {new_month})
        assert tuple(after.j) in allowed
    got = {r.d: tuple(r.j) for r in rows}
    assert got[datetime.date(2021, 3, 20)] == (1399, 12, 30)
    assert got[datetime.date(2024, 1, 1)] == (1402, 10, 11)


def test_stamps(one):
    assert one(DT.stamp_in_name("c"), c="product_details_20240102_030405.csv") == datetime.datetime(2024, 1, 2, 3, 4, 5)
    assert one(DT.folder_stamp("c"), c="2026-06-10_23-19-37") == datetime.datetime(2026, 6, 10, 23, 19, 37)
    assert one(DT.folder_stamp("c"), c="20260610") == datetime.datetime(2026, 6, 10)
    assert one(DT.folder_stamp("c"), c="latest") is None


@pytest.mark.parametrize("url, wanted", [
    ("http://a.example/p/1?x=1#f", "https://a.example/p/1"), ("https://a.example", "https://a.example"),
    ("ftp://a/b;c?d", "ftp://a/b;c"), ("/rel/x?y", "/rel/x"), ("", "")])
def test_normalize_url(one, url, wanted):
    assert one(U.normalize_url("c"), c=url) == wanted


def test_urls_match_the_standard_library(spark):
    from urllib.parse import urljoin
    bases = ["http://a.example/b/c/d?q", "https://a.example/x/", "https://a.example"]
    links = ["g", "./g", "g/", "/g", "//h/g", "?y", "g?y", "#s", "g#s", "../g", "../../g", "../../../g", "./../g",
             "g/./h", "g/../h", "..", "https://z.example/q", "g;x=1/../y"]
    df = spark.createDataFrame([(b, x) for b in bases for x in links], "b string, x string")
    for row in df.select("b", "x", U.absolute_url("b", F.col("x")).alias("got")).collect():
        assert row.got == urljoin(row.b, row.x), (row.b, row.x)


@pytest.mark.parametrize("raw, wanted", [
    ("مشکی ساده", "مشکی"), ("نسکافه ای", "قهوه\u200cای"), ("Navy", "سرمه\u200cای"), ("سورمه", "سرمه\u200cای"),
    ("قرمز جیگری", "قرمز"), ("طرح 12", ""), ("یشمی تیره", "سبز"), ("zzz", "zzz"), ("کرمی", "کرم")])
def test_standard_color(one, raw, wanted):
    assert one(C.standard_color(F.col("c")), c=raw) == wanted


def test_longest_phrase(one):
    words = ("dark green", "green", "sky-blue", "blue")
    assert one(C.match_standard(F.col("c"), words), c="very Dark  Green blue") == "dark green"
    assert one(C.match_standard(F.col("c"), words), c="s k y blue") == "sky-blue"
    assert one(C.match_standard(F.col("c"), words), c="blue green") == "blue"
    assert one(C.match_standard(F.col("c"), words), c="none") is None


@pytest.mark.parametrize("rgb, name", [
    ((0, 0, 0), "black"), ((250, 250, 250), "white"), ((255, 0, 0), "red"), ((100, 0, 0), "dark-red"),
    ((0, 255, 0), "green"), ((0, 0, 128), "navy-blue"), ((255, 215, 0), "gold"), ((255, 0, 255), "magenta")])
def test_color_name(one, rgb, name):
    assert one(C.color_name("r", "g", "b"), r=rgb[0], g=rgb[1], b=rgb[2]) == name


def test_similar(one):
    for a, b, wanted in (("black", "dark-gray", True), ("dark-gray", "black", True), ("sky-blue", "blue", True),
                         ("red", "green", False), ("honey", "gold", True), ("golden", "gold", True)):
        assert one(C.is_similar("a", "b"), a=a, b=b) is wanted


def test_fenced_reply(one):
    assert one(T.fenced_json_map("c"), c='```json\n{"a": "b"}\n```') == {"a": "b"}
    assert one(T.fenced_json_map("c"), c='{"a": "b"}') == {"a": "b"}
    assert one(T.fenced_json_map("c"), c="sorry") is None
