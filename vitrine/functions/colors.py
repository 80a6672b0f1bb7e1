"""Colour arithmetic, matching and standard names as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vitrine import vocab as V
from vitrine.functions.text import (as_column, bare_key, color_key, drop_color_noise, let,
                                    trim_any)


def literal_map(pairs: dict) -> Column:
    flat = [F.lit(x) for kv in pairs.items() for x in kv]
    return F.create_map(*flat) if flat else F.create_map().cast("map<string,string>")


# ---- pixels -----------------------------------------------------------------

def hsv(r, g, b) -> Column:
    red, green, blue = (as_column(x) / 255.0 for x in (r, g, b))
    top = F.greatest(red, green, blue)
    spread = top - F.least(red, green, blue)
    # Dividing by NULL keeps grey pixels from dividing by zero.
    per = F.nullif(spread, F.lit(0.0))
    hue = (F.when(spread == 0, 0.0)
           .when(top == red, F.pmod(60 * ((green - blue) / per) + 360, F.lit(360.0)))
           .when(top == green, F.pmod(60 * ((blue - red) / per) + 120, F.lit(360.0)))
           .otherwise(F.pmod(60 * ((red - green) / per) + 240, F.lit(360.0))))
    return F.struct(hue.alias("h"),
                    F.when(top == 0, 0.0).otherwise(spread / F.nullif(top, F.lit(0.0))).alias("s"),
                    top.alias("v"))


def is_background(r, g, b) -> Column:
    r, g, b = as_column(r), as_column(g), as_column(b)
    bright = (r > 235) & (g > 235) & (b > 235)
    flat = (F.greatest(r, g, b) - F.least(r, g, b)) < 25
    return bright | (flat & ((r + g + b) / 3 > 200))


def _palette_hsv(palette):
    import colorsys
    out = []
    for i, (name, r, g, b) in enumerate(palette):
        h, s, v = colorsys.rgb_to_hsv(r / 255.0, g / 255.0, b / 255.0)
        out.append(F.struct(F.lit(h * 360).alias("h"), F.lit(s).alias("s"), F.lit(v).alias("v"),
                            F.lit(i).alias("i"), F.lit(name).alias("name")))
    return F.array(*out)


def nearest_palette_name(h, s, v, palette=V.PALETTE) -> Column:
    """Named colour at the smallest weighted HSV distance, first one on ties."""
    def scored(p):
        turn = F.abs(h - p["h"])
        score = (F.least(turn, 360 - turn) * 2.0 + F.abs(s - p["s"]) * 100
                 + F.abs(v - p["v"]) * 80)
        return F.struct(F.round(score, 9).alias("score"), p["i"].alias("i"), p["name"].alias("name"))

    return F.array_min(F.transform(_palette_hsv(palette), scored))["name"]


def color_name(r, g, b, palette=V.PALETTE) -> Column:
    """Name of a pixel colour: a ladder for greys, reds and pinks, else nearest."""
    # Bound once: every entry of the palette looks at all of them.
    r, g, b = as_column(r), as_column(g), as_column(b)
    bound = F.struct(r.alias("r"), g.alias("g"), b.alias("b"), hsv(r, g, b).alias("hsv"))
    return let(bound, lambda p: _name_of(p["r"], p["g"], p["b"], p["hsv"], palette))


def _name_of(r, g, b, pixel, palette) -> Column:
    h, s, v = pixel["h"], pixel["s"], pixel["v"]
    mean = (r + g + b) / 3
    flat = (F.greatest(r, g, b) - F.least(r, g, b)) < 20
    warm = (r > g) & (g > b)
    grey = (F.when(mean < 40, "black").when(mean < 80, "dark-gray").when(mean < 130, "gray")
            .when(mean < 180, "light-gray").when(mean < 235, "silver").otherwise("white"))
    pale_warm = warm & (r - g > 5) & (g - b > 5)
    pale = (F.when(pale_warm & (mean > 230), "cream").when(pale_warm & (mean > 200), "beige")
            .when(pale_warm & (mean > 170), "tan")
            .when(mean > 240, "off-white").otherwise("light-gray"))
    dull = (F.when(warm & (r - b > 15) & (mean > 140), "tan")
            .when(warm & (r - b > 15), "brown").otherwise("gray"))
    reds = (F.when(v < 0.5, "dark-red").when((s > 0.7) & (v > 0.7), "red").otherwise("burgundy"))
    pinks = F.when(s > 0.7, "magenta").when(v > 0.7, "pink").otherwise("dusty-pink")
    return (F.when(flat, grey)
            .when((v < 0.30) & (s < 0.35), "black")
            .when(v < 0.25, "black")
            .when((s < 0.25) & (v > 0.80), pale)
            .when((s < 0.25) & (v < 0.35), "black")
            .when(s < 0.25, dull)
            .when(((h < 15) | (h > 345)) & (s > 0.4), reds)
            .when((h >= 300) & (h < 345) & (s > 0.3), pinks)
            .otherwise(nearest_palette_name(h, s, v, palette)))


def cluster_score(r, g, b, share, dark_product) -> Column:
    """How well one pixel cluster represents its picture."""
    r, g, b = as_column(r), as_column(g), as_column(b)
    light = (r + g + b) / 3
    s = hsv(r, g, b)["s"]
    on_dark = F.when(light < 60, 5.0).when(light < 100, 3.0).otherwise(-2.0)
    on_light = F.when(s > 0.3, 2.0).when(light > 200, -3.0).otherwise(0.0)
    return s * 2.0 + as_column(share) * 4.0 + F.when(dark_product, on_dark).otherwise(on_light)


# ---- names ------------------------------------------------------------------

def is_similar(a, b, table=V.SIMILAR_COLORS) -> Column:
    """Equal, one inside the other, or listed as neighbours either way."""
    near = F.create_map(*[x for k, vs in table.items()
                          for x in (F.lit(k), F.array(*[F.lit(v) for v in vs]))])

    def listed(x, y):
        return F.coalesce(F.array_contains(F.try_element_at(near, x), y), F.lit(False))

    return let(F.struct(F.lower(trim_any(a)).alias("a"), F.lower(trim_any(b)).alias("b")), lambda v: (
        v["a"].contains(v["b"]) | v["b"].contains(v["a"])
        | listed(v["a"], v["b"]) | listed(v["b"], v["a"])))


def neighbours(a, table=V.SIMILAR_COLORS) -> Column:
    """Names that ``is_similar`` lists with ``a``, either way; NULL for none."""
    both: dict = {}
    for name, others in table.items():
        for other in others:
            both.setdefault(name, set()).add(other)
            both.setdefault(other, set()).add(name)
    near = F.create_map(*[x for k, vs in both.items()
                          for x in (F.lit(k), F.array(*[F.lit(v) for v in sorted(vs)]))])
    return F.try_element_at(near, as_column(a))


def standard_color(c, spellings=V.COLOR_SPELLINGS, standards=V.STANDARD_COLORS) -> Column:
    """Site colour of a raw colour text.

    Noise words go first; then the spelling table, the table again without
    trailing yeh and heh, a standard colour equal to or inside the text, the
    first word alone, and finally the cleaned text itself.
    """
    table = literal_map({word.lower(): standard for word, standard in spellings.items()})
    ordered = F.array(*[F.struct(F.lit(x).alias("name"), F.lit(x.lower()).alias("low"))
                        for x in standards])

    def first_standard(test):
        return F.get(F.filter(ordered, lambda s: test(s["low"])), F.lit(0))["name"]

    def of_words(v):
        stripped = F.regexp_replace(F.regexp_replace(v["low"], "ی+$", ""), "ه+$", "")
        arabic_yeh = F.replace(v["low"], F.lit("ی"), F.lit("ي"))
        first = F.split_part(F.regexp_replace(v["low"], r"(?U)\s+", " "), F.lit(" "), F.lit(1))
        compound = v["clean"].contains(" ")
        by_first_word = let(first, lambda w: F.coalesce(
            F.try_element_at(table, w), first_standard(lambda s: s.contains(w))))
        return F.coalesce(
            F.try_element_at(table, v["low"]), F.try_element_at(table, stripped),
            F.try_element_at(table, arabic_yeh),
            first_standard(lambda s: v["low"] == s), first_standard(lambda s: v["low"].contains(s)),
            F.when(compound, by_first_word), v["clean"])

    cleaned = let(drop_color_noise(c), lambda x: let(
        F.struct(x.alias("clean"), F.lower(x).alias("low")), of_words))
    return F.when(as_column(c) != "", cleaned)


def distinct_ignoring_case(values) -> Column:
    """First spelling of every value, in order."""
    keyed = F.transform(as_column(values), F.lower)
    return F.filter(as_column(values), lambda x, i: (
        (x != "") & (F.array_position(keyed, F.lower(x)) == (i + 1).cast("bigint"))))


def standard_colors(values) -> Column:
    return distinct_ignoring_case(F.filter(F.transform(as_column(values), lambda c: standard_color(c)),
                                           lambda x: x.isNotNull()))


def longest_phrase(c, standards: dict, longest_key: int) -> Column:
    """First dictionary colour among the word n-grams of ``c``.

    ``standards`` maps comparison keys to colours.  Longer phrases win, then
    the leftmost.  A phrase cannot match once it has more words than the
    longest key has letters, which bounds the n-grams of a runaway cell.
    """
    known = literal_map(standards)

    def matched(words):
        n = F.size(words)
        silent = F.size(F.filter(words, lambda w: bare_key(w) == ""))
        sizes = F.sequence(F.least(n, F.lit(longest_key) + silent), F.lit(1), F.lit(-1))
        grams = F.flatten(F.transform(sizes, lambda size: F.transform(
            F.sequence(F.lit(1), n - size + 1),
            lambda at: bare_key(F.array_join(F.slice(words, at, size), "")))))
        hits = F.filter(F.transform(grams, lambda g: F.try_element_at(known, g)),
                        lambda x: x.isNotNull())
        return F.when(n > 0, F.get(hits, F.lit(0)))

    # Most cells match as a whole and never reach the n-grams.
    whole = F.try_element_at(known, color_key(c))
    words = F.filter(F.split(trim_any(c), r"(?U)\s+"), lambda w: w != "")
    return F.coalesce(whole, let(words, matched))


def standards_by_key(standards=V.STANDARD_COLORS) -> dict:
    import re
    out: dict = {}
    for color in standards:
        out.setdefault(re.sub(rf"[\s{V.ZWNJ}_\-]+", "", color).lower(), color)
    return out


def match_standard(c, standards=V.STANDARD_COLORS) -> Column:
    keys = standards_by_key(standards)
    return longest_phrase(c, keys, max(map(len, keys), default=0))

