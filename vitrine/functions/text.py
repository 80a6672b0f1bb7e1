"""Text rules as Column expressions.

Java's ``\\s``, ``\\d`` and ``trim`` only know ASCII, so rules about white space
spell the Unicode blanks out and digits are folded to ASCII before they are
matched.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, functions as F

from vitrine import vocab as V

# Unicode white space.
WHITE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(
    map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
# Those that ``\s`` means under (?U).
PATTERN_WHITE = "".join(c for c in WHITE if not "\x1c" <= c <= "\x1f")
# One predicate under (?U); a class listing the blanks is many times slower.
WS = r"\s"
IN_WS = r"\s"

_ALL_DIGITS = V.PERSIAN_DIGITS + V.ARABIC_DIGITS
_ANY_DIGIT = f"[0-9{_ALL_DIGITS}]"
# Whole-word borders; a bare \b treats the zero-width non-joiner as a letter.
_WORD_START = r"(?<![\p{L}\p{N}_])"
_WORD_END = r"(?![\p{L}\p{N}_])"


def as_column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def unicode_blanks(pattern: str) -> str:
    return "(?U)" + pattern if r"\s" in pattern.lower() else pattern


def any_of(words, ignore_case: bool = False) -> str:
    """Pattern of any of some words; a place is only tried for all of them if one begins like it."""
    either = "|".join(map(re.escape, words))
    if not all(words):
        return f"(?i:{either})" if ignore_case else either
    firsts = {c for w in words for c in ((w[0].lower(), w[0].upper()) if ignore_case else w[0])}
    within = "".join(sorted(re.escape(c) for c in firsts if len(c) == 1))
    return f"(?=[{within}])(?{'i' if ignore_case else ''}:{either})"


def replace_pattern(c, pattern: str, by: str = "") -> Column:
    return F.regexp_replace(as_column(c), F.lit(unicode_blanks(pattern)), F.lit(by))


def found(c, pattern: str, group: int = 1) -> Column:
    """First match of ``pattern``, NULL (not '') when there is none."""
    return F.nullif(F.regexp_extract(as_column(c), unicode_blanks(pattern), group), F.lit(""))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once.

    Inside a lambda nothing is shared between repeated expressions, so what a
    rule uses several times per element is bound to a variable first.
    """
    return F.get(F.transform(F.array(as_column(value)), lambda v: body(v)), F.lit(0))


# ---- white space, blanks ----------------------------------------------------

def trim_any(c) -> Column:
    return F.btrim(as_column(c), F.lit(WHITE))


def squeeze(c) -> Column:
    return replace_pattern(trim_any(c), WS + "+", " ")


def is_blank(c) -> Column:
    c = as_column(c)
    return c.isNull() | (trim_any(c) == "")


def nullify_blank(c) -> Column:
    """NULL for NULL, blanks and the words a careless export leaves behind."""
    tidy = trim_any(as_column(c).cast("string"))
    # Most cells are longer than any of the words and are not lower-cased.
    longer = F.length(tidy) > max(map(len, V.MISSING_WORDS))
    return F.when(longer | ~F.lower(tidy).isin(*V.MISSING_WORDS), tidy)


def nullify_nan(c) -> Column:
    c = as_column(c)
    return F.when(~F.isnan(c), c)


def render_text(c) -> Column:
    return F.coalesce(as_column(c).cast("string"), F.lit(""))


# ---- digits, letters, invisible characters ----------------------------------

def ascii_digits(c) -> Column:
    c = as_column(c)
    # One range test spares most texts the letter-by-letter translation.
    return F.when(c.rlike("[٠-۹]"), F.translate(c, _ALL_DIGITS, V.ASCII_DIGITS * 2)).otherwise(c)


def persian_digits(c) -> Column:
    return F.translate(as_column(c).cast("string"), V.ASCII_DIGITS, V.PERSIAN_DIGITS)


def strip_invisible(c) -> Column:
    """Drop Unicode format characters (joiners, marks, BOM), then trim."""
    return trim_any(replace_pattern(c, r"\p{Cf}"))


def fold_letters(c) -> Column:
    """Arabic kaf and yeh spelled the Persian way."""
    out = as_column(c)
    for arabic, persian in zip("كيى", "کیی"):
        out = F.replace(out, F.lit(arabic), F.lit(persian))
    return out


def plain_text(c) -> Column:
    return squeeze(fold_letters(c))


def color_text(c) -> Column:
    return squeeze(F.replace(fold_letters(c), F.lit(V.ZWNJ), F.lit(" ")))


def has_persian(c) -> Column:
    return as_column(c).rlike(r"[\x{0600}-\x{06FF}]")


def truncate(c, n: int) -> Column:
    return F.substring(as_column(c), 1, n)


# ---- keys and slugs ---------------------------------------------------------

def color_key(c) -> Column:
    return bare_key(replace_pattern(c, WS + "+"))


def bare_key(c) -> Column:
    """The same for a text whose only blanks are plain ones."""
    out = as_column(c)
    for mark in (" ", V.ZWNJ, "_", "-"):
        out = F.replace(out, F.lit(mark), F.lit(""))
    return F.lower(out)


def slug(c) -> Column:
    kept = replace_pattern(c, rf"[^\p{{L}}\p{{N}}_{IN_WS}-]")
    return F.lower(F.replace(trim_any(kept), F.lit(" "), F.lit("-")))


def dash_slug(c) -> Column:
    dashed = F.translate(F.lower(trim_any(c)), " _", "--")
    return F.when(dashed == "nan", "").otherwise(replace_pattern(dashed, "-+", "-"))


def model_slug(c) -> Column:
    return F.lower(F.replace(as_column(c), F.lit(" "), F.lit("-")))


# ---- several values in one cell ---------------------------------------------

def split_values(c, separators: str = "-|,") -> Column:
    # One plain mark splits without a pattern; a pattern is compiled anew for every cell.
    *others, mark = separators
    cell = as_column(c)
    for other in others:
        cell = F.replace(cell, F.lit(other), F.lit(mark))
    return F.array_remove(F.transform(F.split(cell, "\\" + mark), trim_any), "")


def unify_separators(c) -> Column:
    # A run of marks and blanks with at least one mark becomes one bar.
    mark = r",\-/;\\،؛|"
    piped = replace_pattern(c, rf"{WS}*[{mark}][{mark}{IN_WS}]*", "|")
    return F.when(as_column(c).rlike(f"[{mark}]"), F.btrim(piped, F.lit("|"))).otherwise(as_column(c))


def tidy_multi(c) -> Column:
    """Comma or pipe separated cell to distinct values in first-seen order."""
    return let(as_column(c), lambda cell: let(
        F.array_distinct(split_values(cell, ",|")), lambda values: F.when(
            F.size(values) > 0, F.array_join(values, " | ")).otherwise(cell)))


# ---- words ------------------------------------------------------------------

def drop_word(c, word: str) -> Column:
    c = as_column(c)
    dropped = replace_pattern(c, _WORD_START + word + _WORD_END)
    return trim_any(F.when(c.contains(word), dropped).otherwise(c))


def drop_color_noise(c, patterns=V.COLOR_NOISE) -> Column:
    """Design and brand words out of a colour name, one after the other."""
    def cleaned(text):
        out = text
        for pattern in patterns:
            out = trim_any(replace_pattern(out, "(?iU)" + pattern))
        # Most names hold none of the words and skip the chain.
        return F.when(text.rlike("(?iU)" + "|".join(patterns)), out).otherwise(text)
    return let(ascii_digits(trim_any(c)), cleaned)


def filled(template: str, *cells) -> Column:
    """A template with its ``{}`` slots filled; NULL if any cell is."""
    first, *rest = template.split("{}")
    return F.concat(F.lit(first), *[x for cell, text in zip(cells, rest, strict=True)
                                    for x in (as_column(cell), F.lit(text))])


# ---- codes and names --------------------------------------------------------

def code_after_word(c) -> Column:
    return F.coalesce(found(ascii_digits(c), rf"{V.CODE_WORD}{WS}*([0-9]+)"), F.lit(""))


def code_or_first_number(c) -> Column:
    digits = ascii_digits(c)
    return F.coalesce(found(digits, rf"{V.CODE_WORD}{WS}*([0-9]+)"),
                      found(digits, "([0-9]+)"))


def trailing_code(c) -> Column:
    """Code or model number at the very end of a title."""
    number = rf"([A-Za-z]?{_ANY_DIGIT}{{3,}}){WS}*$"
    named = rf"(?:{V.CODE_WORD}|{V.MODEL_WORD}){WS}*{number}"
    return F.coalesce(found(c, named), found(c, number))


def numeric_code(c, shortest: int = 3, longest: int | None = 6) -> Column:
    """First number of so many digits, cut at ``longest``; whole if that is None."""
    most = "" if longest is None else longest
    return found(strip_invisible(ascii_digits(c)), rf"([0-9]{{{shortest},{most}}})")


def strip_price_suffix(c) -> Column:
    priced = rf"[0-9,{V.ARABIC_THOUSANDS}{IN_WS}]+(?:{V.TOMAN}|{V.RIAL})"
    return F.coalesce(squeeze(replace_pattern(ascii_digits(c), priced)), F.lit(""))


def name_through_code(c) -> Column:
    text = trim_any(ascii_digits(c))
    cut = F.coalesce(found(text, rf"(?s)^(.*?{V.CODE_WORD}{WS}*[0-9]+)"), text)
    # A glued-on price goes, but the number right behind the code word is the code, however long.
    cut = replace_pattern(cut, rf"(?<!{V.CODE_WORD})(?<!{WS}){WS}++[0-9]{{5,}}.*$")
    cut = replace_pattern(cut, rf"[{V.ARABIC_COMMA},{V.ARABIC_THOUSANDS}]+")
    return F.coalesce(squeeze(cut), F.lit(""))


def strip_code(c) -> Column:
    return trim_any(replace_pattern(c, rf"{WS}*{V.CODE_WORD}{WS}*{_ANY_DIGIT}+{WS}*"))


def strip_code_keep_gap(c) -> Column:
    """Dictionary form: the blank after the code stays."""
    return trim_any(replace_pattern(c, rf"{WS}*{V.CODE_WORD}{WS}*{_ANY_DIGIT}+"))


def transliterate(c) -> Column:
    """Persian letters spelled in Latin; stays a chain of codegen expressions."""
    out = F.translate(ascii_digits(trim_any(c)),
                      "".join(V.LATIN_SINGLE), "".join(V.LATIN_SINGLE.values()))
    for letter, latin in V.LATIN_PAIRS.items():
        out = F.replace(out, F.lit(letter), F.lit(latin))
    dashed = F.translate(F.lower(out), " " + V.ZWNJ, "--")
    kept = replace_pattern(dashed, "[^a-z0-9_-]")
    return replace_pattern(replace_pattern(kept, "-+", "-"), "^-|-$")


# ---- image file names -------------------------------------------------------

def letter_for_index(i) -> Column:
    """0 -> a, 25 -> z, 26 -> aa, 702 -> aaa, and so on without an end."""
    i = as_column(i).cast("bigint")

    def letter(n):
        return F.char(n.cast("bigint") + F.lit(97))

    # Base 26 without a zero, last letter first; a bigint has at most 14 letters.
    start = F.struct(i.alias("left"), F.lit("").alias("letters"))

    def step(v, _):
        more = F.struct((F.floor(v["left"] / 26).cast("bigint") - 1).alias("left"),
                        F.concat(letter(F.pmod(v["left"], F.lit(26))), v["letters"]).alias("letters"))
        return F.when(v["left"] < 0, v).otherwise(more)

    long = F.aggregate(F.sequence(F.lit(1), F.lit(14)), start, step)["letters"]
    two = i - 26
    return (F.when(i < 26, letter(i))
            .when(i < 702, F.concat(letter(F.floor(two / 26)), letter(two % 26))).otherwise(long))


def file_stem(path) -> Column:
    path = as_column(path)
    name = replace_pattern(path, r"^.*[/\\]")
    by_pattern = replace_pattern(name, r"(?<=.)\.[^.]*$")
    # Paths without backslashes and line ends, nearly all, are cut at marks.
    bare = F.substring_index(path, "/", -1)
    at = F.length(bare) - F.length(F.substring_index(bare, ".", -1))
    return F.when(path.rlike(r"[\\\n\r\x{0085}\x{2028}\x{2029}]"), by_pattern).otherwise(
        F.when(at > 1, F.substring(bare, F.lit(1), at - 1)).otherwise(bare))


def colors_in_filename(name) -> Column:
    stem = file_stem(name)
    color = F.coalesce(found(stem, r"(?si)^[a-z]?[0-9]+[a-z]+_(.*)"),
                       found(stem, r"(?si)^[a-z]?[0-9]+[a-z]+-(.*)"))
    color = F.nullif(F.lower(trim_any(color)), F.lit(""))
    return F.when(color.isNotNull(), F.array(color)).otherwise(F.array().cast("array<string>"))


def filename_tail(stem) -> Column:
    """What follows the key and letters in a processed image name."""
    return replace_pattern(F.lower(as_column(stem)), r"^[a-z]?[0-9]+[a-z]+[_\-]?")


def leading_number(stem) -> Column:
    return found(stem, r"^([0-9]+)")


def number_key(stem) -> Column:
    """The leading number as a number is written: ``007`` and ``7`` are one key."""
    return replace_pattern(leading_number(stem), r"^0+(?=[0-9])")


# ---- dimensions -------------------------------------------------------------

def _dimension(value, label: str, loose: bool) -> Column:
    text = trim_any(as_column(value))
    if loose:
        number = trim_any(replace_pattern(text, "(?i)cm"))
    else:
        number = replace_pattern(text, f"[^0-9{V.PERSIAN_DIGITS}.]")
        text = F.when(~F.lower(text).isin("", "nan", "none", "-"), text)
    return F.when(text.isNotNull() & (number != ""),
                  F.concat(F.lit(label + ": "), persian_digits(number), F.lit("cm")))


def dimension_text(length, width, depth, loose: bool = False) -> Column:
    return F.concat_ws("|", _dimension(length, V.LENGTH_LABEL, loose),
                       _dimension(width, V.WIDTH_LABEL, loose),
                       _dimension(depth, V.DEPTH_LABEL, loose))


def split_dimensions(c) -> Column:
    """``A x B x C`` to length, depth, width; ``A x B`` to length, width."""
    bare = F.replace(F.replace(as_column(c), F.lit("سانتیمتر"), F.lit("")), F.lit("cm"), F.lit(""))
    parts = F.filter(F.transform(F.split(bare, "[×x]"), trim_any), lambda x: x != "")

    def fields(p):
        n = F.size(p)

        def part(i):
            return F.concat(F.get(p, F.lit(i)), F.lit("cm"))
        return F.struct(F.when(n >= 2, part(0)).alias("length"),
                        F.when(n >= 3, part(2)).when(n == 2, part(1)).alias("width"),
                        F.when(n >= 3, part(1)).alias("depth"))
    return let(parts, fields)


def with_centimetres(c) -> Column:
    def measured(x):
        bare = F.replace(x, F.lit("."), F.lit("")).rlike(f"^{_ANY_DIGIT}+$")
        return F.when(bare, F.concat(x, F.lit("cm"))).otherwise(x)
    return let(as_column(c), measured)


def human_size(n) -> Column:
    n = as_column(n).cast("double")
    steps = [(1024.0 ** i, u) for i, u in enumerate(("B", "KB", "MB", "GB", "TB"))]
    out = None
    for unit, name in steps[:-1]:
        shown = F.format_string("%.2f " + name, n / unit)
        out = F.when(n / unit < 1024, shown) if out is None else out.when(n / unit < 1024, shown)
    return out.otherwise(F.format_string("%.2f TB", n / steps[-1][0]))


def sum_status(failed, found_any) -> Column:
    """Download status of one page from its failed-image count."""
    failed = as_column(failed)
    return (F.when(~found_any, "No Images Found")
            .when(failed > 0, F.format_string("Incomplete (%d failed)", failed))
            .otherwise("OK"))


def retry_status(failed) -> Column:
    failed = as_column(failed)
    return (F.when(failed > 0, F.format_string("Failed (%d images)", failed)).otherwise("OK"))


def is_complete_status(c) -> Column:
    return as_column(c).isin("OK", "OUT_OF_STOCK")


def needs_work_status(c) -> Column:
    c = as_column(c)
    return (c.isNull() | c.isin("Pending", "No Images Found", "")
            | c.startswith("Incomplete") | c.startswith("Failed"))


def fenced_json_map(c) -> Column:
    """A reply that is JSON, perhaps inside a code fence, as a string map."""
    text = trim_any(c)
    # An opening fence takes its whole line with it, the language name included.
    opened = replace_pattern(text, r"(?s)^```(?:[^\n]*\n)?")
    bare = F.when(text.startswith("```"), trim_any(replace_pattern(opened, r"```$"))).otherwise(text)
    return F.from_json(bare, "map<string,string>")
