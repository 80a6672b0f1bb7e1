"""Price parsing and arithmetic as Column expressions.

Prices are whole currency units (bigint); percentages are doubles.  ``NaN``
compares greater than any number in Spark, so it becomes NULL before a test.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from vitrine import vocab as V
from vitrine.functions.text import (as_column, ascii_digits, nullify_blank, nullify_nan,
                                    replace_pattern, trim_any)


def _number(c) -> Column:
    return nullify_nan(as_column(c).try_cast("double"))


def largest_number(c, min_value: int = 1000, min_digits: int | None = None) -> Column:
    """Largest price-like integer in a text.

    With ``min_digits`` short numbers (codes) are ignored whatever their value;
    otherwise a number must exceed ``min_value``.
    """
    text = F.replace(ascii_digits(c), F.lit(V.ARABIC_THOUSANDS), F.lit(","))
    runs = F.transform(F.regexp_extract_all(text, F.lit("[0-9,]+"), F.lit(0)),
                       lambda x: F.replace(x, F.lit(","), F.lit("")))
    if min_digits is not None:
        runs = F.filter(runs, lambda x: F.length(x) >= min_digits)
    values = F.transform(runs, lambda x: x.try_cast("bigint"))
    if min_digits is None:
        values = F.filter(values, lambda x: x > min_value)
    return F.array_max(values)


def price_digits(c) -> Column:
    """Digits of a price text, '' when it has none."""
    return F.coalesce(replace_pattern(ascii_digits(c), "[^0-9]"), F.lit(""))


def parse_price(c) -> Column:
    text = replace_pattern(as_column(c).cast("string"), f"[,{V.ARABIC_THOUSANDS}]")
    return _number(trim_any(text))


def thousands(c) -> Column:
    """1234567 -> 1,234,567; '' for NULL."""
    return F.coalesce(F.format_string("%,d", as_column(c).cast("bigint")), F.lit("")) \
        if not isinstance(c, str) else thousands(F.col(c))


def thousands_text(c) -> Column:
    """The same for a text cell; what is no number is handed back as it is."""
    c = as_column(c)
    value = parse_price(c).try_cast("bigint")
    bare = trim_any(replace_pattern(c, f"[,{V.ARABIC_THOUSANDS}]"))
    return (F.when(c.isNull() | (bare == ""), "")
            .when(value.isNull(), bare)
            .otherwise(F.format_string("%,d", value)))


def persian_thousands(c) -> Column:
    return F.replace(thousands_text(c), F.lit(","), F.lit(V.ARABIC_THOUSANDS))


def with_currency(c) -> Column:
    return F.concat(thousands(as_column(c)), F.lit(" " + V.TOMAN))


def positive(c) -> Column:
    """Whole positive amount of a text cell, NULL for anything else."""
    whole = _number(trim_any(as_column(c).cast("string"))).try_cast("bigint")
    return F.when(whole > 0, whole)


def effective_price(regular, sale) -> Column:
    """A real sale price, else the regular one; zero is no price at all."""
    return F.coalesce(positive(sale), positive(regular))


def price_change(old, new) -> Column:
    old, new = as_column(old), as_column(new)
    amount = F.when(old == 0, F.lit(0).cast("bigint")).otherwise((new - old).cast("bigint"))
    percent = F.when(old == 0, F.lit(0.0)).otherwise((new - old) / F.nullif(old, F.lit(0)) * 100)
    return F.struct(amount.alias("amount"), percent.alias("percent"))


def tracked_percent(old, new) -> Column:
    old, new = as_column(old), as_column(new)
    return F.when(old > 0, (new - old) / old * 100).otherwise(0.0)


def signed_amount(c) -> Column:
    c = as_column(c)
    return F.when(c > 0, F.format_string("+%,d", c)).otherwise(F.format_string("%,d", c))


def signed_percent(c, decimals: int = 1) -> Column:
    c = as_column(c)
    shape = f"%.{decimals}f%%"
    return F.when(c > 0, F.format_string("+" + shape, c)).otherwise(F.format_string(shape, c))


def round_to_thousand(c) -> Column:
    """Nearest 1000, halves upwards."""
    return (F.floor(as_column(c) / 1000 + 0.5) * 1000).cast("bigint")


def render_number(c) -> Column:
    """Whole doubles without their '.0'."""
    c = as_column(c)
    return (F.when(c == F.floor(c), c.try_cast("bigint").cast("string"))
            .otherwise(c.cast("string")))


def has_discount(*cells) -> Column:
    out = F.lit(False)
    for cell in cells:
        out = out | F.coalesce(parse_price(nullify_blank(cell)) > 0, F.lit(False))
    return out
