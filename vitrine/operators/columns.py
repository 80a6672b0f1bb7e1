"""Column resolution, row filters and search over whole rows."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, functions as F

from vitrine import vocab as V
from vitrine.functions.text import PATTERN_WHITE, any_of, is_blank, nullify_blank, render_text


class MissingColumns(ValueError):
    """A table lacks a column its consumer cannot do without."""


def resolve_column(df: DataFrame, part: str | None = None, *, equal: str | None = None,
                   ignore_case: bool = False, without: tuple = ()) -> str | None:
    """First column whose header contains ``part`` or equals ``equal``."""
    fold = str.lower if ignore_case else str
    for name in df.columns:
        head = fold(name.strip())
        if equal is not None and head != fold(equal):
            continue
        if part is not None and fold(part) not in head:
            continue
        if any(fold(w) in head for w in without):
            continue
        return name
    return None


def require_columns(df: DataFrame, *names: str) -> DataFrame:
    missing = [n for n in names if n not in df.columns]
    if missing:
        raise MissingColumns(f"missing {missing}, table has {df.columns}")
    return df


def tidy_headers(df: DataFrame) -> DataFrame:
    """Headers without surrounding blanks and without a byte-order mark."""
    return df.toDF(*[c.replace("\ufeff", "").strip() for c in df.columns])


def nullify_blanks(df: DataFrame, *names: str) -> DataFrame:
    texts = names or [f.name for f in df.schema.fields if f.dataType.typeName() == "string"]
    return df.withColumns({n: nullify_blank(n) for n in texts})


def has_bad_cell(df: DataFrame, bad=V.BAD_CELLS) -> Column:
    """Whether any text cell is one of the disqualifying words."""
    def is_bad(c):
        return reduce(or_, [c.contains(b) & (F.btrim(c, F.lit(PATTERN_WHITE)) == b.strip(PATTERN_WHITE)) for b in bad],
                      F.lit(False))
    texts = [F.col(f"`{f.name}`") for f in df.schema.fields if f.dataType.typeName() == "string"]
    # One look at all cells together, so a filter that is pushed down works each out once; few rows go on.
    some = F.concat_ws(" ", *texts).rlike(any_of(bad))
    return some & F.coalesce(F.exists(F.array(*texts), is_bad), F.lit(False)) if texts and bad else F.lit(False)


def drop_reason(df: DataFrame, name: str, price: str, bad=V.BAD_CELLS) -> Column:
    """Why a row is not worth keeping; NULL for a good row."""
    return (F.when(has_bad_cell(df, bad), "bad_value")
            .when(is_blank(name) & is_blank(price), "blank_name_and_price"))


def drop_unusable(df: DataFrame, name: str, price: str, bad=V.BAD_CELLS) -> DataFrame:
    return df.filter(drop_reason(df, name, price, bad).isNull())


def copy_where_present(df: DataFrame, source: str, target: str) -> DataFrame:
    """``target`` takes ``source`` wherever that is not blank."""
    old = F.col(target) if target in df.columns else F.lit("")
    return df.withColumn(target, F.when(is_blank(source), old).otherwise(F.col(source)))


def any_column_contains(df: DataFrame, text: str) -> DataFrame:
    """Rows with ``text`` in some cell, whatever its case."""
    wanted = F.upper(F.lit(text))
    return df.filter(reduce(or_, [F.upper(F.col(c).cast("string")).contains(wanted)
                                  for c in df.columns], F.lit(False)))


def rendered(df: DataFrame) -> DataFrame:
    """All-text form of a table as sinks want it: '' for NULL, 7 for 7.0."""
    from vitrine.functions.prices import render_number
    out = []
    for f in df.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f"`{f.name}`")
        if kind in ("double", "float"):
            c = F.when(~F.isnan(c), render_number(c))
        elif kind == "array":
            c = F.array_join(c, " | ")
        elif kind == "map" or kind == "struct":
            c = F.to_json(c)
        out.append(render_text(c).alias(f.name))
    return df.select(*out)
