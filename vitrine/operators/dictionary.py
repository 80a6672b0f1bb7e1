"""Dictionaries: lookup with fallback, unknown terms, maintenance."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine import vocab as V
from vitrine.functions import text as T
from vitrine.functions.colors import literal_map
from vitrine.operators.scale import (exploded, first_by_key, last_by_key, local_frame,
                                     rows_if_small, top_n_by_key)


def pairs_frame(spark: SparkSession, pairs: dict, source: str = "term",
                target: str = "translation") -> DataFrame:
    return local_frame(spark, {"ord": list(range(len(pairs))), source: list(pairs),
                               target: list(pairs.values())},
                       f"ord int, {source} string, {target} string")


def usable_entries(entries: DataFrame) -> DataFrame:
    """Rows of a dictionary table (ord, term, translation) with both sides."""
    return (entries.withColumns({"term": T.nullify_blank("term"),
                                 "translation": T.nullify_blank("translation")})
            .filter(F.col("term").isNotNull() & F.col("translation").isNotNull()))


def compact(c, drop: str = "- " + V.ZWNJ) -> Column:
    return T.replace_pattern(F.lower(T.trim_any(c)), f"[{drop.replace('-', '')}\\-]")


@dataclass(frozen=True)
class Lookup:
    """One way to find a term: the key of the term and of the entry."""
    key: object
    value: object = F.col
    keep: str = "last"          # which entry wins when keys collide

    def table(self, entries: DataFrame, n: int) -> DataFrame:
        keyed = entries.select(self.key("term").alias(f"__k{n}"),
                               self.value("translation").alias(f"__v{n}"), "ord")
        pick = last_by_key if self.keep == "last" else first_by_key
        return pick(keyed, f"__k{n}", "ord").drop("ord")


EXACT = Lookup(lambda c: T.trim_any(c))
LOWER = Lookup(lambda c: F.lower(T.trim_any(c)), lambda c: F.lower(T.trim_any(c)))
LOOSE = Lookup(compact, lambda c: F.lower(T.trim_any(c)), keep="first")


def look_up(df: DataFrame, term: str, entries: DataFrame, lookups, fallback: Column,
            out: str, found: str | None = None) -> DataFrame:
    """Left-join ``term`` against every lookup in turn, then the fallback."""
    entries = usable_entries(entries)
    hits = []
    for n, lookup in enumerate(lookups):
        side = lookup.table(entries, n)
        df = df.join(side, lookup.key(term) == F.col(f"__k{n}"), "left")
        hits.append(F.col(f"__v{n}"))
    hit = F.coalesce(*hits)
    df = df.withColumn(out, F.when(T.is_blank(term), "").otherwise(F.coalesce(hit, fallback)))
    if found:
        df = df.withColumn(found, hit.isNotNull())
    return df.drop(*[f"__{s}{n}" for n in range(len(lookups)) for s in "kv"])


def translate_color(df, term, entries, out="color_en", found=None) -> DataFrame:
    """Colour to English; unknown ones are spelled out in Latin letters."""
    spelled = F.coalesce(F.nullif(T.transliterate(term), F.lit("")), F.col(term))
    return look_up(df, term, entries, (LOWER, LOOSE), spelled, out, found)


def translate_color_slug(df, term, entries, out="color_en", found=None) -> DataFrame:
    """The same with a slug for unknown colours, after letter folding."""
    lookup = Lookup(T.color_text, lambda c: T.trim_any(c))
    return look_up(df, term, entries, (lookup,), T.slug(T.color_text(term)), out, found)


def color_in_persian(df, term, entries, out="color_fa") -> DataFrame:
    flipped = entries.select("ord", F.col("translation").alias("term"),
                             F.col("term").alias("translation"))
    exact = Lookup(lambda c: F.lower(T.trim_any(c)), lambda c: T.trim_any(c))
    loose = Lookup(lambda c: compact(c, "- _"), lambda c: T.trim_any(c), keep="first")
    return look_up(df, term, flipped, (exact, loose), F.col(term), out)


def translate_name(df, term, entries, out="name_en", found=None) -> DataFrame:
    """Product name without its code to English, spelled out if unknown."""
    key = Lookup(lambda c: T.strip_code_keep_gap(c), lambda c: T.trim_any(c))
    return look_up(df, term, entries, (key,), T.transliterate(T.strip_code_keep_gap(term)),
                   out, found)


# ---- cells with several terms -----------------------------------------------

@dataclass(frozen=True)
class WordMap:
    """A small dictionary as a literal, and a quick test for its words."""
    words: Column
    hint: str


def translation_map(entries: DataFrame) -> WordMap | None:
    """Lower-cased words of a dictionary, or None when it is too large."""
    rows = rows_if_small(usable_entries(entries).orderBy("ord"))
    if rows is None:
        return None
    words = {r.term.lower(): r.translation for r in rows}
    few = len(words) <= 64
    hint = T.any_of(words, ignore_case=True) if few and words else "[a-zA-Z0-9_]"
    return WordMap(literal_map(words), hint)


_SEPARATORS = r"|،,;؛"
_LATIN = r"(?U)^[a-zA-Z0-9_\s]+$"


def cell_tokens(c) -> Column:
    """A cell cut at its separators, the separators kept as tokens."""
    edge = f"(?<=[{_SEPARATORS}])|(?=[{_SEPARATORS}])"
    return F.split(T.as_column(c), edge)


def _is_latin(token) -> Column:
    return T.trim_any(token).rlike(_LATIN)


def translate_cell(c, known_words: WordMap) -> Column:
    """Known Latin tokens replaced in place, blanks and separators kept."""
    words = known_words.words

    def swap(token):
        return T.let(T.trim_any(token), lambda bare: T.let(
            F.when(bare.rlike(_LATIN), F.try_element_at(words, F.lower(bare))),
            lambda known: F.when(known.isNull(), token).otherwise(F.concat(
                F.regexp_extract(token, r"(?U)^(\s*)", 1), known,
                F.regexp_extract(token, r"(?U)(\s*)$", 1)))))
    c = T.as_column(c)
    # Most cells hold no word of the dictionary and skip the array work.
    return F.when(c.rlike(known_words.hint),
                  F.array_join(F.transform(cell_tokens(c), swap), "")).otherwise(c)


def known_tokens(c, known_words: WordMap) -> Column:
    """Tokens of a cell the dictionary would replace."""
    tokens = F.filter(F.transform(cell_tokens(c), T.trim_any), lambda t: (
        t.rlike(_LATIN) & F.try_element_at(known_words.words, F.lower(t)).isNotNull()))
    return F.when(T.as_column(c).rlike(known_words.hint), tokens)


def translated_cells(df: DataFrame, columns, entries: DataFrame) -> DataFrame:
    """(cell, new, known): every distinct cell of ``columns`` that a dictionary changes.

    The Latin tokens of a cell meet the dictionary by a join, so it may have any
    size; separators and other tokens, which have no key, are not sent.  A cell is
    put together again from its own text and the tokens found, whatever rows it is in.
    """
    lookup = last_by_key(usable_entries(entries).select(
        F.lower("term").alias("__t"), F.col("translation").alias("__v"), "ord"), "__t", "ord").drop("ord")
    cells = (df.select(F.explode(F.array(*[F.col(c).cast("string") for c in columns])).alias("cell"))
             .filter(F.col("cell").rlike("[a-zA-Z0-9_]")).distinct())
    latin = F.filter(F.transform(cell_tokens("cell"), lambda t, i: F.struct(
        i.alias("i"), F.when(_is_latin(t), F.lower(T.trim_any(t))).alias("t"))), lambda x: x["t"].isNotNull())
    tokens = exploded(cells, latin, "__tok", "cell").select("cell", "__tok.i", F.col("__tok.t").alias("__t"))
    found = tokens.join(lookup, "__t").groupBy("cell").agg(
        F.map_from_entries(F.collect_list(F.struct("i", "__v"))).alias("__found"))

    def swapped(token, i):
        return T.let(F.try_element_at("__found", i), lambda v: F.when(v.isNull(), token).otherwise(F.concat(
            F.regexp_extract(token, r"(?U)^(\s*)", 1), v, F.regexp_extract(token, r"(?U)(\s*)$", 1))))
    return found.select("cell", F.array_join(F.transform(cell_tokens("cell"), swapped), "").alias("new"),
                        F.size("__found").alias("known"))


def translate_columns(df: DataFrame, columns, entries: DataFrame, counted: str | None = None) -> DataFrame:
    """Translate the Latin tokens of ``columns`` by a dictionary of any size.

    With ``counted``, a column of that name has the number of tokens replaced
    in the row.  A small dictionary becomes a literal map and the table is not
    shuffled; a large one is joined to the distinct cells.  Both ways give the
    same rows: of entries with one term the last counts.
    """
    columns = list(columns)
    words = translation_map(entries)
    if words is not None:
        if counted:
            df = df.withColumn(counted, sum((F.coalesce(F.size(known_tokens(c, words)), F.lit(0))
                                             for c in columns), F.lit(0)))
        return df.withColumns({c: translate_cell(c, words) for c in columns})
    cells = translated_cells(df, columns, entries)
    total = F.lit(0)
    for i, c in enumerate(columns):
        side = cells.select(F.col("cell").alias("__cell"), F.col("new").alias("__new"), F.col("known").alias(f"__n{i}"))
        df = (df.join(side, F.col(c) == F.col("__cell"), "left")
              .withColumn(c, F.coalesce("__new", c)).drop("__new", "__cell"))
        total = total + F.coalesce(f"__n{i}", F.lit(0))
    if counted:
        df = df.withColumn(counted, total)
    return df.drop(*[f"__n{i}" for i in range(len(columns))])


def unknown_tokens(df: DataFrame, columns, entries: DataFrame) -> DataFrame:
    """Distinct Latin tokens of any cell that the dictionary lacks."""
    cells = F.concat(*[F.coalesce(cell_tokens(c), F.array().cast("array<string>"))
                       for c in columns])
    latin = F.array_distinct(F.transform(F.filter(cells, _is_latin), T.trim_any))
    tokens = exploded(df, latin, "token").filter("token <> ''").distinct()
    known = usable_entries(entries).select(F.lower("term").alias("__t")).distinct()
    return tokens.join(known, F.lower("token") == F.col("__t"), "left_anti")


def unknown_values(df: DataFrame, values: Column, entries: DataFrame, key=T.color_text,
                   out: str = "term") -> DataFrame:
    """Distinct values of an array cell whose key is in no entry."""
    terms = df.select(F.explode(F.array_distinct(F.transform(values, key))).alias(out)).distinct()
    known = usable_entries(entries).select(key("term").alias("__t")).distinct()
    return (terms.filter(F.col(out) != "")
            .join(known, F.col(out) == F.col("__t"), "left_anti"))


def term_report(terms: DataFrame, term: str, sample: str, order: str = "ord",
                samples: int = 5) -> DataFrame:
    """Product count and first sample names per term.

    Counting and sampling are separate: no task ever holds all the products of
    a popular term.
    """
    counts = terms.groupBy(term).agg(F.count(sample).alias("product_count"))
    few = top_n_by_key(terms.filter(F.col(sample).isNotNull()), term, order, samples)
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order), F.col(sample).alias("s"))))
    shown = few.groupBy(term).agg(
        F.array_join(F.transform(pairs, lambda p: p["s"]), " | ").alias("sample_products"))
    return counts.join(shown, term, "left")


def review_sheet(unknown: DataFrame, term: str = "term", note: str = "needs translation",
                 suggest: bool = False) -> DataFrame:
    """Unknown terms laid out for a person to fill in."""
    english = T.transliterate(term) if suggest else F.lit("")
    return unknown.select(F.col(term).alias("Persian"), english.alias("English"),
                          F.lit(note).alias("Notes"))


def merge_entries(entries: DataFrame, new: DataFrame, ignore_case: bool = True) -> DataFrame:
    """Dictionary plus the new entries whose term it does not hold yet."""
    def key(c):
        return F.lower(T.trim_any(c)) if ignore_case else F.col(c)
    fresh = first_by_key(new.withColumn("__t", key("term")), "__t", "ord")
    known = entries.select(key("term").alias("__t")).distinct()
    return entries.unionByName(fresh.join(known, "__t", "left_anti").drop("__t"),
                               allowMissingColumns=True)


def dictionary_summary(entries: DataFrame, unknown: DataFrame) -> DataFrame:
    """Lines of the dictionary report, in print order."""
    entry = F.format_string("%-20s -> %s", "term", "translation")
    head = (entries.agg(F.count("*").alias("n"))
            .select(F.lit(0).alias("section"), F.lit("").alias("key"),
                    F.format_string("Total: %d", "n").alias("value")))
    head_unknown = (unknown.agg(F.count("*").alias("n"))
                    .select(F.lit(1).alias("section"), F.lit("").alias("key"),
                            F.format_string("Unknown: %d", "n").alias("value")))
    listed = entries.select(F.lit(2).alias("section"), F.col("term").alias("key"),
                            entry.alias("value"))
    missing = unknown.select(F.lit(3).alias("section"), F.col("term").alias("key"),
                             F.concat(F.lit("• "), "term").alias("value"))
    return head.unionByName(head_unknown).unionByName(listed).unionByName(missing)

