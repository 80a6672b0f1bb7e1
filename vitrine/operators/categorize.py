"""Rule-based categories and the first-keyword join behind them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, functions as F

from vitrine import vocab as V
from vitrine.functions.prices import has_discount
from vitrine.functions.text import let, nullify_blank, render_text
from vitrine.operators.scale import LITERAL_ROWS, rows_if_small, spread


# A longer CASE makes methods the JVM no longer compiles.
_CASE_RULES = 6


def first_keyword(text: Column, rules) -> Column:
    """Value of the first (keyword, value) rule whose keyword is in ``text``."""
    if len(rules) > _CASE_RULES:
        table = F.array(*[F.struct(F.lit(k).alias("k"), F.lit(v).alias("v")) for k, v in rules])
        return F.get(F.filter(table, lambda r: text.contains(r["k"])), F.lit(0))["v"]
    out = None
    for keyword, value in rules:
        hit = text.contains(keyword)
        out = F.when(hit, F.lit(value)) if out is None else out.when(hit, F.lit(value))
    return F.lit(None).cast("string") if out is None else out


#: Bits of each part of the filter on keywords; they have this size for any number of keywords.
FILTER_BITS = 1 << 20
#: Characters of a keyword's beginning, middle and end that the filter looks at.
MARK = 4
#: Texts are searched in stretches of this many characters.
STRETCH = 256


def _marks(text: Column, at, size: Column) -> dict:
    """What the filter keeps of the ``size`` characters at ``at``: beginning, middle, end and all of them."""
    mark, at = F.least(size, F.lit(MARK)), F.lit(at) if isinstance(at, int) else at
    head = F.substring(text, at, mark)
    middle = F.substring(text, at + F.floor((size - mark) / 2).cast("int"), mark)
    return {"head": F.xxhash64(F.lit(0), head), "middle": F.xxhash64(F.lit(1), size, middle),
            "tail": F.xxhash64(F.lit(2), size, F.substring(text, at + size - mark, mark)),
            "whole": F.xxhash64(F.lit(3), size, F.substring(text, at, size))}


def keyword_filter(rules: DataFrame) -> dict:
    """Per mark a test of its hash: true for those of all keywords, and for few others unless keywords are very many."""
    size = F.length("keyword")
    hashes = F.array(*[F.struct(F.lit(name).alias("mark"), F.pmod(h, F.lit(FILTER_BITS)).alias("at"))
                       for name, h in _marks(F.col("keyword"), 1, size).items()])
    words = (rules.select(F.explode(hashes).alias("b"))
             .groupBy("b.mark", F.shiftright("b.at", 6).alias("word"))
             .agg(F.bit_or(F.expr("shiftleft(1L, CAST(b.at % 64 AS INT))")).alias("bits")))
    # At most FILTER_BITS / 64 numbers per mark.
    found = {(r.mark, r.word): r.bits for r in words.collect()}

    def test(name):
        # One literal, which the optimizer turns into an array once.
        table = F.split(F.lit(",".join(str(found.get((name, i), 0)) for i in range(FILTER_BITS // 64))), ",").cast("array<bigint>")

        def has(h: Column) -> Column:
            at = F.pmod(h, F.lit(FILTER_BITS))
            return F.getbit(F.get(table, F.shiftright(at, 6).cast("int")), (at % 64).cast("int")) == 1
        return has
    return {name: test(name) for name in ("head", "middle", "tail", "whole")}


def text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def possible_keywords(texts: DataFrame, sizes: list[int], tests: dict) -> DataFrame:
    """(id, piece) of the pieces of texts that are as long as some keyword and that the filter lets through.

    Texts are cut into stretches, as a place in a string is only found by
    counting from its beginning; each stretch sees as far into the next one
    as the longest keyword.
    """
    step = max(STRETCH, max(sizes))
    whole = F.col("text")
    parts = F.arrays_zip(F.regexp_extract_all(whole, F.lit(rf"(?s).{{1,{step}}}"), F.lit(0)).alias("core"),
                         F.regexp_extract_all(whole, F.lit(rf"(?s).{{1,{step}}}(?=(.{{0,{max(sizes)}}}))"), F.lit(1)).alias("ahead"))
    short = F.array(F.struct(whole.alias("core"), F.lit("").alias("ahead")))
    cut = texts.select("id", F.explode(F.when(F.length(whole) <= step, short).otherwise(parts)).alias("part")).select(
        "id", F.length("part.core").alias("starts"), F.concat("part.core", "part.ahead").alias("stretch"))
    stretch, at, size = F.col("stretch"), F.col("at"), F.col("size")
    begun = None
    for n in sorted({min(s, MARK) for s in sizes}):
        head = tests["head"](_marks(stretch, at, F.lit(n))["head"])
        begun = head if begun is None else begun | head
    begins = cut.filter("starts > 0").select("id", "stretch", F.explode(F.sequence(F.lit(1), F.col("starts"))).alias("at")).filter(begun)
    sized = begins.select("id", "stretch", "at", F.explode(F.array(*[F.lit(n) for n in sizes])).alias("size"))
    marks = _marks(stretch, at, size)
    fits = at + size - 1 <= F.length(stretch)
    for name in ("tail", "middle", "whole"):
        fits = fits & tests[name](marks[name])
    return sized.filter(fits).select("id", F.substring(stretch, at, size).alias("piece"))


def with_first_keyword(df: DataFrame, text: str, rules: DataFrame, out: str,
                       literal_rows: int = LITERAL_ROWS) -> DataFrame:
    """Substring join to (rule_ord, keyword, value) with the lowest rule first.

    A small rule table is compiled to one CASE.  Of a large one, texts send
    their pieces that are as long as some keyword and begin, go on and end
    like one, by a filter of fixed size; a piece that equals a keyword is a
    hit.  So neither texts nor frequent parts of keywords are shuffled.
    """
    rules = rules.filter("keyword <> ''")
    rows = rows_if_small(rules, literal_rows)
    if rows is not None:
        ordered = [(r.keyword, r.value) for r in sorted(rows, key=lambda r: r.rule_ord)]
        return df.withColumn(out, first_keyword(F.col(text), ordered))
    # One number per length of keywords.
    sizes = sorted(r[0] for r in rules.select(F.length("keyword")).distinct().collect())
    texts = df.select(F.col(text).alias("text")).filter("text is not null").withColumn("id", text_key(F.col("text")))
    pieces = possible_keywords(spread(texts), sizes, keyword_filter(rules))
    index = rules.groupBy("keyword").agg(F.min(F.struct("rule_ord", "value")).alias("__rule"))
    best = (pieces.join(index, F.col("piece") == F.col("keyword"))
            .groupBy(F.col("id").alias("__id")).agg(F.min("__rule").alias("__rule")))
    return (df.withColumn("__key", text_key(F.col(text))).join(best, F.col("__key") == F.col("__id"), "left")
            .withColumn(out, F.col("__rule.value")).drop("__key", "__id", "__rule"))


@dataclass(frozen=True)
class Taxonomy:
    """Category tree, its keywords and extra aliases, in rule order."""
    tree: dict = field(default_factory=lambda: dict(V.CATEGORY_TREE))
    keywords: dict = field(default_factory=lambda: dict(V.CATEGORY_KEYWORDS))
    aliases: tuple = ()

    @classmethod
    def from_rules(cls, rules: DataFrame) -> "Taxonomy":
        """From a (ord, main, sub, expression, equivalent) table.

        The tree is a parameter and becomes part of the plan, whatever its size.
        """
        rows = rules.orderBy("ord").collect()
        tree: dict = {}
        aliases = {}
        for r in rows:
            if r.main and r.sub:
                subs = tree.setdefault(r.main.strip(), [])
                if r.sub.strip() not in subs:
                    subs.append(r.sub.strip())
            if r.expression and r.equivalent:
                aliases[r.expression.strip()] = r.equivalent.strip()
        return cls(tree=tree or dict(V.CATEGORY_TREE), aliases=tuple(aliases.items()))

    def _lead(self, main: str, skip: tuple = ()) -> list:
        """(leading keyword, sub) pairs of a branch."""
        return [(self.keywords.get(s, (s,))[0], s)
                for s in self.tree.get(main, ()) if s not in skip]

    def _words(self, main: str) -> list:
        """(keyword, sub) pairs of a branch, everyday subs first."""
        subs = sorted(self.tree.get(main, ()), key=lambda s: V.EVERYDAY not in s)
        return [(w, s) for s in subs for w in (
            *self.keywords.get(s, ()), *(e for e, to in self.aliases if to == s))]

    def category(self, name: Column, usage: Column, suitable: Column) -> Column:
        """``main>sub`` by name, else by usage; '' when nothing applies."""
        backpack = next((m for m in self.tree if V.BACKPACK_STEM in m), V.BACKPACK)
        travel_subs = self.tree.get(V.TRAVEL, ())
        duffle = V.DUFFLE if V.DUFFLE in travel_subs or not travel_subs else travel_subs[0]
        lead = {V.ACCESSORY: self._lead(V.ACCESSORY), V.TRAVEL: self._lead(V.TRAVEL, (V.DUFFLE,))}

        def by_lead(text, main):
            sub = first_keyword(text, lead[main])
            return F.when(sub.isNotNull(), F.concat(F.lit(main + ">"), sub))

        def by_words(main):
            words = self._words(main)
            sub = F.coalesce(*[first_keyword(t, words) for t in (name, usage, suitable)])
            return F.concat_ws(">", F.lit(main), sub)

        return F.coalesce(
            by_lead(name, V.ACCESSORY), by_lead(name, V.TRAVEL),
            F.when(name.contains(V.DUFFLE), F.lit(f"{V.TRAVEL}>{duffle}")),
            F.when(name.contains(V.BACKPACK_STEM), by_words(backpack)),
            F.when(name.contains(V.WOMEN), by_words(V.WOMEN)),
            F.when(name.contains(V.MEN), by_words(V.MEN)),
            by_lead(usage, V.ACCESSORY), by_lead(usage, V.TRAVEL), F.lit(""))


def categorize(df: DataFrame, taxonomy: Taxonomy = Taxonomy(), name: str = "name",
               usage: str = "usage", suitable: str = "suitable_for",
               sale: tuple = ("sale_price", "sale_after")) -> DataFrame:
    """Category, discount tag and the name with 'duffle' spelled one way."""
    def cell(c):
        return render_text(nullify_blank(c)) if c in df.columns else F.lit("")

    fixed = df.withColumn(name, F.replace(F.col(name), F.lit(V.DUFFLE_BAG), F.lit(V.DUFFLE)))
    # Bound once: every keyword looks at them.
    texts = F.struct(render_text(name).alias("name"), cell(usage).alias("usage"), cell(suitable).alias("suitable"))
    old_tag = F.col("sale_tag") if "sale_tag" in df.columns else F.lit("")
    on_sale = has_discount(*[c for c in sale if c in df.columns])
    return (fixed
            .withColumn("category", let(texts, lambda t: taxonomy.category(t["name"], t["usage"], t["suitable"])))
            .withColumn("sale_tag", F.when(on_sale, V.DISCOUNT_TAG).otherwise(old_tag)))
