"""Bracket pricing: the first closed range that holds a price decides."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from vitrine.functions.prices import parse_price, round_to_thousand
from vitrine.functions.text import nullify_blank
from vitrine.operators.scale import local_frame, number_all, quantile_slices, rows_if_small
from vitrine.session import cut_lineage

RULE_SCHEMA = ("rule_ord int, from_price double, to_price double, "
               "increase_percent double, discount_percent double")


def rules_frame(spark: SparkSession, rules) -> DataFrame:
    names = ("from_price", "to_price", "increase_percent", "discount_percent")
    columns = {n: [float(r[i]) for r in rules] for i, n in enumerate(names)}
    return local_frame(spark, {"rule_ord": list(range(len(rules))), **columns}, RULE_SCHEMA)


# A longer CASE makes methods the JVM no longer compiles.
_CASE_RULES = 12


def bracket_by_case(price: Column, rows) -> Column:
    """Small rule table inside the expression; the first match wins."""
    rows = sorted(rows, key=lambda r: r.rule_ord)
    if len(rows) > _CASE_RULES:
        names = ("rule_ord", "from_price", "to_price", "increase_percent", "discount_percent")
        table = F.array(*[F.struct(*[F.lit(r[n]).alias(n) for n in names]) for r in rows])
        hit = F.get(F.filter(table, lambda r: price.between(r["from_price"], r["to_price"])), F.lit(0))
        return F.when(hit.isNotNull(), F.struct(*[hit[n].alias(n) for n in (
            "rule_ord", "increase_percent", "discount_percent")]))
    out = None
    for r in rows:
        hit = price.between(F.lit(r.from_price), F.lit(r.to_price))
        rule = F.struct(F.lit(r.rule_ord).alias("rule_ord"),
                        F.lit(r.increase_percent).alias("increase_percent"),
                        F.lit(r.discount_percent).alias("discount_percent"))
        out = F.when(hit, rule) if out is None else out.when(hit, rule)
    return out


def _levels(pieces: int) -> int:
    return max(pieces, 1).bit_length() + 1


def _tree_nodes(low: Column, high: Column, levels: int) -> Column:
    """(level, node) of the fewest aligned ranges of 2**level pieces that make up low..high."""
    start = F.struct(low.cast("bigint").alias("lo"), high.cast("bigint").alias("hi"),
                     F.array().cast("array<struct<level:int,node:bigint>>").alias("out"))

    def step(at, level):
        some = at["lo"] <= at["hi"]
        left, right = some & (at["lo"] % 2 == 1), some & (at["hi"] % 2 == 0)
        none = F.array().cast("array<struct<level:int,node:bigint>>")

        def one(node):
            return F.array(F.struct(level.cast("int").alias("level"), node.alias("node")))
        out = F.concat(at["out"], F.when(left, one(at["lo"])).otherwise(none),
                       F.when(right & ~(left & (at["lo"] == at["hi"])), one(at["hi"])).otherwise(none))
        # What is used up stays used up: halving an empty run could fill it again.
        lo, hi = at["lo"] + F.when(left, 1).otherwise(0), at["hi"] - F.when(right, 1).otherwise(0)
        return F.struct(F.when(lo <= hi, F.shiftright(lo, 1)).otherwise(1).cast("bigint").alias("lo"),
                        F.when(lo <= hi, F.shiftright(hi, 1)).otherwise(0).cast("bigint").alias("hi"), out.alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(levels)), start, step, lambda at: at["out"])


def disjoint_brackets(rules: DataFrame) -> DataFrame:
    """Overlapping rules as disjoint pieces, each with its first rule.

    The rules' end points are sorted and numbered; piece 2i is the i-th point,
    piece 2i + 1 what lies open between it and the next.  A rule covers a run
    of pieces, that is at most two aligned ranges per power of two; a piece
    asks the aligned ranges that hold it.  So every rule and every piece makes
    a number of rows that is logarithmic in the number of end points, however
    much rules overlap.  Returns (low, high, point, bracket).
    """
    rules = rules.filter("from_price <= to_price")
    ends = rules.select(F.explode(F.array("from_price", "to_price")).alias("at")).distinct()
    ends = cut_lineage(number_all(ends, "at", quantile_slices(ends, "at"), "no").withColumn("i", F.col("no") - 1))
    pieces = 2 * ends.count()
    levels = _levels(pieces)
    first, last = (ends.select(F.col("at").alias(f"{n}_price"), F.col("i").alias(f"{n}_i")) for n in ("from", "to"))
    rule = F.struct("rule_ord", "increase_percent", "discount_percent")
    covers = rules.join(first, "from_price").join(last, "to_price")
    nodes = (covers.withColumn("n", F.explode(_tree_nodes(F.col("from_i") * 2, F.col("to_i") * 2, levels)))
             .groupBy("n.level", "n.node").agg(F.min_by(rule, "rule_ord").alias("bracket")))
    above = ends.select(F.col("i") - 1, F.col("at").alias("high")).toDF("i", "high")
    all_pieces = ends.select((F.col("i") * 2).alias("piece"), F.col("at").alias("low"), F.col("at").alias("high"), F.lit(True).alias("point")).union(
        ends.join(above, "i").select(F.col("i") * 2 + 1, F.col("at"), F.col("high"), F.lit(False)))
    asked = all_pieces.select("piece", F.explode(F.sequence(F.lit(0), F.lit(levels))).alias("level")).withColumn(
        "node", F.expr("shiftright(piece, level)"))
    best = asked.join(nodes, ["level", "node"]).groupBy("piece").agg(F.min_by("bracket", "bracket.rule_ord").alias("bracket"))
    return all_pieces.join(best, "piece").select("low", "high", "point", "bracket")


def bracket_by_sweep(df: DataFrame, price: str, rules: DataFrame) -> DataFrame:
    """Large rule table: every distinct price meets the one disjoint piece that holds it.

    A point is met by equality.  An open piece lies in at most three cells of
    the least power of two that is not below its width; a price visits its own
    cell once per power in use, and as pieces are disjoint, few lie in a cell.
    """
    pieces = cut_lineage(disjoint_brackets(rules))
    prices = df.select(F.col(price).cast("double").alias("__p")).filter("__p is not null").distinct()
    points = pieces.filter("point").select(F.col("low").alias("__p"), F.col("bracket").alias("at_point"))
    spans = (pieces.filter("not point").withColumn("level", F.ceil(F.log2(F.col("high") - F.col("low"))).cast("int"))
             .withColumn("cell_size", F.pow(F.lit(2.0), F.col("level"))))
    cells = spans.withColumn("cell", F.explode(F.sequence(F.floor(F.col("low") / F.col("cell_size")),
                                                          F.floor(F.col("high") / F.col("cell_size")))))
    # One row per power of two in use.
    levels = [r.level for r in spans.select("level").distinct().collect()]
    visits = (prices.withColumn("level", F.explode(F.array(*[F.lit(x) for x in levels]).cast("array<int>")))
              .withColumn("cell", F.floor(F.col("__p") / F.pow(F.lit(2.0), F.col("level")))))
    inside = (visits.alias("v").join(cells.alias("c"), (F.col("v.level") == F.col("c.level")) & (F.col("v.cell") == F.col("c.cell"))
                                     & (F.col("__p") > F.col("low")) & (F.col("__p") < F.col("high")))
              .select("__p", F.col("bracket").alias("in_span")))
    found = (prices.join(points, "__p", "left").join(inside, "__p", "left")
             .select("__p", F.coalesce("at_point", "in_span").alias("bracket")).filter("bracket is not null"))
    return df.join(found, F.col(price).cast("double") == F.col("__p"), "left").drop("__p")


def with_bracket(df: DataFrame, price: str, rules: DataFrame) -> DataFrame:
    rows = rows_if_small(rules)
    if rows is None:
        return bracket_by_sweep(df, price, rules)
    if not rows:
        return df.withColumn("bracket", F.lit(None).cast(
            "struct<rule_ord:int,increase_percent:double,discount_percent:double>"))
    return df.withColumn("bracket", bracket_by_case(F.col(price), rows))


def apply_brackets(df: DataFrame, rules: DataFrame, regular: str = "regular_price",
                   sale: str = "sale_price", extra_discount: float = 0.0) -> DataFrame:
    """Raise, round and discount prices by their bracket.

    Adds the before and after prices.  A row without a positive price or
    without a bracket keeps its prices; a row without discount keeps its sale
    price.  ``clamped`` flags discounts of 100 % or more, taken as 99 %.
    """
    if sale not in df.columns:
        df = df.withColumn(sale, F.lit(None).cast("string"))
    priced = with_bracket(df.withColumn("__price", parse_price(nullify_blank(regular))),
                          "__price", rules)
    b = F.col("bracket")
    hit = (F.col("__price") > 0) & b.isNotNull()
    raised = F.when(b["increase_percent"] > 0,
                    F.col("__price") * (1 + b["increase_percent"] / 100)).otherwise(F.col("__price"))
    wanted = b["discount_percent"] + F.lit(float(extra_discount))
    discount = F.when(wanted >= 100, F.lit(99.0)).otherwise(wanted)
    new_price = round_to_thousand(raised)
    shown = round_to_thousand(new_price / (1 - discount / 100))
    old_regular, old_sale = F.col(regular).cast("string"), F.col(sale).cast("string")
    return (priced
            .withColumn("regular_before", old_regular).withColumn("sale_before", old_sale)
            .withColumn("price_updated", F.coalesce(hit, F.lit(False)))
            .withColumn("discounted", F.coalesce(hit & (discount > 0), F.lit(False)))
            .withColumn("clamped", F.coalesce(hit & (wanted >= 100), F.lit(False)))
            .withColumn(regular, F.when(F.col("discounted"), shown.cast("string"))
                        .when(F.col("price_updated"), new_price.cast("string"))
                        .otherwise(old_regular))
            .withColumn(sale, F.when(F.col("discounted"), new_price.cast("string"))
                        .otherwise(old_sale))
            .withColumn("regular_after", F.col(regular)).withColumn("sale_after", F.col(sale))
            .drop("__price", "bracket"))


