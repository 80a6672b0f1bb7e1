"""Quality gates, table comparison and the run ledger."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from vitrine.functions.text import is_blank
from vitrine.operators.scale import last_by_key


class GateFailed(RuntimeError):
    """An output did not pass its gates and must not be published."""


# ---- tables against each other --------------------------------------------------

def schema_difference(a: DataFrame, b: DataFrame) -> list[str]:
    left, right = set(a.columns), set(b.columns)
    return ([f"- {c}" for c in a.columns if c not in right]
            + [f"+ {c}" for c in b.columns if c not in left])


#: Buckets by a hash of the row that two tables are first compared in.
DIGEST_BUCKETS = 1024


def _bucket(names) -> Column:
    return F.pmod(F.xxhash64(*names), F.lit(DIGEST_BUCKETS)).cast("int")


def differing_buckets(a: DataFrame, b: DataFrame, names: list[str]) -> list[int]:
    """Buckets whose rows are not the same multiset in both tables.

    A bucket's digest does not depend on the order of rows: their number and
    the sums of four 32-bit hashes of them, left ones counted up and right ones
    down.  A task sends one row per bucket, and at most ``DIGEST_BUCKETS``
    numbers come to the driver.
    """
    def halves(h: Column) -> list[Column]:
        return [F.shiftrightunsigned(h, 32), h.bitwiseAND(F.lit((1 << 32) - 1))]
    parts = halves(F.xxhash64(*names)) + halves(F.xxhash64(F.lit(1), *names))

    def side(df: DataFrame, sign: int) -> DataFrame:
        return df.select(_bucket(names).alias("bucket"), F.lit(sign).cast("bigint").alias("n"),
                         *[(p * sign).alias(f"h{i}") for i, p in enumerate(parts)])
    columns = ["n", *[f"h{i}" for i in range(len(parts))]]
    sums = side(a, 1).unionAll(side(b, -1)).groupBy("bucket").agg(
        *[F.sum(F.col(c).cast("decimal(20,0)")).alias(c) for c in columns])
    return sorted(r.bucket for r in sums.filter(" or ".join(f"{c} <> 0" for c in columns)).select("bucket").collect())


def table_difference(a: DataFrame, b: DataFrame, columns=None) -> DataFrame:
    """Rows (as a multiset over ``columns``) that only one table has.

    Digests tell first in which buckets the tables differ; only their rows are
    shuffled.  Counting both sides in one grouped pass lets the partial
    aggregation fold repeated rows before that, and a missing repetition still
    shows.
    """
    names = list(columns or [c for c in a.columns if c in b.columns])
    a, b = a.select(*names), b.select(*names)
    odd = differing_buckets(a, b, names)
    if len(odd) < DIGEST_BUCKETS:
        a, b = (df.filter(_bucket(names).isin(odd)) for df in (a, b))
    both = a.withColumn("__n", F.lit(1)).unionAll(b.withColumn("__n", F.lit(-1)))
    return (both.groupBy(*names).agg(F.sum("__n").alias("surplus")).filter("surplus <> 0")
            .withColumn("side", F.when(F.col("surplus") > 0, "only_left").otherwise("only_right"))
            .withColumn("surplus", F.abs("surplus")))


def compare_tables(a: DataFrame, b: DataFrame, key: str = "sku") -> DataFrame:
    """Row counts, key differences and whether both tables agree."""
    counts = (a.select(F.lit(1).alias("l"), F.lit(0).alias("r"))
              .unionAll(b.select(F.lit(0).alias("l"), F.lit(1).alias("r")))
              .agg(F.coalesce(F.sum("l"), F.lit(0)).alias("left_rows"),
                   F.coalesce(F.sum("r"), F.lit(0)).alias("right_rows")))
    keys = table_difference(a, b, [key]).agg(
        F.coalesce(F.sum(F.when(F.col("side") == "only_left", F.col("surplus"))), F.lit(0))
        .alias("only_left"),
        F.coalesce(F.sum(F.when(F.col("side") == "only_right", F.col("surplus"))), F.lit(0))
        .alias("only_right"))
    odd = len(schema_difference(a, b))
    return counts.join(keys, F.lit(True)).withColumn("schema_differences", F.lit(odd)).withColumn(
        "equal", (F.col("left_rows") == F.col("right_rows")) & (F.col("only_left") == 0)
        & (F.col("only_right") == 0) & F.lit(odd == 0))


# ---- gates ---------------------------------------------------------------------

def gate_row(df: DataFrame, required: tuple = (), key: str = "sku") -> DataFrame:
    """One pass over a table: is it there, shaped right and keyed throughout."""
    missing = [c for c in required if c not in df.columns]
    blank = F.count_if(is_blank(key)) if key in df.columns else F.count("*")
    return df.agg(F.count("*").alias("rows"), blank.alias("blank_keys")).select(
        "rows", "blank_keys", F.lit(", ".join(missing)).alias("missing_columns"),
        ((F.col("rows") > 0) & (F.col("blank_keys") == 0) & F.lit(not missing)).alias("passed"))


def coverage_row(expected: DataFrame, available: DataFrame, key: str = "sku") -> DataFrame:
    """Expected keys that are available; no coverage at all fails."""
    have = available.select(F.col(key).alias("__k")).distinct()
    want = expected.select(key).filter(F.col(key).isNotNull()).distinct()
    return (want.join(have, F.col(key) == F.col("__k"), "left")
            .agg(F.count("*").alias("expected"), F.count("__k").alias("covered"))
            .withColumn("percent", F.when(F.col("expected") > 0,
                                          F.col("covered") / F.col("expected") * 100))
            .withColumn("passed", (F.col("expected") == 0) | (F.col("covered") > 0)))


def check(gates: DataFrame) -> None:
    """Raise when any gate row did not pass; call before publishing."""
    bad = gates.filter("not passed").limit(20).collect()
    if bad:
        raise GateFailed("; ".join(str(r.asDict()) for r in bad))


def all_gates(**gates: DataFrame) -> DataFrame:
    parts = [g.select(F.lit(name).alias("gate"), "passed") for name, g in gates.items()]
    return reduce(DataFrame.unionByName, parts)


# ---- run ledger -----------------------------------------------------------------

def latest_steps(events: DataFrame, tie: tuple = ()) -> DataFrame:
    """Latest status of every step of every run (run_id, step, status, at)."""
    return last_by_key(events, ["run_id", "step"], ["at", *tie])


def latest_info(events: DataFrame, tie: tuple = ()) -> DataFrame:
    """Per run and step, the newest event that carries info; events without any do not count."""
    return last_by_key(events.filter(F.col("info").isNotNull()), ["run_id", "step"], ["at", *tie])


def run_status(events: DataFrame, tie: tuple = (), failed: Column | None = None) -> DataFrame:
    """One row per run: its state, number of steps and newest event.

    Only the newest event of a step matters, and one bad step outweighs the
    mark of a finished run.  Events are cut to one per step before runs are
    grouped, however many there are.
    """
    latest = latest_steps(events, tie)
    bad = F.col("status").isin("failed", "error") if failed is None else failed
    done = F.col("status") == "complete"
    return latest.groupBy("run_id").agg(
        F.when(F.bool_or(bad), "failed").when(F.bool_or(done), "complete").otherwise("running")
        .alias("status"),
        F.count("*").alias("steps"), F.max("at").alias("updated_at"))


def current_outputs(recorded: DataFrame, files: DataFrame, run_id: str) -> DataFrame:
    """Adds ``is_current`` to recorded outputs (step, path, size, mtime, run_id).

    True for rows of ``run_id`` whose path is among ``files`` (path, size,
    mtime) with some content and, where they were recorded, equal size and time.
    """
    disk = files.select(F.col("path").alias("__p"), F.col("size").alias("__size"),
                        F.col("mtime").alias("__mtime"))
    same = ((F.col("run_id") == run_id) & (F.col("__size") > 0)
            & F.coalesce(F.col("__size") == F.col("size"), F.lit(True))
            & F.coalesce(F.col("__mtime") == F.col("mtime"), F.lit(True)))
    return (recorded.join(disk, F.col("path") == F.col("__p"), "left")
            .withColumn("is_current", F.coalesce(same & F.col("__p").isNotNull(), F.lit(False)))
            .drop("__p", "__size", "__mtime"))


def failure_report(failures: DataFrame, reason: str = "reason") -> DataFrame:
    """Failures per error type, the text before the first colon."""
    kind = F.trim(F.split_part(F.col(reason), F.lit(":"), F.lit(1)))
    return failures.groupBy(kind.alias("error_type")).agg(F.count("*").alias("failures"))


def failure_rate(failures: DataFrame, succeeded: DataFrame) -> DataFrame:
    bad = failures.agg(F.count("*").alias("failed"))
    good = succeeded.agg(F.count("*").alias("succeeded"))
    return bad.join(good, F.lit(True)).withColumn(
        "failure_rate", F.col("failed") / F.greatest(F.col("failed") + F.col("succeeded"), F.lit(1)) * 100)


def state_with_defaults(states: DataFrame, column: str, schema: str, defaults: dict) -> DataFrame:
    """JSON state parsed with missing keys filled from ``defaults``."""
    parsed = F.from_json(column, schema)
    fields = [F.coalesce(parsed[k], v if isinstance(v, Column) else F.lit(v)).alias(k)
              for k, v in defaults.items()]
    return states.withColumn(column, F.struct(*fields))
