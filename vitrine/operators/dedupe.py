"""Keep-first, upsert and resume operators over explicitly ordered rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from vitrine.operators.scale import first_by_key, last_by_key


def keep_first(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    return first_by_key(df, key, order)


def keep_last(df: DataFrame, key: str, order: str = "ord") -> DataFrame:
    return last_by_key(df, key, order)


def upsert(old: DataFrame, new: DataFrame, key: str, order: str = "ord") -> DataFrame:
    """Union where the newer row of a key replaces the older one whole."""
    both = (old.withColumn("__new", F.lit(0))
            .unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True))
    return last_by_key(both, key, ["__new", order]).drop("__new")


def unprocessed(df: DataFrame, ledger: DataFrame, key: str) -> DataFrame:
    """Input rows whose key the ledger does not hold yet."""
    return df.join(ledger.select(key).distinct(), key, "left_anti")


def split_retry(results: DataFrame, failed: str = "failed", hard: str = "hard") -> DataFrame:
    """Tag every reprocessed row: done, to be retried, or given up."""
    return results.withColumn("outcome", F.when(~F.col(failed), "done")
                              .when(F.col(hard), "hard_failure").otherwise("retry"))
