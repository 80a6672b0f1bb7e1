"""Incremental ingest with Structured Streaming.

A micro-batch becomes one Parquet partition, ``batch=<id>``, of the result
table: a replayed batch overwrites its own partition and nothing else, and
readers take the latest row per key.  Whatever the size of the table, a batch
only writes its own rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from vitrine import vocab as V
from vitrine.operators.history import cap_history
from vitrine.operators.scale import last_by_key, previous_within
from vitrine.operators.tracking import tracked_percent


#: Partitions of a stream's state by a hash of the key.
STATE_BUCKETS = 32
#: Runs in which a row that fails is tried at most.
ATTEMPTS = 3


def write_batch(df: DataFrame, path: str, batch_id: int, *by: str) -> None:
    """The rows of one batch as its partition of the table at ``path``."""
    (df.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch", *by).parquet(path))


def read_latest(spark: SparkSession, path: str, keys, order) -> DataFrame:
    return last_by_key(spark.read.parquet(f"{path}/rows").drop("batch"), keys, order)


def file_stream(spark: SparkSession, path: str, schema, fmt: str = "parquet",
                files_per_batch: int = 1000) -> DataFrame:
    """The files of a folder, or one file, as a stream.

    A path without a wildcard is written as a pattern of itself: a stream
    takes a single file only by a pattern, and a folder by either.
    """
    bare = path.rstrip("/")
    if not any(c in bare for c in "*?[{"):
        bare = f"{bare[:-1]}[{bare[-1]}]"
    return (spark.readStream.schema(schema).format(fmt)
            .option("maxFilesPerTrigger", files_per_batch).load(bare))


def run_available(stream: DataFrame, handle: Callable[[DataFrame, int], None],
                  checkpoint: str) -> StreamingQuery:
    """Everything there is now, then stop; progress is kept for the next run."""
    return (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
            .trigger(availableNow=True).start())


def upsert_stream(stream: DataFrame, path: str, keys, order, checkpoint: str) -> StreamingQuery:
    """Latest row per key; each batch is reduced to its own latest rows first."""
    def handle(batch: DataFrame, batch_id: int) -> None:
        write_batch(last_by_key(batch, keys, order), f"{path}/rows", batch_id)
    return run_available(stream, handle, checkpoint)


def bucket_of(key: str) -> Column:
    """Partition of the state that a key's rows lie in."""
    return F.pmod(F.xxhash64(key), F.lit(STATE_BUCKETS)).cast("int")


def earlier_state(state: DataFrame, batch: DataFrame, key: str, batch_id: int) -> DataFrame:
    """State of earlier batches, from the buckets of a batch's keys alone.

    At most ``STATE_BUCKETS`` numbers come to the driver, so that the scan is
    pruned before it is planned.
    """
    mine = sorted(r.b for r in batch.select(bucket_of(key).alias("b")).distinct().collect())
    return state.filter((F.col("batch") < batch_id) & F.col("bucket").isin(mine))


def price_step_rows(batch: DataFrame, state: DataFrame | None, key: str, price: str,
                    order: list[str], slice_by: Column) -> DataFrame:
    """Changes inside a batch, the first row of a key measured against the state."""
    rows = batch.select(key, price, *order).withColumn("__old", F.lit(False))
    if state is not None:
        rows = rows.unionByName(state.select(key, price, *order).withColumn("__old", F.lit(True)))
    seen = previous_within(rows, [key], order, slice_by, {price: "prev_price"})
    return (seen.filter(~F.col("__old") & F.col("prev_price").isNotNull()
                        & (F.col("prev_price") != F.col(price)))
            .withColumn("delta", F.col(price) - F.col("prev_price"))
            .withColumn("percent", tracked_percent(F.col("prev_price"), F.col(price)))
            .drop("__old"))


def price_history_stream(stream: DataFrame, path: str, key: str, price: str, order: list[str],
                         slice_by: Column, checkpoint: str,
                         rows: int = V.HISTORY_ROWS_PER_KEY) -> StreamingQuery:
    """Append every price change, at most ``rows`` of a key per batch.

    Batches must arrive in time order.  A batch meets the latest earlier row
    of its own keys only, and rows of earlier batches only, so a replayed
    batch sees what it saw the first time.  State lies in partitions by a hash
    of the key; a batch reads those its own keys fall in.
    """
    columns = list(dict.fromkeys([key, price, *order]))

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        latest = last_by_key(batch.select(*columns), key, order).withColumn("bucket", bucket_of(key))
        empty = latest.limit(0).withColumn("batch", F.lit(0))
        # An empty table to begin with; where it is there, nothing is done.
        empty.write.mode("ignore").partitionBy("batch", "bucket").parquet(f"{path}/state")
        before = earlier_state(spark.read.schema(empty.schema).parquet(f"{path}/state"), batch, key, batch_id)
        state = last_by_key(before.select(*columns).join(batch.select(key).distinct(), key, "left_semi"), key, order)
        steps = price_step_rows(batch, state, key, price, order, slice_by)
        write_batch(cap_history(steps, rows, key, order[0], tuple(order[1:])), f"{path}/history", batch_id)
        write_batch(latest, f"{path}/state", batch_id, "bucket")
    return run_available(stream, handle, checkpoint)


def read_history(spark: SparkSession, path: str, key: str, order: list[str],
                 rows: int = V.HISTORY_ROWS_PER_KEY) -> DataFrame:
    seen = spark.read.parquet(f"{path}/history").drop("batch")
    return cap_history(seen, rows, key, order[0], tuple(order[1:]))


def retry_stream(stream: DataFrame, process: Callable[[DataFrame], DataFrame], path: str,
                 checkpoint: str, limit: int = ATTEMPTS) -> StreamingQuery:
    """One run over what is new and over what earlier runs left to be retried.

    ``process`` gets rows with their ``attempt`` (from 1) and adds a boolean
    ``failed`` and a boolean ``hard``.  A row goes to one outcome per attempt:
    done, hard_failure, retry, or given_up where its last attempt has failed.
    The run's batches see new files and the retry rows of earlier runs, each
    once; what they put off themselves is left to the next run.  A fresh start
    takes another path and checkpoint, the same ones resume.
    """
    from vitrine.operators.dedupe import split_retry
    spark = stream.sparkSession
    shape = stream.withColumn("attempt", F.lit(1)).schema
    # A replayed batch writes its partition anew; the files it replaces may have been listed before.
    again = (spark.readStream.schema(shape).format("parquet").option("ignoreMissingFiles", True)
             .load(f"{path}/batch=*/outcome=[r]etry"))
    both = stream.withColumn("attempt", F.lit(1)).unionByName(again.withColumn("attempt", F.col("attempt") + 1))

    def handle(batch: DataFrame, batch_id: int) -> None:
        tried = split_retry(process(batch))
        out_of_turns = (F.col("outcome") == "retry") & (F.col("attempt") >= limit)
        write_batch(tried.withColumn("outcome", F.when(out_of_turns, "given_up").otherwise(F.col("outcome"))),
                    path, batch_id, "outcome")
    return run_available(both, handle, checkpoint)


def read_outcomes(spark: SparkSession, path: str, key) -> DataFrame:
    """Every row once, with the outcome of its last attempt."""
    return last_by_key(spark.read.parquet(path), key, ["attempt", "batch"]).drop("batch")


def read_retries(spark: SparkSession, path: str, key) -> DataFrame:
    """Rows that the next run will try again."""
    return read_outcomes(spark, path, key).filter("outcome = 'retry'")


def read_outcome(spark: SparkSession, path: str, outcome: str) -> DataFrame:
    return spark.read.parquet(path).filter(F.col("outcome") == outcome).drop("batch")
