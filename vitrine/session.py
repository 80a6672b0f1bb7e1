"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    # Call sites on every Column make building large plans several times slower.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    "spark.sql.parquet.filterPushdown": "true",
}


def local_session(app: str = "vitrine", cores: str = "*", memory: str = "8g",
                  shuffle_partitions: int = 8) -> SparkSession:
    """A single-machine session for tests and the bench.

    On a cluster the submitter owns the session; nothing in this package sets
    a master, a partition count or a memory size there.
    """
    builder = SparkSession.builder.master(f"local[{cores}]").appName(app)
    for key, value in DEFAULTS.items():
        builder = builder.config(key, value)
    return (builder
            .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
            .config("spark.driver.memory", memory)
            .config("spark.ui.showConsoleProgress", "false")
            .getOrCreate())


def share_package(spark: SparkSession) -> None:
    """Lets Python workers import this package from where the driver did, unless told otherwise."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[1]))


def shared_folder(spark: SparkSession) -> str:
    """Folder every executor can reach, as the cluster names it.

    A machine-local folder is only made up when nothing is configured and the
    session itself runs on one machine.
    """
    named = (spark.conf.get("spark.checkpoint.dir", None)
             or spark.sparkContext.getCheckpointDir())
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    spark.sparkContext.setCheckpointDir(made)
    return made


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably, so a lost executor re-reads files."""
    spark = df.sparkSession
    folder = shared_folder(spark)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_dropped(spark: SparkSession):
    """Inside, shuffle files go when their query ends, not when the driver next collects garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def stored(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder; its readers take only the columns they need."""
    path = f"{shared_folder(df.sparkSession).rstrip('/')}/vitrine-stored-{uuid.uuid4().hex}"
    with shuffles_dropped(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
