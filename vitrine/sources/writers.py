"""Writers.  A 'sheet' of a report is a folder of its own."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from vitrine import vocab as V
from vitrine.functions.dates import older_than
from vitrine.operators.columns import rendered
from vitrine.operators.dictionary import dictionary_summary
from vitrine.operators.history import append_history

BOM = "\ufeff"


def write_csv(df: DataFrame, path: str, bom: bool = True, mode: str = "overwrite",
              compression: str | None = None) -> None:
    """All-text CSV with header, '' for NULL; spreadsheets need the mark."""
    out = rendered(df)
    if bom and out.columns:
        out = out.withColumnRenamed(out.columns[0], BOM + out.columns[0])
    (out.write.mode(mode).option("header", True).option("emptyValue", "").option("nullValue", "")
     .option("quote", '"').option("escape", '"').csv(path, compression=compression))


def write_sheets(sheets: dict[str, DataFrame], path: str, compression: str | None = None) -> None:
    for name, df in sheets.items():
        write_csv(df, f"{path}/{name}", compression=compression)


def write_lines(df: DataFrame, column: str, order, path: str, compression: str | None = None) -> None:
    """Text lines in order: sorted in range partitions, so files concatenate."""
    df.orderBy(*order).select(column).write.mode("overwrite").text(path, compression=compression)


def write_manifests(new: DataFrame, updated: DataFrame, images: DataFrame, path: str,
                    compression: str | None = None) -> None:
    """The three change manifests; an empty one still has its header."""
    write_sheets({"new_products_list": new, "updated_products_list": updated,
                  "image_subset_list": images}, path, compression)


def write_delete_list(keys: DataFrame, path: str, compression: str | None = None) -> None:
    write_lines(keys, "sku", ["part", "k0", "k1", "k2"], path, compression)


def write_tracking_report(current: DataFrame, removed: DataFrame, previous: DataFrame | None,
                          path: str) -> None:
    sheets = {"current": current, "new": current.filter("status = 'new'"),
              "changes": current.filter("status = 'price_changed'"), "removed": removed}
    if previous is not None:
        sheets["previous"] = previous
    write_sheets(sheets, path)


def write_partition(df: DataFrame, path: str, column: str, value: str, overwrite: bool = True) -> bool:
    """One dated partition; without ``overwrite`` a finished one is left alone."""
    target = f"{path}/{column}={value}"
    if not overwrite and _finished(df.sparkSession, target):
        return False
    df.drop(column).write.mode("overwrite").parquet(target)
    return True


def _path(spark: SparkSession, path: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)


def _finished(spark: SparkSession, path: str) -> bool:
    marker = _path(spark, path + "/_SUCCESS")
    return marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(marker)


def _folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder; none if there is no folder yet."""
    folder = _path(spark, path)
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


def write_daily_snapshot(df: DataFrame, path: str, date: str) -> bool:
    """The first snapshot of a day is kept."""
    return write_partition(df, path, "snapshot_date", date, overwrite=False)


def write_dated(df: DataFrame, path: str, date: str) -> None:
    """The run's dated copy under ``archive``, and the same as ``latest``."""
    write_partition(df, f"{path}/archive", "run_date", date)
    df.write.mode("overwrite").parquet(f"{path}/latest")


def drop_old_snapshots(spark: SparkSession, path: str, run_date: str,
                       days: int = V.SNAPSHOT_DAYS) -> list[str]:
    """Remove the partitions older than ``days``; returns their dates.

    The dates come from folder names, one short string per day on disk.
    """
    fs = _path(spark, path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    dates = [n.split("=", 1)[1] for n in _folders(spark, path) if n.startswith("snapshot_date=")]
    if not dates:
        return []
    aged = (spark.createDataFrame([(d,) for d in dates], "d string")
            .filter(older_than(F.to_date("d"), F.to_date(F.lit(run_date)), days)).collect())
    for row in aged:
        fs.delete(_path(spark, f"{path}/snapshot_date={row.d}"), True)
    return sorted(r.d for r in aged)


def save_history(spark: SparkSession, path: str, new: DataFrame, version: int,
                 rows: int = V.HISTORY_ROWS_PER_KEY) -> str:
    """Append and cap; each version is a new folder so readers never see half.

    The newest finished version before ``version`` is taken up, whatever its
    number; with none there yet the history begins.
    """
    earlier = [int(n.split("=", 1)[1]) for n in _folders(spark, path) if n.startswith("version=")]
    done = [v for v in earlier if v < version and _finished(spark, f"{path}/version={v}")]
    history = spark.read.parquet(f"{path}/version={max(done)}") if done else new.limit(0)
    target = f"{path}/version={version}"
    append_history(history, new, rows).write.mode("overwrite").parquet(target)
    return target


def write_import_catalog(catalog: DataFrame, path: str, new: DataFrame | None = None,
                         update: DataFrame | None = None) -> None:
    parts = {"full": catalog, "new": new, "update": update}
    write_sheets({k: v for k, v in parts.items() if v is not None}, path)


def write_manifest(document: DataFrame, copy_log: DataFrame, *paths: str) -> None:
    """The manifest to every place that keeps one, the copy log beside it."""
    for path in paths:
        document.write.mode("overwrite").text(f"{path}/import_manifest")
        copy_log.write.mode("overwrite").json(f"{path}/copy_log")


def write_download_report(df: DataFrame, path: str) -> None:
    """All rows, failed downloads and pages without images."""
    status = F.col("status")
    write_sheets({"all": df, "failed": df.filter(status.startswith("Incomplete")
                                                 | status.startswith("Failed")),
                  "no_images": df.filter(status == "No Images Found")}, path)


def write_products_and_failures(products: DataFrame, failures: DataFrame, path: str,
                                earlier: DataFrame | None = None) -> None:
    """Products and failures; a retry keeps the failures it did not retry."""
    if earlier is not None:
        kept = earlier.join(products.select("url").unionByName(failures.select("url")).distinct(),
                            "url", "left_anti")
        failures = failures.unionByName(kept, allowMissingColumns=True)
    write_sheets({"products": products, "failed": failures}, path)


def write_dictionary_summary(entries: DataFrame, unknown: DataFrame, path: str) -> None:
    write_lines(dictionary_summary(entries, unknown), "value", ["section", "key"], path)
