"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS choose data and
cores.  Every query is written to a sink that takes all rows and columns.
"""

from __future__ import annotations

import json
import os
import time

from vitrine.session import local_session
from vitrine.showcase import all_queries

HEADLINE = (
    "diff_summary", "diff_price", "update_manifest", "image_subset", "track_status",
    "price_lag_changes", "upsert_rows", "history_cap10", "history_stats", "bracket_pricing",
    "categorize", "standard_colors", "standardize_table", "translate_cells", "text_slugs",
    "jalali_dates", "rename_plan", "image_mapping", "export_parents", "folder_pick",
    "page_fields", "page_links", "table_compare", "run_ledger", "apply_manifest", "stream_upsert",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("vitrine-bench", cores, os.environ.get("BENCH_MEMORY", "12g"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()
    wanted = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or HEADLINE
    registered = all_queries()
    seconds = {}
    for name in wanted:
        start = time.perf_counter()
        registered[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(seconds.values()), 3),
                      "unit": "sec", "queries": seconds, "sf": folder.rsplit("sf", 1)[-1]}))
    spark.stop()


if __name__ == "__main__":
    main()
