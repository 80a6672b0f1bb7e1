"""History, statistics, quality gates, run ledger and streaming."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from vitrine.functions import text as T
from vitrine.functions.prices import signed_percent
from vitrine.operators import history as H
from vitrine.operators import quality as Q
from vitrine.operators.dedupe import split_retry
from vitrine.operators.scale import number_all, quantile_slices
from vitrine.plans.prices import dashboard
from vitrine.session import shared_folder
from vitrine.showcase import shop as S
from vitrine.sources.readers import latest_by_stamp
from vitrine.streaming import ingest as G


def _events(spark, d):
    return S.table(spark, d, "events").withColumn("cents", F.round(F.col("value") * 100).cast("bigint"))


def _records(spark, d):
    """Events as price observations of their user, one history row per change."""
    kinds = {"view": "increase", "purchase": "decrease", "signup": "new", "error": "removed"}
    return _events(spark, d).select(
        F.col("user_id").cast("string").alias("sku"), "event_id", F.col("ts").alias("timestamp"),
        F.to_date("ts").alias("change_date"), F.col("cents").alias("new_price"),
        F.coalesce(S.case("event_type", kinds), F.lit("increase")).alias("change_type"))


def history_cap10(spark, d):
    return H.cap_history(_records(spark, d), 10, tie=("event_id",)).select("sku", "event_id", "new_price")


def history_stats(spark, d):
    return H.history_statistics(_records(spark, d))


def product_history(spark, d):
    """History of the product that changed most often."""
    rows = _records(spark, d)
    busiest = rows.groupBy("sku").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "sku").limit(1).first()
    return H.product_history(rows, busiest.sku).select("sku", "event_id", "new_price", "change_type")


def history_records(spark, d):
    """History records of one price pair per order line."""
    changes = S.table(spark, d, "lineitem").select(
        F.concat_ws("/", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("sku"),
        F.col("l_returnflag").alias("product_name"),
        F.when(F.col("l_linenumber") > 1, F.col("l_quantity").cast("bigint") * 100).alias("old_price"),
        F.when(F.col("l_linenumber") < 7, F.floor(F.col("l_extendedprice") / 10).cast("bigint")).alias("new_price"))
    out = H.history_rows(changes, F.lit("2024-03-19 08:00:00").cast("timestamp"))
    return out.select("sku", "change_date", "persian_date", "old_price", "new_price", "change_amount",
                      F.round("change_percent", 6).alias("change_percent"), "change_type")


def snapshot_retention(spark, d):
    snaps = _events(spark, d).select(F.to_date("ts").alias("snapshot_date"))
    return H.expired_snapshots(snaps, F.lit("2024-02-20").cast("date"), 30)


def daily_average_7d(spark, d):
    out = H.daily_average(_events(spark, d), "ts", "cents", F.lit("2024-02-01").cast("date"))
    return out.withColumn("average", F.round("average", 4))


def dashboard_chart(spark, d):
    counts = _events(spark, d).agg(
        F.count_if(F.col("event_type") == "signup").alias("new"),
        F.count_if(F.col("event_type") == "purchase").alias("changed"))
    chart, _ = dashboard(counts, _records(spark, d), F.lit("2024-02-01").cast("date"))
    return chart


def status_breakdown(spark, d):
    """Download status of every order from its lines, and what is left to do."""
    lines = S.table(spark, d, "lineitem").groupBy("l_orderkey").agg(
        F.count_if(F.col("l_returnflag") == "R").alias("failed"), F.count("*").alias("images"))
    status = T.sum_status("failed", F.col("images") > 1)
    return (lines.withColumn("status", status)
            .groupBy("status", T.needs_work_status("status").alias("todo"),
                     T.is_complete_status("status").alias("complete"))
            .agg(F.count("*").alias("pages")))


def _failures(spark, d):
    return _events(spark, d).filter("event_type = 'error'").select(
        "event_id", F.concat(F.when(F.col("cents") % 3 == 0, "Timeout").when(F.col("cents") % 3 == 1, " NoSuchElement ")
                             .otherwise("Price not found"), F.lit(": "), "props").alias("reason"))


def failure_report(spark, d):
    return Q.failure_report(_failures(spark, d))


def failure_rate(spark, d):
    good = _events(spark, d).filter("event_type <> 'error'")
    return Q.failure_rate(_failures(spark, d), good).withColumn("failure_rate", F.round("failure_rate", 6))


def retry_outcomes(spark, d):
    rows = _events(spark, d).select("event_id", (F.col("event_type") == "error").alias("failed"),
                                    (F.col("cents") > 10000).alias("hard"))
    return split_retry(rows).groupBy("outcome").agg(F.count("*").alias("rows"))


def _ledger(spark, d):
    status = (F.when(F.col("event_type") == "error", "failed").when(F.col("event_type") == "signup", "running")
              .otherwise("done"))
    return _events(spark, d).select(
        (F.col("user_id") % 25).alias("run_id"), F.concat(F.lit("step"), F.col("user_id") % 4).alias("step"),
        status.alias("status"), F.col("ts").alias("at"), "event_id",
        F.when(F.col("event_type") == "purchase", F.col("props")).alias("info"))


def run_ledger(spark, d):
    return Q.run_status(_ledger(spark, d), ("event_id",)).select("run_id", "status", "steps")


def ledger_info(spark, d):
    return Q.latest_info(_ledger(spark, d), ("event_id",)).select("run_id", "step", "info")


def output_currency(spark, d):
    """Recorded outputs against the files that are there now."""
    recorded = S.table(spark, d, "orders").select(
        F.concat(F.lit("out/"), "o_orderkey").alias("path"), F.floor("o_totalprice").cast("bigint").alias("size"),
        F.col("o_orderdate").alias("mtime"), F.when(F.col("o_orderstatus") == "F", "A").otherwise("B").alias("run_id"))
    files = S.table(spark, d, "orders").filter("o_orderpriority <> '5-LOW'").select(
        F.concat(F.lit("out/"), "o_orderkey").alias("path"),
        (F.floor("o_totalprice").cast("bigint") + F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("size"),
        F.col("o_orderdate").alias("mtime"))
    out = Q.current_outputs(recorded, files, "A")
    return out.groupBy("run_id", "is_current").agg(F.count("*").alias("outputs"))


def table_compare(spark, d):
    """Key multisets of two item lists that differ in some lines."""
    lines = S.table(spark, d, "lineitem")
    left = lines.select(F.col("l_partkey").alias("sku"), "l_linenumber").filter("l_returnflag <> 'A'")
    right = lines.select(F.col("l_partkey").alias("sku"), "l_linenumber").filter("l_linestatus = 'F'")
    return Q.table_difference(left, right, ["sku", "l_linenumber"])


def table_compare_near(spark, d):
    """Two copies of the order lines, one dealt out anew and with a few lines changed, missing or repeated."""
    lines = S.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_shipdate")
    key = F.col("l_orderkey")
    changed = lines.filter(key % 997 != 3).withColumn("l_quantity", F.when(key % 997 == 5, F.col("l_quantity") + 1).otherwise(F.col("l_quantity")))
    return Q.table_difference(lines, changed.unionAll(lines.filter(key % 997 == 7)).repartition("l_shipdate"))


def table_compare_summary(spark, d):
    lines = S.table(spark, d, "lineitem").withColumn("sku", F.col("l_partkey"))
    return Q.compare_tables(lines.filter("l_returnflag <> 'A'"), lines.filter("l_linestatus = 'F'").drop("l_tax"))


def gates(spark, d):
    rows = S.offers(spark, d)
    ok = Q.gate_row(rows, ("sku", "name", "regular_price"))
    missing = Q.gate_row(rows.drop("name"), ("sku", "name"))
    blank = Q.gate_row(rows.withColumn("sku", F.when(F.col("status") == "OK", F.col("sku"))), ("sku",))
    cover = Q.coverage_row(S.scan(spark, d), S.catalog(spark, d))
    return (Q.all_gates(ok=ok, missing=missing, blank=blank, cover=cover)
            .join(cover.select("expected", "covered"), F.lit(True)))


def latest_dated_file(spark, d):
    names = S.table(spark, d, "orders").select(F.concat(
        F.lit("reports/x/product_details_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"),
        F.lpad((F.col("o_orderkey") % 240000).cast("string"), 6, "0"), F.lit(".csv")).alias("path"))
    return latest_by_stamp(names, r"product_details_([0-9]{8}_[0-9]{6})\.csv$")


def running_number(spark, d):
    """One sequence number over all orders by date, without one task."""
    rows = S.table(spark, d, "orders").select("o_orderkey", (F.unix_timestamp("o_orderdate") * 100000000
                                                            + F.col("o_orderkey")).alias("ord"))
    return number_all(rows, "ord", quantile_slices(rows, "ord", 32), "no").select("o_orderkey", "no")


def signed_texts(spark, d):
    rows = S.table(spark, d, "part").select("p_partkey", (F.col("p_size") - 25).cast("double").alias("x"))
    return rows.select("p_partkey", signed_percent("x", 1).alias("percent"), T.human_size(F.col("p_partkey") * 1000 + 1)
                       .alias("size"), T.retry_status(F.col("p_partkey") % 3).alias("retry"))


# ---- streaming -----------------------------------------------------------------------

def _fresh(spark, name):
    """A new folder of this run inside the folder all executors share."""
    return f"{shared_folder(spark).rstrip('/')}/vitrine-{name}-{uuid.uuid4().hex}"


def stream_upsert(spark, d):
    schema = S.table(spark, d, "events").schema
    stream = G.file_stream(spark, f"{d}/events.parquet", schema)
    out = _fresh(spark, "upsert")
    G.upsert_stream(stream, out, "user_id", ["ts", "event_id"], out + "/progress").awaitTermination()
    return G.read_latest(spark, out, "user_id", ["ts", "event_id"]).select("user_id", "event_id", "event_type")


def stream_history(spark, d):
    schema = S.table(spark, d, "events").schema
    stream = (G.file_stream(spark, f"{d}/events.parquet", schema)
              .withColumn("cents", F.round(F.col("value") * 100).cast("bigint")))
    out = _fresh(spark, "history")
    G.price_history_stream(stream, out, "user_id", "cents", ["ts", "event_id"], F.to_date("ts"),
                           out + "/progress").awaitTermination()
    return G.read_history(spark, out, "user_id", ["ts", "event_id"]).select(
        "user_id", "event_id", "cents", F.col("prev_price").alias("prev_cents"), "delta")


def stream_retry(spark, d):
    """Events as they come: failed ones are kept for a retry or given up."""
    events = S.table(spark, d, "events")
    out = _fresh(spark, "retry")
    G.retry_stream(G.file_stream(spark, f"{d}/events.parquet", events.schema), lambda df: df.withColumns({
        "failed": F.col("event_type") == "error", "hard": F.col("value") > 100}), out + "/t", out + "/progress").awaitTermination()
    return G.read_outcome(spark, out + "/t", "retry").select("event_id", "user_id")


def stream_retry_rounds(spark, d):
    """Four runs over the events: what fails is tried again, at most three times; the last run has nothing to do."""
    events = S.table(spark, d, "events")
    out, turn = _fresh(spark, "rounds"), F.col("event_id") % 10

    def process(df):
        return df.withColumns({"failed": (turn == 0) | (turn == 4) | (turn.isin(1, 2) & (F.col("attempt") <= turn)), "hard": turn == 0})
    for _ in range(4):
        G.retry_stream(G.file_stream(spark, f"{d}/events.parquet", events.schema), process, out + "/t",
                       out + "/progress").awaitTermination()
    return G.read_outcomes(spark, out + "/t", "event_id").select("event_id", "outcome", F.col("attempt").cast("int").alias("attempt"))


_KIND = "CASE event_type WHEN 'view' THEN 'increase' WHEN 'purchase' THEN 'decrease' WHEN 'signup' THEN 'new' WHEN 'error' THEN 'removed' ELSE 'increase' END"
_CENTS = "CAST(round(value * 100) AS BIGINT)"
_LATEST = """l AS (SELECT * FROM (SELECT user_id % 25 AS run_id, 'step' || (user_id % 4) AS step,
  CASE event_type WHEN 'error' THEN 'failed' WHEN 'signup' THEN 'running' ELSE 'done' END AS status,
  row_number() OVER (PARTITION BY user_id % 25, user_id % 4 ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1)"""

QUERIES = {
    "history_cap10": (history_cap10, f"""
SELECT CAST(user_id AS VARCHAR) AS sku, event_id, {_CENTS} AS new_price FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn <= 10"""),
    "history_stats": (history_stats, f"""
SELECT count(*) AS total_records, count(DISTINCT user_id) AS total_products, CAST(min(ts) AS DATE) AS first_date,
  CAST(max(ts) AS DATE) AS last_date, count(*) FILTER (k = 'increase') AS increase_rows, count(*) FILTER (k = 'decrease') AS decrease_rows,
  count(*) FILTER (k = 'new') AS new_rows, count(*) FILTER (k = 'removed') AS removed_rows FROM (SELECT *, {_KIND} AS k FROM events)"""),
    "product_history": (product_history, f"""
SELECT CAST(user_id AS VARCHAR) AS sku, event_id, {_CENTS} AS new_price, {_KIND} AS change_type FROM events
WHERE user_id = (SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, CAST(user_id AS VARCHAR) LIMIT 1)"""),
    "history_records": (history_records, """
SELECT sku, DATE '2024-03-19' AS change_date, '1402/12/29' AS persian_date, o AS old_price, n AS new_price,
  CASE WHEN o <> 0 AND n <> 0 THEN n - o ELSE n END AS change_amount,
  CASE WHEN o > 0 AND n <> 0 THEN round((n - o) / CAST(o AS DOUBLE) * 100, 6) ELSE 0 END AS change_percent,
  CASE WHEN o = 0 THEN 'new' WHEN n = 0 THEN 'removed' WHEN n > o THEN 'increase' ELSE 'decrease' END AS change_type
FROM (SELECT l_orderkey || '/' || l_linenumber || '/' || l_partkey || '/' || l_suppkey AS sku,
  CASE WHEN l_linenumber > 1 THEN CAST(l_quantity AS BIGINT) * 100 ELSE CAST(0 AS BIGINT) END AS o,
  CASE WHEN l_linenumber < 7 THEN CAST(floor(l_extendedprice / 10) AS BIGINT) ELSE CAST(0 AS BIGINT) END AS n FROM lineitem)"""),
    "snapshot_retention": (snapshot_retention, """
SELECT DISTINCT CAST(ts AS DATE) AS snapshot_date, CAST(ts AS DATE) < DATE '2024-01-21' AS expired FROM events"""),
    "daily_average_7d": (daily_average_7d, f"""
SELECT CAST(s.day AS DATE) AS day, round(avg({_CENTS}), 4) AS average, count(e.event_id) AS observations
FROM (SELECT unnest(generate_series(DATE '2024-01-26', DATE '2024-02-01', INTERVAL 1 DAY)) AS day) s
LEFT JOIN events e ON CAST(e.ts AS DATE) = CAST(s.day AS DATE) GROUP BY 1"""),
    "dashboard_chart": (dashboard_chart, """
SELECT '{"new":' || count(*) FILTER (event_type = 'signup') || ',"changed":' || count(*) FILTER (event_type = 'purchase') || '}' AS chart FROM events"""),
    "status_breakdown": (status_breakdown, """
WITH p AS (SELECT count(*) FILTER (l_returnflag = 'R') AS f, count(*) AS n FROM lineitem GROUP BY l_orderkey),
s AS (SELECT CASE WHEN n <= 1 THEN 'No Images Found' WHEN f > 0 THEN 'Incomplete (' || f || ' failed)' ELSE 'OK' END AS status FROM p)
SELECT status, status <> 'OK' AS todo, status = 'OK' AS complete, count(*) AS pages FROM s GROUP BY status"""),
    "failure_report": (failure_report, f"""
SELECT CASE {_CENTS} % 3 WHEN 0 THEN 'Timeout' WHEN 1 THEN 'NoSuchElement' ELSE 'Price not found' END AS error_type,
  count(*) AS failures FROM events WHERE event_type = 'error' GROUP BY 1"""),
    "failure_rate": (failure_rate, """
SELECT count(*) FILTER (event_type = 'error') AS failed, count(*) FILTER (event_type <> 'error') AS succeeded,
  round(count(*) FILTER (event_type = 'error') / CAST(count(*) AS DOUBLE) * 100, 6) AS failure_rate FROM events"""),
    "retry_outcomes": (retry_outcomes, f"""
SELECT CASE WHEN event_type <> 'error' THEN 'done' WHEN {_CENTS} > 10000 THEN 'hard_failure' ELSE 'retry' END AS outcome,
  count(*) AS rows FROM events GROUP BY 1"""),
    "run_ledger": (run_ledger, f"""WITH {_LATEST}
SELECT run_id, CASE WHEN bool_or(status = 'failed') THEN 'failed' ELSE 'running' END AS status, count(*) AS steps FROM l GROUP BY run_id"""),
    "ledger_info": (ledger_info, """
SELECT run_id, step, info FROM (SELECT user_id % 25 AS run_id, 'step' || (user_id % 4) AS step, props AS info,
  row_number() OVER (PARTITION BY user_id % 25, user_id % 4 ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type = 'purchase') WHERE rn = 1"""),
    "output_currency": (output_currency, """
SELECT CASE WHEN o_orderstatus = 'F' THEN 'A' ELSE 'B' END AS run_id,
  o_orderstatus = 'F' AND o_orderpriority NOT IN ('5-LOW', '1-URGENT') AS is_current, count(*) AS outputs FROM orders GROUP BY 1, 2"""),
    "table_compare": (table_compare, """
WITH l AS (SELECT l_partkey AS sku, l_linenumber, count(*) AS n FROM lineitem WHERE l_returnflag <> 'A' GROUP BY ALL),
r AS (SELECT l_partkey AS sku, l_linenumber, count(*) AS n FROM lineitem WHERE l_linestatus = 'F' GROUP BY ALL)
SELECT COALESCE(l.sku, r.sku) AS sku, COALESCE(l.l_linenumber, r.l_linenumber) AS l_linenumber,
  abs(COALESCE(l.n, 0) - COALESCE(r.n, 0)) AS surplus,
  CASE WHEN COALESCE(l.n, 0) > COALESCE(r.n, 0) THEN 'only_left' ELSE 'only_right' END AS side
FROM l FULL OUTER JOIN r ON l.sku = r.sku AND l.l_linenumber = r.l_linenumber WHERE COALESCE(l.n, 0) <> COALESCE(r.n, 0)"""),
    "table_compare_near": (table_compare_near, """
WITH l AS (SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate FROM lineitem),
r AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_orderkey % 997 = 5 THEN l_quantity + 1 ELSE l_quantity END AS l_quantity, l_shipdate FROM l WHERE l_orderkey % 997 <> 3
      UNION ALL SELECT * FROM l WHERE l_orderkey % 997 = 7),
u AS (SELECT *, 1 AS n FROM l UNION ALL SELECT *, -1 FROM r)
SELECT l_orderkey, l_linenumber, l_quantity, l_shipdate, CAST(abs(sum(n)) AS BIGINT) AS surplus,
  CASE WHEN sum(n) > 0 THEN 'only_left' ELSE 'only_right' END AS side FROM u GROUP BY 1, 2, 3, 4 HAVING sum(n) <> 0"""),
    "table_compare_summary": (table_compare_summary, """
WITH l AS (SELECT l_partkey AS sku FROM lineitem WHERE l_returnflag <> 'A'),
r AS (SELECT l_partkey AS sku FROM lineitem WHERE l_linestatus = 'F')
SELECT (SELECT count(*) FROM l) AS left_rows, (SELECT count(*) FROM r) AS right_rows,
  (SELECT count(*) FROM (SELECT * FROM l EXCEPT ALL SELECT * FROM r)) AS only_left,
  (SELECT count(*) FROM (SELECT * FROM r EXCEPT ALL SELECT * FROM l)) AS only_right,
  1 AS schema_differences, FALSE AS equal"""),
    "gates": (gates, f"""WITH {S.OFFERS_SQL},
c AS (SELECT count(*) AS expected, count(*) FILTER (sku IN (SELECT sku FROM offers WHERE is_old)) AS covered
      FROM (SELECT DISTINCT sku FROM offers WHERE NOT is_old))
SELECT gate, passed, expected, covered FROM (VALUES ('ok', TRUE), ('missing', FALSE), ('blank', FALSE), ('cover', TRUE)) t(gate, passed), c"""),
    "latest_dated_file": (latest_dated_file, """
SELECT path, stamp FROM (SELECT 'reports/x/product_details_' || stamp || '.csv' AS path, stamp FROM (
  SELECT strftime(o_orderdate, '%Y%m%d') || '_' || lpad(CAST(o_orderkey % 240000 AS VARCHAR), 6, '0') AS stamp FROM orders))
ORDER BY stamp DESC LIMIT 1"""),
    "running_number": (running_number, """
SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS no FROM orders"""),
    "signed_texts": (signed_texts, """
SELECT p_partkey, CASE WHEN p_size > 25 THEN '+' ELSE '' END || CAST(p_size - 25 AS VARCHAR) || '.0%' AS percent,
  CASE WHEN b < 1024 THEN format('{:.2f} B', b::DOUBLE) WHEN b < 1048576 THEN format('{:.2f} KB', b / 1024.0::DOUBLE)
       WHEN b < 1073741824 THEN format('{:.2f} MB', b / 1048576.0::DOUBLE) ELSE format('{:.2f} GB', b / 1073741824.0::DOUBLE) END AS size,
  CASE WHEN p_partkey % 3 > 0 THEN 'Failed (' || (p_partkey % 3) || ' images)' ELSE 'OK' END AS retry FROM (SELECT *, p_partkey * 1000 + 1 AS b FROM part)"""),
    "stream_upsert": (stream_upsert, """
SELECT user_id, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"""),
    "stream_retry": (stream_retry, """
SELECT event_id, user_id FROM events WHERE event_type = 'error' AND NOT value > 100"""),
    "stream_retry_rounds": (stream_retry_rounds, """
SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'hard_failure' WHEN 4 THEN 'given_up' ELSE 'done' END AS outcome,
  CAST(CASE event_id % 10 WHEN 1 THEN 2 WHEN 2 THEN 3 WHEN 4 THEN 3 ELSE 1 END AS INTEGER) AS attempt FROM events"""),
    "stream_history": (stream_history, f"""
WITH e AS (SELECT user_id, event_id, ts, {_CENTS} AS cents FROM events),
p AS (SELECT *, lag(cents) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS prev_cents FROM e),
c AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM p WHERE prev_cents <> cents)
SELECT user_id, event_id, cents, prev_cents, cents - prev_cents AS delta FROM c WHERE rn <= 10"""),
}
