"""Registered queries for the lake: write derived data from the given tables
into a scratch lake under the shared checkpoint folder, read it back through
the library readers (pruning, min-rows, class map) and gates."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators.reshape import priority_union
from ledgerline.plans import fixtures as fx
from ledgerline.plans.registry import query, rounded
from ledgerline.sources import lake as LK

BARS = fx.bars_sql()
CATEGORY_SQL = "CASE WHEN asset IN ('click', 'view') THEN 'crypto' ELSE 'equities' END"


def _bars_lake(spark, sf):
    b = fx.hourly_bars(spark, sf)
    cat = F.when(F.col("asset").isin("click", "view"), "crypto").otherwise("equities")
    root = LK.scratch_path(spark, "lake")
    LK.write_lake(b.withColumn("category", cat), root, sort_by=["ts"])
    return root


@query("s01_load_bars_min_rows", f"""
WITH b AS ({BARS}) SELECT asset, ts, open, high, low, close, volume FROM b
WHERE asset IN (SELECT asset FROM b GROUP BY 1 HAVING count(*) >= 680)""")
def s01(spark, sf):
    """S-01: read the bars lake, lower-case names, require OHLCV, keep assets with
    at least 680 bars."""
    root = _bars_lake(spark, sf)
    df = LK.load_bars(LK.read_lake(spark, root), min_rows=680)
    return df.select("asset", "ts", "open", "high", "low", "close", "volume")


@query("s02_load_asset_class", f"""
WITH b AS ({BARS}), c AS (SELECT *, {CATEGORY_SQL} AS category FROM b),
f AS (SELECT category, min(asset) AS asset FROM c GROUP BY 1)
SELECT asset, category, ts, close, 'growth' AS asset_class FROM c WHERE asset IN (SELECT asset FROM f)""")
def s02(spark, sf):
    """S-02: asset class -> categories (partition pruning), first asset per
    category by name (max_files = 1)."""
    root = _bars_lake(spark, sf)
    df = LK.load_asset_class(spark, root, "growth", {"growth": ["crypto", "equities"], "other": ["x"]},
                             min_rows=1, max_files=1)
    return df.select("asset", "category", "ts", "close", "asset_class")


@query("s03_category_file_counts", f"""
WITH b AS ({BARS}) SELECT {CATEGORY_SQL} AS category, count(DISTINCT asset) AS assets FROM b GROUP BY 1""")
def s03(spark, sf):
    """S-03 / A-15: asset folders per category of the lake."""
    root = _bars_lake(spark, sf)
    return LK.file_stats(spark, root, "*.parquet").select("category", "assets")


@query("s30_write_skip_empty", f"""
WITH b AS ({BARS}) SELECT asset, count(*) AS n FROM b GROUP BY 1""")
def s30(spark, sf):
    """S-30: writing an empty frame writes nothing; the non-empty one round-trips."""
    b = fx.hourly_bars(spark, sf).withColumn("category", F.lit("events"))
    empty_root = LK.scratch_path(spark, "empty")
    assert LK.write_lake(b.filter(F.lit(False)), empty_root) is False
    root = LK.scratch_path(spark, "bars")
    LK.write_lake(b, root)
    return LK.read_lake(spark, root).groupBy("asset").agg(F.count(F.lit(1)).alias("n"))


@query("s31_fan_out_write", """
SELECT o_orderpriority, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1""")
def s31(spark, sf):
    """S-31: one output directory per key value with a single partitioned write."""
    o = fx.table(spark, sf, "orders")
    root = LK.scratch_path(spark, "fanout")
    LK.write_lake(o, root, partition_by=["o_orderpriority"])
    back = spark.read.parquet(root)
    return rounded(back.groupBy("o_orderpriority").agg(F.count(F.lit(1)).alias("n"),
                                                       F.sum("o_totalprice").alias("total")), digits=2)


@query("s32_jsonl_roundtrip", """
SELECT conv_id, turn, role, text FROM conversations""")
def s32(spark, sf):
    """S-32: JSONL sink and source: conversations as message arrays (one JSON line
    per conversation), read back and exploded to turns."""
    c = fx.table(spark, sf, "conversations")
    docs = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("messages"))
    path = LK.scratch_path(spark, "jsonl")
    LK.write_jsonl(docs, path)
    back = LK.read_jsonl(spark, path, "conv_id long, messages array<struct<turn: long, role: string, text: string>>")
    return back.select("conv_id", F.inline("messages"))


@query("s33_result_sinks", """
SELECT event_type, count(*) AS n FROM events GROUP BY 1""")
def s33(spark, sf):
    """S-33: predictions to CSV with header and a metrics record to JSON, read back."""
    ev = fx.table(spark, sf, "events").select("event_id", "event_type", "value")
    csv_path = LK.scratch_path(spark, "pred_csv")
    LK.write_csv(ev, csv_path)
    metrics = ev.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))
    js = LK.scratch_path(spark, "metrics_json")
    LK.write_jsonl(metrics, js)
    back = spark.read.option("header", True).csv(csv_path)
    m = LK.read_jsonl(spark, js, "event_type string, n long")
    return back.groupBy("event_type").agg(F.count(F.lit(1)).alias("n")).join(m, ["event_type", "n"], "inner")


@query("s34_incremental_since", """
SELECT event_id, ts FROM events WHERE ts >= (SELECT max(ts) FROM events) - INTERVAL 168 HOUR""")
def s34(spark, sf):
    """S-34: only rows within '-1w' of the data's latest time (cutoff parsed on the
    driver; anchor is a scalar subquery)."""
    ev = fx.table(spark, sf, "events").select("event_id", "ts")
    anchor = ev.select(F.max("ts")).scalar()
    return LK.rows_since(ev, "ts", "-1w", anchor=anchor)


@query("s34_changed_files", "SELECT event_id, ts, event_type FROM events")
def s34_files(spark, sf):
    """S-34 on files: what was written in the last hour, and nothing after a cutoff ahead of it."""
    path = LK.scratch_path(spark, "changed")
    fx.table(spark, sf, "events").select("event_id", "ts", "event_type").write.parquet(path)
    none = LK.read_changed_files(spark, path, "2200-01-01")
    return LK.read_changed_files(spark, path, "-1h").unionByName(none)


@query("s35_staleness_gate", """
WITH log AS (SELECT event_type, max(ts) AS last FROM events WHERE event_type <> 'error' GROUP BY 1),
now AS (SELECT max(ts) AS t FROM events)
SELECT DISTINCT event_type FROM events WHERE event_type NOT IN
  (SELECT event_type FROM log, now WHERE last >= now.t - INTERVAL 3 HOUR)""")
def s35(spark, sf):
    """S-35: incoming keys (event types) whose last ingest (ingest log = events
    except 'error') is older than 3 hours before now (= latest event) or missing."""
    ev = fx.table(spark, sf, "events")
    incoming = ev.select("event_type").distinct()
    log = ev.filter(F.col("event_type") != "error").select("event_type", F.col("ts").alias("ingested_at"))
    now = ev.select(F.max("ts")).scalar()
    return LK.stale_keys(incoming, log, ["event_type"], "ingested_at", now, 3)


@query("s36_capped_read", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 100")
def s36(spark, sf):
    return LK.capped(fx.table(spark, sf, "events").select("event_id", "ts", "value"), 100, ["ts", "event_id"])


@query("s37_source_fallback", """
WITH a AS (SELECT event_type AS asset, date_trunc('day', ts) AS day, avg(value) AS v, 0 AS priority FROM events
           WHERE hour(ts) < 12 GROUP BY 1, 2),
b AS (SELECT event_type, date_trunc('day', ts), max(value), 1 FROM events GROUP BY 1, 2),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT asset, day, round(arg_min(v, priority), 6) AS v, min(priority) AS priority FROM u GROUP BY 1, 2""")
def s37(spark, sf):
    """S-37: first available source by priority per (asset, day)."""
    ev = fx.table(spark, sf, "events").withColumn("asset", F.col("event_type"))
    a = ev.filter(F.hour("ts") < 12).groupBy("asset", F.date_trunc("day", "ts").alias("day")).agg(F.avg("value").alias("v"))
    b = ev.groupBy("asset", F.date_trunc("day", "ts").alias("day")).agg(F.max("value").alias("v"))
    return rounded(priority_union([a, b], ["asset", "day"]).select("asset", "day", "v", "priority"))


@query("s38_path_rewrite", r"""
WITH r AS (SELECT page_id, url, regexp_replace(regexp_replace(url, '^https?://', 'lake/'), '[?#].*$', '') AS p FROM pages)
SELECT page_id, url, CASE WHEN NOT starts_with(url, 'https') THEN p
  WHEN regexp_matches(p, '(\.[A-Za-z0-9]+)$') THEN regexp_replace(p, '(\.[A-Za-z0-9]+)$', '_alt\1')
  ELSE p || '_alt' END AS new_path FROM r""")
def s38(spark, sf):
    """S-38: manifest path rewrite by ordered regex rules and an '_alt' suffix rule."""
    p = fx.table(spark, sf, "pages").select("page_id", F.col("url"))
    return LK.rewrite_paths(p, "url", [(r"^https?://", "lake/"), (r"[?#].*$", "")], alt_prefix="https")
