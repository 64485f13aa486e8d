"""Registered queries on the hard cases of the panel operators: order of day and month, numeric columns with
missing values, innings by rank, punctuated tickers, first values that are NULL, medians of large groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import clean as CL
from ledgerline.operators import reshape as RS
from ledgerline.operators import text_ops as TO
from ledgerline.operators.quantiles import exact_median
from ledgerline.plans import fixtures as fx
from ledgerline.plans.registry import duck_round, query, rounded
from ledgerline.plans.q_models import _class_features, CLASS_SQL
from ledgerline.plans.q_series import FEATURES_CTE, bars
from ledgerline.operators import features as FT
from ledgerline.operators import models as MD
from ledgerline.operators import splits as SP
from ledgerline.sources import ingest as IN
from ledgerline.operators import topk as TK
from ledgerline.sources import lake as LK
from ledgerline.sources.lake import scratch_path


def _s(c):
    return F.col(c).cast("string")


@query("p06_day_order", """
SELECT o_orderkey, o_orderpriority AS file, CASE o_orderpriority
    WHEN '5-LOW' THEN CASE WHEN day(o_orderdate) <= 12 THEN CAST(make_date(year(o_orderdate), day(o_orderdate), month(o_orderdate)) AS TIMESTAMP) END
    WHEN '4-NOT SPECIFIED' THEN CAST(o_orderdate AS DATE) + INTERVAL 10 HOUR ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS ts,
  o_orderpriority NOT IN ('5-LOW', '4-NOT SPECIFIED') AS decided
FROM orders WHERE o_orderpriority <> '5-LOW' OR day(o_orderdate) <= 12""")
def p06_day_order(spark, sf):
    """P-06: files of one column each, unpadded: two write the day first, one the month; one has no day over
    12, so that nothing decides and the month is taken as first; one has ISO times without seconds."""
    o = fx.table(spark, sf, "orders")
    d, p = F.col("o_orderdate"), F.col("o_orderpriority")
    raw = F.when(p == "4-NOT SPECIFIED", F.date_format(d, "yyyy-MM-dd'T'10:00'Z'")) \
        .when(p == "3-MEDIUM", F.date_format(d, "M/d/yyyy")).when(p == "2-HIGH", F.date_format(d, "dd/MM/yyyy")) \
        .otherwise(F.date_format(d, "d/M/yyyy"))
    r = o.where((p != "5-LOW") | (F.dayofmonth(d) <= 12)).select("o_orderkey", p.alias("file"), raw.alias("raw"))
    return CL.parse_times(r, "raw", "ts", by=["file"]).select("o_orderkey", "file", F.col("ts").cast("timestamp_ntz").alias("ts"), "decided")


@query("p15_numeric_columns", """
SELECT event_id, value, TRY_CAST(CASE WHEN event_id % 5 < 3 THEN '1.5' ELSE 'x' END AS DOUBLE) AS most FROM events""")
def p15_numeric_columns(spark, sf):
    """P-15: numeric columns stay, and text that is a number in more than half of all rows; a column that is
    a number wherever it is present, but missing in most rows, goes."""
    ev = fx.table(spark, sf, "events")
    m = F.pmod("event_id", F.lit(5))
    raw = ev.select("event_id", "value", F.when(m < 2, _s("user_id")).alias("few"), F.when(m < 3, "1.5").otherwise("x").alias("most"),
                    "event_type")
    return CL.numeric_columns(raw, keep=["event_id"])


@query("a10_match_summary", """
WITH b AS (SELECT l_orderkey // 4 AS match, (l_linenumber * 5) % 7 + 10 AS innings, * FROM lineitem),
per AS (SELECT match, innings, arg_min('T' || CAST(l_suppkey AS VARCHAR), (l_orderkey, l_partkey, l_suppkey)) AS team,
          round(sum(l_quantity) + sum(l_tax), 4) AS runs, count(*) FILTER (l_returnflag = 'R') AS wickets, count(*) AS balls,
          dense_rank() OVER (PARTITION BY match ORDER BY innings) AS r FROM b GROUP BY match, innings)
SELECT match, """ + ", ".join(f"max({n}) FILTER (r = {k}) AS {n}_{k}" for k in range(1, 5) for n in ("team", "runs", "wickets", "balls")) + """
FROM per GROUP BY match""")
def a10_match_summary(spark, sf):
    """A-10: the first four innings of a match by rank, with team, runs and extras, wickets and balls."""
    li = fx.table(spark, sf, "lineitem").select(
        F.floor(F.col("l_orderkey") / 4).cast("long").alias("match"), (F.pmod(F.col("l_linenumber") * 5, F.lit(7)) + 10).alias("innings"), "*")
    first = F.struct("l_orderkey", "l_partkey", "l_suppkey")
    out = RS.ranked_pivot(li, ["match"], "innings", 4, {
        "team": F.min_by(F.concat(F.lit("T"), _s("l_suppkey")), first),
        "runs": F.sum("l_quantity") + F.sum("l_tax"),
        "wickets": F.count_if(F.col("l_returnflag") == "R"), "balls": F.count("*")})
    return rounded(out, digits=4)


@query("a12_punctuated_tickers", """
SELECT t AS ticker, CAST(coalesce(sum(len(regexp_extract_all(upper(coalesce(text, '')), p))), 0) AS BIGINT) AS mentions
FROM documents, (VALUES ('EXAMPLE.COM', '\\bEXAMPLE\\.COM\\b'), ('BY-NC', '\\bBY-NC\\b'), ('BRK.B', '\\bBRK\\.B\\b')) v(t, p) GROUP BY t
UNION ALL SELECT 'THE', (SELECT count(*) FROM (SELECT unnest(regexp_split_to_array(upper(coalesce(text, '')), '[^\\p{L}\\p{N}_]+')) AS w
  FROM documents) WHERE w = 'THE')""")
def a12_punctuated(spark, sf):
    """A-12: tickers with a dot or a hyphen beside plain ones; one without any mention."""
    return TO.keyword_mentions(fx.table(spark, sf, "documents"), ["text"], ["EXAMPLE.COM", "BY-NC", "BRK.B", "THE"])


@query("r04_first_value", """
SELECT date_trunc('month', o_orderdate) AS month, """ + ", ".join(
    f"arg_min(v, o_orderkey) FILTER (o_orderstatus = '{s}' AND v IS NOT NULL) AS {s.lower()}" for s in "FOP") + """
FROM (SELECT *, CASE WHEN o_orderkey % 3 <> 0 THEN o_totalprice END AS v FROM orders) GROUP BY 1""")
def r04_first_value(spark, sf):
    """R-04: a third of the values is missing; the first that is there counts."""
    o = fx.table(spark, sf, "orders").select(F.date_trunc("month", "o_orderdate").alias("month"), "o_orderstatus", "o_orderkey",
                                             F.when(F.pmod("o_orderkey", F.lit(3)) != 0, F.col("o_totalprice")).alias("v"))
    wide = RS.pivot_first(o, ["month"], "o_orderstatus", "v", ["F", "O", "P"], ["o_orderkey"])
    return wide.withColumnsRenamed({s: s.lower() for s in "FOP"})


@query("r05_transpose_repeated", """
WITH c AS (SELECT o_orderstatus AS series, o_orderpriority AS part, CASE WHEN year(o_orderdate) % 5 <> ascii(o_orderpriority) % 5 THEN max(o_totalprice) END AS v,
  year(o_orderdate) AS y FROM orders GROUP BY 1, 2, 4)
SELECT CAST(y AS VARCHAR) AS year, """ + ", ".join(f"arg_min(v, part) FILTER (series = '{s}' AND v IS NOT NULL) AS {s.lower()}" for s in "FOP") + """
FROM c GROUP BY 1""")
def r05_transpose_repeated(spark, sf):
    """R-05: several rows of a series, each with gaps: the first value by their order, NULL only where none has one."""
    o = fx.table(spark, sf, "orders").withColumn("y", F.year("o_orderdate"))
    years = RS.column_values(o, F.year("o_orderdate"))
    gap = F.pmod("y", F.lit(5)) == F.pmod(F.ascii("o_orderpriority"), F.lit(5))
    wide = o.groupBy(F.col("o_orderstatus").alias("series"), F.col("o_orderpriority").alias("part")).pivot("y", years) \
        .agg(F.max(F.when(~gap, F.col("o_totalprice"))))
    out = RS.transpose_series(wide, "series", [str(y) for y in years], "year", ["F", "O", "P"], order=["part"])
    return out.withColumnsRenamed({s: s.lower() for s in "FOP"})


@query("a09_median_of_large_groups", """
SELECT l_returnflag, median(l_extendedprice) AS median_price, count(*) AS n FROM lineitem GROUP BY 1""")
def a09_large_groups(spark, sf):
    """A-09: medians of groups above the row limit, narrowed by sketches before any ranking."""
    li = fx.table(spark, sf, "lineitem")
    counts = li.groupBy("l_returnflag").agg(F.count("*").alias("n"))
    return exact_median(li, ["l_returnflag"], "l_extendedprice", "median_price", most=1000).join(counts, "l_returnflag")


# ---- S-34, S-35: the ingest log -----------------------------------------------------------------

DAYS_SQL = "floor((epoch(ts) - (SELECT epoch(min(ts)) FROM events)) / 86400)"


def _ingested(spark, sf):
    """Three batches of events by time, the second run twice and once more under another name; data without a
    commit lies beside them."""
    ev = fx.table(spark, sf, "events").select("event_id", "event_type", "user_id", "ts")
    first = ev.select(F.min("ts")).scalar()
    day = F.floor((F.unix_timestamp(F.col("ts").cast("timestamp")) - F.unix_timestamp(first.cast("timestamp"))) / 86400)
    root = scratch_path(spark, "ingest")
    key, order = ["event_type"], ["ts", "event_id"]
    IN.ingest(spark, root, "a", ev.where(day < 5), key, order)
    IN.ingest(spark, root, "b", ev.where((day < 9) & (F.col("event_type") != "error")), key, order)
    IN.ingest(spark, root, "b", ev, key, order)           # in the log: adds nothing
    IN.ingest(spark, root, "b2", ev.where((day < 9) & (F.col("event_type") != "error")), key, order)   # nothing new
    ev.limit(5).write.parquet(f"{root}/data/batch=died")  # a run that ended before its commit
    return root, ev


@query("s34_ingest_log", f"""
SELECT event_id, event_type, user_id, ts, CASE WHEN {DAYS_SQL} < 5 THEN 'a' WHEN {DAYS_SQL} < 9 AND event_type <> 'error' THEN 'b' ELSE 'c' END AS batch
FROM events""")
def s34_log(spark, sf):
    """S-34: every row once, in the batch that first brought it, whatever was run again."""
    root, ev = _ingested(spark, sf)
    IN.ingest(spark, root, "c", ev, ["event_type"], ["ts", "event_id"])
    return IN.committed(spark, root).select("event_id", "event_type", "user_id", "ts", "batch")


@query("s35_gate_by_log", f"""
WITH l AS (SELECT event_type, max(ts) AS t FROM events WHERE {DAYS_SQL} < 5 OR ({DAYS_SQL} < 9 AND event_type <> 'error') GROUP BY 1)
SELECT DISTINCT event_type FROM events WHERE event_type NOT IN
  (SELECT event_type FROM l WHERE t >= (SELECT max(t) FROM l) - INTERVAL 30 HOUR)""")
def s35_log(spark, sf):
    """S-35: event types whose mark in the log is over 30 hours behind the newest mark."""
    root, ev = _ingested(spark, sf)
    now = IN.ingest_log(spark, root).select(F.max("high_water.ts")).scalar()
    return IN.stale(spark, root, ev, ["event_type"], now, 30, "ts")


# ---- M-06, M-09 ---------------------------------------------------------------------------------

def _class_scores(spark, sf):
    rows = SP.single_train_test_split(_class_features(spark, sf), 0.8, indexed=False)
    models = MD.train_class_models(rows.where("role = 'train'"), "asset_class", scratch_path(spark, "models"), max_iter=5, max_depth=3)
    return MD.score_by_class(rows.where("role = 'test'").select("asset", "asset_class", "ts", "target", *FT.FEATURE_COLUMNS),
                             models, "asset_class")


@query("m06_class_models")
def m06_class_models(spark, sf):
    """M-06: one saved model per asset class, test rows scored by that of their own class."""
    return _class_scores(spark, sf).select("asset_class", "asset", "ts", F.col("target").alias("actual"), "prediction")


@query("m06_class_model_rows", f"""
WITH {FEATURES_CTE} SELECT {CLASS_SQL} AS asset_class, asset, ts, round(target, 6) AS actual, TRUE AS has_prediction
FROM f WHERE rn >= floor(n * 0.8) AND target IS NOT NULL AND {" AND ".join(f"{c} IS NOT NULL" for c in FT.FEATURE_COLUMNS)}""")
def m06_class_rows(spark, sf):
    """M-06: the rows that the class models are judged on."""
    s = _class_scores(spark, sf).where("target IS NOT NULL")
    return rounded(s.select("asset_class", "asset", "ts", F.col("target").alias("actual"), F.col("prediction").isNotNull().alias("has_prediction")))


@query("m09_feature_windows", f"""
WITH {FEATURES_CTE}, v AS (SELECT asset, ts, rn, target, [{", ".join(f"round({c}, 6)" for c in FT.FEATURE_COLUMNS)}] AS x,
  {" AND ".join(f"{c} IS NOT NULL" for c in FT.FEATURE_COLUMNS)} AS whole FROM f),
w AS (SELECT asset, ts, target, flatten(list(x) OVER w) AS "window", count(*) FILTER (whole) OVER w AS c FROM v
  WINDOW w AS (PARTITION BY asset ORDER BY rn ROWS BETWEEN 15 PRECEDING AND CURRENT ROW))
SELECT asset, ts, "window", round(target, 6) AS target FROM w WHERE c = 16""")
def m09_feature_windows(spark, sf):
    """M-09: windows of 16 vectors of all 14 features with the target, read back from a store of chunk arrays."""
    f = FT.build_features(bars(spark, sf), horizon=1, gaps=False)
    path = scratch_path(spark, "windows")
    MD.write_window_store(f, path, FT.FEATURE_COLUMNS, 16, "target", chunk_rows=128)
    w = MD.read_windows(spark, path, 16)
    return w.select("asset", "ts", F.transform(F.flatten("window"), lambda x: duck_round(x, 6)).alias("window"),
                    duck_round("target", 6).alias("target"))


# ---- S-01, A-15, A-16, J-06, J-09, R-02, M-02: whole tables, the operator itself ------------------------

@query("s01_file_per_asset", f"""
WITH b AS ({fx.bars_sql()}) SELECT asset, ts, close FROM b WHERE asset IN (SELECT asset FROM b GROUP BY 1 HAVING count(*) >= 650)""")
def s01_files(spark, sf):
    """S-01: a flat folder with a file for each asset (the few event types), names from the files, short ones skipped."""
    b = fx.hourly_bars(spark, sf)
    root = scratch_path(spark, "per-asset")
    for a in RS.column_values(b, "asset"):
        b.where(F.col("asset") == a).drop("asset").withColumnsRenamed({"close": "Close"}).write.parquet(f"{root}/{a}.parquet")
    return LK.load_bars(LK.read_file_per_asset(spark, f"{root}/*.parquet"), min_rows=650).select("asset", "ts", "close")


@query("a15_file_counts", """
SELECT c_mktsegment AS category, 1::BIGINT AS assets, CAST(count(DISTINCT c_custkey % 3) AS BIGINT) AS files,
  CAST(sum(strlen(c_name) + 1) AS BIGINT) AS bytes FROM customer GROUP BY 1""")
def a15_counts(spark, sf):
    """A-15: files too, of a write whose files are known: one for each category and writer, by a column."""
    root = scratch_path(spark, "counted")
    c = fx.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("category"), F.pmod("c_custkey", F.lit(3)).alias("writer"), "c_name")
    for w in range(3):
        c.where(F.col("writer") == w).repartition("category").select("category", "c_name").write.mode("append").partitionBy("category").text(root)
    return LK.file_stats(spark, root, pattern="*.txt")


@query("a16_drop_empty_columns", "SELECT o_orderkey, CASE WHEN o_orderkey % 1000 = 1 THEN o_totalprice END AS rare FROM orders")
def a16_drop(spark, sf):
    """A-16: a column without any value goes, one with few values stays."""
    o = fx.table(spark, sf, "orders").select("o_orderkey", F.when(F.pmod("o_orderkey", F.lit(1000)) == 1, F.col("o_totalprice")).alias("rare"),
                                             F.lit(None).cast("string").alias("never"), F.when(F.col("o_orderkey") < 0, 1).alias("nor_this"))
    return RS.drop_all_null_columns(o)


@query("j06_home_away_all", """
SELECT l_orderkey, min(l_suppkey) FILTER (h) AS home_team, min(l_suppkey) FILTER (NOT h) AS away_team,
  min(l_quantity) FILTER (h) AS home_score, min(l_quantity) FILTER (NOT h) AS away_score
FROM (SELECT *, l_linenumber = min(l_linenumber) OVER (PARTITION BY l_orderkey) AS h FROM lineitem) GROUP BY 1""")
def j06_all(spark, sf):
    """J-06 over all rows: home is a game's first line, whatever its number; the others are away."""
    li = fx.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_quantity")
    first = li.groupBy("l_orderkey").agg(F.min("l_linenumber").alias("_first"))
    return TK.home_away(li.join(first, "l_orderkey"), "l_orderkey", F.col("l_linenumber") == F.col("_first"), "l_suppkey", "l_quantity")


@query("j09_reindex_all", """
WITH d AS (SELECT DISTINCT event_type, date_trunc('day', ts) AS day FROM events),
h AS (SELECT event_type, date_trunc('hour', ts) AS hour, avg(value) AS v FROM events GROUP BY 1, 2)
SELECT d.event_type, d.day, round(h.v, 6) AS value FROM d LEFT JOIN h ON h.event_type = d.event_type AND h.hour = d.day""")
def j09_all(spark, sf):
    """J-09 for every type: its hourly series reindexed onto its own days."""
    ev = fx.table(spark, sf, "events")
    days = ev.select("event_type", F.date_trunc("day", "ts").alias("day")).distinct()
    hours = ev.groupBy("event_type", F.date_trunc("hour", "ts").alias("day")).agg(F.avg("value").alias("value"))
    return rounded(days.join(hours, ["event_type", "day"], "left"))


@query("r02_priority_union_all", """
WITH a AS (SELECT event_type, date_trunc('day', ts) AS day, avg(value) AS value, 0 AS priority FROM events WHERE hour(ts) = 0 GROUP BY 1, 2),
b AS (SELECT event_type, date_trunc('day', ts) AS day, avg(value) AS value, 1 AS priority FROM events GROUP BY 1, 2),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT event_type, day, round(arg_min(value, priority), 6) AS value, min(priority) AS priority FROM u GROUP BY 1, 2""")
def r02_all(spark, sf):
    """R-02 for every type: midnight snapshots, else the day's mean."""
    ev = fx.table(spark, sf, "events").withColumn("day", F.date_trunc("day", "ts"))
    feed = lambda d: d.groupBy("event_type", "day").agg(F.avg("value").alias("value"))
    return rounded(RS.priority_union([feed(ev.where(F.hour("ts") == 0)), feed(ev)], ["event_type", "day"])
                   .select("event_type", "day", "value", "priority"))


@query("m02_expanding_fold_bounds", f"""
WITH n AS (SELECT asset, count(*) AS n FROM ({fx.bars_sql()}) GROUP BY 1 HAVING count(*) >= 250)
SELECT asset, CAST(f AS INTEGER) AS fold, CAST(f * 50 + 200 AS BIGINT) AS train_end, CAST(f * 50 + 250 AS BIGINT) AS test_end
FROM n, range(0, 100000) t(f) WHERE f <= (n - 250) // 50""")
def m02_bounds(spark, sf):
    """M-02: the folds as spans of row numbers, one row a fold."""
    n = fx.hourly_bars(spark, sf).groupBy("asset").agg(F.count("*").alias("n"))
    out = SP.expanding_fold_bounds(n, 200, 50)
    return out.select("asset", "fold", F.col("train_end").cast("long").alias("train_end"), F.col("test_end").cast("long").alias("test_end"))
