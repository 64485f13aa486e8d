"""Registered queries: panel model (Spark ML), sequence windows, streaming
operators and the documented-only indicators (M-06, M-09, T-01..T-05, E-01..E-08)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import backtest as BT
from ledgerline.operators import features as FT
from ledgerline.operators import models as MD
from ledgerline.operators import splits as SP
from ledgerline.plans import fixtures as fx
from ledgerline.session import cut_lineage
from ledgerline.plans.q_series import FEATURES_CTE, bars, features
from ledgerline.plans.q_text import SCORE_SQL, _count_sql
from ledgerline.plans.registry import duck_round, query, rounded
from ledgerline.sources.lake import scratch_path
from ledgerline.streaming import ops as ST
from ledgerline.functions import text as TX

RULE_POS = _count_sql("lower(text)", TX.RULE_POSITIVE_WORDS)
RULE_NEG = _count_sql("lower(text)", TX.RULE_NEGATIVE_WORDS)


# ---- M-06 / M-09 ------------------------------------------------------------------

def _panel(spark, sf):
    f = features(spark, sf, horizon=1)
    return SP.single_train_test_split(f, 0.8, indexed=False)


@query("m06_panel_model_predictions")
def m06(spark, sf):
    """M-06: one GBT regressor for the asset class, trained on the pooled train
    rows (features computed per asset), predictions on the test rows. Not
    SQL-expressible: no oracle."""
    rows = _panel(spark, sf)
    model = MD.train_panel_model(rows.filter(F.col("role") == "train"), max_iter=10, max_depth=3)
    pred = MD.predict(model, rows.filter(F.col("role") == "test"))
    return pred.select("asset", "ts", "prediction", F.col("target").alias("actual"))


@query("m06_feature_importance")
def m06i(spark, sf):
    """M-06: top-10 feature importances of the fitted model (14 numbers from the
    model, built into a frame on the driver)."""
    rows = _panel(spark, sf)
    model = MD.train_panel_model(rows.filter(F.col("role") == "train"), max_iter=10, max_depth=3)
    pairs = MD.feature_importance(model, top=10)
    return spark.createDataFrame(pairs, "feature string, importance double")


def _test_rows_sql(label: str | None) -> str:
    """Test rows with every feature; with the label they are what a model is judged on."""
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*FT.FEATURE_COLUMNS, *([label] if label else [])])
    return f"""
WITH {FEATURES_CTE} SELECT asset, ts, {f"round({label}, 6) AS actual, " if label else ""}TRUE AS has_prediction
FROM f WHERE rn >= floor(n * 0.8) AND {complete}"""


@query("m06_direction_classifier_rows", _test_rows_sql("target_direction").replace("round(target_direction, 6)", "target_direction"))
def m06_direction(spark, sf):
    """M-06: the classification task: a GBT classifier of the direction on the pooled
    train rows; judged test rows, their class, and that each got class 0 or 1."""
    rows = _panel(spark, sf)
    model = MD.train_panel_model(rows.filter(F.col("role") == "train"), label="target_direction",
                                 task="classification", max_iter=5, max_depth=3)
    pred = MD.predict(model, rows.filter(F.col("role") == "test")).filter(F.col("target_direction").isNotNull())
    return pred.select("asset", "ts", F.col("target_direction").alias("actual"),
                       F.col("prediction").isin(0.0, 1.0).alias("has_prediction"))


@query("m06_panel_model_rows", _test_rows_sql("target"))
def m06_rows(spark, sf):
    """M-06: the regression task of ``m06_panel_model_predictions`` without the fitted numbers."""
    pred = m06(spark, sf).filter(F.col("actual").isNotNull())
    return rounded(pred.select("asset", "ts", "actual", F.col("prediction").isNotNull().alias("has_prediction")))


@query("m09_sequence_windows", f"""
WITH {FEATURES_CTE}, q AS (SELECT asset, ts, count(log_return) OVER w AS c,
  list(round(log_return, 6)) OVER w AS "window" FROM f
  WINDOW w AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))
SELECT asset, ts, "window" FROM q WHERE c = 5""")
def m09(spark, sf):
    """M-09: per row the last 5 log returns (oldest first), full frames only."""
    lr = FT.log_returns(bars(spark, sf))
    out = MD.sequence_windows(lr, "log_return", 5)
    return out.select("asset", "ts", F.transform("window", lambda x: duck_round(x, 6)).alias("window"))


# ---- M-08: a model per asset class and fold ------------------------------------------

CLASS_SQL = "CASE WHEN asset IN ('click', 'view') THEN 'crypto' ELSE 'equities' END"


def _class_features(spark, sf):
    kind = F.when(F.col("asset").isin("click", "view"), "crypto").otherwise("equities")
    return features(spark, sf, horizon=1).withColumn("asset_class", kind)


def _backtest_sql(scheme: str, label: str) -> str:
    """Folds, sizes, actuals and the error of the naive forecast (zero, or the class 1), per class and fold."""
    first = "fold * 100" if scheme == "walk_forward" else "0"
    naive = "avg(abs(actual))" if label == "target" else "avg(1 - actual)"
    complete = " AND ".join(f"{c} IS NOT NULL" for c in [*FT.FEATURE_COLUMNS, label])
    return f"""
WITH {FEATURES_CTE},
c AS (SELECT asset, {CLASS_SQL} AS asset_class, ts, {label} AS actual FROM f WHERE {complete}),
i AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) - 1 AS p, count(*) OVER (PARTITION BY asset) AS m FROM c),
k AS (SELECT *, unnest(range(0, CAST(floor((m - 300) / 100) AS BIGINT) + 1)) AS fold FROM i WHERE m >= 300),
x AS (SELECT asset_class, fold, actual, p < fold * 100 + 200 AS train FROM k
      WHERE p >= {first} AND p < fold * 100 + 300),
z AS (SELECT asset_class, CAST(fold AS INTEGER) AS fold, count(*) FILTER (WHERE train) AS train_size,
  count(*) FILTER (WHERE NOT train) AS test_size, round(avg(actual) FILTER (WHERE NOT train), 6) AS actual_mean,
  round({naive} FILTER (WHERE NOT train), 6) AS naive_error FROM x GROUP BY 1, 2)
SELECT *, TRUE AS has_prediction FROM z WHERE train_size >= 50 AND test_size >= 10"""


def _backtest_sizes(pred, naive):
    """The part of a backtest that does not depend on the fitted numbers."""
    out = pred.groupBy("asset_class", "fold").agg(
        F.max("train_size").alias("train_size"), F.max("test_size").alias("test_size"),
        F.avg("actual").alias("actual_mean"), F.avg(naive).alias("naive_error"),
        F.bool_and(F.col("prediction").isNotNull() & ~F.isnan("prediction")).alias("has_prediction"))
    return rounded(out)


@query("m08_walk_forward_backtest", _backtest_sql("walk_forward", "target"))
def m08_walk(spark, sf):
    """M-08: a model per asset class and walk-forward fold: folds, sizes, actuals, naive error."""
    return _backtest_sizes(BT.backtest(_class_features(spark, sf)), F.abs("actual"))


@query("m08_expanding_backtest", _backtest_sql("expanding", "target"))
def m08_expanding(spark, sf):
    """M-08 over expanding folds."""
    return _backtest_sizes(BT.backtest(_class_features(spark, sf), scheme="expanding"), F.abs("actual"))


@query("m08_classification_backtest", _backtest_sql("walk_forward", "target_direction"))
def m08_direction(spark, sf):
    """M-06 / M-08: the direction task, a model per asset class and walk-forward fold."""
    pred = BT.backtest(_class_features(spark, sf), label="target_direction", task="classification")
    return _backtest_sizes(pred, 1 - F.col("actual"))


@query("m08_backtest_record")
def m08_record(spark, sf):
    """M-08: all metrics of the fitted model per asset class and walk-forward fold
    (fold -1: pooled over all folds). Fitted numbers: rows only."""
    pred = cut_lineage(BT.backtest(_class_features(spark, sf)), eager=False)
    folds = BT.fold_record(pred)
    pooled = BT.pooled_record(pred).drop("folds")
    return rounded(folds.unionByName(pooled.withColumn("fold", F.lit(-1)), allowMissingColumns=True))


@query("m08_direction_record")
def m08_direction_record(spark, sf):
    """M-06 / M-08: accuracy, precision, recall and F1 per asset class and fold. Fitted numbers: rows only."""
    pred = BT.backtest(_class_features(spark, sf), label="target_direction", task="classification")
    return rounded(BT.class_record(pred))


# ---- T-01..T-05 streaming -----------------------------------------------------------

def _table_path(sf, name):
    """A table, one file or a folder of parts, as a pattern: a stream may not be of the path of one file, and a
    filter by file names over ``sf`` would see no part of a folder."""
    return f"{sf.rstrip('/')}/{{{name}.parquet}}"


def _events_stream(spark, sf):
    return ST.read_stream(spark, _table_path(sf, "events"), fx.table(spark, sf, "events").schema)


def _drain(spark, df, name, mode="append"):
    out = scratch_path(spark, f"stream-{name}")
    ST.run_to_parquet(df, out + "/data", out + "/checkpoint", mode)
    return spark.read.parquet(out + "/data")


@query("t01_stream_bars", """
WITH b AS (SELECT event_type, date_trunc('hour', ts) AS window_start, arg_min(value, (ts, event_id)) AS open,
  max(value) AS high, min(value) AS low, arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
  FROM events GROUP BY 1, 2)
SELECT * FROM b WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE""")
def t01(spark, sf):
    """T-01: hourly bars from the event stream with a 10-minute watermark; only
    windows closed by the watermark are emitted (append mode)."""
    bars_s = ST.stream_bars(_events_stream(spark, sf), "event_type", "ts", "value", "event_id")
    out = _drain(spark, bars_s, "bars")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("t02_stream_scores", f"""
SELECT doc_id, round({SCORE_SQL}, 4) AS score, CASE WHEN {RULE_POS} > {RULE_NEG} THEN 'Positive'
  WHEN {RULE_NEG} > {RULE_POS} THEN 'Negative' ELSE 'Neutral' END AS label FROM documents""")
def t02(spark, sf):
    """T-02: stateless scoring of a document stream."""
    docs = spark.readStream.schema(fx.table(spark, sf, "documents").schema).parquet(_table_path(sf, "documents"))
    out = _drain(spark, ST.stream_scores(docs, "text", keep=["doc_id"]), "scores")
    return out.select("doc_id", "score", "label")


@query("t03_stream_mentions", """
WITH t AS (SELECT ts, unnest(regexp_split_to_array(upper(event_type || ' ' || CAST(user_id AS VARCHAR) || ' CLICK'),
                                   '[^\\p{L}\\p{N}_]+')) AS ticker FROM events),
h AS (SELECT ts, ticker FROM t WHERE ticker IN ('CLICK', 'VIEW', 'ERROR')),
w AS (SELECT ticker, time_bucket(INTERVAL 15 MINUTE, ts) - INTERVAL 45 MINUTE + INTERVAL (15 * k) MINUTE AS window_start
      FROM h, range(0, 4) r(k))
SELECT window_start, ticker, count(*) AS mentions FROM w
WHERE window_start + INTERVAL 1 HOUR <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE GROUP BY 1, 2""")
def t03(spark, sf):
    """T-03: ticker mentions per 1-hour window sliding by 15 minutes over a text
    stream rendered from events; closed windows only."""
    ev = _events_stream(spark, sf)
    docs = ev.select("ts", F.concat_ws(" ", "event_type", F.col("user_id").cast("string"), F.lit("click")).alias("text"))
    m = ST.stream_mentions(docs, "ts", "text", ["CLICK", "VIEW", "ERROR"])
    out = _drain(spark, m, "mentions")
    return out.withColumn("window_start", F.col("window_start").cast("timestamp_ntz"))


@query("t04_stream_dedupe", """
SELECT event_type, count(DISTINCT user_id) AS n FROM events GROUP BY 1""")
def t04(spark, sf):
    """T-04: first event per (user, type) within the watermark. Which duplicate
    survives depends on arrival, so the query reports kept keys per type; the
    table is drained in one micro-batch, where that equals the distinct keys."""
    ev = _events_stream(spark, sf).select("user_id", "event_type", "ts")
    out = _drain(spark, ST.stream_dedupe(ev, ["user_id", "event_type"], "ts", "1 hour"), "dedupe")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("t04_stream_dedupe_batches", "SELECT event_type, count(DISTINCT event_id) AS n FROM events GROUP BY 1")
def t04_batches(spark, sf):
    """T-04 over several micro-batches: every event comes twice, ten minutes apart,
    the files in four slices of time order. The delay is a slice and an hour, so
    no row is late and each repeat meets its first copy in the state, in whatever
    order the files of a slice come."""
    ev = fx.table(spark, sf, "events").select("event_id", "event_type", "ts")
    twice = ev.unionByName(ev.withColumn("ts", F.col("ts") + F.expr("INTERVAL 10 MINUTES")))
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    lo, hi = twice.agg(F.min(at), F.max(at)).first()
    path = scratch_path(spark, "event-slices")
    slices, width = 4, (((hi or 0) - (lo or 0)) // 4) + 1
    for i in range(slices):
        part = twice.filter(F.floor((at - F.lit(lo)) / width) == i)
        part.hint("rebalance").write.mode("append").parquet(path)
    files = len(spark.read.parquet(path).inputFiles())
    stream = ST.read_stream(spark, path, twice.schema, max_files_per_trigger=max(1, files // slices))
    out = _drain(spark, ST.stream_dedupe(stream, ["event_id"], "ts", f"{width + 3600} seconds"), "dedupe")
    return out.groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("t05_stream_model_scoring")
def t05(spark, sf):
    """T-05: a model fitted on the batch panel scores a stream of feature rows."""
    rows = _panel(spark, sf)
    model = MD.train_panel_model(rows.filter(F.col("role") == "train"), max_iter=5, max_depth=3)
    feats = rows.filter(F.col("role") == "test").drop("role", "rn", "n")
    path = scratch_path(spark, "feature-rows")
    feats.na.drop(how="any", subset=FT.FEATURE_COLUMNS).write.parquet(path)
    stream = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    out = _drain(spark, ST.stream_model_scores(stream, model).drop("features_vec"), "scores")
    return out.select("asset", "ts", "prediction")


@query("t05_stream_scored_rows", _test_rows_sql(None))
def t05_rows(spark, sf):
    """T-05 without the fitted numbers: every complete feature row is scored once."""
    return t05(spark, sf).select("asset", "ts", F.col("prediction").isNotNull().alias("has_prediction"))


@query("t05_stream_features", f"""
WITH {FEATURES_CTE} SELECT asset, ts, {", ".join(f"round({c}, 6) AS {c}" for c in FT.FEATURE_COLUMNS)}, TRUE AS has_prediction
FROM f WHERE {" AND ".join(f"{c} IS NOT NULL" for c in FT.FEATURE_COLUMNS)}""")
def t05_features(spark, sf):
    """T-05: features made in the stream from bars alone, then scored by the model. Bars come in three slices
    of time; each is drained by a query that starts anew from the checkpoint, so state crosses restarts."""
    from ledgerline.streaming.features import stream_features, with_rocksdb

    panel = _panel(spark, sf)
    model = MD.train_panel_model(panel.filter(F.col("role") == "train"), max_iter=5, max_depth=3)
    b = bars(spark, sf).select("asset", F.col("ts").cast("timestamp").alias("ts"), "close", "volume")
    at = F.unix_timestamp("ts")
    lo, hi = b.agg(F.min(at), F.max(at)).first()
    path, out = scratch_path(spark, "bar-slices"), scratch_path(spark, "stream-features")
    with with_rocksdb(spark):
        for i in range(3):
            part = b.filter(F.floor((at - (lo or 0)) * 3 / ((hi or 0) - (lo or 0) + 1)) == i)
            part.hint("rebalance").write.mode("append").parquet(path)
            made = stream_features(spark.readStream.schema(b.schema).parquet(path))
            scored = ST.stream_model_scores(made.na.drop(how="any", subset=FT.FEATURE_COLUMNS), model)
            ST.run_to_parquet(scored.drop("features_vec"), out + "/data", out + "/checkpoint")
    got = spark.read.parquet(out + "/data")
    return rounded(got.select("asset", "ts", *FT.FEATURE_COLUMNS, F.col("prediction").isNotNull().alias("has_prediction")))


# ---- E-01..E-08 documented-only indicators ----------------------------------------------

@query("e01_e03_extended_features", f"""
WITH b AS ({fx.bars_sql()}),
r AS (SELECT *, lag(close) OVER w AS pc,
   close / lag(close, 1) OVER w - 1 AS return_1, close / lag(close, 5) OVER w - 1 AS return_5,
   close / lag(close, 20) OVER w - 1 AS return_20, close / lag(close, 60) OVER w - 1 AS return_60,
   (high - low) / close AS hl_range, (close - open) / open AS co_spread, open / lag(close) OVER w - 1 AS overnight_gap,
   CASE WHEN count(close) OVER w10 = 10 THEN avg(close) OVER w10 END AS sma_10,
   CASE WHEN count(close) OVER w20 = 20 THEN avg(close) OVER w20 END AS sma_20,
   CASE WHEN count(close) OVER w50 = 50 THEN avg(close) OVER w50 END AS sma_50,
   CASE WHEN count(close) OVER w200 = 200 THEN avg(close) OVER w200 END AS sma_200,
   CASE WHEN count(close) OVER w20 = 20 THEN stddev_samp(close) OVER w20 END AS sd20,
   CASE WHEN count(high) OVER w14 = 14 THEN max(high) OVER w14 END AS hh,
   CASE WHEN count(low) OVER w14 = 14 THEN min(low) OVER w14 END AS ll,
   volume / lag(volume, 10) OVER w - 1 AS volume_roc_10
   FROM b WINDOW w AS (PARTITION BY asset ORDER BY ts),
     w10 AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 9 PRECEDING AND CURRENT ROW),
     w14 AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
     w20 AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
     w50 AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 49 PRECEDING AND CURRENT ROW),
     w200 AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 199 PRECEDING AND CURRENT ROW)),
t AS (SELECT *, CASE WHEN pc IS NULL THEN high - low ELSE greatest(high - low, abs(high - pc), abs(low - pc)) END AS tr,
   CASE WHEN close > pc THEN volume WHEN close < pc THEN -volume ELSE 0.0 END AS sv,
   (high + low + close) / 3 * volume AS pv FROM r),
u AS (SELECT *, CASE WHEN count(tr) OVER w14 = 14 THEN avg(tr) OVER w14 END AS atr_14,
   sum(sv) OVER wu AS obv, sum(pv) OVER wu / sum(volume) OVER wu AS vwap
   FROM t WINDOW w14 AS (PARTITION BY asset ORDER BY ts ROWS BETWEEN 13 PRECEDING AND CURRENT ROW),
     wu AS (PARTITION BY asset ORDER BY ts ROWS UNBOUNDED PRECEDING))
SELECT asset, ts, round(return_1, 6) AS return_1, round(return_5, 6) AS return_5, round(return_20, 6) AS return_20,
  round(return_60, 6) AS return_60, round(hl_range, 6) AS hl_range, round(co_spread, 6) AS co_spread,
  round(overnight_gap, 6) AS overnight_gap, round(sma_10, 6) AS sma_10, round(sma_20, 6) AS sma_20,
  round(sma_50, 6) AS sma_50, round(sma_200, 6) AS sma_200, round(sma_20 + 2 * sd20, 6) AS bb_upper,
  round(sma_20 - 2 * sd20, 6) AS bb_lower, round((close - (sma_20 - 2 * sd20)) / (4 * sd20), 6) AS bb_position,
  round(atr_14, 6) AS atr_14, round((close - ll) / (hh - ll) * 100, 6) AS stoch_k_14,
  round((hh - close) / (hh - ll) * -100, 6) AS williams_r_14, round(volume_roc_10, 6) AS volume_roc_10,
  round(obv, 6) AS obv, round(vwap, 6) AS vwap,
  round(sin(2 * pi() * ((dayofweek(ts) + 6) % 7) / 7), 6) AS dow_sin, round(cos(2 * pi() * ((dayofweek(ts) + 6) % 7) / 7), 6) AS dow_cos
FROM u""")
def e01(spark, sf):
    """E-01..E-03, E-07 (textbook definitions; the reference documents but does
    not code them)."""
    out = FT.extended_features(bars(spark, sf), gaps=False)
    cols = ["return_1", "return_5", "return_20", "return_60", "hl_range", "co_spread", "overnight_gap", "sma_10",
            "sma_20", "sma_50", "sma_200", "bb_upper", "bb_lower", "bb_position", "atr_14", "stoch_k_14",
            "williams_r_14", "volume_roc_10", "obv", "vwap", "dow_sin", "dow_cos"]
    return rounded(out.select("asset", "ts", *cols))


@query("e02_ema", f"WITH {FEATURES_CTE} SELECT asset, ts, round(ema12, 6) AS ema_12, round(ema26, 6) AS ema_26 FROM f")
def e02(spark, sf):
    out = FT.extended_features(bars(spark, sf), gaps=False)
    return rounded(out.select("asset", "ts", "ema_12", "ema_26"))


@query("e07_day_of_week_encoding", f"""
SELECT asset, ts, round(sin(2 * pi() * ((dayofweek(ts) + 6) % 7) / 7), 6) AS dow_sin,
  round(cos(2 * pi() * ((dayofweek(ts) + 6) % 7) / 7), 6) AS dow_cos FROM ({fx.bars_sql()})""")
def e07(spark, sf):
    """E-07: cyclical day-of-week encoding (Monday = 0)."""
    b = bars(spark, sf)
    return rounded(b.select("asset", "ts", *FT.day_of_week_encoding("ts")))


@query("e04_rolling_correlation", f"""
WITH {FEATURES_CTE},
x AS (SELECT a.asset AS "left", b.asset AS "right", a.ts, a.log_return AS x, b.log_return AS y
      FROM f a JOIN f b ON a.ts = b.ts AND a.asset = 'click' AND b.asset IN ('view', 'purchase')
      WHERE a.log_return IS NOT NULL AND b.log_return IS NOT NULL)
SELECT "left", "right", ts, round(CASE WHEN count(x + y) OVER w = 20 THEN corr(x, y) OVER w END, 6) AS correlation
FROM x WINDOW w AS (PARTITION BY "left", "right" ORDER BY ts ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""")
def e04(spark, sf):
    """E-04: rolling 20-row correlation for an explicit pair list."""
    lr = FT.log_returns(bars(spark, sf))
    pairs = spark.createDataFrame([("click", "view"), ("click", "purchase")], "left string, right string")
    out = FT.cross_asset_correlation(lr, pairs)
    return rounded(out.select("left", "right", "ts", "correlation"))


@query("e05_forward_fill_limit", f"""
WITH b AS ({fx.bars_sql()}), g AS (SELECT asset, ts, CASE WHEN volume >= 3 THEN volume END AS v FROM b),
f AS (SELECT asset, ts, last(v IGNORE NULLS) OVER (PARTITION BY asset ORDER BY ts ROWS BETWEEN 5 PRECEDING AND CURRENT ROW) AS v FROM g)
SELECT asset, ts, v FROM f WHERE v IS NOT NULL""")
def e05(spark, sf):
    """E-05: forward fill over at most 5 rows, then drop rows still missing
    (bars with fewer than 3 ticks have their volume blanked)."""
    b = bars(spark, sf).select("asset", "ts", F.when(F.col("volume") >= 3, F.col("volume")).alias("v"))
    return FT.forward_fill(b, ["v"], limit=5).select("asset", "ts", "v")


@query("e06_standardise_train_only", f"""
WITH {FEATURES_CTE}, sp AS (SELECT *, CASE WHEN rn < floor(n * 0.8) THEN 'train' ELSE 'test' END AS role FROM f),
st AS (SELECT asset, avg(log_return) AS mu, stddev_pop(log_return) AS sd FROM sp WHERE role = 'train' GROUP BY 1)
SELECT sp.asset, sp.ts, sp.role, round((log_return - mu) / sd, 6) AS log_return_z FROM sp JOIN st USING (asset)""")
def e06(spark, sf):
    """E-06: per asset, mean / population std from the train rows only, applied
    to train and test rows (a small per-asset stats table joined back)."""
    lr = FT.log_returns(bars(spark, sf))
    s = SP.single_train_test_split(lr, 0.8)
    stats = s.filter(F.col("role") == "train").groupBy("asset").agg(F.avg("log_return").alias("mu"),
                                                                      F.stddev_pop("log_return").alias("sd"))
    out = s.join(stats, "asset").select("asset", "ts", "role",
                                        F.try_divide(F.col("log_return") - F.col("mu"), F.col("sd")).alias("log_return_z"))
    return rounded(out)


@query("e08_cost_aware_backtest", f"""
WITH {FEATURES_CTE}, p AS (SELECT asset, ts, log_return AS prediction, target AS actual FROM f
      WHERE log_return IS NOT NULL AND target IS NOT NULL),
pq AS (SELECT *, sign(prediction) AS position FROM p),
pr AS (SELECT *, abs(position - coalesce(lag(position) OVER (PARTITION BY asset ORDER BY ts), 0)) AS turnover FROM pq)
SELECT asset, count(*) AS n, round(sum(actual * position - 0.001 * turnover), 6) AS pnl,
  round(avg(CASE WHEN actual * position - 0.001 * turnover > 0 THEN 1.0 ELSE 0.0 END), 6) AS win_rate FROM pr GROUP BY 1""")
def e08(spark, sf):
    """E-08: position = sign(prediction), pnl net of 0.1% cost per unit of
    position change, win rate per asset."""
    from ledgerline.plans.q_series import predictions
    bt = FT.position_backtest(predictions(spark, sf), cost=0.001)
    return rounded(bt.groupBy("asset").agg(F.count(F.lit(1)).alias("n"), F.sum("pnl").alias("pnl"),
                                           F.avg((F.col("pnl") > 0).cast("double")).alias("win_rate")))


@query("e06_standardise_per_fold", f"""
WITH {FEATURES_CTE},
k AS (SELECT asset, ts, rn, log_return, unnest(range(0, CAST(floor((n - 300) / 100) AS BIGINT) + 1)) AS fold
      FROM f WHERE n >= 300),
x AS (SELECT asset, ts, CAST(fold AS INTEGER) AS fold, log_return,
             CASE WHEN rn < fold * 100 + 200 THEN 'train' ELSE 'test' END AS role
      FROM k WHERE rn >= fold * 100 AND rn < fold * 100 + 300),
st AS (SELECT asset, fold, avg(log_return) AS mu, stddev_pop(log_return) AS sd FROM x WHERE role = 'train' GROUP BY 1, 2)
SELECT x.asset, x.ts, x.fold, x.role, round((log_return - mu) / sd, 6) AS log_return_z FROM x JOIN st USING (asset, fold)""")
def e06f(spark, sf):
    """E-06 on walk-forward folds: train-only statistics per (asset, fold)."""
    lr = FT.log_returns(bars(spark, sf))
    folds = SP.walk_forward_split(lr, 200, 100, 100)
    out = SP.standardize_train_only(folds, ["log_return"])
    return rounded(out.select("asset", "ts", "fold", "role", "log_return_z"))
