"""Registered queries: bars, time-series features, splits and forecast metrics.

Input fixture: hourly OHLCV bars built from ``events`` (asset = event_type), or
daily bars per user (many short series). Doubles are rounded to 6 places on
both sides of the oracle comparison.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.operators import bars as B
from ledgerline.operators import features as FT
from ledgerline.operators import metrics as M
from ledgerline.operators import splits as SP
from ledgerline.plans import fixtures as fx
from ledgerline.plans import sequence as sq
from ledgerline.plans.registry import query, rounded, sig_round, sig_round_sql

BARS = fx.bars_sql()

# DuckDB form of the per-series features (same definitions, plain windows).
FEATURES_CTE = f"""
b AS ({BARS}),
r AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) - 1 AS rn,
        count(*) OVER (PARTITION BY asset) AS n,
        CASE WHEN close > 0 AND lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END AS log_return,
        close - lag(close) OVER w AS delta
      FROM b WINDOW w AS (PARTITION BY asset ORDER BY ts)),
e AS (SELECT *,
   CASE WHEN delta > 0 THEN delta ELSE 0 END AS gain, CASE WHEN delta < 0 THEN -delta ELSE 0 END AS loss,
   pow(1-2/13, rn) * sum(CASE WHEN rn = 0 THEN close ELSE (2/13) * close END * pow(1-2/13, -rn))
       OVER (PARTITION BY asset ORDER BY rn) AS ema12,
   pow(1-2/27, rn) * sum(CASE WHEN rn = 0 THEN close ELSE (2/27) * close END * pow(1-2/27, -rn))
       OVER (PARTITION BY asset ORDER BY rn) AS ema26
   FROM r),
m AS (SELECT *, ema12 - ema26 AS macd FROM e),
s AS (SELECT *, pow(0.8, rn) * sum(CASE WHEN rn = 0 THEN macd ELSE 0.2 * macd END * pow(0.8, -rn))
       OVER (PARTITION BY asset ORDER BY rn) AS macd_signal FROM m),
f0 AS (SELECT asset, ts, rn, n, open, high, low, close, volume, log_return, ema12, ema26,
  CASE WHEN count(log_return) OVER w20 = 20 THEN stddev_samp(log_return) OVER w20 END AS volatility_20,
  CASE WHEN count(gain) OVER w14 = 14 THEN avg(gain) OVER w14 END AS g,
  CASE WHEN count(loss) OVER w14 = 14 THEN avg(loss) OVER w14 END AS l,
  macd, macd_signal, macd - macd_signal AS macd_hist,
  (volume - CASE WHEN count(volume) OVER w20 = 20 THEN avg(volume) OVER w20 END)
    / (CASE WHEN count(volume) OVER w20 = 20 THEN stddev_samp(volume) OVER w20 END + 1e-8) AS volume_zscore,
  lag(log_return, 1) OVER w AS return_lag_1, lag(log_return, 2) OVER w AS return_lag_2,
  lag(log_return, 3) OVER w AS return_lag_3, lag(log_return, 5) OVER w AS return_lag_5,
  lag(log_return, 10) OVER w AS return_lag_10,
  close / lag(close, 5) OVER w - 1 AS momentum_5, close / lag(close, 20) OVER w - 1 AS momentum_20,
  CASE WHEN close > 0 AND lead(close) OVER w > 0 THEN ln(lead(close) OVER w / close) END AS target
  FROM s WINDOW w AS (PARTITION BY asset ORDER BY rn),
    w20 AS (PARTITION BY asset ORDER BY rn ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
    w14 AS (PARTITION BY asset ORDER BY rn ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)),
f AS (SELECT *, CASE WHEN l = 0 THEN CASE WHEN g > 0 THEN 100.0 END ELSE 100 - 100 / (1 + g / l) END AS rsi_14,
        CAST(target > 0 AS INTEGER) AS target_direction FROM f0)
"""


def _r(cols):
    return ", ".join(f"round({c}, 6) AS {c}" for c in cols)


def bars(spark, sf):
    return fx.hourly_bars(spark, sf)


def features(spark, sf, horizon=1):
    return FT.build_features(bars(spark, sf), horizon=horizon, gaps=False)   # a bar has a close


def predictions(spark, sf):
    """Persistence forecast: predict the next log return with the current one.
    Complete-case mask (F-09) over the prediction and the actual."""
    f = features(spark, sf)
    return (f.select("asset", "ts", F.col("log_return").alias("prediction"), F.col("target").alias("actual"))
             .na.drop(how="any", subset=["prediction", "actual"]))


PRED_CTE = FEATURES_CTE + """,
p AS (SELECT asset, ts, log_return AS prediction, target AS actual FROM f
      WHERE log_return IS NOT NULL AND target IS NOT NULL)
"""

# ---- A: bars and time-bucket aggregates --------------------------------------


@query("a01_ohlcv_bars", f"SELECT asset, ts, open, high, low, close, volume FROM ({BARS})")
def a01(spark, sf):
    return bars(spark, sf)


@query("a02_last_per_day", """
SELECT event_type, date_trunc('day', ts) AS period, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY 1, 2""")
def a02(spark, sf):
    return B.last_per_period(fx.table(spark, sf, "events"), "event_type", "ts", "value", "day", "event_id")


@query("a03_weekly_friday_last", """
SELECT event_type, CAST(CAST(ts AS DATE) + CAST((5 - dayofweek(ts) + 7) % 7 AS INTEGER) AS TIMESTAMP) AS week_end,
       arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY 1, 2""")
def a03(spark, sf):
    out = B.weekly_last(fx.table(spark, sf, "events"), "event_type", "ts", "value", "event_id")
    return out.withColumn("week_end", F.col("week_end").cast("timestamp_ntz"))


@query("a04_month_end_totals", """
WITH m AS (SELECT last_day(CAST(o_orderdate AS DATE)) AS month_end, sum(o_totalprice) AS o_totalprice,
                  count(*) AS n_orders FROM orders GROUP BY 1),
cal AS (SELECT last_day(CAST(unnest(generate_series(min(month_end) - INTERVAL 27 DAY, max(month_end),
                INTERVAL 1 MONTH)) AS DATE)) AS month_end FROM m)
SELECT CAST(cal.month_end AS TIMESTAMP) AS month_end, round(coalesce(m.o_totalprice, 0.0), 2) AS o_totalprice,
       CAST(coalesce(m.n_orders, 0) AS BIGINT) AS n_orders
FROM cal LEFT JOIN m USING (month_end)""")
def a04(spark, sf):
    out = B.month_end_totals(fx.table(spark, sf, "orders"), "o_orderdate", ["o_totalprice"], count_name="n_orders")
    return rounded(out, money=("o_totalprice",)).withColumn("month_end", F.col("month_end").cast("timestamp_ntz"))


@query("a05_month_end_totals_per_key", """
WITH m AS (SELECT o_custkey, last_day(CAST(o_orderdate AS DATE)) AS month_end, sum(o_totalprice) AS o_totalprice,
                  count(*) AS n_orders FROM orders GROUP BY 1, 2),
b AS (SELECT o_custkey, min(month_end) AS lo, max(month_end) AS hi FROM m GROUP BY 1),
cal AS (SELECT o_custkey, last_day(CAST(unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH))
               AS DATE)) AS month_end FROM b)
SELECT cal.o_custkey, CAST(cal.month_end AS TIMESTAMP) AS month_end, round(coalesce(m.o_totalprice, 0.0), 2) AS o_totalprice,
       CAST(coalesce(m.n_orders, 0) AS BIGINT) AS n_orders
FROM cal LEFT JOIN m USING (o_custkey, month_end)""")
def a05(spark, sf):
    out = B.month_end_totals(fx.table(spark, sf, "orders"), "o_orderdate", ["o_totalprice"], key=["o_custkey"],
                             count_name="n_orders")
    return rounded(out, money=("o_totalprice",)).withColumn("month_end", F.col("month_end").cast("timestamp_ntz"))


@query("a06_daily_mean_count", """
SELECT date_trunc('day', ts) AS day, round(avg(value), 6) AS mean_value, count(*) AS n_events
FROM events GROUP BY 1""")
def a06(spark, sf):
    ev = fx.table(spark, sf, "events")
    return rounded(B.mean_count(ev, [F.date_trunc("day", "ts").alias("day")], "value", "mean_value", "n_events"))


@query("a07_daily_mean_count_by_key", """
SELECT date_trunc('day', ts) AS day, event_type, round(avg(value), 6) AS mean_value, count(*) AS n_events
FROM events GROUP BY 1, 2""")
def a07(spark, sf):
    ev = fx.table(spark, sf, "events")
    return rounded(B.mean_count(ev, [F.date_trunc("day", "ts").alias("day"), "event_type"], "value", "mean_value", "n_events"))


@query("a08_mean_over_divisions", """
WITH d AS (SELECT date_trunc('month', ts) AS month, user_id,
                  avg(CASE WHEN event_type <> 'error' THEN value END) AS v FROM events GROUP BY 1, 2)
SELECT month, round(avg(v), 6) AS national_mean, count(v) AS divisions FROM d GROUP BY 1""")
def a08(spark, sf):
    """Monthly value per division (user; 'error' events are missing data), then the
    mean over divisions ignoring missing ones."""
    ev = fx.table(spark, sf, "events")
    d = ev.groupBy(F.date_trunc("month", "ts").alias("month"), "user_id").agg(
        F.avg(F.when(F.col("event_type") != "error", F.col("value"))).alias("v"))
    return rounded(d.groupBy("month").agg(F.avg("v").alias("national_mean"), F.count("v").alias("divisions")))


@query("a13_extent", f"""
SELECT asset, min(ts) AS first_ts, max(ts) AS last_ts,
       round(datediff('day', min(ts), max(ts)) / 365.25, 6) AS years
FROM ({BARS}) GROUP BY 1""")
def a13(spark, sf):
    b = bars(spark, sf)
    return rounded(b.groupBy("asset").agg(F.min("ts").alias("first_ts"), F.max("ts").alias("last_ts"),
                                          (F.datediff(F.max("ts"), F.min("ts")) / 365.25).alias("years")))


@query("a14_dataset_stats", f"""
WITH {FEATURES_CTE}, c AS (SELECT * FROM f WHERE {" AND ".join(c + " IS NOT NULL" for c in FT.FEATURE_COLUMNS)}
                           AND target IS NOT NULL)
SELECT count(*) AS n_rows, 14 AS n_features, round(avg(target), 6) AS target_mean,
       round(stddev_samp(target), 6) AS target_std FROM c""")
def a14(spark, sf):
    f = features(spark, sf).na.drop(how="any", subset=FT.FEATURE_COLUMNS + ["target"])
    return rounded(f.agg(F.count(F.lit(1)).alias("n_rows"), F.lit(len(FT.FEATURE_COLUMNS)).alias("n_features"),
                         F.avg("target").alias("target_mean"), F.stddev_samp("target").alias("target_std")))


# ---- W: windows --------------------------------------------------------------

def _feature_query(cols):
    return f"WITH {FEATURES_CTE} SELECT asset, ts, {_r(cols)} FROM f"


@query("w01_log_return", _feature_query(["log_return"]))
def w01(spark, sf):
    return rounded(FT.log_returns(bars(spark, sf)).select("asset", "ts", "log_return"))


@query("w02_rolling_volatility", _feature_query(["volatility_20"]))
def w02(spark, sf):
    return rounded(FT.rolling_volatility(bars(spark, sf), window=20, out="volatility_20")
                   .select("asset", "ts", "volatility_20"))


@query("w03_rsi", _feature_query(["rsi_14"]))
def w03(spark, sf):
    return rounded(FT.rsi(bars(spark, sf), window=14, out="rsi_14").select("asset", "ts", "rsi_14"))


@query("w04_ewm_mean", f"WITH {FEATURES_CTE} SELECT asset, ts, round(ema12, 6) AS ema_12 FROM f")
def w04(spark, sf):
    return rounded(FT.ewm_mean(bars(spark, sf), "close", 12, out="ema_12", gaps=False).select("asset", "ts", "ema_12"))


@query("w04_ewm_mean_gaps", f"""
WITH b AS ({BARS}), r AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) - 1 AS rn FROM b),
o AS (SELECT asset, rn, close AS x, pow(1 - 2/13, rn - lag(rn) OVER w) AS d FROM r WHERE volume % 3 <> 0
      WINDOW w AS (PARTITION BY asset ORDER BY rn)),
k AS (SELECT *, d / (d + 2/13) AS k FROM o),
c AS (SELECT *, coalesce(sum(ln(k)) OVER (PARTITION BY asset ORDER BY rn), 0) AS c FROM k),
y AS (SELECT asset, rn, exp(c) * sum(CASE WHEN k IS NULL THEN x ELSE (1 - k) * x END * exp(-c))
      OVER (PARTITION BY asset ORDER BY rn) AS y FROM c)
SELECT r.asset, r.ts, round(last_value(y.y IGNORE NULLS) OVER (PARTITION BY r.asset ORDER BY r.rn), 6) AS ema_12
FROM r LEFT JOIN y ON y.asset = r.asset AND y.rn = r.rn""")
def w04_gaps(spark, sf):
    """W-04 over missing values: the close counts only where the volume isn't a multiple of 3."""
    b = bars(spark, sf).withColumn("close", F.when(F.col("volume") % 3 != 0, F.col("close")))
    return rounded(FT.ewm_mean(b, "close", 12, out="ema_12").select("asset", "ts", "ema_12"))


@query("w05_macd", _feature_query(["macd", "macd_signal", "macd_hist"]))
def w05(spark, sf):
    return rounded(FT.macd(bars(spark, sf), gaps=False).select("asset", "ts", "macd", "macd_signal", "macd_hist"))


@query("w06_volume_zscore", _feature_query(["volume_zscore"]))
def w06(spark, sf):
    return rounded(FT.volume_zscore(bars(spark, sf)).select("asset", "ts", "volume_zscore"))


@query("w07_lag_returns", _feature_query([f"return_lag_{k}" for k in FT.RETURN_LAGS]))
def w07(spark, sf):
    return rounded(FT.lag_returns(bars(spark, sf)).select("asset", "ts", *[f"return_lag_{k}" for k in FT.RETURN_LAGS]))


@query("w08_momentum", _feature_query(["momentum_5", "momentum_20"]))
def w08(spark, sf):
    return rounded(features(spark, sf, horizon=None).select("asset", "ts", "momentum_5", "momentum_20"))


@query("w09_build_features", _feature_query(FT.FEATURE_COLUMNS))
def w09(spark, sf):
    return rounded(features(spark, sf, horizon=None).select("asset", "ts", *FT.FEATURE_COLUMNS))


@query("w10_target", _feature_query(["target"]))
def w10(spark, sf):
    return rounded(FT.make_target(bars(spark, sf), horizon=1).select("asset", "ts", "target"))


@query("w11_direction_target", f"WITH {FEATURES_CTE} SELECT asset, ts, target_direction FROM f")
def w11(spark, sf):
    return FT.make_target(bars(spark, sf), horizon=1, direction=True).select("asset", "ts", "target_direction")


@query("j10_features_with_target", _feature_query(FT.FEATURE_COLUMNS + ["target"]))
def j10(spark, sf):
    """J-10: features and target of the same row are columns of one select: no join."""
    return rounded(features(spark, sf, horizon=1).select("asset", "ts", *FT.FEATURE_COLUMNS, "target"))


@query("w12_first_difference", f"""
SELECT asset, ts, volume - lag(volume) OVER (PARTITION BY asset ORDER BY ts) AS volume_change FROM ({BARS})""")
def w12(spark, sf):
    return FT.first_difference(bars(spark, sf), "volume").select("asset", "ts", "volume_change")


@query("w13_example_features", f"""
WITH b AS ({BARS}),
r AS (SELECT *, row_number() OVER w - 1 AS rn, close / lag(close, 1) OVER w - 1 AS returns_1d,
      close / lag(close, 5) OVER w - 1 AS returns_5d, close / lag(close, 20) OVER w - 1 AS returns_20d,
      close - lag(close) OVER w AS delta
      FROM b WINDOW w AS (PARTITION BY asset ORDER BY ts)),
e AS (SELECT *, CASE WHEN delta > 0 THEN delta ELSE 0 END AS gain, CASE WHEN delta < 0 THEN -delta ELSE 0 END AS loss,
   sum(close * pow(1-2/13, -rn)) OVER (PARTITION BY asset ORDER BY rn) * pow(1-2/13, rn)
     * (2/13) / (1 - pow(1-2/13, rn + 1)) AS ema12,
   sum(close * pow(1-2/27, -rn)) OVER (PARTITION BY asset ORDER BY rn) * pow(1-2/27, rn)
     * (2/27) / (1 - pow(1-2/27, rn + 1)) AS ema26
   FROM r),
m AS (SELECT *, ema12 - ema26 AS macd FROM e),
s AS (SELECT *, sum(macd * pow(0.8, -rn)) OVER (PARTITION BY asset ORDER BY rn) * pow(0.8, rn)
        * 0.2 / (1 - pow(0.8, rn + 1)) AS macd_signal FROM m),
f AS (SELECT asset, ts, returns_1d, returns_5d, returns_20d,
   volume / CASE WHEN count(volume) OVER w20 = 20 THEN avg(volume) OVER w20 END AS volume_ratio,
   CASE WHEN count(returns_1d) OVER w20 = 20 THEN stddev_samp(returns_1d) OVER w20 END AS volatility_20d,
   CASE WHEN count(gain) OVER w14 = 14 THEN avg(gain) OVER w14 END AS g,
   CASE WHEN count(loss) OVER w14 = 14 THEN avg(loss) OVER w14 END AS l, macd, macd_signal
   FROM s WINDOW w20 AS (PARTITION BY asset ORDER BY rn ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
                 w14 AS (PARTITION BY asset ORDER BY rn ROWS BETWEEN 13 PRECEDING AND CURRENT ROW))
SELECT asset, ts, {_r(["returns_1d", "returns_5d", "returns_20d", "volume_ratio", "volatility_20d"])},
  round(CASE WHEN l = 0 THEN CASE WHEN g > 0 THEN 100.0 END ELSE 100 - 100 / (1 + g / l) END, 6) AS rsi,
  round(macd, 6) AS macd, round(macd_signal, 6) AS macd_signal FROM f
WHERE returns_1d IS NOT NULL AND returns_5d IS NOT NULL AND returns_20d IS NOT NULL AND volume_ratio IS NOT NULL
  AND volatility_20d IS NOT NULL AND macd IS NOT NULL AND macd_signal IS NOT NULL
  AND (CASE WHEN l = 0 THEN CASE WHEN g > 0 THEN 100.0 END ELSE 100 - 100 / (1 + g / l) END) IS NOT NULL""")
def w13(spark, sf):
    out = FT.example_features(bars(spark, sf))
    return rounded(out.select("asset", "ts", "returns_1d", "returns_5d", "returns_20d", "volume_ratio",
                              "volatility_20d", "rsi", "macd", "macd_signal"))


@query("w14_w15_cumulative_drawdown", f"""
WITH {FEATURES_CTE},
c AS (SELECT asset, ts, product(1 + log_return * 0.01) OVER (PARTITION BY asset ORDER BY ts) AS cumulative FROM f),
d AS (SELECT *, max(cumulative) OVER (PARTITION BY asset ORDER BY ts) AS running_max FROM c)
SELECT asset, ts, round(cumulative, 6) AS cumulative, round(running_max, 6) AS running_max,
       round((cumulative - running_max) / running_max, 6) AS drawdown FROM d""")
def w14(spark, sf):
    """W-14 / W-15 on returns r = log_return / 100 (the NULL first return is
    skipped, like cumprod)."""
    lr = FT.log_returns(bars(spark, sf)).withColumn("r", F.col("log_return") * 0.01)
    out = FT.cumulative_curve(lr, "r", "asset", "ts")
    return rounded(out.select("asset", "ts", "cumulative", "running_max", "drawdown"))


@query("w16_weekly_bull_bear", """
WITH w AS (SELECT event_type AS asset, CAST(CAST(ts AS DATE) + CAST((5 - dayofweek(ts) + 7) % 7 AS INTEGER) AS TIMESTAMP) AS week_end,
                  arg_max(value, (ts, event_id)) AS close FROM events GROUP BY 1, 2),
r AS (SELECT *, close / lag(close) OVER (PARTITION BY asset ORDER BY week_end) - 1 AS weekly_return FROM w)
SELECT asset, week_end, round(weekly_return, 6) AS weekly_return,
  CAST(CASE WHEN coalesce(weekly_return >= 0, false) THEN 60.0 ELSE 40.0 END AS DOUBLE) AS bullish,
  CAST(CASE WHEN coalesce(weekly_return >= 0, false) THEN 40.0 ELSE 60.0 END AS DOUBLE) AS bearish,
  CAST(0.0 AS DOUBLE) AS neutral,
  CAST(CASE WHEN coalesce(weekly_return >= 0, false) THEN 20.0 ELSE -20.0 END AS DOUBLE) AS bull_bear_spread FROM r""")
def w16(spark, sf):
    weekly = B.weekly_last(fx.table(spark, sf, "events"), "event_type", "ts", "value", "event_id")
    weekly = (weekly.withColumnRenamed("event_type", "asset").withColumnRenamed("value", "close")
                    .withColumn("week_end", F.col("week_end").cast("timestamp_ntz")))
    out = FT.weekly_bull_bear(weekly, ts="week_end")
    return rounded(out.select("asset", "week_end", "weekly_return", "bullish", "bearish", "neutral",
                              "bull_bear_spread"))


@query("w17_keep_first_dedupe", """
SELECT user_id, event_type, arg_min(event_id, (ts, event_id)) AS event_id, min(ts) AS ts,
       arg_min(value, (ts, event_id)) AS value
FROM events GROUP BY 1, 2""")
def w17(spark, sf):
    from ledgerline.operators.reshape import keep_first
    ev = fx.table(spark, sf, "events").select("user_id", "event_type", "event_id", "ts", "value")
    return keep_first(ev, ["user_id", "event_type"], ["ts", "event_id"])


@query("w18_latest_per_key", """
SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts,
       arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value
FROM events GROUP BY 1""")
def w18(spark, sf):
    from ledgerline.operators.reshape import latest
    ev = fx.table(spark, sf, "events").select("user_id", "event_id", "ts", "event_type", "value")
    return latest(ev, ["user_id"], ["ts", "event_id"])


@query("w19_latest_feature_row", f"""
WITH {FEATURES_CTE}, l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY asset ORDER BY ts DESC) = 1)
SELECT asset, ts, {_r(FT.FEATURE_COLUMNS)} FROM l""")
def w19(spark, sf):
    from ledgerline.operators.reshape import latest
    f = features(spark, sf, horizon=None).select("asset", "ts", *FT.FEATURE_COLUMNS)
    return rounded(latest(f, ["asset"], ["ts"]))


# ---- M: splits ---------------------------------------------------------------

@query("m01_walk_forward_split", f"""
WITH {FEATURES_CTE}, k AS (SELECT asset, ts, rn, n, unnest(range(0, CAST(floor((n - 300) / 100) AS BIGINT) + 1)) AS fold
                           FROM f WHERE n >= 300)
SELECT asset, ts, CAST(fold AS INTEGER) AS fold, CASE WHEN rn < fold * 100 + 200 THEN 'train' ELSE 'test' END AS role
FROM k WHERE rn >= fold * 100 AND rn < fold * 100 + 300""")
def m01(spark, sf):
    return SP.walk_forward_split(bars(spark, sf), 200, 100, 100).select("asset", "ts", "fold", "role")


@query("m02_expanding_window_split", f"""
WITH {FEATURES_CTE}, k AS (SELECT asset, ts, rn, n, unnest(range(0, CAST(floor((n - 400) / 50) AS BIGINT) + 1)) AS fold
                           FROM f WHERE n >= 400)
SELECT asset, ts, CAST(fold AS INTEGER) AS fold, CASE WHEN rn < 300 + fold * 50 THEN 'train' ELSE 'test' END AS role
FROM k WHERE rn < 300 + fold * 50 + 100""")
def m02(spark, sf):
    return SP.expanding_window_split(bars(spark, sf), 300, 100, 50).select("asset", "ts", "fold", "role")


@query("m02_expanding_fold_stats", f"""
WITH {FEATURES_CTE}, g AS (SELECT DISTINCT asset, n, unnest(range(0, CAST(floor((n - 400) / 50) AS BIGINT) + 1)) AS fold
                           FROM f WHERE n >= 400),
k AS (SELECT g.asset, g.fold, f.close, f.rn < 300 + g.fold * 50 AS train FROM g JOIN f ON f.asset = g.asset
      AND f.rn < 400 + g.fold * 50)
SELECT asset, CAST(fold AS INTEGER) AS fold, CAST(300 + fold * 50 AS INTEGER) AS train_end,
  CAST(400 + fold * 50 AS INTEGER) AS test_end,
  count(close) FILTER (WHERE train) AS train_size, round(avg(close) FILTER (WHERE train), 6) AS train_mean,
  round(stddev_pop(close) FILTER (WHERE train), 6) AS train_std,
  count(close) FILTER (WHERE NOT train) AS test_size, round(avg(close) FILTER (WHERE NOT train), 6) AS test_mean,
  round(stddev_pop(close) FILTER (WHERE NOT train), 6) AS test_std
FROM k GROUP BY asset, fold""")
def m02_stats(spark, sf):
    """M-02: bounds and train / test statistics of each expanding fold, linear in the rows."""
    return rounded(SP.expanding_fold_stats(bars(spark, sf), "close", 300, 100, 50))


@query("m03_single_split", f"""
WITH {FEATURES_CTE}
SELECT asset, ts, CASE WHEN rn < floor(n * 0.8) THEN 'train' ELSE 'test' END AS role FROM f""")
def m03(spark, sf):
    return SP.single_train_test_split(bars(spark, sf), 0.8).select("asset", "ts", "role")


@query("m07_fold_sizes", f"""
WITH {FEATURES_CTE}, k AS (SELECT asset, ts, rn, n, unnest(range(0, CAST(floor((n - 300) / 100) AS BIGINT) + 1)) AS fold
                           FROM f WHERE n >= 300),
x AS (SELECT fold, CASE WHEN rn < fold * 100 + 200 THEN 'train' ELSE 'test' END AS role
      FROM k WHERE rn >= fold * 100 AND rn < fold * 100 + 300)
SELECT CAST(fold AS INTEGER) AS fold, count(*) FILTER (WHERE role = 'train') AS train_size,
       count(*) FILTER (WHERE role = 'test') AS test_size
FROM x GROUP BY fold HAVING train_size >= 50 AND test_size >= 10""")
def m07(spark, sf):
    folds = SP.walk_forward_split(bars(spark, sf), 200, 100, 100)
    return SP.fold_sizes(SP.usable_folds(folds, 50, 10))


# ---- M: forecast metrics -----------------------------------------------------

def _metrics_sql(group: list[str], order: str, ctes: str | None = None, rows: str = "p") -> str:
    g = ", ".join(group)
    gsel = (g + ", ") if group else ""
    part = f"PARTITION BY {g}" if group else ""
    return f"""
WITH {ctes or PRED_CTE},
q AS (SELECT {gsel} ts, asset, prediction AS p, actual AS y, actual * sign(prediction) AS r FROM {rows}),
c AS (SELECT *, product(1 + r) OVER ({part} ORDER BY {order}) AS cum FROM q),
d AS (SELECT *, (cum - max(cum) OVER ({part} ORDER BY {order})) / max(cum) OVER ({part} ORDER BY {order}) AS dd FROM c),
a AS (SELECT {gsel} count(*) AS n, avg(abs(y - p)) AS mae, sqrt(avg((y - p) * (y - p))) AS rmse,
   CASE WHEN sum(CASE WHEN y = 0 THEN 1 ELSE 0 END) = 0 THEN avg(abs((y - p) / y)) * 100 END AS mape,
   avg(CASE WHEN sign(y) = sign(p) THEN 1.0 ELSE 0.0 END) AS direction_accuracy,
   avg(CASE WHEN sign(y) = sign(p) THEN 1.0 ELSE 0.0 END) * 100 AS hit_rate,
   CASE WHEN stddev_pop(r) = 0 OR stddev_pop(r) IS NULL THEN 0.0 ELSE avg(r) / stddev_pop(r) * sqrt(252) END AS sharpe_ratio,
   CASE WHEN count(CASE WHEN r < 0 THEN r END) = 0 OR stddev_pop(CASE WHEN r < 0 THEN r END) = 0 THEN 0.0
        ELSE avg(r) / stddev_pop(CASE WHEN r < 0 THEN r END) * sqrt(252) END AS sortino_ratio,
   coalesce(sum(CASE WHEN r > 0 THEN r END), 0) AS gains, abs(coalesce(sum(CASE WHEN r < 0 THEN r END), 0)) AS losses,
   coalesce(min(dd) * 100, 0.0) AS max_drawdown, arg_max(cum, ({order})) AS last_cum
   FROM d {"GROUP BY " + g if group else ""})
SELECT {gsel} n, {_r(["mae", "rmse", "mape", "direction_accuracy", "hit_rate", "sharpe_ratio", "sortino_ratio"])},
  round(CASE WHEN losses = 0 THEN CASE WHEN gains > 0 THEN 'Infinity'::DOUBLE ELSE 0.0 END ELSE gains / losses END, 6)
    AS profit_factor,
  round(max_drawdown, 6) AS max_drawdown,
  {sig_round_sql("CASE WHEN abs(max_drawdown) = 0 THEN 0.0 ELSE CASE WHEN last_cum < 0 THEN NULL ELSE (pow(last_cum, 252.0 / n) - 1) * 100 / abs(max_drawdown) END END")}
    AS calmar_ratio,
  {sig_round_sql("(last_cum - 1) * 100")} AS total_return
FROM a"""


def _sig(df):
    """Compounded quantities span many decades: 9 significant digits."""
    return df.withColumns({c: sig_round(c) for c in ("calmar_ratio", "total_return") if c in df.columns})


@query("m20_metrics_per_asset", _metrics_sql(["asset"], "ts"))
def m20(spark, sf):
    return _sig(rounded(M.all_metrics(predictions(spark, sf), group=["asset"], order=("ts",)),
                        keep=("calmar_ratio", "total_return")))


@query("m20_metrics_pooled", _metrics_sql([], "ts, asset"))
def m20p(spark, sf):
    """Pooled over all assets: one curve ordered by (ts, asset)."""
    return _sig(rounded(M.all_metrics(predictions(spark, sf), group=[], order=("ts", "asset")),
                        keep=("calmar_ratio", "total_return")))


def _fold_metrics_sql():
    """The metrics of every fold, from the same SQL as those of an asset."""
    folds = f"""{PRED_CTE},
i AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) - 1 AS rn, count(*) OVER (PARTITION BY asset) AS n FROM p),
k AS (SELECT *, unnest(range(0, CAST(floor((n - 300) / 100) AS BIGINT) + 1)) AS fold FROM i WHERE n >= 300),
pf AS (SELECT asset, ts, CAST(fold AS INTEGER) AS fold, prediction, actual
       FROM k WHERE rn >= fold * 100 + 200 AND rn < fold * 100 + 300)"""
    return _metrics_sql(["fold"], "ts, asset", ctes=folds, rows="pf")


@query("m08_backtest_fold_metrics", _fold_metrics_sql())
def m08(spark, sf):
    """M-08: walk-forward backtest of the persistence forecast; all metrics per fold on
    the test rows, all folds of all assets in one job."""
    folds = SP.walk_forward_split(predictions(spark, sf), 200, 100, 100)
    test = folds.filter(F.col("role") == "test")
    return _sig(rounded(M.all_metrics(test, group=["fold"], order=("ts", "asset")), keep=("calmar_ratio", "total_return")))


@query("m26_batch_forecast_top10", f"""
WITH {FEATURES_CTE}, l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY asset ORDER BY ts DESC) = 1)
SELECT asset AS ticker, round(close, 6) AS current_price, round(log_return, 6) AS predicted_return,
       round(close * (1 + log_return), 6) AS predicted_price
FROM l ORDER BY log_return DESC NULLS LAST, asset LIMIT 10""")
def m26(spark, sf):
    from ledgerline.operators.models import batch_forecast
    f = features(spark, sf, horizon=None)
    return rounded(batch_forecast(f, "log_return", key="asset", ts="ts", top=10))


@query("j11_portfolio_contribution", f"""
WITH {FEATURES_CTE},
l AS (SELECT * FROM f QUALIFY row_number() OVER (PARTITION BY asset ORDER BY ts DESC) = 1),
w AS (SELECT asset, sum(volume) / sum(sum(volume)) OVER () AS weight FROM b GROUP BY asset)
SELECT l.asset, round(w.weight, 6) AS weight, round(l.log_return, 6) AS predicted_return,
       round(l.log_return * w.weight, 6) AS contribution,
       round(sum(l.log_return * w.weight) OVER (), 6) AS portfolio_return
FROM l JOIN w USING (asset)""")
def j11(spark, sf):
    from ledgerline.operators.models import portfolio_forecast
    b = bars(spark, sf)
    per = b.groupBy("asset").agg(F.sum("volume").alias("_v"))
    weights = per.select("asset", (F.col("_v") / per.select(F.sum("_v")).scalar()).alias("weight"))
    f = features(spark, sf, horizon=None)
    return rounded(portfolio_forecast(f, weights, "log_return", key="asset", ts="ts"))


# ---- M-10..M-19 one metric per query (same pipeline, the metric's columns) ---------

def _metric_query(name, cols, doc):
    sql = f"SELECT asset, {', '.join(cols)} FROM ({_metrics_sql(['asset'], 'ts')})"

    def fn(spark, sf):
        of_curve = {"max_drawdown", "calmar_ratio", "total_return"} & set(cols)
        metrics = M.curve_metrics if of_curve else M.order_free_metrics
        m = metrics(predictions(spark, sf), group=["asset"]).select("asset", *cols)
        return _sig(rounded(m, keep=("calmar_ratio", "total_return")))
    fn.__doc__ = doc
    query(name, sql)(fn)


_metric_query("m10_mae", ["mae"], "M-10: mean absolute error per asset.")
_metric_query("m11_rmse", ["rmse"], "M-11: root mean squared error per asset.")
_metric_query("m12_mape", ["mape"], "M-12: MAPE (NULL when an actual is 0) per asset.")
_metric_query("m13_direction_accuracy", ["direction_accuracy", "hit_rate"], "M-13: sign agreement share and %.")
_metric_query("m14_sharpe", ["sharpe_ratio"], "M-14: annualised Sharpe with population std.")
_metric_query("m15_sortino", ["sortino_ratio"], "M-15: annualised Sortino (population std of losses).")
_metric_query("m16_max_drawdown", ["max_drawdown"], "M-16: maximum drawdown of the compounded curve, in %.")
_metric_query("m17_calmar", ["calmar_ratio"], "M-17: Calmar ratio.")
_metric_query("m18_profit_factor", ["profit_factor"], "M-18: gains / |losses| (Infinity without losses).")


@query("m19_strategy_returns", f"""
WITH {PRED_CTE}, q AS (SELECT asset, ts, actual * sign(prediction) AS strategy_return FROM p)
SELECT asset, ts, round(strategy_return, 6) AS strategy_return,
  {sig_round_sql("(product(1 + strategy_return) OVER (PARTITION BY asset ORDER BY ts) - 1) * 100")} AS total_return FROM q""")
def m19(spark, sf):
    """M-19: strategy return y * sign(prediction) per row and the running total
    return (compounded, in %) — the two-level chunk scan, not one big window."""
    p = predictions(spark, sf).withColumn("strategy_return", F.col("actual") * F.signum("prediction"))
    c = FT.cumulative_curve(p, "strategy_return", "asset", "ts")
    out = c.select("asset", "ts", "strategy_return", ((F.col("cumulative") - 1) * 100).alias("total_return"))
    return _sig(rounded(out, keep=("total_return",)))


@query("f09_complete_cases", f"""
WITH {FEATURES_CTE} SELECT asset, ts FROM f WHERE {" AND ".join(c + " IS NOT NULL" for c in FT.FEATURE_COLUMNS)}
  AND target IS NOT NULL""")
def f09(spark, sf):
    """F-09: rows with every feature and the target present."""
    from ledgerline.operators.clean import complete_cases
    return complete_cases(features(spark, sf), FT.FEATURE_COLUMNS + ["target"]).select("asset", "ts")


@query("m04_temporal_order_check", """
WITH p AS (SELECT event_type AS asset, ts, lag(ts) OVER (PARTITION BY event_type ORDER BY event_id) AS before FROM events)
SELECT asset, count(*) AS n, count(*) FILTER (WHERE before > ts) AS out_of_order FROM p GROUP BY 1""")
def m04(spark, sf):
    """M-04: the order column must be temporal (checked on the schema, raises
    otherwise); rows earlier than the one before them in input order (by
    ``event_id``) are counted per series."""
    ev = fx.table(spark, sf, "events").withColumnRenamed("event_type", "asset")
    return SP.temporal_disorder(ev, "ts", "event_id")


@query("m04_input_disorder", """
WITH p AS (SELECT o_orderpriority AS asset, o_orderdate AS ts,
  lag(o_orderdate) OVER (PARTITION BY o_orderpriority ORDER BY o_orderkey) AS before FROM orders)
SELECT asset, count(*) AS n, count(*) FILTER (WHERE before > ts) AS out_of_order FROM p GROUP BY 1""")
def m04_orders(spark, sf):
    """M-04 on a table that isn't in time order: orders by key within a priority."""
    o = fx.table(spark, sf, "orders").select(F.col("o_orderpriority").alias("asset"), F.col("o_orderdate").alias("ts"),
                                             "o_orderkey")
    return SP.temporal_disorder(o, "ts", "o_orderkey")


@query("m08_backtest_predictions", f"""
WITH {PRED_CTE},
i AS (SELECT *, row_number() OVER (PARTITION BY asset ORDER BY ts) - 1 AS rn, count(*) OVER (PARTITION BY asset) AS n FROM p),
k AS (SELECT *, unnest(range(0, CAST(floor((n - 300) / 100) AS BIGINT) + 1)) AS fold FROM i WHERE n >= 300)
SELECT asset, CAST(fold AS INTEGER) AS fold, ts, round(prediction, 6) AS prediction, round(actual, 6) AS actual,
  CAST(prediction > 0 AS INTEGER) AS pred_direction, CAST(actual > 0 AS INTEGER) AS actual_direction
FROM k WHERE rn >= fold * 100 + 200 AND rn < fold * 100 + 300""")
def m08p(spark, sf):
    """M-08: the backtest prediction table (test rows of every walk-forward fold)
    with predicted and actual directions."""
    folds = SP.walk_forward_split(predictions(spark, sf), 200, 100, 100).filter(F.col("role") == "test")
    out = folds.select("asset", "fold", "ts", "prediction", "actual",
                       (F.col("prediction") > 0).cast("int").alias("pred_direction"),
                       (F.col("actual") > 0).cast("int").alias("actual_direction"))
    return rounded(out)
