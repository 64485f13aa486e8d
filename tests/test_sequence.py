"""Chunked series plan: results must not depend on the chunk size, and must
equal straightforward pandas formulas (written here from the definitions)."""
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import features as FT
from ledgerline.plans import sequence as sq


def _series(spark, n=2500, assets=("a", "b"), seed=7):
    rng = np.random.default_rng(seed)
    rows = []
    for a in assets:
        p = 100 + np.cumsum(rng.normal(0, 1, n))
        v = rng.uniform(1, 100, n)
        ts = pd.date_range("2020-01-01", periods=n, freq="h")
        for i in range(n):
            rows.append((a, ts[i].to_pydatetime(), float(p[i]), float(p[i]) + 1, float(p[i]) - 1, float(p[i]), float(v[i])))
    return spark.createDataFrame(rows, "asset string, ts timestamp_ntz, open double, high double, low double, "
                                       "close double, volume double")


@pytest.fixture(scope="module")
def series(spark):
    return _series(spark)


def _pdf(df, cols):
    return df.select("asset", "ts", *cols).toPandas().sort_values(["asset", "ts"]).reset_index(drop=True)


def test_row_index_is_dense_per_key(spark, series):
    ix = sq.with_row_index(series, "asset", ["ts"], num_ranges=7).toPandas()
    for a, g in ix.groupby("asset"):
        g = g.sort_values("ts")
        assert list(g["rn"]) == list(range(len(g)))
        assert (g["n"] == len(g)).all()


def test_features_independent_of_chunk_size(spark, series):
    big = _pdf(FT.build_features(series, horizon=1), FT.FEATURE_COLUMNS + ["target"])
    small = _pdf(FT.build_features(series, horizon=1, chunk_rows=900), FT.FEATURE_COLUMNS + ["target"])
    pd.testing.assert_frame_equal(big, small, rtol=1e-9, atol=1e-9)


def test_features_match_pandas(spark, series):
    out = _pdf(FT.build_features(series, horizon=1, chunk_rows=1024), FT.FEATURE_COLUMNS + ["target"])
    src = series.toPandas().sort_values(["asset", "ts"]).reset_index(drop=True)
    exp = []
    for a, g in src.groupby("asset", sort=True):
        c, v = g["close"], g["volume"]
        lr = np.log(c / c.shift(1))
        d = c.diff()
        gain = d.where(d > 0, 0).rolling(14).mean()
        loss = (-d.where(d < 0, 0)).rolling(14).mean()
        e12 = c.ewm(span=12, adjust=False).mean()
        e26 = c.ewm(span=26, adjust=False).mean()
        m = e12 - e26
        s = m.ewm(span=9, adjust=False).mean()
        exp.append(pd.DataFrame({
            "asset": a, "ts": g["ts"], "log_return": lr, "volatility_20": lr.rolling(20).std(),
            "rsi_14": 100 - 100 / (1 + gain / loss), "macd": m, "macd_signal": s, "macd_hist": m - s,
            "volume_zscore": (v - v.rolling(20).mean()) / (v.rolling(20).std() + 1e-8),
            **{f"return_lag_{k}": lr.shift(k) for k in (1, 2, 3, 5, 10)},
            "momentum_5": c.pct_change(5), "momentum_20": c.pct_change(20),
            "target": np.log(c.shift(-1) / c)}))
    exp = pd.concat(exp).reset_index(drop=True)
    for col in FT.FEATURE_COLUMNS + ["target"]:
        np.testing.assert_allclose(out[col].astype(float), exp[col].astype(float), rtol=1e-7, atol=1e-9,
                                   err_msg=col)


def test_ewm_adjust_true_matches_pandas(spark, series):
    out = _pdf(FT.ewm_mean(series, "close", 9, adjust=True, out="e", chunk_rows=512), ["e"])
    src = series.toPandas().sort_values(["asset", "ts"]).reset_index(drop=True)
    exp = src.groupby("asset")["close"].transform(lambda s: s.ewm(span=9, adjust=True).mean())
    np.testing.assert_allclose(out["e"], exp, rtol=1e-10)


def test_cumulative_curve_two_level_scan(spark, series):
    r = series.withColumn("r", (F.col("close") / 1000.0) - 0.1)
    a = _pdf(FT.cumulative_curve(r, "r", "asset", chunk_rows=128), ["cumulative", "running_max", "drawdown"])
    src = r.toPandas().sort_values(["asset", "ts"]).reset_index(drop=True)
    cum = src.groupby("asset")["r"].transform(lambda s: (1 + s).cumprod())
    mx = cum.groupby(src["asset"]).cummax()
    np.testing.assert_allclose(a["cumulative"], cum, rtol=1e-9)
    np.testing.assert_allclose(a["running_max"], mx, rtol=1e-9)


def test_no_lookahead(spark, series):
    """Features at time t do not change when rows after t change."""
    cut = series.filter(F.col("ts") < "2020-02-15")
    full = _pdf(FT.build_features(series), FT.FEATURE_COLUMNS)
    part = _pdf(FT.build_features(cut), FT.FEATURE_COLUMNS)
    merged = part.merge(full, on=["asset", "ts"], suffixes=("", "_f"))
    for c in FT.FEATURE_COLUMNS:
        np.testing.assert_allclose(merged[c].astype(float), merged[c + "_f"].astype(float), rtol=1e-9, atol=1e-12)


def test_edge_rows(spark):
    rows = [("one", pd.Timestamp("2020-01-01").to_pydatetime(), 1.0, 1.0, 1.0, 1.0, 1.0)]
    rows += [("flat", pd.Timestamp("2020-01-01").to_pydatetime() + pd.Timedelta(hours=i), 5.0, 5.0, 5.0, 5.0, 1.0)
             for i in range(30)]
    rows += [("zero", pd.Timestamp("2020-01-01").to_pydatetime() + pd.Timedelta(hours=i), 0.0, 0.0, 0.0,
              0.0 if i == 3 else 1.0 + i, 1.0) for i in range(5)]
    df = spark.createDataFrame(rows, "asset string, ts timestamp_ntz, open double, high double, low double, "
                                     "close double, volume double")
    out = FT.build_features(df, horizon=1).toPandas()
    one = out[out.asset == "one"].iloc[0]
    assert pd.isna(one["log_return"]) and pd.isna(one["target"])
    flat = out[out.asset == "flat"].sort_values("ts")
    assert flat["rsi_14"].isna().all()                      # gain = loss = 0
    assert (flat["volatility_20"].dropna() == 0).all()
    zero = out[out.asset == "zero"].sort_values("ts").reset_index(drop=True)
    assert pd.isna(zero.loc[3, "log_return"]) and pd.isna(zero.loc[4, "log_return"])   # price 0 -> NULL


@pytest.mark.parametrize("adjust", [False, True])
def test_ewm_passes_over_gaps_like_pandas(spark, adjust):
    rng = np.random.default_rng(5)
    n = 1500
    rows = []
    for a in ("a", "b"):
        x = 100 + np.cumsum(rng.normal(0, 1, n))
        x[rng.random(n) < 0.4] = np.nan
        x[:3] = np.nan
        x[400:900] = np.nan
        ts = pd.date_range("2021-01-01", periods=n, freq="h")
        rows += [(a, t.to_pydatetime(), None if np.isnan(v) else float(v)) for t, v in zip(ts, x)]
    rows += [("empty", rows[0][1], None)]
    df = spark.createDataFrame(rows, "asset string, ts timestamp_ntz, close double")
    line = FT.macd(df, adjust=adjust, chunk_rows=700).toPandas()
    for chunk in (700, 1 << 20):
        ema = FT.ewm_mean(df, "close", 12, adjust=adjust, chunk_rows=chunk, out="ema").toPandas()
        assert len(ema) == len(line) == len(rows) and ema[ema.asset == "empty"].ema.isna().all()
        for a in ("a", "b"):
            g = ema[ema.asset == a].sort_values("ts").reset_index(drop=True)
            np.testing.assert_allclose(g.ema, g.close.ewm(span=12, adjust=adjust).mean(), rtol=1e-10)
    for a in ("a", "b"):
        g = line[line.asset == a].sort_values("ts").reset_index(drop=True)
        want = g.close.ewm(span=12, adjust=adjust).mean() - g.close.ewm(span=26, adjust=adjust).mean()
        np.testing.assert_allclose(g.macd, want, rtol=1e-8, atol=1e-9)
        np.testing.assert_allclose(g.macd_signal, want.ewm(span=9, adjust=adjust).mean(), rtol=1e-8, atol=1e-9)


def test_ewm_of_the_stated_gap(spark):
    import datetime as dt
    df = spark.createDataFrame([("a", dt.datetime(2021, 1, i + 1), v) for i, v in enumerate([1.0, None, 3.0])],
                               "asset string, ts timestamp_ntz, close double")
    got = [r["ewm"] for r in FT.ewm_mean(df, "close", 3).orderBy("ts").collect()]
    assert got == pytest.approx([1.0, 1.0, 7 / 3])


def test_features_pass_over_missing_prices(spark):
    rng = np.random.default_rng(3)
    close = 100 + rng.normal(size=150).cumsum()
    close[[0, 1, 20, 21, 60]] = np.nan
    close[100:140] = np.nan
    ts = pd.date_range("2024-01-01", periods=150, freq="h")
    rows = [("a", t.to_pydatetime(), None if np.isnan(c) else float(c), 1.0, 1.0, 1.0, 1.0) for t, c in zip(ts, close)]
    df = spark.createDataFrame(rows, "asset string, ts timestamp_ntz, close double, open double, high double, low double, volume double")
    x = pd.Series(close)
    ema = {n: x.ewm(span=n, adjust=False).mean() for n in (12, 26)}
    line = ema[12] - ema[26]
    got = FT.build_features(df, chunk_rows=64).toPandas().sort_values("ts")
    np.testing.assert_allclose(got["macd"].to_numpy(dtype=float), line, rtol=0, atol=1e-9)
    np.testing.assert_allclose(got["macd_signal"].to_numpy(dtype=float), line.ewm(span=9, adjust=False).mean(), rtol=0, atol=1e-9)
    more = FT.extended_features(df, chunk_rows=64).toPandas().sort_values("ts")
    np.testing.assert_allclose(more["ema_26"].to_numpy(dtype=float), ema[26], rtol=0, atol=1e-9)
