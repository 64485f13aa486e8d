import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import metrics as M
from ledgerline.operators import splits as SP


def _bars(spark, n, asset="a"):
    ts = pd.date_range("2021-01-01", periods=n, freq="D")
    return spark.createDataFrame([(asset, t.to_pydatetime(), float(i)) for i, t in enumerate(ts)],
                                 "asset string, ts timestamp_ntz, close double")


def _walk_forward_reference(n, a, b, s):
    out, start, k = [], 0, 0
    while start + a + b <= n:
        out += [(k, i, "train") for i in range(start, start + a)] + [(k, i, "test") for i in range(start + a, start + a + b)]
        start += s
        k += 1
    return sorted(out)


@pytest.mark.parametrize("n,a,b,s", [(10, 6, 4, 4), (9, 6, 4, 4), (30, 10, 5, 3), (30, 10, 5, 7), (25, 5, 5, 5)])
def test_walk_forward_matches_loop(spark, n, a, b, s):
    out = SP.walk_forward_split(_bars(spark, n), a, b, s).select("fold", F.col("close").cast("int"), "role").collect()
    assert sorted(tuple(r) for r in out) == _walk_forward_reference(n, a, b, s)


@pytest.mark.parametrize("n,i,b,s", [(10, 6, 4, 4), (9, 6, 4, 4), (30, 10, 5, 3), (30, 10, 5, 7)])
def test_expanding_matches_loop(spark, n, i, b, s):
    exp, end, k = [], i, 0
    while end + b <= n:
        exp += [(k, r, "train") for r in range(0, end)] + [(k, r, "test") for r in range(end, end + b)]
        end += s
        k += 1
    out = SP.expanding_window_split(_bars(spark, n), i, b, s).select("fold", F.col("close").cast("int"), "role").collect()
    assert sorted(tuple(r) for r in out) == sorted(exp)


def test_folds_test_after_train(spark):
    f = SP.walk_forward_split(_bars(spark, 50), 10, 5, 5).toPandas()
    for k, g in f.groupby("fold"):
        assert g[g.role == "train"].ts.max() < g[g.role == "test"].ts.min()


def test_single_split_and_temporal_check(spark):
    out = SP.single_train_test_split(_bars(spark, 10), 0.8).toPandas()
    assert (out.role == "train").sum() == int(10 * 0.8)
    with pytest.raises(ValueError):
        SP.walk_forward_split(_bars(spark, 10).withColumn("ts", F.lit(1)), 2, 2)


def test_hash_split_stable_under_repartition(spark):
    d = spark.range(5000).withColumnRenamed("id", "doc_id")
    a = SP.hash_split(d, "doc_id").filter("role = 'test'").select("doc_id")
    b = SP.hash_split(d.repartition(13), "doc_id").filter("role = 'test'").select("doc_id")
    assert sorted(r[0] for r in a.collect()) == sorted(r[0] for r in b.collect())
    n = a.count()
    assert 350 < n < 650


def _metrics_numpy(y, p):
    r = y * np.sign(p)
    cum = np.cumprod(1 + r)
    mdd = np.min((cum - np.maximum.accumulate(cum)) / np.maximum.accumulate(cum)) * 100
    neg = r[r < 0]
    return {
        "mae": np.mean(np.abs(y - p)), "rmse": np.sqrt(np.mean((y - p) ** 2)),
        "direction_accuracy": np.mean(np.sign(y) == np.sign(p)),
        "sharpe_ratio": 0.0 if np.std(r) == 0 else np.mean(r) / np.std(r) * np.sqrt(252),
        "sortino_ratio": 0.0 if len(neg) == 0 or np.std(neg) == 0 else np.mean(r) / np.std(neg) * np.sqrt(252),
        "profit_factor": r[r > 0].sum() / abs(r[r < 0].sum()),
        "max_drawdown": mdd, "total_return": (cum[-1] - 1) * 100,
        "calmar_ratio": (cum[-1] ** (252 / len(r)) - 1) * 100 / abs(mdd),
    }


def test_all_metrics_match_numpy(spark):
    rng = np.random.default_rng(3)
    y, p = rng.normal(0, 0.01, 300), rng.normal(0, 0.01, 300)
    ts = pd.date_range("2022-01-01", periods=300, freq="D")
    df = spark.createDataFrame([(t.to_pydatetime(), float(a), float(b)) for t, a, b in zip(ts, y, p)],
                               "ts timestamp_ntz, actual double, prediction double")
    got = M.all_metrics(df, order=("ts",), chunk_rows=64).first().asDict()
    exp = _metrics_numpy(y, p)
    for k, v in exp.items():
        assert math.isclose(got[k], v, rel_tol=1e-9, abs_tol=1e-12), k
    assert got["mape"] is not None


def test_metric_edge_cases(spark):
    ts = [pd.Timestamp("2022-01-01") + pd.Timedelta(days=i) for i in range(5)]
    up = spark.createDataFrame([(t.to_pydatetime(), 0.01, 1.0) for t in ts], "ts timestamp_ntz, actual double, prediction double")
    m = M.all_metrics(up).first()
    assert m["profit_factor"] == float("inf") and m["sharpe_ratio"] == 0.0 and m["max_drawdown"] == 0.0
    zero = spark.createDataFrame([(t.to_pydatetime(), 0.0 if i == 0 else 0.01, 1.0) for i, t in enumerate(ts)],
                                 "ts timestamp_ntz, actual double, prediction double")
    assert M.all_metrics(zero).first()["mape"] is None


def test_classification_report_keeps_absent_classes(spark):
    df = spark.createDataFrame([("positive", "positive"), ("positive", "negative"), ("negative", "negative")],
                               "y_true string, y_pred string")
    per, summary = M.classification_report(df)
    per = {r["label"]: r for r in per.collect()}
    assert per["neutral"]["support"] == 0 and per["neutral"]["precision"] == 0.0
    s = summary.first()
    assert math.isclose(s["accuracy"], 2 / 3)
    cm = M.confusion_long(df).collect()
    assert len(cm) == 9


def test_standardize_uses_train_rows_only(spark):
    df = _bars(spark, 30).withColumn("x", F.col("close"))
    folds = SP.walk_forward_split(df, 10, 5, 5)
    a = SP.standardize_train_only(folds, ["x"]).filter("role = 'train'").toPandas()
    # changing only test-row values must not change the standardised train rows
    bumped = folds.withColumn("x", F.when(F.col("role") == "test", F.col("x") * 100).otherwise(F.col("x")))
    b = SP.standardize_train_only(bumped, ["x"]).filter("role = 'train'").toPandas()
    key = ["fold", "ts"]
    a, b = a.sort_values(key).reset_index(drop=True), b.sort_values(key).reset_index(drop=True)
    assert (a["x_z"] - b["x_z"]).abs().max() < 1e-12
    g = a.groupby("fold")["x_z"]
    assert (g.mean().abs() < 1e-9).all()


def test_expanding_fold_stats_match_split_rows(spark):
    bars = _bars(spark, 30).unionByName(_bars(spark, 9, "short"))
    got = SP.expanding_fold_stats(bars, "close", 10, 5, 3).toPandas().sort_values("fold")
    rows = SP.expanding_window_split(bars, 10, 5, 3).toPandas()
    assert set(got.asset) == {"a"} and list(got.fold) == sorted(rows.fold.unique())
    for _, r in got.iterrows():
        for side in ("train", "test"):
            x = rows[(rows.fold == r.fold) & (rows.role == side)].close
            assert r[f"{side}_size"] == len(x)
            assert r[f"{side}_mean"] == pytest.approx(x.mean()) and r[f"{side}_std"] == pytest.approx(x.std(ddof=0))
    assert SP.expanding_fold_stats(bars.filter("false"), "close", 10, 5, 3).count() == 0


def test_temporal_disorder_follows_the_input_order(spark):
    import datetime as dt
    day = [dt.datetime(2021, 1, d) for d in (1, 3, 2, 2, 5)]
    df = spark.createDataFrame([("a", t, i) for i, t in enumerate(day)] + [("b", day[0], 9)],
                               "asset string, ts timestamp_ntz, seq long")
    for chunk in (2, 1 << 20):
        got = {r["asset"]: (r["n"], r["out_of_order"])
               for r in SP.temporal_disorder(df, "ts", "seq", chunk_rows=chunk).collect()}
        assert got == {"a": (5, 1), "b": (1, 0)}
    with pytest.raises(ValueError):
        SP.require_sorted(df, "ts", "seq")
    SP.require_sorted(df.filter("seq <> 2 AND seq <> 3"), "ts", "seq")


def test_hash_split_is_md5(spark):
    import hashlib
    got = SP.hash_split(spark.range(200).withColumnRenamed("id", "doc_id"), "doc_id").collect()
    for r in got:
        h = int(hashlib.md5(f"42:{r['doc_id']}".encode()).hexdigest()[:8], 16) % 1000
        assert r["role"] == ("test" if h < 100 else "train")
