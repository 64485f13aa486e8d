"""Model backtest: folds, sizes, skipped folds and fitted numbers against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import backtest as BT

FEATURES = ["a", "b", "flat"]
LENGTHS = {"x": 70, "y": 47, "z": 20}


def _panel():
    rng = np.random.default_rng(5)
    out = []
    for asset, n in LENGTHS.items():
        for i in range(n):
            a, b = rng.normal(size=2)
            y = 2 * a - b + 0.1 * rng.normal() + 3
            out.append((asset, "k", dt.datetime(2024, 1, 1) + dt.timedelta(hours=i), float(a), float(b), 1.0, float(y)))
    # incomplete rows are left out before folds are counted
    out.append(("x", "k", dt.datetime(2023, 1, 1), None, 1.0, 1.0, 5.0))
    out.append(("x", "k", dt.datetime(2023, 1, 2), 1.0, 1.0, 1.0, None))
    return out


def _frame(spark, rows=None):
    return spark.createDataFrame(rows if rows is not None else _panel(),
                                 "asset string, asset_class string, ts timestamp, a double, b double, flat double, target double")


def _brute(train, test, step, scheme, ridge=1.0):
    series = {}
    for r in sorted(_panel(), key=lambda r: r[2]):
        if r[3] is not None and r[6] is not None:
            series.setdefault(r[0], []).append(r)
    found, fold = {}, 0
    while True:
        tr, te = [], []
        for rows in series.values():
            if len(rows) >= fold * step + train + test:
                lo = fold * step if scheme == "walk_forward" else 0
                tr += rows[lo:fold * step + train]
                te += rows[fold * step + train:fold * step + train + test]
        if not te:
            return found
        x = np.array([r[3:5] for r in tr])
        y = np.array([r[6] for r in tr])
        mean, sd = x.mean(0), x.std(0)
        z = (x - mean) / sd
        w = np.linalg.solve(z.T @ z + ridge * np.eye(2), z.T @ (y - y.mean()))
        for r in te:
            p = y.mean() + ((np.array(r[3:5]) - mean) / sd) @ w
            found[(fold, r[0], r[2])] = (len(tr), len(te), p, r[6])
        fold += 1


@pytest.mark.parametrize("scheme", BT.SCHEMES)
@pytest.mark.parametrize("sizes", [(20, 10, 10), (15, 10, 4), (12, 5, 7)])
def test_backtest_equals_numpy(spark, scheme, sizes):
    train, test, step = sizes
    got = BT.backtest(_frame(spark), FEATURES, "target", train, test, step, scheme, min_train=1, min_test=1).collect()
    want = _brute(train, test, step, scheme)
    assert {(r["fold"], r["asset"], r["ts"]) for r in got} == set(want)
    assert len(got) == len(want)
    for r in got:
        n_train, n_test, p, y = want[(r["fold"], r["asset"], r["ts"])]
        assert (r["train_size"], r["test_size"]) == (n_train, n_test)
        assert r["prediction"] == pytest.approx(p, abs=1e-8) and r["actual"] == y


def test_small_folds_are_skipped_and_recorded(spark):
    pred = BT.backtest(_frame(spark), FEATURES, "target", 20, 10, 10, min_train=40, min_test=10)
    folds = {r["fold"]: r for r in BT.fold_record(pred).collect()}
    # z is too short for a fold and y ends after fold 1: later folds have the 20 train rows of x alone
    assert set(folds) == {0, 1} and folds[0]["train_size"] == 40 and folds[0]["n"] == 20
    pooled = BT.pooled_record(pred).collect()
    assert len(pooled) == 1 and pooled[0]["folds"] == 2 and pooled[0]["n"] == 40
    assert pooled[0]["mae"] < 0.5


def test_classification_and_empty(spark):
    df = _frame(spark).withColumn("up", (F.col("target") > 3).cast("int"))
    pred = BT.backtest(df, FEATURES, "up", 20, 10, 10, min_train=1, min_test=1, task="classification")
    assert pred.filter("prediction < 0 OR prediction > 1").count() == 0
    rows = BT.class_record(pred).collect()
    assert {r["fold"] for r in rows} == set(range(5)) and min(r["accuracy"] for r in rows) > 0.7
    assert BT.backtest(_frame(spark, []), FEATURES).count() == 0
    with pytest.raises(ValueError):
        BT.backtest(df, FEATURES, scheme="other")
