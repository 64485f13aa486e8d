"""Property tests: order / partitioning invariance, isolation of series, empty input."""
import pandas as pd
import pytest
from pyspark.sql import functions as F

from ledgerline.operators import features as FT
from ledgerline.operators import metrics as M
from ledgerline.operators import splits as SP
from ledgerline.plans import fixtures as fx

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def bars(spark):
    return fx.hourly_bars(spark, SF).cache()


def _sorted(df, cols):
    return df.select("asset", "ts", *cols).toPandas().sort_values(["asset", "ts"]).reset_index(drop=True)


def test_features_invariant_to_order_and_partitions(spark, bars):
    cols = FT.FEATURE_COLUMNS + ["target"]
    a = _sorted(FT.build_features(bars, horizon=1), cols)
    shuffled = bars.orderBy(F.rand(seed=3)).repartition(7)
    b = _sorted(FT.build_features(shuffled, horizon=1), cols)
    pd.testing.assert_frame_equal(a, b, rtol=1e-12, atol=1e-12)


def test_asset_alone_equals_asset_in_panel(spark, bars):
    cols = FT.FEATURE_COLUMNS
    full = _sorted(FT.build_features(bars), cols)
    alone = _sorted(FT.build_features(bars.filter(F.col("asset") == "view")), cols)
    pd.testing.assert_frame_equal(full[full.asset == "view"].reset_index(drop=True), alone, rtol=1e-12, atol=1e-12)


def test_empty_input_keeps_schema(spark, bars):
    empty = bars.filter(F.lit(False))
    f = FT.build_features(empty, horizon=1)
    assert f.count() == 0 and set(FT.FEATURE_COLUMNS) <= set(f.columns)
    folds = SP.walk_forward_split(empty, 10, 5)
    assert folds.count() == 0 and {"fold", "role"} <= set(folds.columns)
    pred = empty.select("asset", "ts", F.col("close").alias("actual"), F.col("open").alias("prediction"))
    assert M.all_metrics(pred, group=["asset"]).count() == 0


def test_ties_in_time_resolved_by_tiebreak(spark):
    rows = [("a", pd.Timestamp("2024-01-01").to_pydatetime(), i, float(10 + i)) for i in range(5)]
    df = spark.createDataFrame(rows, "asset string, ts timestamp_ntz, seq int, close double")
    out = FT.log_returns(df, tiebreak="seq").orderBy("seq").collect()
    assert out[0]["log_return"] is None
    assert abs(out[1]["log_return"] - __import__("math").log(11 / 10)) < 1e-15


def test_metrics_invariant_to_partitions(spark, bars):
    f = FT.build_features(bars, horizon=1).select("asset", "ts", F.col("log_return").alias("prediction"),
                                                  F.col("target").alias("actual")).na.drop()
    a = M.all_metrics(f, group=["asset"]).toPandas().sort_values("asset").reset_index(drop=True)
    b = M.all_metrics(f.repartition(5), group=["asset"]).toPandas().sort_values("asset").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, rtol=1e-9)
