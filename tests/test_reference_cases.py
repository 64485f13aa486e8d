"""The reference's own unit-test cases, run against the equivalent operators
(save / skip empty, time index, lake path layout)."""
import datetime as dt
import warnings

from pyspark.sql import types as T

from ledgerline.operators.clean import to_time_index
from ledgerline.sources import lake as LK


def test_save_non_empty_and_empty(spark):
    root = LK.scratch_path(spark, "ref-save")
    df = spark.createDataFrame([(1, "x", "idx"), (2, "x", "idx")], "a int, category string, asset string")
    assert LK.write_lake(df, root) is True
    assert spark.read.parquet(LK.lake_path(root, "x", "idx")).count() == 2
    with warnings.catch_warnings(record=True) as w:
        warnings.simplefilter("always")
        assert LK.write_lake(df.limit(0), LK.scratch_path(spark, "ref-empty")) is False
    assert any("skipping" in str(x.message) for x in w)


def test_path_layout():
    assert LK.lake_path("/lake", "equities", "AAPL_1d") == "/lake/category=equities/asset=AAPL_1d"


def test_date_column_to_time_index(spark):
    df = spark.createDataFrame([(10, "2024-01-15")], "val int, date string")
    out = to_time_index(df, "date")
    assert isinstance(out.schema["ts"].dataType, T.TimestampType)        # session-zone (UTC) timestamp
    assert out.first()["ts"] == dt.datetime(2024, 1, 15)


def test_already_temporal_unchanged(spark):
    rows = [(i, dt.datetime(2024, 1, 1 + i)) for i in range(3)]
    df = spark.createDataFrame(rows, "val int, date timestamp")
    out = to_time_index(df, "date")
    assert [r["ts"] for r in out.orderBy("val").collect()] == [r[1] for r in rows]


def test_sorted_after_conversion(spark):
    df = spark.createDataFrame([(3, "2024-01-05"), (1, "2024-01-01")], "val int, date string")
    assert [r["val"] for r in to_time_index(df, "date", sort=True).collect()] == [1, 3]
