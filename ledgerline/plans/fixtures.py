"""Derive the library's input shapes from the driver's tables.

The registered queries read the given Parquet tables (or data Spark derives
from them) so that their work grows with the tables:

* ``events`` -> hourly OHLCV bars, one series per ``event_type``; or daily bars
  per ``user_id`` (many short series).
* ``documents`` / ``labels`` / ``conversations`` -> text inputs.
* ``orders`` / ``lineitem`` / dimensions -> panels, joins, top-k.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.bars import ohlcv_bars

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def hourly_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bars fixture: asset = event_type, bucket = hour, open/close by (ts, event_id),
    volume = event count."""
    ev = table(spark, sf_dir, "events")
    return (ohlcv_bars(ev, key="event_type", ts="ts", price="value", unit="hour", tiebreak="event_id")
            .withColumnRenamed("event_type", "asset"))


def user_daily_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many short series: asset = user_id (as string), bucket = day."""
    ev = table(spark, sf_dir, "events").withColumn("asset", F.col("user_id").cast("string"))
    return ohlcv_bars(ev, key="asset", ts="ts", price="value", unit="day", tiebreak="event_id")


def bars_sql(unit: str = "hour") -> str:
    """DuckDB form of :func:`hourly_bars` for the oracle queries."""
    return f"""
    SELECT event_type AS asset, date_trunc('{unit}', ts) AS ts,
           arg_min(value, (ts, event_id)) AS open, max(value) AS high, min(value) AS low,
           arg_max(value, (ts, event_id)) AS close, CAST(count(*) AS DOUBLE) AS volume
    FROM events GROUP BY 1, 2"""
