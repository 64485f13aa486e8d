"""Time-bucket aggregations: OHLCV bars, last-per-period, calendars (A-01..A-08).

All are ``groupBy`` aggregations with map-side partial aggregation; first/last
are order-defined (``min_by``/``max_by`` on a (ts, tie-break) struct), never
input-order dependent.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def _order_key(ts: str, tiebreak: str | None) -> Column:
    return F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)


def ohlcv_bars(ticks: DataFrame, key: str | Sequence[str], ts: str, price: str,
               unit: str = "hour", tiebreak: str | None = None, size: str | None = None,
               out_ts: str = "ts") -> DataFrame:
    """A-01: first/max/min/last price per (key, time bucket) and volume.

    ``volume`` is ``sum(size)`` when a size column is given, else the tick count
    (as DOUBLE). Buckets are ``date_trunc(unit, ts)``.
    """
    key = _cols(key)
    order = _order_key(ts, tiebreak)
    vol = F.sum(size) if size else F.count(F.lit(1))
    return (ticks
            .withColumn("_bucket", F.date_trunc(unit, F.col(ts)))
            .groupBy(*key, "_bucket")
            .agg(F.min_by(price, order).alias("open"),
                 F.max(price).alias("high"),
                 F.min(price).alias("low"),
                 F.max_by(price, order).alias("close"),
                 vol.cast("double").alias("volume"))
            .withColumnRenamed("_bucket", out_ts))


def last_per_period(df: DataFrame, key: str | Sequence[str], ts: str, value: str,
                    unit: str = "day", tiebreak: str | None = None, out_ts: str = "period") -> DataFrame:
    """A-02: last value per (key, period) by time order."""
    key = _cols(key)
    return (df.groupBy(*key, F.date_trunc(unit, F.col(ts)).alias(out_ts))
              .agg(F.max_by(value, _order_key(ts, tiebreak)).alias(value)))


def week_ending_friday(d: Column) -> Column:
    """The Friday on or after date ``d`` (pandas ``W-FRI`` bin label)."""
    return F.next_day(F.date_sub(d, 1), "FRI")


def weekly_last(df: DataFrame, key: str | Sequence[str], ts: str, value: str,
                tiebreak: str | None = None, out: str = "week_end") -> DataFrame:
    """A-03: Friday-anchored weekly last value; weeks without rows are absent."""
    key = _cols(key)
    return (df.groupBy(*key, week_ending_friday(F.to_date(F.col(ts))).alias(out))
              .agg(F.max_by(value, _order_key(ts, tiebreak)).alias(value)))


def month_end_totals(df: DataFrame, date_col: str, sums: Sequence[str], key: Sequence[str] = (),
                     count_name: str = "n_events", out: str = "month_end") -> DataFrame:
    """A-04 / A-05: month-end sums and counts with empty months present as 0.

    The calendar runs per key from its first to its last month (pandas
    ``resample('ME')``); it is generated from the per-key min/max, so its size
    is months x keys, independent of the row count.
    """
    key = list(key)
    me = F.last_day(F.to_date(F.col(date_col)))
    agg = (df.groupBy(*key, me.alias(out))
             .agg(*[F.sum(c).alias(c) for c in sums], F.count(F.lit(1)).alias(count_name)))
    bounds = agg.groupBy(*key).agg(F.min(out).alias("_lo"), F.max(out).alias("_hi"))
    cal = bounds.select(*key, F.explode(F.sequence(
        F.col("_lo"), F.col("_hi"), F.expr("INTERVAL 1 MONTH"))).alias("_m"))
    cal = cal.select(*key, F.last_day(F.col("_m")).alias(out))
    out_df = cal.join(agg, on=[*key, out], how="left")
    return out_df.select(*key, out, *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in sums],
                         F.coalesce(F.col(count_name), F.lit(0)).cast("long").alias(count_name))


def mean_count(df: DataFrame, keys: Sequence[str | Column], value: str,
               mean_name: str = "mean", count_name: str = "count") -> DataFrame:
    """A-06 / A-07 / A-08: mean (NULLs ignored) and row count per key."""
    return df.groupBy(*keys).agg(F.avg(value).alias(mean_name), F.count(F.lit(1)).alias(count_name))
