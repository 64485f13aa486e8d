"""The features of W-09 on a stream (T-05): per-series state, a timeout, any split into micro-batches.

State of a series is its last rows (as many as the longest look-back) and the means of the EWMs, whatever
its length. A micro-batch's rows of a series are put in time order, computed after the rows in the state, and
emitted once each. A series that is silent for the timeout, in event time, loses its state and starts anew.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ledgerline.operators.features import FEATURE_COLUMNS, RETURN_LAGS

#: Rows before a row that its features look at.
BACK = 21
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def before(x: np.ndarray, k: int) -> np.ndarray:
    """x shifted by k rows, NaN where there is none."""
    out = np.full(len(x), np.nan)
    if k < len(x):
        out[k:] = x[:len(x) - k]
    return out


def rolling(x: np.ndarray, rows: int, of) -> np.ndarray:
    """``of`` over full windows without a missing value, else NaN."""
    out = np.full(len(x), np.nan)
    if len(x) >= rows:
        w = np.lib.stride_tricks.sliding_window_view(x, rows)
        ok = ~np.isnan(w).any(1)
        out[rows - 1:][ok] = of(w[ok])
    return out


def window_features(close: np.ndarray, volume: np.ndarray, first: bool) -> dict[str, np.ndarray]:
    """The windowed features of consecutive rows; ``first``: they begin with the series' first row."""
    prev = before(close, 1)
    with np.errstate(all="ignore"):
        lr = np.where((close > 0) & (prev > 0), np.log(close / prev), np.nan)
        delta = close - prev
        known = ~np.isnan(delta) | (first & (np.arange(len(close)) == 0))
        gain, loss = (np.where(known, np.where(s * delta > 0, s * delta, 0.0), np.nan) for s in (1, -1))
        g, lo = (rolling(x, 14, lambda w: w.mean(1)) for x in (gain, loss))
        rsi = np.where(lo == 0, np.where(g > 0, 100.0, np.nan), 100.0 - 100.0 / (1.0 + g / lo))
        mean, std = rolling(volume, 20, lambda w: w.mean(1)), rolling(volume, 20, lambda w: w.std(1, ddof=1))
        out = {"log_return": lr, "volatility_20": rolling(lr, 20, lambda w: w.std(1, ddof=1)), "rsi_14": rsi,
               "volume_zscore": (volume - mean) / (std + 1e-8)}
        for k in (5, 20):
            p = before(close, k)
            out[f"momentum_{k}"] = np.where(p != 0, close / p - 1.0, np.nan)
    return out | {f"return_lag_{k}": before(lr, k) for k in RETURN_LAGS}


def ewm_step(mean: float | None, x: float, span: int) -> float:
    return x if mean is None else mean + 2.0 / (span + 1.0) * (x - mean)


class FeatureProcessor(StatefulProcessor):
    """Rows of one series -> rows with the 14 features."""

    def __init__(self, key: str, ts: str, timeout_ms: int):
        self.key, self.ts, self.timeout = key, ts, timeout_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", "ts timestamp, close double, volume double")
        self.means = handle.getValueState("means", "fast double, slow double, signal double, n long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = pd.concat(list(rows)).sort_values(self.ts, kind="stable").reset_index(drop=True)
        held = [(r[0], r[1], r[2]) for r in self.rows.get()]
        fast, slow, signal, n = self.means.get() if self.means.exists() else (None, None, None, 0)
        if held:  # a row before the last one that was emitted is late: its neighbours are out already
            new = new[new[self.ts] > pd.Timestamp(held[-1][0])].reset_index(drop=True)
        if not len(new):
            return
        close = np.concatenate([[r[1] for r in held], new["close"].to_numpy(float)])
        volume = np.concatenate([[r[2] for r in held], new["volume"].to_numpy(float)])
        made = window_features(close, volume, first=n <= len(held))
        out = new[[self.ts, "close", "volume"]].copy()
        out.insert(0, self.key, key[0])
        for c, x in made.items():
            out[c] = x[len(held):]
        macd = np.empty((len(new), 2))
        for i, x in enumerate(close[len(held):]):
            fast, slow = ewm_step(fast, x, 12), ewm_step(slow, x, 26)
            signal = ewm_step(signal, fast - slow, 9)
            macd[i] = fast - slow, signal
        out["macd"], out["macd_signal"], out["macd_hist"] = macd[:, 0], macd[:, 1], macd[:, 0] - macd[:, 1]
        times = [r[0] for r in held] + [t.to_pydatetime() for t in new[self.ts]]
        self.rows.put([(t, float(c), float(v)) for t, c, v in zip(times[-BACK:], close[-BACK:], volume[-BACK:], strict=True)])
        self.means.update((float(fast), float(slow), float(signal), n + len(new)))
        for t in list(self.handle.listTimers()):
            self.handle.deleteTimer(t)
        self.handle.registerTimer(int(pd.Timestamp(times[-1]).timestamp() * 1000) + self.timeout)
        yield out[[self.key, self.ts, "close", "volume", *FEATURE_COLUMNS]]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        self.rows.clear()
        self.means.clear()
        return iter([])

    def close(self) -> None:
        pass


def stream_features(bars: DataFrame, key: str = "asset", ts: str = "ts", delay: str = "1 hour",
                    timeout_hours: int = 24 * 30) -> DataFrame:
    """T-05: a stream of bars (key, ts, close, volume) -> the bars with the 14 features of ``build_features``.

    Micro-batches must bring a series in time order; within one the order doesn't matter. A row at or before
    the last time emitted for its series is late and dropped. Prices are expected in every row. One exchange
    by key; the state of a series is ``BACK`` rows and four numbers. Needs the RocksDB state store (see
    :func:`with_rocksdb`)."""
    kinds = dict(bars.dtypes)
    schema = f"{key} {kinds[key]}, {ts} timestamp, close double, volume double, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    return bars.select(key, ts, "close", "volume").withWatermark(ts, delay).groupBy(key).transformWithStateInPandas(
        FeatureProcessor(key, ts, timeout_hours * 3_600_000), schema, "append", "eventtime", eventTimeColumnName="")


class with_rocksdb:
    """The session's state store while stateful processors run; what was set before comes back."""

    def __init__(self, spark: SparkSession):
        self.spark = spark

    def __enter__(self):
        self.old = self.spark.conf.get(PROVIDER, None)
        self.spark.conf.set(PROVIDER, ROCKSDB)

    def __exit__(self, *_):
        if self.old is None:
            self.spark.conf.unset(PROVIDER)
        else:
            self.spark.conf.set(PROVIDER, self.old)
