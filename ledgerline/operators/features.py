"""Per-series technical features and targets (W-01..W-16, E-01..E-08).

Every operator runs in the chunk layout of :mod:`ledgerline.plans.sequence`:
rows are numbered per series, split into ``chunk_rows`` chunks with a halo of
the largest look-back, evaluated with ``partitionBy(key, chunk)`` windows and
the halo copies dropped. One hash exchange on (key, chunk) serves all windows.

Rolling windows need a full frame, as pandas ``rolling(n)`` does
(``min_periods = n``): the value is NULL until n non-null inputs are present.
Missing data is NULL; ratios go through ``try_divide`` and logs are guarded
with ``> 0`` (ANSI mode raises on ``/0``).
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.plans import sequence as sq
from ledgerline.session import cut_lineage
from ledgerline.plans.sequence import RN, N, chunk_window, full_rolling, rolling

# The names of the feature columns
FEATURE_COLUMNS = [
    "log_return", "volatility_20", "rsi_14", "macd", "macd_signal", "macd_hist",
    "volume_zscore", "return_lag_1", "return_lag_2", "return_lag_3", "return_lag_5",
    "return_lag_10", "momentum_5", "momentum_20",
]
RETURN_LAGS = (1, 2, 3, 5, 10)


def _cols(x):
    return [x] if isinstance(x, str) else list(x)


def on_series(df: DataFrame, key: str | Sequence[str], order: Sequence[str],
              build: Callable[[DataFrame], DataFrame], back: int, fwd: int = 0,
              chunk_rows: int = sq.DEFAULT_CHUNK_ROWS, keep_index: bool = False) -> DataFrame:
    """Number rows per series, lay out chunks with a halo, apply ``build``, drop halo."""
    ix = sq.with_row_index(df, key, order)
    laid = sq.with_halo(ix, back=back, fwd=fwd, chunk_rows=chunk_rows)
    out = sq.home_rows(build(laid))
    return out if keep_index else out.drop(RN, N)


# ---- column builders (valid inside the chunk layout) -------------------------

def log_return_col(key, price: str = "close", k: int = 1) -> Column:
    """W-01: ln(p_t / p_{t-k}); NULL unless both prices are > 0."""
    prev = F.lag(price, k).over(chunk_window(key))
    p = F.col(price)
    return F.when((p > 0) & (prev > 0), F.log(F.try_divide(p, prev)))


def pct_change_col(key, price: str = "close", k: int = 1) -> Column:
    """W-08 / W-13: p_t / p_{t-k} - 1 (NULL when the earlier price is 0)."""
    prev = F.lag(price, k).over(chunk_window(key))
    return F.try_divide(F.col(price), prev) - F.lit(1.0)


def rsi_col(key, price: str = "close", window: int = 14) -> Column:
    """W-03: simple-mean RSI. The first difference is missing and counts as 0,
    so the first value is at row window-1. loss = 0: 100 if gain > 0, else NULL."""
    delta = F.col(price) - F.lag(price, 1).over(chunk_window(key))
    gain = F.coalesce(F.when(delta > 0, delta), F.lit(0.0))
    loss = F.coalesce(F.when(delta < 0, -delta), F.lit(0.0))
    g = full_rolling(F.avg(gain), gain, key, window)
    lo = full_rolling(F.avg(loss), loss, key, window)
    return (F.when(lo.isNull() | g.isNull(), F.lit(None).cast("double"))
             .when(lo == 0, F.when(g > 0, F.lit(100.0)))
             .otherwise(F.lit(100.0) - F.lit(100.0) / (F.lit(1.0) + g / lo)))


def zscore_col(key, x: str, window: int = 20, eps: float = 1e-8) -> Column:
    """W-06: (x - rolling mean) / (rolling sample std + eps)."""
    v = F.col(x)
    mean = full_rolling(F.avg(v), v, key, window)
    std = full_rolling(F.stddev_samp(v), v, key, window)
    return (v - mean) / (std + F.lit(eps))


# ---- operators ---------------------------------------------------------------

def _order(ts: str, tiebreak: str | None) -> list[str]:
    return [ts] + ([tiebreak] if tiebreak else [])


def log_returns(bars: DataFrame, key="asset", ts="ts", price="close", tiebreak=None,
                out="log_return", chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    return on_series(bars, key, _order(ts, tiebreak),
                     lambda d: d.withColumn(out, log_return_col(key, price)), back=1, chunk_rows=chunk_rows)


def rolling_volatility(bars: DataFrame, key="asset", ts="ts", price="close", window=20,
                       tiebreak=None, out="volatility", chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W-02: sample std of log returns over ``window`` rows (full frames only)."""
    def build(d):
        d = d.withColumn("_lr", log_return_col(key, price))
        return d.withColumn(out, full_rolling(F.stddev_samp("_lr"), F.col("_lr"), key, window)).drop("_lr")
    return on_series(bars, key, _order(ts, tiebreak), build, back=window + 1, chunk_rows=chunk_rows)


def rsi(bars: DataFrame, key="asset", ts="ts", price="close", window=14, tiebreak=None,
        out="rsi", chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    return on_series(bars, key, _order(ts, tiebreak),
                     lambda d: d.withColumn(out, rsi_col(key, price, window)), back=window + 1,
                     chunk_rows=chunk_rows)


def add_macd(d: DataFrame, key, price="close", fast=12, slow=26, signal=9, adjust=False,
             names=("macd", "macd_signal", "macd_hist"), extra: dict | None = None) -> DataFrame:
    """MACD columns; ``extra`` columns (independent of the MACD) are added in the
    same projection as the MACD line to keep the DataFrame chain short."""
    d = sq.ewm_many(d, [(price, "_ema_fast", fast), (price, "_ema_slow", slow)], key, adjust=adjust)
    d = d.withColumns({names[0]: F.col("_ema_fast") - F.col("_ema_slow"), **(extra or {})})
    d = sq.ewm_many(d, [(names[0], names[1], signal)], key, adjust=adjust)
    return d.withColumn(names[2], F.col(names[0]) - F.col(names[1])).drop("_ema_fast", "_ema_slow")


def macd_halo(fast=12, slow=26, signal=9) -> int:
    return max(sq.ewm_halo(fast), sq.ewm_halo(slow)) + sq.ewm_halo(signal)


def macd(bars: DataFrame, key="asset", ts="ts", price="close", fast=12, slow=26, signal=9,
         tiebreak=None, adjust=False, chunk_rows=sq.DEFAULT_CHUNK_ROWS, gaps=True) -> DataFrame:
    """W-04 / W-05: EWM(adjust=False) fast - slow, signal EWM of that, histogram.

    Missing prices are passed over as in :func:`ewm_mean`; ``gaps=False`` is the
    shorter plan for a price that is never NULL (bars' own).
    """
    if not gaps:
        return on_series(bars, key, _order(ts, tiebreak),
                         lambda d: add_macd(d, key, price, fast, slow, signal, adjust),
                         back=macd_halo(fast, slow, signal), chunk_rows=chunk_rows)
    ix = sq.with_row_index(bars, key, _order(ts, tiebreak))
    d = sq.ewm_gaps(ix, price, {"_fast": fast, "_slow": slow}, key, adjust, chunk_rows)
    d = d.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    # from its first value on the line has no gaps: the signal needs no folding
    keys = _cols(key)
    first = ix.filter(F.col(price).isNotNull() & ~F.isnan(price)).groupBy(
        *[F.col(k).alias(f"_key_{i}") for i, k in enumerate(keys)]).agg(F.min(RN).alias("_first"))
    same = [F.col(k).eqNullSafe(F.col(f"_key_{i}")) for i, k in enumerate(keys)]
    laid = sq.with_halo(d.join(first, same, "left").drop(*[f"_key_{i}" for i in range(len(keys))]),
                        back=sq.ewm_halo(signal), chunk_rows=chunk_rows)
    d = sq.home_rows(sq.ewm(laid, "macd", "macd_signal", signal, key, adjust, first_rn=F.col("_first")))
    return d.withColumn("macd_hist", F.col("macd") - F.col("macd_signal")).drop(RN, N, "_first")


def ewm_mean(df: DataFrame, x: str, span: float, key="asset", ts="ts", tiebreak=None, adjust=False,
             out="ewm", chunk_rows=sq.DEFAULT_CHUNK_ROWS, gaps=True) -> DataFrame:
    """W-04: exponentially weighted mean per series. A missing value (NULL, NaN)
    repeats the last mean and older values lose weight over it; ``gaps=False`` is
    the shorter plan for a column that is never missing."""
    if not gaps:
        return on_series(df, key, _order(ts, tiebreak), lambda d: sq.ewm(d, x, out, span, key, adjust=adjust),
                         back=sq.ewm_halo(span), chunk_rows=chunk_rows)
    ix = sq.with_row_index(df, key, _order(ts, tiebreak))
    return sq.ewm_gaps(ix, x, {out: span}, key, adjust, chunk_rows).drop(RN, N)


def volume_zscore(bars: DataFrame, key="asset", ts="ts", window=20, tiebreak=None,
                  out="volume_zscore", chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W-06: 0 when there is no volume column."""
    if "volume" not in bars.columns:
        return bars.withColumn(out, F.lit(0.0))
    return on_series(bars, key, _order(ts, tiebreak),
                     lambda d: d.withColumn(out, zscore_col(key, "volume", window)), back=window,
                     chunk_rows=chunk_rows)


def lag_returns(bars: DataFrame, key="asset", ts="ts", price="close", lags=RETURN_LAGS,
                tiebreak=None, chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W-07: return_lag_k = log return shifted by k rows."""
    def build(d):
        d = d.withColumn("_lr", log_return_col(key, price))
        w = chunk_window(key)
        return d.withColumns({f"return_lag_{k}": F.lag("_lr", k).over(w) for k in lags}).drop("_lr")
    return on_series(bars, key, _order(ts, tiebreak), build, back=max(lags) + 1, chunk_rows=chunk_rows)


def feature_builder(key, price="close", lookback=20, include_volume=True, include_macd=True):
    """Column plan of W-09 (``build_features``): 14 fixed-name columns, built in
    a few batched projections (each DataFrame call is analysed on the driver)."""
    def build(d: DataFrame) -> DataFrame:
        w = chunk_window(key)
        d = d.withColumns({
            "log_return": log_return_col(key, price),
            "rsi_14": rsi_col(key, price, min(14, lookback)),
            "volume_zscore": zscore_col(key, "volume", 20) if include_volume else F.lit(0.0),
            "momentum_5": pct_change_col(key, price, min(5, lookback)),
            "momentum_20": pct_change_col(key, price, lookback),
        })
        lagged = {f"return_lag_{k}": F.lag("log_return", k).over(w) for k in RETURN_LAGS}
        lagged["volatility_20"] = full_rolling(F.stddev_samp("log_return"), F.col("log_return"), key, lookback)
        return add_macd(d, key, price, extra=lagged) if include_macd else d.withColumns(lagged)
    return build


def features_halo(lookback=20) -> int:
    return max(lookback + 1, 21, max(RETURN_LAGS) + 1, macd_halo())


def build_features(bars: DataFrame, key="asset", ts="ts", price="close", lookback=20,
                   tiebreak=None, horizon: int | None = None, strict_tail: bool = True,
                   chunk_rows=sq.DEFAULT_CHUNK_ROWS, keep_index=False, gaps=True) -> DataFrame:
    """W-09 (+ W-10/W-11 when ``horizon`` is given): all 14 features.

    Missing prices (NULL, NaN) are passed over by the MACD columns as in
    :func:`macd`, which is a plan of its own. ``gaps=False`` is for prices that are
    never missing (bars' own): there every window shares the (key, chunk)
    partitioning, one exchange after the row index for all features.
    """
    base = feature_builder(key, price, lookback, include_volume="volume" in bars.columns, include_macd=not gaps)
    if gaps:
        bars = macd(bars, key, ts, price, tiebreak=tiebreak, chunk_rows=chunk_rows)

    def build(d):
        d = base(d)
        if horizon is not None:
            d = d.withColumn("target", target_col(key, price, horizon))
            d = d.withColumn("target_direction", direction_col(F.col("target"), strict_tail))
        return d
    return on_series(bars, key, _order(ts, tiebreak), build, back=features_halo(lookback),
                     fwd=horizon or 0, chunk_rows=chunk_rows, keep_index=keep_index)


def target_col(key, price="close", horizon=1) -> Column:
    """W-10: ln(p_{t+h} / p_t)."""
    nxt = F.lead(price, horizon).over(chunk_window(key))
    p = F.col(price)
    return F.when((p > 0) & (nxt > 0), F.log(F.try_divide(nxt, p)))


def direction_col(target: Column, strict_tail=True) -> Column:
    """W-11: 1 if the future return is > 0 else 0. ``strict_tail`` keeps NULL where
    the target is missing; ``False`` gives 0 there (the pandas NaN > 0 result)."""
    d = (target > 0).cast("int")
    return d if strict_tail else F.coalesce(d, F.lit(0))


def make_target(bars: DataFrame, key="asset", ts="ts", price="close", horizon=1, tiebreak=None,
                direction=False, strict_tail=True, chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    def build(d):
        d = d.withColumn("target", target_col(key, price, horizon))
        if direction:
            d = d.withColumn("target_direction", direction_col(F.col("target"), strict_tail))
        return d
    return on_series(bars, key, _order(ts, tiebreak), build, back=0, fwd=horizon, chunk_rows=chunk_rows)


def first_difference(df: DataFrame, x: str, key="asset", ts="ts", tiebreak=None, out=None,
                     chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W-12: x_t - x_{t-1}."""
    out = out or f"{x}_change"
    return on_series(df, key, _order(ts, tiebreak),
                     lambda d: d.withColumn(out, F.col(x) - F.lag(x, 1).over(chunk_window(key))),
                     back=1, chunk_rows=chunk_rows)


def example_features(bars: DataFrame, key="asset", ts="ts", price="close", tiebreak=None,
                     chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W-13: simple returns 1/5/20, volume ratio to its 20-row mean, 20-row std of
    the 1-row return, RSI 14 and MACD with EWM ``adjust=True`` (pandas default);
    rows with any missing value are dropped (``dropna``). A ratio with a zero
    denominator is NULL here (pandas keeps it as infinity)."""
    def build(d):
        d = d.withColumn("returns_1d", pct_change_col(key, price, 1))
        d = d.withColumn("returns_5d", pct_change_col(key, price, 5))
        d = d.withColumn("returns_20d", pct_change_col(key, price, 20))
        d = d.withColumn("volume_ratio", F.try_divide(F.col("volume"), full_rolling(
            F.avg("volume"), F.col("volume"), key, 20)))
        d = d.withColumn("volatility_20d", full_rolling(F.stddev_samp("returns_1d"), F.col("returns_1d"),
                                                        key, 20))
        d = d.withColumn("rsi", rsi_col(key, price, 14))
        d = add_macd(d, key, price, adjust=True, names=("macd", "macd_signal", "_hist")).drop("_hist")
        return d
    out = on_series(bars, key, _order(ts, tiebreak), build, back=max(macd_halo(), 22), chunk_rows=chunk_rows)
    return out.na.drop(how="any")


def cumulative_curve(df: DataFrame, r: str, key, ts="ts", tiebreak=None, cum="cumulative",
                     drawdown="drawdown", chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W-14 / W-15: cumulative compounded return prod(1 + r) (sign-correct, no
    log trick; NULL returns are skipped like cumprod), its running max and
    drawdown (c - max) / max.

    Unbounded-preceding frames use the two-level scan: the product of each
    earlier chunk comes from a per-chunk aggregate over the indexed rows (cheap)
    and is joined before the windows; the running max needs the chunk maxima of
    the compounded values, a second small carry table. As the scan reads its input
    several times, the input is checkpointed once: pass only the columns needed."""
    key = _cols(key)
    ix = sq.with_row_index(cut_lineage(df), key, _order(ts, tiebreak))
    laid = sq.with_halo(ix, back=0, fwd=0, chunk_rows=chunk_rows)       # no halo: every row is home
    one_plus = F.lit(1.0) + F.col(r)
    carry = sq.chunk_carries(laid, key, {"_cp": (F.product(one_plus), "product")})
    x = laid.join(carry, on=[*key, sq.CHUNK], how="inner")
    x = x.withColumn(cum, F.col("_cp") * sq.running(F.product(one_plus), key))
    x = x.withColumn("_lm", sq.running(F.max(cum), key))
    carry_m = sq.chunk_carries(x, key, {"_cm": (F.max(cum), "max")})
    x = x.join(carry_m, on=[*key, sq.CHUNK], how="inner")
    x = x.withColumn("running_max", F.greatest(F.col("_cm"), F.col("_lm")))   # greatest skips NULLs
    x = x.withColumn(drawdown, F.try_divide(F.col(cum) - F.col("running_max"), F.col("running_max")))
    return sq.home_rows(x).drop("_cp", "_lm", "_cm")


def weekly_bull_bear(df: DataFrame, price="close", key="asset", ts="ts", tiebreak=None,
                     bull=60.0, bear=40.0, chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """W-16: weekly return -> bull/bear proxy. A missing return counts as not
    ``>= 0`` (the reference's NaN comparison), so the first row is bearish."""
    def build(d):
        ret = pct_change_col(key, price, 1)
        up = F.coalesce(ret >= 0, F.lit(False))
        d = d.withColumn("weekly_return", ret)
        d = d.withColumn("bullish", F.when(up, F.lit(bull)).otherwise(F.lit(bear)))
        d = d.withColumn("bearish", F.when(up, F.lit(bear)).otherwise(F.lit(bull)))
        d = d.withColumn("neutral", F.lit(0.0))
        return d.withColumn("bull_bear_spread", F.col("bullish") - F.col("bearish"))
    return on_series(df, key, _order(ts, tiebreak), build, back=1, chunk_rows=chunk_rows)


# ---- documented-only indicators (E-01..E-08), textbook definitions ------------

def extended_features(bars: DataFrame, key="asset", ts="ts", tiebreak=None,
                      chunk_rows=sq.DEFAULT_CHUNK_ROWS, gaps=True) -> DataFrame:
    """E-01..E-03, E-07: returns 1/5/20/60, range, spread, gap, SMA 10/20/50/200,
    EMA 12/26, Bollinger(20, 2) and band position, ATR 14 (simple mean of true
    range), stochastic %K 14, Williams %R 14, OBV (0 on the first row), volume
    ROC 10, cumulative VWAP of the typical price, day-of-week sin/cos.

    OBV and VWAP are unbounded running sums: the sums of earlier chunks come from
    a small carry table computed from the indexed rows plus one lag, joined
    before the feature windows (which are then evaluated once). The EMAs pass over
    missing closes; ``gaps=False`` is the shorter plan where there are none."""
    key_l = _cols(key)
    ix = sq.with_row_index(bars, key, _order(ts, tiebreak))
    if gaps:
        ix = sq.ewm_gaps(ix, "close", {"ema_12": 12, "ema_26": 26}, key, chunk_rows=chunk_rows)
    laid = sq.with_halo(ix, back=max(sq.ewm_halo(26), 201), chunk_rows=chunk_rows)
    w = chunk_window(key)
    c = F.col("close")
    prev_c = F.lag("close", 1).over(w)
    base = laid.withColumn("_sv", F.when(c > prev_c, F.col("volume")).when(c < prev_c, -F.col("volume"))
                           .otherwise(F.lit(0.0)))
    base = base.withColumn("_pv", (F.col("high") + F.col("low") + c) / 3 * F.col("volume"))
    home = base.filter(F.col(sq.HOME))
    carry = sq.chunk_carries(home, key, {"_c_sv": (F.sum("_sv"), "sum"), "_c_pv": (F.sum("_pv"), "sum"),
                                         "_c_v": (F.sum("volume"), "sum")})
    d = base.join(carry, on=[*key_l, sq.CHUNK], how="inner")
    for k in (1, 5, 20, 60):
        d = d.withColumn(f"return_{k}", pct_change_col(key, "close", k))
    d = d.withColumn("hl_range", F.try_divide(F.col("high") - F.col("low"), c))
    d = d.withColumn("co_spread", F.try_divide(c - F.col("open"), F.col("open")))
    d = d.withColumn("overnight_gap", F.try_divide(F.col("open"), prev_c) - 1)
    for k in (10, 20, 50, 200):
        d = d.withColumn(f"sma_{k}", full_rolling(F.avg(c), c, key, k))
    if not gaps:
        d = sq.ewm_many(d, [("close", "ema_12", 12), ("close", "ema_26", 26)], key)
    sd = full_rolling(F.stddev_samp(c), c, key, 20)
    d = d.withColumn("bb_upper", F.col("sma_20") + 2 * sd).withColumn("bb_lower", F.col("sma_20") - 2 * sd)
    d = d.withColumn("bb_position", F.try_divide(c - F.col("bb_lower"), F.col("bb_upper") - F.col("bb_lower")))
    tr = F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - prev_c), F.abs(F.col("low") - prev_c))
    d = d.withColumn("_tr", F.when(prev_c.isNull(), F.col("high") - F.col("low")).otherwise(tr))
    d = d.withColumn("atr_14", full_rolling(F.avg("_tr"), F.col("_tr"), key, 14))
    hh = full_rolling(F.max("high"), F.col("high"), key, 14)
    ll = full_rolling(F.min("low"), F.col("low"), key, 14)
    d = d.withColumn("stoch_k_14", F.try_divide(c - ll, hh - ll) * 100)
    d = d.withColumn("williams_r_14", F.try_divide(hh - c, hh - ll) * -100)
    d = d.withColumn("volume_roc_10", pct_change_col(key, "volume", 10))
    d = d.withColumns(dict(zip(["dow_sin", "dow_cos"], day_of_week_encoding(ts))))
    # running sums over home rows only (halo copies belong to the previous chunk)
    home_only = F.col(sq.HOME)
    d = d.withColumn("obv", F.col("_c_sv") + sq.running(F.sum(F.when(home_only, F.col("_sv"))), key))
    cum_pv = F.col("_c_pv") + sq.running(F.sum(F.when(home_only, F.col("_pv"))), key)
    cum_v = F.col("_c_v") + sq.running(F.sum(F.when(home_only, F.col("volume"))), key)
    d = d.withColumn("vwap", F.try_divide(cum_pv, cum_v))
    return sq.home_rows(d).drop("_sv", "_pv", "_tr", "_c_sv", "_c_pv", "_c_v", RN, N)


def day_of_week_encoding(ts: str = "ts") -> list[Column]:
    """E-07: sin / cos of 2*pi*weekday/7 with Monday = 0 .. Sunday = 6."""
    dow = (F.dayofweek(F.col(ts)) + 5) % 7
    return [F.sin(2 * F.pi() * dow / 7).alias("dow_sin"), F.cos(2 * F.pi() * dow / 7).alias("dow_cos")]


def cross_asset_correlation(returns: DataFrame, pairs: DataFrame, key="asset", ts="ts", value="log_return",
                            window=20, chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """E-04: rolling Pearson correlation for an explicit (left, right) pair list.

    The pair list bounds the output (no all-pairs expansion). Both legs are
    aligned on ts with an equi-join, then the rolling ``corr`` runs per pair in
    the chunk layout."""
    left = returns.select(F.col(key).alias("left"), ts, F.col(value).alias("x"))
    right = returns.select(F.col(key).alias("right"), ts, F.col(value).alias("y"))
    aligned = (pairs.select("left", "right").join(left, "left").join(right, ["right", ts])
                    .filter(F.col("x").isNotNull() & F.col("y").isNotNull()))

    def build(d):
        both = F.col("x") + F.col("y")
        return d.withColumn("correlation", F.when(rolling(F.count(both), ["left", "right"], window) == window,
                                                  rolling(F.corr("x", "y"), ["left", "right"], window)))
    return on_series(aligned, ["left", "right"], [ts], build, back=window, chunk_rows=chunk_rows)


def forward_fill(df: DataFrame, cols: Sequence[str], key="asset", ts="ts", limit=5, tiebreak=None,
                 chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """E-05: fill NULLs from at most ``limit`` rows back, then drop rows still missing."""
    def build(d):
        w = chunk_window(key).rowsBetween(-limit, 0)
        return d.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in cols})
    return on_series(df, key, _order(ts, tiebreak), build, back=limit, chunk_rows=chunk_rows).na.drop(
        how="any", subset=list(cols))


def position_backtest(df: DataFrame, ret="actual", signal="prediction", key="asset", ts="ts",
                      cost=0.001, size=1.0, tiebreak=None, chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """E-08: position = size*sign(signal); pnl = ret*position - cost*|position change|."""
    def build(d):
        pos = F.lit(size) * F.signum(F.col(signal))
        d = d.withColumn("position", pos)
        prev = F.coalesce(F.lag("position", 1).over(chunk_window(key)), F.lit(0.0))
        d = d.withColumn("turnover", F.abs(F.col("position") - prev))
        return d.withColumn("pnl", F.col(ret) * F.col("position") - F.lit(cost) * F.col("turnover"))
    return on_series(df, key, _order(ts, tiebreak), build, back=1, chunk_rows=chunk_rows)
