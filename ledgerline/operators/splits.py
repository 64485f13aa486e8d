"""Temporal train/test splits as rows (M-01..M-05, M-07).

A fold is not a Python list of slices: every row carries ``fold`` and
``role`` ('train' / 'test') and appears once per fold it belongs to. Fold
membership is closed-form in the row position ``rn`` and series length ``n``
(from :func:`ledgerline.plans.sequence.with_row_index`), so all folds of all
series are produced by one ``explode`` with no loop and no join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.plans import sequence as sq
from ledgerline.plans.sequence import N, RN


def require_temporal(df: DataFrame, ts: str) -> None:
    """M-04: the order column must be a date/timestamp (order is by construction)."""
    dt = df.schema[ts].dataType
    if not isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        raise ValueError(f"column {ts!r} must be temporal, got {dt.simpleString()}")


def temporal_disorder(df: DataFrame, ts: str, sequence: str, key="asset",
                      chunk_rows: int = sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """M-04: per series its rows ``n`` and the rows that are earlier than the one
    before them in input order (``out_of_order``). A table has no order of its
    own: ``sequence`` is the column that numbers the input."""
    require_temporal(df, ts)
    keys = [key] if isinstance(key, str) else list(key)
    laid = sq.with_halo(sq.with_row_index(df.select(*keys, ts, sequence), keys, [sequence]), back=1, chunk_rows=chunk_rows)
    late = F.lag(ts).over(sq.chunk_window(keys)) > F.col(ts)
    return sq.home_rows(laid.withColumn("_late", late)).groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_late").alias("out_of_order"))


def require_sorted(df: DataFrame, ts: str, sequence: str, key="asset") -> None:
    """M-04: raises unless every series is in time order in its input (one job)."""
    late = temporal_disorder(df, ts, sequence, key).agg(F.sum("out_of_order")).first()[0]
    if late:
        raise ValueError(f"{late} rows are earlier than the row before them")


def _order(ts, tiebreak):
    return [ts] + ([tiebreak] if tiebreak else [])


def _fold_rows(df: DataFrame, lo: Column, hi: Column, role: Column) -> DataFrame:
    out = (df.filter(lo <= hi)   # Spark's sequence counts down when lo > hi
             .withColumn("fold", F.explode(F.sequence(lo.cast("int"), hi.cast("int")))))
    return out.withColumn("role", role)


def walk_forward_split(df: DataFrame, train_size: int, test_size: int, step: int | None = None,
                       key="asset", ts="ts", tiebreak=None, indexed: bool = False) -> DataFrame:
    """M-01: fold k trains on rows [k*step, k*step+train) and tests on the next
    ``test_size`` rows, for every k whose test end is <= n. step defaults to test."""
    require_temporal(df, ts)
    a, b, s = train_size, test_size, step or test_size
    ix = df if indexed else sq.with_row_index(df, key, _order(ts, tiebreak))
    rn, n = F.col(RN), F.col(N)
    k_max = F.floor((n - a - b) / s)
    lo = F.greatest(F.lit(0), F.ceil((rn - a - b + 1) / s))
    hi = F.least(k_max, F.floor(rn / s))
    ix = ix.filter(n >= a + b)
    out = _fold_rows(ix, lo, hi, F.lit(None))
    return out.withColumn("role", F.when(rn < F.col("fold") * s + a, "train").otherwise("test"))


def expanding_window_split(df: DataFrame, initial_train_size: int, test_size: int,
                           step: int | None = None, key="asset", ts="ts", tiebreak=None,
                           indexed: bool = False) -> DataFrame:
    """M-02: fold k trains on rows [0, init + k*step) and tests on the next
    ``test_size`` rows. A train row belongs to many folds; when only fold
    bounds or statistics are needed use :func:`expanding_fold_bounds` or
    :func:`expanding_fold_stats`, which are linear in the rows."""
    require_temporal(df, ts)
    i, b, s = initial_train_size, test_size, step or test_size
    ix = df if indexed else sq.with_row_index(df, key, _order(ts, tiebreak))
    rn, n = F.col(RN), F.col(N)
    k_max = F.floor((n - i - b) / s)
    lo = F.greatest(F.lit(0), F.ceil((rn - i - b + 1) / s))
    ix = ix.filter(n >= i + b)
    out = _fold_rows(ix, lo, k_max, F.lit(None))
    return out.withColumn("role", F.when(rn < F.col("fold") * s + i, "train").otherwise("test"))


def expanding_fold_bounds(lengths: DataFrame, initial_train_size: int, test_size: int,
                          step: int | None = None, key: Sequence[str] = ("asset",)) -> DataFrame:
    """Fold table (key, fold, train_end, test_end) from per-series lengths ``n``;
    rows join to it with ``rn < test_end`` only for the columns they need."""
    i, b, s = initial_train_size, test_size, step or test_size
    k_max = F.floor((F.col(N) - i - b) / s).cast("int")
    out = lengths.filter(F.col(N) >= i + b).select(*key, F.explode(F.sequence(F.lit(0), k_max)).alias("fold"))
    return out.select(*key, "fold", (F.col("fold") * s + i).alias("train_end"),
                      (F.col("fold") * s + i + b).alias("test_end"))


def expanding_fold_stats(df: DataFrame, value: str, initial_train_size: int, test_size: int,
                         step: int | None = None, key="asset", ts="ts", tiebreak=None,
                         indexed: bool = False) -> DataFrame:
    """M-02 without a row for each (train row, fold): per series and fold the bounds
    and count, mean, population deviation of ``value`` over train and test rows.

    Rows are summed per block between two fold bounds, a prefix over that small
    table gives the train side of each fold; only test rows are repeated, at most
    ``ceil(test_size / step)`` times. Output and work are linear in the rows.
    """
    require_temporal(df, ts)
    i, b, s = initial_train_size, test_size, step or test_size
    keys = [key] if isinstance(key, str) else list(key)
    ix = df if indexed else sq.with_row_index(df.select(*keys, ts, *([tiebreak] if tiebreak else []), value), key,
                                              _order(ts, tiebreak))
    rn, x = F.col(RN), F.col(value).cast("double")
    k_max = F.floor((F.col(N) - i - b) / s).cast("int")
    ix = ix.filter(F.col(N) >= i + b).withColumn("_last", k_max)
    sums = [F.count("_x").alias("_c"), F.sum("_x").alias("_s"), F.sum(F.col("_x") * F.col("_x")).alias("_q")]
    blocks = (ix.withColumn("_x", x).withColumn("fold", F.greatest(F.lit(0), F.floor((rn - i) / s) + 1).cast("int"))
              .filter("fold <= _last").groupBy(*keys, "fold").agg(*sums))
    upto = Window.partitionBy(*keys).orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)
    train = blocks.select(*keys, "fold", *[F.sum(c).over(upto).alias(c) for c in ("_c", "_s", "_q")])
    lo = F.greatest(F.lit(0), F.ceil((rn - i - b + 1) / s))
    hi = F.least(F.col("_last"), F.floor((rn - i) / s))
    test = _fold_rows(ix.filter(rn >= i).withColumn("_x", x), lo, hi, F.lit("test")).groupBy(*keys, "fold").agg(*sums)

    def stats(side):
        mean = F.try_divide("_s", "_c")
        var = F.greatest(F.try_divide("_q", "_c") - mean * mean, F.lit(0.0))
        return [F.col("_c").alias(f"{side}_size"), mean.alias(f"{side}_mean"), F.sqrt(var).alias(f"{side}_std")]
    return (train.select(*keys, "fold", (F.col("fold") * s + i).alias("train_end"),
                         (F.col("fold") * s + i + b).alias("test_end"), *stats("train"))
            .join(test.select(*keys, "fold", *stats("test")), [*keys, "fold"]))


def single_train_test_split(df: DataFrame, train_ratio: float = 0.8, key="asset", ts="ts",
                            tiebreak=None, indexed: bool = False) -> DataFrame:
    """M-03: first floor(n * ratio) rows train, rest test (same double product as
    the reference: 0.8 is the literal double 0.8)."""
    require_temporal(df, ts)
    ix = df if indexed else sq.with_row_index(df, key, _order(ts, tiebreak))
    cut = F.floor(F.col(N).cast("double") * F.lit(float(train_ratio)))
    return ix.withColumn("role", F.when(F.col(RN) < cut, "train").otherwise("test"))


def hash_split(df: DataFrame, id_col: str, test_fraction: float = 0.1, seed: int = 42,
               buckets: int = 1000) -> DataFrame:
    """M-05: stable random split: the first 32 bits of ``md5(seed:id)`` modulo
    ``buckets`` below ``fraction * buckets`` is test. Depends only on the id, so it
    is unchanged by repartitioning or input order (unlike ``randomSplit``) and any
    engine with md5 can repeat it. A NULL id is train."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")).cast("binary"))
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % F.lit(buckets)
    return df.withColumn("role", F.when(h < int(round(test_fraction * buckets)), "test").otherwise("train"))


def fold_sizes(folds: DataFrame, key: Sequence[str] = ("fold",)) -> DataFrame:
    """Train / test row counts per fold."""
    return folds.groupBy(*key).agg(
        F.count(F.when(F.col("role") == "train", 1)).alias("train_size"),
        F.count(F.when(F.col("role") == "test", 1)).alias("test_size"))


def usable_folds(folds: DataFrame, min_train: int = 50, min_test: int = 10,
                 key: Sequence[str] = ("fold",)) -> DataFrame:
    """M-07: keep folds with >= min_train train rows and >= min_test test rows
    (fold sizes is a small table: one row per fold)."""
    sizes = fold_sizes(folds, key).filter((F.col("train_size") >= min_train) & (F.col("test_size") >= min_test))
    return folds.join(sizes.select(*key), on=list(key), how="left_semi")


def standardize_train_only(folds: DataFrame, cols: Sequence[str], key: Sequence[str] = ("asset", "fold"),
                           suffix: str = "_z") -> DataFrame:
    """E-06: per (asset, fold), mean and population std from the fold's train rows
    only, applied to its train and test rows (no test information leaks into the
    scaling). The statistics table has one row per (asset, fold) and is joined
    back on those keys."""
    key = list(key)
    stats = folds.filter(F.col("role") == "train").groupBy(*key).agg(
        *[F.avg(c).alias(f"_mu_{c}") for c in cols], *[F.stddev_pop(c).alias(f"_sd_{c}") for c in cols])
    out = folds.join(stats, on=key, how="inner")
    out = out.withColumns({f"{c}{suffix}": F.try_divide(F.col(c) - F.col(f"_mu_{c}"), F.col(f"_sd_{c}"))
                           for c in cols})
    return out.drop(*[f"_mu_{c}" for c in cols], *[f"_sd_{c}" for c in cols])
