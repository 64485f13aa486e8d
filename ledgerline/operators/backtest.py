"""Model backtest (M-06, M-08): one linear model per asset class and fold, all folds in one job.

A fold's model needs only sums over its train rows (counts, sums and products of
features and target). Rows are summed once per block of ``step`` rows; a fold is
a few blocks (walk-forward) or a prefix of blocks (expanding), so no train row is
repeated for each of its folds and there is no loop over folds. The small table
of sums, one row per (class, fold), is solved on the executors; the coefficients
are joined to the test rows, where the prediction is a column expression.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import gcd

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.operators import metrics as M
from ledgerline.operators.features import FEATURE_COLUMNS
from ledgerline.operators.splits import require_temporal
from ledgerline.plans import sequence as sq
from ledgerline.plans.sequence import N, RN
from ledgerline.session import cut_lineage

SCHEMES = ("walk_forward", "expanding")


def _moments(features: Sequence[str], label: str) -> list[Column]:
    """1, the columns, and every product of two of them (upper triangle), as one list of sums."""
    x = [F.col(c).cast("double") for c in [*features, label]]
    terms = [F.lit(1.0), *x, *[a * b for i, a in enumerate(x) for b in x[i:]]]
    return [F.sum(t).alias(f"_m{i}") for i, t in enumerate(terms)]


def solve_ridge(moments: np.ndarray, n_features: int, ridge: float) -> np.ndarray | None:
    """Intercept and coefficients of least squares on standardised features with a
    ridge of ``ridge`` rows, from the sums of :func:`_moments`; None without rows."""
    p, n = n_features, moments[0]
    if not n > 0:
        return None
    mean = moments[1:p + 2] / n
    cov = np.zeros((p + 1, p + 1))
    cov[np.triu_indices(p + 1)] = moments[p + 2:] / n
    cov = np.triu(cov) + np.triu(cov, 1).T - np.outer(mean, mean)
    sd = np.sqrt(np.maximum(np.diag(cov)[:p], 0.0))
    # a constant feature has no spread and takes no part
    use = sd > 1e-9 * (1 + np.abs(mean[:p]))
    coef = np.zeros(p)
    if use.any():
        scale = sd[use]
        corr = cov[:p, :p][np.ix_(use, use)] / np.outer(scale, scale)
        coef[use] = np.linalg.solve(corr + np.eye(use.sum()) * ridge / n, cov[:p, p][use] / scale) / scale
    return np.concatenate([[mean[p] - coef @ mean[:p]], coef])


def _fold_span(scheme: str, rn: Column, n: Column, train: int, test: int, step: int) -> tuple[Column, Column]:
    """First and last fold in which the row at position ``rn`` is a test row."""
    last = F.floor((n - train - test) / step)
    lo = F.greatest(F.lit(0), F.ceil((rn - train - test + 1) / step))
    return lo.cast("int"), F.least(last, F.floor((rn - train) / step)).cast("int")


def fit_folds(indexed: DataFrame, features: Sequence[str], label: str, train: int, test: int, step: int,
              scheme: str, group: Sequence[str], key: Sequence[str], ridge: float = 1.0) -> DataFrame:
    """(group, fold, train_size, coef) for every fold; ``indexed`` has positions ``rn`` and lengths ``n``."""
    sums = _moments(features, label)
    names = [f"_m{i}" for i in range(len(sums))]
    rn, last = F.col(RN), F.floor((F.col(N) - train - test) / step).cast("int")
    rows = indexed.filter(F.col(N) >= train + test).withColumn("_last", last)
    if scheme == "walk_forward":
        g = gcd(train, step)
        blocks = rows.groupBy(*group, "_last", F.floor(rn / g).alias("_b")).agg(*sums)
        lo = F.greatest(F.lit(0), F.floor((F.col("_b") * g - train) / step) + 1).cast("int")
        hi = F.least(F.col("_last"), F.floor(F.col("_b") * g / step)).cast("int")
        parts = blocks.filter(lo <= hi).withColumn("fold", F.explode(F.sequence(lo, hi)))
    else:
        # the fold from which on a row is a train row; a prefix per series over its folds. Every fold has
        # a row here, as each new fold brings `step` new rows
        start = F.greatest(F.lit(0), F.floor((rn - train) / step) + 1).cast("int")
        blocks = rows.withColumn("fold", start).filter("fold <= _last").groupBy(*group, *key, "fold").agg(*sums)
        upto = Window.partitionBy(*group, *key).orderBy("fold").rowsBetween(Window.unboundedPreceding, 0)
        parts = blocks.select(*group, "fold", *[F.sum(c).over(upto).alias(c) for c in names])
    total = parts.groupBy(*group, "fold").agg(F.array(*[F.sum(c) for c in names]).alias("_m"))
    p = len(features)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            coef = [solve_ridge(np.asarray(m, dtype=float), p, ridge) for m in b["_m"]]
            yield b.drop(columns="_m").assign(train_size=[int(m[0]) for m in b["_m"]], coef=coef)

    kinds = ", ".join(f"`{c}` {total.schema[c].dataType.simpleString()}" for c in [*group, "fold"])
    return total.mapInPandas(run, f"{kinds}, train_size long, coef array<double>")


def backtest(df: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = "target", train_size: int = 200,
             test_size: int = 100, step: int | None = None, scheme: str = "walk_forward",
             group: Sequence[str] = ("asset_class",), key: Sequence[str] = ("asset",), ts: str = "ts",
             keep: Sequence[str] = (), min_train: int = 50, min_test: int = 10, ridge: float = 1.0,
             task: str = "regression") -> DataFrame:
    """M-08: the prediction table of a backtest: (group, key, ts, fold, train_size,
    test_size, prediction, actual, ``keep``), one row per test row and fold.

    Incomplete rows (a feature or the label is NULL) are left out first; folds are
    counted per series over what remains, and a fold's model is fitted on the
    train rows of all series of its group. Folds with fewer than ``min_train``
    train or ``min_test`` test rows are skipped. ``expanding`` trains on rows
    [0, train_size + k*step), ``walk_forward`` on [k*step, k*step + train_size).
    ``classification`` expects a 0/1 label: the prediction is its linear
    probability, cut to 0..1. Features are those of the rows given: they look
    back only, so none sees its test period. The complete rows are checkpointed
    once, numbered, in the shared folder."""
    if scheme not in SCHEMES or task not in ("regression", "classification"):
        raise ValueError(f"unknown scheme {scheme!r} or task {task!r}")
    require_temporal(df, ts)
    step, group, key = step or test_size, list(group), list(key)
    columns = list(dict.fromkeys([*group, *key, ts, *features, label, *keep]))
    rows = df.select(*columns).na.drop(how="any", subset=[*features, label])
    # models, test rows and sizes all read the numbered rows: the features are computed once, not for each
    indexed = cut_lineage(sq.with_row_index(rows, key, [ts]))
    models = fit_folds(indexed, features, label, train_size, test_size, step, scheme, group, key, ridge)
    lo, hi = _fold_span(scheme, F.col(RN), F.col(N), train_size, test_size, step)
    test = (indexed.filter((F.col(N) >= train_size + test_size) & (F.col(RN) >= train_size)).filter(lo <= hi)
            .withColumn("fold", F.explode(F.sequence(lo, hi))))
    sizes = test.groupBy(*group, "fold").agg(F.count(F.lit(1)).alias("test_size"))
    usable = models.join(sizes, [*group, "fold"]).filter(
        (F.col("train_size") >= min_train) & (F.col("test_size") >= min_test))
    value = F.col("coef")[0]
    for i, c in enumerate(features):
        value = value + F.col("coef")[i + 1] * F.col(c).cast("double")
    if task == "classification":
        value = F.greatest(F.lit(0.0), F.least(F.lit(1.0), value))
    return test.join(usable, [*group, "fold"]).select(
        *group, *key, ts, "fold", "train_size", "test_size", value.alias("prediction"),
        F.col(label).alias("actual"), *keep)


def fold_record(pred: DataFrame, group: Sequence[str] = ("asset_class",), key: str = "asset", ts: str = "ts") -> DataFrame:
    """M-08: sizes and all forecast metrics per (group, fold)."""
    sizes = pred.groupBy(*group, "fold").agg(F.max("train_size").alias("train_size"),
                                             F.max("test_size").alias("test_size"))
    return M.all_metrics(pred, group=[*group, "fold"], order=(ts, key)).join(sizes, [*group, "fold"])


def pooled_record(pred: DataFrame, group: Sequence[str] = ("asset_class",), key: str = "asset", ts: str = "ts") -> DataFrame:
    """M-08: number of folds and all forecast metrics per group over the test rows
    of all its folds, in (time, series) order; test periods must not overlap
    (``step >= test_size``)."""
    folds = pred.groupBy(*group).agg(F.count_distinct("fold").alias("folds"))
    return M.all_metrics(pred, group=list(group), order=(ts, key)).join(folds, list(group))


def class_record(pred: DataFrame, group: Sequence[str] = ("asset_class",), cut: float = 0.5) -> DataFrame:
    """M-08 for 0/1 labels: accuracy, precision, recall and F1 of class 1 per (group, fold); 0 where undefined."""
    up, real = F.col("prediction") > cut, F.col("actual") == 1
    hit, said, are = F.count_if(up & real), F.count_if(up), F.count_if(real)
    ratio = lambda a, b: F.coalesce(F.try_divide(a, b), F.lit(0.0))
    return pred.groupBy(*group, "fold").agg(
        F.max("train_size").alias("train_size"), F.max("test_size").alias("test_size"),
        F.avg((up == real).cast("double")).alias("accuracy"), ratio(hit, said).alias("precision"),
        ratio(hit, are).alias("recall"), ratio(2 * hit, said + are).alias("f1"))
