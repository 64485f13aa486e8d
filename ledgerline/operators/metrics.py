"""Forecast, strategy and classification metrics by group (M-10..M-25).

Metrics are aggregates, so any grouping (per fold, per asset, pooled) is one
``groupBy``. The only order-dependent metrics (max drawdown, Calmar, total
return) need the compounded curve, computed with the two-level chunk scan of
:func:`ledgerline.operators.features.cumulative_curve` instead of one
unpartitioned window.

Definitions (population std for Sharpe / Sortino, sample std elsewhere):
  mae = mean|y-p|, rmse = sqrt(mean (y-p)^2), mape = mean|(y-p)/y|*100 over
  y != 0, reported only when no y is 0; direction_accuracy = mean(sign y = sign p);
  hit_rate = 100 * that; strategy return r = y*sign(p); sharpe =
  mean(e)/std_pop(e)*sqrt(252) with e = r - rf/252 (0 when empty or std_pop(r)=0);
  sortino = mean(e)/std_pop(e | e<0)*sqrt(252) (0 when no e<0 or that std is 0);
  profit_factor = sum(r>0)/|sum(r<0)| (no losses: Infinity if gains else 0);
  cumulative = prod(1+r) in order; max_drawdown = 100*min((c-max c)/max c);
  calmar = ((last c)^(252/n) - 1)*100/|mdd| (0 when mdd = 0; NULL when the
  power is undefined); total_return = (last c - 1)*100.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.features import cumulative_curve
from ledgerline.plans import sequence as sq

ANNUAL = 252


def _z(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def forecast_aggs(y: Column, p: Column) -> list[Column]:
    """M-10..M-13 as aggregate expressions."""
    err = y - p
    any_zero = F.sum(F.when(y == 0, 1).otherwise(0)) > 0
    agree = (F.signum(y) == F.signum(p)).cast("double")
    return [
        F.avg(F.abs(err)).alias("mae"),
        F.sqrt(F.avg(err * err)).alias("rmse"),
        F.when(~any_zero, F.avg(F.abs(F.try_divide(err, y))) * 100).alias("mape"),
        F.avg(agree).alias("direction_accuracy"),
        (F.avg(agree) * 100).alias("hit_rate"),
    ]


def strategy_aggs(r: Column, risk_free_rate: float = 0.0) -> list[Column]:
    """M-14, M-15, M-18 on strategy returns r."""
    e = r - F.lit(risk_free_rate / ANNUAL)
    sd = F.stddev_pop(e)
    neg = F.when(e < 0, e)
    sd_neg = F.stddev_pop(neg)
    gains = _z(F.sum(F.when(r > 0, r)))
    losses = F.abs(_z(F.sum(F.when(r < 0, r))))
    root = F.lit(math.sqrt(ANNUAL))
    return [
        F.when((F.count(r) == 0) | (F.stddev_pop(r) == 0) | F.stddev_pop(r).isNull(), F.lit(0.0))
         .otherwise(F.avg(e) / sd * root).alias("sharpe_ratio"),
        F.when((F.count(neg) == 0) | (sd_neg == 0), F.lit(0.0))
         .otherwise(F.avg(e) / sd_neg * root).alias("sortino_ratio"),
        F.when(losses == 0, F.when(gains > 0, F.lit(float("inf"))).otherwise(F.lit(0.0)))
         .otherwise(gains / losses).alias("profit_factor"),
    ]


def order_free_metrics(pred: DataFrame, group: Sequence[str] = (), actual="actual", prediction="prediction",
                       risk_free_rate: float = 0.0) -> DataFrame:
    """M-10..M-15, M-18: one aggregate with map-side partials, in any order of the rows."""
    y, p = F.col(actual), F.col(prediction)
    return pred.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), *forecast_aggs(y, p),
                                    *strategy_aggs(y * F.signum(p), risk_free_rate))


def curve_metrics(pred: DataFrame, group: Sequence[str] = (), actual="actual", prediction="prediction",
                  order: Sequence[str] = ("ts",), chunk_rows: int = sq.DEFAULT_CHUNK_ROWS,
                  others: Sequence[Column] = ()) -> DataFrame:
    """M-16, M-17, M-19: the metrics of the compounded curve, for each group; ``others`` are aggregates over
    the same rows (``_r`` is the strategy return)."""
    if len(order) > 2:
        raise ValueError("order supports at most two columns (time, tie-break)")
    rows = pred.select(*group, *order, actual, prediction, (F.col(actual) * F.signum(F.col(prediction))).alias("_r"))
    key = list(group) or ["_all"]
    if not group:
        rows = rows.withColumn("_all", F.lit(0))
    curve = cumulative_curve(rows, "_r", key, ts=order[0], tiebreak=order[1] if len(order) > 1 else None,
                             cum="_cum", drawdown="_dd", chunk_rows=chunk_rows)
    last_cum = F.max_by("_cum", F.struct(*[F.col(o) for o in order]))
    mdd = F.coalesce(F.min("_dd") * 100, F.lit(0.0))
    ann = F.try_subtract(F.pow(last_cum, F.lit(float(ANNUAL)) / F.count(F.lit(1))), F.lit(1.0)) * 100
    calmar = F.when(F.abs(mdd) == 0, F.lit(0.0)).otherwise(F.when(~F.isnan(ann), ann / F.abs(mdd)))
    out = curve.groupBy(*key).agg(*others, mdd.alias("max_drawdown"), calmar.alias("calmar_ratio"),
                                  ((last_cum - 1) * 100).alias("total_return"))
    return out if group else out.drop("_all")


def all_metrics(pred: DataFrame, group: Sequence[str] = (), actual="actual", prediction="prediction",
                order: Sequence[str] = ("ts",), risk_free_rate: float = 0.0,
                chunk_rows: int = sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """M-20: every metric of ``calculate_all_metrics`` for each group, one row per group, in one pass over the
    rows of the curve.

    ``order`` orders the compounded curve inside a group (make it total, e.g.
    ``('ts', 'asset')`` for a pooled curve over several assets)."""
    y, p = F.col(actual), F.col(prediction)
    free = [F.count(F.lit(1)).alias("n"), *forecast_aggs(y, p), *strategy_aggs(F.col("_r"), risk_free_rate)]
    return curve_metrics(pred, group, actual, prediction, order, chunk_rows, free)


# ---- classification (M-21..M-25) ---------------------------------------------

DEFAULT_CLASSES = ("positive", "negative", "neutral")


def confusion_long(df: DataFrame, y_true="y_true", y_pred="y_pred", classes=DEFAULT_CLASSES,
                   group: Sequence[str] = ()) -> DataFrame:
    """M-23: confusion counts as a long table (true, pred, count) in fixed class
    order, every class pair present (zeros included). The class list is a
    literal of a few rows, crossed with the group keys only."""
    group = list(group)
    grid = F.array(*[F.struct(F.lit(i).alias("true_idx"), F.lit(a).alias("true_label"),
                              F.lit(j).alias("pred_idx"), F.lit(b).alias("pred_label"))
                     for i, a in enumerate(classes) for j, b in enumerate(classes)])
    counts = (df.groupBy(*group, F.col(y_true).alias("true_label"), F.col(y_pred).alias("pred_label"))
                .agg(F.count(F.lit(1)).alias("count")))
    # every (group, true, pred) cell of the fixed class grid, generated by explode
    keys = counts.select(*group).distinct() if group else df.sparkSession.range(1).select()
    pairs = keys.select(*group, F.inline(grid))
    out = pairs.join(counts, on=[*group, "true_label", "pred_label"], how="left")
    return out.select(*group, "true_idx", "true_label", "pred_idx", "pred_label",
                      F.coalesce("count", F.lit(0)).cast("long").alias("count"))


def classification_report(df: DataFrame, y_true="y_true", y_pred="y_pred", classes=DEFAULT_CLASSES,
                          group: Sequence[str] = ()) -> tuple[DataFrame, DataFrame]:
    """M-21 / M-22: per-class precision, recall, F1, support (zero division -> 0)
    and the summary row (accuracy, macro and weighted averages, samples).

    Support is by true label, predictions by predicted label; accuracy and samples
    are over all rows, whatever was predicted (a NULL or unlisted prediction is
    wrong). The data is scanned once, into (true, predicted) counts."""
    group = list(group)
    counts = df.groupBy(*group, F.col(y_true).alias("_t"), F.col(y_pred).alias("_p")).agg(F.count(F.lit(1)).alias("_c"))
    hit = F.coalesce(F.col("_t") == F.col("_p"), F.lit(False))
    sums = counts.groupBy(*group).agg(
        F.sum("_c").alias("_rows"), F.coalesce(F.sum(F.when(hit, F.col("_c"))), F.lit(0)).alias("_hits"),
        *[F.coalesce(F.sum(F.when(cond & (F.col("_p" if k == "predicted" else "_t") == c), F.col("_c"))), F.lit(0))
          .alias(f"_{k}{i}") for i, c in enumerate(classes)
          for k, cond in (("support", F.lit(True)), ("tp", hit), ("predicted", F.lit(True)))])
    per = sums.select(*group, "_rows", "_hits", F.inline(F.array(*[F.struct(
        F.lit(c).alias("label"), *[F.col(f"_{k}{i}").alias(k) for k in ("support", "tp", "predicted")])
        for i, c in enumerate(classes)])))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(F.lit(0.0))
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(F.lit(0.0))
    per = per.withColumn("precision", prec).withColumn("recall", rec)
    per = per.withColumn("f1", F.when(F.col("precision") + F.col("recall") > 0,
                                      2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")))
                         .otherwise(F.lit(0.0)))
    total = F.sum("support")
    k = F.lit(float(len(classes)))
    summary = per.groupBy(*group).agg(
        F.coalesce(F.try_divide(F.max("_hits"), F.max("_rows")), F.lit(0.0)).alias("accuracy"),
        (F.sum("precision") / k).alias("macro_precision"),
        (F.sum("recall") / k).alias("macro_recall"),
        (F.sum("f1") / k).alias("macro_f1"),
        F.coalesce(F.try_divide(F.sum(F.col("precision") * F.col("support")), total), F.lit(0.0)).alias("weighted_precision"),
        F.coalesce(F.try_divide(F.sum(F.col("recall") * F.col("support")), total), F.lit(0.0)).alias("weighted_recall"),
        F.coalesce(F.try_divide(F.sum(F.col("f1") * F.col("support")), total), F.lit(0.0)).alias("weighted_f1"),
        F.coalesce(F.max("_rows"), F.lit(0)).cast("long").alias("num_samples"),
    )
    per = per.select(*group, "label", "precision", "recall", "f1", F.col("support").cast("long").alias("support"))
    return per, summary


def compare_classifiers(df: DataFrame, y_true: str, preds: Sequence[str], classes=DEFAULT_CLASSES):
    """M-24: stack the prediction columns into (model, y_pred) rows and report
    per model in one pass."""
    stacked = df.select(y_true, F.explode(F.array(*[
        F.struct(F.lit(p).alias("model"), F.col(p).alias("y_pred")) for p in preds])).alias("_s")) \
        .select(F.col(y_true).alias("y_true"), "_s.model", "_s.y_pred")
    return classification_report(stacked, "y_true", "y_pred", classes, group=["model"])


def masked_token_accuracy(df: DataFrame, predictions="predictions", labels="labels", ignore=-100,
                          group: Sequence[str] = ()) -> DataFrame:
    """M-25: share of positions with label != ignore where prediction == label."""
    z = df.select(*group, F.explode(F.arrays_zip(F.col(predictions).alias("p"), F.col(labels).alias("l"))).alias("_z"))
    z = z.filter(F.col("_z.l") != ignore)
    return z.groupBy(*group).agg(F.avg((F.col("_z.p") == F.col("_z.l")).cast("double")).alias("accuracy"),
                                 F.count(F.lit(1)).alias("tokens"))
