"""Panel models and forecast tables (M-06, M-09, M-26, J-11).

The forecaster is re-aimed on Spark ML: one gradient-boosted tree model per
asset class trained on the pooled panel of per-asset features (never features
computed across assets). Training is distributed by Spark ML; classes, few by a
stated limit, are fitted a few at a time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.operators.features import FEATURE_COLUMNS
from ledgerline.operators.reshape import latest
from ledgerline.plans import sequence as sq
from ledgerline.session import cut_lineage


def train_panel_model(train: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = "target",
                      task: str = "regression", max_iter: int = 20, max_depth: int = 4, seed: int = 42):
    """M-06: fit a GBT regressor / classifier on complete rows; returns the fitted
    ``PipelineModel``."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import GBTClassifier
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import GBTRegressor

    rows = train.na.drop(how="any", subset=[*features, label])
    assembler = VectorAssembler(inputCols=list(features), outputCol="features_vec")
    if task == "regression":
        est = GBTRegressor(featuresCol="features_vec", labelCol=label, maxIter=max_iter, maxDepth=max_depth, seed=seed)
    else:
        est = GBTClassifier(featuresCol="features_vec", labelCol=label, maxIter=max_iter, maxDepth=max_depth,
                            seed=seed)
    return Pipeline(stages=[assembler, est]).fit(rows)


def feature_importance(model, features: Sequence[str] = FEATURE_COLUMNS, top: int = 10):
    """M-06: (feature, importance) rows of the fitted trees, top N (a list of
    len(features) values, computed from the model on the driver)."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    pairs = sorted(zip(features, imp), key=lambda p: (-p[1], p[0]))[:top]
    return pairs


def predict(model, rows: DataFrame, features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    return model.transform(rows.na.drop(how="any", subset=list(features))).drop("features_vec")


def sequence_windows(df: DataFrame, value: str, lookback: int, key="asset", ts="ts", tiebreak=None,
                     out="window", chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """M-09: per row, the array of the last ``lookback`` values (oldest first),
    only where the frame is full and non-null; computed in the chunk layout."""
    from ledgerline.operators.features import on_series

    def build(d):
        w = sq.chunk_window(key).rowsBetween(-(lookback - 1), 0)
        full = F.count(F.col(value)).over(w) == lookback
        return d.withColumn(out, F.when(full, F.collect_list(value).over(w)))
    order = [ts] + ([tiebreak] if tiebreak else [])
    return on_series(df, key, order, build, back=lookback, chunk_rows=chunk_rows).filter(F.col(out).isNotNull())


def batch_forecast(features: DataFrame, prediction: str, key="asset", ts="ts", price="close",
                   top: int | None = 10) -> DataFrame:
    """M-26 / K-05: latest row per ticker, predicted price = close * (1 + pred),
    ranked by predicted return (top N)."""
    last = latest(features.select(key, ts, price, prediction), [key], [ts])
    out = last.select(F.col(key).alias("ticker"), F.col(price).alias("current_price"),
                      F.col(prediction).alias("predicted_return"),
                      (F.col(price) * (1 + F.col(prediction))).alias("predicted_price"))
    out = out.orderBy(F.col("predicted_return").desc_nulls_last(), F.col("ticker"))
    return out.limit(top) if top else out


def portfolio_forecast(features: DataFrame, weights: DataFrame, prediction: str, key="asset",
                       ts="ts") -> DataFrame:
    """J-11: latest prediction per asset x weight = contribution; the portfolio
    return is the sum of contributions (a scalar subquery, no join)."""
    last = latest(features.select(key, ts, prediction), [key], [ts])
    joined = last.join(weights, on=key, how="inner")
    contrib = joined.select(key, "weight", F.col(prediction).alias("predicted_return"),
                            (F.col(prediction) * F.col("weight")).alias("contribution"))
    total = contrib.select(F.sum("contribution")).scalar()
    return contrib.withColumn("portfolio_return", total)


# ---- M-06: one model per class --------------------------------------------------------

def train_class_models(train: DataFrame, class_col: str, path: str, features: Sequence[str] = FEATURE_COLUMNS,
                       label: str = "target", task: str = "regression", pool: int = 4, most: int = 64,
                       least_rows: int = 50, **settings) -> DataFrame:
    """M-06: a fitted ``PipelineModel`` for each class of ``class_col``, saved under ``path`` by its class, and
    the model table (class, path, rows, task), kept there as Parquet and returned.

    Features are computed once (the complete rows are checkpointed); the classes are fitted by at most
    ``pool`` Spark ML jobs at a time, each distributed. A class of fewer than ``least_rows`` complete rows
    gets no model; more than ``most`` classes are an error, since every class is a training run. Rows
    without a class belong to none.
    """
    from concurrent.futures import ThreadPoolExecutor
    from urllib.parse import quote

    from pyspark import inheritable_thread_target

    spark = train.sparkSession
    rows = cut_lineage(train.select(class_col, *features, label).na.drop(how="any"))
    sizes = rows.groupBy(class_col).agg(F.count("*").alias("n")).where(F.col("n") >= least_rows)
    found = {r[0]: r[1] for r in sizes.orderBy(class_col).limit(most + 1).collect()}
    if len(found) > most:
        raise ValueError(f"more than {most} classes to fit")

    def fit(name):
        model = train_panel_model(rows.where(F.col(class_col) == F.lit(name)), features, label, task, **settings)
        to = f"{path}/class={quote(str(name), safe='')}"
        model.write().overwrite().save(to)
        return name, to
    with ThreadPoolExecutor(pool) as workers:
        places = list(workers.map(inheritable_thread_target(spark)(fit), found))
    kind = rows.schema[class_col].dataType.simpleString()
    table = spark.createDataFrame([(n, p, found[n], task) for n, p in places],
                                  f"`{class_col}` {kind}, path string, rows long, task string")
    table.write.mode("overwrite").parquet(f"{path}/models")
    return spark.read.parquet(f"{path}/models")


def score_by_class(rows: DataFrame, models: DataFrame, class_col: str,
                   features: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """Complete rows scored by the saved model of their own class; classes without a model give no rows. The
    model table has one row a class, which is bounded where it is made."""
    from functools import reduce

    from pyspark.ml import PipelineModel

    known = models.collect()
    if not known:
        return rows.where("false").withColumn("prediction", F.lit(None).cast("double"))
    parts = [predict(PipelineModel.load(m["path"]), rows.where(F.col(class_col) == F.lit(m[class_col])), features)
             for m in known]
    return reduce(lambda a, b: a.unionByName(b), [p.select(*rows.columns, "prediction") for p in parts])


# ---- M-09: feature-vector windows ------------------------------------------------------

def write_window_store(df: DataFrame, path: str, values: Sequence[str], lookback: int, target: str, key="asset", ts="ts",
                       tiebreak=None, chunk_rows: int = 1024) -> None:
    """M-09: the rows of every series as arrays of ``chunk_rows`` feature vectors with the ``lookback`` - 1 rows
    before them, so that any window lies in one row of the store; windows are slices at read, and the
    ``lookback``-fold copies are never written. Rows without a key belong to no series. A chunk's arrays are bounded by ``chunk_rows + lookback``."""
    keys = sq._cols(key)
    ix = sq.with_row_index(df.select(*keys, ts, *([tiebreak] if tiebreak else []), *values, target), key,
                           [ts] + ([tiebreak] if tiebreak else []))
    laid = sq.with_halo(ix, back=lookback - 1, chunk_rows=chunk_rows)
    row = F.struct(F.col(sq.RN).alias("rn"), F.col(sq.HOME).alias("home"), F.col(ts).alias("ts"),
                   F.array(*[F.col(v).cast("double") for v in values]).alias("x"), F.col(target).cast("double").alias("y"))
    # rows before a chunk that the series doesn't reach make no chunk
    store = laid.groupBy(*keys, F.col(sq.CHUNK).alias("chunk")).agg(
        F.sort_array(F.collect_list(row)).alias("_r"), F.bool_or(sq.HOME).alias("_any")).where("_any")
    part = lambda f: F.transform("_r", lambda r: r[f])
    store.select(*keys, "chunk", F.array_position(part("home"), True).alias("first"), part("ts").alias("ts"),
                 part("x").alias("x"), part("y").alias("y")).write.parquet(path)


def read_windows(spark, path: str, lookback: int, key="asset") -> DataFrame:
    """Windows of a store: (key, ts, window, target), ``window`` the last ``lookback`` feature vectors up to the
    row, oldest first; only full windows without a missing value. The store's own look-back is the longest
    that can be read."""
    s = spark.read.parquet(path)
    at = s.select(*sq._cols(key), "ts", "x", "y", F.explode(F.sequence(F.col("first").cast("int"), F.size("x"))).alias("_i"))
    window = F.slice("x", F.col("_i") - (lookback - 1), lookback)
    full = F.forall("window", lambda v: F.forall(v, lambda e: e.isNotNull()))
    return at.where(F.col("_i") >= lookback).select(
        *sq._cols(key), F.element_at("ts", F.col("_i")).alias("ts"), window.alias("window"),
        F.element_at("y", F.col("_i")).alias("target")).where(full)
