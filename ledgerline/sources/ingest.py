"""An append-only ingest log with high-water marks (S-34, S-35).

A batch is data under ``<root>/data/batch=<id>`` and one commit under ``<root>/log/batch=<id>``: per key its
rows, its high-water mark and the time of the commit. The commit is written last, by Spark's file commit, so
data of a run that died is not in the log: readers don't see it and the next run of that batch writes over
it. A batch that is in the log is never written again.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest_log(spark: SparkSession, root: str) -> DataFrame | None:
    """The log: (batch, key..., rows, high_water, committed_at); None before the first commit."""
    try:
        return spark.read.option("basePath", f"{root}/log").parquet(f"{root}/log").withColumn("batch", F.col("batch").cast("string"))
    except AnalysisException as e:
        if e.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def high_water(log: DataFrame, key: Sequence[str]) -> DataFrame:
    """(key..., high_water): how far each key has been ingested."""
    return log.groupBy(*key).agg(F.max("high_water").alias("high_water"))


def new_rows(spark: SparkSession, root: str, incoming: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Incoming rows beyond their key's mark; of a key that was never ingested, all. ``order`` (time, then a
    tie-break) is what marks compare; rows whose time is NULL can't be placed and are left out."""
    rows = incoming.where(F.col(order[0]).isNotNull())
    log = ingest_log(spark, root)
    if log is None:
        return rows
    marks = high_water(log, key).select(*[F.col(k).alias(f"_{k}") for k in key], "high_water")
    on = F.lit(True)
    for k in key:
        on = on & F.col(k).eqNullSafe(F.col(f"_{k}"))
    joined = rows.join(marks, on, "left")
    beyond = F.col("high_water").isNull() | (F.struct(*[F.col(c) for c in order]) > F.col("high_water"))
    return joined.where(beyond).select(*incoming.columns)


def ingest(spark: SparkSession, root: str, batch: str, incoming: DataFrame, key: Sequence[str], order: Sequence[str]) -> int:
    """Adds what is new in ``incoming`` as ``batch`` and returns the number of rows added: 0 where the batch is
    in the log already, or nothing is new (then nothing is logged). Data is written by key and time, hot
    keys split among tasks."""
    log = ingest_log(spark, root)
    if log is not None and log.where(F.col("batch") == batch).limit(1).count():
        return 0
    data = f"{root}/data/batch={batch}"
    new = new_rows(spark, root, incoming, key, order)
    new.hint("rebalance", *key).sortWithinPartitions(*key, *order).write.mode("overwrite").parquet(data)
    written = spark.read.schema(new.schema).parquet(data)
    mark = F.max(F.struct(*[F.col(c) for c in order])).alias("high_water")
    commit = written.groupBy(*key).agg(F.count("*").alias("rows"), mark).withColumn("committed_at", F.current_timestamp())
    added = commit.agg(F.sum("rows")).first()[0] or 0
    if added:
        commit.write.mode("overwrite").parquet(f"{root}/log/batch={batch}")
    return added


def committed(spark: SparkSession, root: str) -> DataFrame:
    """The rows of all batches in the log, with their ``batch``; data without a commit is not read."""
    log = ingest_log(spark, root)
    if log is None:
        raise ValueError(f"nothing was ingested under {root}")
    rows = spark.read.option("basePath", f"{root}/data").parquet(f"{root}/data").withColumn("batch", F.col("batch").cast("string"))
    return rows.join(log.select("batch").distinct(), "batch", "left_semi")


def stale(spark: SparkSession, root: str, incoming: DataFrame, key: Sequence[str], now, max_age_hours: float,
          time: str) -> DataFrame:
    """S-35: incoming keys that the log has never seen or whose high-water mark, by its ``time`` field, is older
    than the limit before ``now``."""
    keys = incoming.select(*key).distinct()
    log = ingest_log(spark, root)
    if log is None:
        return keys
    fresh = high_water(log, key).where(F.col(f"high_water.{time}") >= now - F.make_interval(secs=F.lit(float(max_age_hours * 3600))))
    return keys.join(fresh.select(*key), list(key), "left_anti")
