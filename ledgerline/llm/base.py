"""Session preparation, table readers and the registry of the ``opN_*`` queries."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ledgerline.session import ensure_checkpoint_dir

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}

#: Rows of an Arrow batch handed to a Python worker: texts and packed blocks are large rows, so few of
#: them already fill a batch (memory of a worker = rows x row size).
ARROW_ROWS = 1024


def prepare(spark: SparkSession) -> None:
    """Settings the operators rely on. Workers get the package root on their path (an installed package
    or ``--py-files`` needs nothing more); the checkpoint folder is the session's own."""
    if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    ensure_checkpoint_dir(spark)
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    if root not in env.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(x for x in (root, env.get("PYTHONPATH", "")) if x)


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir)`` under ``name``, with its oracle where SQL can express it."""
    def deco(fn):
        def run(spark, sf_dir):
            prepare(spark)
            return fn(spark, sf_dir)
        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Reliable checkpoint in the shared ``spark.checkpoint.dir`` (never a local checkpoint): the rows
    are computed once, and a lost executor costs a read, not a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def load_all() -> None:
    from ledgerline.llm import queries  # noqa: F401


def unused(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have (column names are case-insensitive)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name
