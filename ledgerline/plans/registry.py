"""Registry of named queries: a Spark builder ``(spark, sf_dir) -> DataFrame`` and,
where the operator is SQL-expressible, the DuckDB oracle text.

Keys are the operator ids of the design inventory in snake case (``w02_...``).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def duck_round(c, digits: int):
    """Round like the oracle engine: round-half-away-from-zero of x * 10^d on the
    binary value, then / 10^d. (Spark's ``round(x, d)`` rounds the shortest decimal
    string of x, which differs on values that print as a tie but are not one.)
    ``round(v, 0)`` on the scaled value is exact: the shortest string of a double
    is a tie only when the double is one."""
    x = F.col(c) if isinstance(c, str) else c
    p = float(10 ** digits)
    return F.round(x * F.lit(p), 0) / F.lit(p)


def rounded(df: DataFrame, digits: int = 6, money: tuple[str, ...] = (), money_digits: int = 2,
            keep: tuple[str, ...] = ()) -> DataFrame:
    """Round every top-level DOUBLE column (the oracle SQL rounds the same way);
    columns in ``keep`` are left as they are."""
    out = []
    for f in df.schema.fields:
        if f.name in keep:
            out.append(F.col(f.name))
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            d = money_digits if f.name in money else digits
            out.append(duck_round(f.name, d).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def prepared(fn: Callable) -> Callable:
    """Wrap a query so it runs under the settings the library relies on: UTC
    session time zone and a checkpoint folder (the session's
    ``spark.checkpoint.dir`` is used; one is only set where none is configured)."""
    def run(spark, sf_dir):
        from ledgerline.session import ensure_checkpoint_dir
        if spark.conf.get("spark.sql.session.timeZone", "UTC") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")
        ensure_checkpoint_dir(spark)
        return naive_timestamps(fn(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def naive_timestamps(df: DataFrame) -> DataFrame:
    """Top-level TIMESTAMP (session-zone) columns as TIMESTAMP_NTZ in UTC wall
    time — the type of the given tables and of the oracle's TIMESTAMP."""
    if not any(isinstance(f.dataType, T.TimestampType) for f in df.schema.fields):
        return df
    return df.select(*[F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, T.TimestampType)
                       else F.col(f.name) for f in df.schema.fields])


def load_all() -> None:
    """Import every query module so that their decorators register."""
    from ledgerline.plans import q_series, q_text, q_panel, q_sources, q_files, q_cases, q_lake, q_models  # noqa: F401


def sig_round(c, digits: int = 9):
    """Round to ``digits`` significant digits (for values whose magnitude varies
    over many decades, e.g. compounded returns); see :func:`sig_round_sql`."""
    x = F.col(c) if isinstance(c, str) else c
    e = F.pow(F.lit(10.0), F.floor(F.log10(F.abs(x))))
    return F.when(x == 0, F.lit(0.0)).when(F.isnan(x) | (F.abs(x) == float("inf")), x) \
        .otherwise(F.round(x / e, digits - 1) * e)


def sig_round_sql(x: str, digits: int = 9) -> str:
    e = f"pow(10.0, floor(log10(abs({x}))))"
    return (f"(CASE WHEN ({x}) = 0 THEN 0.0 WHEN isnan({x}) OR isinf({x}) THEN ({x}) "
            f"ELSE round(({x}) / {e}, {digits - 1}) * {e} END)")
