"""Compare a Spark result with a DuckDB oracle query (the driver's check, locally).

Columns are matched by name (sorted), rows compared order-insensitively after
rounding floats, so the check is the same shape as the driver's value hash.
"""

from __future__ import annotations

import math

import duckdb
import pandas as pd

from ledgerline.plans.fixtures import TABLES


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir.rstrip('/')}/{t}.parquet')")
    return con


def _norm(v, digits):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        if math.isinf(v):
            return v
        return round(v, digits) + 0.0
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    if hasattr(v, "tolist"):
        return _norm(v.tolist(), digits)
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x, digits)) for k, x in v.items()))
    return v


def frame_rows(pdf: pd.DataFrame, digits: int = 6):
    cols = sorted(pdf.columns)
    rows = []
    for rec in pdf[cols].itertuples(index=False, name=None):
        rows.append(tuple(_norm(None if (not isinstance(x, (list, tuple, dict)) and not hasattr(x, "tolist")
                                         and pd.isna(x)) else x, digits) for x in rec))
    return cols, sorted(rows, key=lambda r: tuple((x is None, str(x)) for x in r))


SPARK_KIND = {"tinyint": "int8", "smallint": "int16", "int": "int32", "bigint": "int64", "float": "float32",
              "double": "float64", "string": "string", "boolean": "bool", "date": "date",
              "timestamp": "timestamp_ltz", "timestamp_ntz": "timestamp"}
DUCK_KIND = {"TINYINT": "int8", "SMALLINT": "int16", "INTEGER": "int32", "BIGINT": "int64", "FLOAT": "float32",
             "DOUBLE": "float64", "VARCHAR": "string", "BOOLEAN": "bool", "DATE": "date", "TIMESTAMP": "timestamp",
             "TIMESTAMP WITH TIME ZONE": "timestamp", "HUGEINT": "int128", "DECIMAL": "decimal"}


def _kind(t: str, table: dict) -> str:
    t = t.strip()
    if t.endswith("[]") or t.startswith("array") or t.startswith("STRUCT") or t.startswith("struct") \
            or t.startswith("MAP") or t.startswith("map"):
        return "nested"
    if t.startswith("DECIMAL") or t.startswith("decimal"):
        return "decimal"
    return table.get(t, t)


def schema_diff(spark_df, sql: str, con) -> list[str]:
    """Columns whose Spark type and DuckDB type differ in kind/width."""
    left = {f.name: _kind(f.dataType.simpleString(), SPARK_KIND) for f in spark_df.schema.fields}
    desc = con.execute(f"DESCRIBE {sql}").fetchall()
    right = {r[0]: _kind(r[1], DUCK_KIND) for r in desc}
    return [f"{c}: spark {left[c]} vs duckdb {right.get(c)}" for c in sorted(left) if left[c] != right.get(c)]


def compare(spark_df, sql: str, sf_dir: str, digits: int = 6, con=None, check_types: bool = True) -> tuple[bool, str]:
    con = con or duck(sf_dir)
    if check_types:
        diff = schema_diff(spark_df, sql, con)
        if diff:
            return False, f"types differ: {diff}"
    left = spark_df.toPandas()
    right = con.execute(sql).df()
    lc, lr = frame_rows(left, digits)
    rc, rr = frame_rows(right, digits)
    if lc != rc:
        return False, f"columns differ: {lc} vs {rc}"
    if len(lr) != len(rr):
        return False, f"row count {len(lr)} vs {len(rr)}"
    for i, (a, b) in enumerate(zip(lr, rr)):
        if a != b:
            diffs = [(c, x, y) for c, x, y in zip(lc, a, b) if x != y]
            return False, f"row {i} differs: {diffs[:5]}"
    return True, f"{len(lr)} rows match"
