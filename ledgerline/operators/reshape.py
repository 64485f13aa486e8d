"""Reshape, set operations and keyed dedupe (R-01..R-07, W-17, W-18, A-10, A-16).

Dedupe and latest-row are aggregates (``min_by``/``max_by`` of the whole row on
an order struct), not ``row_number`` windows: the aggregate combines partially
on the map side, so a key holding a third of the rows never lands whole in one
task, and the kept row is defined by order, never arbitrary.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _row_pick(df: DataFrame, key: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    key = list(key)
    rest = [c for c in df.columns if c not in key]
    row = F.struct(*[F.col(c) for c in rest])
    o = F.struct(*[F.col(c) for c in order])
    return df.groupBy(*key).agg(pick(row, o).alias("_row")).select(*key, *[F.col("_row." + c).alias(c) for c in rest])


def keep_first(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """W-17: first row per key by ``order`` (make it total with a tie-break)."""
    return _row_pick(df, key, order, F.min_by)


def latest(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """W-18 / W-19: last row per key by ``order``."""
    return _row_pick(df, key, order, F.max_by)


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    """R-01: row concat by column name, missing columns filled with NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def priority_union(frames: Sequence[DataFrame], key: Sequence[str]) -> DataFrame:
    """R-02 / S-37: union sources tagged with their priority (list order) and keep,
    per key, the row of the best (lowest) priority."""
    tagged = [f.withColumn("priority", F.lit(i)) for i, f in enumerate(frames)]
    return keep_first(union_all(tagged), key, ["priority"])


#: Distinct values that may become columns: a wider table can't be planned in reasonable time.
MOST_COLUMNS = 10_000


def column_values(df: DataFrame, column, most: int = MOST_COLUMNS) -> list:
    """The sorted distinct values of a column that become column names (a distinct
    of that column alone, one value per output column; NULL is no name). More than
    ``most`` are an error, found without collecting them."""
    found = [r[0] for r in df.select(column).distinct().limit(most + 2).collect() if r[0] is not None]
    if len(found) > most:
        raise ValueError(f"more than {most} distinct values would become columns")
    return sorted(found)


def pivot_unique(df: DataFrame, index: Sequence[str], column: str, value: str,
                 values: Sequence | None = None) -> DataFrame:
    """R-03: long -> wide where (index, column) pairs are unique; a duplicate pair
    fails the job (``assert_true`` inside the plan, no extra pass). Without
    ``values`` the columns are all that the table has."""
    values = column_values(df, column) if values is None else values
    checked = (df.groupBy(*index, column).agg(F.count(F.lit(1)).alias("_n"), F.first(value).alias(value))
                 .withColumn("_ok", F.assert_true(F.col("_n") == 1, "duplicate (index, column) pair in pivot")))
    checked = checked.filter(F.col("_ok").isNull())
    return checked.groupBy(*index).pivot(column, list(values)).agg(F.first(value))


def pivot_first(df: DataFrame, index: Sequence[str], column: str, value: str, values: Sequence | None,
                order: Sequence[str]) -> DataFrame:
    """R-04: long -> wide keeping the first value (by ``order``) of duplicate pairs,
    rows without a value passed over; ``values=None``: a column for every value that the table has."""
    values = column_values(df, column) if values is None else values
    return df.groupBy(*index).pivot(column, list(values)).agg(first_value(value, order))


def first_value(value: str, order: Sequence[str]) -> Column:
    """Aggregate: the first value by ``order`` that isn't NULL (``min_by`` would take a NULL value of the first row)."""
    return F.min_by(value, F.when(F.col(value).isNotNull(), F.struct(*[F.col(c) for c in order])))


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], name: str, value: str) -> DataFrame:
    """R-05 / R-06: wide -> long (``stack``)."""
    return df.unpivot(list(ids), list(values), name, value)


def transpose_series(df: DataFrame, series: str, columns: Sequence[str], name: str,
                     values: Sequence | None = None, value: str = "value", order: Sequence[str] = ()) -> DataFrame:
    """R-05: series-as-rows / dates-as-columns -> dates as rows, one column per
    series (unpivot, then pivot); without ``values`` every series. Of a series that
    has several rows the first value by ``order`` counts (without ``order`` the
    smallest), NULL only where no row has one."""
    values = column_values(df, series) if values is None else values
    long = unpivot(df, [series, *order], columns, name, value)
    return long.groupBy(name).pivot(series, list(values)).agg(first_value(value, order or [value]))


def map_rows_with_fallback(df: DataFrame, ids: Sequence[str], map_col: str, total: Column,
                           key_name: str = "chain", value_name: str = "value") -> DataFrame:
    """R-07: one row per map entry; rows whose breakdown is missing or empty keep a
    single ``'all'`` row with the total."""
    ex = df.select(*ids, total.alias("_total"), F.explode_outer(F.col(map_col)).alias("_k", "_v"))
    return ex.select(*ids, F.coalesce(F.col("_k"), F.lit("all")).alias(key_name),
                     F.when(F.col("_k").isNull(), F.col("_total")).otherwise(F.col("_v")).alias(value_name))


def align_outer(frames: dict[str, DataFrame], on: str, value: str, names: Sequence[str] | None = None) -> DataFrame:
    """J-01 / J-02: N-way full outer align on ``on``: one ``unionByName`` of long
    rows and one ``pivot`` (a single shuffle) instead of N-1 chained outer joins.
    Each frame must have one row per ``on``."""
    names = list(names or frames.keys())
    long = union_all([f.select(on, F.lit(k).alias("_series"), F.col(value).alias("_v")) for k, f in frames.items()])
    return long.groupBy(on).pivot("_series", names).agg(F.first("_v"))


def align_series(long: DataFrame, on: str, series: str, value: str, names: Sequence[str] | None = None) -> DataFrame:
    """J-01 where all series stand in one long table: a pivot of that table, one
    column per series. Without ``names`` they are read from the table first (a
    distinct of one column), so that no series is left out; NULL is no name."""
    if names is None:
        names = column_values(long, series)
    return long.groupBy(on).pivot(series, list(names)).agg(F.first(value))


def non_null_counts(df: DataFrame, drop_all_null: bool = True) -> DataFrame:
    """A-16: non-null count per column in one aggregate, as (column, non_null)
    rows; columns with no value are dropped when asked."""
    agg = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    long = agg.unpivot([], df.columns, "column", "non_null")
    return long.filter(F.col("non_null") > 0) if drop_all_null else long


def drop_all_null_columns(df: DataFrame) -> DataFrame:
    """A-16 applied: select only columns with at least one value (needs one action)."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns]).first().asDict()
    return df.select(*[c for c in df.columns if counts[c] > 0])


def group_pivot(df: DataFrame, group: Sequence[str], rank_col: str, ranks: Sequence[int],
                aggs: dict[str, Column]) -> DataFrame:
    """A-10: per (group, rank) aggregates, then ranks 1..k as columns
    ``<name>_<rank>`` (explicit values: no discovery pass). Each (group, rank) is one row by then, so its
    value is taken as it is; ``pivot`` would first group by (group, rank) once more."""
    per = df.groupBy(*group, rank_col).agg(*[c.alias(n) for n, c in aggs.items()])
    return per.groupBy(*group).agg(*[F.first(F.when(F.col(rank_col) == r, F.col(n)), ignorenulls=True).alias(f"{n}_{r}")
                                     for r in ranks for n in aggs])


def ranked_pivot(df: DataFrame, group: Sequence[str], rank_by: str, most: int, aggs: dict[str, Column]) -> DataFrame:
    """A-10: per (group, ``rank_by``) aggregates, then the first ``most`` by rank as
    columns ``<name>_<rank>``: a group whose values are 1, 2, 5 has ranks 1, 2, 3.
    The ranks are over the aggregated rows, a few a group."""
    per = df.where(F.col(rank_by).isNotNull()).groupBy(*group, rank_by).agg(*[c.alias(n) for n, c in aggs.items()])
    rank = F.dense_rank().over(Window.partitionBy(*group).orderBy(rank_by))
    firsts = per.withColumn("_rank", rank).where(F.col("_rank") <= most)
    wide = firsts.groupBy(*group).agg(*[F.max(F.when(F.col("_rank") == r, F.col(n))).alias(f"{n}_{r}")
                                        for r in range(1, most + 1) for n in aggs])
    return wide
