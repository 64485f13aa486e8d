"""Sort, limit and top-k (K-01..K-09) and dimension joins (J-03..J-09).

Top-N uses ``orderBy(...).limit(n)``, which plans as TakeOrderedAndProject
(per-partition top-N, then a merge of N x partitions rows), never a global
sort. Top-N *groups* use the (N-row) result as the build side of a semi join.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _order(cols: Sequence[str | Column]) -> list[Column]:
    return [F.col(c) if isinstance(c, str) else c for c in cols]


def top_n(df: DataFrame, by: str, n: int, tiebreak: Sequence[str] = ()) -> DataFrame:
    """K-01 / K-05: rows with the N largest values (NULLs last), ties broken by
    ``tiebreak`` ascending for a deterministic result."""
    return df.orderBy(F.col(by).desc_nulls_last(), *_order(tiebreak)).limit(n)


def top_groups(df: DataFrame, key: str | Sequence[str], n: int) -> DataFrame:
    """K-02: the N keys with the most rows (ties by key), as a small table."""
    key = [key] if isinstance(key, str) else list(key)
    counts = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return counts.orderBy(F.col("_n").desc(), *key).limit(n).select(*key)


def rows_of_top_groups(df: DataFrame, key: str | Sequence[str], n: int) -> DataFrame:
    """K-02: rows whose key is among the N most frequent keys (a semi join; AQE
    broadcasts the keys where their measured size allows)."""
    key = [key] if isinstance(key, str) else list(key)
    return df.join(top_groups(df, key, n), on=key, how="left_semi")


def sort_by(df: DataFrame, cols: Sequence[str | Column]) -> DataFrame:
    """K-03 / K-04: total order for display or export (range-partitioned sort);
    inside a pipeline prefer ``sortWithinPartitions`` at write time."""
    return df.orderBy(*_order(cols))


def winning_row(df: DataFrame, key: Sequence[str], outcome: str, price: str, order: Sequence[str]) -> DataFrame:
    """X-13 over rows: per key the outcome of the highest price, first by ``order``
    on ties; NULL where a price of the key is missing. One aggregate with
    map-side partials, so a hot key never becomes a list."""
    best = F.min_by(outcome, F.struct(-F.col(price), *[F.col(c) for c in order]))
    return df.groupBy(*key).agg(F.when(F.count(price) == F.count(F.lit(1)), best).alias(outcome))


def first_n_per_group(df: DataFrame, key: str | Sequence[str], by: str, n: int, salt_buckets: int = 32) -> DataFrame:
    """K-06: rows whose ``by`` value is among the first N distinct values of their
    group (dense rank <= N).

    Exact two-phase top-N that never ranks a whole key in one task: distinct
    (key, value) pairs are spread over ``salt_buckets`` by a hash of the value,
    the first N per (key, bucket) are kept (each bucket holds 1/buckets of a hot
    key), then at most N x buckets candidates per key are ranked. A value in the
    global first N is in the first N of its bucket, so nothing is lost."""
    key = [key] if isinstance(key, str) else list(key)
    distinct = df.select(*key, by).distinct().withColumn("_salt", F.pmod(F.xxhash64(F.col(by)), F.lit(salt_buckets)))
    local = distinct.withColumn("_r", F.row_number().over(Window.partitionBy(*key, "_salt").orderBy(by)))
    cand = local.filter(F.col("_r") <= n).select(*key, by)
    ranked = cand.withColumn("_r", F.dense_rank().over(Window.partitionBy(*key).orderBy(by)))
    firsts = ranked.filter(F.col("_r") <= n).drop("_r")
    return df.join(firsts, on=[*key, by], how="left_semi")


def join_first(arr, n: int, sep: str = ", ") -> Column:
    """K-07: first N array elements joined with ``sep``."""
    return F.array_join(F.slice(F.col(arr) if isinstance(arr, str) else arr, 1, n), sep)


def ranked_elements(df: DataFrame, arr: str, keep: Sequence[str] = (), item: str = "item",
                    rank: str = "rank") -> DataFrame:
    """K-08: one row per array element with its 1-based position."""
    return df.select(*keep, F.posexplode(arr).alias("_pos", item)).select(
        *keep, (F.col("_pos") + 1).alias(rank), item)


def lookup_with_fallback(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, value: str,
                         fallback: Column, out: str | None = None) -> DataFrame:
    """J-08: value by exact key, else by a fallback form of the key (e.g. '-' ->
    '.'): two left joins and ``coalesce``. The lookup is a dimension table;
    AQE broadcasts it when its measured size allows."""
    out = out or value
    lk = lookup.select(F.col(lookup_key).alias("_lk"), F.col(value).alias("_lv"))
    first = df.join(lk, df[key] == lk["_lk"], "left").drop("_lk").withColumnRenamed("_lv", "_v1")
    first = first.withColumn("_fb", fallback)
    lk2 = lookup.select(F.col(lookup_key).alias("_lk2"), F.col(value).alias("_v2"))
    second = first.join(lk2, first["_fb"] == lk2["_lk2"], "left").drop("_lk2", "_fb")
    return second.withColumn(out, F.coalesce("_v1", "_v2")).drop("_v1", "_v2")


def home_away(df: DataFrame, game: str, side: Column, team: str, score: str) -> DataFrame:
    """J-06: one row per game with home and away team / score: a single
    ``groupBy(game)`` with conditional aggregates instead of a self-join.
    ``side`` is True for the home row; ties resolve to the smallest value."""
    return df.groupBy(game).agg(
        F.min(F.when(side, F.col(team))).alias("home_team"),
        F.min(F.when(~side, F.col(team))).alias("away_team"),
        F.min(F.when(side, F.col(score))).alias("home_score"),
        F.min(F.when(~side, F.col(score))).alias("away_score"))
