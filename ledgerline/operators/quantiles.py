"""Exact order statistics of groups of any size (A-09)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.session import cut_lineage

#: Points of a group's sketch; its accuracy bounds their error in rank by 1 / ACCURACY.
POINTS, ACCURACY = 64, 4000


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str = "median", most: int = 1 << 20) -> DataFrame:
    """A-09: (keys, median) as a double: the middle value of each group, or the mean of the middle two; NULL
    where a group has no value, and a NULL key is a group of its own. NaN counts as the largest value.

    Selection by narrowing: a group of more than ``most`` rows is bracketed by two points of a sketch of
    fixed size (partial aggregates), the rows below the bracket are counted and dropped, those inside are
    written to the shared checkpoint folder, until ``most`` are left. What is left is counted per distinct
    value and ranked by a cumulative count. No task ever sees the values of a whole large group, and each
    round leaves about a twentieth of the rows.
    """
    keys = list(keys)
    v = F.col(value).cast("double")
    rows = df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], v.alias("_v"))
    ks = [f"_k{i}" for i in range(len(keys))]
    groups = rows.groupBy(*ks).agg(F.count("_v").alias("_n"))
    # ranks (from 0) of the middle values among the rows that are left, for groups that have any
    left = groups.where("_n > 0").withColumns({"_a": F.expr("(_n - 1) DIV 2"), "_b": F.expr("_n DIV 2")})
    rows = rows.where("_v IS NOT NULL")
    left = cut_lineage(left)
    while (left.agg(F.max("_n")).first()[0] or 0) > most:
        rows, left = narrowed(rows, left, ks, most)
    counts = rows.groupBy(*ks, "_v").agg(F.count("*").alias("_c"))
    upto = F.sum("_c").over(Window.partitionBy(*ks).orderBy("_v"))
    ranked = counts.withColumn("_u", upto)
    at = _same(ranked, left, ks)
    middle = at.groupBy(*[F.col(f"l.{k}").alias(k) for k in ks]).agg(
        F.min(F.when(F.col("_u") > F.col("_a"), F.col("_v"))).alias("_lo"),
        F.min(F.when(F.col("_u") > F.col("_b"), F.col("_v"))).alias("_hi"))
    found = middle.select(*ks, F.when(F.col("_lo") == F.col("_hi"), F.col("_lo")).otherwise((F.col("_lo") + F.col("_hi")) / 2)
                          .alias("_m"))
    full = _same(groups, found, ks, "left")
    return full.select(*[F.col(f"r.{k}").alias(n) for k, n in zip(ks, keys)], F.col("_m").alias(out))


def _same(r: DataFrame, left: DataFrame, ks: list[str], how: str = "inner") -> DataFrame:
    """Join by equal keys, NULL equal to NULL; sides are ``r`` and ``l``."""
    r, left = r.alias("r"), left.alias("l")
    on = F.lit(True)
    for k in ks:
        on = on & F.col(f"r.{k}").eqNullSafe(F.col(f"l.{k}"))
    return r.join(left, on, how)


def narrowed(rows: DataFrame, left: DataFrame, ks: list[str], most: int) -> tuple[DataFrame, DataFrame]:
    """One round: the rows inside each large group's bracket, those of the other groups, and the ranks among them.

    Groups of more than ``most`` rows are few, at most rows / ``most``: their brackets go to the rows, which are
    never dealt by group (a few groups would put the whole table into a few tasks).
    """
    large = cut_lineage(left.where(F.col("_n") > most))
    of = F.broadcast(large.select(*ks))
    points = F.percentile_approx("_v", [i / POINTS for i in range(POINTS + 1)], ACCURACY).alias("_p")
    sketch = _same(rows, of, ks, "left_semi").groupBy(*ks).agg(points, F.min("_v").alias("_min"), F.max("_v").alias("_max"))
    s = _same(sketch, F.broadcast(large), ks).select(*[F.col(f"l.{k}").alias(k) for k in ks], "_p", "_min", "_max", "_n", "_a", "_b")
    # a point's place is off by no more than n / ACCURACY rows: one point of margin covers it
    low = F.floor(F.col("_a") / F.col("_n") * POINTS) - 1
    high = F.ceil((F.col("_b") + 1) / F.col("_n") * POINTS) + 1
    s = s.select(*ks, "_n", "_a", "_b",
                 F.when(low >= 0, F.get("_p", low.cast("int"))).otherwise(F.col("_min")).alias("_lo"),
                 F.when(high <= POINTS, F.get("_p", high.cast("int"))).otherwise(F.col("_max")).alias("_hi"))
    s = cut_lineage(s)
    j = _same(rows, F.broadcast(s), ks)
    mine = [F.col(f"r.{k}").alias(k) for k in ks]
    split = cut_lineage(j.where("_v <= _hi").groupBy(*mine).agg(
        F.count_if(F.col("_v") < F.col("_lo")).alias("_below"), F.count_if(F.col("_v") >= F.col("_lo")).alias("_in"),
        F.first("_n").alias("_was"), F.first("_a").alias("_a"),
        F.first("_b").alias("_b"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi")))
    if split.where("_below > _a OR _below + _in <= _b").limit(1).count():
        raise ArithmeticError("a sketch's bracket missed the median")  # not within its stated error
    # a bracket of one value is its median: one row stands for all of them
    alone = split.where("_lo = _hi").select(*ks, F.col("_lo").alias("_v"))
    kept = j.where("_v >= _lo AND _v <= _hi AND _lo < _hi").select(*mine, "_v").unionByName(alone)
    others = left.where(F.col("_n") <= most)
    if others.limit(1).count():
        kept = kept.unionByName(_same(rows, of, ks, "left_anti").select(*ks, "_v"))
    rows = cut_lineage(kept)
    one = F.col("_lo") == F.col("_hi")
    others = others.select(*ks, "_n", "_a", "_b", F.lit(False).alias("_stuck"))
    left = cut_lineage(split.select(
        *ks, F.when(one, F.lit(1)).otherwise(F.col("_in")).cast("long").alias("_n"),
        F.when(one, F.lit(0)).otherwise(F.col("_a") - F.col("_below")).cast("long").alias("_a"),
        F.when(one, F.lit(0)).otherwise(F.col("_b") - F.col("_below")).cast("long").alias("_b"),
        (F.col("_in") == F.col("_was")).alias("_stuck")).unionByName(others))
    if left.where(F.col("_stuck") & (F.col("_n") > most)).limit(1).count():
        # few distinct values around the median: rows can't be told apart by points, but by value they are few
        return rows, left.withColumn("_n", F.least("_n", F.lit(most))).drop("_stuck")
    return rows, left.drop("_stuck")
