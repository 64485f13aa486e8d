"""Hard cases of the panel operators, against plain Python."""
import random
import statistics

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import clean as CL
from ledgerline.operators import quantiles
from ledgerline.operators import reshape as RS
from ledgerline.operators import text_ops as TO
from ledgerline.operators.quantiles import exact_median
from ledgerline.session import cut_lineage


@pytest.mark.parametrize("most", [1 << 20, 40])
def test_median_by_narrowing(spark, most):
    rng = random.Random(9)
    rows = [("normal", rng.gauss(0, 1)) for _ in range(1500)] + [("even", float(i)) for i in range(600)]
    rows += [("one value", 7.0)] * 900 + [("two", float(i % 2)) for i in range(500)] + [("few", v) for v in (3.0, 1.0, None, 2.0, 4.0)]
    rows += [("none", None)] * 3 + [(None, v) for v in (5.0, 1.0, 9.0)] + [("wide", 10.0 ** rng.uniform(-300, 300)) for _ in range(701)]
    rows += [("ties", float(rng.choice([1, 2, 2, 2, 3]))) for _ in range(800)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r.median for r in exact_median(df, ["k"], "v", most=most).collect()}
    want = {k: [v for g, v in rows if g == k and v is not None] for k, _ in rows}
    assert got == {k: statistics.median(v) if v else None for k, v in want.items()}
    assert exact_median(df.where("false"), ["k"], "v").collect() == []


def test_median_never_deals_rows_by_group(spark, monkeypatch):
    """However few the groups, the rows stay where they are until little is left of them."""
    plans = []

    def cut(df):
        if "_v" in df.columns or "_below" in df.columns:
            plans.append(df._jdf.queryExecution().executedPlan().toString())
        return cut_lineage(df)
    monkeypatch.setattr(quantiles, "cut_lineage", cut)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")   # as if every table were large
    df = spark.range(9000).selectExpr("id % 3 AS k", "double(id * 7919 % 9001) AS v").unionByName(spark.sql("SELECT 9L AS k, 1D AS v"))
    got = {r.k: r.median for r in exact_median(df, ["k"], "v", most=500).collect()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert got == {k: statistics.median(i * 7919 % 9001 for i in range(k, 9000, 3)) for k in range(3)} | {9: 1.0}
    assert plans and not any("SortMergeJoin" in p or "ShuffledHashJoin" in p for p in plans)


def test_one_order_of_day_and_month_a_column(spark):
    rows = [("d", "5/8/2004"), ("d", "15/08/2004"), ("d", " 1/2/2005 07:30 "), ("m", "5/8/2004"), ("m", "8/25/2004"), ("m", "25/8/2004"),
            ("m", "8/26/2004"), ("?", "5/8/2004"), ("?", None), ("iso", "2024-01-15T10:00Z"), ("iso", "2024-01-15"), ("iso", "x")]
    df = spark.createDataFrame(rows, "file string, raw string")
    got = {(r.file, r.raw): (r.t and str(r.t), r.decided) for r in
           CL.parse_times(df, "raw", "ts", by=["file"]).selectExpr("file", "raw", "CAST(ts AS STRING) AS t", "decided").collect()}
    assert got["d", "5/8/2004"] == ("2004-08-05 00:00:00", True) and got["d", "15/08/2004"] == ("2004-08-15 00:00:00", True)
    assert got["d", " 1/2/2005 07:30 "] == ("2005-02-01 07:30:00", True)
    assert got["m", "5/8/2004"] == ("2004-05-08 00:00:00", True) and got["m", "25/8/2004"] == (None, True)  # outvoted
    assert got["?", "5/8/2004"] == ("2004-05-08 00:00:00", False) and got["?", None] == (None, False)
    assert got["iso", "2024-01-15T10:00Z"][0] == "2024-01-15 10:00:00" and got["iso", "x"][0] is None
    one = spark.createDataFrame([("3/4/2020",), ("13/4/2020",)], "date string")
    assert sorted(str(r.ts)[:10] for r in CL.to_time_index(one).collect()) == ["2020-04-03", "2020-04-13"]


def test_numeric_columns_count_missing_rows(spark):
    df = spark.createDataFrame([(1, "1", "2", None), (2, None, "x", None), (3, None, "4", None)], "i int, a string, b string, c string")
    assert CL.numeric_columns(df).columns == ["i", "b"]
    assert CL.numeric_columns(df, keep=["c"]).columns == ["c", "i", "b"]
    assert CL.numeric_columns(df.where("false")).columns == ["i"]


def test_innings_by_rank(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([("a", 1, 3), ("a", 2, 4), ("a", 5, 6), ("a", 5, 1), ("b", 9, 2), ("b", None, 8)], "m string, i int, r int")
    got = {r.m: r for r in RS.ranked_pivot(df, ["m"], "i", 4, {"runs": F.sum("r"), "balls": F.count("*")}).collect()}
    assert (got["a"].runs_1, got["a"].runs_2, got["a"].runs_3, got["a"].balls_3, got["a"].runs_4) == (3, 4, 7, 2, None)
    assert (got["b"].runs_1, got["b"].runs_2) == (2, None)


def test_punctuated_tickers(spark):
    df = spark.createDataFrame([("brk.b, BRK.B! xBRK.B BRKAB", "bf-b"), (None, "BF-B GME"), ("gme", None)], "title string, body string")
    got = {r.ticker: r.mentions for r in TO.keyword_mentions(df, ["title", "body"], ["BRK.B", "BF-B", "GME", "A.B"]).collect()}
    assert got == {"BRK.B": 2, "BF-B": 2, "GME": 2, "A.B": 0}


def test_first_value_passes_over_missing(spark):
    df = spark.createDataFrame([("x", "k", None, 1), ("x", "k", 5.0, 2), ("x", "k", 6.0, 3), ("y", "k", None, 1)], "d string, k string, v double, o int")
    got = {r.d: r.k for r in RS.pivot_first(df, ["d"], "k", "v", ["k"], ["o"]).collect()}
    assert got == {"x": 5.0, "y": None}
    wide = spark.createDataFrame([("s", 2, 1.0, None), ("s", 1, None, None), ("t", 1, 3.0, 4.0)], "s string, o int, d1 double, d2 double")
    got = {r.d: (r.s, r.t) for r in RS.transpose_series(wide, "s", ["d1", "d2"], "d", ["s", "t"], order=["o"]).collect()}
    assert got == {"d1": (1.0, 3.0), "d2": (None, 4.0)}


def test_too_many_columns_are_an_error(spark):
    df = spark.createDataFrame([(str(i),) for i in range(7)] + [(None,)], "c string")
    assert RS.column_values(df, "c", most=7) == [str(i) for i in range(7)]
    with pytest.raises(ValueError):
        RS.column_values(df, "c", most=6)


def test_group_pivot_groups_twice(spark):
    """By (group, rank) and by group, not a third time; a rank or a group without rows is NULL, a rank left out no row less."""
    df = spark.createDataFrame([("a", 1, 2.0), ("a", 1, 3.0), ("a", 2, None), ("b", 7, 1.0), (None, 2, 4.0)], "g string, r int, v double")
    got = RS.group_pivot(df, ["g"], "r", [1, 2], {"s": F.sum("v"), "n": F.count("v")})
    assert got._jdf.queryExecution().executedPlan().toString().count("HashAggregate") == 4
    assert got.columns == ["g", "s_1", "n_1", "s_2", "n_2"]
    assert sorted(map(tuple, got.collect()), key=str) == [("a", 5.0, 2, None, 0), ("b", None, None, None, None), (None, None, None, 4.0, 1)]
