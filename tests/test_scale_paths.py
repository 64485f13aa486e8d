"""Skew paths: a hot key must give the same answer as brute force."""
import random

from pyspark.sql import functions as F

from ledgerline.operators import reshape as RS
from ledgerline.operators import text_ops as TO
from ledgerline.operators import topk as TK


def test_first_n_per_group_hot_key(spark):
    rnd = random.Random(5)
    rows = [("hot", rnd.randint(0, 5000), i) for i in range(6000)] + \
           [(f"k{j}", rnd.randint(0, 50), 10_000 + j) for j in range(300)]
    df = spark.createDataFrame(rows, "key string, v int, id int")
    got = sorted(r.id for r in TK.first_n_per_group(df, "key", "v", 4, salt_buckets=7).collect())
    firsts = {}
    for k, v, _ in rows:
        firsts.setdefault(k, set()).add(v)
    keep = {k: sorted(vs)[:4] for k, vs in firsts.items()}
    exp = sorted(i for k, v, i in rows if v in keep[k])
    assert got == exp


def test_keep_first_and_latest_hot_key(spark):
    df = spark.createDataFrame([("a", i % 97, i) for i in range(5000)], "k string, ts int, id int")
    first = RS.keep_first(df, ["k"], ["ts", "id"]).first()
    last = RS.latest(df, ["k"], ["ts", "id"]).first()
    assert (first.ts, first.id) == (0, 0)
    assert (last.ts, last.id) == (96, 4946)


def test_consistent_labels_digest(spark):
    df = spark.createDataFrame([("same text", "pos", 1), ("same text", "neg", 2), ("other", "pos", 3),
                                ("other", "pos", 4)], "text string, y string, id int")
    got = sorted(r.id for r in TO.consistent_labels(df, "text", "y").collect())
    assert got == [3, 4]
    share = {r.y: r.share for r in TO.label_share(df, "y").collect()}
    assert share == {"pos": 0.75, "neg": 0.25}


def test_pivot_unique_fails_on_duplicates(spark):
    import pytest
    ok = spark.createDataFrame([("d1", "a", 1.0), ("d1", "b", 2.0)], "d string, k string, v double")
    assert RS.pivot_unique(ok, ["d"], "k", "v", ["a", "b"]).first()["b"] == 2.0
    dup = spark.createDataFrame([("d1", "a", 1.0), ("d1", "a", 2.0)], "d string, k string, v double")
    with pytest.raises(Exception):
        RS.pivot_unique(dup, ["d"], "k", "v", ["a", "b"]).collect()


def test_pivots_keep_keys_nobody_listed(spark):
    long = spark.createDataFrame([("d1", "a", 1.0, 1), ("d1", "new", 2.0, 1), ("d1", "new", 3.0, 0), ("d2", None, 9.0, 1)],
                                 "d string, k string, v double, o int")
    first = {r["d"]: r.asDict() for r in RS.pivot_first(long, ["d"], "k", "v", None, ["o"]).collect()}
    assert first["d1"] == {"d": "d1", "a": 1.0, "new": 3.0} and first["d2"] == {"d": "d2", "a": None, "new": None}
    one = long.filter("o = 1")
    assert RS.pivot_unique(one, ["d"], "k", "v").columns == ["d", "a", "new"]
    wide = spark.createDataFrame([("x", 1.0, 2.0), ("y", 3.0, None)], "s string, `2020` double, `2021` double")
    got = {r["year"]: (r["x"], r["y"]) for r in RS.transpose_series(wide, "s", ["2020", "2021"], "year").collect()}
    assert got == {"2020": (1.0, 3.0), "2021": (2.0, None)}


def test_winning_row_ties_and_missing_prices(spark):
    from ledgerline.operators import topk as TK
    rows = spark.createDataFrame([(1, "b", 0.5, 2), (1, "a", 0.5, 1), (1, "c", 0.1, 0), (2, "x", None, 1), (2, "y", 1.0, 2)],
                                 "m int, o string, p double, i int")
    got = {r["m"]: r["o"] for r in TK.winning_row(rows, ["m"], "o", "p", ["i"]).collect()}
    assert got == {1: "a", 2: None}
