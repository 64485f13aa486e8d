"""A model for each class, window store, ingest log."""
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import models as MD
from ledgerline.sources import ingest as IN


def test_each_class_has_its_own_model(spark, tmp_path):
    rng = random.Random(1)
    rows = []
    for i in range(600):
        x, z = rng.uniform(-1, 1), rng.random()
        rows += [("up/1", x, z, 5 * x), ("down", x, z, -5 * x)]
    rows += [("few", 1.0, 1.0, 1.0)] * 3 + [(None, 0.0, 0.0, 0.0)] * 90 + [("up/1", None, 0.0, 99.0)]
    df = spark.createDataFrame(rows, "kind string, x double, z double, y double")
    table = MD.train_class_models(df, "kind", str(tmp_path), ["x", "z"], "y", max_iter=5, max_depth=3)
    assert {r.kind: r.rows for r in table.collect()} == {"up/1": 600, "down": 600}
    test = spark.createDataFrame([(k, x, 0.5) for k in ("up/1", "down", "few", None) for x in (-0.8, 0.8)], "kind string, x double, z double")
    again = spark.read.parquet(f"{tmp_path}/models")
    got = {(r.kind, r.x): r.prediction for r in MD.score_by_class(test, again, "kind", ["x", "z"]).collect()}
    assert len(got) == 4 and got["up/1", 0.8] > 2 > -2 > got["up/1", -0.8] and got["down", 0.8] < -2 < 2 < got["down", -0.8]
    with pytest.raises(ValueError):
        MD.train_class_models(df, "kind", str(tmp_path / "b"), ["x", "z"], "y", most=1)
    assert MD.score_by_class(test, again.where("false"), "kind", ["x", "z"]).collect() == []


@pytest.mark.parametrize("lookback", [1, 5, 16])
def test_window_store_round_trip(spark, tmp_path, lookback):
    rng = random.Random(2)
    rows = [(a, i, None if rng.random() < 0.02 else rng.random(), rng.random(), None if i == n - 1 else float(i))
            for a, n in (("a", 300), ("b", 64), ("c", 3), (None, 40)) for i in range(n)]  # a row without a key is in no series
    df = spark.createDataFrame(rows, "asset string, ts long, u double, v double, target double").repartition(4)
    MD.write_window_store(df, f"{tmp_path}/w", ["u", "v"], 16, "target", chunk_rows=64)
    stored = spark.read.parquet(f"{tmp_path}/w").select(F.sum(F.size("x"))).first()[0]
    assert stored < 1.5 * len(rows)  # not 16-fold
    got = sorted((r.asset or "", r.ts, [tuple(v) for v in r.window], r.target) for r in MD.read_windows(spark, f"{tmp_path}/w", lookback).collect())
    want = []
    for a in ("a", "b", "c"):
        s = [r for r in rows if r[0] == a]
        for i in range(lookback - 1, len(s)):
            w = [(r[2], r[3]) for r in s[i - lookback + 1:i + 1]]
            if all(u is not None for u, _ in w):
                want.append((a or "", s[i][1], w, s[i][4]))
    assert got == sorted(want)


def test_ingest_log(spark, tmp_path):
    root, key, order = f"{tmp_path}/lake", ["k"], ["ts", "id"]
    def rows(*r):
        return spark.createDataFrame(list(r), "k string, ts int, id int, v string")
    with pytest.raises(ValueError):
        IN.committed(spark, root)
    one = rows(("a", 1, 1, "x"), ("a", 2, 1, "x"), ("b", 5, 1, "x"), (None, 1, 1, "x"), ("a", None, 9, "no time"))
    assert IN.ingest(spark, root, "1", one, key, order) == 4
    assert IN.ingest(spark, root, "1", one, key, order) == 0 and IN.ingest(spark, root, "1b", one, key, order) == 0
    rows(("a", 99, 1, "lost")).write.parquet(f"{root}/data/batch=2")  # a run that died before its commit
    assert {r.v for r in IN.committed(spark, root).collect()} == {"x"}
    two = rows(("a", 2, 1, "old"), ("a", 2, 2, "y"), ("b", 4, 9, "late"), ("c", 0, 0, "y"), (None, 2, 0, "y"))
    assert IN.ingest(spark, root, "2", two, key, order) == 3
    assert sorted((r.k or "", r.ts, r.id, r.v, r.batch) for r in IN.committed(spark, root).collect()) == sorted([
        ("a", 1, 1, "x", "1"), ("a", 2, 1, "x", "1"), ("b", 5, 1, "x", "1"), ("", 1, 1, "x", "1"), ("a", 2, 2, "y", "2"),
        ("c", 0, 0, "y", "2"), ("", 2, 0, "y", "2")])
    marks = {r.k: (r.high_water.ts, r.high_water.id) for r in IN.high_water(IN.ingest_log(spark, root), key).collect()}
    assert marks == {"a": (2, 2), "b": (5, 1), "c": (0, 0), None: (2, 0)}
    assert IN.ingest(spark, root, "3", one.where("false"), key, order) == 0
