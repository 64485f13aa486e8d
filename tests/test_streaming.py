"""T-01 / T-04 semantics on a file stream fed in two batches."""
import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.plans import registry
from ledgerline.sources.lake import scratch_path
from ledgerline.streaming import ops as ST

SF001 = "/root/testdata/sf0.001"
registry.load_all()

SCHEMA = "event_id long, ts timestamp_ntz, event_type string, value double"


def _write(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def test_stream_bars_drop_late_rows(spark):
    src = scratch_path(spark, "stream-src")
    base = dt.datetime(2024, 1, 1, 10, 0)
    batch1 = [(i, base + dt.timedelta(minutes=10 * i), "a", float(i)) for i in range(13)]      # 10:00 .. 12:00
    _write(spark, src, batch1)
    out, ck = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-ck")
    stream = ST.read_stream(spark, src, SCHEMA)
    bars = ST.stream_bars(stream, "event_type", "ts", "value", "event_id")
    ST.run_to_parquet(bars, out, ck)
    # second batch: one late row for the closed 10:00 window, new rows up to 14:00
    late = [(100, base + dt.timedelta(minutes=5), "a", 999.0)]
    fresh = [(200 + i, base + dt.timedelta(hours=2, minutes=10 * i), "a", 50.0 + i) for i in range(13)]
    _write(spark, src, late + fresh)
    ST.run_to_parquet(ST.stream_bars(ST.read_stream(spark, src, SCHEMA), "event_type", "ts", "value", "event_id"),
                      out, ck)
    got = {r.window_start.replace(tzinfo=None): r for r in spark.read.parquet(out).collect()}
    ten = got[dt.datetime(2024, 1, 1, 10, 0)]
    assert ten.high == 5.0 and ten.volume == 6.0          # the late 999.0 row was dropped
    assert dt.datetime(2024, 1, 1, 12, 0) in got          # closed by the second batch's watermark
    assert len(got) == len(set(got))                      # each window emitted once


def test_stream_dedupe_within_watermark(spark):
    src = scratch_path(spark, "stream-dd")
    base = dt.datetime(2024, 1, 1, 10, 0)
    rows = [(i, base + dt.timedelta(minutes=i), "a" if i % 2 else "b", 1.0) for i in range(10)]
    _write(spark, src, rows + rows)                        # every row twice
    out, ck = scratch_path(spark, "dd-out"), scratch_path(spark, "dd-ck")
    s = ST.read_stream(spark, src, SCHEMA)
    ST.run_to_parquet(ST.stream_dedupe(s, ["event_id"], "ts", "1 hour"), out, ck)
    assert spark.read.parquet(out).count() == 10


@pytest.mark.parametrize("name, table", [("t02_stream_scores", "documents"), ("t04_stream_dedupe", "events")])
def test_streams_of_tables_in_parts(spark, tmp_path, name, table):
    """A table may be a folder of part files: the stream reads all of them."""
    rows = spark.read.parquet(f"{SF001}/{table}.parquet")
    rows.repartition(3).write.parquet(f"{tmp_path}/{table}.parquet")
    run = registry.prepared(registry.QUERIES[name])
    got, want = (sorted(map(tuple, run(spark, sf).collect()), key=str) for sf in (str(tmp_path), SF001))
    assert got == want and len(got) == (rows.count() if table == "documents" else 5)


START = 1_700_000_000 // 3600 * 3600


def test_streamed_features_equal_the_batch(spark, tmp_path):
    import random

    from pyspark.sql import functions as F

    from ledgerline.operators import features as FT
    from ledgerline.streaming import features as SF
    from ledgerline.streaming import ops as ST
    rng = random.Random(1)
    rows = [(a, 3600 * i, max(0.0, 50 + rng.gauss(0, 9)) * (i != 7), float(rng.randrange(1, 99)))
            for a, n in (("a", 90), ("b", 31), ("c", 1), ("d", 0)) for i in range(n)]
    df = spark.createDataFrame(rows, "asset string, s long, close double, volume double") \
        .select("asset", F.timestamp_seconds(F.col("s") + START).alias("ts"), "close", "volume")
    late = [("a", 3600 * 3, 1.0, 1.0), ("a", 3600 * 29, 1.0, 1.0)]  # at or before what was emitted
    path, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    with SF.with_rocksdb(spark):
        for i, (lo, hi) in enumerate(((0, 1), (1, 30), (30, 90))):
            part = df.where((F.unix_timestamp("ts") >= START + 3600 * lo) & (F.unix_timestamp("ts") < START + 3600 * hi)).repartition(3)
            if i == 2:
                part = part.unionByName(spark.createDataFrame(late, "asset string, s long, close double, volume double")
                                        .select("asset", F.timestamp_seconds(F.col("s") + START).alias("ts"), "close", "volume"))
            part.write.mode("append").parquet(path)
            ST.run_to_parquet(SF.stream_features(spark.readStream.schema(df.schema).parquet(path), delay="100 days"), out, ck)
    got = spark.read.parquet(out)
    want = FT.build_features(df, gaps=False)
    cols = ["asset", "ts", *FT.FEATURE_COLUMNS]
    key = lambda r: (r[0], r[1])
    g, w = (sorted(map(tuple, d.select(*cols).collect()), key=key) for d in (got, want))
    assert [key(r) for r in g] == [key(r) for r in w]
    for a, b in zip(g, w, strict=True):
        for x, y in zip(a[2:], b[2:], strict=True):
            assert (x is None) == (y is None) and (x is None or abs(x - y) < 1e-9), (a, b)


def test_silent_series_start_anew(spark, tmp_path):
    from pyspark.sql import functions as F

    from ledgerline.streaming import features as SF
    from ledgerline.streaming import ops as ST
    path, out, ck = (str(tmp_path / x) for x in ("in", "out", "ck"))
    hour = 3600
    with SF.with_rocksdb(spark):
        for rows in ([("a", 0, 5.0), ("a", hour, 6.0), ("b", hour, 1.0)], [("b", 90 * hour, 1.0)], [("b", 91 * hour, 2.0)], [("a", 92 * hour, 9.0)]):
            spark.createDataFrame([(a, s, c, 1.0) for a, s, c in rows], "asset string, s long, close double, volume double") \
                .select("asset", F.timestamp_seconds(F.col("s") + START).alias("ts"), "close", "volume").write.mode("append").parquet(path)
            stream = spark.readStream.schema("asset string, ts timestamp, close double, volume double").parquet(path)
            ST.run_to_parquet(SF.stream_features(stream, timeout_hours=24), out, ck)
    got = {(r.asset, r.s // hour): r.log_return for r in spark.read.parquet(out).withColumn("s", F.unix_timestamp("ts") - START).collect()}
    assert got["a", 1] is not None and got["b", 91] is not None and got["a", 92] is None
