"""Cases of the round-1 review: inputs that the oracles' own renderings did not contain."""
from pyspark.sql import functions as F

from ledgerline.operators import clean, metrics
from ledgerline.plans import sequence as sq
from ledgerline.sources import nested, raw


def lines(spark, rows):
    return spark.createDataFrame(rows, "file string, pos long, line string")


def test_unlisted_and_null_predictions_count_as_wrong(spark):
    df = spark.createDataFrame([("positive", "positive"), ("negative", "negative"), ("positive", "other"), ("positive", None)],
                               "y_true string, y_pred string")
    per, summary = metrics.classification_report(df)
    s = summary.first()
    assert (s.accuracy, s.num_samples) == (0.5, 4)
    assert {r.label: r.support for r in per.collect()} == {"positive": 3, "negative": 1, "neutral": 0}
    none = metrics.classification_report(df.limit(0))[1].first()
    assert (none.accuracy, none.weighted_f1, none.num_samples) == (0.0, 0.0, 0)


def test_last_fixed_width_field_is_whole(spark):
    row = "4".ljust(12) + "Co".ljust(62) + "1".ljust(12) + "1996-01-01".ljust(12) + "x" * 12_000
    out = raw.fixed_width(lines(spark, [("f", 0, "---"), ("f", 1, row)])).first()
    assert len(out.filename) == 12_000


def test_header_after_comments(spark):
    left = raw.drop_comments(lines(spark, [("f", 0, "# a;b;c;d"), ("f", 1, "x,y"), ("f", 2, "1,2")]))
    assert [tuple(r)[2:] for r in raw.split_by_file_delimiter(left, ["x", "y"]).collect()] == [("1", "2")]


def test_bad_items_are_missing_not_fatal(spark):
    out = raw.series_csv(lines(spark, [("s.csv", 0, "d,v"), ("s.csv", 1, "2024-01-01,5"), ("s.csv", 2, "end")])).collect()
    assert sorted((str(r.ts)[:10], r.value) for r in out) == [("2024-01-01", 5.0), ("None", None)]
    assert raw.positional_csv(lines(spark, [("f", 0, "a,b")]), {0: "x", 7: "y"}, 2).first().y is None
    assert raw.coded_monthly(lines(spark, [("f", 0, "101xxABCD 1.0")])).first().year is None
    docs = spark.createDataFrame([("[[1, 2.5]]",), ("[[1,",)], "doc string")
    assert [tuple(r) for r in nested.heterogeneous_items(docs, "doc").collect()] == [(1, 2.5)]


def test_form4_first_owner_bad_price_blank_date(spark):
    xml = ("<ownershipDocument><issuer><issuerTradingSymbol>T</issuerTradingSymbol></issuer>"
           "<reportingOwner><reportingOwnerId><rptOwnerName>A</rptOwnerName></reportingOwnerId></reportingOwner>"
           "<reportingOwner><reportingOwnerId><rptOwnerName>B</rptOwnerName></reportingOwnerId></reportingOwner>"
           "<nonDerivativeTable><nonDerivativeTransaction><transactionDate><value> </value></transactionDate>"
           "<transactionAmounts><transactionShares><value>5</value></transactionShares><transactionPricePerShare>"
           "<value>abc</value></transactionPricePerShare></transactionAmounts></nonDerivativeTransaction>"
           "</nonDerivativeTable></ownershipDocument>")
    df = spark.createDataFrame([(xml, "2024-02-03")], "doc string, file_date string")
    r = nested.form4_transactions(df, "doc", file_date="file_date").first()
    assert (r.owner_name, r.shares, r.price_per_share, r.transaction_date) == ("A", 5.0, None, "2024-02-03")


def test_zoned_and_day_first_times(spark):
    given = ["2024-01-15T00:00:00Z", "2024-01-15T00:00:00.123Z", "2024-01-15T02:00:00+02:00", "15/08/2004", "2024-01-15T00:00:00"]
    df = spark.createDataFrame([(g,) for g in given], "s string")
    got = [r.t for r in df.select(clean.to_timestamp_any("s").cast("string").alias("t")).collect()]
    assert got == ["2024-01-15 00:00:00", "2024-01-15 00:00:00.123", "2024-01-15 00:00:00", "2004-08-15 00:00:00",
                   "2024-01-15 00:00:00"]


def test_first_non_empty_keeps_the_type(spark):
    df = spark.createDataFrame([(None, 2.0), (0.0, 3.0)], "a double, b double")
    out = df.select(clean.first_non_empty("a", "b", skip_zero=True).alias("x"))
    assert out.dtypes == [("x", "double")] and [r.x for r in out.collect()] == [2.0, 3.0]


def test_role_after_many_lines(spark):
    df = spark.range(1).select(F.transform(F.sequence(F.lit(1), F.lit(65)), lambda i: F.struct(
        F.when(i == 65, "away").otherwise("home").alias("role"), i.alias("team"))).alias("c"))
    assert df.select(nested.pick_by_role("c", "role", "away", 2)["team"]).first()[0] == 65


def test_row_index_starts_no_job_and_numbers_across_buckets(spark):
    rows = [(k, i * 7_000 + k) for k in (1, 2) for i in range(200)] + [(1, None)]
    df = spark.createDataFrame(rows, "k int, s long").selectExpr("k", "timestamp_seconds(s) AS ts", "s")
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("index", "index")
    ix = sq.with_row_index(df, "k", ["ts"])
    assert not tracker.getJobIdsForGroup("index")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = sorted((r.k, r.rn, r.n, r.s) for r in ix.collect())
    want = []
    for k in (1, 2):
        own = sorted((s for kk, s in rows if kk == k), key=lambda s: -1 if s is None else s)
        want += [(k, i, len(own), s) for i, s in enumerate(own)]
    assert [g[:3] for g in got] == [w[:3] for w in want] and [g[3] for g in got] == [w[3] for w in want]
