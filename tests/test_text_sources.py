import json
import os
import uuid

import pytest
from pyspark.sql import functions as F

from ledgerline.functions import text as TX
from ledgerline.operators import reshape as RS
from ledgerline.operators import text_ops as TO
from ledgerline.sources import lake as LK
from ledgerline.sources import nested as NS
from ledgerline.sources import raw as RW


def one(spark, col, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} string" for k in cols))
    return df.select(col.alias("x")).first()["x"]


def test_parse_instruction(spark):
    t = "## Is this news positive?\n\n### Input\nShares jump 5%\nafter results\n\n### Response\nYes"
    p = one(spark, TX.parse_instruction(F.col("t")), t=t)
    assert p["question"] == "Is this news positive?"
    assert p["headline"] == "Shares jump 5%\nafter results"
    assert p["response"] == "Yes"
    assert one(spark, TX.parse_instruction(F.col("t")), t="no markers") is None


@pytest.mark.parametrize("q,r,label", [
    ("Is the price going up?", "Yes", "positive"), ("Is the price going up?", "No", "negative"),
    ("Is the price going up?", "Maybe", None), ("Is the price going down?", "no", "positive"),
    ("Is the price staying constant?", "No", None), ("Is this positive?", "Maybe", "negative"),
    ("Is this bearish?", "No", "positive"), ("Is it neutral?", "yes", "neutral"), ("What is it?", "Yes", None)])
def test_label_decision_list(spark, q, r, label):
    assert one(spark, TX.sentiment_label(F.col("q"), F.col("r")), q=q, r=r) == label


def test_keyword_score_substring_and_literal(spark):
    assert one(spark, TX.keyword_score(F.col("t")), t="support the moon") == 1.0     # 'up' inside 'support'
    assert one(spark, TX.keyword_score(F.col("t")), t="nothing here") == 0.0
    assert one(spark, TX.contains_any(F.lower(F.col("t")), ["a.b"]), t="axb") is False


def test_winning_outcome_and_json(spark):
    df = spark.createDataFrame([(["yes", "no"], ["0.3", "0.7"]), (["a", "b"], ["0.5", "bad"]), ([], [])],
                               "o array<string>, p array<string>")
    got = [r[0] for r in df.select(TX.winning_outcome("o", "p")).collect()]
    assert got == ["no", None, None]
    assert one(spark, TX.json_list(F.col("t")), t="[\"a\", 1]") == ["a", "1"]
    assert one(spark, TX.json_list(F.col("t")), t="{bad") is None
    assert one(spark, TX.score_from_text(F.col("t")), t="score: 0.7") == 0.7
    assert one(spark, TX.score_from_text(F.col("t")), t="no number") == 0.0
    assert one(spark, TX.score_from_text(F.col("t")), t="-3") == -1.0


def test_prepare_sentiment_reasons(spark):
    rows = [("## Is the price going up?\n\n### Input\nA\n\n### Response\nYes",),
            ("## What is the weather?\n\n### Input\nB\n\n### Response\nYes",),
            ("garbage",)]
    out = TO.prepare_sentiment(spark.createDataFrame(rows, "text string")).collect()
    assert [r["drop_reason"] for r in out] == [None, "not_sentiment", "unparsed"]
    assert out[0]["sentiment"] == "positive"


def _write(tmp, name, text):
    p = os.path.join(tmp, name)
    with open(p, "w") as f:
        f.write(text)
    return p


def test_raw_files_end_to_end(spark, tmp_path):
    d = str(tmp_path / f"raw-{uuid.uuid4().hex[:6]}")
    os.makedirs(d)
    _write(d, "ff.csv", "Created by X\n\n,Mkt,SMB\n20200101,1.0,2.0\n20200102,3.5,.\n\n Annual\n,Mkt,SMB\n2020,9,9\n")
    lines = RW.read_lines(spark, d + "/ff.csv")
    rows = RW.csv_after_header(lines, F.col("line").startswith(","), ["date", "mkt", "smb"]).orderBy("pos").collect()
    assert [(r.date, r.mkt) for r in rows] == [("20200101", "1.0"), ("20200102", "3.5")]
    _write(d, "idx.txt", "Header\n" + "-" * 20 + "\n" + "4".ljust(12) + "ACME".ljust(62) + "123".ljust(12)
           + "2024-01-02".ljust(12) + "edgar/1.txt\n" + "10-K".ljust(12) + "X".ljust(62) + "1".ljust(12)
           + "2024-01-02".ljust(12) + "edgar/2.txt\n")
    fw = RW.fixed_width(RW.read_lines(spark, d + "/idx.txt")).collect()
    assert [(r.form, r.company, r.cik, r.filename) for r in fw] == [("4", "ACME", "123", "edgar/1.txt")]


def test_landed_lines_keep_their_order_over_splits(spark):
    lines = spark.range(20_000).select(F.concat(F.lit("f/"), (F.col("id") % 3).cast("string")).alias("file"),
                                       F.col("id").alias("pos"), F.concat(F.lit("line "), F.col("id")).alias("line"))
    path = LK.scratch_path(spark, "test-lines")
    RW.land_lines(lines, path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")   # each file is read in several splits
    try:
        back = RW.read_landed(spark, path)
        assert back.rdd.getNumPartitions() > 10
        for f in ("f/0", "f/1", "f/2"):
            got = [int(r.line[5:]) for r in back.filter(F.col("file") == f).orderBy("pos").collect()]
            assert got == list(range(int(f[-1]), 20_000, 3))
        headless = RW.after_first_line(back).filter(F.col("file") == "f/1").agg(F.min("line")).first()[0]
        assert headless == "line 10" and RW.after_first_line(back).count() == 19_997
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_quoted_fields_and_comments(spark, tmp_path):
    d = str(tmp_path)
    _write(d, "q.csv", "# note, with comma\n1,\"Smith, J\",NA\n2,\"say \"\"hi\"\"\",x\n")
    got = [tuple(r) for r in RW.read_delimited(spark, d + "/q.csv", ["id", "name", "v"], comment="#", missing="NA").collect()]
    assert got[0] == ("1", "Smith, J", None)
    lines = RW.drop_comments(RW.read_lines(spark, d + "/q.csv"))
    rows = RW.positional_csv(lines, {0: "id", 1: "name", 9: "none"}, min_fields=3).orderBy("id").collect()
    assert [tuple(r) for r in rows] == [("1", "Smith, J", None), ("2", 'say "hi"', None)]


def test_asset_files_and_changed_files(spark):
    root = LK.scratch_path(spark, "test-assets")
    spark.createDataFrame([(1.0,), (2.0,)], "close double").coalesce(1).write.parquet(root)
    df = LK.read_file_per_asset(spark, root)
    assert df.count() == 2 and df.filter("asset LIKE 'part-%' AND asset NOT LIKE '%.parquet'").count() == 2
    assert LK.read_changed_files(spark, root, "-1h").count() == 2
    assert LK.read_changed_files(spark, root, "2020-01-01").count() == 2
    far = LK.parse_since("-1h").replace(year=2200).isoformat()
    assert LK.read_changed_files(spark, root, far).count() == 0


def test_nested_json_and_xml(spark):
    doc = json.dumps({"values": {"GDP": {"USA": {"2020": 1.5, "2021": 2.0}}}})
    df = spark.createDataFrame([(doc,)], "doc string")
    got = sorted(tuple(r) for r in NS.nested_map_rows(df, "doc").collect())
    assert got == [("GDP", "USA", "2020", 1.5), ("GDP", "USA", "2021", 2.0)]
    xml = ("<wrapper><?xml version=\"1.0\"?><ownershipDocument><issuer><issuerTradingSymbol>AB</issuerTradingSymbol>"
           "</issuer><nonDerivativeTable><nonDerivativeTransaction><transactionAmounts><transactionShares><value>10"
           "</value></transactionShares><transactionPricePerShare><value>2.5</value></transactionPricePerShare>"
           "</transactionAmounts></nonDerivativeTransaction></nonDerivativeTable></ownershipDocument></wrapper>")
    x = spark.createDataFrame([(xml, "2024-01-05")], "doc string, fd string").withColumn("doc", NS.extract_xml("doc"))
    t = NS.form4_transactions(x, "doc", file_date="fd").first()
    assert t["ticker"] == "AB" and t["transaction_value"] == 25.0 and t["transaction_date"] == "2024-01-05"


def test_lake_skip_empty_and_pruning(spark):
    b = spark.createDataFrame([("crypto", "btc", 1.0), ("fx", "eur", 2.0)], "category string, asset string, close double")
    root = LK.scratch_path(spark, "test-lake")
    assert LK.write_lake(b.filter("false"), root) is False
    assert LK.write_lake(b, root) is True
    df = LK.read_lake(spark, root, ["crypto"])
    assert [r.asset for r in df.collect()] == ["btc"]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert LK.parse_since("-2d").tzinfo is not None


def test_sdmx_any_number_of_dimensions(spark):
    doc = json.dumps({"structure": {"dimensions": {"observation": [
        {"id": "REF_AREA", "values": [{"id": "USA"}, {"id": "FRA"}]}, {"id": "MEASURE", "values": [{"id": "CLI"}]},
        {"id": "TIME", "values": [{"id": "2020-01"}, {"id": "2020-02"}]}]}},
        "observations": {"1:0:1": [99.5], "0:0:0": [100.1]}})
    rows = NS.sdmx_observations(spark.createDataFrame([(doc,)], "doc string"), "doc", n_dims=3).collect()
    got = sorted((r.dim_0, r.dim_1, r.dim_2, r.value) for r in rows)
    assert got == [("FRA", "CLI", "2020-02", 99.5), ("USA", "CLI", "2020-01", 100.1)]
    assert rows[0].dimensions["MEASURE"] == "CLI"


def test_xbrl_facts_one_taxonomy_dated_rows(spark):
    entry = '{"end": "%s", "val": %s, "form": "%s", "fp": "%s"}'
    doc = ('{"facts": {"us-gaap": {"GrossProfit": {"units": {"USD": [' + ", ".join([
        entry % ("2020-12-31", "5.5", "10-K", "FY"), entry % ("", "6", "10-K", "FY"),
        entry % ("2020-06-30", '"bad"', "10-Q", "Q2"), entry % ("2020-06-30", "7", "8-K", "Q2")])
        + ']}}}, "ifrs-full": {"Revenues": {"units": {"EUR": [' + entry % ("2020-12-31", "1", "20-F", "FY") + "]}}}}}")
    df = spark.createDataFrame([(1, doc), (2, '{"facts": {}}'), (3, None), (4, "{bad")], "id long, doc string")
    got = sorted((r["id"], str(r["date"])[:10], r["metric"], r["value"], r["form"], r["period"], r["unit"])
                 for r in NS.xbrl_facts(df, "doc", keep=["id"]).collect())
    assert got == [(1, "2020-06-30", "gross_profit", None, "10-Q", "Q2", "USD"),
                   (1, "2020-12-31", "gross_profit", 5.5, "10-K", "FY", "USD")]


def test_align_series_has_a_column_for_every_key(spark):
    long = spark.createDataFrame([(1, "a", 1.0), (1, "new", 2.0), (2, "a", 3.0), (2, None, 4.0)], "day int, k string, v double")
    out = RS.align_series(long, "day", "k", "v").orderBy("day")
    assert out.columns == ["day", "a", "new"] and [tuple(r) for r in out.collect()] == [(1, 1.0, 2.0), (2, 3.0, None)]
