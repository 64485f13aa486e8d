"""Structure across splits: JSON documents, quoted line breaks, headers, XML filings."""
import json
import random

import pytest
from pyspark.sql import functions as F

from ledgerline.sources import blocks as B
from ledgerline.sources import nested
from ledgerline.sources import raw as RW


@pytest.fixture
def tiny_splits(spark):
    """Files are read in splits of a few hundred bytes."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def odd_text(rng):
    return "".join(rng.choice(['a', '{', '}', '[', ']', '"', '\\', ',', ':', 'é', '\n', ' ']) for _ in range(rng.randrange(9)))


def test_json_elements_equal_the_parser(spark, tmp_path, tiny_splits):
    rng = random.Random(4)
    want, heads = [], []
    for f, indent in enumerate((None, 2, None)):
        doc = {"meta": {"n": odd_text(rng), "x": {"y": [1, [2]]}}, "races": []}
        for r in range(40):
            res = [{"p": p, "s": odd_text(rng), "in": [{"z": odd_text(rng)}, [[]], {}]} for p in range(rng.randrange(6))]
            doc["races"].append({"round": r, "name": odd_text(rng), "Results": res, "after": -r})
            heads.append((f, r, doc["races"][-1]["name"], -r))
            want += [(f, r, i, x["s"], x["in"][0]["z"]) for i, x in enumerate(res)]
        (tmp_path / f"doc{f}.json").write_text(json.dumps(doc, indent=indent, ensure_ascii=f != 2), encoding="utf-8")
    assert B.split_rows(spark, str(tmp_path), "}").select("file", "block").distinct().count() > 20
    no = F.regexp_extract("file", r"doc(\d)", 1).cast("int").alias("f")
    races = B.json_elements(spark, str(tmp_path), 2, names={"list": 2}, shallow=True).where("list = 'races'")
    races = races.select("file", "at", no, F.from_json("text", "round int, name string, after int").alias("r"))
    assert sorted(map(tuple, races.select("f", "r.round", "r.name", "r.after").collect())) == sorted(heads)
    res = B.json_elements(spark, str(tmp_path), 4, names={"list": 4}, parents={"race": 3}).where("list = 'Results'")
    res = res.join(races.select("file", F.col("at").alias("race"), "f", "r.round"), ["file", "race"]) \
        .select("f", "round", F.from_json("text", "p int, s string, `in` string").alias("x"))
    got = [(r.f, r.round, r.x.p, r.x.s, json.loads(r.x["in"])[0]["z"]) for r in res.collect()]
    assert sorted(got) == sorted(want)


def test_json_names_of_dynamic_keys(spark, tmp_path, tiny_splits):
    facts = {t: {f"C{c} \"q\\u00e9": {"label": "}{", "units": {u: [{"v": i, "k": f"{t}{c}{u}"} for i in range(c)] for u in ("USD", "x/y")}}
                 for c in range(7)} for t in ("us-gaap", "dei")}
    (tmp_path / "a.json").write_text(json.dumps({"cik": 1, "facts": facts}))
    got = B.json_elements(spark, str(tmp_path), 6, names={"taxonomy": 3, "concept": 4, "unit": 6})
    rows = got.select("taxonomy", "concept", "unit", F.from_json("text", "v int, k string").alias("e")).collect()
    want = [(t, c, u, e["v"], e["k"]) for t, m in facts.items() for c, d in m.items() for u, es in d["units"].items() for e in es]
    assert sorted((r.taxonomy, r.concept, r.unit, r.e.v, r.e.k) for r in rows) == sorted(want)


def leaves(x, path=()):
    if isinstance(x, dict):
        for k, v in x.items():
            yield from leaves(v, (*path, k))
    elif isinstance(x, list):
        for i, v in enumerate(x):
            yield from leaves(v, (*path, i))
    else:
        yield path, x


def as_text(x):
    return {True: "true", False: "false"}.get(x, x) if isinstance(x, bool) else x if x is None or isinstance(x, str) else json.dumps(x)


def test_json_leaves_equal_the_parser(spark, tmp_path, tiny_splits):
    rng = random.Random(5)
    scalar = lambda: rng.choice([1, -2.5, 3e9, True, None, odd_text(rng), "a, b", "", "x:"])
    docs = {}
    for f, indent in enumerate((None, 2)):
        docs[f] = {"cols": {n: [scalar() for _ in range(80)] for n in ("t", "c")},
                   "map": {f"i{i}": {f"k{j}": scalar() for j in range(rng.randrange(7))} for i in range(30)},
                   "rows": [[scalar() for _ in range(4)] for _ in range(40)], "one": scalar()}
        (tmp_path / f"doc{f}.json").write_text(json.dumps(docs[f], indent=indent, ensure_ascii=False), encoding="utf-8")
    assert B.split_rows(spark, str(tmp_path), ",").select("file", "block").distinct().count() > 10
    got = B.json_leaves(spark, str(tmp_path), 3, names={"top": 2, "mid": 3}, places={"i": 2, "j": 3})
    no = F.regexp_extract("file", r"doc(\d)", 1).cast("int").alias("f")
    rows = got.select(no, "top", "mid", "key", "i", "j", "value").collect()
    have = sorted(((r.f, r.top, r.mid or r.i, r.key or r.j, r.value) for r in rows), key=repr)
    want = sorted(((f, p[0], p[1], p[2], as_text(v)) for f, d in docs.items() for p, v in leaves(d) if len(p) == 3), key=repr)
    assert have == want
    one = B.json_leaves(spark, str(tmp_path), 1).select(no, "key", "value").collect()
    assert sorted(map(tuple, one), key=repr) == sorted([(f, "one", as_text(d["one"])) for f, d in docs.items()], key=repr)


def test_json_of_ordered_parts_and_empty_files(spark, tmp_path, tiny_splits):
    lines = [(0, "d", '{"a": [')] + [(i + 1, "d", f'{"," if i else ""} {{"i": {i}, "t": "}}{{"}}') for i in range(200)] + [(999, "d", "]}")]
    df = spark.createDataFrame(lines, "pos long, file string, line string").repartition(5)
    df.repartitionByRange(3, "pos").sortWithinPartitions("pos").select("file", "line").write.partitionBy("file").text(f"{tmp_path}/x")
    assert len(list((tmp_path / "x" / "file=d").glob("part-*.txt"))) > 1
    got = B.json_elements(spark, f"{tmp_path}/x", 2)
    assert sorted(r.i for r in got.select(F.from_json("text", "i int, t string").alias("e")).select("e.*").where("t = '}{'").collect()) == list(range(200))
    for i, text in enumerate(("", "{}", "[]", "  \n", "[[1],[2]]")):
        (tmp_path / f"y{i}.json").write_text(text)
    assert B.json_elements(spark, f"{tmp_path}/y*.json", 1).collect() == []


def exchanges(df):
    """Exchanges of the plan and of those that it keeps."""
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange")


def test_json_text_stays_in_its_task(spark, tmp_path, tiny_splits):
    """Only parts of objects across the ends of splits are exchanged; names may hold separators, and a part may
    end in one."""
    doc = {"a, b}": {f"k,{i}": [i, "x, }" * (i % 5)] for i in range(60)}}
    (tmp_path / "a.json").write_text(json.dumps(doc))
    got = B.json_leaves(spark, f"{tmp_path}/a.json", 3, names={"top": 2, "k": 3}, places={"p": 3})
    assert exchanges(got) == 0
    assert sorted((r.top, r.k, r.p, r.value) for r in got.collect()) == sorted(
        ("a, b}", k, p, str(v)) for k, vs in doc["a, b}"].items() for p, v in enumerate(vs))
    (tmp_path / "one").mkdir()
    (tmp_path / "one" / "a.json").write_text('{"x": [' + ", ".join(['{"i": 1}'] * 5) + "]}")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1000")
    whole = B.json_elements(spark, f"{tmp_path}/one", 2)
    assert exchanges(whole) == 0 and whole.count() == 5
    (tmp_path / "p" / "file=d").mkdir(parents=True)
    for i, text in enumerate(('{"x": [{"i": {"j": 1}', '}, {"i": {"j":', ' 2}}, {"i": {"j": 3}}', "]}")):
        (tmp_path / "p" / "file=d" / f"part-0000{i}.txt").write_text(text)
    parts = B.json_elements(spark, f"{tmp_path}/p", 2, names={"list": 2}, parents={"up": 2})
    assert sorted((r.list, r.up, json.loads(r.text)["i"]["j"]) for r in parts.collect()) == [("x", 1, 1), ("x", 1, 2), ("x", 1, 3)]


def test_quoted_records_equal_the_csv_reader(spark, tmp_path, tiny_splits):
    import csv
    rng = random.Random(6)
    rows = [[str(i), "".join(rng.choice(['x', '"', '\n', ',', ' ', 'é']) for _ in range(rng.randrange(30))), "end"] for i in range(300)]
    with open(tmp_path / "a.csv", "w", newline="", encoding="utf-8") as f:
        csv.writer(f, lineterminator="\n").writerows(rows)
    rec = B.quoted_records(B.split_rows(spark, str(tmp_path)))
    out = rec.orderBy("pos").select(RW.split_quoted(F.col("line")).alias("f")).collect()
    assert [r.f for r in out] == rows


def test_headers_in_another_order(spark):
    lines = spark.createDataFrame([("a", 0, "Date, Total ,status"), ("a", 1, "d1,1,F"), ("a", 2, " "), ("a", 3, "d2,2"),
                                   ("b", 5, "status;;date;total;date"), ("b", 6, "O;x;d3;3;no;more"), ("c", 0, "date")],
                                  "file string, pos int, line string")
    split = F.split("line", "[;,]")
    header = lines.groupBy("file").agg(F.min("pos").alias("pos"), F.min_by(split, "pos").alias("names"))
    got = B.columns_of(B.by_header(lines, split, header), ["date", "total", "status", "absent"])
    assert sorted(map(tuple, got.collect()), key=str) == [("a", "d1", "1", "F", None), ("a", "d2", "2", None, None), ("b", "d3", "3", "O", None)]


def test_xml_filings(spark, tmp_path, tiny_splits):
    def filing(n, owner):
        t = "".join(f"<nonDerivativeTransaction><transactionDate><value>{d}</value></transactionDate><transactionAmounts>"
                    f"<transactionShares><value>{s}</value></transactionShares><transactionPricePerShare><value>2.5</value>"
                    "</transactionPricePerShare><transactionAcquiredDisposedCode><value>A</value></transactionAcquiredDisposedCode>"
                    "</transactionAmounts></nonDerivativeTransaction>" for d, s in n)
        return ("<ownershipDocument><issuer><issuerName>I</issuerName><issuerTradingSymbol>TCK</issuerTradingSymbol></issuer>"
                f"<reportingOwner><reportingOwnerId><rptOwnerName>{owner}</rptOwnerName></reportingOwnerId></reportingOwner>"
                "<reportingOwner><reportingOwnerId><rptOwnerName>Second</rptOwnerName></reportingOwnerId></reportingOwner>"
                f"<nonDerivativeTable>{t}</nonDerivativeTable></ownershipDocument>")
    (tmp_path / "f-20240105.txt").write_text("header < 3 & text\n<XML>\n<?xml version=\"1.0\"?>\n" + filing([("2024-01-02", 10), (" ", "abc")], "Bo") + "\n</XML>")
    (tmp_path / "g.xml").write_text(filing([("2024-02-0%d" % (i % 9 + 1), i) for i in range(500)], "Cy"))
    (tmp_path / "h.xml").write_text(filing([], "Dee"))
    rows = B.filing_transactions(spark, str(tmp_path)).collect()
    assert len(rows) == 502 and {r.ticker for r in rows} == {"TCK"}
    two = sorted((r.transaction_date, r.owner_name, r.shares, r.transaction_value) for r in rows if "f-2024" in r.file)
    assert two == [("2024-01-02", "Bo", 10.0, 25.0), ("2024-01-05", "Bo", None, None)]
    assert sum(r.shares for r in rows if r.owner_name == "Cy") == sum(range(500))


def test_heads_of_filings_are_read_in_splits(spark, tmp_path, tiny_splits):
    """Issuer and first owner come from text rows, not from one task that reads a whole file; a comment is none."""
    head = "<!-- <issuer><issuerName>No</issuerName></issuer> --><issuer a='/'><issuerName>A &amp; B</issuerName></issuer>"
    owner = "<reportingOwner><reportingOwnerId><rptOwnerName>{}</rptOwnerName></reportingOwnerId></reportingOwner>"
    txn = "<nonDerivativeTransaction><transactionAmounts><transactionShares><value>1</value></transactionShares></transactionAmounts></nonDerivativeTransaction>"
    (tmp_path / "a-20240105.txt").write_text("x <issuers/>" + head + owner.format("One") + owner.format("Two") + txn * 30)
    (tmp_path / "b-20240106.txt").write_text("<issuer/>" + txn * 9 + owner.format("Late"))
    got = B.filing_transactions(spark, str(tmp_path))
    assert "FileScan xml" not in got._jdf.queryExecution().executedPlan().toString()
    rows = got.groupBy("transaction_date", "issuer_name", "ticker", "owner_name").count().collect()
    assert sorted(map(tuple, rows)) == [("2024-01-05", "A & B", None, "One", 30), ("2024-01-06", None, None, "Late", 9)]


def test_a_filing_may_be_a_folder_of_compressed_parts(spark, tmp_path):
    """Parts, in the order of task and file number, are one file: heads of an early part hold for the rows of all."""
    import gzip
    txn = "<nonDerivativeTransaction><transactionAmounts><transactionShares><value>{}</value></transactionShares></transactionAmounts></nonDerivativeTransaction>\n"
    owner = "<reportingOwner><reportingOwnerId><rptOwnerName>{}</rptOwnerName></reportingOwnerId></reportingOwner>\n"
    issuer = "<issuer><issuerTradingSymbol>{}</issuerTradingSymbol></issuer>\n"
    parts = {"part-00000-x.c000": issuer.format("A") + txn.format(1) * 2, "part-00000-x.c002": txn.format(2) + owner.format("One"),
             "part-00000-x.c010": owner.format("No") + txn.format(3) * 5 + "<nonDerivativeTransactions/>\n",
             "part-00007-x.c000": issuer.format("No") + txn.format(4) + "</ownershipDocument>\n"}
    for f in ("f-20240105", "f-20240106"):
        (tmp_path / f"file={f}").mkdir()
        for name, text in parts.items():
            (tmp_path / f"file={f}" / f"{name}.txt.gz").write_bytes(gzip.compress(text.encode()))
    rows = B.filing_transactions(spark, str(tmp_path)).groupBy("file", "ticker", "owner_name", "transaction_date", "shares").count().collect()
    assert sorted(map(tuple, rows)) == [(f"f-2024010{d}", "A", "One", f"2024-01-0{d}", float(n), k)
                                        for d in (5, 6) for n, k in ((1, 2), (2, 1), (3, 5), (4, 1))]


def test_a_wrapped_filing_in_compressed_parts(spark, tmp_path):
    """The wrapper's header and trailer stand in the first and the last part; the filing is found across all of them."""
    import gzip
    txn = "<nonDerivativeTransaction><transactionDate><value>{}</value></transactionDate>\n<transactionAmounts><transactionShares><value>2</value></transactionShares>" \
          "<transactionPricePerShare><value>1.5</value></transactionPricePerShare></transactionAmounts></nonDerivativeTransaction>\n"
    head = "<ownershipDocument><issuer><issuerName>A &amp; B</issuerName></issuer><reportingOwner><reportingOwnerId><rptOwnerName>{}</rptOwnerName>" \
           "</reportingOwnerId></reportingOwner><nonDerivativeTable>\n"
    for f, before, after in (("f-20240105", "<SEC-DOCUMENT>0001.txt\nfee < 3 & more\n<XML>\n<?xml version=\"1.0\"?>\n", "\n</XML>\n</SEC-DOCUMENT>\n"),
                             ("f-20240106", "header text ", " trailer text < 1 & 2\n")):
        (tmp_path / f"file={f}").mkdir()
        texts = [before + head.format(f[-2:]) + txn.format("2024-01-02"), txn.format("") * 3, txn.format("2024-01-03") + "</nonDerivativeTable></ownershipDocument>" + after]
        for i, text in enumerate(texts):
            (tmp_path / f"file={f}" / f"part-0000{i}-x.c000.txt.gz").write_bytes(gzip.compress(text.encode()))
    rows = B.filing_transactions(spark, str(tmp_path)).groupBy("file", "issuer_name", "owner_name", "transaction_date", "transaction_value").count().collect()
    assert sorted(map(tuple, rows)) == [(f"f-202401{d}", "A & B", d, date, 3.0, k) for d in ("05", "06")
                                        for date, k in sorted([("2024-01-02", 1), ("2024-01-03", 1), (f"2024-01-{d}", 3)])]


def test_files_without_filings_give_no_rows(spark, tmp_path):
    (tmp_path / "a.txt").write_text("no <b>xml</b>\n")
    assert B.filing_transactions(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", ["s27_xml_filings", "s28_wrapped_filings"])
def test_filings_take_little_disk(spark, monkeypatch, name):
    """Landed filings are compressed, in parts of a bounded number of transactions, and transactions aren't exchanged
    to find their issuer and owner."""
    import glob
    import os
    import re
    from urllib.parse import urlparse

    import __spark_entry__ as E
    from ledgerline.plans import fixtures as fx
    from ledgerline.plans import q_files

    sf = "/root/testdata/sf0.001"
    landed = []
    monkeypatch.setattr(q_files, "scratch_path", lambda s, n, make=q_files.scratch_path: landed.append(make(s, n)) or landed[-1])
    monkeypatch.setattr(q_files, "FILING_PART", 30, raising=False)
    df = E.queries()[name](spark, sf)
    rows = sorted(map(tuple, df.collect()), key=str)
    n = fx.table(spark, sf, "lineitem").count()
    files = [f for f in glob.glob(urlparse(landed[0]).path + "/*/*") if "/part-" in f]
    assert len(rows) == n and sum(map(os.path.getsize, files)) < 60 * n
    lines = [r.n for r in RW.read_lines(spark, landed[0]).groupBy("file").agg(F.sum(F.contains("line", F.lit("</nonDer")).cast("int")).alias("n")).collect()]
    assert sum(lines) >= n and max(lines) <= 61
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange (hash|range)partitioning", plan)
    monkeypatch.undo()
    assert rows == sorted(map(tuple, E.queries()[name](spark, sf).collect()), key=str)


def test_embedded_xml_equals_the_patterns(spark):
    import re
    rng = random.Random(8)
    bits = ["<?xml", "<ownershipDocument>", "</ownershipDocument>", "\n", "é", "?>", " a"]
    texts = ["".join(rng.choice(bits) for _ in range(rng.randrange(8))) for _ in range(300)] + [None]
    want = []
    for t in texts:
        found = t and (re.search(r"<\?xml.*?</ownershipDocument>", t, re.S) or re.search(r"<ownershipDocument>.*?</ownershipDocument>", t, re.S))
        want.append(found.group() if found else None)
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", nested.extract_xml("t").alias("x"))
    assert "regexp" not in df._jdf.queryExecution().executedPlan().toString()
    assert [r.x for r in df.orderBy("i").collect()] == want
