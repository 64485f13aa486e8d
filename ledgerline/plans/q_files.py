"""Registered queries over landed files that are read by several tasks: JSON documents with large arrays,
CSV records over several lines, files with their own headers, XML filings (S-04, S-06, S-12, S-13,
S-15, S-21, S-24, S-25, S-27, S-28).

Each query writes text files from a given table under the shared scratch folder (each file's lines in
order, one line an item) and reads them back with the library; the oracle is the DuckDB projection of the
table.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.plans import fixtures as fx
from ledgerline.plans.registry import duck_round, query
from ledgerline.sources import blocks as B
from ledgerline.sources import raw as RW
from ledgerline.sources.lake import scratch_path


def _s(c):
    return F.col(c).cast("string")


def land(spark, lines, name):
    """(file, pos, line) as text files, a folder of ordered parts each; ``pos`` is an array, compared in order."""
    path = scratch_path(spark, name)
    RW.land_lines(lines, path)
    return path


def framed(items, file, opening, closing):
    """Lines of one array a file between an opening and a closing line."""
    files = items.select(file.alias("file")).distinct()
    ends = files.select("file", F.inline(F.array(F.struct(F.array(F.lit(0).cast("long")).alias("pos"), F.lit(opening).alias("line")),
                                                 F.struct(F.array(F.lit(2).cast("long")).alias("pos"), F.lit(closing).alias("line")))))
    return items.select(file.alias("file"), "pos", "line").unionByName(ends)


def line_pos():
    """Order of a line item in its file."""
    return F.array(F.lit(1).cast("long"), F.col("l_orderkey").cast("long"), F.col("l_linenumber").cast("long"),
                   F.col("l_partkey").cast("long"), F.col("l_suppkey").cast("long"))


# ---- S-15, S-21, S-24, S-25: one document a file, arrays of any length ----------------------------

@query("s15_envelope_files", """
SELECT l_returnflag AS file, l_orderkey, l_linenumber AS line, l_quantity AS qty, l_extendedprice AS price,
  'a {' || l_returnflag || '} "quote" [' AS note FROM lineitem""")
def s15_files(spark, sf):
    """S-15: three documents, each an envelope around one array of all items of a flag."""
    li = fx.table(spark, sf, "lineitem").withColumn("file", F.col("l_returnflag"))
    item = F.to_json(F.struct("l_orderkey", F.col("l_linenumber").alias("line"), F.col("l_quantity").alias("qty"),
                              F.col("l_extendedprice").alias("price"),
                              F.concat(F.lit("a {"), "l_returnflag", F.lit('} "quote" [')).alias("note")))
    data = li.select("file", line_pos().alias("pos"), F.concat(F.lit(","), item).alias("line"))
    first = F.lit('{"status": {"code": 200, "tags": [[], "}"]}, "data": {"items": [{"skip": true}')
    lines = framed(data, F.col("file"), "", "]}, \"next\": null}")
    lines = lines.withColumn("line", F.when(F.col("pos") == F.array(F.lit(0).cast("long")), first).otherwise(F.col("line")))
    items = B.json_elements(spark, land(spark, lines, "envelope"), 3, names={"list": 3}).where("list = 'items'")
    parsed = items.select("file", F.from_json("text", "l_orderkey long, line int, qty double, price double, note string").alias("d"))
    return parsed.where("d.l_orderkey IS NOT NULL").select("file", "d.*")


@query("s21_results_files", """
SELECT l_orderkey AS round, 'race } ' || CAST(l_orderkey AS VARCHAR) AS race, l_linenumber AS position,
  'S' || CAST(l_suppkey AS VARCHAR) AS driver, l_quantity AS points FROM lineitem""")
def s21_files(spark, sf):
    """S-21: one document of all races (orders); a race's results are joined with its own fields, which
    stand before and after the nested list."""
    li = fx.table(spark, sf, "lineitem")
    file = F.lit("season")
    at = lambda k: F.array(F.lit(1).cast("long"), F.col("l_orderkey").cast("long"), *k)
    lit = lambda *v: [F.lit(x).cast("long") for x in v]
    races = li.select("l_orderkey").distinct()
    low = li.agg(F.min("l_orderkey")).scalar()
    comma = F.when(F.col("l_orderkey") > low, ",").otherwise("")
    heads = races.select(file.alias("file"), at(lit(0)).alias("pos"), F.concat(
        comma, F.lit('{"round": '), _s("l_orderkey"), F.lit(', "Results": [')).alias("line"))
    tails = races.select(file.alias("file"), at(lit(2)).alias("pos"), F.concat(
        F.lit('{"none": 1}], "name": "race } '), _s("l_orderkey"), F.lit('"}')).alias("line"))
    res = li.select(file.alias("file"), at([*lit(1), F.col("l_linenumber").cast("long"), F.col("l_suppkey").cast("long")]).alias("pos"),
                    F.concat(F.to_json(F.struct(F.col("l_linenumber").alias("position"), F.struct(F.concat(
                        F.lit("S"), _s("l_suppkey")).alias("code")).alias("Driver"), F.col("l_quantity").alias("points"))),
                        F.lit(",")).alias("line"))
    data = heads.unionByName(tails).unionByName(res)
    path = land(spark, framed(data, file, '{"MRData": {"Races": [', "]}}"), "results")
    race = B.json_elements(spark, path, 3, shallow=True).select(
        "file", F.col("at").alias("race_at"), F.from_json("text", "round long, name string").alias("r"))
    result = B.json_elements(spark, path, 5, parents={"race_at": 4}).select(
        "file", "race_at", F.from_json("text", "position int, Driver struct<code: string>, points double").alias("p"))
    return result.where("p.position IS NOT NULL").join(race, ["file", "race_at"]).select(
        "r.round", F.col("r.name").alias("race"), "p.position", F.col("p.Driver.code").alias("driver"), "p.points")


@query("s24_geojson_file", """
SELECT l_orderkey, l_quantity AS mag, l_extendedprice AS lon, l_discount AS lat, l_tax AS depth,
       l_linenumber % 2 <> 0 AS tsunami FROM lineitem""")
def s24_file(spark, sf):
    """S-24: one feature collection of all rows."""
    li = fx.table(spark, sf, "lineitem")
    feature = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.struct(F.col("l_orderkey").alias("id"), F.col("l_quantity").alias("mag"),
                 F.pmod("l_linenumber", F.lit(2)).alias("tsunami")).alias("properties"),
        F.struct(F.array("l_extendedprice", "l_discount", "l_tax").alias("coordinates")).alias("geometry")))
    data = li.select(line_pos().alias("pos"), F.concat(F.lit(","), feature).alias("line"))
    lines = framed(data, F.lit("quakes"), '{"type": "FeatureCollection", "features": [{"type": "None"}', "]}")
    f = B.json_elements(spark, land(spark, lines, "geojson"), 2).select(F.from_json(
        "text", "properties struct<id: long, mag: double, tsunami: int>, geometry struct<coordinates: array<double>>").alias("f"))
    c = F.col("f.geometry.coordinates")
    return f.where("f.properties.id IS NOT NULL").select(
        F.col("f.properties.id").alias("l_orderkey"), "f.properties.mag", c[0].alias("lon"), c[1].alias("lat"),
        c[2].alias("depth"), (F.coalesce("f.properties.tsunami", F.lit(0)) != 0).alias("tsunami"))


@query("s25_facts_files", """
WITH r AS (SELECT o_orderpriority AS company, o_orderkey, CAST(date_trunc('day', CAST(o_orderdate AS TIMESTAMP)) AS TIMESTAMP) AS date,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS v,
  CASE o_orderkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' ELSE '8-K' END AS form FROM orders WHERE o_orderkey % 5 <> 0)
SELECT company, date, m.metric, v * m.k AS value, form, m.unit
FROM r, (VALUES ('revenue', 1.0::DOUBLE, 'USD'), ('eps_basic', 0.5::DOUBLE, 'USD/shares')) m(metric, k, unit) WHERE form <> '8-K'""")
def s25_files(spark, sf):
    """S-25: a company-facts document for each order priority; taxonomy, concept and unit are keys above the
    list of entries. Another taxonomy, other concepts and form 8-K aren't kept; an entry without a date is
    left out, a value that is no number is NULL."""
    from ledgerline.sources.nested import GAAP_METRICS, REPORT_FORMS

    o = fx.table(spark, sf, "orders").withColumn("file", F.regexp_replace("o_orderpriority", "[^A-Za-z0-9-]+", "_"))
    m = F.pmod("o_orderkey", F.lit(3))
    groups = [("us-gaap", "Revenues", "USD", 1.0), ("us-gaap", "Ignored", "USD", 2.0),
              ("us-gaap", "EarningsPerShareBasic", "USD/shares", 0.5), ("ifrs-full", "Revenues", "USD", 3.0)]

    def lit(*v):
        return [F.lit(x).cast("long") for x in v]
    lines = None
    for g, (taxonomy, concept, unit, k) in enumerate(groups):
        value = F.when(F.pmod("o_orderkey", F.lit(7)) == 0, "n/a").otherwise((F.col("o_totalprice") * k).cast("string"))
        entry = F.to_json(F.struct(
            F.when(F.pmod("o_orderkey", F.lit(5)) == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("end"),
            value.alias("val"), F.when(m == 0, "10-K").when(m == 1, "10-Q").otherwise("8-K").alias("form")))
        rows = o.select("file", F.array(*lit(1, g, 1), F.col("o_orderkey").cast("long")).alias("pos"),
                        F.concat(F.lit(","), entry).alias("line"))
        opens = ("" if g == 0 else "," if groups[g - 1][0] == taxonomy else "},") + \
            (f'"{taxonomy}": {{' if g == 0 or groups[g - 1][0] != taxonomy else "") + \
            f'"{concept}": {{"label": "a }} b", "units": {{"{unit}": [{{"end": ""}}'
        ends = o.select("file").distinct().select("file", F.inline(F.array(
            F.struct(F.array(*lit(1, g, 0)).alias("pos"), F.lit(opens).alias("line")),
            F.struct(F.array(*lit(1, g, 2)).alias("pos"), F.lit("]}}").alias("line")))))
        rows = rows.unionByName(ends)
        lines = rows if lines is None else lines.unionByName(rows)
    path = land(spark, framed(lines, F.col("file"), '{"cik": 1, "facts": {', "}}}"), "facts")
    e = B.json_elements(spark, path, 6, names={"taxonomy": 3, "concept": 4, "unit": 6}) \
        .where(F.col("taxonomy").eqNullSafe("us-gaap") & F.col("concept").isin(*GAAP_METRICS))
    metric = F.element_at(F.create_map(*[F.lit(x) for kv in GAAP_METRICS.items() for x in kv]), F.col("concept"))
    d = e.select("file", metric.alias("metric"), "unit", F.from_json("text", "`end` string, val string, form string").alias("e"))
    names = o.select("file", F.col("o_orderpriority").alias("company")).distinct()
    return d.join(names, "file").where(F.col("e.form").isin(*REPORT_FORMS)).select(
        "company", F.col("e.end").try_cast("timestamp").alias("date"), "metric", F.col("e.val").try_cast("double").alias("value"),
        "e.form", "unit").where("date IS NOT NULL")


# ---- S-04, S-06, S-12, S-13: records over several lines, columns by the file's own header ------------

@query("s13_quoted_line_breaks", """
SELECT doc_id, lang, md5(text) AS text_md5, length(text) AS n FROM documents WHERE text IS NOT NULL""")
def s13_quoted(spark, sf):
    """S-13: texts as quoted CSV fields with separators, doubled quotes and line breaks inside."""
    d = fx.table(spark, sf, "documents").where("text IS NOT NULL")
    q = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    line = F.concat_ws(",", _s("doc_id"), q(F.coalesce("lang", F.lit("NA"))), q(F.col("text")), F.lit("end"))
    data = d.select(F.lit("texts").alias("file"), F.array(F.col("doc_id")).alias("pos"), line.alias("line"))
    rec = B.quoted_records(B.split_rows(spark, land(spark, data, "texts"), "\n"))
    f = rec.select(B.quoted_fields(F.col("line")).alias("f")).where(F.element_at("f", -1) == "end")
    return f.select(F.col("f")[0].try_cast("long").alias("doc_id"), F.nullif(F.col("f")[1], F.lit("NA")).alias("lang"),
                    F.md5(F.col("f")[2].cast("binary")).alias("text_md5"), F.length(F.col("f")[2]).cast("long").alias("n"))


def _header_files(spark, sf):
    """Customers in a file for each segment: other delimiters, columns in another order, a comment and a
    preamble before the header, a column that only some files have."""
    c = fx.table(spark, sf, "customer")
    semi = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    swap = F.col("c_mktsegment").isin("BUILDING", "FURNITURE")
    join = lambda *v: F.when(semi, F.concat_ws(";", *v)).otherwise(F.concat_ws(",", *v))
    name = F.concat(F.lit('"'), F.col("c_name"), F.when(F.pmod("c_custkey", F.lit(9)) == 0, F.lit('; "",\nJr')).otherwise(""), F.lit('"'))
    row = F.when(swap, join(_s("c_acctbal"), F.lit("x"), _s("c_custkey"), name)).otherwise(join(_s("c_custkey"), name, _s("c_acctbal")))
    head = F.when(swap, join(F.lit(" AcctBal"), F.lit("Flag"), F.lit("CustKey "), F.lit("Name"))) \
        .otherwise(join(F.lit("custkey"), F.lit("name"), F.lit("acctbal")))
    one = lambda p: F.array(F.lit(p).cast("long"))
    files = c.select("c_mktsegment").distinct()
    notes = files.select(F.col("c_mktsegment").alias("file"), one(0).alias("pos"), F.lit("# customers, by segment;").alias("line"))
    heads = files.select(F.col("c_mktsegment").alias("file"), one(1).alias("pos"), head.alias("line"))
    data = c.select(F.col("c_mktsegment").alias("file"), F.array(F.lit(2).cast("long"), F.col("c_custkey")).alias("pos"), row.alias("line"))
    return land(spark, notes.unionByName(heads).unionByName(data), "headers")


@query("s06_columns_by_header", """
SELECT c_mktsegment AS file, c_custkey, c_name || CASE WHEN c_custkey % 9 = 0 THEN '; ",' || chr(10) || 'Jr' ELSE '' END AS c_name,
  c_acctbal, CASE WHEN c_mktsegment IN ('BUILDING', 'FURNITURE') THEN 'x' END AS flag FROM customer""")
def s06_by_header(spark, sf):
    """S-04 / S-06: delimiter and columns from each file's header; quoted line breaks join lines."""
    rec = B.quoted_records(B.split_rows(spark, _header_files(spark, sf), "\n"))
    lines = RW.drop_comments(rec)
    d = RW.sniff_delimiter(lines)
    split = F.when(F.col("delim") == ";", B.quoted_fields(F.col("line"), ";")).otherwise(B.quoted_fields(F.col("line"), ","))
    header = lines.join(d, "file").where("pos = _hdr").select("file", "pos", split.alias("names"))
    out = B.columns_of(B.by_header(lines.join(d.select("file", "delim"), "file"), split, header),
                       ["custkey", "name", "acctbal", "flag"])
    return out.select("file", F.col("custkey").try_cast("long").alias("c_custkey"), F.col("name").alias("c_name"),
                      F.col("acctbal").try_cast("double").alias("c_acctbal"), "flag")


@query("s12_pipe_by_header", """
SELECT CAST(date_trunc('month', l_shipdate) AS TIMESTAMP) AS date, 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
  sum(l_quantity) AS short_volume, CAST(count(*) AS DOUBLE) AS total_volume FROM lineitem GROUP BY ALL""")
def s12_by_header(spark, sf):
    """S-12: a pipe file a month, with columns in another order in every other year; a blank date is in the
    file's name; blank and trailer rows are left out."""
    g = fx.table(spark, sf, "lineitem").groupBy(F.date_trunc("month", "l_shipdate").alias("day"), "l_suppkey").agg(
        F.sum("l_quantity").alias("q"), F.count("*").alias("n"))
    ymd, old = F.date_format("day", "yyyyMMdd"), F.pmod(F.year("day"), F.lit(2)) == 0
    file = F.concat(F.lit("CNMSshvol"), ymd).alias("file")
    date = F.when(F.pmod("l_suppkey", F.lit(4)) == 0, "").otherwise(ymd)
    symbol = F.concat(F.lit("S"), _s("l_suppkey"))
    line = F.when(old, F.concat_ws("|", symbol, _s("n"), date, F.lit("Q"), _s("q"))).otherwise(
        F.concat_ws("|", date, symbol, _s("q"), _s("n"), F.lit("Q")))
    long = lambda v: F.lit(v).cast("long")
    data = g.select(file, F.array(long(1), F.col("l_suppkey")).alias("pos"), line.alias("line"))
    head = F.when(old, "Symbol|TotalVolume|Date|Market|ShortVolume").otherwise("Date|Symbol|ShortVolume|TotalVolume|Market")
    ends = g.select("day").distinct().select(file, F.inline(F.array(
        F.struct(F.array(long(0)).alias("pos"), head.alias("line")), F.struct(F.array(long(2)).alias("pos"), F.lit("").alias("line")),
        F.struct(F.array(long(3)).alias("pos"), F.when(old, "Total records|0|all|Q|0").otherwise("all|0|0|0|").alias("line")))))
    lines = RW.read_landed(spark, land(spark, data.unionByName(ends), "pipes"))
    fields = F.split("line", r"\|")
    first = lines.groupBy("file").agg(F.min("pos").alias("pos"), F.min_by(fields, "pos").alias("names"))
    out = B.columns_of(B.by_header(lines, fields, first), ["date", "symbol", "shortvolume", "totalvolume"])
    own = F.try_to_date("date", "yyyyMMdd")
    out = out.where((F.coalesce("date", F.lit("")) == "") | own.isNotNull())
    named = F.try_to_date(F.regexp_extract("file", r"(\d{8})", 1), "yyyyMMdd")
    return out.select(F.coalesce(F.when(F.col("date") != "", own), named).cast("timestamp_ntz").alias("date"), "symbol",
                      F.col("shortvolume").try_cast("double").alias("short_volume"),
                      F.col("totalvolume").try_cast("double").alias("total_volume"))


# ---- S-27, S-28: XML filings ------------------------------------------------------------------------

#: Transactions in a compressed part of a filing, on average: what one task reads at once
FILING_PART = 250_000

FILINGS_SQL = """
SELECT strftime(o_orderdate, '%Y%m') AS month, 'T' || strftime(o_orderdate, '%Y%m') AS ticker, 'Issuer & Sons' AS issuer_name,
  'Owner ' || strftime(o_orderdate, '%Y%m') AS owner_name,
  CASE WHEN l_linenumber IN (3, 4) THEN strftime(o_orderdate, '%Y-%m-01') ELSE strftime(l_shipdate, '%Y-%m-%d') END AS transaction_date,
  l_quantity AS shares, CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS price_per_share,
  CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'A' END AS acquired_disposed,
  CASE WHEN l_linenumber <> 5 THEN round(l_quantity * l_extendedprice, 4) END AS transaction_value
FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""


def _filings(spark, sf, wrap):
    """A filing for each month of orders, as one file; its line items are the transactions. Files are compressed, in
    parts of about ``FILING_PART`` transactions; items are exchanged as they are and become XML in the task that writes them."""
    lineitem, orders = fx.table(spark, sf, "lineitem"), fx.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    name = F.concat(F.lit("form4-"), F.date_format("o_orderdate", "yyyyMM"), F.lit("01")).alias("file")
    month_no = (F.year("o_orderdate") * 12 + F.month("o_orderdate")).alias("month_no")
    filings = orders.select(name, month_no).distinct()
    n = max(1, filings.count())
    parts = max(1, -(-lineitem.count() // (n * FILING_PART)))
    data = lineitem.join(orders, F.col("o_orderkey") == F.col("l_orderkey")).select(
        name, month_no, F.lit(1).alias("kind"), F.pmod(F.xxhash64("l_orderkey", "l_linenumber"), F.lit(parts)).cast("int").alias("part"),
        "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")
    ends = filings.select("*", F.inline(F.array(F.struct(F.lit(0).alias("kind"), F.lit(0).alias("part")),
                                                F.struct(F.lit(2).alias("kind"), F.lit(parts - 1).alias("part")))))
    v = lambda t, x: F.concat(F.lit(f"<{t}><value>"), x, F.lit(f"</value></{t}>"))
    date = F.when(F.col("l_linenumber") == 3, "").when(F.col("l_linenumber") == 4, v("transactionDate", F.lit(" "))) \
        .otherwise(v("transactionDate", F.date_format("l_shipdate", "yyyy-MM-dd")))
    txn = F.concat(F.lit("<nonDerivativeTransaction>"), date, F.lit("\n<transactionAmounts>"),
                   v("transactionShares", _s("l_quantity")),
                   v("transactionPricePerShare", F.when(F.col("l_linenumber") == 5, "abc").otherwise(_s("l_extendedprice"))),
                   v("transactionAcquiredDisposedCode", F.when(F.col("l_returnflag") == "R", "D").otherwise("A")),
                   F.lit("</transactionAmounts></nonDerivativeTransaction>"))
    month = F.substring("file", 7, 6)
    head = F.concat(F.lit("<ownershipDocument><issuer><issuerTradingSymbol>T"), month, F.lit(
        "</issuerTradingSymbol><issuerName>Issuer &amp; Sons</issuerName></issuer><reportingOwner><reportingOwnerId><rptOwnerName>Owner "),
        month, F.lit("</rptOwnerName></reportingOwnerId></reportingOwner><reportingOwner><reportingOwnerId><rptOwnerName>Second"
                     "</rptOwnerName></reportingOwnerId></reportingOwner><nonDerivativeTable>"))
    before, after = F.lit('<?xml version="1.0"?>\n'), F.lit("")
    if wrap:
        odd = F.pmod(month.cast("int"), F.lit(2)) == 1
        before = F.when(odd, "<SEC-DOCUMENT>0001.txt\nfee < 3 & more\n<XML>\n<?xml version=\"1.0\"?>\n").otherwise("header text ")
        after = F.when(odd, "\n</XML>\n</SEC-DOCUMENT>").otherwise(" trailer text")
    line = F.when(F.col("kind") == 0, F.concat(before, head)).when(F.col("kind") == 1, txn) \
        .otherwise(F.concat(F.lit("</nonDerivativeTable></ownershipDocument>"), after))
    path = scratch_path(spark, "filings")
    # the parts of a file are partitions in a row (also where files share them), so they are numbered in its order
    place = F.pmod("month_no", F.lit(n)) * parts + F.col("part")
    (data.unionByName(ends, allowMissingColumns=True).repartitionById(n * parts, place)
         .sortWithinPartitions("file", "kind").select("file", line.alias("line"))
         .write.options(**{"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}, maxRecordsPerFile=2 * FILING_PART).partitionBy("file").text(path))
    rows = B.filing_transactions(spark, path, name_date=r"form4-(\d{8})")
    return rows.select(F.regexp_extract("file", r"form4-(\d{6})", 1).alias("month"), "ticker", "issuer_name", "owner_name",
                       "transaction_date", "shares", "price_per_share", "acquired_disposed",
                       duck_round("transaction_value", 4).alias("transaction_value"))


@query("s27_xml_filings", FILINGS_SQL)
def s27_files(spark, sf):
    """S-27 from XML files: transactions by their own tag, issuer and first owner joined by file."""
    return _filings(spark, sf, wrap=False)


@query("s28_wrapped_filings", FILINGS_SQL)
def s28_files(spark, sf):
    """S-28: the same inside text wrappers, with and without an XML declaration."""
    return _filings(spark, sf, wrap=True)


# ---- S-16..S-20, S-22, S-23, S-26: scalars and nested objects of one large document -----------------

def longs(*v):
    return F.array(*[(F.lit(x) if isinstance(x, int) else x).cast("long") for x in v])


def lines_at(df, file, *rows):
    """(file, pos, line) rows of (pos, line) pairs for each row of ``df``."""
    each = F.array(*[F.struct(p.alias("pos"), t.alias("line")) for p, t in rows])
    return df.select(F.lit(file).alias("file"), F.inline(each))


@query("s16_dynamic_keys_file", """
SELECT n_name AS country, CAST(year(o_orderdate) AS VARCHAR) AS year, round(sum(o_totalprice), 2) AS value
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2""")
def s16_file(spark, sf):
    """S-16: one document indicator -> country -> year -> value, read scalar by scalar with the names above it."""
    o = fx.table(spark, sf, "orders").join(fx.table(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey")) \
        .join(fx.table(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey"))
    v = o.groupBy("n_nationkey", "n_name", F.year("o_orderdate").alias("y")).agg(F.round(F.sum("o_totalprice"), 2).alias("v"))
    names = v.select("n_nationkey", "n_name").distinct()
    n = F.col("n_nationkey")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    head = lines_at(names, "imf", (longs(1, n, 0), F.concat(F.lit(","), quoted(F.col("n_name")), F.lit(': {"0": null'))),
                    (longs(1, n, 9999), F.lit("}")))
    data = lines_at(v, "imf", (longs(1, n, F.col("y")), F.concat(F.lit(", "), quoted(_s("y")), F.lit(": "), _s("v"))))
    lines = framed(head.unionByName(data), F.lit("imf"), '{"api": {"v": "1, {2}"}, "values": {"NGDP": {"none": {"0": null}', "}}}")
    e = B.json_leaves(spark, land(spark, lines, "dynamic"), 4, names={"top": 2, "indicator": 3, "country": 4})
    e = e.where("top = 'values' AND indicator = 'NGDP' AND value IS NOT NULL")
    return e.select("country", F.col("key").alias("year"), F.round(F.col("value").cast("double"), 2).alias("value"))


@query("s17_sdmx_file", """
SELECT o_orderstatus AS status, o_orderpriority AS priority, CAST(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1, 2""")
def s17_file(spark, sf):
    """S-17: observation keys i:j index the value lists of the dimensions, which stand in the same document."""
    o = fx.table(spark, sf, "orders")
    place = {"F": 0, "O": 1, "P": 2}
    pri = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
    dims = ('{"structure": {"dimensions": {"observation": [{"id": "STATUS", "values": [' + ",".join(f'{{"id": "{s}"}}' for s in place)
            + ']}, {"id": "PRIORITY", "values": [' + ",".join(f'{{"id": "{p}"}}' for p in pri) + ']}]}}, "observations": {"x": []')
    at = F.concat_ws(":", F.element_at(F.create_map(*[F.lit(x) for kv in place.items() for x in kv]), F.col("o_orderstatus")).cast("string"),
                     (F.array_position(F.array(*map(F.lit, pri)), F.col("o_orderpriority")) - 1).cast("string"))
    g = o.groupBy(at.alias("k")).agg(F.count("*").alias("n"))
    data = lines_at(g, "sdmx", (longs(1, F.xxhash64("k")), F.concat(F.lit(',"'), F.col("k"), F.lit('": ['), _s("n"), F.lit(", 0, null]"))))
    path = land(spark, framed(data, F.lit("sdmx"), dims, "}}"), "sdmx")
    obs = B.json_leaves(spark, path, 3, names={"top": 2, "k": 3}, places={"p": 3}).where("top = 'observations' AND p = 0")
    ids = B.json_leaves(spark, path, 7, places={"dim": 4, "val": 6}).where("key = 'id'").select(
        F.col("dim").alias("_d"), F.col("val").alias("_v"), F.col("value").alias("id"))
    parts = obs.select("k", F.col("value").cast("double").alias("value"), F.posexplode(F.split("k", ":")).alias("_d", "_i"))
    found = parts.join(ids, (parts["_d"] == ids["_d"]) & (parts["_i"].cast("long") == ids["_v"]))
    return found.groupBy("k").agg(F.max(F.when(parts["_d"] == 0, F.col("id"))).alias("status"),
                                  F.max(F.when(parts["_d"] == 1, F.col("id"))).alias("priority"), F.first("value").alias("value")).drop("k")


def _columns_file(spark, sf, arrays):
    """One document of parallel arrays over all orders, in the order of their keys -> (i, name...)."""
    o = fx.table(spark, sf, "orders")
    data = None
    for a, (name, text) in enumerate(arrays.items()):
        item = F.concat(F.lit(","), text)
        part = lines_at(o, "cols", (longs(1, a, 1, F.col("o_orderkey")), item))
        data = part if data is None else data.unionByName(part)
        ends = lines_at(o.select(F.lit(1)).limit(1), "cols",
                        (longs(1, a, 0), F.lit(("," if a else "") + f'"{name}": [null')), (longs(1, a, 2), F.lit("]")))
        data = data.unionByName(ends)
    path = land(spark, framed(data, F.lit("cols"), '{"chart": {', "}}"), "columns")
    e = B.json_leaves(spark, path, 3, names={"name": 3}, places={"i": 3}).where("i > 0")
    return e.groupBy("i").agg(*[F.max(F.when(F.col("name") == n, F.col("value"))).alias(n) for n in arrays])


@query("s18_columns_file", """
SELECT o_orderkey AS orderkey, strftime(o_orderdate, '%Y, %m') AS month, CASE WHEN o_orderkey % 4 <> 0 THEN o_totalprice END AS close FROM orders""")
def s18_file(spark, sf):
    """S-18: arrays of all rows, aligned by position; strings hold commas, values may be null."""
    rows = _columns_file(spark, sf, {
        "orderkey": _s("o_orderkey"), "month": F.concat(F.lit('"'), F.date_format("o_orderdate", "yyyy, MM"), F.lit('"')),
        "close": F.when(F.pmod("o_orderkey", F.lit(4)) == 0, "null").otherwise(_s("o_totalprice"))})
    return rows.select(F.col("orderkey").cast("long").alias("orderkey"), "month", F.col("close").cast("double").alias("close"))


@query("s26_parallel_arrays_file", """
SELECT 'A-' || CAST(o_orderkey AS VARCHAR) AS accession, strftime(o_orderdate, '%Y-%m-%d') AS filed FROM orders WHERE o_orderkey % 3 = 1""")
def s26_file(spark, sf):
    """S-26: parallel arrays of all filings, form '4' kept."""
    rows = _columns_file(spark, sf, {
        "form": F.when(F.pmod("o_orderkey", F.lit(3)) == 1, '"4"').otherwise('"10-K"'),
        "accession": F.concat(F.lit('"A-'), _s("o_orderkey"), F.lit('"')),
        "filed": F.concat(F.lit('"'), F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit('"'))})
    return rows.where("form = '4'").select("accession", "filed")


@query("s20_kline_file", "SELECT o_orderkey AS open_time, o_totalprice AS open, o_orderstatus AS flag FROM orders")
def s20_file(spark, sf):
    """S-20: one array of all candles, each an array of positions."""
    o = fx.table(spark, sf, "orders")
    data = lines_at(o, "klines", (longs(1, F.col("o_orderkey")), F.concat(F.lit(",["), _s("o_orderkey"), F.lit(',"'), _s("o_totalprice"), F.lit('","'), F.col("o_orderstatus"), F.lit('"]'))))
    e = B.json_leaves(spark, land(spark, framed(data, F.lit("klines"), "[[]", "]"), "klines"), 2, places={"row": 1, "col": 2})
    at = lambda k: F.max(F.when(F.col("col") == k, F.col("value")))
    return e.groupBy("row").agg(at(0).cast("long").alias("open_time"), at(1).cast("double").alias("open"), at(2).alias("flag")).drop("row")


@query("s19_items_file", "SELECT o_orderkey AS key, o_totalprice AS value FROM orders")
def s19_file(spark, sf):
    """S-19: items that are arrays or objects, in one array of all."""
    o = fx.table(spark, sf, "orders")
    item = F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.concat(F.lit(",["), _s("o_orderkey"), F.lit(","), _s("o_totalprice"), F.lit("]"))) \
        .otherwise(F.concat(F.lit(',{"totalFees": '), _s("o_totalprice"), F.lit(', "date": '), _s("o_orderkey"), F.lit("}")))
    data = lines_at(o, "items", (longs(1, F.col("o_orderkey")), item))
    e = B.json_leaves(spark, land(spark, framed(data, F.lit("items"), "[[]", "]"), "items"), 2, places={"row": 1, "col": 2})
    of = lambda name, k: F.max(F.when(F.coalesce(F.col("key") == name, F.col("col") == k), F.col("value")))
    return e.groupBy("row").agg(of("date", 0).cast("long").alias("k"), of("totalFees", 1).cast("double").alias("value")) \
        .select(F.col("k").alias("key"), "value")


@query("s22_roles_file", """
WITH g AS (SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F')
SELECT o_orderkey AS game, 'T' || CAST(o_custkey AS VARCHAR) AS home_team, 'A' || CAST(o_custkey AS VARCHAR) AS away_team, o_totalprice AS home_score FROM g""")
def s22_file(spark, sf):
    """S-22: one scoreboard of all games; the competitor marked home, or the first of a game that marks none."""
    from ledgerline.sources.nested import pick_by_role

    o = fx.table(spark, sf, "orders")
    side = lambda c, role, team, score: F.struct(role.alias("homeAway"), F.concat(F.lit(team), _s("o_custkey")).alias("team"), score.alias("score"))
    marked = F.pmod("o_orderkey", F.lit(5)) != 0
    home = side(o, F.when(marked, "home"), "T", F.col("o_totalprice"))
    away = side(o, F.when(marked, "away"), "A", F.lit(0.0))
    swap = marked & (F.pmod("o_orderkey", F.lit(2)) == 0)
    comp = F.when(swap, F.array(away, home)).otherwise(F.array(home, away))
    status = F.when(F.col("o_orderstatus") == "F", "STATUS_FINAL").otherwise("STATUS_SCHEDULED")
    item = F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.struct(status.alias("name")).alias("status"), comp.alias("competitors")))
    data = lines_at(o, "scores", (longs(1, F.col("o_orderkey")), F.concat(F.lit(","), item)))
    path = land(spark, framed(data, F.lit("scores"), '{"day": {"date": "d"}, "events": [{"id": null}', "]}"), "scores")
    kind = "id long, status struct<name: string>, competitors array<struct<homeAway: string, team: string, score: double>>"
    g = B.json_elements(spark, path, 2, names={"list": 2}).where("list = 'events'").select(F.from_json("text", kind).alias("g")).select("g.*")
    g = g.where("status.name = 'STATUS_FINAL'")
    h, a = pick_by_role("competitors", "homeAway", "home", 1), pick_by_role("competitors", "homeAway", "away", 2)
    return g.select(F.col("id").alias("game"), h["team"].alias("home_team"), a["team"].alias("away_team"), h["score"].alias("home_score"))


@query("s23_schedule_file", "SELECT CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS date, o_orderkey AS id, o_totalprice AS price FROM orders")
def s23_file(spark, sf):
    """S-23: weeks[].games[]: a day's games of any number are joined with the day's own fields."""
    o = fx.table(spark, sf, "orders").withColumn("day", F.unix_date(F.to_date("o_orderdate")).cast("long"))
    days = o.select("day", F.to_date("o_orderdate").alias("d")).distinct()
    head = lines_at(days, "weeks", (longs(1, F.col("day"), 0), F.concat(F.lit(',{"date": "'), F.date_format("d", "yyyy-MM-dd'T'HH:mm:ss"), F.lit('", "games": [{"id": null}'))),
                    (longs(1, F.col("day"), 2), F.lit("]}")))
    data = lines_at(o, "weeks", (longs(1, F.col("day"), 1, F.col("o_orderkey")), F.concat(F.lit(","), F.to_json(F.struct(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("price"))))))
    path = land(spark, framed(head.unionByName(data), F.lit("weeks"), '{"gameWeek": [{"date": null, "games": []}', "]}"), "weeks")
    weeks = B.json_elements(spark, path, 2, shallow=True).select("file", F.col("at").alias("week"), F.from_json("text", "date string").alias("w"))
    games = B.json_elements(spark, path, 4, parents={"week": 3}).select("file", "week", F.from_json("text", "id long, price double").alias("g"))
    return games.where("g.id IS NOT NULL").join(weeks, ["file", "week"]).select(
        F.to_timestamp_ntz("w.date").alias("date"), "g.id", "g.price")
