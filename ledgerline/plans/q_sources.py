"""Registered queries for the landed-file parsers (S-04..S-29).

There are no raw files among the given tables, so each query first renders
the raw shape from a given table with Spark: lines are written as text files
(S-04..S-14) and read back by the library's readers; JSON or XML text is made
per order (bounded by the lines of one order). Then it runs the library parser. The oracle is the DuckDB projection of the original
table, so a match means render + parse round-trips every row.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.sources import nested as NS
from ledgerline.sources import raw as RW
from ledgerline.sources.lake import scratch_path
from ledgerline.plans import fixtures as fx
from ledgerline.plans import sequence as sq
from ledgerline.plans.registry import duck_round, query, rounded

def T(spark, sf, name):
    return fx.table(spark, sf, name)


def _s(c):
    return F.col(c).cast("string")


def lines_of(df, file, pos, line):
    return df.select(file.alias("file"), pos.cast("long").alias("pos"), line.alias("line"))


def fixed_lines(files, rows):
    """Per file, constant lines at given positions: rows = [(pos, text), ...]."""
    arr = F.array(*[F.struct(F.lit(p).cast("long").alias("pos"), F.lit(t).alias("line")) for p, t in rows])
    return files.select("file", F.inline(arr))


def with_fixed_lines(data, head, tail):
    """``data`` lines with constant lines in every file: ``head`` = [(pos, text), ...], and
    ``tail`` = [text, ...] right after the file's last data line."""
    files = data.groupBy("file").agg(F.max("pos").alias("_last"))
    at = [(F.lit(p).cast("long"), t) for p, t in head]
    at += [((F.col("_last") + 1 + i).cast("long"), t) for i, t in enumerate(tail)]
    arr = F.array(*[F.struct(p.alias("pos"), F.lit(t).alias("line")) for p, t in at])
    return data.unionByName(files.select("file", F.inline(arr)))


def landed(spark, lines, name):
    """``lines`` as they come back from text files."""
    path = scratch_path(spark, name)
    RW.land_lines(lines, path)
    return RW.read_landed(spark, path)


LINE_COLS = ["l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
             "l_returnflag", "l_shipdate"]


def order_lines(spark, sf):
    """One document per order, lines sorted by their full content. As with any
    nested file, a document (here the lines of one order) has to fit in a row."""
    key = F.struct(*LINE_COLS)
    return T(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.sort_array(F.collect_list(key)).alias("lines"))


# ---- S-04..S-14 line formats --------------------------------------------------------

@query("s04_preamble_csv", """
SELECT o_orderpriority AS file, strftime(o_orderdate, '%Y%m%d') AS date, o_totalprice AS total, o_orderstatus AS status
FROM orders""")
def s04(spark, sf):
    o = T(spark, sf, "orders")
    data = lines_of(o, F.col("o_orderpriority"), F.col("o_orderkey") + 1,
                    F.concat_ws(",", F.date_format("o_orderdate", "yyyyMMdd"), _s("o_totalprice"), "o_orderstatus"))
    lines = with_fixed_lines(data, [(-3, "This file was created by the desk"), (-2, "Units: USD"), (-1, ""),
                                    (0, ",total,status")], ["", " Annual totals", ",total,status", "1995,1.0,F"])
    parsed = RW.csv_after_header(landed(spark, lines, "preamble"), F.col("line").startswith(","), ["date", "total", "status"])
    return parsed.select("file", "date", F.col("total").try_cast("double").alias("total"), "status")


@query("s05_comment_lines", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, CAST(p_size AS VARCHAR) AS p_size FROM part")
def s05(spark, sf):
    p = T(spark, sf, "part")
    data = lines_of(p, F.lit("part.csv"), F.col("p_partkey") * 2, F.concat_ws(",", _s("p_partkey"), "p_name", _s("p_size")))
    notes = lines_of(p.filter(F.col("p_size") > 40), F.lit("part.csv"), F.col("p_partkey") * 2 + 1,
                     F.concat(F.lit("# large part, "), _s("p_partkey")))
    path = scratch_path(spark, "comments")
    RW.land_lines(data.unionByName(notes), path)
    return RW.read_delimited(spark, path, ["p_partkey", "p_name", "p_size"], comment="#")


@query("s06_sniff_delimiter", "SELECT c_mktsegment AS file, c_custkey, c_name, c_acctbal FROM customer")
def s06(spark, sf):
    c = T(spark, sf, "customer")
    semi = F.col("c_mktsegment").isin("BUILDING", "MACHINERY")
    data = lines_of(c, F.col("c_mktsegment"), F.col("c_custkey") + 1,
                    F.when(semi, F.concat_ws(";", _s("c_custkey"), "c_name", _s("c_acctbal")))
                     .otherwise(F.concat_ws(",", _s("c_custkey"), "c_name", _s("c_acctbal"))))
    files = c.select(F.col("c_mktsegment").alias("file")).distinct()
    notes = files.select("file", F.lit(-1).cast("long").alias("pos"), F.lit("# customers; by segment, ;;;").alias("line"))
    hdr = files.select("file", F.lit(0).cast("long").alias("pos"),
                       F.when(F.col("file").isin("BUILDING", "MACHINERY"), F.lit("custkey;name;acctbal"))
                        .otherwise(F.lit("custkey,name,acctbal")).alias("line"))
    lines = RW.drop_comments(landed(spark, data.unionByName(hdr).unionByName(notes), "delimiters"))
    out = RW.split_by_file_delimiter(lines, ["c_custkey", "c_name", "c_acctbal"])
    return out.select("file", F.col("c_custkey").cast("long").alias("c_custkey"), "c_name",
                      F.col("c_acctbal").try_cast("double").alias("c_acctbal"))


@query("s07_series_csv", """
WITH d AS (SELECT event_type, date_trunc('day', ts) AS ts, max(value) AS mx, avg(value) AS mean FROM events GROUP BY 1, 2)
SELECT event_type AS series_id, ts, CASE WHEN mx > 300 THEN NULL ELSE round(mean, 6) END AS value FROM d""")
def s07(spark, sf):
    """S-07: one series file per event type; days whose max exceeds 300 are
    published as '.' (missing)."""
    ev = T(spark, sf, "events")
    d = ev.groupBy("event_type", F.date_trunc("day", "ts").alias("day")).agg(F.max("value").alias("mx"),
                                                                              F.avg("value").alias("mean"))
    file = F.concat(F.lit("/lake/fred/"), F.col("event_type"), F.lit(".csv"))
    val = F.when(F.col("mx") > 300, F.lit(".")).otherwise(_s("mean"))
    data = lines_of(d, file, F.unix_timestamp(F.col("day").cast("timestamp")),
                    F.concat_ws(",", F.date_format("day", "yyyy-MM-dd"), val))
    hdr = d.select(file.alias("file")).distinct().select("file", F.lit(0).cast("long").alias("pos"),
                                                          F.lit("observation_date,VALUE").alias("line"))
    out = RW.series_csv(landed(spark, data.unionByName(hdr), "series"))
    return rounded(out.withColumn("ts", F.col("ts").cast("timestamp_ntz")))


FW_SQL = """WITH r AS (SELECT o_orderkey, CAST(year(o_orderdate) AS VARCHAR) AS y,
   CASE o_orderkey % 3 WHEN 0 THEN '4' WHEN 1 THEN '4/A' ELSE '10-K' END AS form, c_name AS company,
   CAST(o_custkey AS VARCHAR) AS cik, strftime(o_orderdate, '%Y-%m-%d') AS date_filed,
   'edgar/data/' || CAST(o_custkey AS VARCHAR) || '/' || CAST(o_orderkey AS VARCHAR) || '.txt' AS filename
   FROM orders JOIN customer ON c_custkey = o_custkey)"""


def _filings(spark, sf):
    o = T(spark, sf, "orders").join(T(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    m = F.pmod("o_orderkey", F.lit(3))
    return o.select("o_orderkey", F.year("o_orderdate").cast("string").alias("y"),
                    F.when(m == 0, "4").when(m == 1, "4/A").otherwise("10-K").alias("form"),
                    F.col("c_name").alias("company"), _s("o_custkey").alias("cik"),
                    F.date_format("o_orderdate", "yyyy-MM-dd").alias("date_filed"),
                    F.concat(F.lit("edgar/data/"), _s("o_custkey"), F.lit("/"), _s("o_orderkey"), F.lit(".txt"))
                    .alias("filename"))


@query("s08_fixed_width", FW_SQL + " SELECT form, company, cik, date_filed, filename FROM r WHERE form IN ('4', '4/A')")
def s08(spark, sf):
    f = _filings(spark, sf)
    file = F.concat(F.lit("form."), F.col("y"), F.lit(".idx"))
    line = F.concat(F.rpad("form", 12, " "), F.rpad("company", 62, " "), F.rpad("cik", 12, " "),
                    F.rpad("date_filed", 12, " "), F.col("filename"))
    data = lines_of(f, file, F.col("o_orderkey"), line)
    files = f.select(file.alias("file")).distinct()
    fixed = fixed_lines(files, [(-3, "Description:           Master Index of EDGAR Dissemination Feed"),
                                (-2, "Form Type   Company Name   CIK   Date Filed   File Name"), (-1, "-" * 120)])
    out = RW.fixed_width(landed(spark, data.unionByName(fixed), "fixed-width"))
    return out.select("form", "company", "cik", "date_filed", "filename")


@query("s09_multi_space_capped", FW_SQL + """
SELECT form, company, cik, date_filed, filename FROM r
WHERE form = '4' AND date_filed BETWEEN '1996-01-01' AND '1997-12-31'
ORDER BY date_filed, 'form.' || y || '.idx', o_orderkey LIMIT 50""")
def s09(spark, sf):
    f = _filings(spark, sf)
    file = F.concat(F.lit("form."), F.col("y"), F.lit(".idx"))
    line = F.concat_ws("  ", "form", "company", "cik", "date_filed", "filename")
    data = lines_of(f, file, F.col("o_orderkey"), line)
    out = RW.multi_space(landed(spark, data, "multi-space"), ["form", "company", "cik", "date_filed", "filename"], form="4",
                         start="1996-01-01", end="1997-12-31", cap=50)
    return out.select("form", "company", "cik", "date_filed", "filename")


@query("s10_coded_monthly", """
WITH d AS (SELECT c_nationkey, year(o_orderdate) AS year, month(o_orderdate) AS month, sum(o_totalprice) AS v
           FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3),
ny AS (SELECT DISTINCT c_nationkey, year FROM d),
m AS (SELECT * FROM ny, range(1, 13) t(month))
SELECT lpad(CAST(m.c_nationkey AS VARCHAR), 3, '0') AS division, CAST(m.year AS INTEGER) AS year, CAST(m.month AS INTEGER) AS month,
       CAST(make_date(m.year, CAST(m.month AS INTEGER), 1) AS TIMESTAMP) AS date, round(d.v, 2) AS value
FROM m LEFT JOIN d USING (c_nationkey, year, month)""")
def s10(spark, sf):
    """S-10: a line per (division, year) with 12 monthly values; -99.99 = missing."""
    oc = T(spark, sf, "orders").join(T(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    wide = (oc.withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate"))
              .groupBy("c_nationkey", "year").pivot("month", list(range(1, 13))).agg(F.sum("o_totalprice")))
    vals = [F.coalesce(_s(str(m)), F.lit("-99.99")) for m in range(1, 13)]
    code = F.concat(F.lpad(_s("c_nationkey"), 3, "0"), F.lit("02"), _s("year"))
    data = lines_of(wide, F.lit("climdiv"), F.col("c_nationkey") * 10000 + F.col("year"),
                    F.concat_ws(" ", code, *vals))
    out = RW.coded_monthly(landed(spark, data, "monthly"))
    return rounded(out.withColumn("date", F.col("date").cast("timestamp_ntz")), digits=2)


@query("s11_whitespace_negative_missing", """
SELECT CAST(year(ts) AS DOUBLE) AS year, CAST(month(ts) AS DOUBLE) AS month, CAST(day(ts) AS DOUBLE) AS day,
  CASE WHEN count(*) - 340 >= 0 THEN CAST(count(*) - 340 AS DOUBLE) END AS sn
FROM events GROUP BY date_trunc('day', ts), year(ts), month(ts), day(ts)""")
def s11(spark, sf):
    """S-11: 'year month day value' lines; negative values are missing."""
    ev = T(spark, sf, "events")
    d = ev.groupBy(F.date_trunc("day", "ts").alias("day")).agg((F.count(F.lit(1)) - 340).alias("sn"))
    line = F.concat_ws("   ", F.year("day").cast("string"), F.lpad(F.month("day").cast("string"), 2, " "),
                       F.lpad(F.dayofmonth("day").cast("string"), 2, " "), _s("sn"))
    data = lines_of(d, F.lit("sunspots"), F.unix_timestamp(F.col("day").cast("timestamp")), line)
    return RW.whitespace_table(landed(spark, data, "whitespace"), ["year", "month", "day", "sn"], negative_missing=["sn"])


def _pipe_sql(day: str) -> str:
    return f"""
WITH g AS (SELECT {day} AS day, l_suppkey, sum(l_quantity) AS short_volume, count(*) AS total_volume FROM lineitem GROUP BY 1, 2)
SELECT CAST(CAST(day AS DATE) AS TIMESTAMP) AS date, 'S' || CAST(l_suppkey AS VARCHAR) AS symbol,
       short_volume, CAST(total_volume AS DOUBLE) AS total_volume FROM g"""


def _pipe_lines(spark, sf, day):
    """A pipe file per ``day``; some rows leave the date blank (it is in the file
    name); a trailer row and a blank row end each file."""
    li = T(spark, sf, "lineitem")
    g = li.groupBy(day.alias("day"), "l_suppkey").agg(F.sum("l_quantity").alias("q"), F.count(F.lit(1)).alias("n"))
    ymd = F.date_format("day", "yyyyMMdd")
    file = F.concat(F.lit("CNMSshvol"), ymd, F.lit(".txt"))
    date_field = F.when(F.pmod("l_suppkey", F.lit(4)) == 0, F.lit("")).otherwise(ymd)
    data = lines_of(g, file, F.col("l_suppkey") + 1,
                    F.concat_ws("|", date_field, F.concat(F.lit("S"), _s("l_suppkey")), _s("q"), _s("n"), F.lit("Q")))
    return with_fixed_lines(data, [(0, "Date|Symbol|ShortVolume|TotalVolume|Market")], ["", "Total records|0|0|0|"])


def _pipe_rows(lines):
    out = RW.pipe_file(lines, ["date", "symbol", "short_volume", "total_volume", "market"])
    return out.select(F.col("date").cast("timestamp_ntz").alias("date"), "symbol",
                      F.col("short_volume").try_cast("double").alias("short_volume"),
                      F.col("total_volume").try_cast("double").alias("total_volume"))


@query("s12_pipe_file", _pipe_sql("l_shipdate"))
def s12(spark, sf):
    """S-12: daily files, as rendered lines (thousands of tiny files otherwise)."""
    return _pipe_rows(_pipe_lines(spark, sf, F.col("l_shipdate")))


@query("s12_pipe_files_landed", _pipe_sql("date_trunc('month', l_shipdate)"))
def s12_landed(spark, sf):
    """S-12 from text files, one a month."""
    return _pipe_rows(landed(spark, _pipe_lines(spark, sf, F.date_trunc("month", "l_shipdate")), "pipe"))


@query("s13_positional_csv", """
SELECT CAST(l_orderkey AS VARCHAR) AS orderkey, CAST(l_suppkey AS VARCHAR) AS suppkey, CAST(l_quantity AS VARCHAR) AS qty
FROM lineitem WHERE l_linenumber <> 7""")
def s13(spark, sf):
    """S-13: headerless quoted CSV; line 7 of an order is a short (3-field) row."""
    li = T(spark, sf, "lineitem")
    q = [F.concat(F.lit('"'), _s(c), F.lit('"')) for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
                                                          "l_quantity")]
    line = F.when(F.col("l_linenumber") == 7, F.concat_ws(",", *q[:3])).otherwise(F.concat_ws(",", *q))
    data = lines_of(li, F.lit("gamelogs.txt"), F.col("l_orderkey") * 10 + F.col("l_linenumber"), line)
    return RW.positional_csv(landed(spark, data, "positional"), {0: "orderkey", 2: "suppkey", 4: "qty"}, min_fields=5)


@query("s14_tab_events", """
SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS date, event_type AS country,
  ['ECON_' || upper(event_type), 'USER_' || CAST(user_id AS VARCHAR)] AS themes, value AS avg_tone
FROM events WHERE event_id % 7 <> 0""")
def s14(spark, sf):
    """S-14: tab-separated event rows (16 fields); every 7th row is truncated
    (short rows are dropped by the parser)."""
    ev = T(spark, sf, "events")
    e = F.lit("")
    themes = F.concat(F.lit("ECON_"), F.upper("event_type"), F.lit(";USER_"), _s("user_id"), F.lit(";"))
    tone = F.concat(_s("value"), F.lit(",1.5,0"))
    fields = [_s("event_id"), F.date_format("ts", "yyyyMMddHHmmss"), e, F.col("event_type"), e, e, e, themes,
              e, e, e, e, e, e, e, tone]
    line = F.when(F.pmod("event_id", F.lit(7)) == 0, F.concat_ws("\t", *fields[:8])).otherwise(F.concat_ws("\t", *fields))
    data = lines_of(ev, F.lit("gkg.csv"), F.col("event_id"), line)
    out = RW.tab_events(landed(spark, data, "tab-events"))
    return out.withColumn("date", F.col("date").cast("timestamp_ntz"))


# ---- S-15..S-29 nested documents per order ------------------------------------------

LINE_ROWS_SQL = "SELECT l_orderkey, l_linenumber AS line, l_quantity AS qty, l_extendedprice AS price FROM lineitem"


@query("s15_envelope_flatten", LINE_ROWS_SQL)
def s15(spark, sf):
    ol = order_lines(spark, sf)
    items = F.transform("lines", lambda x: F.struct(x["l_linenumber"].alias("line"), x["l_quantity"].alias("qty"),
                                                    x["l_extendedprice"].alias("price")))
    docs = ol.select("l_orderkey", F.to_json(F.struct(F.struct(items.alias("items")).alias("data"))).alias("doc"))
    return NS.flatten_envelope(docs, "doc", "struct<data: struct<items: array<struct<line: int, qty: double, "
                                            "price: double>>>>", "data.items", keep=["l_orderkey"])


NY_SQL = """SELECT n_name, CAST(year(o_orderdate) AS VARCHAR) AS year, round(sum(o_totalprice), 2) AS value
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2"""


def _nation_year(spark, sf):
    oc = (T(spark, sf, "orders").join(T(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
          .join(T(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")))
    return oc.groupBy("n_name", F.year("o_orderdate").cast("string").alias("year")).agg(F.sum("o_totalprice").alias("v"))


@query("s16_dynamic_key_json", "SELECT 'REV' AS indicator, n_name AS country, year, value FROM (" + NY_SQL + ")")
def s16(spark, sf):
    ny = _nation_year(spark, sf)
    per = ny.groupBy("n_name").agg(F.map_from_entries(F.collect_list(F.struct("year", "v"))).alias("m"))
    docs = per.select(F.to_json(F.struct(F.create_map(F.lit("REV"), F.create_map("n_name", "m")).alias("values")))
                      .alias("doc"))
    return rounded(NS.nested_map_rows(docs, "doc"), digits=2)


@query("s17_sdmx_json", """
SELECT n_name, o_orderpriority AS dim_0, CAST(year(o_orderdate) AS VARCHAR) AS dim_1, round(sum(o_totalprice), 2) AS value
FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey GROUP BY 1, 2, 3""")
def s17(spark, sf):
    """S-17: per nation an SDMX-JSON document: dimensions (priority, year) and
    observations keyed 'i:j' by dimension index; the dimensions list every value
    the table has (a scalar subquery, one value per dimension member)."""
    oc = (T(spark, sf, "orders").join(T(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
          .join(T(spark, sf, "nation"), F.col("n_nationkey") == F.col("c_nationkey")))
    year = F.year("o_orderdate").cast("string")
    orders = T(spark, sf, "orders")
    pris = orders.agg(F.sort_array(F.collect_set("o_orderpriority"))).scalar()
    years = orders.agg(F.sort_array(F.collect_set(year))).scalar()
    def members(c):
        return orders.agg(F.transform(F.sort_array(F.collect_set(c)), lambda v: F.struct(v.alias("id")))).scalar()

    pri_idx = F.array_position(pris, F.col("o_orderpriority")) - 1
    yr_idx = F.array_position(years, year) - 1
    g = oc.groupBy("n_name", F.concat_ws(":", pri_idx.cast("string"), yr_idx.cast("string")).alias("k")) \
        .agg(F.array(F.sum("o_totalprice")).alias("v"))
    obs = g.groupBy("n_name").agg(F.map_from_entries(F.collect_list(F.struct("k", "v"))).alias("observations"))
    dims = F.array(F.struct(F.lit("PRIORITY").alias("id"), members("o_orderpriority")
                            .alias("values")),
                   F.struct(F.lit("YEAR").alias("id"), members(year)
                            .alias("values")))
    docs = obs.select("n_name", F.to_json(F.struct(F.struct(F.struct(dims.alias("observation")).alias("dimensions"))
                                                   .alias("structure"), "observations")).alias("doc"))
    out = NS.sdmx_observations(docs, "doc", keep=["n_name"], n_dims=2)
    return rounded(out.drop("dimensions"), digits=2)


@query("s18_columns_to_rows", LINE_ROWS_SQL)
def s18(spark, sf):
    ol = order_lines(spark, sf)
    doc = F.to_json(F.struct(F.transform("lines", lambda x: x["l_linenumber"]).alias("line"),
                             F.transform("lines", lambda x: x["l_quantity"]).alias("qty"),
                             F.transform("lines", lambda x: x["l_extendedprice"]).alias("price")))
    docs = ol.select("l_orderkey", doc.alias("doc"))
    return NS.columns_to_rows(docs, "doc", {"line": "int", "qty": "double", "price": "double"}, keep=["l_orderkey"])


@query("s19_variant_items", "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS key, l_quantity AS value FROM lineitem")
def s19(spark, sf):
    """S-19: items are [line, qty] on even lines and {date: line, totalFees: qty} on odd ones."""
    ol = order_lines(spark, sf)
    item = F.transform("lines", lambda x: F.when(F.pmod(x["l_linenumber"], F.lit(2)) == 0,
                                                 F.concat(F.lit("["), x["l_linenumber"].cast("string"), F.lit(","),
                                                          x["l_quantity"].cast("string"), F.lit("]")))
                       .otherwise(F.concat(F.lit('{"date":'), x["l_linenumber"].cast("string"), F.lit(',"totalFees":'),
                                           x["l_quantity"].cast("string"), F.lit("}"))))
    docs = ol.select("l_orderkey", F.concat(F.lit("["), F.array_join(item, ","), F.lit("]")).alias("doc"))
    return NS.heterogeneous_items(docs, "doc", keep=["l_orderkey"])


@query("s20_kline_arrays", """
SELECT l_orderkey, l_linenumber AS line, l_quantity AS qty, l_extendedprice AS price, l_returnflag AS flag FROM lineitem""")
def s20(spark, sf):
    ol = order_lines(spark, sf)
    rows = F.transform("lines", lambda x: F.array(x["l_linenumber"].cast("string"), x["l_quantity"].cast("string"),
                                                  x["l_extendedprice"].cast("string"), x["l_returnflag"]))
    docs = ol.select("l_orderkey", F.to_json(rows).alias("doc"))
    return NS.positional_arrays(docs, "doc", ["line", "qty", "price", "flag"], ["int", "double", "double", "string"],
                                keep=["l_orderkey"])


@query("s21_nested_results", """
SELECT l_orderkey AS round, l_linenumber AS position, 'S' || CAST(l_suppkey AS VARCHAR) AS driver, l_quantity AS points,
  'S' || CAST(l_suppkey AS VARCHAR) || ' ' || CAST(l_linenumber AS VARCHAR) AS label FROM lineitem""")
def s21(spark, sf):
    ol = order_lines(spark, sf)
    res = F.transform("lines", lambda x: F.struct(x["l_linenumber"].alias("position"),
                                                  F.struct(F.concat(F.lit("S"), x["l_suppkey"].cast("string"))
                                                           .alias("code")).alias("Driver"),
                                                  x["l_quantity"].alias("points")))
    docs = ol.select(F.to_json(F.struct(F.col("l_orderkey").alias("round"), res.alias("Results"))).alias("doc"))
    schema = "struct<round: long, Results: array<struct<position: int, Driver: struct<code: string>, points: double>>>"
    out = NS.explode_path(docs, "doc", schema, "Results", {"round": "_d.round", "position": "position",
                                                            "driver": "Driver.code", "points": "points"})
    return out.withColumn("label", F.concat_ws(" ", "driver", F.col("position").cast("string")))


@query("s22_pick_by_role", """
WITH l AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_quantity, l_partkey, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate FROM lineitem),
p AS (SELECT l_orderkey, list({'role': CASE WHEN l_linenumber = 1 THEN 'home' ELSE 'away' END, 'team': l_suppkey, 'score': l_quantity}
        ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate) AS c
      FROM l GROUP BY 1),
k AS (SELECT l_orderkey, coalesce([x for x in c if x.role = 'home'][1], c[1]) AS h, coalesce([x for x in c if x.role = 'away'][1], c[2]) AS a FROM p),
h AS (SELECT l_orderkey, h.team AS home_team, h.score AS home_score, a.team AS away_team, a.score AS away_score FROM k)
SELECT h.l_orderkey, home_team, away_team, home_score, away_score FROM h JOIN orders ON o_orderkey = h.l_orderkey
WHERE o_orderstatus = 'F' AND away_team IS NOT NULL AND home_team IS NOT NULL""")
def s22(spark, sf):
    """S-22: per game (order) pick the competitor marked 'home' (line 1) and the
    first one marked 'away'; keep games whose status is final."""
    ol = order_lines(spark, sf).join(T(spark, sf, "orders").select("o_orderkey", "o_orderstatus"),
                                     F.col("o_orderkey") == F.col("l_orderkey"))
    comp = F.transform("lines", lambda x: F.struct(F.when(x["l_linenumber"] == 1, F.lit("home")).otherwise(F.lit("away"))
                                                   .alias("homeAway"), x["l_suppkey"].alias("team"),
                                                   x["l_quantity"].alias("score")))
    g = ol.select("l_orderkey", comp.alias("competitors"),
                  F.when(F.col("o_orderstatus") == "F", "STATUS_FINAL").otherwise("STATUS_SCHEDULED").alias("status"))
    g = g.filter(F.col("status") == "STATUS_FINAL")
    home = NS.pick_by_role("competitors", "homeAway", "home", 1)
    away = NS.pick_by_role("competitors", "homeAway", "away", 2)
    out = g.select("l_orderkey", home.alias("h"), away.alias("a")).filter(F.col("h").isNotNull() & F.col("a").isNotNull())
    return out.select("l_orderkey", F.col("h.team").alias("home_team"), F.col("a.team").alias("away_team"),
                      F.col("h.score").alias("home_score"), F.col("a.score").alias("away_score"))


@query("s23_double_nested", "SELECT l_orderkey, l_shipdate AS date, l_linenumber AS id, l_quantity AS qty FROM lineitem")
def s23(spark, sf):
    li = T(spark, sf, "lineitem")
    per_day = li.groupBy("l_orderkey", "l_shipdate").agg(F.sort_array(F.collect_list(
        F.struct(F.col("l_linenumber").alias("id"), F.col("l_quantity").alias("qty")))).alias("games"))
    weeks = per_day.groupBy("l_orderkey").agg(F.collect_list(F.struct(
        F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss").alias("date"), "games")).alias("gameWeek"))
    docs = weeks.select("l_orderkey", F.to_json(F.struct("gameWeek")).alias("doc"))
    schema = "struct<gameWeek: array<struct<date: string, games: array<struct<id: int, qty: double>>>>>"
    out = NS.double_explode(docs, "doc", schema, "gameWeek", "games", keep=["l_orderkey"])
    return out.select("l_orderkey", F.to_timestamp_ntz(F.col("_o.date")).alias("date"), F.col("_g.id").alias("id"),
                      F.col("_g.qty").alias("qty"))


@query("s24_geojson", """
SELECT l_orderkey, l_quantity AS mag, l_extendedprice AS lon, l_discount AS lat, l_tax AS depth,
       l_linenumber % 2 <> 0 AS tsunami FROM lineitem""")
def s24(spark, sf):
    ol = order_lines(spark, sf)
    feats = F.transform("lines", lambda x: F.struct(
        F.struct(x["l_quantity"].alias("mag"), F.pmod(x["l_linenumber"], F.lit(2)).alias("tsunami")).alias("properties"),
        F.struct(F.array(x["l_extendedprice"], x["l_discount"], x["l_tax"]).alias("coordinates")).alias("geometry")))
    docs = ol.select("l_orderkey", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), feats.alias("features")))
                     .alias("doc"))
    schema = ("struct<features: array<struct<properties: struct<mag: double, tsunami: int>, "
              "geometry: struct<coordinates: array<double>>>>>")
    out = NS.explode_path(docs, "doc", schema, "features", {"mag": "properties.mag", "tsunami": "properties.tsunami",
                                                             "coords": "geometry.coordinates"}, keep=["l_orderkey"])
    return out.select("l_orderkey", "mag", F.col("coords")[0].alias("lon"), F.col("coords")[1].alias("lat"),
                      F.col("coords")[2].alias("depth"), (F.coalesce(F.col("tsunami"), F.lit(0)) != 0).alias("tsunami"))


@query("s25_xbrl_facts", """
WITH r AS (SELECT o_orderkey, date_trunc('day', CAST(o_orderdate AS TIMESTAMP)) AS date, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS v,
  CASE o_orderkey % 3 WHEN 0 THEN '10-K' WHEN 1 THEN '10-Q' ELSE '8-K' END AS form,
  CASE o_orderkey % 3 WHEN 0 THEN 'FY' ELSE 'Q' || CAST(quarter(o_orderdate) AS VARCHAR) END AS period FROM orders
  WHERE o_orderkey % 5 <> 0)
SELECT o_orderkey, date, m.metric, v * m.k AS value, form, period, 'USD' AS unit
FROM r, (VALUES ('revenue', 1.0::DOUBLE), ('net_income', 0.5::DOUBLE)) m(metric, k) WHERE form <> '8-K'""")
def s25(spark, sf):
    """S-25: per order a company-facts document with two wanted concepts and an
    ignored one, the first also under another taxonomy (not kept), forms 10-K /
    10-Q / 8-K (8-K is not kept), blank dates (left out) and values that are no
    number (NULL)."""
    o = T(spark, sf, "orders")
    m = F.pmod("o_orderkey", F.lit(3))
    form = F.when(m == 0, "10-K").when(m == 1, "10-Q").otherwise("8-K")
    period = F.when(m == 0, "FY").otherwise(F.concat(F.lit("Q"), F.quarter("o_orderdate")))
    end = F.when(F.pmod("o_orderkey", F.lit(5)) == 0, "").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))

    def entry(v):
        text = F.when(F.pmod("o_orderkey", F.lit(7)) == 0, "n/a").otherwise(v.cast("string"))
        return F.struct(F.create_map(F.lit("USD"), F.array(F.struct(
            end.alias("end"), text.alias("val"), form.alias("form"), period.alias("fp")))).alias("units"))
    revenue = entry(F.col("o_totalprice"))
    facts = F.create_map(
        F.lit("us-gaap"), F.create_map(F.lit("Revenues"), revenue, F.lit("NetIncomeLoss"),
                                       entry(F.col("o_totalprice") * 0.5), F.lit("Ignored"), entry(F.lit(1.0))),
        F.lit("ifrs-full"), F.create_map(F.lit("Revenues"), revenue))
    docs = o.select("o_orderkey", F.to_json(F.struct(facts.alias("facts"))).alias("doc"))
    return NS.xbrl_facts(docs, "doc", keep=["o_orderkey"])


@query("s26_parallel_arrays_filtered", """
SELECT l_orderkey, l_linenumber AS line, 'S' || CAST(l_suppkey AS VARCHAR) AS accession FROM lineitem WHERE l_linenumber % 2 = 1""")
def s26(spark, sf):
    """S-26: parallel arrays (form, line, accession) -> rows, keeping form '4'
    (odd lines are form 4, even lines form 3)."""
    ol = order_lines(spark, sf)
    doc = F.to_json(F.struct(
        F.transform("lines", lambda x: F.when(F.pmod(x["l_linenumber"], F.lit(2)) == 1, F.lit("4")).otherwise(F.lit("3")))
        .alias("form"),
        F.transform("lines", lambda x: x["l_linenumber"]).alias("line"),
        F.transform("lines", lambda x: F.concat(F.lit("S"), x["l_suppkey"].cast("string"))).alias("accession")))
    rows = NS.columns_to_rows(ol.select("l_orderkey", doc.alias("doc")), "doc",
                              {"form": "string", "line": "int", "accession": "string"}, keep=["l_orderkey"])
    return rows.filter(F.col("form") == "4").select("l_orderkey", "line", "accession")


def _form4_docs(spark, sf, wrap: bool):
    ol = order_lines(spark, sf).join(T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate"),
                                     F.col("o_orderkey") == F.col("l_orderkey"))

    def txn(x):
        date = F.when(x["l_linenumber"] == 3, F.lit("")) \
            .when(x["l_linenumber"] == 4, F.lit("<transactionDate><value> </value></transactionDate>")).otherwise(
            F.concat(F.lit("<transactionDate><value>"), F.date_format(x["l_shipdate"], "yyyy-MM-dd"),
                     F.lit("</value></transactionDate>")))
        return F.concat(F.lit("<nonDerivativeTransaction>"), date,
                        F.lit("<transactionAmounts><transactionShares><value>"), x["l_quantity"].cast("string"),
                        F.lit("</value></transactionShares><transactionPricePerShare><value>"),
                        F.when(x["l_linenumber"] == 5, "abc").otherwise(x["l_extendedprice"].cast("string")),
                        F.lit("</value></transactionPricePerShare><transactionAcquiredDisposedCode><value>"),
                        F.when(x["l_returnflag"] == "R", F.lit("D")).otherwise(F.lit("A")),
                        F.lit("</value></transactionAcquiredDisposedCode></transactionAmounts>"
                              "</nonDerivativeTransaction>"))
    xml = F.concat(F.lit("<ownershipDocument><issuer><issuerTradingSymbol>O"), F.col("o_custkey").cast("string"),
                   F.lit("</issuerTradingSymbol><issuerName>Issuer "), F.col("o_custkey").cast("string"),
                   F.lit("</issuerName></issuer><reportingOwner><reportingOwnerId><rptOwnerName>Owner "),
                   F.col("l_orderkey").cast("string"),
                   F.lit("</rptOwnerName></reportingOwnerId></reportingOwner><reportingOwner><reportingOwnerId>"
                        "<rptOwnerName>Second owner</rptOwnerName></reportingOwnerId></reportingOwner><nonDerivativeTable>"),
                   F.array_join(F.transform("lines", txn), ""), F.lit("</nonDerivativeTable></ownershipDocument>"))
    if wrap:
        xml = F.when(F.pmod("l_orderkey", F.lit(2)) == 0,
                     F.concat(F.lit("<SEC-DOCUMENT>0001.txt\n<XML>\n<?xml version=\"1.0\"?>\n"), xml,
                              F.lit("\n</XML>\n</SEC-DOCUMENT>"))) \
            .otherwise(F.concat(F.lit("header text "), xml, F.lit(" trailer text")))
    return ol.select("l_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("file_date"), xml.alias("doc"))


FORM4_SQL = """
SELECT l_orderkey, 'O' || CAST(o_custkey AS VARCHAR) AS ticker, 'Issuer ' || CAST(o_custkey AS VARCHAR) AS issuer_name,
  'Owner ' || CAST(l_orderkey AS VARCHAR) AS owner_name,
  CASE WHEN l_linenumber IN (3, 4) THEN strftime(o_orderdate, '%Y-%m-%d') ELSE strftime(l_shipdate, '%Y-%m-%d') END AS transaction_date,
  l_quantity AS shares, CASE WHEN l_linenumber <> 5 THEN l_extendedprice END AS price_per_share, CASE WHEN l_returnflag = 'R' THEN 'D' ELSE 'A' END AS acquired_disposed,
  CASE WHEN l_linenumber <> 5 THEN round(l_quantity * l_extendedprice, 4) END AS transaction_value
FROM lineitem JOIN orders ON o_orderkey = l_orderkey"""


@query("s27_xml_transactions", FORM4_SQL)
def s27(spark, sf):
    docs = _form4_docs(spark, sf, wrap=False)
    out = NS.form4_transactions(docs, "doc", file_date="file_date", keep=["l_orderkey"])
    return out.drop("file_date").withColumn("transaction_value", duck_round("transaction_value", 4))


@query("s28_extract_embedded_xml", FORM4_SQL)
def s28(spark, sf):
    """S-28 + S-27: find the XML inside a text wrapper (with or without an XML
    declaration), then parse it."""
    docs = _form4_docs(spark, sf, wrap=True).withColumn("doc", NS.extract_xml("doc"))
    out = NS.form4_transactions(docs, "doc", file_date="file_date", keep=["l_orderkey"])
    return out.drop("file_date").withColumn("transaction_value", duck_round("transaction_value", 4))


@query("s29_page_metrics", """
WITH t AS (SELECT page_id, url || ' ' || html AS txt FROM pages)
SELECT page_id, 'page' AS metric, TRY_CAST(replace(regexp_extract(txt, 'page=(\\d+)', 1), ',', '') AS DOUBLE) AS value FROM t
UNION ALL SELECT page_id, 'track', TRY_CAST(replace(regexp_extract(txt, 'track\\((\\d+)\\)', 1), ',', '') AS DOUBLE) FROM t
UNION ALL SELECT page_id, 'path_id', TRY_CAST(replace(regexp_extract(txt, '/(\\d+)', 1), ',', '') AS DOUBLE) FROM t""")
def s29(spark, sf):
    p = T(spark, sf, "pages").select("page_id", F.concat_ws(" ", "url", "html").alias("txt"))
    return NS.page_metrics(p, "txt", {"page": r"page=(\d+)", "track": r"track\((\d+)\)", "path_id": r"/(\d+)"},
                           keep=["page_id"])
