"""Registered queries: joins, reshape, top-k, cleaning, filters and scalar helpers
over the TPC-H-like tables, ``events``, ``documents`` and ``pages``."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.functions import text as TX
from ledgerline.operators import bars as B
from ledgerline.operators import clean as CL
from ledgerline.operators import reshape as RS
from ledgerline.operators import topk as TK
from ledgerline.operators.quantiles import exact_median
from ledgerline.plans import fixtures as fx
from ledgerline.plans.registry import duck_round, query, rounded
from ledgerline.sources import lake as LK

EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
PRI_COLS = {p: f"p{p[0]}" for p in PRIORITIES}


def T(spark, sf, name):
    return fx.table(spark, sf, name)


def _day(c="ts"):
    return F.date_trunc("day", F.col(c))


# ---- A-09, A-10, A-15, A-16 ----------------------------------------------------

@query("a09_median_and_sums", """
SELECT l_returnflag, l_linestatus, round(median(l_discount), 6) AS median_discount,
  round(coalesce(sum(l_quantity), 0), 2) AS sum_qty, round(coalesce(sum(l_extendedprice), 0), 2) AS sum_price,
  min(l_shipdate) AS first_ship FROM lineitem GROUP BY 1, 2""")
def a09(spark, sf):
    """A-09: exact median, sums (0 when all missing), first snapshot per group."""
    li = T(spark, sf, "lineitem")
    keys = ["l_returnflag", "l_linestatus"]
    sums = li.groupBy(*keys).agg(
        F.coalesce(F.sum("l_quantity"), F.lit(0.0)).alias("sum_qty"),
        F.coalesce(F.sum("l_extendedprice"), F.lit(0.0)).alias("sum_price"),
        F.min("l_shipdate").alias("first_ship"))
    out = exact_median(li, keys, "l_discount", "median_discount").join(sums, keys)
    return rounded(out, money=("sum_qty", "sum_price"))


@query("a10_group_then_pivot", """
WITH per AS (SELECT l_orderkey, l_linenumber, sum(l_quantity) AS runs, count(CASE WHEN l_returnflag = 'R' THEN 1 END) AS wickets
             FROM lineitem GROUP BY 1, 2)
SELECT l_orderkey, """ + ", ".join(
    f"max(CASE WHEN l_linenumber = {k} THEN runs END) AS runs_{k}, "
    f"max(CASE WHEN l_linenumber = {k} THEN wickets END) AS wickets_{k}" for k in range(1, 5)) + """
FROM per GROUP BY 1""")
def a10(spark, sf):
    """A-10: per (match, innings) totals, innings 1..4 as columns (lineitem: order =
    match, line number = innings, quantity = runs, returned lines = wickets)."""
    li = T(spark, sf, "lineitem")
    return RS.group_pivot(li, ["l_orderkey"], "l_linenumber", [1, 2, 3, 4],
                          {"runs": F.sum("l_quantity"), "wickets": F.count(F.when(F.col("l_returnflag") == "R", 1))})


@query("a15_file_stats", """
SELECT c_mktsegment AS category, count(DISTINCT c_nationkey) AS assets,
  CAST(sum(strlen(c_custkey || ',' || c_name) + 1) AS BIGINT) AS bytes FROM customer GROUP BY 1""")
def a15(spark, sf):
    """A-15: asset folders and bytes per category of a text lake written from
    ``customer``, from file metadata only (the content column is never read). The
    number of files is left out: it depends on how the write was split."""
    root = LK.scratch_path(spark, "text-lake")
    c = T(spark, sf, "customer").select(F.col("c_mktsegment").alias("category"), F.col("c_nationkey").alias("asset"),
                                        F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name").alias("value"))
    LK.write_lake(c, root, fmt="text")
    return LK.file_stats(spark, root, pattern="*.txt").select("category", "assets", "bytes")


@query("a16_non_null_counts", " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count({c}) AS non_null FROM orders"
    for c in ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]))
def a16(spark, sf):
    long = RS.non_null_counts(T(spark, sf, "orders"))
    return long.withColumnRenamed("column", "column_name")


# ---- J -------------------------------------------------------------------------

J01_SQL = "WITH " + ", ".join(
    f"{e} AS (SELECT date_trunc('day', ts) AS day, avg(value) AS v FROM events WHERE event_type = '{e}' GROUP BY 1)"
    for e in EVENT_TYPES) + """
SELECT coalesce(click.day, error.day, purchase.day, signup.day, view.day) AS day, """ + ", ".join(
    f"round({e}.v, 6) AS {e}" for e in EVENT_TYPES) + """
FROM click FULL OUTER JOIN error ON click.day = error.day
FULL OUTER JOIN purchase ON purchase.day = coalesce(click.day, error.day)
FULL OUTER JOIN signup ON signup.day = coalesce(click.day, error.day, purchase.day)
FULL OUTER JOIN view ON view.day = coalesce(click.day, error.day, purchase.day, signup.day)"""


@query("j01_align_outer", J01_SQL)
def j01(spark, sf):
    """J-01: the daily series of all event types aligned on day — oracle: chained
    full outer joins; ours: one scan, one aggregate, one pivot."""
    daily = T(spark, sf, "events").groupBy(_day().alias("day"), "event_type").agg(F.avg("value").alias("v"))
    names = sorted(r[0] for r in T(spark, sf, "events").select("event_type").distinct().collect() if r[0] is not None)
    return rounded(RS.align_series(daily, "day", "event_type", "v", names))


@query("j02_concat_outer", """
WITH o AS (SELECT date_trunc('day', o_orderdate) AS day, count(*) AS n FROM orders GROUP BY 1),
s AS (SELECT date_trunc('day', l_shipdate) AS day, count(*) AS n FROM lineitem GROUP BY 1)
SELECT coalesce(o.day, s.day) AS day, o.n AS orders, s.n AS shipments FROM o FULL OUTER JOIN s ON o.day = s.day""")
def j02(spark, sf):
    o = T(spark, sf, "orders").groupBy(_day("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    s = T(spark, sf, "lineitem").groupBy(_day("l_shipdate").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    return RS.align_outer({"orders": o, "shipments": s}, "day", "n")


def _orders_daily(spark, sf):
    return T(spark, sf, "orders").groupBy(_day("o_orderdate").alias("day")).agg(F.count(F.lit(1)).alias("orders"))


def _ship_daily(spark, sf):
    return T(spark, sf, "lineitem").groupBy(_day("l_shipdate").alias("day")).agg(F.sum("l_quantity").alias("shipped_qty"))


J_DAILY = """WITH o AS (SELECT date_trunc('day', o_orderdate) AS day, count(*) AS orders FROM orders GROUP BY 1),
s AS (SELECT date_trunc('day', l_shipdate) AS day, sum(l_quantity) AS shipped_qty FROM lineitem GROUP BY 1)"""


@query("j03_left_join_on_time", J_DAILY + """
SELECT o.day, o.orders, round(s.shipped_qty, 2) AS shipped_qty FROM o LEFT JOIN s ON o.day = s.day""")
def j03(spark, sf):
    return rounded(_orders_daily(spark, sf).join(_ship_daily(spark, sf), "day", "left"), digits=2)


@query("j04_inner_join_on_time", J_DAILY + """
SELECT o.day, o.orders, round(s.shipped_qty, 2) AS shipped_qty FROM o JOIN s ON o.day = s.day""")
def j04(spark, sf):
    return rounded(_orders_daily(spark, sf).join(_ship_daily(spark, sf), "day", "inner"), digits=2)


@query("j05_semi_join", """
SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""")
def j05(spark, sf):
    c = T(spark, sf, "customer").filter(F.col("c_mktsegment") == "BUILDING")
    return T(spark, sf, "orders").join(c, F.col("o_custkey") == F.col("c_custkey"), "left_semi") \
        .select("o_orderkey", "o_custkey")


@query("j06_home_away", """
SELECT l_orderkey, min(CASE WHEN l_linenumber = 1 THEN l_suppkey END) AS home_team,
  min(CASE WHEN l_linenumber <> 1 THEN l_suppkey END) AS away_team,
  min(CASE WHEN l_linenumber = 1 THEN l_quantity END) AS home_score,
  min(CASE WHEN l_linenumber <> 1 THEN l_quantity END) AS away_score
FROM lineitem WHERE l_linenumber IN (1, 2) GROUP BY 1""")
def j06(spark, sf):
    """J-06: home row (line 1) and away row (line 2) of one game (order) side by side."""
    li = T(spark, sf, "lineitem").filter(F.col("l_linenumber").isin(1, 2))
    return TK.home_away(li, "l_orderkey", F.col("l_linenumber") == 1, "l_suppkey", "l_quantity")


@query("j07_anti_join", """
SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders)""")
def j07(spark, sf):
    o = T(spark, sf, "orders")
    return T(spark, sf, "customer").join(o, F.col("c_custkey") == F.col("o_custkey"), "left_anti") \
        .select("c_custkey", "c_name")


@query("j08_lookup_with_fallback", """
WITH lk AS (SELECT DISTINCT CASE WHEN o_orderpriority < '3' THEN replace(o_orderpriority, '-', '.') ELSE o_orderpriority END AS k,
                   CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS priority_rank FROM orders)
SELECT o_orderkey, coalesce(a.priority_rank, b.priority_rank) AS priority_rank
FROM orders LEFT JOIN lk a ON a.k = o_orderpriority LEFT JOIN lk b ON b.k = replace(o_orderpriority, '-', '.')""")
def j08(spark, sf):
    """J-08: lookup by the exact key, else by its '-' -> '.' form (the lookup
    stores the first two priorities in dotted form)."""
    o = T(spark, sf, "orders")
    p = F.col("o_orderpriority")
    lk = o.select(F.when(p < "3", F.replace(p, F.lit("-"), F.lit("."))).otherwise(p).alias("k"),
                  F.substring(p, 1, 1).cast("int").alias("priority_rank")).distinct()
    out = TK.lookup_with_fallback(o.select("o_orderkey", "o_orderpriority"), lk, "o_orderpriority", "k",
                                  "priority_rank", F.replace(F.col("o_orderpriority"), F.lit("-"), F.lit(".")))
    return out.select("o_orderkey", "priority_rank")


@query("j09_reindex", """
WITH v AS (SELECT date_trunc('day', ts) AS day, avg(value) AS view_mean FROM events WHERE event_type = 'view' GROUP BY 1),
c AS (SELECT date_trunc('hour', ts) AS hour, avg(value) AS click_mean FROM events WHERE event_type = 'click' GROUP BY 1)
SELECT v.day, round(v.view_mean, 6) AS view_mean, round(c.click_mean, 6) AS click_mean
FROM v LEFT JOIN c ON c.hour = v.day""")
def j09(spark, sf):
    """J-09: reindex the hourly click series onto the daily view dates (left join)."""
    ev = T(spark, sf, "events")
    v = ev.filter(F.col("event_type") == "view").groupBy(_day().alias("day")).agg(F.avg("value").alias("view_mean"))
    c = ev.filter(F.col("event_type") == "click").groupBy(F.date_trunc("hour", "ts").alias("day")) \
        .agg(F.avg("value").alias("click_mean"))
    return rounded(v.join(c, "day", "left"))


# ---- K -------------------------------------------------------------------------

@query("k01_top_n", """
WITH r AS (SELECT l_suppkey, sum(l_extendedprice * (1 - l_discount)) AS revenue FROM lineitem GROUP BY 1),
t AS (SELECT * FROM r ORDER BY revenue DESC NULLS LAST, l_suppkey LIMIT 20)
SELECT t.l_suppkey, s_name, round(t.revenue, 2) AS revenue FROM t JOIN supplier ON s_suppkey = t.l_suppkey""")
def k01(spark, sf):
    li = T(spark, sf, "lineitem")
    r = li.groupBy("l_suppkey").agg(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("revenue"))
    top = TK.top_n(r, "revenue", 20, ["l_suppkey"])
    out = top.join(T(spark, sf, "supplier"), F.col("s_suppkey") == F.col("l_suppkey")).select("l_suppkey", "s_name",
                                                                                             "revenue")
    return rounded(out, digits=2)


@query("k02_top_groups_rows", """
WITH oc AS (SELECT o.*, c_nationkey FROM orders o JOIN customer ON c_custkey = o_custkey),
top AS (SELECT c_nationkey FROM oc GROUP BY 1 ORDER BY count(*) DESC, c_nationkey LIMIT 10)
SELECT c_nationkey, CAST(year(o_orderdate) AS INTEGER) AS year, round(avg(o_totalprice), 6) AS mean_price, count(*) AS n
FROM oc WHERE c_nationkey IN (SELECT c_nationkey FROM top) GROUP BY 1, 2""")
def k02(spark, sf):
    oc = T(spark, sf, "orders").join(T(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    kept = TK.rows_of_top_groups(oc, "c_nationkey", 10)
    out = kept.groupBy("c_nationkey", F.year("o_orderdate").alias("year")).agg(
        F.avg("o_totalprice").alias("mean_price"), F.count(F.lit(1)).alias("n"))
    return rounded(out)


@query("k03_sort_multi_key", "SELECT c_custkey, c_nationkey, c_acctbal FROM customer")
def k03(spark, sf):
    return TK.sort_by(T(spark, sf, "customer"), ["c_nationkey", F.col("c_acctbal").desc(), "c_custkey"]) \
        .select("c_custkey", "c_nationkey", "c_acctbal")


@query("k04_sort_descending", "SELECT p_partkey, p_retailprice FROM part")
def k04(spark, sf):
    return TK.sort_by(T(spark, sf, "part"), [F.col("p_retailprice").desc(), "p_partkey"]).select("p_partkey",
                                                                                                "p_retailprice")


@query("k05_top_predicted_gainers", """
WITH b AS (SELECT CAST(user_id AS VARCHAR) AS asset, date_trunc('day', ts) AS ts,
                  arg_max(value, (ts, event_id)) AS close FROM events GROUP BY 1, 2),
r AS (SELECT *, CASE WHEN close > 0 AND lag(close) OVER w > 0 THEN ln(close / lag(close) OVER w) END AS log_return
      FROM b WINDOW w AS (PARTITION BY asset ORDER BY ts)),
l AS (SELECT * FROM r QUALIFY row_number() OVER (PARTITION BY asset ORDER BY ts DESC) = 1)
SELECT asset AS ticker, round(close, 6) AS current_price, round(log_return, 6) AS predicted_return,
       round(close * (1 + log_return), 6) AS predicted_price
FROM l ORDER BY log_return DESC NULLS LAST, asset LIMIT 10""")
def k05(spark, sf):
    """K-05 / M-26 over many short series (daily bars per user)."""
    from ledgerline.operators.features import log_returns
    from ledgerline.operators.models import batch_forecast
    f = log_returns(fx.user_daily_bars(spark, sf))
    return rounded(batch_forecast(f, "log_return", key="asset", ts="ts", top=10))


@query("k06_first_n_per_group", """
WITH d AS (SELECT DISTINCT o_custkey, o_orderdate FROM orders),
r AS (SELECT *, dense_rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rk FROM d)
SELECT o_orderkey, o.o_custkey, o.o_orderdate FROM orders o JOIN r USING (o_custkey, o_orderdate) WHERE rk <= 4""")
def k06(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return TK.first_n_per_group(o, "o_custkey", "o_orderdate", 4)


@query("k07_join_first_elements", """
SELECT doc_id, array_to_string(list_slice(string_split(text, ' '), 1, 3), ', ') AS first_words FROM documents""")
def k07(spark, sf):
    d = T(spark, sf, "documents")
    return d.select("doc_id", TK.join_first(F.split("text", " "), 3).alias("first_words"))


@query("k08_rank_in_list", """
WITH h AS (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS hrefs FROM pages)
SELECT page_id, CAST(i AS INTEGER) AS rank, hrefs[i] AS href FROM h, range(1, len(hrefs) + 1) t(i)""")
def k08(spark, sf):
    p = T(spark, sf, "pages").select("page_id", F.regexp_extract_all("html", F.lit(r'href="([^"]*)"'), 1).alias("hrefs"))
    return TK.ranked_elements(p, "hrefs", keep=["page_id"], item="href", rank="rank")


@query("k09_last_n_by_name", "SELECT doc_id, source FROM documents ORDER BY doc_id DESC LIMIT 10")
def k09(spark, sf):
    return TK.top_n(T(spark, sf, "documents").select("doc_id", "source"), "doc_id", 10)


# ---- R -------------------------------------------------------------------------

@query("r01_union_by_name", """
SELECT c_custkey AS id, c_name AS name, c_acctbal AS acctbal, c_mktsegment AS segment, 'customer' AS kind FROM customer
UNION ALL BY NAME
SELECT s_suppkey AS id, s_name AS name, s_acctbal AS acctbal, 'supplier' AS kind FROM supplier""")
def r01(spark, sf):
    c = T(spark, sf, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"),
                                         F.col("c_acctbal").alias("acctbal"), F.col("c_mktsegment").alias("segment"),
                                         F.lit("customer").alias("kind"))
    s = T(spark, sf, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"),
                                         F.col("s_acctbal").alias("acctbal"), F.lit("supplier").alias("kind"))
    return RS.union_all([c, s])


@query("r02_priority_union", """
WITH a AS (SELECT date_trunc('day', ts) AS day, avg(value) AS value, 0 AS priority FROM events
           WHERE event_type = 'click' AND hour(ts) = 0 GROUP BY 1),
b AS (SELECT date_trunc('day', ts) AS day, avg(value) AS value, 1 AS priority FROM events WHERE event_type = 'click' GROUP BY 1),
u AS (SELECT * FROM a UNION ALL SELECT * FROM b)
SELECT day, round(arg_min(value, priority), 6) AS value, min(priority) AS priority FROM u GROUP BY 1""")
def r02(spark, sf):
    """R-02 / S-37: a primary feed (midnight-hour snapshot) with a fallback feed
    (whole-day mean); per day the best available source wins."""
    ev = T(spark, sf, "events").filter(F.col("event_type") == "click")
    a = ev.filter(F.hour("ts") == 0).groupBy(_day().alias("day")).agg(F.avg("value").alias("value"))
    b = ev.groupBy(_day().alias("day")).agg(F.avg("value").alias("value"))
    return rounded(RS.priority_union([a, b], ["day"]).select("day", "value", "priority"))


PIVOT_DAILY_SQL = "SELECT day, " + ", ".join(
    f"round(max(CASE WHEN o_orderpriority = '{p}' THEN v END), 2) AS {PRI_COLS[p]}" for p in PRIORITIES)


@query("r03_pivot_unique", """
WITH d AS (SELECT date_trunc('day', o_orderdate) AS day, o_orderpriority, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
""" + PIVOT_DAILY_SQL + " FROM d GROUP BY day")
def r03(spark, sf):
    o = T(spark, sf, "orders")
    d = o.groupBy(_day("o_orderdate").alias("day"), "o_orderpriority").agg(F.sum("o_totalprice").alias("v"))
    return rounded(RS.pivot_unique(d, ["day"], "o_orderpriority", "v").withColumnsRenamed(PRI_COLS),
                   digits=2)


@query("r04_pivot_first", """
WITH d AS (SELECT date_trunc('day', o_orderdate) AS day, o_orderpriority, arg_min(o_totalprice, o_orderkey) AS v
           FROM orders GROUP BY 1, 2)
""" + PIVOT_DAILY_SQL + " FROM d GROUP BY day")
def r04(spark, sf):
    o = T(spark, sf, "orders").withColumn("day", _day("o_orderdate"))
    return rounded(RS.pivot_first(o, ["day"], "o_orderpriority", "o_totalprice", None, ["o_orderkey"])
                   .withColumnsRenamed(PRI_COLS), digits=2)


@query("r05_transpose", """
WITH d AS (SELECT year(o_orderdate) AS year, o_orderpriority, sum(o_totalprice) AS v FROM orders GROUP BY 1, 2)
SELECT CAST(year AS VARCHAR) AS year, """ + ", ".join(
    f"round(max(CASE WHEN o_orderpriority = '{p}' THEN v END), 2) AS {PRI_COLS[p]}" for p in PRIORITIES) + """
FROM d GROUP BY 1""")
def r05(spark, sf):
    """R-05: a wide table with one row per series (priority) and one column per
    year is turned into one row per year with one column per series."""
    o = T(spark, sf, "orders")
    years = RS.column_values(o, F.year("o_orderdate"))
    wide = o.withColumn("y", F.year("o_orderdate")).groupBy("o_orderpriority").pivot("y", years) \
        .agg(F.sum("o_totalprice"))
    out = RS.transpose_series(wide, "o_orderpriority", [str(y) for y in years], "year",
                              RS.column_values(o, "o_orderpriority"))
    return rounded(out.withColumnsRenamed(PRI_COLS), digits=2)


@query("r06_wide_months_to_long", """
WITH d AS (SELECT c_nationkey, year(o_orderdate) AS year, month(o_orderdate) AS month, sum(o_totalprice) AS v
           FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2, 3),
ny AS (SELECT DISTINCT c_nationkey, year FROM d),
m AS (SELECT * FROM ny, range(1, 13) t(month))
SELECT m.c_nationkey, CAST(m.year AS INTEGER) AS year, CAST(m.month AS VARCHAR) AS month, round(d.v, 2) AS value
FROM m LEFT JOIN d USING (c_nationkey, year, month)""")
def r06(spark, sf):
    """R-06: wide (nation, year) rows with twelve month columns -> one row per month."""
    oc = T(spark, sf, "orders").join(T(spark, sf, "customer"), F.col("c_custkey") == F.col("o_custkey"))
    wide = oc.withColumn("year", F.year("o_orderdate")).withColumn("month", F.month("o_orderdate")) \
        .groupBy("c_nationkey", "year").pivot("month", list(range(1, 13))).agg(F.sum("o_totalprice"))
    long = RS.unpivot(wide, ["c_nationkey", "year"], [str(m) for m in range(1, 13)], "month", "value")
    return rounded(long, digits=2)


@query("r07_map_rows_with_fallback", """
WITH f AS (SELECT l_orderkey, l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2)
SELECT o_orderkey, coalesce(l_returnflag, 'all') AS chain,
       round(CASE WHEN l_returnflag IS NULL THEN o_totalprice ELSE q END, 2) AS value
FROM orders LEFT JOIN f ON f.l_orderkey = o_orderkey""")
def r07(spark, sf):
    """R-07: per order a map flag -> quantity; orders without a breakdown keep one
    'all' row carrying the order total."""
    li = T(spark, sf, "lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    maps = li.groupBy("l_orderkey").agg(F.map_from_entries(F.collect_list(F.struct("l_returnflag", "q"))).alias("m"))
    o = T(spark, sf, "orders").join(maps, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return rounded(RS.map_rows_with_fallback(o, ["o_orderkey"], "m", F.col("o_totalprice")), digits=2)


# ---- P -------------------------------------------------------------------------

@query("p01_normalize_columns", "SELECT * FROM customer")
def p01(spark, sf):
    c = T(spark, sf, "customer")
    messy = c.toDF("C CustKey ", " C Name", "C NationKey", "C AcctBal ", "C MktSegment")
    return CL.normalize_columns(messy)


@query("p02_rename_map", 'SELECT s_suppkey, s_name AS name, s_nationkey, s_acctbal AS "balance>0" FROM supplier')
def p02(spark, sf):
    return CL.rename(T(spark, sf, "supplier"), {"s_name": "name", "s_acctbal": "balance>0", "missing": "x"})


@query("p03_keep_available", "SELECT p_partkey, p_name, p_size FROM part")
def p03(spark, sf):
    return CL.keep_available(T(spark, sf, "part"), ["p_partkey", "p_name", "p_color", "p_size"])


@query("p04_find_column", "SELECT l_orderkey, l_extendedprice FROM lineitem")
def p04(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", CL.find_column(li, "price"))


@query("p05_to_number", """
SELECT event_id, TRY_CAST(CASE WHEN event_id % 5 = 0 THEN 'n/a' ELSE json_extract_string(props, '$.k') END AS DOUBLE) AS k
FROM events""")
def p05(spark, sf):
    ev = T(spark, sf, "events")
    raw = F.when(F.pmod("event_id", F.lit(5)) == 0, F.lit("n/a")).otherwise(F.get_json_object("props", "$.k"))
    return ev.select("event_id", CL.to_number(raw).alias("k"))


P06_RAW_SQL = """CASE o_orderkey % 4 WHEN 0 THEN CAST(epoch(o_orderdate) AS BIGINT)::VARCHAR
  WHEN 1 THEN strftime(o_orderdate, '%Y%m%d') WHEN 2 THEN strftime(o_orderdate, '%m/%d/%Y')
  ELSE strftime(o_orderdate, '%Y-%m-%d') END"""


@query("p06_parse_timestamps", f"""
WITH r AS (SELECT o_orderkey, {P06_RAW_SQL} AS raw FROM orders)
SELECT o_orderkey, raw, CASE WHEN regexp_full_match(raw, '[0-9]{{9,}}') THEN CAST(to_timestamp(CAST(raw AS BIGINT)) AS TIMESTAMP)
  ELSE coalesce(try_strptime(raw, '%Y%m%d'), try_strptime(raw, '%m/%d/%Y'), try_strptime(raw, '%Y-%m-%d')) END AS parsed
FROM r""")
def p06(spark, sf):
    """P-06: one text column in mixed formats (epoch seconds, yyyyMMdd, MM/dd/yyyy, ISO)."""
    o = T(spark, sf, "orders")
    d = F.col("o_orderdate")
    m = F.pmod("o_orderkey", F.lit(4))
    raw = (F.when(m == 0, F.unix_timestamp(d.cast("timestamp")).cast("string"))
            .when(m == 1, F.date_format(d, "yyyyMMdd")).when(m == 2, F.date_format(d, "MM/dd/yyyy"))
            .otherwise(F.date_format(d, "yyyy-MM-dd")))
    r = o.select("o_orderkey", raw.alias("raw"))
    parsed = F.when(F.col("raw").rlike(r"^[0-9]{9,}$"), CL.to_timestamp_any("raw", epoch="s")) \
        .otherwise(CL.to_timestamp_any("raw", formats=("yyyyMMdd", "MM/dd/yyyy", "yyyy-MM-dd")))
    return r.select("o_orderkey", "raw", parsed.cast("timestamp_ntz").alias("parsed"))


@query("p07_date_from_parts", """
SELECT o_orderkey, CASE WHEN o_orderkey % 14 BETWEEN 1 AND 12 THEN CAST(make_date(year(o_orderdate), CAST(o_orderkey % 14 AS INTEGER), 1) AS TIMESTAMP) END AS d,
       CAST(make_date(year(o_orderdate), 12, 31) AS TIMESTAMP) AS year_end FROM orders""")
def p07(spark, sf):
    o = T(spark, sf, "orders")
    y = F.year("o_orderdate")
    return o.select("o_orderkey", CL.date_from_parts(y, F.pmod("o_orderkey", F.lit(14))).cast("timestamp_ntz").alias("d"),
                    CL.date_from_parts(y, year_end=True).cast("timestamp_ntz").alias("year_end"))


@query("p08_floor_time", """
SELECT event_id, date_trunc('minute', ts) AS minute, date_trunc('day', ts) AS day FROM events""")
def p08(spark, sf):
    return T(spark, sf, "events").select("event_id", F.date_trunc("minute", "ts").alias("minute"),
                                          F.date_trunc("day", "ts").alias("day"))


SENT_SQL = "CASE WHEN l_linenumber = 7 THEN -999.0 WHEN l_linenumber = 6 THEN -99.99 ELSE l_quantity END"


def _sentinel_rows(spark, sf):
    li = T(spark, sf, "lineitem")
    raw = F.when(F.col("l_linenumber") == 7, F.lit(-999.0)).when(F.col("l_linenumber") == 6, F.lit(-99.99)) \
        .otherwise(F.col("l_quantity"))
    return li.select("l_orderkey", "l_linenumber", raw.alias("raw"), "l_discount")


@query("p09_sentinels_to_null", f"""
SELECT l_orderkey, l_linenumber, CASE WHEN ({SENT_SQL}) NOT IN (-999, -9999, -99.99, -9.99) THEN {SENT_SQL} END AS qty
FROM lineitem""")
def p09(spark, sf):
    r = _sentinel_rows(spark, sf)
    return r.select("l_orderkey", "l_linenumber", CL.null_sentinels("raw").alias("qty"))


@query("p10_drop_missing", f"""
WITH c AS (SELECT CASE WHEN ({SENT_SQL}) NOT IN (-999, -9999, -99.99, -9.99) THEN {SENT_SQL} END AS qty,
                  CASE WHEN l_linenumber = 7 THEN NULL ELSE l_discount END AS disc FROM lineitem)
SELECT 'any' AS how, count(*) AS n FROM c WHERE qty IS NOT NULL AND disc IS NOT NULL
UNION ALL SELECT 'all', count(*) FROM c WHERE qty IS NOT NULL OR disc IS NOT NULL
UNION ALL SELECT 'subset', count(*) FROM c WHERE qty IS NOT NULL""")
def p10(spark, sf):
    r = _sentinel_rows(spark, sf)
    c = r.select(CL.null_sentinels("raw").alias("qty"),
                 F.when(F.col("l_linenumber") != 7, F.col("l_discount")).alias("disc"))
    parts = [c.na.drop(how="any").agg(F.count(F.lit(1)).alias("n")).withColumn("how", F.lit("any")),
             c.na.drop(how="all").agg(F.count(F.lit(1)).alias("n")).withColumn("how", F.lit("all")),
             c.na.drop(how="any", subset=["qty"]).agg(F.count(F.lit(1)).alias("n")).withColumn("how", F.lit("subset"))]
    return RS.union_all(parts).select("how", "n")


@query("p11_percent_scale", """
SELECT l_orderkey, l_linenumber,
  round(CASE WHEN (SELECT max(l_discount) FROM lineitem) <= 1.01 THEN l_discount * 100 ELSE l_discount END, 6) AS l_discount,
  round(l_tax / 100, 8) AS l_tax FROM lineitem""")
def p11(spark, sf):
    li = T(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_discount", "l_tax")
    out = CL.percent_scale(CL.percent_scale(li, ["l_discount"], "auto"), ["l_tax"], "div")
    return out.select("l_orderkey", "l_linenumber", duck_round("l_discount", 6).alias("l_discount"),
                      duck_round("l_tax", 8).alias("l_tax"))


@query("p12_prefix_columns", "SELECT n_nationkey, n_name AS nat_n_name, n_regionkey AS nat_n_regionkey FROM nation")
def p12(spark, sf):
    return CL.add_prefix(T(spark, sf, "nation"), prefix="nat_", exclude=["n_nationkey"])


@query("p13_constant_tag", "SELECT r_regionkey, r_name, 'region' AS source FROM region")
def p13(spark, sf):
    return T(spark, sf, "region").withColumn("source", F.lit("region"))


@query("p14_first_non_empty", """
SELECT c_custkey, coalesce(nullif(CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END, ''), c_name) AS label
FROM customer""")
def p14(spark, sf):
    c = T(spark, sf, "customer")
    a = F.when(F.pmod("c_custkey", F.lit(3)) == 0, F.lit("")).otherwise(F.col("c_mktsegment"))
    return c.select("c_custkey", CL.first_non_empty(a, "c_name").alias("label"))


@query("p15_numeric_share", "SELECT " + ", ".join(
    f"round(count(TRY_CAST(CAST({c} AS VARCHAR) AS DOUBLE)) / count(*), 6) AS {c}"
    for c in ["event_id", "ts", "user_id", "event_type", "value", "props"]) + " FROM events")
def p15(spark, sf):
    return rounded(CL.numeric_share(T(spark, sf, "events")))


@query("p16_required_columns", "SELECT o_orderkey, o_orderdate FROM orders")
def p16(spark, sf):
    return CL.require_columns(T(spark, sf, "orders"), ["o_orderkey", "o_orderdate"]).select("o_orderkey", "o_orderdate")


@query("p17_to_time_index", """
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS TIMESTAMP) AS ts FROM orders""")
def p17(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"))
    return CL.to_time_index(o, "date").select("o_orderkey", F.col("ts").cast("timestamp_ntz").alias("ts"))


@query("p18_derived_columns", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 6) AS net_price,
  round(CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END, 8) AS unit_price,
  round(l_extendedprice - l_extendedprice * l_discount, 6) AS gross_minus_discount FROM lineitem""")
def p18(spark, sf):
    li = T(spark, sf, "lineitem")
    # unit price is rounded to 8 places: cents / quantity (<= 50) never ends in a 5 there
    return rounded(li.select("l_orderkey", "l_linenumber",
                             (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("net_price"),
                             duck_round(CL.safe_ratio("l_extendedprice", "l_quantity"), 8).alias("unit_price"),
                             (F.col("l_extendedprice") - F.col("l_extendedprice") * F.col("l_discount"))
                             .alias("gross_minus_discount")), keep=("unit_price",))


@query("p19_row_sum_min_count", """
SELECT event_id, CASE WHEN event_type IN ('click', 'view') THEN value END AS total FROM events""")
def p19(spark, sf):
    ev = T(spark, sf, "events")
    a = F.when(F.col("event_type") == "click", F.col("value"))
    b = F.when(F.col("event_type") == "view", F.col("value"))
    return ev.select("event_id", CL.row_sum_min_count(a, b).alias("total"))


@query("p20_change_pct", """
WITH d AS (SELECT event_type AS asset, date_trunc('day', ts) AS ts, sum(value) AS total FROM events GROUP BY 1, 2)
SELECT asset, ts, CASE WHEN lag(total) OVER w > 0 THEN round_even((total / lag(total) OVER w - 1) * 100 * 10000, 0) / 10000 END AS total_change_pct
FROM d WINDOW w AS (PARTITION BY asset ORDER BY ts)""")
def p20(spark, sf):
    ev = T(spark, sf, "events")
    d = ev.groupBy(F.col("event_type").alias("asset"), _day().alias("ts")).agg(F.sum("value").alias("total"))
    return CL.pct_change_guarded(d, "total").select("asset", "ts", "total_change_pct")


@query("p21_flat_ohlc", """
SELECT event_type, date_trunc('day', ts) AS period, arg_max(value, (ts, event_id)) AS close,
  arg_max(value, (ts, event_id)) AS open, arg_max(value, (ts, event_id)) AS high, arg_max(value, (ts, event_id)) AS low
FROM events GROUP BY 1, 2""")
def p21(spark, sf):
    d = B.last_per_period(T(spark, sf, "events"), "event_type", "ts", "value", "day", "event_id")
    return CL.flat_ohlc(d.withColumnRenamed("value", "close"))


@query("p22_truncate_text", "SELECT doc_id, coalesce(substr(text, 1, 500), '') AS selftext FROM documents")
def p22(spark, sf):
    return T(spark, sf, "documents").select("doc_id", CL.truncate_text("text", 500).alias("selftext"))


# ---- F -------------------------------------------------------------------------

@query("f01_equality_filter", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F'")
def f01(spark, sf):
    return T(spark, sf, "orders").filter(F.col("o_orderstatus") == "F").select("o_orderkey")


@query("f02_isin_filter", "SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY')")
def f02(spark, sf):
    return T(spark, sf, "customer").filter(F.col("c_mktsegment").isin("BUILDING", "MACHINERY")).select("c_custkey")


@query("f03_contains_ci", "SELECT p_partkey FROM part WHERE contains(upper(p_name), 'RED')")
def f03(spark, sf):
    return T(spark, sf, "part").filter(CL.contains_ci("p_name", "red")).select("p_partkey")


@query("f04_any_prefix", """
SELECT doc_id, len(list_filter(string_split(text, ' '), lambda t: starts_with(t, 'Th') OR starts_with(t, 'Ei'))) > 0 AS hit
FROM documents""")
def f04(spark, sf):
    d = T(spark, sf, "documents")
    return d.select("doc_id", CL.any_prefix(F.split("text", " "), ["Th", "Ei"]).alias("hit"))


@query("f05_hour_sample", "SELECT event_id FROM events WHERE hour(ts) IN (0, 6, 12, 18)")
def f05(spark, sf):
    return T(spark, sf, "events").filter(F.hour("ts").isin(0, 6, 12, 18)).select("event_id")


@query("f06_business_days", "SELECT o_orderkey FROM orders WHERE isodow(o_orderdate) <= 5")
def f06(spark, sf):
    return T(spark, sf, "orders").filter(CL.business_day("o_orderdate")).select("o_orderkey")


@query("f07_min_history", """
WITH b AS (SELECT CAST(user_id AS VARCHAR) AS asset, date_trunc('day', ts) AS ts, arg_max(value, (ts, event_id)) AS close
           FROM events GROUP BY 1, 2)
SELECT asset, ts, close FROM b WHERE asset IN (SELECT asset FROM b GROUP BY 1 HAVING count(*) >= 20)""")
def f07(spark, sf):
    b = fx.user_daily_bars(spark, sf).select("asset", "ts", "close")
    return CL.min_history(b, "asset", 20)


@query("f08_positive_only", "SELECT event_id, value FROM events WHERE value > 0")
def f08(spark, sf):
    return T(spark, sf, "events").filter(F.col("value") > 0).select("event_id", "value")


# ---- X-13..X-22 ----------------------------------------------------------------

LINES_ORDER = "l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_shipdate"


LISTS_SQL = f"""WITH g AS (SELECT l_orderkey, list(CAST(l_partkey AS VARCHAR) ORDER BY {LINES_ORDER}) AS outcomes,
  list(CAST(l_discount AS VARCHAR) ORDER BY {LINES_ORDER}) AS prices FROM lineitem GROUP BY 1)"""


@query("x13_winning_outcome", LISTS_SQL + """
SELECT l_orderkey, outcomes[list_position(list_transform(prices, lambda p: CAST(p AS DOUBLE)),
  list_max(list_transform(prices, lambda p: CAST(p AS DOUBLE))))] AS winner FROM g""")
def x13(spark, sf):
    """X-13 where outcomes and prices are rows: an aggregate, no list of a market is built."""
    li = T(spark, sf, "lineitem")
    out = TK.winning_row(li, ["l_orderkey"], "l_partkey", "l_discount", LINES_ORDER.split(", "))
    return out.select("l_orderkey", F.col("l_partkey").cast("string").alias("winner"))


VECTORS_SQL = """WITH g AS (SELECT vec_id, [CAST(x AS VARCHAR) for x in embedding] AS prices FROM embeddings)"""


@query("x13_winning_outcome_list", VECTORS_SQL + """
SELECT vec_id, CASE WHEN len(prices) > 0 AND len([p for p in prices if TRY_CAST(p AS DOUBLE) IS NULL]) = 0 THEN
  'outcome ' || CAST(list_position([CAST(p AS DOUBLE) for p in prices], list_max([CAST(p AS DOUBLE) for p in prices])) - 1
    AS VARCHAR) END AS winner FROM g""")
def x13_list(spark, sf):
    """X-13 where the table has lists: the outcome at the highest of a vector's prices (text)."""
    g = T(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("string")).alias("prices"))
    names = F.transform("prices", lambda _, i: F.concat(F.lit("outcome "), i.cast("string")))
    return g.select("vec_id", TX.winning_outcome(names, "prices").alias("winner"))


@query("x15_first_price_list", VECTORS_SQL + " SELECT vec_id, TRY_CAST(prices[1] AS DOUBLE) AS first_price FROM g")
def x15_list(spark, sf):
    g = T(spark, sf, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("string")).alias("prices"))
    return g.select("vec_id", TX.first_price("prices").alias("first_price"))


@query("x15_first_price", LISTS_SQL + " SELECT l_orderkey, TRY_CAST(prices[1] AS DOUBLE) AS first_price FROM g")
def x15(spark, sf):
    """X-15 where prices are rows: the first row per market, an aggregate."""
    first = RS.keep_first(T(spark, sf, "lineitem"), ["l_orderkey"], LINES_ORDER.split(", "))
    return first.select("l_orderkey", F.col("l_discount").try_cast("double").alias("first_price"))


X14_RAW = """CASE event_id % 3 WHEN 0 THEN '["' || event_type || '","' || CAST(user_id AS VARCHAR) || '"]'
  WHEN 1 THEN props ELSE 'not json' END"""


@query("x14_json_list", f"""
WITH r AS (SELECT event_id, {X14_RAW} AS raw FROM events)
SELECT event_id, CASE WHEN json_valid(raw) AND json_type(raw) = 'ARRAY' THEN json_extract_string(raw, '$[*]') END AS items
FROM r""")
def x14(spark, sf):
    ev = T(spark, sf, "events")
    m = F.pmod("event_id", F.lit(3))
    raw = (F.when(m == 0, F.concat(F.lit('["'), F.col("event_type"), F.lit('","'), F.col("user_id").cast("string"),
                                   F.lit('"]')))
            .when(m == 1, F.col("props")).otherwise(F.lit("not json")))
    return ev.select("event_id", TX.json_list(raw).alias("items"))


@query("x16_opponent", """
WITH m AS (SELECT o_orderkey, o_orderstatus || CASE WHEN o_orderkey % 2 = 0 THEN ' vs. ' ELSE ' @ ' END || o_orderpriority AS matchup
           FROM orders)
SELECT o_orderkey, regexp_extract(matchup, 'vs\\.\\s+(\\w+)', 1) AS opponent, contains(matchup, 'vs.') AS is_home FROM m""")
def x16(spark, sf):
    o = T(spark, sf, "orders")
    sep = F.when(F.pmod("o_orderkey", F.lit(2)) == 0, F.lit(" vs. ")).otherwise(F.lit(" @ "))
    m = o.select("o_orderkey", F.concat("o_orderstatus", sep, "o_orderpriority").alias("matchup"))
    return m.select("o_orderkey", TX.opponent("matchup").alias("opponent"), TX.is_home("matchup").alias("is_home"))


@query("x17_safe_id", "SELECT page_id, substr(regexp_replace(url, '[^A-Za-z0-9_-]', '_', 'g'), 1, 80) AS safe FROM pages")
def x17(spark, sf):
    return T(spark, sf, "pages").select("page_id", TX.safe_id("url").alias("safe"))


@query("x18_clean_symbol", """
SELECT p_partkey, replace(replace(replace(p_brand, '#', '-') || CASE WHEN p_partkey % 2 = 0 THEN '-SWAP' ELSE '' END,
  '-SWAP', ''), '-', '') AS symbol FROM part""")
def x18(spark, sf):
    p = T(spark, sf, "part")
    raw = F.concat(F.replace("p_brand", F.lit("#"), F.lit("-")),
                   F.when(F.pmod("p_partkey", F.lit(2)) == 0, F.lit("-SWAP")).otherwise(F.lit("")))
    return p.select("p_partkey", TX.clean_symbol(raw).alias("symbol"))


@query("x19_math", """
SELECT l_orderkey, l_linenumber, CAST(sign(l_tax - 0.04) AS DOUBLE) AS sgn, abs(l_tax - 0.04) AS dist,
  round(sqrt(l_quantity), 6) AS root, round(ln(l_extendedprice), 6) AS log_price, round(pow(l_discount, 2), 8) AS disc_sq
FROM lineitem""")
def x19(spark, sf):
    li = T(spark, sf, "lineitem")
    return li.select("l_orderkey", "l_linenumber", F.signum(F.col("l_tax") - 0.04).alias("sgn"),
                     F.abs(F.col("l_tax") - 0.04).alias("dist"), duck_round(F.sqrt("l_quantity"), 6).alias("root"),
                     duck_round(F.log("l_extendedprice"), 6).alias("log_price"),
                     duck_round(F.pow("l_discount", 2), 8).alias("disc_sq"))


@query("x20_seasons_quarters", """
WITH y AS (SELECT DISTINCT year(o_orderdate) AS year FROM orders),
q AS (SELECT year, year * 4 - 1 - k AS qi FROM y, range(0, 4) t(k))
SELECT CAST(year AS INTEGER) AS year, lpad(CAST(year % 100 AS VARCHAR), 2, '0') || lpad(CAST((year + 1) % 100 AS VARCHAR), 2, '0') AS season,
  CAST(floor(qi / 4) AS INTEGER) AS q_year, CAST(qi % 4 + 1 AS INTEGER) AS q_quarter FROM q""")
def x20(spark, sf):
    """X-20: season code of each order year and the four completed quarters before
    that year's first day."""
    y = T(spark, sf, "orders").select(F.year("o_orderdate").alias("year")).distinct()
    jan1 = F.make_date(F.col("year"), F.lit(1), F.lit(1))
    out = y.select("year", TX.season_code(F.col("year")).alias("season"),
                   F.explode(TX.previous_quarters(jan1, 4)).alias("q"))
    return out.select("year", "season", F.col("q.year").alias("q_year"), F.col("q.quarter").alias("q_quarter"))


@query("x21_literal_count", """
SELECT page_id, CAST((length(html) - length(replace(html, '<li>', ''))) / 4 AS INTEGER) AS li_tags,
  CAST((length(url) - length(replace(url, '.example', ''))) / 8 AS INTEGER) AS example_hosts FROM pages""")
def x21(spark, sf):
    p = T(spark, sf, "pages")
    return p.select("page_id", TX.literal_count("html", "<li>").alias("li_tags"),
                    TX.literal_count("url", ".example").alias("example_hosts"))


@query("x22_iso_date", "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS order_date FROM orders")
def x22(spark, sf):
    return T(spark, sf, "orders").select("o_orderkey", TX.iso_date("o_orderdate").alias("order_date"))
