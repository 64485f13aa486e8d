"""Structure that runs across the splits of a file: large JSON documents, quoted line breaks, header rows.

Files are read in splits by many tasks; what a row means can depend on all rows before it (is this place
inside quotes, how many brackets are open). Such state is a sum over the rows before: a running sum inside
each split, plus the sum of the splits before, which is one small row a split (:func:`carried`). No file and
no document is ever held in one row or read by one task.

Rows are keyed (file, part, block, row): ``part`` numbers the files that make up one document (a folder
``file=<name>`` of ordered parts), ``block`` is the offset of a split, ``row`` the order inside it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.sources import json_scan as JS
from ledgerline.sources.lake import scratch_path

SPLIT = ["file", "part", "block"]


def split_rows(spark: SparkSession, path: str, sep: str | None = None, holds: Sequence[str] = (),
               also: Sequence[str] = ()) -> DataFrame:
    """(file, part, block, row, size, text) of the text files under ``path``, cut at ``sep`` (default: line ends).
    Parts of a folder ``file=<name>`` are one file, in the order of their numbers; ``size`` is a part's bytes.
    ``holds`` keeps only texts with one of these strings (looked for first, before anything is made of a text),
    ``also`` names more of Spark's file metadata."""
    r = spark.read.option("lineSep", sep) if sep else spark.read
    df = r.text(path)
    if holds:
        df = df.where(reduce(or_, [F.contains("value", F.lit(h)) for h in holds]))
    meta = F.col("_metadata")
    if "file" in df.columns:
        number = lambda p: F.coalesce(F.regexp_extract(meta["file_name"], p, 1).try_cast("long"), F.lit(0))
        # a writing task's files are numbered part-<task>-<id>.c<file>
        file, part = F.col("file").cast("string"), number(r"part-(\d+)") * 1_000_000 + number(r"\.c(\d+)\.")
    else:
        file, part = meta["file_path"], F.lit(0).cast("long")
    return df.select(file.alias("file"), part.alias("part"), meta["file_block_start"].alias("block"),
                     F.monotonically_increasing_id().alias("row"), meta["file_size"].alias("size"), F.col("value").alias("text"),
                     *[meta[m].alias(m) for m in also])


def carried(df: DataFrame, sums: dict[str, Column], order: Sequence[str] = ("row",)) -> DataFrame:
    """Adds for each name the sum of its value over all earlier rows of the file (0 for the first).

    One exchange by split, shared by the window and the totals; the totals are one row a split.
    """
    inside = Window.partitionBy(*SPLIT).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy("file").orderBy("part", "block").rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    here = df.withColumns({n: F.coalesce(F.sum(v).over(inside), zero) for n, v in sums.items()})
    totals = df.groupBy(*SPLIT).agg(*[F.sum(v).alias(f"_t_{n}") for n, v in sums.items()])
    offsets = totals.select(*SPLIT, *[F.coalesce(F.sum(f"_t_{n}").over(before), zero).alias(f"_o_{n}") for n in sums])
    out = here.join(offsets, SPLIT)
    return out.withColumns({n: F.col(n) + F.col(f"_o_{n}") for n in sums}).drop(*[f"_o_{n}" for n in sums])


def _name(raw: Column) -> Column:
    """The text of a JSON string without its quotes; most have nothing to unescape."""
    plain = raw.cast("string")
    return F.when(plain.rlike(r"[\\\x00-\x1f]"), F.from_json(F.concat(F.lit('["'), plain, F.lit('"]')), "array<string>")[0]).otherwise(plain)


def json_text(spark: SparkSession, path: str, sep: str) -> DataFrame:
    """(file, part, block, size, text) of the JSON under ``path``, cut at ``sep``: as a document has brackets (or
    commas) everywhere, rows are small and any split starts near its place, also in a file of one line."""
    return split_rows(spark, path, sep).select(*SPLIT, "size", "text")


def json_leaves(spark: SparkSession, path: str, depth: int, names: dict[str, int] | None = None,
                places: dict[str, int] | None = None) -> DataFrame:
    """S-16..S-20, S-26 from files: the scalars that lie inside ``depth`` brackets, one row each, however long
    their arrays or objects are -> (file, key, value, ...): ``value`` is text (a string without its quotes,
    NULL for null), ``key`` its name in an object (NULL in an array). ``names`` adds columns with the name
    of the enclosing bracket at a level (1 = outermost), ``places`` with the position (from 0) in the
    enclosing bracket at a level. The text is read three times and never exchanged; only one scalar has to fit in
    a row.
    """
    names, places = names or {}, places or {}
    rows = json_text(spark, path, ",")
    wanted = sorted({*names.values(), *places.values()})
    named, placed = sorted(set(names.values())), sorted(set(places.values()))
    at, _ = JS.starts(rows, ",", wanted)
    kinds = ", ".join(["file string, key binary", *[f"_k{k} binary" for k in named], *[f"_p{k} long" for k in placed], "value binary"])
    e = rows.mapInArrow(JS.scanner("leaves", ",", at, depth, wanted, named, placed), kinds).withColumn("value", F.col("value").cast("string"))
    value = F.when(F.startswith("value", F.lit('"')), _name(F.expr("substring(value, 2, length(value) - 2)"))) \
        .otherwise(F.nullif(F.col("value"), F.lit("null")))
    return e.select("file", _name(F.col("key")).alias("key"), *[F.col(f"_p{k}").alias(n) for n, k in places.items()],
                    *[_name(F.col(f"_k{k}")).alias(n) for n, k in names.items()], value.alias("value"))


def json_elements(spark: SparkSession, path: str, depth: int, names: dict[str, int] | None = None,
                  parents: dict[str, int] | None = None, shallow: bool = False) -> DataFrame:
    """S-15..S-26 from files: the objects that lie inside ``depth`` brackets -> (file, at, key, text, ...).

    ``at`` numbers the containers at that depth in a file, ``key`` is the object's name (NULL in an array),
    ``text`` its JSON for ``from_json``. ``names`` adds columns with the name of the enclosing bracket at a
    level (1 = outermost), e.g. a dynamic key above the object; ``parents`` adds the number of the
    enclosing bracket at a level, the ``at`` of the objects of depth level - 1. With ``shallow`` the text
    leaves out what lies in deeper brackets, so that the fields of an object that holds a large array are
    read without it. Only one object (without its inner arrays if ``shallow``) has to fit in a row.

    The text is read three times and never exchanged; only objects across the ends of splits are put together
    from their parts, at most two parts a split.
    """
    names, parents = names or {}, parents or {}
    rows = json_text(spark, path, "}")
    own, named, above = depth + 1, sorted(set(names.values())), sorted(set(parents.values()))
    wanted = sorted({own, *named, *above})
    at, ends = JS.starts(rows, "}", wanted, depth, shallow)
    kinds = ", ".join(["file string, at long, key binary", *[f"_n{k} long" for k in above], *[f"_k{k} binary" for k in named], "text binary"])
    e = rows.mapInArrow(JS.scanner("elements", "}", at, depth, wanted, named, (), above, shallow), kinds)
    if any(v["across"] for v in at.values()):
        parts = JS.across(ends, at, own, named, above).groupBy("file", "at").agg(
            F.sort_array(F.collect_list(F.struct("part", "block", "no", "text"))).alias("_p"),
            *[F.max(c).alias(c) for c in e.columns if c not in ("file", "at", "text")])
        joined = F.array_join(F.transform("_p", lambda x: x["text"].cast("string")), "").cast("binary")
        e = e.unionByName(parts.withColumn("text", joined).drop("_p"))
    return e.select("file", "at", _name(F.col("key")).alias("key"), *[F.col(f"_n{k}").alias(n) for n, k in parents.items()],
                    *[_name(F.col(f"_k{k}")).alias(n) for n, k in names.items()], F.col("text").cast("string").alias("text"))


def quoted_records(rows: DataFrame) -> DataFrame:
    """S-04 / S-13: physical lines (file, part, block, row, text) -> records (file, pos, line): a line break
    inside double quotes belongs to its field.

    A line starts a record where the number of quotes before it in the file is even; records are numbered
    and their lines joined, so a record may span splits and parts, and the file stays splittable.
    """
    q = rows.drop("size").withColumn("quotes", (F.length("text") - F.length(F.replace("text", F.lit('"'), F.lit("")))).cast("long"))
    q = carried(q, {"before": F.col("quotes")})
    starts = (F.col("before") % 2 == 0).cast("long")
    q = carried(q, {"pos": starts}).withColumn("pos", F.col("pos") + starts)
    one = q.where((F.col("before") % 2 == 0) & (F.col("quotes") % 2 == 0)).select("file", "pos", F.col("text").alias("line"))
    many = q.where((F.col("before") % 2 == 1) | (F.col("quotes") % 2 == 1)).groupBy("file", "pos").agg(
        F.sort_array(F.collect_list(F.struct("part", "block", "row", "text"))).alias("_l")) \
        .select("file", "pos", F.array_join(F.transform("_l", lambda x: x["text"]), "\n").alias("line"))
    return one.unionByName(many)


def by_header(lines: DataFrame, fields: Column, header: DataFrame, normal=None) -> DataFrame:
    """S-04 / S-06 / S-12: rows named by each file's own header.

    ``header`` has (file, pos, names): where the header stands and its fields; ``fields`` splits a line.
    Returns (file, pos, record), ``record`` a map from name to text, so that files with other columns, or
    the same in another order, come together; blank names and fields beyond the header are left out, the
    first of repeated names counts. ``normal`` maps a name to its normal form.
    """
    name = (lambda c: F.lower(F.trim(c))) if normal is None else normal
    h = header.select("file", F.col("pos").alias("_hdr"), F.transform("names", name).alias("_names"))
    body = lines.join(h, "file").where((F.col("pos") > F.col("_hdr")) & (F.trim("line") != "")).withColumn("_f", fields)
    body = body.withColumn("_f", F.slice("_f", 1, F.size("_names")))
    pairs = F.filter(F.arrays_zip("_names", "_f"), lambda p, i: (p["_names"] != "") & (i < F.size("_f")) &
                     (F.array_position("_names", p["_names"]) == i + 1))
    return body.select("file", "pos", F.map_from_entries(pairs).alias("record"))


def columns_of(records: DataFrame, names: Sequence[str], keep: Sequence[str] = ("file",)) -> DataFrame:
    """The named fields of ``record`` as columns; NULL in files that have no such column."""
    return records.select(*keep, *[F.trim(F.try_element_at("record", F.lit(n))).alias(n) for n in names])


def quoted_fields(line: Column, sep: str = ",") -> Column:
    """Fields of a record in one pass: a field in double quotes may hold separators, line breaks and doubled
    quotes; other fields are taken as they are."""
    field = rf'(?s)\Q{sep}\E(\s*+"[^"]*+(?:""[^"]*+)*+"\s*+(?=\Q{sep}\E|$)|(?:(?!\Q{sep}\E).)*+)'
    found = F.regexp_extract_all(F.concat(F.lit(sep), line), F.lit(field), F.lit(1))
    bare = lambda f: F.replace(F.regexp_replace(f, r'^\s*+"|"\s*+$', ""), F.lit('""'), F.lit('"'))
    return F.transform(found, lambda f: F.when(F.ltrim(f).startswith('"'), bare(f)).otherwise(f))


def xml_first(spark: SparkSession, path: str, between: str, schemas: dict[str, str]) -> DataFrame:
    """S-27 / S-28: (file, tag...): the first element of each tag of ``schemas`` in every file under ``path``, whatever
    text wraps the XML; NULL where there is none. A file is read by many tasks, as the text between two end tags
    ``between`` (a tag that the elements neither hold nor lie in, and that fills large files); only one text a file
    and tag is parsed."""
    r = split_rows(spark, path, f"</{between}>", holds=[f"<{t}" for t in schemas])
    bare = F.regexp_replace("text", r"(?s)<!--.*?-->", "")
    first = {t: F.nullif(F.regexp_extract(bare, rf"(?s)<{t}(?:\s[^>]*)?/>|<{t}(?:\s[^>]*)?>.*?</{t}>", 0), F.lit("")) for t in schemas}
    held = lambda t: F.contains("text", F.lit(f"<{t}"))
    r = r.select("file", F.struct("part", "block", "row").alias("pos"), *[F.when(held(t), c).alias(t) for t, c in first.items()])
    r = r.where(F.coalesce(*schemas).isNotNull())
    texts = r.groupBy("file").agg(*[F.min_by(t, F.when(F.col(t).isNotNull(), F.col("pos"))).alias(t) for t in schemas])
    return texts.select("file", *[F.from_xml(t, s).alias(t) for t, s in schemas.items()])


def xml_split_rows(spark: SparkSession, path: str, tag: str, schema: str) -> DataFrame:
    """Elements ``tag`` (not nested in each other) with their ``file`` and ``file_time``, each read from the
    text between two end tags: a large file is read by many tasks, in rows of one element. Compressed files are
    read by a task each, so a large one should be a folder ``file=<name>`` of parts, cut between elements."""
    opening = [f"<{tag}{c}" for c in "> \n\t\r\f\v/"]
    r = split_rows(spark, path, f"</{tag}>", holds=opening, also=["file_modification_time"])
    element = F.concat(F.regexp_extract("text", rf"(?s)<{tag}(?=[\s>/]).*$", 0), F.lit(f"</{tag}>"))
    return r.select("file", F.col("file_modification_time").alias("file_time"), F.from_xml(element, schema).alias("x")) \
        .select("x.*", "file", "file_time")


def filing_transactions(spark: SparkSession, path: str, name_date: str = r"(\d{8})[^/]*$") -> DataFrame:
    """S-27 / S-28 over landed ownership filings: one row per non-derivative transaction, read by its own
    tag, so that a filing is as many rows as it has transactions and is split among tasks. Issuer and first
    owner are found in a pass before over the same rows and kept as a table of a row a file: its size is known when
    the transactions are joined to it, so that they aren't exchanged while it is small. value = shares x price (NULL for a bad
    number); a missing or blank transaction date is that in the file's path (eight digits, found by ``name_date``), else the day the file was
    written."""
    value = "STRUCT<value: STRING>"
    t = xml_split_rows(spark, path, "nonDerivativeTransaction",
                       f"transactionDate {value}, transactionAmounts STRUCT<transactionShares: {value}, "
                       f"transactionPricePerShare: {value}, transactionAcquiredDisposedCode: {value}>")
    heads = xml_first(spark, path, "nonDerivativeTransaction", {
        "issuer": "issuerTradingSymbol STRING, issuerName STRING", "reportingOwner": "reportingOwnerId STRUCT<rptOwnerName: STRING>"})
    kept = scratch_path(spark, "filing-heads")
    heads.write.parquet(kept)
    heads = spark.read.parquet(kept)
    shares = F.trim("transactionAmounts.transactionShares.value").try_cast("double")
    price = F.trim("transactionAmounts.transactionPricePerShare.value").try_cast("double")
    name = F.try_to_date(F.regexp_extract("file", name_date, 1), "yyyyMMdd")
    date = F.coalesce(F.nullif(F.trim("transactionDate.value"), F.lit("")),
                      F.date_format(F.coalesce(name, F.to_date("file_time")), "yyyy-MM-dd"))
    return t.join(heads, "file", "left").select(
        "file", F.trim("issuer.issuerTradingSymbol").alias("ticker"), F.trim("issuer.issuerName").alias("issuer_name"),
        F.trim("reportingOwner.reportingOwnerId.rptOwnerName").alias("owner_name"), date.alias("transaction_date"), shares.alias("shares"),
        price.alias("price_per_share"), F.trim("transactionAmounts.transactionAcquiredDisposedCode.value").alias("acquired_disposed"),
        (shares * price).alias("transaction_value"))
