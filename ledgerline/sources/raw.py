"""Parsers for landed raw text files (S-04..S-14).

Readers return a line table ``(file, pos, line)``; parsers take such a table
(or any DataFrame with those columns) and return typed rows. Everything is
column expressions plus per-file aggregates (header position, delimiter) joined
back; no Python loop over lines and no per-file collect.

``pos`` only orders the lines of a file. :func:`read_lines` takes it from the
place of the split in the file and the order of reading inside the split, so a
large file is read by many tasks and never held in one row. Sources without a
preamble can use :func:`read_delimited`, Spark's CSV reader.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LINE = "line"
POS = "pos"
FILE = "file"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """Files -> (file, pos, line); CRLF or LF endings. ``pos`` = (split offset, row
    number inside the task): a file's lines in order, from splittable reading."""
    pos = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select(F.col("_metadata.file_path").alias(FILE), pos.alias(POS), F.col("value").alias(LINE))


def land_lines(lines: DataFrame, path: str) -> None:
    """Write a line table as text files: a folder ``file=<name>`` of ordered parts
    per file, so that a large file is written by several tasks."""
    (lines.repartitionByRange(FILE, POS).sortWithinPartitions(FILE, POS).select(FILE, LINE)
          .write.partitionBy(FILE).text(path))


def read_landed(spark: SparkSession, path: str) -> DataFrame:
    """The line table of a folder written by :func:`land_lines`."""
    part = F.regexp_extract(F.col("_metadata.file_name"), r"part-(\d+)", 1).cast("long")
    pos = F.struct(part.alias("part"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("row"))
    return spark.read.text(path).select(F.col(FILE).cast("string").alias(FILE), pos.alias(POS),
                                        F.col("value").alias(LINE))


def read_delimited(spark: SparkSession, path: str, names: Sequence[str], sep: str = ",", comment: str | None = None,
                   header: bool = False, missing: str | None = None) -> DataFrame:
    """S-05 / S-13: Spark's CSV reader with text columns ``names``: comment lines
    dropped, quoted fields, ``missing`` as NULL."""
    r = spark.read.schema(", ".join(f"`{n}` string" for n in names)).option("sep", sep).option("header", header)
    r = r.option("comment", comment) if comment else r
    r = r.option("nullValue", missing) if missing is not None else r
    return r.csv(path).select(*[f"`{n}`" for n in names])


def split_quoted(line: Column, sep: str = ",") -> Column:
    """Fields of a delimited line: a separator inside double quotes doesn't split;
    surrounding quotes are dropped, a doubled quote is one."""
    fields = F.split(line, "\\Q" + sep + "\\E" + r'(?=(?:[^"]*+"[^"]*+")*+[^"]*+$)')
    bare = lambda f: F.regexp_replace(F.regexp_replace(f, r'^\s*"|"\s*$', ""), '""', '"')
    return F.transform(fields, lambda f: F.when(F.contains(f, F.lit('"')), bare(f)).otherwise(f))


def after_first_line(lines: DataFrame) -> DataFrame:
    """Lines without the first of each file (its header)."""
    first = lines.groupBy(FILE).agg(F.min(POS).alias("_first"))
    return lines.join(first, FILE).filter(F.col(POS) > F.col("_first")).drop("_first")


def file_stem(file: Column) -> Column:
    """File name without directory and extension (the series id of a file)."""
    return F.regexp_extract(file, r"([^/]+?)(\.[^./]*)?$", 1)


# ---- S-04 preamble CSV ---------------------------------------------------------

def header_positions(lines: DataFrame, is_header: Column, stop_at_blank: bool = True) -> DataFrame:
    """Per file: position of the first header line and of the first blank line
    after it (exclusive end of the table). Small: one row per file."""
    hdr = lines.filter(is_header).groupBy(FILE).agg(F.min(POS).alias("_hdr"))
    if not stop_at_blank:
        return hdr.withColumn("_end", F.lit(None).cast(lines.schema[POS].dataType))
    blanks = lines.filter(F.trim(F.col(LINE)) == "").select(FILE, F.col(POS).alias("_b"))
    ends = blanks.join(hdr, FILE).filter(F.col("_b") > F.col("_hdr")).groupBy(FILE).agg(F.min("_b").alias("_end"))
    return hdr.join(ends, FILE, "left")


def csv_after_header(lines: DataFrame, is_header: Column, names: Sequence[str], sep: str = ",",
                     stop_at_blank: bool = True) -> DataFrame:
    """S-04: drop everything before the header line (found by ``is_header``),
    stop at the first blank line after it, split fields and name them
    positionally with ``names``; all values stay text (cast downstream)."""
    bounds = header_positions(lines, is_header, stop_at_blank)
    body = lines.join(bounds, FILE).filter((F.col(POS) > F.col("_hdr")) &
                                           (F.col("_end").isNull() | (F.col(POS) < F.col("_end"))))
    body = body.filter(F.trim(F.col(LINE)) != "")
    parts = split_quoted(F.col(LINE), sep)
    return body.select(FILE, POS, *[F.trim(F.try_element_at(parts, F.lit(i + 1))).alias(n) for i, n in enumerate(names)])


def drop_comments(lines: DataFrame, marker: str = "#") -> DataFrame:
    """S-05: drop comment lines (the file-reader form is CSV option ``comment``)."""
    return lines.filter(~F.ltrim(F.col(LINE)).startswith(marker))


def sniff_delimiter(lines: DataFrame, candidates: Sequence[str] = (";", ",")) -> DataFrame:
    """S-06: per file, the candidate occurring most on the header line, the first
    line that is left and not blank (first candidate on ties) -> (file, delim, _hdr)."""
    hdr = (lines.filter(F.trim(F.col(LINE)) != "").groupBy(FILE)
                .agg(F.min(POS).alias("_hdr"), F.min_by(LINE, POS).alias(LINE)))
    scored = [F.struct((F.size(F.split(F.col(LINE), "\\Q" + c + "\\E")) - 1).alias("n"),
                       F.lit(-i).alias("rank"), F.lit(c).alias("c")) for i, c in enumerate(candidates)]
    return hdr.select(FILE, F.greatest(*scored)["c"].alias("delim"), "_hdr")


def split_by_file_delimiter(lines: DataFrame, names: Sequence[str],
                            candidates: Sequence[str] = (";", ",")) -> DataFrame:
    """S-06 applied: split every data line by its file's sniffed delimiter."""
    d = sniff_delimiter(lines, candidates)
    body = lines.join(d, FILE).filter((F.col(POS) > F.col("_hdr")) & (F.trim(F.col(LINE)) != ""))
    pattern = F.concat(F.lit("\\Q"), F.col("delim"), F.lit("\\E"))
    parts = F.split(F.col(LINE), pattern)
    return body.select(FILE, POS, *[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)])


# ---- S-07 series CSV ------------------------------------------------------------

def series_csv(lines: DataFrame, missing: Sequence[str] = (".", "", "NA")) -> DataFrame:
    """S-07: ``date,value`` lines after a header; '.', blank and 'NA' are
    missing; the series id is the file stem."""
    body = after_first_line(lines).filter(F.trim(F.col(LINE)) != "")
    parts = F.split(F.col(LINE), ",")
    raw = F.trim(F.try_element_at(parts, F.lit(2)))
    value = F.when(~raw.isin(*missing), raw.try_cast("double"))
    return body.select(file_stem(F.col(FILE)).alias("series_id"),
                       F.try_to_timestamp(F.trim(parts[0]), F.lit("yyyy-MM-dd")).alias("ts"), value.alias("value"))


# ---- S-08 / S-09 index files ----------------------------------------------------

# The character offsets of the public form index
FORM4_COLUMNS = (("form", 0, 12), ("company", 12, 74), ("cik", 74, 86), ("date_filed", 86, 98), ("filename", 98, None))


def fixed_width(lines: DataFrame, columns=FORM4_COLUMNS, after_marker: str = "---",
                forms: Sequence[str] | None = ("4", "4/A")) -> DataFrame:
    """S-08: fixed-width columns (name, start, end) of the lines after the first
    line starting with ``after_marker``; optional form filter."""
    marker = lines.filter(F.col(LINE).startswith(after_marker)).groupBy(FILE).agg(F.min(POS).alias("_m"))
    body = lines.join(marker, FILE).filter(F.col(POS) > F.col("_m")).filter(F.trim(F.col(LINE)) != "")
    cols = []
    for name, start, end in columns:
        length = F.lit(end - start) if end is not None else F.length(LINE)
        cols.append(F.trim(F.col(LINE).substr(F.lit(start + 1), length)).alias(name))
    out = body.select(FILE, POS, *cols)
    return out.filter(F.col("form").isin(*forms)) if forms else out


def multi_space(lines: DataFrame, names: Sequence[str], form: str = "4", date_col: str = "date_filed",
                start: str | None = None, end: str | None = None, cap: int | None = None) -> DataFrame:
    """S-09: fields separated by 2+ spaces; keep one form, a date range and
    optionally the first ``cap`` rows by (date, position)."""
    parts = F.split(F.trim(F.col(LINE)), " {2,}")
    out = lines.select(FILE, POS, *[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)])
    out = out.filter(F.col("form") == form)
    d = F.try_to_date(F.col(date_col), "yyyy-MM-dd")
    if start:
        out = out.filter(d >= F.lit(start).cast("date"))
    if end:
        out = out.filter(d <= F.lit(end).cast("date"))
    if cap:
        out = out.orderBy(date_col, FILE, POS).limit(cap)
    return out


# ---- S-10 / S-11 whitespace tables ----------------------------------------------

def coded_monthly(lines: DataFrame, missing: Sequence[float] = (-99.99, -9.99)) -> DataFrame:
    """S-10: ``CCCDDEEYYYY`` code + 12 monthly values per line -> 12 rows.
    Code = 3-digit division, 2-digit element, 4-digit year (last 4 chars)."""
    parts = F.split(F.trim(F.col(LINE)), r"\s+")
    code = parts[0]
    base = lines.filter(F.trim(F.col(LINE)) != "").select(
        F.substring(code, 1, 3).alias("division"), F.substring(code, -4, 4).try_cast("int").alias("year"),
        F.posexplode(F.slice(parts, 2, 12)).alias("_m", "_v"))
    v = F.col("_v").try_cast("double")
    return base.select("division", "year", (F.col("_m") + 1).alias("month"),
                       F.make_date("year", (F.col("_m") + 1).cast("int"), F.lit(1)).alias("date"),
                       F.when(~v.isin(*missing), v).alias("value"))


def whitespace_table(lines: DataFrame, names: Sequence[str], negative_missing: Sequence[str] = ()) -> DataFrame:
    """S-11: whitespace-separated columns; listed columns < 0 become missing."""
    parts = F.split(F.trim(F.col(LINE)), r"\s+")
    out = lines.filter(F.trim(F.col(LINE)) != "").select(
        *[F.try_element_at(parts, F.lit(i + 1)).try_cast("double").alias(n) for i, n in enumerate(names)])
    return out.withColumns({c: F.when(F.col(c) >= 0, F.col(c)) for c in negative_missing})


# ---- S-12 / S-13 delimited ------------------------------------------------------

def pipe_file(lines: DataFrame, names: Sequence[str], date_col: str = "date",
              file_date_pattern: str = r"(\d{8})") -> DataFrame:
    """S-12: '|' delimited with a header; blank rows and trailer rows (first field
    not a date) dropped; a missing date is taken from the file name."""
    parts = F.split(F.col(LINE), r"\|")
    body = after_first_line(lines).filter(F.trim(F.col(LINE)) != "")
    out = body.select(FILE, *[F.trim(F.try_element_at(parts, F.lit(i + 1))).alias(n) for i, n in enumerate(names)])
    from_name = F.try_to_date(F.regexp_extract(F.col(FILE), file_date_pattern, 1), "yyyyMMdd")
    d = F.try_to_date(F.nullif(F.col(date_col), F.lit("")), "yyyyMMdd")
    trailer = F.col(date_col).isNotNull() & (F.col(date_col) != "") & d.isNull()
    return out.filter(~trailer).withColumn(date_col, F.coalesce(d, from_name))


def positional_csv(lines: DataFrame, index_map: dict[int, str], min_fields: int) -> DataFrame:
    """S-13: headerless CSV; fields picked by 0-based index into named columns,
    surrounding quotes stripped, rows with fewer than ``min_fields`` skipped."""
    parts = split_quoted(F.col(LINE))
    body = lines.filter(F.size(parts) >= min_fields)
    return body.select(*[F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in sorted(index_map.items())])


# ---- S-14 tab events with sub-delimited fields ------------------------------------

def tab_events(lines: DataFrame, min_fields: int = 16) -> DataFrame:
    """S-14: tab-separated event rows: date = first 8 chars of field 1, country =
    field 3, themes = non-empty items of field 7 split by ';', tone = first
    comma item of field 15 as double; short or undated rows, and rows without a
    number as tone, dropped."""
    f = F.split(F.col(LINE), "\t")
    ok = lines.filter(F.size(f) >= min_fields)
    out = ok.select(F.try_to_date(F.substring(f[1], 1, 8), "yyyyMMdd").alias("date"),
                    F.trim(f[3]).alias("country"),
                    F.filter(F.split(f[7], ";"), lambda t: t != "").alias("themes"),
                    F.split(f[15], ",")[0].try_cast("double").alias("avg_tone"))
    return out.filter(F.col("date").isNotNull() & F.col("avg_tone").isNotNull())
