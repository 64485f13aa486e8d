"""Projection, cleaning and filter operators (P-01..P-22, F-01..F-09).

Schema-level helpers (name normalisation, column discovery) work on
``df.columns`` on the driver — metadata only, no data. Value-level helpers are
column expressions; bad input becomes NULL through ``try_*`` forms (ANSI mode).
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.plans import sequence as sq


# ---- schema-level (P-01..P-04, P-12, P-15, P-16) -----------------------------

def normalize_name(name: str, upper: bool = False) -> str:
    """P-01: strip, lower (or upper), spaces -> '_'."""
    n = re.sub(r"\s+", "_", name.strip())
    return n.upper() if upper else n.lower()


def normalize_columns(df: DataFrame, upper: bool = False) -> DataFrame:
    return df.toDF(*[normalize_name(c, upper) for c in df.columns])


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """P-02: rename by map (names may contain '>' / '<'); unknown keys ignored."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def keep_available(df: DataFrame, wanted: Sequence[str]) -> DataFrame:
    """P-03: select the wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in wanted if c in df.columns])


def find_column(df: DataFrame, *needles: str, exclude: Iterable[str] = ()) -> str | None:
    """P-04: first column whose lower-cased name contains every needle."""
    ex = set(exclude)
    for c in df.columns:
        if c not in ex and all(n.lower() in c.lower() for n in needles):
            return c
    return None


def add_prefix(df: DataFrame, prefix: str = "", suffix: str = "", exclude: Iterable[str] = ()) -> DataFrame:
    """P-12: prefix / suffix every column except ``exclude``."""
    ex = set(exclude)
    return df.toDF(*[c if c in ex else f"{prefix}{c}{suffix}" for c in df.columns])


def require_columns(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """P-16: raise when a required column is missing."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def numeric_share(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """P-15: share of all rows whose value casts to double, per column (one pass,
    one row); a missing value is no number. NULL for an empty table."""
    cols = list(cols or df.columns)
    return df.agg(*[F.try_divide(F.count(F.col(c).cast("string").try_cast("double")), F.count(F.lit(1))).alias(c) for c in cols])


def numeric_columns(df: DataFrame, threshold: float = 0.5, keep: Sequence[str] = ()) -> DataFrame:
    """P-15 applied: columns of a numeric type, and those where more than
    ``threshold`` of all rows parse, cast to double (one small action for the
    shares); ``keep`` columns stay as they are."""
    from pyspark.sql import types as T
    typed = [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    rest = [c for c in df.columns if c not in typed and c not in keep]
    shares = numeric_share(df, rest).first().asDict() if rest else {}
    chosen = [c for c in df.columns if c in typed or (shares.get(c) or 0) > threshold]
    return df.select(*keep, *[F.col(c).cast("string").try_cast("double").alias(c) for c in chosen if c not in keep])


# ---- value-level --------------------------------------------------------------

def to_number(c) -> Column:
    """P-05: numeric coercion, unparsable -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return col.cast("string").try_cast("double")


DATE_FORMATS = ("yyyy-MM-dd'T'HH:mm[:ss][.SSSSSSSSS][.SSSSSS][.SSS][XXX]", "yyyy-MM-dd HH:mm[:ss][.SSSSSS][.SSS][XXX]",
                "yyyy-MM-dd", "yyyyMMdd", "yyyyMM", "yyyy")
MONTH_FIRST = ("M/d/yyyy[ HH:mm][:ss]",)
DAY_FIRST = ("d/M/yyyy[ HH:mm][:ss]",)


def to_timestamp_any(c, formats: Sequence[str] = DATE_FORMATS, epoch: str | None = None,
                     day_first: bool | Column = False) -> Column:
    """P-06 / P-17: first format that parses wins; ``epoch='s'|'ms'`` reads numbers
    as Unix time. Dates with slashes are read month first, or day first; with a
    boolean a date that is none in this order is read in the other one, with a
    column (see :func:`day_order`) only in the column's order. Unparsable -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    s = F.trim(col.cast("string"))
    if epoch == "s":
        return F.timestamp_seconds(s.try_cast("long"))
    if epoch == "ms":
        return F.timestamp_millis(s.try_cast("long"))
    read = lambda fs: F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in fs])
    if isinstance(day_first, bool):
        return read((*formats, *(DAY_FIRST + MONTH_FIRST if day_first else MONTH_FIRST + DAY_FIRST)))
    return F.coalesce(read(formats), F.when(day_first, read(DAY_FIRST)).otherwise(read(MONTH_FIRST)))


def day_order(df: DataFrame, col: str, by: Sequence[str] = (), default: bool = False) -> DataFrame:
    """P-06: the order of day and month in dates with slashes, voted by the whole
    column, or by each group ``by`` (a file): (by..., day_first, votes_day, votes_month, decided).

    A first part over 12 votes for day first, a second part over 12 for month
    first; the larger number of votes wins. Without any vote, or with as many
    for both, ``decided`` is false and the order is ``default``. One aggregate
    with map-side partials, whose result is one row a group."""
    part = lambda i: F.regexp_extract(F.col(col).cast("string"), r"^\s*(\d{1,2})/(\d{1,2})/\d{4}", i).try_cast("int")
    votes = df.groupBy(*by).agg(F.count_if(part(1) > 12).alias("votes_day"), F.count_if(part(2) > 12).alias("votes_month"))
    d, m = F.col("votes_day"), F.col("votes_month")
    return votes.select(*by, F.when(d == m, F.lit(default)).otherwise(d > m).alias("day_first"), "votes_day", "votes_month",
                        (d != m).alias("decided"))


def parse_times(df: DataFrame, col: str, out: str, by: Sequence[str] = (), default: bool = False) -> DataFrame:
    """P-06 applied: ``out`` from the text column ``col`` in the voted order, and
    ``decided`` (false where the order is only the default)."""
    votes = day_order(df, col, by, default).select(*[F.col(b).alias(f"_{b}") for b in by], "day_first", "decided")
    on = F.lit(True)
    for b in by:
        on = on & df[b].eqNullSafe(votes[f"_{b}"])
    joined = df.join(votes if by else F.broadcast(votes), on, "left" if by else "cross")  # one row without groups
    return joined.withColumn(out, to_timestamp_any(col, day_first=F.col("day_first"))).drop("day_first", *[f"_{b}" for b in by])


def to_time_index(df: DataFrame, col: str = "date", out: str = "ts", sort: bool = False) -> DataFrame:
    """P-17: parse ``col`` to a UTC timestamp column ``out`` in the order of day and
    month that the column votes for (a column that is already a timestamp or date
    is only cast); with ``sort`` the rows are ordered
    by time (an export-edge total order; inside a pipeline order is by window)."""
    from pyspark.sql import types as T
    dt = df.schema[col].dataType
    if isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        ts = F.col(col).cast("timestamp")
    else:
        voted = parse_times(df, col, "_ts").drop("decided")
        res = voted.drop(col).withColumnRenamed("_ts", out) if out != col else voted.drop(col).withColumnRenamed("_ts", col)
        return res.orderBy(out) if sort else res
    res = df.withColumn(out, ts)
    if out != col:
        res = res.drop(col)
    return res.orderBy(out) if sort else res


def date_from_parts(year, month=None, day=None, year_end: bool = False) -> Column:
    """P-07: date from year[, month[, day]] (year-start, or year-end with
    ``year_end``); invalid month / day -> NULL."""
    y = F.col(year) if isinstance(year, str) else year
    if month is None:
        return F.make_date(y, F.lit(12 if year_end else 1), F.lit(31 if year_end else 1))
    m = F.col(month) if isinstance(month, str) else month
    d = F.lit(1) if day is None else (F.col(day) if isinstance(day, str) else day)
    ok = m.between(1, 12) & d.between(1, 31)
    return F.when(ok, F.try_to_date(F.format_string("%04d-%02d-%02d", y.cast("int"), m.cast("int"), d.cast("int")),
                                    "yyyy-MM-dd"))


def null_sentinels(c, sentinels: Sequence = (-999, -9999, -99.99, -9.99)) -> Column:
    """P-09: sentinel values (numbers or strings such as 'NaN', 'N/A', '.') -> NULL."""
    col = F.col(c) if isinstance(c, str) else c
    return F.when(~col.isin(*sentinels), col)


def percent_scale(df: DataFrame, cols: Sequence[str], mode: str = "auto", limit: float = 1.01) -> DataFrame:
    """P-11: ``mode='div'`` divides by 100; ``'auto'`` multiplies by 100 when the
    column maximum is <= ``limit`` (fractions). The maximum is a scalar
    subquery per column, evaluated once — no join."""
    out = {}
    for c in cols:
        if mode == "div":
            out[c] = F.col(c) / 100
        else:
            mx = df.select(F.max(c)).scalar()
            out[c] = F.when(mx <= limit, F.col(c) * 100).otherwise(F.col(c))
    return df.withColumns(out)


def first_non_empty(*cols, skip_zero: bool = False) -> Column:
    """P-14: first value that is not NULL / '' (and not 0 when ``skip_zero``,
    like Python ``a or b``). The columns' type is kept."""
    out = []
    for c in cols:
        col = F.col(c) if isinstance(c, str) else c
        text = col.cast("string")
        full = text != ""
        if skip_zero:
            full = full & F.coalesce(text.try_cast("double") != 0, F.lit(True))
        out.append(F.when(full, col))
    return F.coalesce(*out)


def safe_ratio(a, b) -> Column:
    """P-18: a / b, NULL when b is 0 or NULL."""
    return F.try_divide(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b)


def row_sum_min_count(*cols) -> Column:
    """P-19: row-wise sum when at least one value is present (pandas min_count=1)."""
    cs = [F.col(c) if isinstance(c, str) else c for c in cols]
    any_present = F.lit(False)
    for c in cs:
        any_present = any_present | c.isNotNull()
    total = F.lit(0.0)
    for c in cs:
        total = total + F.coalesce(c, F.lit(0.0))
    return F.when(any_present, total)


def pct_change_guarded(df: DataFrame, x: str, key="asset", ts="ts", out=None, digits=4,
                       chunk_rows=sq.DEFAULT_CHUNK_ROWS) -> DataFrame:
    """P-20: (x / prev - 1) * 100 with prev > 0, rounded like pandas ``round``
    (half-to-even on the binary value scaled by 10^digits); per series."""
    from ledgerline.operators.features import on_series
    out = out or f"{x}_change_pct"

    def build(d):
        prev = F.lag(x, 1).over(sq.chunk_window(key))
        scale = float(10 ** digits)
        change = (F.col(x) / prev - 1) * 100
        return d.withColumn(out, F.when(prev > 0, F.bround(change * scale, 0) / scale))
    return on_series(df, key, [ts], build, back=1, chunk_rows=chunk_rows)


def flat_ohlc(df: DataFrame, close: str = "close") -> DataFrame:
    """P-21: open = high = low = close when only a close is known."""
    return df.withColumns({"open": F.col(close), "high": F.col(close), "low": F.col(close)})


def truncate_text(c, n: int) -> Column:
    """P-22: first n characters, NULL -> ''."""
    col = F.col(c) if isinstance(c, str) else c
    return F.coalesce(F.substring(col, 1, n), F.lit(""))


# ---- filters (F-03..F-09) ----------------------------------------------------

def contains_ci(c, needle: str, regex: bool = False) -> Column:
    """F-03: case-insensitive match; literal by default, Java regex with ``regex``."""
    col = F.upper(F.col(c) if isinstance(c, str) else c)
    if regex:
        return col.rlike("(?i)" + needle)
    return col.contains(needle.upper())


def any_prefix(arr, prefixes: Sequence[str]) -> Column:
    """F-04: any array element starts with any of the prefixes."""
    a = F.col(arr) if isinstance(arr, str) else arr

    def test(t):
        out = F.lit(False)
        for p in prefixes:
            out = out | t.startswith(p)
        return out
    return F.exists(a, test)


def business_day(d) -> Column:
    """F-06: Monday..Friday."""
    col = F.col(d) if isinstance(d, str) else d
    return F.weekday(col) < 5


def min_history(df: DataFrame, key: str | Sequence[str], min_rows: int) -> DataFrame:
    """F-07 / S-01: keep series with at least ``min_rows`` rows. Counting is an
    aggregate (partial on the map side) and the keep is a semi join — not a
    per-series window."""
    key = [key] if isinstance(key, str) else list(key)
    ok = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_rows)
    return df.join(ok.select(*key), on=key, how="left_semi")


def complete_cases(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """F-09: rows with every listed column present."""
    return df.na.drop(how="any", subset=list(cols))
