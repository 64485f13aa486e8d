"""Per-series ordered computation that does not put one series in one task.

Every time-series operator in the library is a window over one series
(``partitionBy(asset).orderBy(ts)``). Written naively that window sends a whole
series to one task, and a hot asset that holds a third of all rows would then
run on one core. The helpers here split a series into fixed-size row chunks:

* :func:`with_row_index` gives every row its 0-based position ``rn`` in its
  series and the series length ``n`` without a per-series window: rows are counted
  per (key, time bucket), the counts are prefix-summed on that small table, and
  rows are numbered inside their (key, bucket).
* :func:`with_halo` assigns rows to chunks of ``chunk_rows`` consecutive
  positions and copies the last ``back`` rows of each chunk into the next one
  (and the first ``fwd`` rows into the previous one). Any window whose frame
  reaches at most ``back`` rows back and ``fwd`` rows ahead is then exact when
  evaluated with ``partitionBy(key, chunk)``; :func:`home_rows` drops the copies.
* :func:`chunk_carries` is the two-level scan for unbounded-preceding frames
  (running product / max / sum): a per-chunk aggregate, a prefix over the
  small chunk table, joined back once before the caller's windows.
* :func:`ewm` evaluates the linear recurrence of an exponentially weighted
  mean inside the chunk layout (64-row sub-chunks plus a truncated carry).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import cut_lineage

RN = "rn"          # 0-based position of the row in its series
N = "n"            # rows in the series
CHUNK = "_chunk"   # chunk id (rn // chunk_rows) the row is evaluated in
HOME = "_home"     # False for halo copies
SUB = 64           # EWM sub-chunk length (beta**-63 stays far from overflow)

DEFAULT_CHUNK_ROWS = 1 << 20
BUCKET_SECONDS = 86_400   # time bucket of the row index
BUCKET_STEPS = 4_096      # the same for a whole-number order column


def _cols(x: str | Sequence[str]) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def with_row_index(df: DataFrame, key: str | Sequence[str], order: Sequence[str | Column],
                   num_ranges: int | None = None, materialize: bool = True) -> DataFrame:
    """Add ``rn`` (0-based position in the series) and ``n`` (series length).

    ``order`` must be a total order inside each key (add a tie-break column).
    If it starts with a time or whole-number column, the index is a plain query
    (:func:`_bucket_index`): nothing runs while it is built, unused columns are
    pruned and filters pass. Any other order is range-partitioned, numbered and
    checkpointed into the shared checkpoint folder, so that the sampled bounds —
    and therefore the numbering — are fixed for every consumer.
    """
    key = _cols(key)
    df = df.drop(*[c for c in (RN, N, CHUNK, HOME) if c in df.columns])   # an earlier index is replaced
    bucket = _bucket(df, order[0])
    if bucket is not None and num_ranges is None:
        return _bucket_index(df, key, order, bucket)
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    spark = df.sparkSession
    n_parts = num_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (df.repartitionByRange(n_parts, *[F.col(k) for k in key], *order_cols)
                .sortWithinPartitions(*[F.col(k) for k in key], *order_cols)
                .withColumn("_mid", F.monotonically_increasing_id()))
    if materialize:
        ranged = cut_lineage(ranged)
    # monotonically_increasing_id = partition_id << 33 | position in partition
    ranged = ranged.withColumn("_pid", F.shiftright(F.col("_mid"), 33))
    blocks = (ranged.groupBy(*key, "_pid")
                    .agg(F.min("_mid").alias("_b0"), F.count(F.lit(1)).alias("_bn")))
    w = Window.partitionBy(*key).orderBy("_pid")
    blocks = (blocks
              .withColumn("_off", F.coalesce(F.sum("_bn").over(
                  w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
              .withColumn(N, F.sum("_bn").over(Window.partitionBy(*key)))
              .drop("_bn"))
    # blocks has at most (#keys + #partitions) rows; AQE broadcasts it when its
    # measured size is under the adaptive threshold, else it is a shuffle join.
    out = ranged.join(blocks, on=[*key, "_pid"], how="inner")
    out = out.withColumn(RN, F.col("_off") + F.col("_mid") - F.col("_b0"))
    return out.drop("_mid", "_pid", "_b0", "_off")


def _bucket(df: DataFrame, col) -> Column | None:
    """Bucket number of the first order column, increasing with it (NULLs first)."""
    if not isinstance(col, str):
        return None
    kind, c = df.schema[col].dataType, F.col(col)
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        b = F.floor(F.unix_seconds(c.cast("timestamp")) / BUCKET_SECONDS)
    elif isinstance(kind, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        b = F.floor(c / BUCKET_STEPS)
    else:
        return None
    return F.coalesce(b, F.lit(-(1 << 60)))


def _bucket_index(df: DataFrame, key: list[str], order: Sequence[str | Column], bucket: Column) -> DataFrame:
    """Rows per (key, bucket), prefix-summed over the buckets of a key (a table far
    smaller than the rows), plus the row's number inside its (key, bucket)."""
    df = df.withColumn("_bkt", bucket)
    sizes = df.groupBy(*key, "_bkt").agg(F.count(F.lit(1)).alias("_bn"))
    w = Window.partitionBy(*key).orderBy("_bkt")
    sizes = sizes.select(*key, "_bkt",
                         F.coalesce(F.sum("_bn").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"),
                         F.sum("_bn").over(Window.partitionBy(*key)).alias(N))
    own = Window.partitionBy(*key, "_bkt").orderBy(*[F.col(o) if isinstance(o, str) else o for o in order])
    out = df.withColumn(RN, F.row_number().over(own) - 1).join(sizes, [*key, "_bkt"])
    return out.withColumn(RN, F.col(RN) + F.col("_off")).drop("_bkt", "_off")


def with_halo(df: DataFrame, back: int, fwd: int = 0,
              chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Assign ``_chunk`` and duplicate boundary rows into neighbouring chunks.

    Requires ``rn``. ``back``/``fwd`` are the largest look-back / look-ahead (in
    rows) of the windows evaluated afterwards. ``chunk_rows`` is rounded up to
    a multiple of :data:`SUB` so EWM sub-chunks never straddle a chunk edge.
    """
    chunk_rows = max(chunk_rows, back + 1, fwd + 1)
    chunk_rows = int(math.ceil(chunk_rows / SUB) * SUB)
    c = F.floor(F.col(RN) / chunk_rows)
    p = F.col(RN) - c * chunk_rows
    copies = F.array(
        F.struct(c.alias(CHUNK), F.lit(True).alias(HOME)),
        F.when(p >= chunk_rows - back, F.struct((c + 1).alias(CHUNK), F.lit(False).alias(HOME))),
        F.when((p < fwd) & (c > 0), F.struct((c - 1).alias(CHUNK), F.lit(False).alias(HOME))),
    )
    copies = F.filter(copies, lambda s: s.isNotNull())
    keep = [F.col(c) for c in df.columns]
    return df.select(*keep, F.inline(copies))


def home_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col(HOME)).drop(HOME, CHUNK)


_SPECS: dict = {}


def chunk_window(key: str | Sequence[str], frame: tuple[int, int] | None = None):
    """Window spec over one chunk of one series, in series order (optionally with
    a row frame). Specs are reused: every expression over the same spec would
    otherwise rebuild it through the Python-JVM bridge."""
    from pyspark import SparkContext
    k = (id(SparkContext._active_spark_context), tuple(_cols(key)), frame)
    spec = _SPECS.get(k)
    if spec is None:
        spec = Window.partitionBy(*_cols(key), CHUNK).orderBy(RN)
        if frame is not None:
            spec = spec.rowsBetween(*frame)
        _SPECS[k] = spec
    return spec


def rolling(agg: Column, key: str | Sequence[str], rows: int) -> Column:
    """``agg`` over the trailing ``rows`` rows (current included) in chunk layout."""
    return agg.over(chunk_window(key, (-(rows - 1), 0)))


def full_rolling(agg: Column, x: Column, key: str | Sequence[str], rows: int) -> Column:
    """Rolling aggregate that is NULL until ``rows`` non-null values fill the frame
    (pandas ``rolling(rows)`` with ``min_periods = rows``)."""
    return F.when(rolling(F.count(x), key, rows) == F.lit(rows), rolling(agg, key, rows))


def ewm_halo(span: float, tol: float = 1e-17) -> int:
    """Rows of look-back the chunked EWM needs for a relative error below ``tol``."""
    return SUB * _ewm_k(span, tol)


def _ewm_k(span: float, tol: float = 1e-17) -> int:
    alpha = 2.0 / (span + 1.0)
    beta = 1.0 - alpha
    if beta <= 0.0:
        return 1
    return int(math.ceil(math.log(tol) / (SUB * math.log(beta)))) + 1


def ewm(df: DataFrame, x: str, out: str, span: float, key: str | Sequence[str],
        adjust: bool = False, first_rn: Column | None = None) -> DataFrame:
    """Exponentially weighted mean of column ``x`` per series (chunk layout).

    ``adjust=False``: y_0 = x_0, y_t = a*x_t + (1-a)*y_{t-1}, a = 2/(span+1).
    ``adjust=True``:  y_t = sum_i b^i x_{t-i} / sum_i b^i over the series so far.
    ``x`` must be non-null from ``first_rn`` (default 0) on; rows before
    ``first_rn`` get NULL. Requires ``with_halo(back >= ewm_halo(span))``.
    """
    return ewm_many(df, [(x, out, span)], key, adjust=adjust, first_rn=first_rn)


def ewm_many(df: DataFrame, specs: Sequence[tuple[str, str, float]], key: str | Sequence[str],
             adjust: bool = False, first_rn: Column | None = None) -> DataFrame:
    """Several independent EWMs (``(x, out, span)``) in one sub-chunk pass and one
    chunk pass, so they share two sorts.

    With u the per-row input, y_t = sum_{i<=t} b^(t-i) u_i. Rows are grouped in
    64-row sub-chunks s: ``loc`` is the sum inside the sub-chunk (a window sum
    of u*b^-p scaled by b^p), E_s the value of ``loc`` at the sub-chunk's end,
    and the carry from earlier sub-chunks sum_j b^(64(j-1)) E_(s-j) is read
    with ``lag(E, 64*j)`` — the row at the same offset j sub-chunks back.
    """
    key = _cols(key)
    start = first_rn if first_rn is not None else F.lit(0)
    rel = F.col(RN) - start                         # position since the series start
    sub = F.floor(F.col(RN) / SUB)
    p = F.col(RN) - sub * SUB
    w_sub = Window.partitionBy(*key, CHUNK, sub).orderBy(RN)
    locs, ends, finals = {}, {}, {}
    for x, out, span in specs:
        alpha = 2.0 / (span + 1.0)
        beta = 1.0 - alpha
        xv = F.col(x)
        if beta == 0.0:
            finals[out] = F.when(rel >= 0, xv)
            continue
        u = xv if adjust else F.when(rel == 0, xv).otherwise(F.lit(alpha) * xv)
        u_valid = F.when(rel >= 0, u).otherwise(F.lit(0.0))
        locs[f"_loc_{out}"] = F.pow(F.lit(beta), p) * F.sum(u_valid * F.pow(F.lit(beta), -p)).over(
            w_sub.rowsBetween(Window.unboundedPreceding, 0))
        ends[f"_end_{out}"] = F.last(f"_loc_{out}").over(
            w_sub.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    for x, out, span in specs:
        if f"_loc_{out}" not in locs:
            continue
        beta = 1.0 - 2.0 / (span + 1.0)
        # one SQL expression for the K lag terms: parsed JVM-side in a single call
        over = "OVER (PARTITION BY " + ", ".join(f"`{k}`" for k in key) + f", `{CHUNK}` ORDER BY `{RN}`)"
        terms = [f"CAST('{beta ** (SUB * (j - 1))!r}' AS DOUBLE) * coalesce(lag(`_end_{out}`, {SUB * j}) {over}, 0D)"
                 for j in range(1, _ewm_k(span) + 1)]
        carry = F.expr(" + ".join(terms))
        y = F.col(f"_loc_{out}") + F.pow(F.lit(beta), p + 1) * carry
        if adjust:
            # divide by sum_{i<=rel} b^i = (1 - b^(rel+1)) / (1 - b)
            y = y * F.lit(1.0 - beta) / (F.lit(1.0) - F.pow(F.lit(beta), rel + 1))
        finals[out] = F.when(rel >= 0, y)
    if locs:
        df = df.withColumns(locs).withColumns(ends)
    df = df.withColumns(finals)
    return df.drop(*locs.keys(), *ends.keys()) if locs else df


#: A run of missing values is spread over rows in stretches of this many.
RUN = 1 << 16


def ewm_gaps(indexed: DataFrame, x: str, spans: dict[str, float], key: str | Sequence[str], adjust: bool = False,
             chunk_rows: int = DEFAULT_CHUNK_ROWS) -> DataFrame:
    """Exponentially weighted means (``spans``: column name -> span) of a column with
    missing values, added to ``indexed`` (rows with ``rn`` and ``n``).

    Weights go by position, so an older value loses weight over missing rows too;
    a missing row repeats the last mean, rows before the first value get NULL.
    The step at the observation after a gap of g rows is ``S = k S + u, W = k W + w``
    and the mean S / W, with d = b^g: k = d, u = x, w = 1 (``adjust``) or
    k = d / (d + a), u = (1 - k) x, w = 1 - k. Observations are folded in arrays of
    64, the few arrays before (``k`` is at most b, so older ones don't count) are
    folded by their totals: no product ever has to be divided out, however long a gap.
    """
    key = _cols(key)
    seen = indexed.filter(F.col(x).isNotNull() & ~F.isnan(x)).select(
        *key, F.col(RN).alias("_row"), F.col(N).alias("_rows"), F.col(x).cast("double").alias("_x"))
    obs = with_halo(with_row_index(seen, key, ["_row"]), back=1, fwd=1, chunk_rows=chunk_rows)
    w = chunk_window(key)
    obs = home_rows(obs.withColumn("_gap", F.col("_row") - F.lag("_row").over(w))
                    .withColumn("_next", F.coalesce(F.lead("_row").over(w), F.col("_rows"))))
    steps = []
    for span in spans.values():
        alpha = 2.0 / (span + 1.0)
        d = F.when(F.col("_gap").isNotNull(), F.pow(F.lit(1.0 - alpha), F.col("_gap"))).otherwise(0.0)
        k = d if adjust else d / (d + F.lit(alpha))
        share = F.lit(1.0) if adjust else F.lit(1.0) - k
        steps.append(F.struct(k.alias("k"), (share * F.col("_x")).alias("u"), share.alias("w")))
    folds = obs.groupBy(*key, F.floor(F.col(RN) / SUB).alias(RN)).agg(F.sort_array(F.collect_list(
        F.struct(F.col("_row").alias("row"), F.col("_next").alias("next"), F.array(*steps).alias("steps")))).alias("_obs"))
    names, kind = list(spans), "struct<s: double, w: double, d: double>"

    def states(i: int) -> Column:   # S, W and the product of k after each observation of an array
        def after(acc, o):
            e, last = o["steps"][i], F.try_element_at(acc, F.lit(-1))
            return F.concat(acc, F.array(F.struct(
                (F.coalesce(last["s"], F.lit(0.0)) * e["k"] + e["u"]).alias("s"),
                (F.coalesce(last["w"], F.lit(0.0)) * e["k"] + e["w"]).alias("w"),
                (F.coalesce(last["d"], F.lit(1.0)) * e["k"]).alias("d"))))
        return F.aggregate("_obs", F.array().cast(f"array<{kind}>"), after).alias(f"_run_{i}")

    def means(i: int) -> Column:
        b = F.col(f"_before_{i}")
        return F.transform(f"_run_{i}", lambda r: (r["s"] + r["d"] * b["s"]) / (r["w"] + r["d"] * b["w"])).alias(names[i])

    which = range(len(names))
    laid = with_halo(folds.select(*key, RN, F.transform("_obs", lambda o: F.struct(o["row"].alias("row"), o["next"].alias("next")))
                                  .alias("_at"), *map(states, which)),
                     back=max(map(_ewm_k, spans.values())), chunk_rows=max(SUB, chunk_rows // SUB))
    before = []
    for i in which:
        ends = F.collect_list(F.element_at(f"_run_{i}", -1)).over(chunk_window(key, (-_ewm_k(spans[names[i]]), -1)))
        before.append(F.aggregate(ends, F.struct(F.lit(0.0).alias("s"), F.lit(0.0).alias("w")), lambda a, e: F.struct(
            (a["s"] * e["d"] + e["s"]).alias("s"), (a["w"] * e["d"] + e["w"]).alias("w"))).alias(f"_before_{i}"))
    folded = home_rows(laid.select("*", *before))
    keys = {k: f"_key_{i}" for i, k in enumerate(key)}
    flat = folded.select(*[F.col(k).alias(v) for k, v in keys.items()], "_at", *map(means, which))
    flat = flat.select(*keys.values(), F.inline(F.arrays_zip("_at", *names)))
    flat = flat.select(*keys.values(), *names, F.col("_at.next").alias("_next"), F.explode(
        F.sequence(F.col("_at.row"), F.col("_at.next") - 1, F.lit(RUN).cast("long"))).alias("_from"))
    flat = flat.select(*keys.values(), *names, F.explode(F.sequence(
        F.col("_from"), F.least(F.col("_from") + (RUN - 1), F.col("_next") - 1))).alias("_row"))
    on = F.col(RN) == F.col("_row")
    for k, v in keys.items():
        on = on & F.col(k).eqNullSafe(F.col(v))
    return indexed.join(flat, on, "left").select(*indexed.columns, *names)


def chunk_carries(rows: DataFrame, key: str | Sequence[str], totals: dict[str, tuple[Column, str]]) -> DataFrame:
    """Two-level scan, first level: per (key, chunk) the combination of the
    totals of all *earlier* chunks of the series.

    ``rows`` must hold each row once (home rows) with ``_chunk`` assigned;
    ``totals`` maps output name -> (aggregate over a chunk, combine) with combine
    in 'sum' | 'product' | 'max' | 'min' ('max'/'min' give NULL for the first
    chunk). The result has n / chunk_rows rows per series: the window over it is
    cheap, and callers join it back once, *before* their own windows, so no
    expensive upstream is evaluated twice.
    """
    key = _cols(key)
    t = rows.groupBy(*key, CHUNK).agg(*[agg.alias(f"_t_{n}") for n, (agg, _) in totals.items()])
    prev = Window.partitionBy(*key).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    out = []
    for n, (_, comb) in totals.items():
        c = F.col(f"_t_{n}")
        if comb == "sum":
            v = F.coalesce(F.sum(c).over(prev), F.lit(0.0))
        elif comb == "product":
            v = F.coalesce(F.product(c).over(prev), F.lit(1.0))
        elif comb == "max":
            v = F.max(c).over(prev)
        elif comb == "min":
            v = F.min(c).over(prev)
        else:
            raise ValueError(comb)
        out.append(v.alias(n))
    return t.select(*key, CHUNK, *out)


def running(agg: Column, key: str | Sequence[str]) -> Column:
    """``agg`` from the start of the chunk to the current row (chunk layout)."""
    return agg.over(chunk_window(key, (Window.unboundedPreceding, 0)))
