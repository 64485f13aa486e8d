"""The Parquet lake: layout, reads with pruning, writes and ingest gates
(S-01..S-03, S-30..S-38, A-15).

Layout: ``<root>/category=<c>/asset=<a>/part-*.parquet`` (Hive partitions), so a
category or asset filter is partition pruning and the asset is a column — the
reference's file-per-asset layout with the file stem as asset maps to it
(:func:`read_file_per_asset` reads that layout too).

Scratch outputs go under the cluster's shared checkpoint folder
(``spark.checkpoint.dir``), never a machine-local temp directory.
"""

from __future__ import annotations

import re
import uuid
import warnings
from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.clean import min_history, normalize_columns
from ledgerline.operators.topk import first_n_per_group
from ledgerline.session import ensure_checkpoint_dir

OHLCV = ["open", "high", "low", "close", "volume"]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint folder."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/ledgerline-scratch/{name}-{uuid.uuid4().hex[:12]}"


# ---- reads ---------------------------------------------------------------------

def read_lake(spark: SparkSession, root: str, categories: Sequence[str] | None = None) -> DataFrame:
    """S-03: the lake with ``category`` / ``asset`` partition columns; a category
    list becomes a partition filter (only those directories are listed/read)."""
    df = spark.read.option("basePath", root).parquet(root)
    if categories is not None:
        df = df.filter(F.col("category").isin(*categories))
    return df


def read_file_per_asset(spark: SparkSession, path: str) -> DataFrame:
    """S-01 for a flat folder of ``<asset>.parquet`` files, or folders of that name with parts: asset = the stem."""
    df = spark.read.parquet(path)
    name = F.regexp_replace(F.col("_metadata.file_path"), r"\.parquet/[^/]*$", ".parquet")
    return df.withColumn("asset", F.regexp_extract(name, r"([^/]*?)(\.parquet)?$", 1))


def load_bars(df: DataFrame, min_rows: int = 100, ts: str = "ts") -> DataFrame:
    """S-01 / P-16 / F-07: lower-case names, require ts + OHLCV, keep assets with
    at least ``min_rows`` rows (aggregate + semi join)."""
    df = normalize_columns(df)
    missing = [c for c in [ts, *OHLCV] if c not in df.columns]
    if missing:
        raise ValueError(f"bars need columns {missing}")
    return min_history(df, "asset", min_rows)


def load_asset_class(spark: SparkSession, root: str, asset_class: str, class_map: dict[str, Sequence[str]],
                     min_rows: int = 100, max_files: int | None = None) -> DataFrame:
    """S-02: the categories of one asset class (partition pruning), optionally the
    first ``max_files`` assets per category by name, then :func:`load_bars`.
    The asset ranking runs on the distinct (category, asset) table."""
    cats = list(class_map[asset_class])
    df = read_lake(spark, root, cats)
    if max_files:
        first = first_n_per_group(df.select("category", "asset").distinct(), "category", "asset", max_files)
        df = df.join(first.select("category", "asset"), ["category", "asset"], "left_semi")
    return load_bars(df, min_rows).withColumn("asset_class", F.lit(asset_class))


def file_stats(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """A-15 / S-03: asset folders, files and bytes per category from file metadata
    only (``binaryFile`` with the content column pruned). Category = first path
    component under ``root`` (or the file stem for a flat folder). A large asset
    may have several files, so ``assets`` counts folders."""
    meta = spark.read.format("binaryFile").option("pathGlobFilter", pattern) \
        .option("recursiveFileLookup", "true").load(root).select("path", "length")
    rel = F.regexp_replace(F.col("path"), "^.*?" + re.escape(root.rstrip("/")) + "/", "")
    first = F.split(rel, "/")[0]
    category = F.regexp_replace(F.regexp_replace(first, r"^category=", ""), r"\.parquet$", "")
    folder = F.regexp_replace(rel, "/[^/]*$", "")
    return meta.groupBy(category.alias("category")).agg(F.count_distinct(folder).alias("assets"),
                                                        F.count(F.lit(1)).alias("files"),
                                                        F.sum("length").alias("bytes"))


# ---- writes (S-30..S-33) ---------------------------------------------------------

def write_lake(df: DataFrame, root: str, partition_by: Sequence[str] = ("category", "asset"),
               mode: str = "overwrite", sort_by: Sequence[str] = (), max_file_rows: int = 10_000_000,
               fmt: str = "parquet") -> bool:
    """S-30 / S-31: partitioned write (Parquet, or another file ``fmt``); an empty frame writes nothing and
    returns False (one ``isEmpty`` probe). Rows are rebalanced by the partition
    columns first: each task writes few files, and AQE splits a hot partition
    over several tasks. ``sort_by`` orders rows within files (time order at rest,
    no global sort); ``max_file_rows`` bounds a file."""
    if df.isEmpty():
        warnings.warn(f"empty DataFrame, skipping write to {root}", stacklevel=2)
        return False
    out = df.hint("rebalance", *[F.col(c) for c in partition_by]) if partition_by else df
    if sort_by:
        out = out.sortWithinPartitions(*partition_by, *sort_by)
    w = out.write.mode(mode).option("maxRecordsPerFile", max_file_rows)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.format(fmt).save(root)
    return True


def lake_path(root: str, category: str, dataset: str | None = None) -> str:
    """Folder of one category (and dataset) in the lake: ``<root>/category=<c>[/asset=<d>]``."""
    out = f"{root.rstrip('/')}/category={category}"
    return f"{out}/asset={dataset}" if dataset else out


def write_jsonl(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S-32 / S-33: JSON lines sink (nested arrays/structs kept)."""
    df.write.mode(mode).json(path)


def read_jsonl(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    r = spark.read
    if schema:
        r = r.schema(schema)
    return r.json(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """S-33: CSV with header (predictions export)."""
    df.write.mode(mode).option("header", True).csv(path)


# ---- ingest gates (S-34..S-38) ------------------------------------------------------

_SINCE = re.compile(r"^-(\d+)([hdw])$")


def parse_since(value: str, now: datetime | None = None) -> datetime:
    """S-34: '-6h' / '-2d' / '-1w' relative to ``now`` (UTC), or an ISO date/time."""
    now = now or datetime.now(timezone.utc)
    m = _SINCE.match(value.strip())
    if m:
        n, unit = int(m.group(1)), m.group(2)
        return now - {"h": timedelta(hours=n), "d": timedelta(days=n), "w": timedelta(weeks=n)}[unit]
    dt = datetime.fromisoformat(value.strip())
    return dt if dt.tzinfo else dt.replace(tzinfo=timezone.utc)


def read_changed_files(spark: SparkSession, path: str, since: str, fmt: str = "parquet", schema=None) -> DataFrame:
    """S-34 on files: only files modified after the cutoff (file-source option). The
    schema is that of all files unless given, so that no change gives no rows."""
    cutoff = parse_since(since).strftime("%Y-%m-%dT%H:%M:%S")
    schema = schema or spark.read.format(fmt).load(path).schema
    return spark.read.format(fmt).schema(schema).option("modifiedAfter", cutoff).load(path)


def rows_since(df: DataFrame, ts: str, since: str, anchor=None) -> DataFrame:
    """S-34 on rows: rows with ``ts`` after the cutoff; a relative cutoff is taken
    from ``anchor`` (a Column, e.g. the data's max time) when given, else now."""
    m = _SINCE.match(since.strip())
    if m and anchor is not None:
        n, unit = int(m.group(1)), m.group(2)
        hours = n * {"h": 1, "d": 24, "w": 168}[unit]
        return df.filter(F.col(ts) >= anchor - F.make_interval(hours=F.lit(hours)))
    return df.filter(F.col(ts) >= F.lit(parse_since(since).replace(tzinfo=None)))


def stale_keys(incoming: DataFrame, log: DataFrame, key: Sequence[str], ingested_at: str, now,
               max_age_hours: float) -> DataFrame:
    """S-35 / J-07: incoming keys whose last ingest is missing or older than the
    limit (left anti join against the fresh keys of the ingest log)."""
    key = list(key)
    last = log.groupBy(*key).agg(F.max(ingested_at).alias("_last"))
    fresh = last.filter(F.col("_last") >= now - F.make_interval(secs=F.lit(float(max_age_hours * 3600))))
    return incoming.join(fresh.select(*key), on=key, how="left_anti")


def capped(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """S-36: the first ``n`` rows in an explicit order (deterministic cap)."""
    return df.orderBy(*order).limit(n)


def rewrite_paths(manifest: DataFrame, path: str, rules: Sequence[tuple[str, str]], alt_prefix: str | None = None,
                  alt_suffix: str = "_alt") -> DataFrame:
    """S-38: apply regex rewrite rules in order; paths starting with
    ``alt_prefix`` get ``alt_suffix`` before the extension."""
    new = F.col(path)
    for pat, rep in rules:
        new = F.regexp_replace(new, pat, rep)
    if alt_prefix:
        ext = r"(\.[A-Za-z0-9]+)$"
        with_alt = F.when(new.rlike(ext), F.regexp_replace(new, ext, alt_suffix + "$1")) \
            .otherwise(F.concat(new, F.lit(alt_suffix)))
        new = F.when(F.col(path).startswith(alt_prefix), with_alt).otherwise(new)
    return manifest.withColumn("new_path", new)
