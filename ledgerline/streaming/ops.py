"""Structured Streaming forms of the bar, scoring, mention and dedupe
operators (T-01..T-05).

Event time must be a TIMESTAMP (not TIMESTAMP_NTZ) for watermarks, so the
sources cast it under the UTC session. State is bounded by the watermark;
windows are emitted once closed (append mode). Sinks write Parquet into a
folder (and the checkpoint into the shared checkpoint folder), so a restarted
query resumes from its offsets and state.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions import text as TX


def read_stream(spark: SparkSession, path: str, schema, ts: str = "ts", fmt: str = "parquet",
                max_files_per_trigger: int | None = None, glob: str | None = None) -> DataFrame:
    """File stream over a folder with an explicit schema (``glob`` selects file
    names); ``ts`` cast to TIMESTAMP."""
    r = spark.readStream.format(fmt).schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    df = r.load(path)
    return df.withColumn(ts, F.col(ts).cast("timestamp"))


def stream_bars(ticks: DataFrame, key: str, ts: str, price: str, tiebreak: str | None = None,
                window: str = "1 hour", delay: str = "10 minutes") -> DataFrame:
    """T-01: tumbling-window OHLCV with a watermark; rows later than the
    watermark are dropped, each window is emitted once when it closes."""
    order = F.struct(F.col(ts), F.col(tiebreak)) if tiebreak else F.col(ts)
    return (ticks.withWatermark(ts, delay)
                 .groupBy(F.window(ts, window).alias("w"), key)
                 .agg(F.min_by(price, order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"),
                      F.max_by(price, order).alias("close"), F.count(F.lit(1)).cast("double").alias("volume"))
                 .select(key, F.col("w.start").alias("window_start"), "open", "high", "low", "close", "volume"))


def stream_scores(docs: DataFrame, text: str, keep: Sequence[str] = ()) -> DataFrame:
    """T-02: stateless per-row text scores (X-11 / X-12)."""
    return docs.select(*keep, TX.keyword_score(text).alias("score"), TX.rule_based_label(text).alias("label"))


def stream_mentions(docs: DataFrame, ts: str, text: str, tickers: Sequence[str], window: str = "1 hour",
                    slide: str = "15 minutes", delay: str = "10 minutes") -> DataFrame:
    """T-03: ticker mentions per sliding window (tokens matched to the literal
    ticker list right after the split)."""
    toks = docs.withWatermark(ts, delay).select(ts, F.explode(F.split(F.upper(F.col(text)), r"[^\p{L}\p{N}_]+"))
                                                 .alias("ticker"))
    hits = toks.filter(F.col("ticker").isin(*tickers))
    return (hits.groupBy(F.window(ts, window, slide).alias("w"), "ticker").agg(F.count(F.lit(1)).alias("mentions"))
                .select(F.col("w.start").alias("window_start"), "ticker", "mentions"))


def stream_dedupe(rows: DataFrame, key: Sequence[str], ts: str, delay: str = "1 hour") -> DataFrame:
    """T-04: drop repeated keys arriving within the watermark delay."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(list(key))


def stream_model_scores(rows: DataFrame, model) -> DataFrame:
    """T-05: apply a fitted ``PipelineModel`` to a stream of feature rows."""
    return model.transform(rows)


def run_to_parquet(df: DataFrame, out: str, checkpoint: str, mode: str = "append") -> None:
    """Drain everything available now into a Parquet folder and stop."""
    q = (df.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start(out))
    q.awaitTermination()
