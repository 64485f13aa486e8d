"""Text-table operators built from the column functions (X-04..X-07, A-11, A-12, M-27)."""

from __future__ import annotations

import re

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions import text as TX

WORD_SPLIT = r"[^\p{L}\p{N}_]+"   # tokens = maximal runs of letters, digits, '_'


def prepare_sentiment(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """X-04: parse instruction text, gate on sentiment keywords, map Yes/No to a
    label. Returns every row with ``headline``, ``sentiment`` and ``drop_reason``
    (NULL for kept rows), so the skipped count is an aggregate, not a loop.

    Staged projections: the regex parse, the lower-casing and the keyword tests
    are each evaluated once per row (no expression is inlined into another)."""
    keep = list(keep)
    parsed = df.select(*keep, TX.parse_instruction(text).alias("_p"))
    flat = parsed.select(*keep, F.col("_p").isNull().alias("_unparsed"), "_p.question", "_p.headline",
                         "_p.response")
    low = flat.select("*", F.lower("question").alias("_ql"), F.lower("response").alias("_rl"))
    tested = low.select(*keep, "_unparsed", "question", "headline", "response",
                        TX.gate_lowered(F.col("_ql")).alias("_gate"),
                        TX.label_lowered(F.col("_ql"), F.col("_rl")).alias("_label"))
    return tested.select(*keep, "question", "headline", "response",
                         F.when(F.col("_gate"), F.col("_label")).alias("sentiment"),
                         F.when(F.col("_unparsed"), "unparsed").when(~F.col("_gate"), "not_sentiment")
                          .when(F.col("_label").isNull(), "no_label").alias("drop_reason"))


def sentiment_examples(df: DataFrame, text: str = "text", keep: Sequence[str] = ()) -> DataFrame:
    """X-04 kept rows only: (keep..., headline, sentiment).

    Selected through ``inline`` of a 0/1-element array rather than a filter: a
    filter on a derived column is pushed below the projections and re-inlines the
    whole parse and label logic into its condition."""
    keep = list(keep)
    prep = prepare_sentiment(df, text, keep)
    row = F.struct(*[F.col(k) for k in keep], F.col("headline"), F.col("sentiment"))
    fields = [f"{k}:{df.schema[k].dataType.simpleString()}" for k in keep] + ["headline:string", "sentiment:string"]
    empty = F.array().cast("array<struct<" + ",".join(fields) + ">>")
    one = F.when(F.col("drop_reason").isNull(), F.array(row)).otherwise(empty)
    return prep.select(F.inline(one))


def to_chat(df: DataFrame, headline: str = "headline", sentiment: str = "sentiment") -> DataFrame:
    """X-05: ``{messages: [{role: user, content: headline}], label: lower(sentiment)}``."""
    return df.select(TX.user_messages(headline).alias("messages"), F.lower(F.col(sentiment)).alias("label"))


def source_to_chat(df: DataFrame, input_col: str = "input", output_col: str = "output",
                   keep: Sequence[str] = ()) -> DataFrame:
    """X-06: (input, output) rows -> user/assistant pair; label = stripped,
    lower-cased output, rows outside the three labels dropped."""
    label = F.lower(TX.py_strip(F.col(output_col)))
    out = df.select(*keep, F.col(input_col).alias("_in"), label.alias("label"))
    out = out.filter(F.col("label").isin(*TX.SENTIMENT_LABELS))
    return out.select(*keep, TX.chat_pair(F.concat(F.lit(TX.NEWS_PROMPT_PREFIX), F.col("_in")),
                                          F.col("label")).alias("messages"), "label")


def first_user_turn(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role",
                    text: str = "text") -> DataFrame:
    """X-07 on a turn table: text of the lowest user turn per conversation ('' if
    none). An aggregate, so long conversations combine partially."""
    return turns.groupBy(conv).agg(
        F.coalesce(F.min_by(text, F.when(F.col(role) == "user", F.col(turn))), F.lit("")).alias("user_message"))


def label_share(df: DataFrame, label: str) -> DataFrame:
    """A-11: count per label and share of the total (the total is a scalar
    subquery over the aggregated counts, evaluated once)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    return counts.withColumn("share", F.col("count") / counts.select(F.sum("count")).scalar())


def keyword_mentions(df: DataFrame, text_cols: Sequence[str], tickers: Sequence[str]) -> DataFrame:
    """A-12: word-boundary mentions per ticker in upper-cased text, every tracked
    ticker present (zeros included). Tokens are matched to the (small, literal)
    ticker list right after the split, so only hits are shuffled; tickers with
    other than word characters (``BRK.B``) are counted in the text by the escaped
    ticker between word boundaries, in one aggregate."""
    spark = df.sparkSession
    combined = F.upper(F.concat_ws(" ", *[F.coalesce(F.col(c), F.lit("")) for c in text_cols]))
    odd = [t for t in tickers if not re.fullmatch(r"\w+", t)]
    toks = df.select(F.explode(F.split(combined, WORD_SPLIT)).alias("ticker"))
    hits = toks.filter(F.col("ticker").isin(*tickers)).groupBy("ticker").agg(F.count(F.lit(1)).alias("mentions"))
    if odd:
        edge = lambda t: "\\b" + re.escape(t) + "\\b"
        counts = df.agg(*[F.sum(F.regexp_count(combined, F.lit(edge(t)))).alias(f"t{i}") for i, t in enumerate(odd)])
        pairs = F.array(*[F.struct(F.lit(t).alias("ticker"), F.col(f"t{i}").alias("mentions")) for i, t in enumerate(odd)])
        hits = hits.unionByName(counts.select(F.inline(pairs)))
    tracked = spark.createDataFrame([(t,) for t in tickers], "ticker string")
    return tracked.join(hits, "ticker", "left").select("ticker", F.coalesce("mentions", F.lit(0)).cast("long")
                                                        .alias("mentions"))


def consistent_labels(df: DataFrame, key: str, label: str, digest: bool = True) -> DataFrame:
    """M-27: drop every row whose key (e.g. headline) carries more than one
    distinct label; rows of consistent keys are kept.

    With ``digest`` the shuffles carry a SHA-256 of the key instead of the text
    itself (a hot headline copied many times then costs 32 bytes per row in
    the exchange); the (digest, label) pairs are deduplicated map-side first."""
    k = F.sha2(F.col(key), 256) if digest else F.col(key)
    keyed = df.withColumn("_key", k)
    good = (keyed.select("_key", label).distinct().groupBy("_key").agg(F.count(F.lit(1)).alias("_k"))
                 .filter(F.col("_k") == 1).select("_key"))
    return keyed.join(good, on="_key", how="left_semi").drop("_key")
