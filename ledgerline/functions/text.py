"""Text, label and small scalar functions as native column expressions (X-01..X-22).

Everything here returns a ``Column`` built from ``pyspark.sql.functions``: no
Python UDF, so it runs inside whole-stage codegen. Regexes are written so that
Java (Spark) and RE2 (the DuckDB oracle) agree: ``[^\\n]`` instead of ``.``
where Python's ``.`` semantics matter, and ``\\z`` instead of ``$``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical labels and scores.
# ---------------------------------------------------------------------------
SENTIMENT_QUESTION_KEYWORDS = [
    "positive", "negative", "neutral", "bullish", "bearish", "optimistic", "pessimistic",
    "sentiment", "good news", "bad news", "price going up", "price going down",
    "price staying constant", "price in the past", "price in the future", "asset", "compare",
]
BULLISH_WORDS = ["bull", "calls", "moon", "\U0001F680", "buy", "long", "pump", "yolo", "green", "up", "squeeze"]
BEARISH_WORDS = ["bear", "puts", "crash", "short", "dump", "red", "down", "sell", "rekt", "loss"]
RULE_POSITIVE_WORDS = ["gain", "beat", "surge", "profit", "strong", "increase"]
RULE_NEGATIVE_WORDS = ["loss", "miss", "plummet", "weak", "decline", "layoff"]
SENTIMENT_LABELS = ["positive", "negative", "neutral"]
SYSTEM_PROMPT = "You are a financial sentiment analysis assistant."
USER_PROMPT_PREFIX = "Classify the sentiment of this financial text:\n\n"
NEWS_PROMPT_PREFIX = "Analyze the sentiment of this financial news:\n\n"
QUESTION_PATTERN = r"##\s+([^\n]+)"
INPUT_PATTERN = r"(?s)### Input\s*\n(.+?)(?:\n\n|\n###)"
RESPONSE_PATTERN = r"(?s)### Response\s*\n(.+?)(?:\n|\z)"
SCORE_PATTERN = r"([-+]?\d*\.?\d+)"
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def py_strip(x) -> Column:
    """Python ``str.strip()`` (ASCII whitespace) — Spark ``trim`` strips spaces only."""
    return F.regexp_replace(_c(x), r"^\s+|\s+\z", "")


def contains_any(text: Column, words: Sequence[str]) -> Column:
    """True when any literal word is a substring (regex characters are literal)."""
    out = F.lit(False)
    for w in words:
        out = out | text.contains(F.lit(w))
    return out


def count_present(text: Column, words: Sequence[str]) -> Column:
    """Number of words of the list that occur as substrings (each counted once)."""
    out = F.lit(0)
    for w in words:
        out = out + F.when(text.contains(F.lit(w)), 1).otherwise(0)
    return out


# ---- X-01..X-04 instruction text -> labels -----------------------------------

def parse_instruction(text) -> Column:
    """X-01: struct(question, headline, response); NULL unless all three match."""
    t = _c(text)
    q = F.regexp_extract(t, QUESTION_PATTERN, 1)
    h = F.regexp_extract(t, INPUT_PATTERN, 1)
    r = F.regexp_extract(t, RESPONSE_PATTERN, 1)
    ok = (q != "") & (h != "") & (r != "")
    return F.when(ok, F.struct(py_strip(q).alias("question"), py_strip(h).alias("headline"),
                               py_strip(r).alias("response")))


def is_sentiment_question(question) -> Column:
    """X-02: any of the keywords occurs in the lower-cased question."""
    return gate_lowered(F.lower(_c(question)))


def gate_lowered(q: Column) -> Column:
    return contains_any(q, SENTIMENT_QUESTION_KEYWORDS)


def sentiment_label(question, response) -> Column:
    """X-03: Yes/No answer -> label; the branch order is part of the definition."""
    return label_lowered(F.lower(_c(question)), F.lower(_c(response)))


def label_lowered(q: Column, r: Column) -> Column:
    """X-03 on already lower-cased question ``q`` and response ``r``."""
    yes, no = r == "yes", r == "no"
    null = F.lit(None).cast("string")
    up = q.contains("price going up") | q.contains("price in the future")
    down = q.contains("price going down") | q.contains("price in the past")
    flat = q.contains("price staying constant")
    pos = q.contains("positive") | q.contains("bullish") | q.contains("good news")
    neg = q.contains("negative") | q.contains("bearish") | q.contains("bad news")
    neu = q.contains("neutral")
    return (F.when(up, F.when(yes, "positive").when(no, "negative").otherwise(null))
             .when(down, F.when(yes, "negative").when(no, "positive").otherwise(null))
             .when(flat, F.when(yes, "neutral").otherwise(null))
             .when(pos, F.when(yes, "positive").otherwise("negative"))
             .when(neg, F.when(yes, "negative").otherwise("positive"))
             .when(neu, F.when(yes, "neutral").otherwise(null))
             .otherwise(null))


# ---- X-05..X-08 chat format --------------------------------------------------

def user_messages(content) -> Column:
    """X-05: ``[{role: 'user', content}]``."""
    return F.array(F.struct(F.lit("user").alias("role"), _c(content).alias("content")))


def chat_pair(user_content, assistant_content) -> Column:
    return F.array(F.struct(F.lit("user").alias("role"), _c(user_content).alias("content")),
                   F.struct(F.lit("assistant").alias("role"), _c(assistant_content).alias("content")))


def first_user_message(messages) -> Column:
    """X-07: content of the first message with role 'user', '' when there is none."""
    m = F.filter(_c(messages), lambda x: x["role"] == "user")
    return F.coalesce(F.try_element_at(m, F.lit(1))["content"], F.lit(""))


def label_id(label, label_map: dict[str, int], default_name: str = "neutral") -> Column:
    """X-07: label name -> id from a map; unknown names map to the id of ``default_name``."""
    m = F.create_map(*[x for k, v in label_map.items() for x in (F.lit(k), F.lit(v))])
    return F.coalesce(F.element_at(m, F.lower(_c(label))), F.lit(label_map[default_name]))


def chat_prompt(text, label=None) -> Column:
    """X-08: chat template with system / user (/ assistant when a label is given)."""
    head = F.concat(F.lit(f"<|im_start|>system\n{SYSTEM_PROMPT}<|im_end|>\n"),
                    F.lit("<|im_start|>user\n" + USER_PROMPT_PREFIX), _c(text), F.lit("<|im_end|>\n"))
    if label is None:
        return F.concat(head, F.lit("<|im_start|>assistant\n"))
    lab = _c(label)
    return F.when(lab.isNull(), F.concat(head, F.lit("<|im_start|>assistant\n"))) \
        .otherwise(F.concat(head, F.lit("<|im_start|>assistant\n"), lab, F.lit("<|im_end|>")))


# ---- X-09..X-12 scores from text ---------------------------------------------

def label_from_generation(text) -> Column:
    """X-09: first of positive / negative / neutral contained in the lower-cased
    text; else the first word if it is a label; else 'neutral'."""
    t = F.lower(py_strip(_c(text)))
    first = F.split(t, r"\s+", 2)[0]
    return (F.when(t.contains("positive"), "positive")
             .when(t.contains("negative"), "negative")
             .when(t.contains("neutral"), "neutral")
             .when(first.isin(*SENTIMENT_LABELS), first)
             .otherwise("neutral"))


def score_from_text(text) -> Column:
    """X-10: first signed decimal number, clamped to [-1, 1]; 0 when none."""
    s = F.regexp_extract(_c(text), SCORE_PATTERN, 1).try_cast("double")
    # greatest/least skip NULLs, so test for "no number" first
    return F.when(s.isNull(), F.lit(0.0)).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), s)))


def keyword_score(text, bullish: Sequence[str] = BULLISH_WORDS, bearish: Sequence[str] = BEARISH_WORDS) -> Column:
    """X-11: (bull - bear) / max(bull + bear, 1) over substring presence, rounded
    half-even to 4 places. Substring, not word, membership: 'up' hits 'support'."""
    t = F.lower(_c(text))
    b, s = count_present(t, bullish), count_present(t, bearish)
    total = F.greatest(b + s, F.lit(1))
    return F.bround((b - s).cast("double") / total, 4)


def rule_based_label(text, positive: Sequence[str] = RULE_POSITIVE_WORDS,
                     negative: Sequence[str] = RULE_NEGATIVE_WORDS) -> Column:
    """X-12: more positive than negative keywords -> Positive, fewer -> Negative, tie -> Neutral."""
    t = F.lower(_c(text))
    p, n = count_present(t, positive), count_present(t, negative)
    return F.when(p > n, "Positive").when(n > p, "Negative").otherwise("Neutral")


# ---- X-13..X-22 small scalar helpers -----------------------------------------

def winning_outcome(outcomes, prices) -> Column:
    """X-13: outcome at the position of the highest price (first on ties); NULL
    when either list is empty, a price does not parse, or the index is missing."""
    p = F.transform(_c(prices), lambda v: v.cast("string").try_cast("double"))
    bad = F.exists(p, lambda v: v.isNull())
    pos = F.array_position(p, F.array_max(p))
    o = _c(outcomes)
    return F.when((F.size(o) > 0) & (F.size(p) > 0) & ~bad,
                  F.try_element_at(o, pos.cast("int")).cast("string"))


def json_list(value) -> Column:
    """X-14: JSON text of a list -> array<string>; NULL on malformed input or a non-list."""
    v = _c(value)
    return F.when(F.trim(v).startswith("["), F.from_json(v, "array<string>"))


def first_price(prices) -> Column:
    """X-15: first element as double, NULL when missing or unparsable."""
    return F.try_element_at(_c(prices), F.lit(1)).cast("string").try_cast("double")


def opponent(matchup) -> Column:
    """X-16: team after 'vs.' ('' when absent)."""
    return F.regexp_extract(_c(matchup), r"vs\.\s+(\w+)", 1)


def is_home(matchup) -> Column:
    return _c(matchup).contains("vs.")


def safe_id(x, width: int = 80) -> Column:
    """X-17: characters outside [A-Za-z0-9_-] -> '_', cut to ``width``."""
    return F.substring(F.regexp_replace(_c(x), r"[^A-Za-z0-9_-]", "_"), 1, width)


def clean_symbol(x) -> Column:
    """X-18: drop '-SWAP' then every '-'."""
    return F.replace(F.replace(_c(x), F.lit("-SWAP"), F.lit("")), F.lit("-"), F.lit(""))


def season_code(start_year) -> Column:
    """X-20: two-digit start year + two-digit following year ('9394', '0001')."""
    y = _c(start_year)
    return F.concat(F.lpad(F.pmod(y, F.lit(100)).cast("string"), 2, "0"),
                    F.lpad(F.pmod(y + 1, F.lit(100)).cast("string"), 2, "0"))


def previous_quarters(d, n: int = 4) -> Column:
    """X-20: the ``n`` completed (year, quarter) pairs before the quarter of date ``d``."""
    q_index = F.year(d) * 4 + F.quarter(d) - 1          # absolute quarter number
    seq = F.sequence(q_index - 1, q_index - n, F.lit(-1))
    return F.transform(seq, lambda k: F.struct(F.floor(k / 4).cast("int").alias("year"),
                                               (F.pmod(k, F.lit(4)) + 1).cast("int").alias("quarter")))


def literal_count(text, needle: str) -> Column:
    """X-21: non-overlapping occurrences of a literal (Python ``str.count``)."""
    t = _c(text)
    return F.regexp_count(t, F.lit(_java_quote(needle)))


def _java_quote(s: str) -> str:
    return "\\Q" + s.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def iso_date(x) -> Column:
    """X-22: date / timestamp -> 'yyyy-MM-dd' text (export edge only)."""
    return F.date_format(_c(x), "yyyy-MM-dd")
