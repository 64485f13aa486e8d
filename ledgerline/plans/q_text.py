"""Registered queries: instruction text, labels, chat format, text scores and
classification reports over ``documents``, ``labels``, ``conversations``,
``pages`` and ``embeddings``.

Instruction text is rendered from whole documents: a question chosen by
``doc_id mod 6`` and a Yes/No answer by ``(doc_id div 6) mod 2``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerline.functions import text as TX
from ledgerline.operators import metrics as M
from ledgerline.operators import text_ops as TO
from ledgerline.plans import fixtures as fx
from ledgerline.plans.registry import query, rounded

QUESTIONS = [
    "Is the sentiment of this news positive?",
    "Is this headline bearish for the asset?",
    "Is the price going up after this news?",
    "Is the price going down after this news?",
    "Is the price staying constant?",
    "Does this mention a company merger?",
]
# D6: the chat transform's label map (positive 0, negative 1, neutral 2)
LABEL_MAP = {"positive": 0, "negative": 1, "neutral": 2}
TICKERS = ["THE", "AND", "DER", "LA", "ET", "UND", "QUE", "NICHT"]
CLF_POS = ["up", "and"]
CLF_NEG = ["red", "der"]

Q_SQL = "CASE doc_id % 6 " + " ".join(f"WHEN {i} THEN '{q}'" for i, q in enumerate(QUESTIONS)) + " END"
INSTR_SQL = (f"'## ' || {Q_SQL} || chr(10) || chr(10) || '### Input' || chr(10) || text || chr(10) || chr(10) "
             "|| '### Response' || chr(10) || CASE WHEN (doc_id // 6) % 2 = 0 THEN 'Yes' ELSE 'No' END")
PARSE_SQL = f"""
WITH t AS (SELECT doc_id, {INSTR_SQL} AS instr FROM documents),
x AS (SELECT doc_id, regexp_extract(instr, '{TX.QUESTION_PATTERN}', 1) AS q,
             regexp_extract(instr, '{TX.INPUT_PATTERN}', 1) AS h,
             regexp_extract(instr, '{TX.RESPONSE_PATTERN}', 1) AS r FROM t),
p AS (SELECT doc_id, q <> '' AND h <> '' AND r <> '' AS ok,
             regexp_replace(q, '^\\s+|\\s+\\z', '', 'g') AS question,
             regexp_replace(h, '^\\s+|\\s+\\z', '', 'g') AS headline,
             regexp_replace(r, '^\\s+|\\s+\\z', '', 'g') AS response FROM x)
"""


def _contains_any_sql(col: str, words) -> str:
    return "(" + " OR ".join(f"contains({col}, '{w}')" for w in words) + ")"


def _count_sql(col: str, words) -> str:
    return "(" + " + ".join(f"CASE WHEN contains({col}, '{w}') THEN 1 ELSE 0 END" for w in words) + ")"


LABEL_SQL = """CASE
  WHEN contains(lower(question), 'price going up') OR contains(lower(question), 'price in the future') THEN
    CASE WHEN lower(response) = 'yes' THEN 'positive' WHEN lower(response) = 'no' THEN 'negative' END
  WHEN contains(lower(question), 'price going down') OR contains(lower(question), 'price in the past') THEN
    CASE WHEN lower(response) = 'yes' THEN 'negative' WHEN lower(response) = 'no' THEN 'positive' END
  WHEN contains(lower(question), 'price staying constant') THEN
    CASE WHEN lower(response) = 'yes' THEN 'neutral' END
  WHEN contains(lower(question), 'positive') OR contains(lower(question), 'bullish') OR contains(lower(question), 'good news') THEN
    CASE WHEN lower(response) = 'yes' THEN 'positive' ELSE 'negative' END
  WHEN contains(lower(question), 'negative') OR contains(lower(question), 'bearish') OR contains(lower(question), 'bad news') THEN
    CASE WHEN lower(response) = 'yes' THEN 'negative' ELSE 'positive' END
  WHEN contains(lower(question), 'neutral') THEN CASE WHEN lower(response) = 'yes' THEN 'neutral' END
END"""
GATE_SQL = _contains_any_sql("lower(question)", TX.SENTIMENT_QUESTION_KEYWORDS)
PREP_SQL = PARSE_SQL + f""",
s AS (SELECT doc_id, question, headline, response, CASE WHEN {GATE_SQL} THEN {LABEL_SQL} END AS sentiment,
        CASE WHEN NOT ok THEN 'unparsed' WHEN NOT {GATE_SQL} THEN 'not_sentiment'
             WHEN ({LABEL_SQL}) IS NULL THEN 'no_label' END AS drop_reason FROM p)
"""
TRUE_LABEL_SQL = "CASE WHEN quality = 1 THEN 'positive' WHEN toxic = 1 THEN 'negative' ELSE 'neutral' END"


def instruction_docs(spark, sf):
    d = fx.table(spark, sf, "documents")
    q = F.element_at(F.array(*[F.lit(x) for x in QUESTIONS]), (F.pmod("doc_id", F.lit(6)) + 1).cast("int"))
    ans = F.when(F.pmod(F.floor(F.col("doc_id") / 6), F.lit(2)) == 0, "Yes").otherwise("No")
    nl = F.lit("\n")
    text = F.concat(F.lit("## "), q, nl, nl, F.lit("### Input"), nl, F.col("text"), nl, nl,
                    F.lit("### Response"), nl, ans)
    return d.select("doc_id", text.alias("text"))


def true_label(quality: Column, toxic: Column) -> Column:
    """Gold label from the quality / toxic flags (quality takes precedence)."""
    return F.when(quality == 1, "positive").when(toxic == 1, "negative").otherwise("neutral")


def labelled_docs(spark, sf):
    d = fx.table(spark, sf, "documents")
    lab = fx.table(spark, sf, "labels")
    return d.join(lab, "doc_id").select("doc_id", "text", true_label(F.col("quality"), F.col("toxic")).alias("y_true"))


def _rule_pred(col="text"):
    return F.lower(TX.rule_based_label(col, CLF_POS, CLF_NEG))


def _score_pred(col="text"):
    s = TX.keyword_score(col)
    return F.when(s > 0, "positive").when(s < 0, "negative").otherwise("neutral")


RULE_PRED_SQL = (f"CASE WHEN {_count_sql('lower(text)', CLF_POS)} > {_count_sql('lower(text)', CLF_NEG)} THEN 'positive' "
                 f"WHEN {_count_sql('lower(text)', CLF_NEG)} > {_count_sql('lower(text)', CLF_POS)} THEN 'negative' "
                 "ELSE 'neutral' END")
KW_B = _count_sql("lower(text)", TX.BULLISH_WORDS)
KW_S = _count_sql("lower(text)", TX.BEARISH_WORDS)
SCORE_SQL = f"(({KW_B}) - ({KW_S}))::DOUBLE / greatest(({KW_B}) + ({KW_S}), 1)"
SCORE_PRED_SQL = f"CASE WHEN {SCORE_SQL} > 0 THEN 'positive' WHEN {SCORE_SQL} < 0 THEN 'negative' ELSE 'neutral' END"
LABELLED_SQL = f"""ld AS (SELECT doc_id, text, {TRUE_LABEL_SQL} AS y_true FROM documents JOIN labels USING (doc_id))"""


# ---- X-01..X-08 --------------------------------------------------------------

@query("x01_parse_instruction", PARSE_SQL + "SELECT doc_id, question, headline, response FROM p WHERE ok")
def x01(spark, sf):
    p = instruction_docs(spark, sf).select("doc_id", TX.parse_instruction("text").alias("p"))
    return p.filter(F.col("p").isNotNull()).select("doc_id", "p.question", "p.headline", "p.response")


@query("x02_is_sentiment_question", PARSE_SQL + f"SELECT doc_id, {GATE_SQL} AS is_sentiment FROM p WHERE ok")
def x02(spark, sf):
    p = instruction_docs(spark, sf).select("doc_id", TX.parse_instruction("text").alias("p"))
    return p.filter(F.col("p").isNotNull()).select("doc_id", TX.is_sentiment_question("p.question").alias("is_sentiment"))


@query("x03_sentiment_label", PARSE_SQL + f"SELECT doc_id, {LABEL_SQL} AS sentiment FROM p WHERE ok")
def x03(spark, sf):
    p = instruction_docs(spark, sf).select("doc_id", TX.parse_instruction("text").alias("p"))
    return p.filter(F.col("p").isNotNull()).select("doc_id", TX.sentiment_label("p.question", "p.response")
                                                    .alias("sentiment"))


@query("x04_prepare_sentiment", PREP_SQL + "SELECT doc_id, headline, sentiment FROM s WHERE drop_reason IS NULL")
def x04(spark, sf):
    return TO.sentiment_examples(instruction_docs(spark, sf), keep=["doc_id"])


@query("x04_drop_reasons", PREP_SQL + """
SELECT coalesce(drop_reason, 'kept') AS outcome, count(*) AS n FROM s GROUP BY 1""")
def x04d(spark, sf):
    out = TO.prepare_sentiment(instruction_docs(spark, sf), keep=["doc_id"])
    return out.groupBy(F.coalesce("drop_reason", F.lit("kept")).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


@query("a11_label_share", PREP_SQL + """
, c AS (SELECT sentiment, count(*) AS count FROM s WHERE drop_reason IS NULL GROUP BY 1)
SELECT sentiment, count, round(count / sum(count) OVER (), 6) AS share FROM c""")
def a11(spark, sf):
    out = TO.sentiment_examples(instruction_docs(spark, sf), keep=["doc_id"])
    return rounded(TO.label_share(out, "sentiment"))


@query("x05_chat_format", PREP_SQL + """
SELECT doc_id, [{'role': 'user', 'content': headline}] AS messages, lower(sentiment) AS label
FROM s WHERE drop_reason IS NULL""")
def x05(spark, sf):
    out = TO.sentiment_examples(instruction_docs(spark, sf), keep=["doc_id"])
    return out.select("doc_id", TX.user_messages("headline").alias("messages"), F.lower("sentiment").alias("label"))


SRC_OUT_SQL = (f"CASE doc_id % 4 WHEN 0 THEN upper({TRUE_LABEL_SQL}) WHEN 1 THEN ' ' || {TRUE_LABEL_SQL} || ' ' "
               f"WHEN 2 THEN {TRUE_LABEL_SQL} ELSE {TRUE_LABEL_SQL} || 'ish' END")


def source_rows(spark, sf):
    """(input, output) source rows: whole document text and a noisy label answer."""
    d = fx.table(spark, sf, "documents").join(fx.table(spark, sf, "labels"), "doc_id")
    lab = true_label(F.col("quality"), F.col("toxic"))
    m = F.pmod("doc_id", F.lit(4))
    out = (F.when(m == 0, F.upper(lab)).when(m == 1, F.concat(F.lit(" "), lab, F.lit(" ")))
            .when(m == 2, lab).otherwise(F.concat(lab, F.lit("ish"))))
    return d.select("doc_id", F.col("text").alias("input"), out.alias("output"))


@query("x06_source_to_chat", f"""
WITH s AS (SELECT doc_id, text AS input, lower(regexp_replace({SRC_OUT_SQL}, '^\\s+|\\s+\\z', '', 'g')) AS label
           FROM documents JOIN labels USING (doc_id))
SELECT doc_id, [{{'role': 'user', 'content': '{TX.NEWS_PROMPT_PREFIX.strip()}' || chr(10) || chr(10) || input}},
                {{'role': 'assistant', 'content': label}}] AS messages, label
FROM s WHERE label IN ('positive', 'negative', 'neutral')""")
def x06(spark, sf):
    return TO.source_to_chat(source_rows(spark, sf), keep=["doc_id"])


@query("x07_first_user_message", f"""
WITH f AS (SELECT conv_id, coalesce(arg_min(text, CASE WHEN role = 'user' THEN turn END), '') AS user_message
           FROM conversations GROUP BY 1)
SELECT conv_id, user_message,
  CASE WHEN {_count_sql('lower(user_message)', CLF_POS)} > {_count_sql('lower(user_message)', CLF_NEG)} THEN 0
       WHEN {_count_sql('lower(user_message)', CLF_NEG)} > {_count_sql('lower(user_message)', CLF_POS)} THEN 1
       ELSE 2 END AS label_id
FROM f""")
def x07(spark, sf):
    f = TO.first_user_turn(fx.table(spark, sf, "conversations"))
    lab = _rule_pred("user_message")
    return f.select("conv_id", "user_message", TX.label_id(lab, LABEL_MAP).alias("label_id"))


@query("x07_first_user_message_array", """
WITH m AS (SELECT conv_id, list({'role': role, 'content': text} ORDER BY turn) AS messages FROM conversations GROUP BY 1)
SELECT conv_id, coalesce(list_filter(messages, lambda x: x.role = 'user')[1].content, '') AS user_message FROM m""")
def x07a(spark, sf):
    """X-07 on messages arrays (the chat-format shape): one array per conversation,
    as such a file has it. On turn rows, ``first_user_turn`` needs no array."""
    c = fx.table(spark, sf, "conversations")
    m = c.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role",
                                                                      F.col("text").alias("content")))).alias("_m"))
    m = m.select("conv_id", F.transform("_m", lambda s: F.struct(s["role"].alias("role"),
                                                                 s["content"].alias("content"))).alias("messages"))
    return m.select("conv_id", TX.first_user_message("messages").alias("user_message"))


@query("x08_chat_prompt", f"""
WITH f AS (SELECT conv_id, coalesce(arg_min(text, CASE WHEN role = 'user' THEN turn END), '') AS user_message
           FROM conversations GROUP BY 1)
SELECT conv_id, '<|im_start|>system' || chr(10) || '{TX.SYSTEM_PROMPT}<|im_end|>' || chr(10) ||
  '<|im_start|>user' || chr(10) || 'Classify the sentiment of this financial text:' || chr(10) || chr(10) ||
  user_message || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) ||
  CASE WHEN {_count_sql('lower(user_message)', CLF_POS)} > {_count_sql('lower(user_message)', CLF_NEG)} THEN 'positive'
       WHEN {_count_sql('lower(user_message)', CLF_NEG)} > {_count_sql('lower(user_message)', CLF_POS)} THEN 'negative'
       ELSE 'neutral' END || '<|im_end|>' AS prompt
FROM f""")
def x08(spark, sf):
    f = TO.first_user_turn(fx.table(spark, sf, "conversations"))
    return f.select("conv_id", TX.chat_prompt("user_message", _rule_pred("user_message")).alias("prompt"))


# ---- X-09..X-12 --------------------------------------------------------------

@query("x09_label_from_generation", """
WITH t AS (SELECT conv_id, turn, lower(regexp_replace(text, '^\\s+|\\s+\\z', '', 'g')) AS g
           FROM conversations WHERE role = 'assistant')
SELECT conv_id, turn, CASE WHEN contains(g, 'positive') THEN 'positive' WHEN contains(g, 'negative') THEN 'negative'
  WHEN contains(g, 'neutral') THEN 'neutral'
  WHEN regexp_split_to_array(g, '\\s+')[1] IN ('positive', 'negative', 'neutral') THEN regexp_split_to_array(g, '\\s+')[1]
  ELSE 'neutral' END AS label FROM t""")
def x09(spark, sf):
    c = fx.table(spark, sf, "conversations").filter(F.col("role") == "assistant")
    return c.select("conv_id", "turn", TX.label_from_generation("text").alias("label"))


@query("x10_score_from_text", """
SELECT page_id, CASE WHEN TRY_CAST(regexp_extract(html, '([-+]?\\d*\\.?\\d+)', 1) AS DOUBLE) IS NULL THEN 0.0
  ELSE greatest(-1.0, least(1.0, TRY_CAST(regexp_extract(html, '([-+]?\\d*\\.?\\d+)', 1) AS DOUBLE))) END AS score
FROM pages""")
def x10(spark, sf):
    return fx.table(spark, sf, "pages").select("page_id", TX.score_from_text("html").alias("score"))


@query("x11_keyword_score", f"SELECT doc_id, round({SCORE_SQL}, 4) AS score FROM documents")
def x11(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", TX.keyword_score("text").alias("score"))


@query("x12_rule_based_label", f"""
SELECT doc_id, CASE WHEN {_count_sql('lower(text)', TX.RULE_POSITIVE_WORDS)} > {_count_sql('lower(text)', TX.RULE_NEGATIVE_WORDS)}
  THEN 'Positive' WHEN {_count_sql('lower(text)', TX.RULE_NEGATIVE_WORDS)} > {_count_sql('lower(text)', TX.RULE_POSITIVE_WORDS)}
  THEN 'Negative' ELSE 'Neutral' END AS label FROM documents""")
def x12(spark, sf):
    return fx.table(spark, sf, "documents").select("doc_id", TX.rule_based_label("text").alias("label"))


@query("a12_ticker_mentions", f"""
WITH t AS (SELECT unnest(regexp_split_to_array(upper(coalesce(text, '')), '{TO.WORD_SPLIT}')) AS ticker FROM documents),
tr AS (SELECT unnest([{", ".join(f"'{t}'" for t in TICKERS)}]) AS ticker),
h AS (SELECT ticker, count(*) AS mentions FROM t WHERE ticker IN (SELECT ticker FROM tr) GROUP BY 1)
SELECT tr.ticker, CAST(coalesce(h.mentions, 0) AS BIGINT) AS mentions FROM tr LEFT JOIN h USING (ticker)""")
def a12(spark, sf):
    return TO.keyword_mentions(fx.table(spark, sf, "documents"), ["text"], TICKERS)


# ---- M-21..M-27 classification ---------------------------------------------------

def _predicted(spark, sf):
    return labelled_docs(spark, sf).select("doc_id", "y_true", _rule_pred().alias("y_pred"),
                                           _score_pred().alias("y_pred_keyword"))


CLASSES_SQL = "(SELECT * FROM (VALUES (0, 'positive'), (1, 'negative'), (2, 'neutral')) v(idx, label))"
CM_SQL = f"""
WITH {LABELLED_SQL}, pr AS (SELECT y_true, {RULE_PRED_SQL} AS y_pred FROM ld),
cnt AS (SELECT y_true, y_pred, count(*) AS c FROM pr GROUP BY 1, 2),
cm AS (SELECT t.idx AS true_idx, t.label AS true_label, p.idx AS pred_idx, p.label AS pred_label,
              CAST(coalesce(cnt.c, 0) AS BIGINT) AS count
       FROM {CLASSES_SQL} t CROSS JOIN {CLASSES_SQL} p LEFT JOIN cnt ON cnt.y_true = t.label AND cnt.y_pred = p.label),
per AS (SELECT t.label, t.support, t.tp, p.predicted,
   CASE WHEN p.predicted > 0 THEN t.tp / p.predicted ELSE 0.0 END AS precision,
   CASE WHEN t.support > 0 THEN t.tp / t.support ELSE 0.0 END AS recall
   FROM (SELECT true_label AS label, sum(count) AS support, sum(CASE WHEN true_label = pred_label THEN count ELSE 0 END) AS tp
         FROM cm GROUP BY 1) t
   JOIN (SELECT pred_label AS label, sum(count) AS predicted FROM cm GROUP BY 1) p USING (label)),
per2 AS (SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM per)
"""


@query("m23_confusion_matrix", CM_SQL + "SELECT * FROM cm")
def m23(spark, sf):
    return M.confusion_long(_predicted(spark, sf), "y_true", "y_pred")


@query("m22_classification_per_class", CM_SQL + """
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1,
       CAST(support AS BIGINT) AS support FROM per2""")
def m22(spark, sf):
    per, _ = M.classification_report(_predicted(spark, sf), "y_true", "y_pred")
    return rounded(per)


@query("m21_classification_summary", CM_SQL + """
SELECT round(sum(tp) / sum(support), 6) AS accuracy, round(sum(precision) / 3, 6) AS macro_precision,
  round(sum(recall) / 3, 6) AS macro_recall, round(sum(f1) / 3, 6) AS macro_f1,
  round(sum(precision * support) / sum(support), 6) AS weighted_precision,
  round(sum(recall * support) / sum(support), 6) AS weighted_recall,
  round(sum(f1 * support) / sum(support), 6) AS weighted_f1, CAST(sum(support) AS BIGINT) AS num_samples FROM per2""")
def m21(spark, sf):
    _, summary = M.classification_report(_predicted(spark, sf), "y_true", "y_pred")
    return rounded(summary)


@query("m24_compare_classifiers", f"""
WITH {LABELLED_SQL},
st AS (SELECT 'y_pred' AS model, y_true, {RULE_PRED_SQL} AS y_pred FROM ld
       UNION ALL SELECT 'y_pred_keyword', y_true, {SCORE_PRED_SQL} FROM ld)
SELECT model, round(avg(CASE WHEN y_true = y_pred THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
       CAST(count(*) AS BIGINT) AS num_samples FROM st GROUP BY 1""")
def m24(spark, sf):
    _, summary = M.compare_classifiers(_predicted(spark, sf), "y_true", ["y_pred", "y_pred_keyword"])
    return rounded(summary.select("model", "accuracy", "num_samples"))


@query("m25_masked_token_accuracy", """
WITH u AS (SELECT label, unnest(embedding) AS x, unnest(range(len(embedding))) AS i FROM embeddings),
t AS (SELECT label, CAST(x > 0 AS INTEGER) AS p, CASE WHEN i % 4 = 0 THEN -100 ELSE CAST(x >= 0.5 AS INTEGER) END AS l FROM u)
SELECT label, round(avg(CASE WHEN p = l THEN 1.0 ELSE 0.0 END), 6) AS accuracy, count(*) AS tokens
FROM t WHERE l <> -100 GROUP BY label""")
def m25(spark, sf):
    e = fx.table(spark, sf, "embeddings")
    e = e.select("label", F.transform("embedding", lambda x: (x > 0).cast("int")).alias("predictions"),
                 F.transform("embedding", lambda x, i: F.when(F.pmod(i, F.lit(4)) == 0, F.lit(-100))
                             .otherwise((x >= 0.5).cast("int"))).alias("labels"))
    return rounded(M.masked_token_accuracy(e, group=["label"]))


@query("m27_consistent_labels", f"""
WITH {LABELLED_SQL}, g AS (SELECT text FROM ld GROUP BY text HAVING count(DISTINCT y_true) = 1)
SELECT doc_id, y_true FROM ld WHERE text IN (SELECT text FROM g)""")
def m27(spark, sf):
    return TO.consistent_labels(labelled_docs(spark, sf), "text", "y_true").select("doc_id", "y_true")


@query("m05_hash_split_counts", """
SELECT CASE WHEN ('0x' || substr(md5('42:' || CAST(doc_id AS VARCHAR)), 1, 8))::BIGINT % 1000 < 100
       THEN 'test' ELSE 'train' END AS role, count(*) AS n FROM documents GROUP BY 1""")
def m05(spark, sf):
    """M-05: 90/10 split stable under repartitioning (md5 of seed and id)."""
    from ledgerline.operators.splits import hash_split
    return hash_split(fx.table(spark, sf, "documents").select("doc_id"), "doc_id", 0.1, 42) \
        .groupBy("role").agg(F.count(F.lit(1)).alias("n"))
