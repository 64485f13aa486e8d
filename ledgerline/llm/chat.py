"""Chat formatting in budgeted windows: DataFrame and SQL functions only.

Prefix sums of turn tokens place each turn of a conversation on a line; turns that lie in one stride of it
are the new turns of a window, a turn across a stride's end is a window of its own. Every window starts
with the system turn, repeats a limited history before its first new turn, and has under the loss mask
only its new assistant turns: each of them is a target exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.base import cut

# The template's marks, and the control strings that may not stand in a text as they are
START, END = "<|im_start|>", "<|im_end|>"
CONTROL = r"([<\[])(\\*)(/?(?:s>|INST\]|SYS>|<SYS>>|\|[A-Za-z0-9_]{1,40}\|>))"
ESCAPED = r"([<\[])\\(\\*)(/?(?:s>|INST\]|SYS>|<SYS>>|\|[A-Za-z0-9_]{1,40}\|>))"
TOKEN = r"[A-Za-z0-9]+|[^A-Za-z0-9\x00-\x20]"
#: Tokens that the marks of a turn cost.
TURN_COST = 4
BUDGET, HISTORY, LEAST_STRIDE = 2048, 512, 256
#: Turn numbers are dealt in blocks of this many, so that a very long conversation isn't one task's.
TURN_BLOCK = 256


def escape(text: Column) -> Column:
    """Reversible: a control string gets one more backslash after its first character."""
    return F.regexp_replace(text, CONTROL, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, ESCAPED, r"$1$2$3")


def numbered_turns(conversations: DataFrame) -> DataFrame:
    """conv, conv_id, seq, role, text, tokens, is_system, start, stop: turns in order, on the token line.

    Order is by turn (nulls first), role, text. Sums are taken within blocks of turn numbers, then over
    the table of blocks.
    """
    t = conversations.select(
        F.coalesce(F.col("conv_id").cast("string"), F.lit("null")).alias("conv"),
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")) \
        .withColumn("tokens", F.regexp_count("text", F.lit(TOKEN)) + F.lit(TURN_COST)) \
        .withColumn("block", F.coalesce(F.floor(F.col("turn") / TURN_BLOCK), F.lit(-(1 << 60))))
    blocks = t.groupBy("conv", "block").agg(F.count("*").alias("n"), F.sum("tokens").alias("sum"),
                                            F.min(F.struct("turn", "role", "tokens")).alias("first"))
    before = Window.partitionBy("conv").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    first = F.first("first").over(Window.partitionBy("conv").orderBy("block"))
    blocks = blocks.select("conv", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n0"),
                           F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("sum0"), first.alias("first")) \
        .withColumn("system", F.when(F.col("first.role") == "system", F.col("first.tokens")).otherwise(F.lit(0)))
    own = Window.partitionBy("conv", "block").orderBy("turn", "role", "tokens", "text")
    line = own.rowsBetween(Window.unboundedPreceding, 0)
    return (t.withColumn("i", F.row_number().over(own)).withColumn("upto", F.sum("tokens").over(line))
            .join(blocks, ["conv", "block"])
            .withColumn("seq", F.col("i") + F.col("n0"))
            .withColumn("is_system", (F.col("seq") == 1) & (F.col("role") == "system"))
            .withColumn("stop", F.col("upto") + F.col("sum0") - F.col("system"))
            .select("conv", "conv_id", "seq", "role", "text", "tokens", "is_system", "system",
                    (F.col("stop") - F.col("tokens")).alias("start"), "stop"))


def chat_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY) -> DataFrame:
    """conv_id, window, text, n_tokens, segments for every window of every conversation.

    ``conversations``: conv_id, turn, role, text. ``text`` is the formatted window; ``segments`` has, for
    each turn in it, where its escaped role and text stand (code points, from 1), whether it is repeated,
    and whether its text is under the loss mask. A window has at most ``budget`` tokens unless a single
    turn (with the system turn) is longer: turns are never cut. Null roles and texts are empty, null turn
    numbers come first, a null conv_id is a conversation of its own; repeated rows are turns of their own;
    an empty table gives no windows.
    """
    turns = cut(numbered_turns(conversations))
    stride = F.greatest(F.lit(budget - history) - F.col("system"), F.lit(LEAST_STRIDE))
    body = turns.where("NOT is_system").withColumn("_s", F.floor(F.col("start") / stride)) \
        .withColumn("kind", (F.col("_s") != F.floor((F.col("stop") - 1) / stride)).cast("int")) \
        .withColumn("window", F.col("_s") * 2 + F.col("kind"))
    spans = body.groupBy("conv", "window").agg(F.min("start").alias("begin"), F.sum("tokens").alias("new"),
                                               F.min("system").alias("system"))
    spans = spans.withColumn("room", F.greatest(F.lit(0), F.least(
        F.lit(history), F.lit(budget) - F.col("system") - F.col("new"))))

    def part(rank: int, repeated: Column, loss: Column) -> Column:
        return F.struct(F.lit(rank).alias("rank"), F.col("seq"), escape(F.col("role")).alias("role"),
                        escape(F.col("text")).alias("text"), F.col("tokens"), repeated.alias("repeated"),
                        loss.alias("loss")).alias("part")

    no, yes = F.lit(False), F.lit(True)
    new = body.select("conv", "conv_id", "window", part(2, no, F.col("role") == "assistant"))
    cells = spans.where("room > 0 AND begin > 0").select(
        "conv", "window", "begin", "room",
        F.explode(F.sequence(F.floor(F.greatest(F.col("begin") - F.col("room"), F.lit(0)) / history),
                             F.floor((F.col("begin") - 1) / history))).alias("cell"))
    past = body.select("conv", "conv_id", "seq", "role", "text", "tokens", "start", "stop",
                       F.floor(F.col("start") / history).alias("cell")).join(cells, ["conv", "cell"]) \
        .where("stop <= begin AND begin - start <= room").select("conv", "conv_id", "window", part(1, yes, no))
    opening = turns.where("is_system").join(spans.select("conv", "window", "begin"), "conv", "left") \
        .select("conv", "conv_id", F.coalesce("window", F.lit(0)).alias("window"),
                part(0, F.coalesce(F.col("begin") > 0, no), no))
    parts = new.unionByName(past).unionByName(opening) \
        .groupBy("conv", "window").agg(F.min("conv_id").alias("conv_id"),
                                       F.sort_array(F.collect_list("part")).alias("parts"))
    role_at = len(START) + 1
    length = lambda p: F.length(p["role"]) + F.length(p["text"]) + F.lit(len(START) + len(END) + 2)
    starts = F.transform("parts", lambda p, i: F.aggregate(
        F.slice("parts", F.lit(1), i), F.lit(0), lambda a, q: a + length(q)))
    segments = F.zip_with("parts", "_at", lambda p, at: F.struct(
        (at + role_at).alias("role_start"), F.length(p["role"]).alias("role_chars"),
        (at + role_at + F.length(p["role"]) + 1).alias("text_start"), F.length(p["text"]).alias("text_chars"),
        p["repeated"].alias("repeated"), p["loss"].alias("loss")))
    text = F.array_join(F.transform("parts", lambda p: F.concat(
        F.lit(START), p["role"], F.lit("\n"), p["text"], F.lit(f"{END}\n"))), "")
    return parts.withColumn("_at", starts).select(
        "conv", "conv_id", "window", text.alias("text"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["tokens"]).alias("n_tokens"),
        segments.alias("segments"))


def digests(windows: DataFrame) -> DataFrame:
    """Per conversation, read back from the formatted windows by their segments: n_turns, turns_sha256,
    loss_chars, loss_sha256, formatted_chars. A digest needs its conversation's text in one row."""
    def got(s, at, n):
        return unescape(F.substring(F.col("text"), s[at], s[n]))

    fresh = F.filter("segments", lambda s: ~s["repeated"])
    turns = F.array_join(F.transform(fresh, lambda s: F.concat(
        got(s, "role_start", "role_chars"), F.lit("\n"), got(s, "text_start", "text_chars"), F.lit("\n"))), "")
    loss = F.array_join(F.transform(F.filter("segments", lambda s: s["loss"]),
                                    lambda s: got(s, "text_start", "text_chars")), "")
    each = windows.select("conv", "conv_id", F.struct(
        "window", turns.alias("turns"), loss.alias("loss"), F.size(fresh).alias("n"),
        F.length("text").alias("chars")).alias("w"))
    join = lambda k: F.array_join(F.transform("w", lambda x: x[k]), "")
    add = lambda k: F.aggregate("w", F.lit(0).cast("long"), lambda a, x: a + x[k])
    return each.groupBy("conv").agg(F.min("conv_id").alias("conv_id"), F.sort_array(F.collect_list("w")).alias("w")) \
        .select("conv_id", add("n").alias("n_turns"), F.sha2(join("turns"), 256).alias("turns_sha256"),
                F.length(join("loss")).cast("long").alias("loss_chars"),
                F.sha2(join("loss"), 256).alias("loss_sha256"), add("chars").alias("formatted_chars"))


ORACLE = f"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
costed AS (
  SELECT *, len(regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\\x00-\\x20]')) + {TURN_COST} AS tokens,
         length(role) + len(regexp_extract_all(role, '[<\\[]\\\\*/?(?:s>|INST\\]|SYS>|<SYS>>|\\|[A-Za-z0-9_]{{1,40}}\\|>)'))
         + length(text) + len(regexp_extract_all(text, '[<\\[]\\\\*/?(?:s>|INST\\]|SYS>|<SYS>>|\\|[A-Za-z0-9_]{{1,40}}\\|>)'))
         + {len(START) + len(END) + 2} AS chars
  FROM given),
numbered AS (
  SELECT *, row_number() OVER o AS seq,
         first_value(CASE WHEN role = 'system' THEN tokens ELSE 0 END) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND
                     UNBOUNDED FOLLOWING) AS sys,
         sum(tokens) OVER (o ROWS UNBOUNDED PRECEDING) AS upto
  FROM costed WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, tokens, text)),
lined AS (
  SELECT *, seq = 1 AND role = 'system' AS is_system, upto - sys AS stop, upto - sys - tokens AS start,
         greatest({BUDGET - HISTORY} - sys, {LEAST_STRIDE}) AS stride FROM numbered),
body AS (
  SELECT *, 2 * (start // stride) + CASE WHEN start // stride <> (stop - 1) // stride THEN 1 ELSE 0 END AS win
  FROM lined WHERE NOT is_system),
spans AS (
  SELECT conv_id, win, min(start) AS b, greatest(0, least({HISTORY}, {BUDGET} - min(sys) - sum(tokens))) AS room
  FROM body GROUP BY ALL),
sized AS (
  SELECT conv_id, chars FROM body
  UNION ALL SELECT s.conv_id, t.chars FROM spans s JOIN body t
    ON t.conv_id IS NOT DISTINCT FROM s.conv_id AND t.stop <= s.b AND s.b - t.start <= s.room
  UNION ALL SELECT t.conv_id, t.chars FROM lined t LEFT JOIN spans s
    ON t.conv_id IS NOT DISTINCT FROM s.conv_id WHERE t.is_system),
total AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars FROM sized GROUP BY 1),
digest AS (
  SELECT conv_id, count(*) AS n_turns,
         sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY seq)) AS turns_sha256,
         coalesce(string_agg(text, '' ORDER BY seq) FILTER (role = 'assistant'), '') AS loss
  FROM lined GROUP BY 1)
SELECT d.conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars
FROM digest d JOIN total t ON d.conv_id IS NOT DISTINCT FROM t.conv_id
"""
