"""The registered queries of the subpackage, one for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerline.llm import (chat, embed_dedup, hosts, html, langid, mixing, packing, phrases, pii, quality, runs,
                            simhash, topk)
from ledgerline.llm.base import query, table, unused

#: From this score on a document counts as good.
KEEP_SCORE = 0.5


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op1_html_main_text")
def op1_html_main_text(spark, sf_dir):
    """Main text of every page."""
    return html.extract(table(spark, sf_dir, "pages"))


OP2_SQL = """
WITH v AS (
  SELECT vec_id, [floor(1024 * x::DOUBLE) for x in embedding] AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.x, c.x)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id AND len(q.x) = len(c.x)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
"""


@query("op2_exact_top_k", OP2_SQL)
def op2_exact_top_k(spark, sf_dir):
    """Ten best inner products for every row whose id is divisible by 100, over all rows."""
    vectors = table(spark, sf_dir, "embeddings")
    return topk.top_k(vectors, vectors.where("vec_id % 100 = 0"), k=10)


@query("op3_chat_windows", chat.ORACLE)
def op3_chat_windows(spark, sf_dir):
    """All conversations, and one of control strings, formatted in windows and read back."""
    own = spark.sql("SELECT * FROM VALUES (-7L, 0L, 'user', '</s>[INST] ok [/INST]'), "
                    "(-7L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t (conv_id, turn, role, text)")
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.chat_windows(given.unionByName(own)))


@query("op4_simhash_near_dedup")
def op4_simhash_near_dedup(spark, sf_dir):
    """SimHash of 3-word shingles, links at 3 or fewer differing bits, components."""
    found = simhash.simhash_components(table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op5_language_id")
def op5_language_id(spark, sf_dir):
    """Language of every document; a quarter of the ids is held out."""
    return langid.identify(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS x FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0
    AND len([x for x in embedding if x <> 0]) > 0),
e AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM embeddings UNION SELECT r.a, e.b FROM reach r JOIN e ON r.b = e.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
deg AS (SELECT a, count(*) AS n FROM e GROUP BY a)
SELECT m.vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, m.vec_id = component_id AS kept
FROM embeddings m JOIN low ON low.a = m.vec_id LEFT JOIN deg ON deg.a = m.vec_id
"""


@query("op6_embedding_near_dedup", OP6_SQL)
def op6_embedding_near_dedup(spark, sf_dir):
    """Links at cosine 0.98 within a label, and their components."""
    return embed_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


def labelled_languages(spark, sf_dir, docs, fit_rows=mixing.FIT_ROWS):
    """The labelled table of the mixture: of the documents that ``labels`` lists, about ``fit_rows`` chosen
    by a hash of the id, with their language. The chosen ids are few by that bound, so they are broadcast
    and no text is shuffled."""
    ids = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("_id")).where("_id IS NOT NULL").distinct()
    spread = F.pmod(F.xxhash64(F.lit(13), "_id"), F.lit(1 << 30)) / float(1 << 30)
    chosen = ids.where(spread < fit_rows / max(1, ids.count()))
    return docs.join(F.broadcast(chosen), docs["doc_id"] == F.col("_id"), "left_semi") \
        .select(docs["text"], docs["lang"].alias("domain"))


@query("op7_mix_sources")
def op7_mix_sources(spark, sf_dir):
    """Rates that bring expected tokens of each language domain to shares smoothed by the power 0.7."""
    docs = table(spark, sf_dir, "documents")
    mix, rows = mixing.fit_mixture(docs, labelled_languages(spark, sf_dir, docs), id_cols=("doc_id", "source"))
    return rows.select("doc_id", "source", F.col("tokens").cast("long").alias("tokens"),
                       F.array(*map(F.lit, mix.domains)).alias("domains"), "posterior", "rate",
                       mixing.copies(F.col("rate"), F.col("doc_id")).alias("copies"))


@query("op8_pii_skip_chain")
def op8_pii_skip_chain(spark, sf_dir):
    """Base patterns and what the skip-chain field adds, for every whole text."""
    return pii.find_pii(table(spark, sf_dir, "documents"))


@query("op9_best_fit_packing")
def op9_best_fit_packing(spark, sf_dir):
    """All documents in sequences of at most 4096 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), capacity=4096)


@query("op10_quality_co_training")
def op10_quality_co_training(spark, sf_dir):
    """Score and decision for every document."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    out = unused(docs, "score")
    scored = quality.score_quality(docs, model, out=out)
    return scored.select("doc_id", F.col(out).alias("score"), (F.col(out) >= KEEP_SCORE).alias("keep"))


OP11_RULES = "('com/', 'allow'), ('example.com/en/', 'block'), ('www.example.com/en/', 'allow'), " \
             "('net/es/', 'block'), ('net/fr/', 'block')"

OP11_SQL = r"""
WITH RECURSIVE pg AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') AS host, regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages),
bare AS (SELECT DISTINCT host, rtrim(regexp_replace(host, '^.*@|:[^:\]]*$', '', 'g'), '.') AS b FROM pg),
part AS (SELECT *, string_split(b, '.') AS s, len(string_split(b, '.')) AS n FROM bare),
cuts AS (SELECT *, CASE WHEN n > 2 AND length(s[n]) = 2 AND s[n - 1] IN ('ac', 'co', 'com', 'edu', 'gov', 'net', 'org')
                   THEN 2 ELSE 1 END AS k, regexp_matches(b, '^[0-9.]+$') AS digits FROM part),
names AS (SELECT host, CASE WHEN digits THEN b ELSE array_to_string(s[greatest(n - k, 1):n], '.') END AS domain,
                 CASE WHEN digits THEN '' ELSE array_to_string(s[greatest(n - k + 1, 1):n], '.') END AS suffix FROM cuts),
seen AS (SELECT doc_id, bool_or(quality = 0 OR toxic = 1) AS bad FROM labels WHERE (quality = 0 OR toxic = 1) IS NOT NULL
         AND doc_id IS NOT NULL GROUP BY doc_id),
hit AS (SELECT DISTINCT page_id, host, bad FROM pg JOIN seen ON page_id = doc_id),
counts AS (SELECT host, domain, suffix, count(*) AS n, count(*) FILTER (bad) AS bad FROM hit JOIN names USING (host) GROUP BY ALL),
top AS (SELECT (coalesce(sum(bad), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM counts),
tried AS (SELECT power(2.0::DOUBLE, j / 2.0) AS s FROM range(-2, 25) t(j)),
k1 AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM counts, top GROUP BY suffix),
s1 AS (SELECT s FROM k1, tried GROUP BY s ORDER BY round(sum(
  lgamma(bad + s * m) + lgamma(n - bad + s * (1 - m)) - lgamma(n + s) - lgamma(s * m) - lgamma(s * (1 - m)) + lgamma(s)), 6) DESC, s LIMIT 1),
m1 AS (SELECT suffix, (bad + s * m) / (n + s) AS m FROM k1, s1),
k2 AS (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad, any_value(m) AS m FROM counts JOIN m1 USING (suffix) GROUP BY suffix, domain),
s2 AS (SELECT s FROM k2, tried GROUP BY s ORDER BY round(sum(
  lgamma(bad + s * m) + lgamma(n - bad + s * (1 - m)) - lgamma(n + s) - lgamma(s * m) - lgamma(s * (1 - m)) + lgamma(s)), 6) DESC, s LIMIT 1),
m2 AS (SELECT suffix, domain, (bad + s * m) / (n + s) AS m FROM k2, s2),
k3 AS (SELECT host, n, bad, m FROM counts JOIN m2 USING (suffix, domain)),
s3 AS (SELECT s FROM k3, tried GROUP BY s ORDER BY round(sum(
  lgamma(bad + s * m) + lgamma(n - bad + s * (1 - m)) - lgamma(n + s) - lgamma(s * m) - lgamma(s * (1 - m)) + lgamma(s)), 6) DESC, s LIMIT 1),
post AS (
  SELECT host, coalesce(c.n, 0) AS n, coalesce(c.bad, 0) AS bad, coalesce(m2.m, m1.m, top.m) AS m, s
  FROM names LEFT JOIN counts c USING (host) LEFT JOIN m2 ON m2.suffix = names.suffix AND m2.domain = names.domain
  LEFT JOIN m1 ON m1.suffix = names.suffix, top, s3),
ab AS (SELECT host, n, bad, bad + s * m AS a, n - bad + s * (1 - m) AS b FROM post),
grid AS (SELECT host, n, bad, a, b, ln(a / b) + sqrt(1 / a + 1 / b) * sinh(-8 + 16 * i / 20000.0) AS u,
                cosh(-8 + 16 * i / 20000.0) AS w, ln(a / b) AS u0 FROM ab, range(0, 20001) t(i)),
mass AS (SELECT host, n, bad, u > 0 AS above, w * exp(a * (u - u0) - (a + b) * (greatest(u, 0) + ln(1 + exp(-abs(u)))
                - greatest(u0, 0) - ln(1 + exp(-abs(u0))))) AS d FROM grid),
told AS (SELECT host, any_value(n)::BIGINT AS labelled, any_value(bad)::BIGINT AS bad,
                coalesce(sum(d) FILTER (above), 0) / sum(d) >= 0.95 AS blocked FROM mass GROUP BY host),
rules AS (SELECT rule, verdict, string_split(rule, '/')[1] AS rh, substr(rule, length(string_split(rule, '/')[1]) + 1) AS rp
          FROM (VALUES """ + OP11_RULES + r""") t(rule, verdict)),
places AS (SELECT DISTINCT host, path FROM pg),
fit AS (SELECT host, path, rule, verdict, row_number() OVER (PARTITION BY host, path ORDER BY length(rule) DESC) AS r
        FROM places JOIN rules ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp))
SELECT page_id, pg.host, pg.path, fit.rule, coalesce(fit.verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict,
       labelled, bad
FROM pg JOIN told USING (host) LEFT JOIN fit ON fit.host = pg.host AND fit.path = pg.path AND fit.r = 1
"""


@query("op11_url_reputation", OP11_SQL)
def op11_url_reputation(spark, sf_dir):
    """Every page judged by the longest rule, else by its host's reputation. A labelled page is one whose id
    ``labels`` lists; its outcome is bad where the quality is 0 or it is toxic."""
    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"),
                                                     F.expr("quality = 0 OR toxic = 1").alias("bad"))
    rules = spark.sql(f"SELECT * FROM VALUES {OP11_RULES} AS t (rule, verdict)")
    return hosts.judge(table(spark, sf_dir, "pages"), outcomes, rules)


OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-
]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^ 	]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
f AS MATERIALIZED (SELECT lang, k AS size, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM i, range(1, 5) t(k) WHERE i + k - 1 <= len(w) GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
c AS MATERIALIZED (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 30),
parts AS MATERIALIZED (
  SELECT lang, phrase, f AS a, k, array_to_string(w[1:k], ' ') AS lp, array_to_string(w[k + 1:], ' ') AS rp
  FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
cut AS (SELECT p.lang, p.phrase, a, k, l.f AS l, r.f AS r, (2000000::HUGEINT * a) // (l.f + r.f) AS score
        FROM parts p JOIN f l ON l.lang = p.lang AND l.phrase = p.lp JOIN f r ON r.lang = p.lang AND r.phrase = p.rp),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(w[s:s + m - 1], ' ') AS phrase, max(f) AS f
           FROM c, range(2, 4) t(m), range(1, 4) u(s) WHERE m < size AND s + m - 1 <= size GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN inside USING (lang, phrase) WHERE inside.f IS NULL OR 100 * inside.f < 80 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""


@query("op12_phrase_collocations", OP12_SQL)
def op12_phrase_collocations(spark, sf_dir):
    """The 2000 tightest phrases of two to four words of every language, over all texts."""
    return phrases.collocations(table(spark, sf_dir, "documents"), least=30, top=2000)


def with_planted_runs(docs, id_col="doc_id", text_col="text"):
    """Texts of a tenth of the ids (by crc32) made periodic from one word on, in the row: the words of the
    first period are repeated and cut to the text's number of words."""
    docs = docs.select(F.col(id_col), F.col(text_col), F.crc32(F.col(id_col).cast("string").cast("binary")).alias("h"))
    space = " \t\n\x0b\x0c\r"
    words = F.split(F.btrim(text_col, F.lit(space)), "[\\x09-\\x0D\\x20]+")
    n = F.size(words)
    g = F.floor(F.col("h") / 10)
    a = (g % n).cast("int")
    p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    period = F.slice(words, a + 1, p)
    again = F.slice(F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int"))), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice(words, F.lit(1), a), again), " ")
    chosen = (F.col("h") % 10 == 0) & (F.btrim(text_col, F.lit(space)) != "")
    return docs.select(id_col, F.when(chosen, planted).otherwise(F.col(text_col)).alias(text_col))


@query("op13_periodic_runs")
def op13_periodic_runs(spark, sf_dir):
    """Runs of four periods or more in every text, and digests of the runs and of the text without them."""
    found = runs.periodic_runs(with_planted_runs(table(spark, sf_dir, "documents")), least_periods=4, least_words=6)
    told = F.expr("array_join(transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, '\\n')), '')")
    best = F.expr("array_max(transform(runs, r -> struct(r.length, -r.start AS s, -r.period AS p)))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.s")).alias("start"), F.col("best.length"),
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length DIV -best.p").alias("exponent_milli"),
        F.sha2(told.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
