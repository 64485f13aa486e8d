"""Phrase collocations: counts of the longest windows, marginalised to all shorter phrases by one ROLLUP."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.base import cut

#: Columns of the longest window.
WORDS = ("w1", "w2", "w3", "w4")
SCALE = 2000000
#: Pairs and triples of neighbouring words are counted in 2^GRAM_BITS buckets; a bit for each (16 MB) is broadcast.
GRAM_BITS = 27
#: A worker gathers about so many bytes of text before it counts (a longer text is gathered alone).
GATHER = 3 << 19
#: Ranking takes the first rows of this many parts of a language before those of the language.
PARTS = 64

#: A-Z lower-cased, piece ends to a line feed, tab to blank.
BYTES = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ.,;:!?\x0b\x0c\r\t",
                        b"abcdefghijklmnopqrstuvwxyz" + b"\n" * 9 + b" ")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes], np.ndarray]]:
    """(lang, words, ids): texts of one lang as word numbers in order, 0 at the end of every piece."""
    held: dict[str, list[bytes]] = defaultdict(list)
    sizes: dict[str, int] = defaultdict(int)

    def words(lang):
        sizes.pop(lang)
        tokens = b"\n".join(held.pop(lang)).translate(BYTES).replace(b"\n", b" \n ").split(b" ")
        number = defaultdict(count().__next__)
        number[b"\n"], number[b""]
        ids = np.fromiter(map(number.__getitem__, tokens), dtype=np.int64, count=len(tokens))
        ids = np.append(ids[ids != 1], 0)
        return lang, list(number), np.where(ids > 0, ids - 1, 0)

    for b in batches:
        for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            held[lang].append(text.as_py() or b"")
            sizes[lang] += len(held[lang][-1]) + 1
            if sizes[lang] >= GATHER:
                yield words(lang)
    for lang in list(held):
        yield words(lang)


class Grams:
    """Buckets of the sequences of neighbouring words in one gathered text."""

    def __init__(self, lang: str, words: list[bytes], ids: np.ndarray):
        import pandas as pd

        h = pd.util.hash_array(np.array([lang.encode(), b"", *words[2:]], dtype=object), categorize=False)
        self.seed, self.hash, self.ids = h[0], np.append(np.uint64(0), h[2:])[ids], ids

    def buckets(self, k: int) -> np.ndarray:
        """Bucket of the ``k`` words from each place on."""
        mixed = np.full(len(self.ids), self.seed)
        with np.errstate(over="ignore"):
            for j in range(k):
                later = np.append(self.hash[j:], np.zeros(min(j, len(self.ids)), np.uint64))
                mixed = (mixed + later) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(29)
            mixed = mixed * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(64 - GRAM_BITS)).astype(np.int64)

    def possible(self, k: int, known: dict[int, np.ndarray]) -> np.ndarray:
        """Places where ``k`` words stand in one piece and no shorter sequence inside, as far as ``known``, is
        too rare."""
        ok = self.ids > 0
        for j in range(1, k):
            ok = ok & np.append(self.ids[j:] > 0, np.zeros(min(j, len(ok)), bool))
        for n, bits in known.items():
            if n <= k:
                b = self.buckets(n)
                often = (bits[b >> 3] >> (b & 7).astype(np.uint8) & 1) > 0
                for j in range(k - n + 1):
                    ok = ok & np.append(often[j:], np.zeros(min(j, len(ok)), bool))
        return ok


def frequent_grams(texts: DataFrame, k: int, least: int, known) -> np.ndarray:
    """Bits of the buckets that hold ``least`` sequences of ``k`` words or more, as bytes: of fixed size,
    whatever the input. Only sequences that the shorter ones ``known`` leave possible are counted.

    A bucket's count is never below that of a sequence in it, so one whose bit is unset occurs less often.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in gathered(batches):
            g = Grams(lang, words, ids)
            b, n = np.unique(g.buckets(k)[g.possible(k, known.value)], return_counts=True)
            yield pa.record_batch([pa.array(b), pa.array(n)], names=["b", "n"])

    sums = texts.mapInArrow(run, "b long, n long").groupBy("b").agg(F.sum("n").alias("n"))
    blocks = sums.where(F.col("n") >= least).groupBy(F.shiftright("b", 15).alias("block")) \
        .agg(F.bitmap_construct_agg(F.col("b").bitwiseAND(F.lit((1 << 15) - 1))).alias("bits"))
    bits = np.zeros((1 << GRAM_BITS >> 15, 1 << 12), dtype=np.uint8)
    for r in blocks.toLocalIterator():
        bits[r.block] = np.frombuffer(r.bits, dtype=np.uint8)
    return bits.reshape(-1)


def windows(texts: DataFrame, known) -> DataFrame:
    """lang, w1..w4, c: for every word the window that starts there. It is padded with NULL from where its
    piece ends, or from the first word up to which ``known`` shows it to be too rare for any phrase.

    The lead columns are the numbered words of a text shifted by one, two and three places.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, words, ids in gathered(batches):
            g = Grams(lang, words, ids)
            lead = [np.where(g.possible(k + 1, known.value), np.append(ids[k:], np.zeros(min(k, len(ids)), np.int64)), 0)
                    for k in range(len(WORDS))]
            here = ids > 0
            left, right = (np.unique(lead[k][here] * len(words) + lead[k + 1][here], return_inverse=True) for k in (0, 2))
            both, n = np.unique(left[1] * max(1, len(right[0])) + right[1], return_counts=True)
            p, q = left[0][both // max(1, len(right[0]))], right[0][both % max(1, len(right[0]))]
            names = pa.array([None, *words[2:]], pa.binary())
            cols = [names.take(pa.array(x)).cast(pa.string()) for x in
                    (p // len(words), p % len(words), q // len(words), q % len(words))]
            yield pa.record_batch([pa.array([lang] * len(n), pa.string()), *cols, pa.array(n)],
                                  names=["lang", *WORDS, "c"])

    return texts.mapInArrow(run, "lang string, w1 string, w2 string, w3 string, w4 string, c long")


def phrase_counts(docs: DataFrame, least: int = 30, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, size, phrase, f: all phrases of 1 to 4 words that occur ``least`` times or more, and for every
    lang one row of size 0 with the number of its words."""
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"),
                        F.col(text_col).cast("string").cast("binary").alias("text"))
    known = {}
    for k in (2, 3):
        known[k] = frequent_grams(texts, k, least, spark.sparkContext.broadcast(dict(known)))
    longest = windows(texts, spark.sparkContext.broadcast(known)).groupBy("lang", *WORDS).agg(F.sum("c").alias("c"))
    rolled = spark.sql("SELECT lang, w1, w2, w3, w4, grouping_id() AS g, sum(c) AS f "
                       "FROM {longest} GROUP BY lang, ROLLUP (w1, w2, w3, w4)", longest=longest)
    size = sum((F.col("g").bitwiseAND(1 << i) == 0).cast("int") for i in range(len(WORDS)))
    # a set that ends in padding is a shorter window: its shorter set counts it
    ended = F.element_at(F.array(*WORDS), F.greatest(F.col("size"), F.lit(1)))
    return rolled.withColumn("size", size) \
        .where((F.col("size") == 0) | ((F.col("f") >= least) & ended.isNotNull())) \
        .select("lang", "size", F.concat_ws(" ", *WORDS).alias("phrase"), "f")


def collocations(docs: DataFrame, least: int = 30, top: int = 2000, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to 4 words.

    Texts are lower-cased (A-Z), split into pieces at ``.,;:!?`` and line ends, and into words at blank and
    tab; phrases lie within a piece. ``a`` counts all occurrences of the phrase (``least`` or more); cut
    after its first words it has parts of counts ``l`` and ``r``, and its score is that of the lowest of
    floor(2000000 a / (l + r)), ties to the shortest first part. A phrase whose words lie inside a longer
    one that occurs at least 0.8 times as often is dropped. Order: score and ``a`` descending, phrase by
    bytes.

    Every word's longest window is counted once; one ROLLUP sums the counts of all shorter phrases, which
    are prefixes of windows. Before that, counts of word pairs, then triples, in a fixed number of buckets
    show which of them stay below ``least``: a window ends before such a one is whole, as no phrase that
    holds it counts. The bits are one-sided, so counts are exact; with very many words all bits are set and
    windows are only longer. Phrases that pass are joined with their parts and their longer phrases by key.

    A null text is empty, a null lang ``und``. A text without words gives nothing, nor does an empty table.
    Repeated rows count as often as they occur. A text of any length is counted as a whole, in one task
    (about 100 bytes a word). Other columns aren't read.
    """
    kept = cut(phrase_counts(docs, least, text_col, lang_col))
    known = kept.where("size > 0").select("lang", "size", "phrase", "f")
    cand = known.where("size > 1").withColumn("w", F.split("phrase", " "))
    cuts = cand.select("lang", "phrase", F.col("f").alias("a"), "size", "w",
                       F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    part = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    cuts = cuts.select("lang", "phrase", "a", "size", "k", part(F.lit(1), F.col("k")).alias("lp"),
                       part(F.col("k") + 1, F.col("size") - F.col("k")).alias("rp"))
    of = lambda side, n: known.select("lang", F.col("phrase").alias(side), F.col("f").alias(n))
    scored = cuts.join(of("lp", "l"), ["lang", "lp"]).join(of("rp", "r"), ["lang", "rp"])
    score = F.expr(f"CAST((CAST(a AS DECIMAL(19,0)) * {SCALE}) DIV (CAST(l AS DECIMAL(19,0)) + r) AS BIGINT)")
    best = scored.withColumn("score", score).groupBy("lang", "phrase").agg(
        F.min("a").alias("a"), F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("b"))
    inner = cand.where("size > 2").select(
        "lang", "f", F.explode(F.expr(
            "flatten(transform(sequence(2, size - 1), m -> transform(sequence(1, size - m + 1), "
            "i -> array_join(slice(w, i, m), ' '))))")).alias("phrase"))
    longer = inner.groupBy("lang", "phrase").agg(F.max("f").alias("of_longer"))
    left = best.join(longer, ["lang", "phrase"], "left").where(
        "of_longer IS NULL OR CAST(of_longer AS DECIMAL(19,0)) * 100 < CAST(a AS DECIMAL(19,0)) * 80")
    total = kept.where("size = 0").select("lang", F.col("f").alias("n"))
    rows = left.select("lang", "phrase", "a", "b.l", "b.r", "b.score")
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    salted = rows.withColumn("_p", F.pmod(F.xxhash64("phrase"), F.lit(PARTS)))
    first = salted.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_p").orderBy(*order))) \
        .where(F.col("_r") <= top).drop("_r", "_p")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))) \
        .where(F.col("rank") <= top)
    return ranked.join(total, "lang") \
        .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
