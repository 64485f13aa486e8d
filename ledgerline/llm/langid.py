"""Language by string kernels: blended-spectrum presence kernel, Nyström landmarks, one-versus-rest ridge."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Labelled rows of each language that the classifier is fitted on (about; chosen by a hash of the id).
FIT_ROWS = 600
GRAMS, LANDMARKS = 4096, 192
#: Grams are hashed to 2^BITS codes.
BITS = 20
RIDGE = 1e-2
UNKNOWN = "und"


@lru_cache(maxsize=1)
def _letter() -> np.ndarray:
    """Whether a code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def _mixed(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        return ((x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - BITS)


def spectrum(text: str) -> np.ndarray:
    """Hash codes of all 1-, 2- and 3-grams of a whole text in lower case, over its letters as they are; a run of
    characters that aren't letters is one symbol. Codes repeat."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), dtype="<u4")
    s = np.where(_letter()[points], points, 0).astype(np.uint64)
    s = np.concatenate([[0], s[np.concatenate([[True], (s[1:] > 0) | (s[:-1] > 0)])] if len(s) else s, [0]]).astype(np.uint64)
    size = np.uint64(0x110000)
    two = (s[:-1] + np.uint64(1)) * size + s[1:]
    three = two[:-1] * size + s[2:]
    return _mixed(np.concatenate([s, two, three])).astype(np.int64)


def presence(grams: list[np.ndarray], columns: np.ndarray) -> np.ndarray:
    """Row for each text, given by its gram codes: 1 where a gram of the vocabulary occurs, divided by the norm
    (the kernel of two texts is then the inner product of their rows)."""
    out = np.zeros((len(grams), GRAMS), dtype=np.float32)
    for i, g in enumerate(grams):
        at = columns[g]
        out[i, at[at >= 0]] = 1
    return out / np.sqrt(np.maximum(out.sum(1, keepdims=True), 1))


@dataclass
class KernelRidge:
    langs: list[str]
    columns: np.ndarray | None = None  # gram code to vocabulary column, -1 for none
    landmarks: np.ndarray | None = None  # presence rows of the landmarks
    weights: np.ndarray | None = None  # landmark kernels (and 1) to one score for each language

    @classmethod
    def fit(cls, grams: list[np.ndarray], langs: list[str]) -> KernelRidge:
        """Gram codes of texts in a fixed order: landmarks are taken in turn from each language. The vocabulary
        is of the grams that most texts of some language hold, so that no script crowds another out."""
        names = sorted(set(langs))
        if len(names) < 2:
            return cls(names)
        share = np.zeros(1 << BITS)
        for name in names:
            mine = [np.unique(g) for g, x in zip(grams, langs, strict=True) if x == name]
            share = np.maximum(share, np.bincount(np.concatenate(mine), minlength=1 << BITS) / len(mine))
        best = np.argsort(-share, kind="stable")[:GRAMS]
        best = best[share[best] > 0]
        columns = np.full(1 << BITS, -1, dtype=np.int32)
        columns[best] = np.arange(len(best))
        x = presence(grams, columns)
        y = np.array([names.index(n) for n in langs])
        turn = np.argsort(np.array([(y[:i] == y[i]).sum() for i in range(len(y))]), kind="stable")
        marks = x[turn[:LANDMARKS]]
        k_mm = (marks @ marks.T).astype(np.float64)
        value, vector = np.linalg.eigh(k_mm)
        keep = value > 1e-6 * value.max()
        root = vector[:, keep] / np.sqrt(value[keep])  # Nyström: features whose inner products are the kernel's
        z = np.hstack([(x @ marks.T) @ root, np.ones((len(x), 1))])
        target = np.where(y[:, None] == np.arange(len(names))[None, :], 1.0, -1.0)
        share = 1.0 / np.bincount(y)[y]  # each language weighs the same
        a = (z * share[:, None]).T @ z + RIDGE / len(x) * np.eye(z.shape[1])
        w = np.linalg.solve(a, (z * share[:, None]).T @ target)
        return cls(names, columns, marks, np.vstack([root @ w[:-1], w[-1:]]).astype(np.float32))

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        ok = np.array([bool(t) and any(map(str.isalpha, t)) for t in texts], dtype=bool)
        langs, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
        if not self.langs or not ok.any():
            return langs, score
        rows = np.flatnonzero(ok)
        if self.landmarks is None:
            for i in rows:
                langs[i] = self.langs[0]
            score[rows] = 1.0
            return langs, score
        for at in range(0, len(rows), 256):
            part = rows[at:at + 256]
            kernel = presence([spectrum(texts[i]) for i in part], self.columns) @ self.landmarks.T
            f = kernel @ self.weights[:-1] + self.weights[-1]
            best = f.argmax(1)
            score[part] = np.clip((f[np.arange(len(part)), best] + 1) / 2, 0, 1)
            for i, b in zip(part, best, strict=True):
                langs[i] = self.langs[b]
        return langs, score


def held_out(id_col: str = "doc_id"):
    """crc32 of the id as text, mod 4, is 2 (false for a null id, which isn't learned from either)."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  fit_rows: int = FIT_ROWS) -> KernelRidge:
    """Fit on text and language of about ``fit_rows`` rows of each language that aren't held out (never
    more than twice as many in all); rows without id, text or language aren't used."""
    rows = docs.where(~held_out(id_col)).select(
        F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")) \
        .where("id IS NOT NULL AND lang IS NOT NULL AND text IS NOT NULL AND text <> ''")
    n = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}
    if not n:
        return KernelRidge([])
    share = F.element_at(F.create_map(*[F.lit(x) for k, v in n.items() for x in (k, fit_rows / v)]), F.col("lang"))
    spread = F.pmod(F.xxhash64(F.lit(5), "id", "text"), F.lit(1 << 30)) / float(1 << 30)
    chosen = rows.where(spread < share).select("id", "lang", "text", spread.alias("s"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            codes = [np.unique(spectrum(t)).astype("<i4").tobytes() for t in b.column(2).to_pylist()]
            yield pa.record_batch([b.column(0), b.column(1), b.column(3), pa.array(codes, pa.binary())], names=["id", "lang", "s", "codes"])

    # the gram sets of the chosen rows reach the driver, 2^BITS codes at most each; ties of the hash by what they hold
    got = chosen.mapInArrow(run, "id long, lang string, s double, codes binary") \
        .orderBy("s", "id", "lang", "codes").limit(2 * fit_rows * len(n)).collect()
    return KernelRidge.fit([np.frombuffer(r["codes"], dtype="<i4").astype(np.int64) for r in got], [r["lang"] for r in got])


def identify(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
             model: KernelRidge | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row, from its whole text alone.

    Null texts and texts without a letter are ``und`` with score 0, as is everything if there is no
    labelled row; with one learned language every other text is that one. Of equal scores the language
    first by name counts. Repeated rows give repeated rows; an empty table gives no rows. A text of any
    length is read whole, about 40 bytes a character in its task. Other columns aren't read.
    """
    fitted = model or fit_languages(docs, id_col, text_col, lang_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            langs, score = fitted.predict(b.column(2).to_pylist())
            yield pa.record_batch([b.column(0), b.column(1), pa.array(langs, pa.string()), pa.array(score, pa.float64())],
                                  names=["doc_id", "held_out", "lang_pred", "score"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), held_out(id_col).alias("held_out"),
                       F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")
