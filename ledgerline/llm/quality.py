"""Quality classifier by co-training: a text view and a metadata view teach each other."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled, and unlabelled, rows the two classifiers are fitted on (about; chosen by a hash of the id).
FIT_ROWS = 8_000
ROUNDS = 4
#: Pseudo-labels a view hands over in a round, at most, and how sure it must be of them.
PER_ROUND, SURE = 1_000, 0.97
META = 64

# Byte classes: 0 space, 1 lower, 2 upper, 3 digit, 4 . and , 5 other ASCII, 6 beyond ASCII
_CLASS = np.full(256, 5, dtype=np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = 0
_CLASS[ord("a"):ord("z") + 1] = 1
_CLASS[ord("A"):ord("Z") + 1] = 2
_CLASS[ord("0"):ord("9") + 1] = 3
_CLASS[[ord("."), ord(",")]] = 4
_CLASS[128:] = 6
KINDS = 7
#: Hash places of the words.
WORD_DIMS = 256
SHAPE_DIMS = KINDS ** 2 + 8
TEXT_DIMS = SHAPE_DIMS + WORD_DIMS


def text_view(text: str | None) -> np.ndarray:
    """Features of a whole text: shares of byte-class pairs (root), how much words and lines repeat, and shares
    of its words (root), hashed."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    out = np.zeros(TEXT_DIMS, dtype=np.float32)
    if not raw:
        return out
    kind = _CLASS[np.frombuffer(raw, dtype=np.uint8)]
    pairs = np.bincount(kind[:-1] * KINDS + kind[1:], minlength=KINDS ** 2)[:KINDS ** 2]
    out[:KINDS ** 2] = np.sqrt(pairs / max(1, pairs.sum()))
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x]
    n = max(1, len(words))
    counts = Counter(words)
    distinct = len(counts)
    twice = len(set(zip(words[:-1], words[1:], strict=True)))
    out[KINDS ** 2:SHAPE_DIMS] = [np.log1p(len(raw)) / 10, np.log1p(n) / 10, distinct / n ** 0.8, len(raw) / n / 10,
                        twice / max(1, n - 1), len(set(lines)) / max(1, len(lines)), distinct / n,
                        np.log1p(n / max(1, distinct))]
    places = np.fromiter(map(zlib.crc32, counts), dtype=np.int64, count=distinct) % WORD_DIMS
    out[SHAPE_DIMS:] = np.sqrt(np.bincount(places, np.fromiter(counts.values(), np.float64, distinct), WORD_DIMS) / n)
    return out


def meta_view(lang: str | None, source: str | None, n_chars: int | None) -> np.ndarray:
    """Features of what is known about a page besides its text."""
    out = np.zeros(META + 24, dtype=np.float32)
    out[xxhash.xxh32_intdigest(f"source={source}") % META] += 1
    out[xxhash.xxh32_intdigest(f"lang={lang}") % META] += 1
    out[META + (23 if n_chars is None else min(22, max(0, int(n_chars)).bit_length()))] = 1
    return out


@dataclass
class Logistic:
    """Logistic regression with a ridge, on standardised features, fitted by Newton steps."""

    weights: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    @classmethod
    def fit(cls, x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 25) -> Logistic:
        x = x.astype(np.float64)
        mean, scale = x.mean(0), x.std(0) + 1e-3
        z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
        w = np.zeros(z.shape[1])
        penalty = np.full(z.shape[1], ridge)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
            hess = (z * (p * (1 - p))[:, None]).T @ z + np.diag(penalty)
            move = np.linalg.solve(hess, z.T @ (p - y) + penalty * w)
            w = w - move
            if np.abs(move).max() < 1e-6:
                break
        return cls(w, mean, scale)

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale @ self.weights[:-1] + self.weights[-1], -30, 30)


@dataclass
class CoTrained:
    """Two views, and the calibration that joins their logits; ``prior`` alone without usable labels."""

    text: Logistic | None = None
    meta: Logistic | None = None
    joined: Logistic | None = None
    prior: float = 1.0

    def score(self, t: np.ndarray, m: np.ndarray) -> np.ndarray:
        if self.joined is None:
            return np.full(len(t), self.prior)
        both = np.stack([self.text.logit(t), self.meta.logit(m)], axis=1)
        return 1 / (1 + np.exp(-self.joined.logit(both)))


def co_train(t: np.ndarray, m: np.ndarray, y: np.ndarray, fold: np.ndarray, rounds: int = ROUNDS) -> CoTrained:
    """``y``: 1, 0 or -1 (unlabelled). A quarter of the labelled rows (``fold`` 0) calibrates: it trains
    neither view. In each round a view labels unlabelled rows it is sure of, for the other view."""
    labelled = y >= 0
    if len(set(y[labelled])) < 2:
        return CoTrained(prior=float(y[labelled].mean()) if labelled.any() else 1.0)
    train = labelled & (fold != 0)
    if len(set(y[train])) < 2 or len(set(y[labelled & (fold == 0)])) < 2:
        train = labelled
    held = labelled & (fold == 0) if (train != labelled).any() else labelled
    own = {"t": np.where(train, y, -1), "m": np.where(train, y, -1)}
    views = {"t": t, "m": m}
    fitted = {}
    for k in range(rounds + 1):
        fitted = {v: Logistic.fit(views[v][own[v] >= 0], own[v][own[v] >= 0]) for v in views}
        if k == rounds:
            break
        for v, other in (("t", "m"), ("m", "t")):
            open_rows = np.flatnonzero((own[other] < 0) & ~labelled)
            logit = fitted[v].logit(views[v][open_rows])
            sure = np.abs(logit) > np.log(SURE / (1 - SURE))
            pick = open_rows[sure][np.argsort(-np.abs(logit[sure]), kind="stable")[:PER_ROUND]]
            own[other][pick] = (fitted[v].logit(views[v][pick]) > 0).astype(int)
    both = np.stack([fitted["t"].logit(t[held]), fitted["m"].logit(m[held])], axis=1)
    return CoTrained(fitted["t"], fitted["m"], Logistic.fit(both, y[held], ridge=0.1), float(y[held].mean()))


def _columns(docs: DataFrame, names: dict[str, str]):
    have = {c.lower() for c in docs.columns}
    kinds = {"text": "string", "lang": "string", "source": "string", "n_chars": "long"}
    return [(F.col(f"`{names[k]}`") if names[k].lower() in have else F.lit(None)).cast(kind).alias(k)
            for k, kind in kinds.items()]


NAMES = {"text": "text", "lang": "lang", "source": "source", "n_chars": "n_chars"}


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality",
                fit_rows: int = FIT_ROWS, names: dict[str, str] = NAMES) -> CoTrained:
    """Fit on about ``fit_rows`` labelled and as many unlabelled documents, chosen by a hash of the id.

    Labels other than 0 and 1 are left out; an id labelled both ways counts as 0. Only the features of
    the chosen rows reach the driver (about 1.6 KB each; never more than ``4 * fit_rows`` rows, those of the
    smallest hashes, should an id be repeated very often). Repeated rows are fitted as often as they occur.
    """
    marks = labels.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()) \
        .groupBy(F.col(id_col).cast("long").alias("id")).agg(F.min(label_col).cast("int").alias("y"))
    total, known = docs.count(), marks.count()
    spread = F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 30)) / float(1 << 30)
    base = docs.select(docs[id_col].cast("long").alias("id"), *_columns(docs, names)).where("id IS NOT NULL")
    chosen = marks.where(spread < fit_rows / max(1, known))
    some = base.where(spread < fit_rows / max(1, total)).join(marks, "id", "left_anti") \
        .withColumn("y", F.lit(-1))
    # the chosen marks are at most about fit_rows rows: a proven bound
    rows = base.join(F.broadcast(chosen), "id").unionByName(some)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            c = {n: b.column(n).to_pylist() for n in b.schema.names}
            x = [text_view(v).tobytes() for v in c["text"]]
            z = [meta_view(*v).tobytes() for v in zip(c["lang"], c["source"], c["n_chars"], strict=True)]
            fold = [xxhash.xxh32_intdigest(str(i)) % 4 for i in c["id"]]
            yield pa.record_batch([pa.array(c["id"], pa.int64()), pa.array(c["y"], pa.int32()),
                                   pa.array(fold, pa.int32()), pa.array(x, pa.binary()), pa.array(z, pa.binary())],
                                  names=["id", "y", "fold", "t", "m"])

    # features first, so that texts stay where they are read; the order makes a limit that bites repeatable
    made = rows.mapInArrow(run, "id long, y int, fold int, t binary, m binary")
    first = made.orderBy(F.pmod(F.xxhash64(F.lit(11), "id"), F.lit(1 << 30)), "id", "y", "t", "m").limit(4 * fit_rows)
    got = sorted(first.collect(), key=lambda r: (r["id"], r["y"], bytes(r["t"]), bytes(r["m"])))
    if not got:
        return CoTrained()
    stack = lambda k: np.stack([np.frombuffer(r[k], dtype=np.float32) for r in got])
    return co_train(stack("t"), stack("m"), np.array([r["y"] for r in got]), np.array([r["fold"] for r in got]))


def score_quality(docs: DataFrame, model: CoTrained, names: dict[str, str] = NAMES, out: str = "score") -> DataFrame:
    """``docs`` with a score of 0 to 1 (column ``out``; an existing one is an error: see ``base.unused`` for a
    free name). A null or empty text has nothing to keep: its score is 0. Equal rows get equal scores; a
    text of any length is read whole."""
    if out.lower() in {c.lower() for c in docs.columns}:
        raise ValueError(f"column {out} exists")
    at = {c.lower(): i for i, c in enumerate(docs.columns)}
    place = [at.get(names[k].lower()) for k in ("text", "lang", "source", "n_chars")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            text, lang, source, n = ([None] * b.num_rows if i is None else b.column(i).to_pylist() for i in place)
            score = np.zeros(0)
            if text:
                t = np.stack([text_view(x) for x in text])
                m = np.stack([meta_view(*x) for x in zip(lang, source, n, strict=True)])
                score = np.where([not (x or "").strip() for x in text], 0.0, model.score(t, m))
            yield pa.record_batch([*b.columns, pa.array(score, pa.float64())], names=[*b.schema.names, out])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField(out, T.DoubleType())]))
