"""Personal data by a skip-chain conditional random field over a document's number- and address-like tokens.

Base patterns give sure spans, the observed nodes. Runs of digits joined by spaces, dots, hyphens and brackets
that spell an observed number again are one node each, and so is every other token with a digit or an ``@``;
their labels are inferred. Neighbouring nodes are linked (chain), and tokens of the same document
that repeat or resemble each other (same address, or same digits whatever the separators) share one label:
each observed one of them votes for its kind by the agreement weight, and what the others bring (shape, word
before, neighbours) counts once, as their mean, however often the value is repeated. Loopy belief
propagation then carries labels over the links until its messages settle, so that a number written once with
and many times without its prefix gets one label. Potentials are fitted piecewise, from counts over all
documents of what the base patterns label.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

KINDS = ("email", "ip", "card", "phone")
LABELS = ("none", *KINDS)

# The base patterns
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

HINT = re.compile(r"[0-9@]")
NODE = re.compile(r"[A-Za-z0-9._%+()-]*[0-9@][A-Za-z0-9@._%+()-]*")
RUN = re.compile(r"[0-9]+(?:[\x20().-]+[0-9]+)*")
DIGITS = re.compile(r"[0-9]+")

#: Buckets of token shapes and of words before a token; the model's size.
BUCKETS = 4096
#: A node is labelled from this marginal on. Without a link, a shape alone counts at most ALONE.
SURE, ALONE, FLOOR = 0.9, 0.35, 0.02
#: Observed pairs of equal keys and equal kinds taken as given before any are counted (seven digits agree by
#: chance in one of 10^7), so that a small corpus trusts agreement as much as a large one. Without contrary
#: pairs one observed node then gives SURE against all that FLOOR, the word before and two neighbours can say.
AGREE = 160_000
#: Messages are passed until none changes by SETTLED. From SLOW rounds on the steps shrink, and ROUNDS is
#: the end for a field that still swings.
SETTLED, SLOW, ROUNDS = 1e-4, 100, 2000


def luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    even = sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])
    return (odd + even) % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind index) of the base patterns, leftmost non-overlapping per kind, unsorted."""
    out = []
    if not HINT.search(text):
        return out
    end = 0
    at = text.find("@")
    while at >= 0:  # an address has its @ after the longest run of local characters: find that first
        first = at
        while first > end and LOCAL.match(text[first - 1]):
            first -= 1
        m = DOMAIN.match(text, at + 1) if first < at else None
        if m:
            end = m.end()
            out.append((first, end, 0))
        at = text.find("@", max(at + 1, end))
    for m in IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((*m.span(), 1))
    for m in CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 12 <= len(digits) <= 19 and luhn(digits):
            out.append((*m.span(), 2))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((*m.span(), 3))
    return out


def shape(token: str) -> int:
    """Bucket of a token's shape: letters as a, digit runs by their length, other characters as they are."""
    s = re.sub(r"[A-Za-z]+", "a", token)
    return zlib.crc32(re.sub(r"[0-9]+", lambda m: f"<{min(len(m[0]), 20)}>", s).encode()) % BUCKETS


def word_before(text: str, start: int) -> str:
    """The whole word before a place, at most three other characters away; '' if there is none."""
    end = start
    while end > 0 and start - end < 3 and not (text[end - 1].isalnum() or text[end - 1] == "_"):
        end -= 1
    at = end
    while at > 0 and text[at - 1].isalpha():
        at -= 1
    return text[at:end].lower()


def skip_key(token: str, label: int, known: dict[str, dict[str, int]]) -> str | None:
    """What repeated or similar tokens share: the address in lower case, or the whole number. A token that
    isn't observed shares the number of ``known`` (last seven digits to numbers and labels) that it spells."""
    if "@" in token:
        return token.lower().strip(".")
    digits = only_digits(token)
    if len(digits) < 7:
        return None
    if not label:
        for number, of in known.get(digits[-7:], {}).items():
            if spells(token, number, of):
                return number
    return digits


def spells(token: str, number: str, label: int) -> bool:
    """Whether a token is an observed number written again: the same digits, or a phone number without its
    prefix. A zero alone, as in 49 (0)30, may be no digit of it."""
    groups = DIGITS.findall(token)
    return any(digits == number or LABELS[label] == "phone" and agrees(digits, number) is not None
               for digits in {"".join(groups), "".join(g for g in groups if g.strip("0"))})


def observed_numbers(text: str, spans) -> dict[str, dict[str, int]]:
    """Last seven digits to the numbers of (start, end, label) that end so."""
    known: dict[str, dict[str, int]] = {}
    for start, end, label in spans:
        digits = only_digits(text[start:end]) if label > 1 else ""
        if len(digits) >= 7:
            known.setdefault(digits[-7:], {})[digits] = label
    return known


def only_digits(text: str) -> str:
    return re.sub(r"[^0-9]", "", text)


def agrees(group: str, rest: str) -> str | None:
    """What is left of ``rest``, an observed number's digits, before ``group``; None if it doesn't end so.
    Zeros that stand for a prefix (030 for +49 30, 0049 for +49) or that the observed form alone has, as in
    +49 (0)30, make no difference."""
    bare = group.lstrip("0")
    for own, of in ((group, rest), (bare, rest), (bare, rest.rstrip("0"))):
        if own and of.endswith(own):
            return of[:-len(own)]
    return None


def repeats(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """(start, end) of the runs of digit groups outside the base spans that spell a number of theirs again: the
    last seven digits are the same, no dot or hyphen joins them to more digits, as many groups before them
    belong to it as agree with the whole number, and all their digits spell it (see :func:`spells`)."""
    known = observed_numbers(text, [(a, b, k + 1) for a, b, k in spans])
    out: list[tuple[int, int]] = []
    at = 0
    for stop, after in [*((s[0], s[1]) for s in spans), (len(text), len(text))] if known else ():
        for m in RUN.finditer(text, at, max(at, stop)):
            groups = [g.span() for g in DIGITS.finditer(text, *m.span())]
            spelt = only_digits(m[0])
            took, j, have = [], len(groups) - 1, len(spelt)
            while j >= 0 and have >= 7:
                inside = j + 1 < len(groups) and groups[j + 1][0] == groups[j][1] + 1 and text[groups[j][1]] in ".-"
                whole = None if inside else known.get(spelt[have - 7:have])
                i, size = j, groups[j][1] - groups[j][0]
                if whole:
                    while size < 7:
                        i -= 1
                        size += groups[i][1] - groups[i][0]
                    end, tail = j, spelt[have - size:have]
                    best = i
                    for number in whole:
                        rest, k = agrees(tail, number), i
                        while rest and k:
                            k -= 1
                            group = text[slice(*groups[k])]
                            if group.strip("0"):
                                rest = agrees(group, rest)
                                if rest is None:
                                    break
                                best = min(best, k)
                            elif rest.endswith(group):
                                rest = rest[:-len(group)]
                                best = min(best, k)
                    size += sum(b - a for a, b in groups[best:i])
                    i = best
                    first, last = groups[i][0], groups[end][1]
                    inner = text[first:last]
                    again = any(spells(inner, number, label) for number, label in whole.items())
                    if inner.count(")") > inner.count("(") and first > at and text[first - 1] == "(":
                        first -= 1
                    elif inner.count("(") > inner.count(")") and last < stop and text[last] == ")":
                        last += 1
                    if again:
                        took.append((first, last))
                have -= size
                j = i - 1
            out += took[::-1]
        at = max(at, after)
    return out


def candidates(text: str, spans: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """(start, end, kind + 1 or 0) by start: base spans (overlapping ones under the first), the runs that repeat
    one, and the other tokens."""
    out = []
    for start, end, kind in sorted([*((a, b, k + 1) for a, b, k in spans), *((a, b, 0) for a, b in repeats(text, spans))]):
        if not out or start >= out[-1][1]:
            out.append((start, end, kind))
        elif kind and end > out[-1][1]:
            out[-1] = (out[-1][0], end, out[-1][2])
    sure, at = out, 0
    out = []
    for m in NODE.finditer(text):
        start, end = m.span()
        while end > start and text[end - 1] in ".,-(":
            end -= 1
        while start < end and text[start] in ".,-)":
            start += 1
        while at < len(sure) and sure[at][0] < end:
            out.append(sure[at])
            at += 1
        if start < end and (not out or out[-1][1] <= start):
            out.append((start, end, 0))
    return out + sure[at:]


def nodes(text: str, base: list[tuple[int, int, int]]):
    """Nodes (start, end, shape, word before, observed label or 0), chain links (i, j), and for each node the
    first node with its key (itself, if none is before it or it has no key)."""
    out, links, first, same = [], [], {}, []
    parts = candidates(text, sorted(base))
    known = observed_numbers(text, parts)
    for start, end, label in parts:
        w = word_before(text, start)
        word = zlib.crc32(w.encode()) % BUCKETS if w else 0
        i = len(out)
        out.append((start, end, shape(text[start:end]), word, label))
        if i and start - out[i - 1][1] <= 2:
            links.append((i - 1, i))
        key = skip_key(text[start:end], label, known)
        same.append(first.setdefault(key, i) if key else i)
    return out, links, same


def count_batch(texts: list[str | None]) -> Counter:
    """(what, bucket, label) and (link kind, label, label) counts of some texts."""
    c: Counter = Counter()
    for text in texts:
        if not text or not HINT.search(text):
            continue
        found, links, same = nodes(text, base_spans(text))
        for _, _, s, w, label in found:
            c["shape", s, label] += 1
            c["word", w, label] += 1
            c["label", 0, label] += 1
        for i, j in links:
            c["chain", found[i][4], found[j][4]] += 1
        last = {}
        for i, k in enumerate(same):
            if k in last:
                c["skip", found[last[k]][4], found[i][4]] += 1
            last[k] = i
    return c


class SkipChain:
    """Potentials of the field, from the counts."""

    def __init__(self, counts: dict[tuple[str, int, int], int]):
        k = len(LABELS)
        tab = {w: np.zeros((BUCKETS, k)) for w in ("shape", "word")}
        label = np.ones(k)
        pair = {"chain": np.zeros((k, k)), "skip": np.zeros((k, k))}
        for (what, a, b), n in counts.items():
            if what in tab:
                tab[what][a, b] += n
            elif what == "label":
                label[b] += n
            else:
                pair[what][a, b] += n
                pair[what][b, a] += n
        prior = label / label.sum()
        by_shape = (tab["shape"] + prior) / (tab["shape"].sum(1, keepdims=True) + 1)
        by_shape[:, 1:] = np.clip(by_shape[:, 1:], FLOOR, None)
        over = by_shape[:, 1:].sum(1, keepdims=True)
        by_shape[:, 1:] *= np.minimum(1, ALONE / over)
        by_shape[:, 0] = 1 - by_shape[:, 1:].sum(1)
        self.shape = np.log(by_shape)
        by_word = (tab["word"] + 5 * prior) / (tab["word"].sum(1, keepdims=True) + 5)
        self.word = np.clip(np.log(by_word / prior), -1, 0.5)
        c = pair["chain"] + 1
        self.chain = np.clip(np.log(c * c.sum() / (c.sum(1, keepdims=True) * c.sum(0, keepdims=True))), -1, 1)
        s = pair["skip"][1:, 1:]
        same = float(np.trace(s)) / 2  # pair has each pair in both orders
        #: Weight of agreement with an observed node of the same key; it favours no label of its own.
        self.skip = float(np.clip(np.log((same + AGREE) / (s.sum() / 2 - same + 1)), 5, 12))

    def marginals(self, found: list[tuple], links: list[tuple], same: list[int], doc: list[int]) -> np.ndarray:
        """Label marginals of each node by damped sum-product; ``doc`` numbers the document of each node, and
        messages of a document rest once it has settled, so that it doesn't matter which others are here.

        The unobserved nodes of one key are one variable: the mean of their evidence and of the messages of
        their neighbours, and one vote of ``skip`` from each observed node of that key.
        """
        x = np.array([f[2:] for f in found])
        k = len(LABELS)
        seen = x[:, 2] > 0
        at = np.where(seen, len(x) + np.arange(len(x)), np.array(same))  # an observed node is its own variable
        names, var = np.unique(at, return_inverse=True)
        share = 1 / np.bincount(var)
        unary = np.zeros((len(names), k))
        np.add.at(unary, var, (self.shape[x[:, 0]] + self.word[x[:, 1]]) * share[var, None])
        where = np.minimum(np.searchsorted(names, same), len(names) - 1)
        votes = np.flatnonzero(seen & (names[where] == same))
        np.add.at(unary, (where[votes], x[votes, 2]), self.skip)
        unary[var[seen]] = -40.0
        unary[var[seen], x[seen, 2]] = 0.0
        e = var[np.array(links, dtype=int).reshape(-1, 2)]
        e = e[e[:, 0] != e[:, 1]]
        belief = unary.copy()
        if len(e):
            half = len(e)
            e = np.concatenate([e, e[:, ::-1]])
            back = np.concatenate([np.arange(half, 2 * half), np.arange(half)])
            part = share[e[:, 1], None]
            msg = np.zeros((len(e), k))
            home = np.zeros(len(names), dtype=int)
            home[var] = np.array(doc)
            of = home[e[:, 1]]
            busy = np.arange(len(e))  # edges of documents that haven't settled
            for r in range(ROUNDS):
                z = (belief[e[busy, 0]] - part[back[busy]] * msg[back[busy]])[:, :, None] + self.chain
                top = z.max(1)
                new = np.log(np.exp(z - top[:, None, :]).sum(1)) + top
                new -= new.max(1, keepdims=True)
                step = 0.7 / (1 + max(0, r - SLOW) / SLOW)
                change = np.zeros(of.max() + 1)
                np.maximum.at(change, of[busy], np.abs(new - msg[busy]).max(1))
                msg[busy] = (1 - step) * msg[busy] + step * new
                to = np.unique(e[busy, 1])
                belief[to] = unary[to]
                np.add.at(belief, e[busy, 1], part[busy] * msg[busy])
                busy = busy[change[of[busy]] >= SETTLED]
                if not len(busy):
                    break
        p = np.exp(belief - belief.max(1, keepdims=True))
        return (p / p.sum(1, keepdims=True))[var]

    def find(self, texts: list[str | None]) -> list[tuple[list, list]]:
        """For each text (base spans, all spans), sorted by start, then kind."""
        out, found, links, same, place = [], [], [], [], []
        # a document without an observed node can't reach SURE: shape gives at most ALONE, the word before 0.5,
        # each neighbour 1, and that is 0.87
        for text in texts:
            base = sorted(base_spans(text or ""), key=lambda s: (s[0], s[2]))
            out.append((base, list(base)))
            if text and HINT.search(text):
                own, own_links, own_same = nodes(text, base)
                if any(not n[4] for n in own) and any(n[4] for n in own):
                    k = len(found)
                    links += [(i + k, j + k) for i, j in own_links]
                    same += [i + k for i in own_same]
                    found += own
                    place += [len(out) - 1] * len(own)
        if found:
            p = self.marginals(found, links, same, place)
            best = p[:, 1:].argmax(1)
            for i in np.flatnonzero(p[np.arange(len(p)), best + 1] >= SURE):
                if not found[i][4]:
                    out[place[i]][1].append((found[i][0], found[i][1], int(best[i])))
            for _, spans in out:
                spans.sort(key=lambda s: (s[0], s[2]))
        return out


def fit_skip_chain(docs: DataFrame, text_col: str = "text") -> SkipChain:
    """Potentials from all documents. Only counts reach the driver: at most ``2 * BUCKETS`` by 5 of them."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()
        for b in batches:
            total.update(count_batch(b.column(0).to_pylist()))
        keys = list(total)
        yield pa.record_batch([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.int64()),
                               pa.array([k[2] for k in keys], pa.int64()),
                               pa.array([total[k] for k in keys], pa.int64())], names=["what", "a", "b", "n"])

    rows = docs.select(F.col(text_col).alias("text")).mapInArrow(run, "what string, a long, b long, n long") \
        .groupBy("what", "a", "b").agg(F.sum("n").alias("n")).collect()
    return SkipChain({(r["what"], r["a"], r["b"]): r["n"] for r in rows})


def _write(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, b, k in spans)


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             model: SkipChain | None = None) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans for every row, over whole texts.

    Counts and hash are of the base spans; ``spans`` has all, as kind:start:end in code points, by start,
    then kind as listed. A null or empty text has none; repeated rows give repeated rows; an empty table
    gives no rows. Only ``id_col`` and ``text_col`` are read.
    """
    field = model or fit_skip_chain(docs, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            got = field.find(b.column(1).to_pylist())
            n = [[sum(s[2] == k for s in base) for base, _ in got] for k in range(4)]
            sha = [hashlib.sha256(_write(base).encode()).hexdigest() for base, _ in got]
            yield pa.record_batch([b.column(0), *[pa.array(x, pa.int64()) for x in n], pa.array(sha, pa.string()),
                                   pa.array([_write(a) for _, a in got], pa.string())],
                                  names=["doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", "spans"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, "
                         "base_sha256 string, spans string")


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    """``text`` with each span, overlapping ones together, as [KIND] of the first."""
    out, at = [], 0
    i = 0
    while i < len(spans):
        start, end, kind = spans[i]
        while i + 1 < len(spans) and spans[i + 1][0] < end:
            i += 1
            end = max(end, spans[i][1])
        out += [text[at:start], f"[{KINDS[kind].upper()}]"]
        at = end
        i += 1
    return "".join(out) + text[at:]


def mask_pii(docs: DataFrame, text_col: str = "text", chars_col: str = "n_chars",
             model: SkipChain | None = None) -> DataFrame:
    """``docs`` with personal data replaced by its kind; ``chars_col``, if there, follows a changed text."""
    field = model or fit_skip_chain(docs, text_col)
    at = docs.columns.index(text_col)
    chars = docs.columns.index(chars_col) if chars_col in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(at).to_pylist()
            new = [masked(t, spans) if spans else t
                   for t, (_, spans) in zip(texts, field.find(texts), strict=True)]
            cols = list(b.columns)
            cols[at] = pa.array(new, cols[at].type)
            if chars is not None:
                n = [len(y) if y != x else k for x, y, k in zip(texts, new, cols[chars].to_pylist(), strict=True)]
                cols[chars] = pa.array(n, cols[chars].type)
            yield pa.record_batch(cols, names=b.schema.names)

    return docs.mapInArrow(run, T.StructType(docs.schema.fields))
