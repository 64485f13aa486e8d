"""Periodic runs of words, found with string synchronising sets."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: A worker searches texts of about so many words at once (a longer text alone).
GATHER = 1 << 18
#: Runs are followed from three periods on: the synchronising sets need them, results take ``least`` or more.
PERIODS = 3


def named(pair: np.ndarray, may: np.ndarray, free: int) -> np.ndarray:
    """Names of windows: equal pairs (among ``may``) share a number below ``free``; a window that occurs
    once gets a number of its own, ``free`` + its place."""
    names = free + np.arange(len(pair), dtype=np.int64)
    at = np.flatnonzero(may)
    if len(at):
        _, inverse, n = np.unique(pair[at], return_inverse=True, return_counts=True)
        again = n[inverse] > 1
        names[at[again]] = inverse[again]
    return names


def window_names(words: np.ndarray) -> list[np.ndarray]:
    """Level k: names of the windows of 2^k words, until no window occurs twice. ``words`` are numbers
    below their own count, such that words of different texts differ and every text ends in a word of its own."""
    n = len(words)
    levels = [named(words, np.ones(n, bool), n)]
    while (levels[-1] < n).any():
        last, half = levels[-1], 1 << (len(levels) - 1)
        pair, may = np.zeros(n, np.int64), np.zeros(n, bool)
        if half < n:
            may[:-half] = (last[:-half] < n) & (last[half:] < n)
            pair[:-half] = last[:-half] * n + np.minimum(last[half:], n)
        levels.append(named(pair, may, n))
    return levels


def extended(levels: list[np.ndarray], at: np.ndarray, d: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of the longest stretch of period ``d`` around ``at`` (words at and at + d are equal)."""
    n = len(levels[0])
    low, high = at.copy(), at.copy()
    for k in range(len(levels) - 1, -1, -1):
        name, step = levels[k], 1 << k
        ok = high + d < n
        ok[ok] = name[high[ok]] == name[high[ok] + d[ok]]
        high[ok] += step
        ok = low >= step
        ok[ok] = name[low[ok] - step] == name[low[ok] - step + d[ok]]
        low[ok] -= step
    return low, high + d


def minima(x: np.ndarray, width: int) -> np.ndarray:
    """Least of x[i..i + width] (``width`` a power of two), over what there is of it."""
    top = np.iinfo(x.dtype).max
    shift = lambda y, by: np.append(y[by:], np.full(min(by, len(y)), top, y.dtype))
    low, have = x, 1
    while have < width:
        low = np.minimum(low, shift(low, have))
        have *= 2
    return np.minimum(low, shift(x, width))


def mixed(names: np.ndarray) -> np.ndarray:
    """A hash of the names that keeps different ones different."""
    x = names.astype(np.uint64)
    with np.errstate(over="ignore"):
        for m in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            x = (x ^ (x >> np.uint64(31))) * np.uint64(m)
    return x ^ (x >> np.uint64(30))


def proposed(levels: list[np.ndarray], k: int, runs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (place, distance) of the synchronising set of scale t = 2^k with equal contexts of 2 t words,
    at distances of 3 t - 1 to 6 t - 2.

    A place belongs to the set where the least hash among the t + 1 windows of t words from it on is that
    of the first or the last; windows of a period of t / 3 or less don't count: they are the stretches of
    ``runs`` (start, end, period) found at smaller scales. Whether a place belongs depends on its context
    alone, so a run of a period p has its places again p words on; and every stretch of 3 t - 1 words
    without such a small period holds one. A period from 3 t - 1 to 6 t - 2 whose run has three periods so
    shows in two equal contexts. Within the set equal contexts lie more than t / 3 apart, so that few of
    them are within reach of each other.
    """
    n, t = len(levels[0]), 1 << k
    if k + 1 >= len(levels):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    none = np.iinfo(np.uint64).max
    value = mixed(levels[k])
    small = runs[(3 * runs[:, 2] <= t) & (runs[:, 1] - runs[:, 0] >= t)]
    inside = np.zeros(n + 1, np.int64)
    np.add.at(inside, small[:, 0], 1)
    np.add.at(inside, small[:, 1] - t + 1, -1)
    value[np.cumsum(inside[:-1]) > 0] = none
    least = minima(value, t)
    last = np.append(value[t:], np.full(min(t, n), none, np.uint64))
    context = levels[k + 1]
    place = np.flatnonzero((context < n) & (least < none) & ((least == value) | (least == last)))
    order = np.lexsort((place, context[place]))
    place, context = place[order], context[place][order]
    found, far = [], []
    for j in range(1, len(place)):
        d = place[j:] - place[:-j]
        near = (context[j:] == context[:-j]) & (d <= 6 * t - 2)
        if not near.any():
            break
        near &= d >= 3 * t - 1
        found.append(place[:-j][near])
        far.append(d[near])
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(found), np.concatenate(far)


def all_runs(words: np.ndarray) -> np.ndarray:
    """(start, end, period) of every longest stretch of at least three of its smallest periods, by start,
    then period."""
    levels = window_names(words)
    same = np.concatenate([[False], words[1:] == words[:-1], [False]]).astype(np.int8)
    # period one: no scale is small enough for it
    begin, end = np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1) + 1
    runs = np.stack([begin, end, np.ones_like(begin)], 1)[end - begin >= PERIODS].reshape(-1, 3)
    for k in range(len(levels)):
        at, d = proposed(levels, k, runs)
        if not len(at):
            continue
        low, high = extended(levels, at, d)
        ok = high - low >= PERIODS * d
        more = np.unique(np.stack([low, high, d], 1)[ok], axis=0)
        # a multiple of the smallest period has the same ends: the first of equal ends is the smallest
        both = np.concatenate([runs, more])
        both = both[np.lexsort((both[:, 2], both[:, 1], both[:, 0]))]
        new = np.ones(len(both), bool)
        new[1:] = (both[1:, :2] != both[:-1, :2]).any(1)
        runs = both[new]
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def runs_of(texts: list[bytes], least_periods: int, least_words: int):
    """Per text its words, and an array of (start, length, period)."""
    parts = [t.split() for t in texts]  # of bytes, blank and 9 to 13 alone are white space
    flat, starts, at, used = [], np.zeros(len(parts), np.int64), 0, 0
    for i, p in enumerate(parts):
        known = defaultdict(count(used).__next__)
        flat += map(known.__getitem__, p)
        used += len(known)
        flat.append(used)  # an end of its own
        used += 1
        starts[i] = at
        at += len(p) + 1
    runs = all_runs(np.array(flat, dtype=np.int64))
    length = runs[:, 1] - runs[:, 0]
    runs = runs[length >= np.maximum(least_words, least_periods * runs[:, 2])]
    text = np.searchsorted(starts, runs[:, 0], side="right") - 1
    cut = np.searchsorted(text, np.arange(len(parts) + 1))
    for i, p in enumerate(parts):
        r = runs[cut[i]:cut[i + 1]]
        yield p, np.stack([r[:, 0] - starts[i], r[:, 1] - r[:, 0], r[:, 2]], 1)


def collapsed(words: list[bytes], runs: np.ndarray) -> bytes:
    """Words joined by a blank, without those that a run holds after its first period."""
    if not len(runs):
        return b" ".join(words)
    drop = np.zeros(len(words) + 1, np.int64)
    np.add.at(drop, runs[:, 0] + runs[:, 2], 1)
    np.add.at(drop, runs[:, 0] + runs[:, 1], -1)
    return b" ".join([words[i] for i in np.flatnonzero(np.cumsum(drop[:-1]) == 0)])


def periodic_runs(docs: DataFrame, least_periods: int = 4, least_words: int = 6, id_col: str = "doc_id",
                  text_col: str = "text") -> DataFrame:
    """id, runs array<struct<start, length, period>> by start, then period, and ``collapsed``, the text
    without what repeats.

    Words are what blank and the controls 9 to 13 separate. A run is a longest stretch of words of a
    smallest period, at least ``least_periods`` (3 or more) periods and ``least_words`` words long. In
    ``collapsed`` each run keeps its first period; kept words are joined by one blank.

    Periods come from synchronising sets at scales of 1, 2, 4, ... words: places picked by hash, alike
    wherever the context is alike; two such places with equal contexts propose their distance, and the
    stretch of that period around them is followed both ways by window names of doubling length, which
    are exact. Periods too small for a scale are those of stretches found before; period one is found by
    comparing neighbours. About n log n steps for n words, however they repeat.

    Map only: each row is searched where it is read, whole. A null text is empty; a text without words
    has no runs and an empty ``collapsed``. Null ids and repeated rows are rows like any other, an empty
    table gives none. A text of any length is searched in one task (about 24 bytes a word and level, one
    level for each doubling of its longest repeat). Other columns aren't read.
    """
    if least_periods < PERIODS:
        raise ValueError(f"runs are found from {PERIODS} periods on")

    def answer(ids: list, texts: list[bytes]) -> pa.RecordBatch:
        told, short = [], []
        for words, runs in runs_of(texts, least_periods, least_words):
            told.append([dict(zip(("start", "length", "period"), r, strict=True)) for r in runs.tolist()])
            short.append(collapsed(words, runs).decode())
        kind = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))
        return pa.record_batch([pa.array(ids, pa.int64()), pa.array(told, kind), pa.array(short, pa.string())],
                               names=["id", "runs", "collapsed"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, texts, size = [], [], 0
        for b in batches:
            for key, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                ids.append(key)
                texts.append(text.as_py() or b"")
                size += len(texts[-1])
                if size >= 6 * GATHER:
                    yield answer(ids, texts)
                    ids, texts, size = [], [], 0
        if ids:
            yield answer(ids, texts)

    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    found = rows.mapInArrow(run, "id long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)
