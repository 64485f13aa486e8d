"""Brackets, commas and names of JSON text that is read in splits by many tasks.

A task sees each of its splits in order, so it needs no exchange to know how many brackets are open at a place:
only what stood before the split, one small row a split that two passes over the text give (:func:`starts`).
The text itself stays in the task that reads it. Everything that workers run is nested in :func:`scanner`, so
that it is shipped with the job.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.session import cut_lineage

#: Bytes of a split that are looked at together.
PIECE = 1 << 20
# what stands for text and name before a split while they are unknown; JSON holds no such characters
_BEFORE, _NAME = b"\0", b"\1"


def scanner(what: str, sep: str, at: dict, depth: int = 0, levels: Sequence[int] = (), names: Sequence[int] = (),
            places: Sequence[int] = (), parents: Sequence[int] = (), shallow: bool = False) -> Callable:
    """A function for ``mapInArrow`` over (file, part, block, size, text), ``text`` cut at ``sep``. ``at`` holds for
    (file, part, block) what stands before the split. ``what`` is ``quotes`` or ``marks``, the two passes of
    :func:`starts`, or ``elements`` or ``leaves``, rows of what lies inside ``depth`` brackets."""
    quote, comma, colon, opening, closing = 34, 44, 58, (91, 123), (93, 125)
    piece, before, unknown, blank = PIECE, _BEFORE, _NAME, b" \t\r\n"
    marks = np.zeros(256, bool)
    marks[[quote, comma, colon, *opening, *closing]] = True
    change = np.zeros(256, np.int64)
    change[list(opening)], change[list(closing)] = 1, -1

    def pieces(batches):
        """(split, size of its file, text, is it the last of the split), in order."""
        held, size, key, total = [], 0, None, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            file, part, block, sizes, text = (batch.column(i) for i in range(5))
            code = file.dictionary_encode().indices.to_numpy(zero_copy_only=False)
            turns = (np.diff(code) != 0) | (np.diff(part.to_numpy()) != 0) | (np.diff(block.to_numpy()) != 0)
            cuts = [0, *(np.flatnonzero(turns) + 1).tolist(), n]
            for a, b in zip(cuts, cuts[1:]):
                mine = (file[a].as_py(), part[a].as_py(), block[a].as_py())
                if held and (mine != key or size > piece):
                    yield key, total, b"".join(held), mine != key
                    held, size = [], 0
                key, total = mine, sizes[a].as_py()
                rows = pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), text.slice(a, b - a))
                held += [pc.binary_join(rows, sep)[0].as_buffer().to_pybytes(), sep.encode()]
                size += len(held[-2])
        if held:
            yield key, total, b"".join(held), True

    def marked(text):
        """Places and kinds of quotes and marks that no backslash escapes."""
        a = np.frombuffer(text, np.uint8)
        where = np.flatnonzero(marks[a])
        if b"\\" in text:
            slash = np.flatnonzero(a == 92)
            i = np.arange(len(slash))
            first = np.maximum.accumulate(np.where(np.append(True, np.diff(slash) != 1), i, 0))
            escaped = np.zeros(len(a) + 1, bool)
            escaped[slash[(i - first) % 2 == 0] + 1] = True
            where = where[~escaped[where]]
        return where, a[where]

    def quotes(batches):
        sums = None
        for key, total, text, last in pieces(batches):
            n, odd, even, uneven = sums or (0, 0, 0, 0)
            _, kind = marked(text)
            is_quote = kind == quote
            inside = (np.cumsum(is_quote) + odd) % 2 == 1
            d = change[kind]
            sums = (n + len(text), (odd + int(is_quote.sum())) % 2, even + int(d[~inside].sum()), uneven + int(d[inside].sum()))
            if last:
                yield pa.record_batch([pa.array([key[0]], pa.string()), *[pa.array([v], pa.int64()) for v in (*key[1:], total, *sums)]],
                                      names=["file", "part", "block", "size", "n", "odd", "even", "uneven"])
                sums = None

    def name(raw):
        return None if raw is None else raw.strip(blank)[1:-1]

    def walk(batches):
        """For each piece what it holds: state before, text, places, kinds, depth after each; the state is brought
        up to date when the next piece is asked for. A place in it is one between marks; what follows the last mark
        is looked at with the next piece. At the end of a split the piece is None."""
        s = None
        for key, _, text, last in pieces(batches):
            if s is None:
                s = {**at[key], "key": key, "events": 0}
                s["opens"], s["commas"], s["last"] = dict(s["opens"]), dict(s["commas"]), dict(s["last"])
            if last and not s["ended"]:
                text = text[:-1]
            text = s["rest"] + text
            where, kind = marked(text)
            is_quote = kind == quote
            real = ~is_quote & ((np.cumsum(is_quote) + s["odd"]) % 2 == 0)
            where, kind = where[real], kind[real]
            if len(where):
                d = change[kind]
                after = s["depth"] + np.cumsum(d)
                begin = np.append(0, where[:-1] + 1)
                left = np.append(s["left"], kind[:-1])

                def key_at(i):
                    """The name before mark ``i``, as it stands in the text."""
                    if left[i] == colon:
                        return text[begin[i - 1]:where[i - 1]] if i else s["left_key"]
                    return unknown if i == 0 and s["left"] == unknown[0] else None

                level = {k: np.flatnonzero((d == 1) & (after == k)) for k in levels}
                passed = {k: np.append(0, np.cumsum((kind == comma) & (after == k))) + s["commas"][k] for k in levels}
                yield s, text, where, kind, d, after, left, key_at, level, passed
                for k in levels:
                    if len(level[k]):
                        i = level[k][-1]
                        s["last"][k] = (int(passed[k][i]), int(kind[i]), key_at(i))
                    s["opens"][k] += len(level[k])
                    s["commas"][k] = int(passed[k][-1])
                i = len(where) - 1
                s["left_key"] = (text[begin[i]:where[i]] if kind[i] == colon else None)
                s["left"], s["depth"], s["odd"], s["rest"] = int(kind[i]), int(after[i]), 0, text[where[i] + 1:]
                s["events"] += len(where)
            else:
                s["rest"] = text
            if last:
                yield s, None, *[None] * 8
                s = None

    def kept(s, text, where, d, after):
        """Cuts a range of the text; with ``shallow`` without what lies in deeper brackets."""
        if not shallow:
            return lambda a, b: text[a:b]
        turns = np.zeros(len(text) + 1, np.int64)
        turns[0] = s["depth"] > depth + 1
        turns[where[(d == 1) & (after == depth + 2)] + 1] += 1
        turns[where[(d == -1) & (after == depth + 1)]] -= 1
        keep = np.cumsum(turns)[:-1] == 0
        rest, place = np.frombuffer(text, np.uint8)[keep].tobytes(), np.append(0, np.cumsum(keep))
        return lambda a, b: rest[place[a]:place[b]]

    def objects(batches, whole):
        """``whole``: columns of the objects that lie in one split. Else a row a split: the parts of objects that go
        on across its ends, also of what may be one (nothing is known there of the splits before; a list shows by
        its end or by two commas without a colon, and isn't kept)."""
        own, inner = depth + 1, None
        for s, text, where, kind, d, after, left, key_at, level, passed in walk(batches):
            if inner is None:   # at the start of a split: an object (or list) that an earlier one opened
                inner = {"parts": [], "open": at[s["key"]]["depth"] > depth, "kind": (at[s["key"]]["last"][own] or (0, 0))[1], "before": True}
                head = None
            if text is None:
                if not whole:
                    rest = s["rest"] if not shallow or s["depth"] <= own else b""
                    end = b"".join(inner["parts"]) + rest if inner["open"] and inner["kind"] != opening[0] else None
                    if inner["before"] and end is not None:
                        head, end = end.removeprefix(before), None
                    yield s, head, end
                inner = None
                continue
            cut = kept(s, text, where, d, after)
            first, ends = level[own], np.flatnonzero((d == -1) & (after == depth))
            if inner["open"]:
                stop = where[ends[0]] + 1 if len(ends) else where[-1] + 1
                if not whole and not inner["kind"]:
                    members = kind[(after == own) & ((kind == comma) | (kind == colon))]
                    if ((members[1:] == comma) & (members[:-1] == comma)).any() or len(ends) and kind[ends[0]] == closing[0]:
                        inner["kind"], inner["parts"] = opening[0], []
                if inner["kind"] != opening[0] and not (whole and inner["before"]):
                    inner["parts"].append(cut(0, stop))
                if len(ends):
                    ends, inner["open"] = ends[1:], False
                    if inner["kind"] != opening[0]:
                        done = b"".join(inner["parts"])
                        if whole and not inner["before"]:
                            yield s, [inner["at"]], [done], [inner["key"]], inner["up"], inner["names"]
                        elif inner["before"]:
                            head = done.removeprefix(before)
                    inner["before"] = False
            n = min(len(first), len(ends))
            number = {k: s["opens"][k] + np.cumsum((d == 1) & (after == k)) for k in levels}
            seen = {k: [name((s["last"][k] or (0, 0, None))[2]), *[name(key_at(i)) for i in level[k]]]
                    for k in names} if whole else {}
            if whole and n:
                took = kind[first[:n]] == opening[1]
                a, b = first[:n][took], ends[:n][took]
                texts = [cut(x, y) for x, y in zip(where[a].tolist(), (where[b] + 1).tolist())]
                keys = [name(key_at(i)) if left[i] == colon else None for i in a]
                if len(a):
                    yield (s, number[own][a], texts, keys, [number[k][a] for k in parents],
                           [[seen[k][j] for j in number[k][a] - s["opens"][k]] for k in names])
            if len(first) > n:
                i = first[n]
                inner = {"open": True, "before": False, "kind": int(kind[i]), "parts": [], "key": name(key_at(i)), "at": int(number[own][i])}
                inner["up"] = [[int(number[k][i])] for k in parents]
                inner["names"] = [[seen[k][number[k][i] - s["opens"][k]]] for k in names] if whole else []
                if inner["kind"] == opening[1]:
                    inner["parts"].append(cut(where[i], where[-1] + 1))

    def elements(batches):
        for s, number, texts, keys, ups, named in objects(batches, True):
            yield pa.record_batch([pa.array([s["key"][0]] * len(texts), pa.string()), pa.array(number, pa.int64()), pa.array(keys, pa.binary()),
                                   *[pa.array(u, pa.int64()) for u in ups], *[pa.array(v, pa.binary()) for v in named],
                                   pa.array(texts, pa.binary())],
                                  names=["file", "at", "key", *[f"_n{k}" for k in parents], *[f"_k{k}" for k in names], "text"])

    def leaves(batches):
        for s, text, where, kind, d, after, left, key_at, level, passed in walk(batches):
            if text is None:
                continue
            inside = after - d == depth
            ends = np.flatnonzero(inside & ((kind == comma) | (d == -1)) & (change[left] != -1))
            begin = np.append(0, where[:-1] + 1)[ends]
            texts = [text[a:b].strip(blank) for a, b in zip(begin.tolist(), where[ends].tolist())]
            some = np.array([bool(t) for t in texts], bool)
            ends, texts = ends[some], [t for t in texts if t]
            if not texts:
                continue
            keys = [name(key_at(i)) if left[i] == colon else None for i in ends]
            cols = {}
            for k in levels:
                by = np.append(0, np.cumsum((d == 1) & (after == k)))[ends]   # openings in this piece before a scalar
                last = s["last"][k] or (0, 0, None)
                if k in names:
                    own = [name(last[2]), *[name(key_at(i)) for i in level[k]]]
                    cols[f"_k{k}"] = pa.array([own[j] for j in by], pa.binary())
                if k in places:
                    cols[f"_p{k}"] = pa.array(passed[k][ends] - np.append(last[0], passed[k][level[k]])[by], pa.int64())
            order = [f"_k{k}" for k in names] + [f"_p{k}" for k in places]
            yield pa.record_batch([pa.array([s["key"][0]] * len(texts), pa.string()), pa.array(keys, pa.binary()), *[cols[c] for c in order],
                                   pa.array(texts, pa.binary())], names=["file", "key", *order, "value"])

    def ends_of(batches):
        found = objects(batches, False) if what == "marks" else ((s, None, None) for s, text, *_ in walk(batches) if text is None)
        for s, head, tail in found:
            last = [s["last"][k] or (0, 0, None) for k in levels]
            row = {"file": s["key"][0], "part": s["key"][1], "block": s["key"][2], "events": s["events"], "rest": s["rest"],
                   "left": s["left"], "left_key": s["left_key"], "opens": [s["opens"][k] for k in levels],
                   "commas": [s["commas"][k] for k in levels], "base": [v[0] for v in last], "kind": [v[1] for v in last],
                   "names": [v[2] for v in last], "head": head, "tail": tail}
            kinds = [pa.string(), *[pa.int64()] * 3, pa.binary(), pa.int64(), pa.binary(), *[pa.list_(pa.int64())] * 4,
                     pa.list_(pa.binary()), pa.binary(), pa.binary()]
            yield pa.record_batch([pa.array([v], t) for v, t in zip(row.values(), kinds)], names=list(row))

    return {"quotes": quotes, "marks": ends_of, "scalar marks": ends_of, "elements": elements, "leaves": leaves}[what]


ENDS = ("file string, part long, block long, events long, rest binary, left long, left_key binary, opens array<long>, "
        "commas array<long>, base array<long>, kind array<long>, names array<binary>, head binary, tail binary")


def starts(rows: DataFrame, sep: str, levels: Sequence[int], depth: int | None = None, shallow: bool = False) -> tuple[dict, DataFrame]:
    """What stands before each split of ``rows`` (file, part, block, size, text): is it inside a string, how many
    brackets are open, how many were opened and commas passed at each of ``levels``, the last name there, the text
    since the last mark. With ``depth`` also the parts of objects that lie across the ends of splits.

    A row a split comes to the driver: sums and the last names, never the text of a split.
    """
    at: dict = {}
    empty = {"rest": _BEFORE, "left": _NAME[0], "left_key": None, "opens": dict.fromkeys(levels, 0),
             "commas": dict.fromkeys(levels, 0), "last": dict.fromkeys(levels)}
    q = rows.mapInArrow(scanner("quotes", sep, {}), "file string, part long, block long, size long, n long, odd long, even long, uneven long")
    for _, splits in groupby(sorted(map(tuple, q.collect()), key=lambda r: (r[0] or "", *r[1:])), key=lambda r: r[0]):
        odd = opened = 0
        for _, part in groupby(splits, key=lambda r: r[1]):
            part = list(part)
            # the reader takes the separator away; the last row of a part may never have had one (a byte order
            # mark of three bytes is taken away, too)
            ended = sum(r[4] for r in part) - part[0][3] in (0, -3)
            for i, (file, no, block, _, _, flips, even, uneven) in enumerate(part):
                whole = ended or i < len(part) - 1
                at[file, no, block] = {"odd": odd, "depth": opened, "ended": whole, **empty}
                opened += uneven if odd else even
                odd = (odd + flips) % 2
                if not whole and sep == "}" and not odd:
                    opened += 1
    what = "scalar marks" if depth is None else "marks"
    found = cut_lineage(rows.mapInArrow(scanner(what, sep, at, depth or 0, levels, shallow=shallow), ENDS))
    known: dict = {}
    ends = found.withColumn("across", F.expr("head IS NOT NULL OR tail IS NOT NULL")).drop("head", "tail").collect()
    for _, splits in groupby(sorted(ends, key=lambda r: (r.file or "", r.part, r.block)), key=lambda r: r.file):
        now, key = {**empty, "rest": b"", "left": 0}, None
        for r in splits:
            if key:
                known[key]["next"] = (r.file, r.part, r.block)
            key = (r.file, r.part, r.block)
            known[key] = {**at[key], **now, "odd": 0, "across": r.across, "next": None}

            def told(raw):
                raw = None if raw is None else bytes(raw)
                if raw == _NAME:
                    return now["left_key"] if now["left"] == 58 else None
                return now["rest"] + raw[1:] if raw and raw.startswith(_BEFORE) else raw
            last = {k: (now["commas"][k] + r.base[j], r.kind[j], told(r.names[j])) if r.opens[j] else now["last"][k]
                    for j, k in enumerate(levels)}
            now = {"rest": told(r.rest), "left": r.left if r.events else now["left"],
                   "left_key": told(r.left_key) if r.events else now["left_key"], "last": last,
                   "opens": {k: now["opens"][k] + r.opens[j] for j, k in enumerate(levels)},
                   "commas": {k: now["commas"][k] + r.commas[j] for j, k in enumerate(levels)}}
    return known, found.select("file", "part", "block", "head", "tail")


def across(parts: DataFrame, at: dict, own: int, names: Sequence[int], parents: Sequence[int]) -> DataFrame:
    """Parts of objects that lie across the ends of splits, each with the number, name and parents of its object;
    the split that holds an object's end knows its name."""
    def run(batches):
        def name(raw):
            return None if raw is None else raw.strip(b" \t\r\n")[1:-1]

        for batch in batches:
            for r in batch.to_pylist():
                key = (r["file"], r["part"], r["block"])
                for no, (of, text) in enumerate(((key, r["head"]), (at[key]["next"], r["tail"]))):
                    s = at.get(of)
                    if text is None or s is None or (s["last"][own] or (0, 0))[1] != 123:
                        continue
                    last = lambda k: name((s["last"][k] or (0, 0, None))[2])  # noqa: E731, B023
                    yield pa.record_batch([pa.array([v], t) for v, t in (
                        (key[0], pa.string()), (s["opens"][own], pa.int64()), (last(own), pa.binary()),
                        *[(s["opens"][k], pa.int64()) for k in parents], *[(last(k), pa.binary()) for k in names],
                        (key[1], pa.int64()), (key[2], pa.int64()), (no, pa.int64()), (text, pa.binary()))],
                        names=["file", "at", "key", *[f"_n{k}" for k in parents], *[f"_k{k}" for k in names], "part", "block", "no", "text"])
    kinds = ", ".join(["file string, at long, key binary", *[f"_n{k} long" for k in parents], *[f"_k{k} binary" for k in names],
                       "part long, block long, no long, text binary"])
    return parts.where("head IS NOT NULL OR tail IS NOT NULL").mapInArrow(run, kinds)
