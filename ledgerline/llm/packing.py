"""Best-fit packing of documents into fixed-length sequences by a linear grouping scheme.

1. Documents are tokenised once; each becomes pieces of at most ``capacity`` ids.
2. The histogram of piece lengths (at most ``capacity`` rows, however many documents) goes to the driver,
   which plans on lengths: large lengths are rounded up within groups of equal cardinality, a few-size
   cutting-stock program finds how often to use each configuration, actual lengths replace the rounded
   ones, and the rest goes best-fit, longest first, into the space left.
3. The plan is a list of runs ("pieces of length L with rank a..a+n go to sequences s..s+n at offset o").
   Pieces get their rank within their length from per-(length, bucket) counts, and join the runs.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.base import cut

#: Words whose ids a Python worker keeps between tasks; it starts anew beyond that, so memory is bounded.
CACHED_WORDS = 600_000
#: Rows of one length are ranked in this many buckets, so that a common length isn't ranked in one task.
RANK_BUCKETS = 256

_encoders: dict[str, WordEncoder] = {}


class WordEncoder:
    """Ids of a text, word by word, by a ``tokenizers`` file whose pre-tokeniser never joins words.

    A word between ASCII white space is encoded on its own and remembered; the ids of a text are those of
    its words in order. Lower-case letters plus marks, by far the most words, skip normalisation: letters
    and marks are the pre-tokens, and go to the file's BPE model as byte-level symbols.
    """

    LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.full = Tokenizer.from_file(path)
        self.model = self.full.model
        self.known: dict[str, bytes] = {}
        self.simple = re.compile(f"([{self.LETTERS}]+)([.,!?;:]*)").fullmatch
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        other = [b for b in range(256) if b not in plain]
        self.symbols = {b: chr(256 + i) for i, b in enumerate(other)}

    def _symbols(self, word: str) -> str:
        return word if word.isascii() else word.encode().decode("latin-1").translate(self.symbols)

    def _model_ids(self, word: str) -> bytes:
        return np.array([t.id for t in self.model.tokenize(self._symbols(word))], dtype="<u4").tobytes()

    def word(self, word: str) -> bytes:
        """Little-endian unsigned 32-bit ids of one word."""
        if len(word) <= 60 and (m := self.simple(word.lower())):
            stem, marks = m.groups()
            ids = self.known.get(stem) or self._model_ids(stem)
            return ids + (self.known.get(marks) or self._model_ids(marks)) if marks else ids
        return np.array(self.full.encode(word, add_special_tokens=False).ids, dtype="<u4").tobytes()

    def words(self, words: list[str]) -> list[bytes]:
        known = self.known
        out = [known.get(w) for w in words]
        for i, ids in enumerate(out):
            if ids is None:
                out[i] = ids = self.word(words[i])
                if len(words[i]) <= 60:
                    known[words[i]] = ids
        if len(known) > CACHED_WORDS:
            known.clear()
        return out

    def texts(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text (null: none)."""
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        ids = self.words(coded.dictionary.to_pylist())
        size = np.array([len(x) // 4 for x in ids], dtype=np.int64)
        flat = np.frombuffer(b"".join(ids), dtype="<u4")
        begin = np.cumsum(size) - size
        codes = coded.indices.to_numpy()
        ends = split.offsets.to_numpy() - split.offsets[0].as_py()
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            own = codes[a:b]
            n = size[own]
            at = np.repeat(begin[own] - (np.cumsum(n) - n), n)
            yield flat[at + np.arange(len(at))]


def encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def pieces(docs: DataFrame, tokenizer: str, capacity: int, id_col: str = "doc_id", text_col: str = "text",
           end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32 (and ids).

    A document's ids are its text's (null or empty: none), then ``end_id``. Only documents longer than
    ``capacity`` are cut, every ``capacity`` ids.
    """
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for b in batches:
            if not b.num_rows:
                continue
            cols: list[list] = [[] for _ in range(6 if with_ids else 5)]
            for doc, ids in zip(b.column(0).to_pylist(), enc.texts(b.column(1)), strict=True):
                ids = np.append(ids, np.uint32(end_id)).astype("<u4")
                for k, at in enumerate(range(0, len(ids), capacity)):
                    part = ids[at:at + capacity]
                    row = (doc, k, at, len(part), zlib.crc32(part.tobytes()), part.astype(np.int32))
                    for c, v in zip(cols, row, strict=False):
                        c.append(v)
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int32())]
            yield pa.record_batch([pa.array(c, t) for c, t in zip(cols, kinds, strict=False)],
                                  names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:len(cols)])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, schema)


def cutting_stock(sizes: list[int], demand: list[int], capacity: int) -> list[tuple[np.ndarray, int]]:
    """Configurations of the given sizes with whole numbers of uses, by column generation.

    The linear program "cover the demand with the fewest sequences" is solved by the revised simplex
    method; new columns come from an unbounded knapsack on the dual prices. Uses are rounded down: what
    they leave uncovered is placed best-fit later.
    """
    k = len(sizes)
    size = np.array(sizes)
    columns = [np.eye(k, dtype=int)[i] * (capacity // sizes[i]) for i in range(k)]
    need = np.array(demand, dtype=float)
    for _ in range(40 * k + 100):
        basis = np.array(columns, dtype=float).T
        price = np.linalg.solve(basis.T, np.ones(k))
        best = np.zeros(capacity + 1)
        pick = np.full(capacity + 1, -1)
        for c in range(int(size.min()), capacity + 1):
            fits = np.flatnonzero(size <= c)
            gain = best[c - size[fits]] + price[fits]
            j = int(gain.argmax())
            best[c], pick[c] = (gain[j], fits[j]) if gain[j] > best[c - 1] + 1e-12 else (best[c - 1], -1)
        if best[capacity] <= 1 + 1e-7:
            break
        column, c = np.zeros(k, dtype=int), capacity
        while c > 0:
            if pick[c] < 0:
                c -= 1
                continue
            column[pick[c]] += 1
            c -= int(size[pick[c]])
        step, use = np.linalg.solve(basis, column), np.linalg.solve(basis, need)
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        columns[int(ratio.argmin())] = column
    use = np.linalg.solve(np.array(columns, dtype=float).T, need)
    return [(c, int(u + 1e-9)) for c, u in zip(columns, use, strict=True) if u + 1e-9 >= 1]


#: (groups, small_share) that best_plan tries. At a half, configurations hold one large piece each.
SETTINGS = ((12, 1 / 8), (24, 1 / 3), (24, 1 / 2))


def best_plan(counts: dict[int, int], capacity: int, settings=SETTINGS) -> list[tuple]:
    """The plan with the fewest sequences over a few settings of the scheme (the first of equals)."""
    found = [plan(counts, capacity, *x) for x in settings]
    return min(found, key=lambda runs: max((first + n for _, _, n, first, _ in runs), default=0))


def plan(counts: dict[int, int], capacity: int, groups: int = 24, small_share: float = 1 / 3) -> list[tuple]:
    """Runs (length, first_rank, n, first_sequence, offset) that place every piece of the histogram.

    Lengths above ``small_share * capacity`` are large. The number of runs depends on ``capacity`` and
    ``groups``, not on the number of pieces. An empty histogram gives no runs.
    """
    left = {n: c for n, c in counts.items() if c > 0}
    rank = dict.fromkeys(left, 0)
    runs: list[tuple] = []
    sequence = 0
    free: dict[int, list[list[int]]] = {}  # space left -> [first_sequence, n]
    spaces: list[int] = []

    def open_space(space: int, first: int, n: int) -> None:
        if space and n:
            if space not in free:
                free[space] = []
                insort(spaces, space)
            free[space].append([first, n])

    def place(length: int, n: int, first: int, offset: int) -> None:
        runs.append((length, rank[length], n, first, offset))
        rank[length] += n
        left[length] -= n

    large = sorted((n for n in left if n > small_share * capacity), reverse=True)
    total = sum(left[n] for n in large)
    if total:
        group_size = -(-total // groups)
        members: list[list[list[int]]] = []  # group -> [length, number], longest first
        room = 0
        for n in large:
            c = left[n]
            while c:
                if not room:
                    members.append([])
                    room = group_size
                take = min(c, room)
                members[-1].append([n, take])
                c, room = c - take, room - take
        merged: dict[int, list[list[int]]] = {}
        for g in members:  # groups with the same rounded size are one size
            merged.setdefault(g[0][0], []).extend(g)
        sizes = list(merged)
        demand = [sum(c for _, c in merged[s]) for s in sizes]
        for column, uses in cutting_stock(sizes, demand, capacity):
            slots = [s for s, a in zip(sizes, column, strict=True) for _ in range(a)]
            done = 0
            while done < uses:  # a stretch of sequences whose slots have the same actual lengths
                avail = {s: merged[s] for s in dict.fromkeys(slots)}
                stretch, chosen, want = uses - done, [], {}
                for s in slots:
                    queue = avail[s]
                    i = want.get(s, 0)
                    if i < len(queue):
                        chosen.append((s, i))
                        want[s] = i + 1 if queue[i][1] < 2 * (uses - done) else i
                share: dict[tuple, int] = {}
                for c in chosen:
                    share[c] = share.get(c, 0) + 1
                for (s, i), m in share.items():
                    stretch = min(stretch, avail[s][i][1] // m if m > 1 else avail[s][i][1])
                if not chosen:
                    break
                if not stretch:  # a run too short for its slots: one sequence, slot by slot
                    chosen, stretch, want = [], 1, {}
                    for s in slots:
                        i = next((i for i, (_, c) in enumerate(avail[s]) if c > want.get((s, i), 0)), None)
                        if i is not None:
                            chosen.append((s, i))
                            want[s, i] = want.get((s, i), 0) + 1
                offset = 0
                for s, i in chosen:
                    n = avail[s][i][0]
                    place(n, stretch, sequence, offset)
                    avail[s][i][1] -= stretch
                    offset += n
                for s in avail:
                    merged[s][:] = [x for x in merged[s] if x[1]]
                open_space(capacity - offset, sequence, stretch)
                sequence += stretch
                done += stretch
    for n in sorted(left, reverse=True):  # best fit, longest first
        while left[n]:
            i = bisect_left(spaces, n)
            if i == len(spaces):
                space, first, have = capacity, sequence, max(1, left[n] // (capacity // n))
                sequence += have
            else:
                space = spaces[i]
                first, have = free[space].pop()
                if not free[space]:
                    del free[space], spaces[i]
            each = min(space // n, left[n])
            use = min(have, left[n] // each)
            for k in range(each):
                place(n, use, first, capacity - space + k * n)
            open_space(space - each * n, first, use)
            open_space(space, first + use, have - use)
    return runs


def pack(docs: DataFrame, tokenizer: str, capacity: int = 4096, id_col: str = "doc_id", text_col: str = "text",
         end_id: int = 1, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32[, ids], sequence_id, offset for every piece of ``docs``.

    Sequences hold at most ``capacity`` ids, gapless from 0. A null or empty text is one piece with the
    end id alone; repeated rows are documents of their own; an empty table gives no rows. Only ``id_col``
    and ``text_col`` are read. The runs joined to the pieces are bounded by ``capacity`` and the groups.
    """
    part = cut(pieces(docs, tokenizer, capacity, id_col, text_col, end_id, with_ids)
               .withColumn("_bucket", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.spark_partition_id()),
                                             F.lit(RANK_BUCKETS))))
    sums = part.groupBy("length", "_bucket").agg(F.count("*").alias("_n"))
    counts: dict[int, int] = {}
    for r in sums.groupBy("length").agg(F.sum("_n").alias("n")).collect():
        counts[r["length"]] = r["n"]
    runs = best_plan(counts, capacity)
    spark = docs.sparkSession
    schema = "length long, _first long, _many long, _sequence long, _offset long"
    placed = spark.createDataFrame(runs, schema)
    before = Window.partitionBy("length").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sums.select("length", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    own = Window.partitionBy("length", "_bucket").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (part.withColumn("_own", F.row_number().over(own) - 1).join(starts, ["length", "_bucket"])
              .withColumn("_rank", F.col("_own") + F.col("_start")))
    out = ranked.join(F.broadcast(placed), "length") \
        .where("_rank >= _first AND _rank < _first + _many") \
        .select("doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else []),
                (F.col("_sequence") + F.col("_rank") - F.col("_first")).alias("sequence_id"),
                F.col("_offset").alias("offset"))
    return out
