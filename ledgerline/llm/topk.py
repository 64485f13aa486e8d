"""Exact top-k by integer inner product with a pivot table that rules candidates out."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.llm.base import cut

PIVOTS = 32
#: Rows of a packed block of candidates and of queries; a work unit is one of each.
CANDIDATES, QUERIES = 512, 128
SCALE = 1024.0


def to_integers(vector) -> np.ndarray | None:
    """floor(1024 * x) of each component in double precision; None for a vector that takes no part (null,
    empty, or with a null or non-finite component)."""
    if vector is None or len(vector) == 0 or any(x is None for x in vector):
        return None
    x = np.floor(SCALE * np.asarray(vector, dtype=np.float64))
    return x if np.isfinite(x).all() else None


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.sqrt(((x[:, None, :] - pivots[None, :, :]) ** 2).sum(2))


def blocks(vectors: DataFrame, pivots: dict[int, np.ndarray], rows: int, id_col: str, vector_col: str) -> DataFrame:
    """Packed blocks (n, dim, ids, vectors, pivot distances) of at most ``rows`` vectors of one length: the
    pivot table. Rows that take no part are left out. No group is formed: a task packs what it reads."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        held: dict[int, list] = {}

        def packed(dim):
            ids, vecs = zip(*held.pop(dim), strict=True)
            x = np.stack(vecs)
            marks = pivots.get(dim, np.zeros((1, dim)))  # a length that no pivot has meets no candidate either
            return pa.record_batch(
                [pa.array([len(ids)], pa.int32()), pa.array([dim], pa.int32()),
                 pa.array([np.array(ids, dtype="<i8").tobytes()], pa.binary()), pa.array([x.tobytes()], pa.binary()),
                 pa.array([distances(x, marks).tobytes()], pa.binary())],
                names=["n", "dim", "ids", "vecs", "dists"])

        for b in batches:
            for i, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                x = to_integers(v)
                if x is not None and i is not None:
                    held.setdefault(len(x), []).append((i, x))
                    if len(held[len(x)]) == rows:
                        yield packed(len(x))
        for dim in sorted(held):
            yield packed(dim)

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")) \
        .mapInArrow(run, "n int, dim int, ids binary, vecs binary, dists binary")


def choose_pivots(vectors: DataFrame, id_col: str, vector_col: str, n: int = PIVOTS) -> dict[int, np.ndarray]:
    """For each vector length, ``n`` vectors with the smallest hashes of (length, id) (a bounded sample:
    pivots only make bounds tighter or looser, never wrong)."""
    size = F.size(vector_col)
    order = Window.partitionBy("dim").orderBy("h", "id")
    rows = (vectors.where(size > 0).select(size.alias("dim"), F.col(id_col).cast("long").alias("id"),
                                           F.xxhash64(F.lit(2), F.col(id_col)).alias("h"), F.col(vector_col).alias("v"))
            .withColumn("r", F.row_number().over(order)).where(F.col("r") <= n).collect())
    out: dict[int, list] = {}
    for r in sorted(rows, key=lambda r: (r["dim"], r["r"])):
        out.setdefault(r["dim"], [])
        x = to_integers(r["v"])
        if x is not None:
            out[r["dim"]].append(x)
    return {d: np.stack(x) if x else np.zeros((1, d)) for d, x in out.items()}


def unit_top(q_ids, q, q_dist, ids, x, x_dist, k: int):
    """The best ``k`` of one candidate block for each query, exactly: (query_id, vec_id, score) arrays.

    A distance is at least ``max |d(q,p) - d(x,p)|`` over the pivots, so the inner product is at most
    ``(|q|^2 + |x|^2 - that^2) / 2``. Candidates are scored in the order of this bound, some at a time,
    until the k-th best score is above the next bound (equal bounds may still win by their smaller id).
    """
    low = np.zeros((len(q), len(x)))
    for p in range(q_dist.shape[1]):
        np.maximum(low, np.abs(q_dist[:, p, None] - x_dist[None, :, p]), out=low)
    bound = ((q ** 2).sum(1)[:, None] + (x ** 2).sum(1)[None, :] - low ** 2) / 2
    bound += 1e-9 * np.abs(bound) + 1e-3 + 1e-9 * low ** 2  # rounding of the distances
    largest = max(np.abs(q).max(initial=0), np.abs(x).max(initial=0))
    exact = q.shape[1] * largest ** 2 < 2 ** 53
    out = []
    for i in range(len(q)):
        order = np.argsort(-bound[i], kind="stable")
        got_id, got = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        for at in range(0, len(order), 64):
            if len(got) >= k and got[k - 1] > bound[i, order[at]]:
                break
            part = order[at:at + 64]
            part = part[ids[part] != q_ids[i]]
            if exact:
                s = (x[part] @ q[i]).astype(np.int64)
            else:  # whole numbers beyond a double: Python's
                s = np.array([min(max(sum(int(a) * int(b) for a, b in zip(x[j], q[i], strict=True)), -2 ** 63),
                                  2 ** 63 - 1) for j in part], dtype=np.int64)
            got_id, got = np.concatenate([got_id, ids[part]]), np.concatenate([got, s])
            best = np.lexsort((got_id, -got))[:k]
            got_id, got = got_id[best], got[best]
        out.append((np.full(len(got), q_ids[i]), got_id, got))
    return [np.concatenate(c) for c in zip(*out, strict=True)]


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id",
          vector_col: str = "embedding", pivots: int = PIVOTS) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` highest inner products of floor(1024 * x) vectors for every
    query row, over all rows of ``vectors`` but those of the query's id; ties to the smaller id.

    Vectors that are null, empty, or hold a null or non-finite component, and rows without id, take no
    part; vectors of another length aren't compared. Repeated candidate rows count each; a repeated query
    id is answered once, for its rows' best. An empty table gives no rows. A score beyond 64 bits is cut
    to them. Queries meet candidates block by block: query blocks are copied to ``shuffle.partitions``
    slots, over which the candidate blocks are dealt evenly, and each unit returns ``k`` rows a query.
    """
    spark = vectors.sparkSession
    slots = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    table = choose_pivots(vectors, id_col, vector_col, pivots)
    cand = cut(blocks(vectors, table, CANDIDATES, id_col, vector_col)
               .withColumn("slot", F.pmod(F.xxhash64("ids"), F.lit(slots)).cast("int")))
    asked = blocks(queries, table, QUERIES, id_col, vector_col)
    asked = cut(asked).withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(slots - 1))))
    pairs = cand.join(asked.select("slot", "dim", F.col("n").alias("qn"), F.col("ids").alias("q_ids"),
                                   F.col("vecs").alias("q_vecs"), F.col("dists").alias("q_dists")), ["slot", "dim"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in range(b.num_rows):
                c = {n: b.column(n)[r].as_py() for n in b.schema.names}
                arr = lambda key, n, kind="<f8": np.frombuffer(c[key], dtype=kind).reshape(n, -1)
                got = unit_top(arr("q_ids", c["qn"], "<i8")[:, 0], arr("q_vecs", c["qn"]), arr("q_dists", c["qn"]),
                               arr("ids", c["n"], "<i8")[:, 0], arr("vecs", c["n"]), arr("dists", c["n"]), k)
                yield pa.record_batch([pa.array(x, pa.int64()) for x in got], names=["query_id", "vec_id", "score"])

    local = pairs.mapInArrow(run, "query_id long, vec_id long, score long")
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return local.withColumn("rank", F.row_number().over(rank)).where(F.col("rank") <= k) \
        .select("query_id", "rank", "vec_id", "score")
