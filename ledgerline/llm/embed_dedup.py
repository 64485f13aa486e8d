"""Near-duplicate vectors: random-hyperplane signs in several tables, exact cosine, components."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.base import cut
from ledgerline.llm.components import connected_components, units

#: Two vectors at cosine 0.98 agree on one sign with probability 0.936, on 16 with 0.348, and so meet in
#: at least one of 20 tables with probability 0.9998.
TABLES, BITS = 20, 16
CHUNK = 512


def class_rows(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """vec_id, label, key, vec: ``key`` names the class of equal vectors of a label (a 128-bit digest),
    null for a row that links with nothing: null label, null or zero vector, null or non-finite part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, vecs = [], []
            for label, v in zip(b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
                x = None
                if label is not None and v and not any(p is None for p in v):
                    x = np.asarray(v, dtype="<f8") + 0.0  # no -0.0
                    if not np.isfinite(x).all() or not x.any():
                        x = None
                data = None if x is None else x.tobytes()
                vecs.append(data)
                keys.append(None if x is None else
                            hashlib.blake2b(data + b"|" + label.encode(), digest_size=16).digest())
            yield pa.record_batch([b.column(0), b.column(1), pa.array(keys, pa.binary()), pa.array(vecs, pa.binary())],
                                  names=["vec_id", "label", "key", "vec"])

    return vectors.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("string").alias("l"),
                          F.col(vector_col).alias("v")) \
        .mapInArrow(run, "vec_id long, label string, key binary, vec binary")


def signs(classes: DataFrame, tables: int, bits: int) -> DataFrame:
    """Adds ``sig`` (one hash a table) from hyperplanes drawn once for each vector length."""
    names = classes.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        for b in batches:
            sig = []
            for raw in b.column(names.index("vec")).to_pylist():
                x = np.frombuffer(raw, dtype="<f8")
                if len(x) not in planes:
                    planes[len(x)] = np.random.default_rng(len(x)).standard_normal((len(x), tables * bits))
                up = (x / np.abs(x).max() @ planes[len(x)] > 0).reshape(tables, bits)
                sig.append((up @ (1 << np.arange(bits))).tolist())
            yield pa.record_batch([*b.columns, pa.array(sig, pa.list_(pa.int32()))], names=[*names, "sig"])

    kinds = ", ".join(f"{n} {t}" for n, t in classes.dtypes)
    return classes.mapInArrow(run, f"{kinds}, sig array<int>")


def unit_links(keys, n, chunk, sig, vecs, t: int, lo: int, hi: int, least: float):
    """Links of one unit, each found here for the first time: (key, links to rows of others, root key).

    A pair that agrees in an earlier table is that table's. With two chunks, only pairs across them count.
    """
    x = np.stack([np.frombuffer(v, dtype="<f8") for v in vecs])
    norm = np.sqrt((x * x).sum(1))
    sig, n, chunk = np.array(sig), np.array(n), np.array(chunk)
    m = len(keys)
    links, root = np.zeros(m, dtype=np.int64), np.arange(m)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(0, m, 128):
        near = (x[i:i + 128] @ x.T) / (norm[i:i + 128, None] * norm[None, :]) >= least
        near &= np.arange(m)[None, :] != np.arange(i, min(m, i + 128))[:, None]
        if lo != hi:
            near &= chunk[i:i + 128, None] != chunk[None, :]
        for e in range(t):
            near &= sig[i:i + 128, e, None] != sig[None, :, e]
        links[i:i + 128] = near @ n
        for r, c in zip(*np.nonzero(near), strict=True):
            a, b = find(i + int(r)), find(int(c))
            if a != b:
                root[max(a, b)] = min(a, b)
    return [(keys[i], int(links[i]), keys[find(i)]) for i in range(m) if links[i]]


def near_duplicates(vectors: DataFrame, least: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label", tables: int = TABLES, bits: int = BITS) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row.

    Rows of one label (not null) whose cosine, in double precision, is at least ``least`` are linked; the
    hash tables find a pair at the limit with probability 0.9998, and no pair below it is linked. Equal
    vectors are one class with a count, however many rows it has. Vectors that are null, zero or hold
    null or non-finite components link with nothing, nor do null labels: no links, their own id as
    component. Vectors of another length aren't compared. Repeated rows are rows of their own; null ids
    are links but never a component's id. An empty table gives no rows. Other columns aren't read.
    """
    rows = cut(class_rows(vectors, id_col, vector_col, label_col))
    grouped = rows.where("key IS NOT NULL").groupBy("key").agg(
        F.count("*").alias("n"), F.min("vec_id").alias("first_id"), F.min("label").alias("label"), F.min("vec").alias("vec"))
    classes = cut(signs(grouped, tables, bits))
    keys = classes.select("key", "label", F.length("vec").alias("size"), F.posexplode("sig").alias("t", "hash"))
    bucket = ["label", "size", "t", "hash"]
    work = units(keys, bucket, "key", CHUNK).join(classes.select("key", "n", "sig", "vec"), "key") \
        .groupBy(*bucket, "lo", "hi").agg(F.collect_list(F.struct("key", "n", "chunk", "sig", "vec")).alias("m")) \
        .select("t", "lo", "hi", "m")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            head = [b.column(i).to_pylist() for i in range(3)]
            for r in range(b.num_rows):
                m = b.column(3)[r].values
                if len(m) > 1:
                    out += unit_links(*(m.field(i).to_pylist() for i in range(5)), *(h[r] for h in head), least)
            yield pa.record_batch([pa.array([o[0] for o in out], pa.binary()), pa.array([o[1] for o in out], pa.int64()),
                                   pa.array([o[2] for o in out], pa.binary())], names=["key", "links", "root"])

    links = cut(work.mapInArrow(run, "key binary, links long, root binary"))
    roots = connected_components(links.select("key", "root"), "key", "root").withColumnRenamed("node", "key")
    each = links.groupBy("key").agg(F.sum("links").alias("links"))
    known = (classes.select("key", "n", "first_id").join(roots, "key", "left").join(each, "key", "left")
             .select("key", "first_id", F.coalesce("root", "key").alias("root"),
                     (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    lowest = known.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return (rows.select("vec_id", "key").join(known.join(lowest, "root").select("key", "n_links", "component_id"),
                                              "key", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce("component_id", F.when(F.col("n_links").isNull(), F.col("vec_id"))).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False))))
