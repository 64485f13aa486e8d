"""SimHash near-duplicates: pigeonhole blocks, exact Hamming check, distributed components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.base import cut, unused
from ledgerline.llm.components import connected_components, units

BITS = 64
#: Fingerprints of one bucket chunk; a work unit holds two chunks, its distance rows are built 256 at a time.
CHUNK = 1024


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """Signed 64-bit SimHash of a whole text.

    Words are runs without ASCII white space after lower-casing A-Z (``bytes.lower`` and ``bytes.split``
    do exactly that); shingles are ``shingle`` words joined by a space, repeats included, the whole
    sequence if there are fewer words. A bit is set if more than half of the shingles' XXH64 (seed 42)
    have it. No word: 0.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        grams = [b" ".join(words)]
    else:
        grams = map(b" ".join, zip(*(words[i:] for i in range(shingle)), strict=False))
    n = max(1, len(words) - shingle + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype="<u8", count=n)
    ones = np.zeros(BITS, dtype=np.int64)
    for i in range(0, n, 1 << 15):
        part = hashes[i:i + (1 << 15)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3) -> DataFrame:
    """(doc_id, fp) for every row; a null or wordless text has fingerprint 0."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = [fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.record_batch([b.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")) \
        .mapInArrow(run, "doc_id long, fp long")


def block_masks(max_bits: int) -> list[int]:
    """Masks such that two fingerprints at most ``max_bits`` apart agree under at least one.

    The 64 bits are cut into ``max_bits + 1`` blocks: one block agrees (pigeonhole). The rest of the
    bits, cut again into ``max_bits + 1`` parts, has an agreeing part too. A mask is a block with one
    part of its rest, about 28 bits for 3, so buckets stay small on billions of fingerprints.
    """
    k = max_bits + 1
    bits = np.arange(BITS)
    out = []
    for block in np.array_split(bits, k):
        for part in np.array_split(np.setdiff1d(bits, block), k):
            mask = sum(1 << int(i) for i in np.concatenate([block, part]))
            out.append(mask - (1 << BITS) if mask >> (BITS - 1) else mask)
    return out


def near_edges(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star for each group of fingerprints connected within ``max_bits`` inside one unit."""
    fps = np.unique(fps)
    n = len(fps)
    u = fps.view(np.uint64)
    root = np.arange(n)

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i in range(0, n, 256):
        near = np.bitwise_count(u[i:i + 256, None] ^ u[None, :]) <= max_bits
        for r in range(near.shape[0]):
            for j in np.flatnonzero(near[r, i + r + 1:]) + i + r + 1:
                x, y = find(i + r), find(int(j))
                if x != y:
                    root[max(x, y)] = min(x, y)
    tops = np.array([find(i) for i in range(n)])
    linked = tops != np.arange(n)
    return fps[linked], fps[tops[linked]]


def link_fingerprints(distinct: DataFrame, max_bits: int = 3, chunk: int = CHUNK) -> DataFrame:
    """Edges (a, b) whose components are those of all pairs at most ``max_bits`` apart.

    ``distinct`` has one row per fingerprint (copies are one row, however many). Buckets are cut into
    chunk pairs (:func:`ledgerline.llm.components.units`); a unit returns spanning edges, at most one per
    fingerprint, never all its pairs.
    """
    masks = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("block"))
                      for i, m in enumerate(block_masks(max_bits))])
    keys = distinct.select("fp", F.inline(masks))
    groups = (units(keys, ["t", "block"], "fp", chunk)
              .groupBy("t", "block", "lo", "hi").agg(F.collect_list("fp").alias("fps")))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            found = [near_edges(np.asarray(x, dtype=np.int64), max_bits) for x in b["fps"]]
            if found:
                yield pd.DataFrame({"a": np.concatenate([x[0] for x in found]),
                                    "b": np.concatenate([x[1] for x in found])}).drop_duplicates()

    return groups.select("fps").mapInPandas(run, "a long, b long")


def simhash_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                       max_bits: int = 3) -> DataFrame:
    """doc_id, fp, component_id for every row of ``docs``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked; component_id is the
    smallest doc_id reachable over links, the document's own included. Null and empty texts have
    fingerprint 0 and are linked like any other; repeated rows give repeated rows; a null doc_id has the
    component of its text (null if that has no id at all); an empty table gives no rows. Only ``id_col``
    and ``text_col`` are read, so other columns can't clash.
    """
    fp = cut(fingerprints(docs, id_col, text_col, shingle))
    classes = cut(fp.groupBy("fp").agg(F.min("doc_id").alias("first_id")))
    roots = connected_components(link_fingerprints(classes.select("fp"), max_bits))
    rooted = (classes.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
              .select("fp", "first_id", F.coalesce("root", "fp").alias("root")))
    lowest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return fp.join(rooted.join(lowest, "root").select("fp", "component_id"), "fp") \
        .select("doc_id", "fp", "component_id")


def keep_one_per_component(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                           max_bits: int = 3) -> DataFrame:
    """The rows of ``docs`` without near-copies: the document with the smallest id of each component.

    Rows that share the kept id (repeated rows, or a reused id) are one document: the smallest row of
    them stays. Rows without an id can't be named and all stay. Columns and their order are those of
    ``docs``, whatever they are called.
    """
    row_id, rows = unused(docs, "_kept_id"), unused(docs, "_kept_rows")
    found = simhash_components(docs, id_col, text_col, shingle, max_bits)
    keep = (found.where("doc_id = component_id").groupBy(F.col("doc_id").alias(row_id))
            .agg(F.count("*").alias(rows)))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    marked = docs.join(keep, docs[id_col].cast("long") == keep[row_id])
    again = (marked.where(F.col(rows) > 1).groupBy(row_id)
             .agg(F.min(F.struct(*columns)).alias(rows)).select(f"{rows}.*"))
    return (marked.where(F.col(rows) == 1).select(*columns).unionByName(again)
            .unionByName(docs.where(docs[id_col].cast("long").isNull())))
