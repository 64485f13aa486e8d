"""SimHash, embeddings, components against brute force."""
import random
import re

import numpy as np
import pytest
import xxhash

from ledgerline.llm import components, embed_dedup, simhash


def plain_fingerprint(text):
    words = re.findall("[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else \
        [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def union(n, pairs):
    root = list(range(n))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def texts():
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)] + ["É", "Ünï", "A\x85b", "x\xa0y"]
    out = []
    for _ in range(60):
        t = rnd.choices(words, k=rnd.choice([1, 2, 3, 40, 400]))
        out.append(" ".join(t))
        for _ in range(rnd.choice([0, 0, 3])):
            u = list(t)
            u[rnd.randrange(len(u))] = "changed"
            out.append("\t".join(u).upper())
    return [*out, out[0], out[0], "", None, " \n", "w1 " * 30_000]


def test_simhash_equals_brute_force(spark, docs_of):
    t = texts()
    rows = [(i * 7 % 1000, x, None, None, None) for i, x in enumerate(t)]
    got = simhash.simhash_components(docs_of(rows)).collect()
    fps = [plain_fingerprint(x) for x in t]
    near = [(a, b) for a in range(len(t)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 3]
    top = union(len(t), near)
    low = {}
    for i, r in enumerate(top):
        low[r] = min(low.get(r, 1 << 60), rows[i][0])
    assert sorted((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == \
        sorted((rows[i][0], fps[i], low[top[i]]) for i in range(len(t)))


def test_block_masks_never_miss_a_close_pair():
    rng = np.random.default_rng(1)
    masks = [m % (1 << 64) for m in simhash.block_masks(3)]
    for _ in range(3000):
        diff = sum(1 << int(b) for b in rng.choice(64, 3, replace=False))
        assert any(diff & m == 0 for m in masks)


def test_hot_bucket_is_split_and_keeps_every_link(spark):
    rng = np.random.default_rng(2)
    fps = sorted({int(sum(1 << int(b) for b in rng.choice(10, rng.integers(0, 6), replace=False))) for _ in range(900)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long")
    edges = simhash.link_fingerprints(df, 3, chunk=40)
    got = {r.node: r.root for r in components.connected_components(edges).collect()}
    near = [(a, b) for a in range(len(fps)) for b in range(a) if bin(fps[a] ^ fps[b]).count("1") <= 3]
    assert [got.get(f, f) for f in fps] == [fps[i] for i in union(len(fps), near)]
    assert edges.count() < 40 * len(fps)


def test_components_of_a_path_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(50)] + [(1000, 2000 + i) for i in range(300)] + [(5, 5), (None, 3)]
    got = {r.node: r.root for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert {got[i] for i in range(51)} == {0} and {got[2000 + i] for i in range(300)} == {1000} and len(got) == 352


def test_one_stays_of_each_component(spark, docs_of):
    long = "one two three four five six seven eight nine ten " * 20
    rows = [(9, long, "a", "b", 1), (4, long, "c", "d", 2), (4, long, "c", "d", 2), (4, long, "z", "d", 2),
            (7, "other words here", None, None, None), (None, long, None, None, None), (None, "x", None, None, None)]
    df = docs_of(rows).selectExpr("*", "1 AS fp", "2 AS _kept_id", "3 AS component_id")
    out = simhash.keep_one_per_component(df)
    assert out.columns == df.columns
    assert sorted((r.doc_id is None, r.doc_id, r.lang) for r in out.where("doc_id IS NOT NULL").collect()) == \
        [(False, 4, "c"), (False, 7, None)]
    assert out.where("doc_id IS NULL").count() == 2
    empty = docs_of([])
    assert simhash.keep_one_per_component(empty).count() == 0 and simhash.simhash_components(empty).count() == 0


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(4)
    out = []
    for c in range(40):
        v = rng.standard_normal(16)
        for _ in range(int(rng.integers(1, 6))):
            out.append((v + rng.standard_normal(16) * rng.choice([0, 0.02, 0.06])).astype(np.float32).tolist())
    rows = [(i, v, int(rng.integers(0, 2))) for i, v in enumerate(out)]
    rows += [(500, out[0], rows[0][2]), (501, out[0], rows[0][2]), (502, out[0], None), (503, [0.0] * 16, 1), (504, None, 1),
             (505, [1.0, None] + [0.0] * 14, 1), (506, [float("nan")] * 16, 1), (507, [], 1), (508, out[0][:8], rows[0][2]),
             (0, out[0], rows[0][2])]
    return rows


def test_embedding_links_equal_brute_force(spark, vectors, monkeypatch):
    monkeypatch.setattr(embed_dedup, "CHUNK", 3)  # buckets of more rows are split
    df = spark.createDataFrame(vectors, "vec_id long, embedding array<float>, label int").selectExpr("*", "1 AS key", "2 AS n")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in embed_dedup.near_duplicates(df).collect())

    def usable(r):
        v = r[1]
        return r[2] is not None and v and None not in v and np.isfinite(v).all() and any(v)
    n = len(vectors)
    near = []
    for a in range(n):
        for b in range(a):
            x, y = vectors[a], vectors[b]
            if usable(x) and usable(y) and x[2] == y[2] and len(x[1]) == len(y[1]):
                u, v = np.array(x[1], dtype=float), np.array(y[1], dtype=float)
                if u @ v / (np.sqrt(u @ u) * np.sqrt(v @ v)) >= 0.98:
                    near.append((a, b))
    top = union(n, near)
    low, links = {}, [0] * n
    for i in range(n):
        low[top[i]] = min(low.get(top[i], 1 << 60), vectors[i][0])
    for a, b in near:
        links[a] += 1
        links[b] += 1
    assert got == sorted((vectors[i][0], links[i], low[top[i]], vectors[i][0] == low[top[i]]) for i in range(n))
    assert embed_dedup.near_duplicates(df.limit(0)).count() == 0
