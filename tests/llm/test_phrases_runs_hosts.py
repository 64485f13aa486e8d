"""Phrases, periodic runs and host reputation against brute force on small fixtures."""
import hashlib
import math
import random
import zlib

import numpy as np
import pytest

from ledgerline.llm import hosts, phrases, queries, runs


# --- phrases -------------------------------------------------------------------------------------
def brute_phrases(rows, least, top):
    import re
    from collections import Counter
    f, n = Counter(), Counter()
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(low)):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i:i + k])) for k in range(1, 5) for i in range(len(w) - k + 1))
    out = []
    for (lang, p), a in f.items():
        if len(p) < 2 or a < least:
            continue
        score, _, le, ri = min((2000000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]])
                               for k in range(1, len(p)))
        held = any(100 * b >= 80 * a for (g, q), b in f.items() if g == lang and len(q) > len(p) and b >= least and
                   any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1)))
        if not held:
            out.append((lang, " ".join(p), a, le, ri, n[lang], score))
    got = []
    for lang in {o[0] for o in out}:
        mine = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[6], -o[2], o[1].encode()))
        got += [(o[0], i + 1, *o[1:]) for i, o in enumerate(mine[:top])]
    return sorted(got)


def test_phrases_equal_brute_force(spark):
    rng = random.Random(5)
    words = ["The", "the", "of", "Éa", "éa", "new", "york", "x-ray", "a\u00a0b"]
    rows = [(rng.choice(["en", "de", None]), "".join(rng.choice(words) + rng.choice([" ", " ", "\t", "  ", ", ", "\n", ". "])
             for _ in range(rng.randrange(60)))) for _ in range(120)]
    rows += [("en", None), ("en", ""), (None, "...\n\t "), ("fr", "a"), ("en", "new york city " * 40)] + [("en", "tie tie")] * 9
    for least, top in ((3, 2000), (3, 7), (30, 5)):
        df = spark.createDataFrame([(t, la, 1) for la, t in rows], "text string, lang string, size int")
        got = sorted(map(tuple, phrases.collocations(df, least, top).collect()))
        assert got == brute_phrases(rows, least, top)


def test_phrases_of_small_batches_and_full_sketch(spark, monkeypatch):
    rows = [("en", "to be or not to be " * 3, 0), ("en", "to be", 1)] * 5
    df = spark.createDataFrame(rows, "lang string, text string, phrase int").repartition(3)
    want = brute_phrases([r[:2] for r in rows], 2, 50)
    assert sorted(map(tuple, phrases.collocations(df, 2, 50).collect())) == want
    all_set = np.full(1 << phrases.GRAM_BITS >> 3, 255, np.uint8)
    monkeypatch.setattr(phrases, "frequent_grams", lambda *_: all_set)  # nothing pruned: the same counts
    assert sorted(map(tuple, phrases.collocations(df, 2, 50).collect())) == want


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(df).collect() == []
    assert phrases.collocations(spark.createDataFrame([(None, None), ("", "en")], "text string, lang string")).collect() == []


# --- runs ----------------------------------------------------------------------------------------
def brute_runs(w, least_periods, least_words):
    n, out, seen = len(w), [], set()
    for q in range(1, n // 3 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            b = i
            while i + q < n and w[i] == w[i + q]:
                i += 1
            e = i + q
            if (b, e) not in seen and e - b >= max(least_words, least_periods * q):
                out.append((b, e - b, q))
            if e - b >= 2 * q:
                seen.add((b, e))
    return sorted(out, key=lambda r: (r[0], r[2]))


def some_words(rng):
    n, k = rng.choice([0, 1, 5, 20, 60, 200, 500]), rng.choice([1, 2, 3, 8, 100])
    w = [str(rng.randrange(k)) for _ in range(n)]
    kind = rng.randrange(5)
    if n and kind == 1:
        a = rng.randrange(n)
        p = 1 + (n - a) // rng.randint(2, 9)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    elif n and kind == 2:
        base = [str(rng.randrange(2)) for _ in range(rng.randint(1, 12))]
        w = [base[i % len(base)] for i in range(n)]
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(n)] = "x"
    elif kind == 3:
        a, b = "a", "ab"
        while len(b) < n:
            a, b = b, b + a
        w = list(b[:n])
    elif kind == 4:  # small periods inside a larger one
        inner = (["a"] * rng.randint(1, 9) + ["b"]) * rng.randint(1, 5) + ["c"]
        w = inner * (n // len(inner) + 5)
    return w


def test_runs_equal_brute_force():
    rng = random.Random(3)
    for _ in range(250):
        texts = [some_words(rng) for _ in range(rng.randint(1, 6))]
        texts += texts[:1]
        periods, least = rng.choice([3, 4]), rng.choice([3, 6])
        got = [[tuple(r) for r in x.tolist()] for _, x in runs.runs_of([" ".join(w).encode() for w in texts], periods, least)]
        assert got == [brute_runs(w, periods, least) for w in texts]


def planted(doc_id, text):
    import re
    w = re.findall("[^\x20\x09-\x0d]+", text or "")
    h, n = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1, len(w)
    if h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    return w


def test_op13_rows_equal_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, rng.choice([" ", "\n", "\t ", "  "]).join(some_words(rng))) for i in range(150)]
    rows += [(200, None), (201, ""), (202, " \n\t"), (None, "a " * 20), (3, "same id"), (203, "é\u00a0è\u2003 " * 9),
             (204, "x y " * 3000), (205, " ".join(map(str, range(3000))) * 2)] + [(-5, "b b b b b b b")] * 2
    df = spark.createDataFrame([(i, t, 7, 8) for i, t in rows], "doc_id long, text string, runs int, id int")
    df.write.parquet(f"{tmp_path}/documents.parquet")
    want = []
    for i, t in rows:
        w = planted(i, t)
        found = brute_runs(w, 4, 6)
        drop = {j for s, n, q in found for j in range(s + q, s + n)}
        best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((i, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
                     sha("".join(f"{s},{n},{q}\n" for s, n, q in found)),
                     sha(" ".join(x for j, x in enumerate(w) if j not in drop))))
    got = queries.op13_periodic_runs(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))
    empty = spark.createDataFrame([], df.schema)
    assert runs.periodic_runs(empty).collect() == []
    with pytest.raises(ValueError):
        runs.periodic_runs(empty, least_periods=2)


# --- hosts ---------------------------------------------------------------------------------------
def brute_place(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    low = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = rest[end:]
    return rest[:end].translate(low), path[:min((path.index(c) for c in "?#" if c in path), default=len(path))]


RULES = [("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"),
         ("a.org", "block"), ("a.org/x", "allow"), ("a.org/x", "block"), (None, "block")]


def brute_rule(host, path):
    best = None
    for rule, verdict in RULES[:-1]:
        rh, _, rp = rule.partition("/")
        if (host == rh or host.endswith("." + rh)) and path.startswith(rule[len(rh):]):
            best = max(best or (0, 0, 0, "", ""), (len(rule), len(rh), verdict == "block", rule, verdict))
    return best[3:] if best else (None, None)


def test_urls_and_rules(spark):
    urls = [None, "", "no scheme/x", "http://Example.COM", "http://example.com/en/1?q=://x/y", "https://m.www.example.com/en/a#b",
            "http://badexample.com/en/", "HTTP://É.Net/es/#", "http://x.net?/es/", "ftp://u:p@x.net:80/es/", "http://a.org", "x://",
            "http://b.a.org/xy/z", "http://a.org?x", "a://b://c.com/d", "http://x\ny.com/\n", "http://..com/", "http://" + "a." * 300 + "com/" + "p" * 5000]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)] * 2, "page_id long, url string, host string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    got = hosts.judge(pages, none, spark.createDataFrame(RULES, "rule string, verdict string")).collect()
    want = [(i, *brute_place(u), *brute_rule(*brute_place(u))) for i, u in enumerate(urls)] * 2
    want = [(*w[:4], w[4] or "allow") for w in want]
    assert sorted(map(repr, (tuple(r)[:5] for r in got))) == sorted(map(repr, want))
    no_rules = spark.createDataFrame([], "rule string, verdict string")
    assert {r.verdict for r in hosts.judge(pages, none, no_rules).collect()} == {"allow"}
    assert hosts.judge(pages.where("false"), none, no_rules).collect() == []


def test_domains(spark):
    rows = ["a.b.example.com", "example.co.uk", "www.example.co.uk", "co.uk", "u@x.org:80", "x.org.", "10.0.0.1", "", "localhost"]
    got = {r.host: (r.domain, r.suffix) for r in hosts.with_domain(spark.createDataFrame([(r,) for r in rows], "host string")).collect()}
    assert got == {"a.b.example.com": ("example.com", "com"), "example.co.uk": ("example.co.uk", "co.uk"),
                   "www.example.co.uk": ("example.co.uk", "co.uk"), "co.uk": ("co.uk", "uk"), "u@x.org:80": ("x.org", "org"),
                   "x.org.": ("x.org", "org"), "10.0.0.1": ("10.0.0.1", ""), "": ("", ""), "localhost": ("localhost", "localhost")}


def exact_above(limit, a, b):
    """P(Beta(a, b) > limit) for whole numbers: a binomial sum."""
    n = a + b - 1
    return sum(math.comb(n, j) * limit ** j * (1 - limit) ** (n - j) for j in range(a))


def test_posterior(spark):
    from pyspark.sql import functions as F
    cases = [(a, b) for a in (1, 2, 7, 60, 400) for b in (1, 3, 50, 420)]
    df = spark.createDataFrame([(float(a), float(b)) for a, b in cases], "a double, b double")
    for limit in (0.5, 0.2, 0.97):
        got = df.select(hosts.share_above(limit, F.col("a"), F.col("b")).alias("p"), hosts.ln_gamma(F.col("a")).alias("g")).collect()
        for (a, b), r in zip(cases, got, strict=True):
            assert abs(r.p - exact_above(limit, a, b)) < 1e-6, (limit, a, b)
            assert abs(r.g - math.lgamma(a)) < 1e-9 * max(1, abs(r.g))


def brute_reputation(counts):
    """Shrinkage in plain Python: {host: (n, bad, domain, suffix)} -> {host: (a, b)}."""
    lg = math.lgamma
    n, bad = sum(c[0] for c in counts.values()), sum(c[1] for c in counts.values())
    means = {(): (bad + 1) / (n + 2)}
    for depth in (1, 2, 3):
        groups = {}
        for host, (n, bad, domain, suffix) in counts.items():
            key = (suffix, domain, host)[:depth]
            o = groups.get(key, (0, 0))
            groups[key] = (o[0] + n, o[1] + bad)

        def fit(s):
            return round(sum(lg(x + s * m) + lg(n - x + s * (1 - m)) - lg(n + s) - lg(s * m) - lg(s * (1 - m)) + lg(s)
                             for k, (n, x) in groups.items() for m in [means[k[:-1]]]), 6)
        s = max(hosts.STRENGTHS, key=lambda s: (fit(s), -s))
        if depth < 3:
            means |= {k: (x + s * means[k[:-1]]) / (n + s) for k, (n, x) in groups.items()}
    return {k[2]: (x + s * means[k[:2]], n - x + s * (1 - means[k[:2]])) for k, (n, x) in groups.items()}, s, means


def test_reputation_equals_brute_force_and_blocks_bad_hosts(spark):
    rng = random.Random(2)
    share = {"good.a.com": 0.05, "bad.a.com": 0.97, "few.a.com": 1.0, "spam.b.net": 0.9, "spam2.b.net": 0.95, "x.c.net": 0.1,
             **{f"h{i}.d{i % 4}.org": rng.random() * 0.3 for i in range(12)}}
    size = {"few.a.com": 2}
    pages, outcomes, i = [], [], 0
    for host, p in share.items():
        for _ in range(size.get(host, 40)):
            pages.append((i, f"http://{host}/p{i}"))
            outcomes.append((i, rng.random() < p))
            i += 1
    pages += [(i + 1, "http://new.b.net/"), (i + 2, "http://new.c.net/"), (0, pages[0][1]), (None, "http://good.a.com/")]
    outcomes += [(0, None), (None, True), (0, False), (10 ** 9, True)]
    df = spark.createDataFrame(pages, "page_id long, url string")
    got = {r.host: r for r in hosts.judge(df, spark.createDataFrame(outcomes, "page_id long, bad boolean"),
                                          spark.createDataFrame([], "rule string, verdict string")).collect()}
    counts = {}
    for (k, bad), (_, u) in zip(outcomes, pages[:i], strict=False):
        h = brute_place(u)[0]
        d = h.split(".", 1)[1]
        o = counts.get(h, (0, 0))
        counts[h] = (o[0] + 1, o[1] + bad, d, d.split(".")[1])
    post, _, _ = brute_reputation(counts)
    draw = np.random.default_rng(1)
    for h, (a, b) in post.items():
        above = (draw.beta(a, b, 200000) > hosts.LIMIT).mean()
        assert (got[h].labelled, got[h].bad) == counts[h][:2]
        if abs(above - hosts.SURE) > 0.01:
            assert got[h].verdict == ("block" if above >= hosts.SURE else "allow"), h
    assert {h for h in share if got[h].verdict == "block"} >= {"bad.a.com", "spam.b.net", "spam2.b.net"}
    assert got["good.a.com"].verdict == got["x.c.net"].verdict == got["new.c.net"].verdict == "allow"
