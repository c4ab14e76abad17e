"""SimHash groups against brute force."""

import random
import re

import numpy as np
import xxhash

from snapfeed.llm import simhash

SF = "/root/testdata/sf0.001"


def fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    parts = [" ".join(words[i: i + k]) for i in range(len(words) - k + 1)] if len(words) >= k else [" ".join(words)] if words else []
    hs = [xxhash.xxh64_intdigest(p.encode(), 42) for p in parts]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hs) * 2 > len(hs))


def groups(rows, bits=4, k=4):
    """(doc_id, fingerprint, component) by comparing all pairs."""
    fps = [fingerprint(t, k) for _, t in rows]
    root = list(range(len(rows)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    ids = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            ids[find(i)] = min(d, ids.get(find(i), d))
    return sorted(((d, fps[i], ids.get(find(i))) for i, (d, _) in enumerate(rows)), key=str)


def found(df):
    return sorted(((r.key, r.fp % (1 << 64), r.component) for r in df.collect()), key=str)


def test_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert found(simhash.near_duplicates(docs)) == groups(rows)


def test_cases(docs):
    """Nulls, blanks, few words, case, white space, repeats, null and equal keys, a very long text."""
    rng = random.Random(2)
    long = " ".join(rng.choice(["alpha", "beta", "gamma", "delta", "é", "ü"]) + str(rng.randrange(5000)) for _ in range(300_000))
    rows = [(5, None), (3, ""), (None, " \n\x0b"), (7, "one"), (8, "ONE"), (9, "one two\tthree"), (10, "one  two three"), (10, "one two three"),
            (11, "É a b c d"), (12, "é a b c d"), (None, "nothing else is like this one here"), (20, long), (21, long.upper().replace("É", "é").replace("Ü", "ü"))]
    assert found(simhash.near_duplicates(docs(rows))) == groups(rows)
    assert simhash.near_duplicates(docs([])).count() == 0
    kept = sorted(str(r.doc_id) for r in simhash.keep_one(docs(rows)).collect())
    named = {c: d for d, _, c in groups(rows)}
    assert kept == sorted(str(d) for d, _, c in groups(rows) if d is None or d == c) and named


def near_groups(rng, n, flips):
    """Fingerprints around a few centres, and some at random."""
    out = []
    for _ in range(4):
        centre = rng.integers(0, 1 << 63, dtype=np.uint64)
        for _ in range(n):
            x = centre
            for b in rng.integers(0, 64, rng.integers(0, flips + 1)):
                x = x ^ (np.uint64(1) << np.uint64(b))
            out.append(int(x))
    return np.unique(np.array(out + [int(x) for x in rng.integers(0, 1 << 63, n, dtype=np.uint64)], np.uint64))


def test_links_connect_all(spark, monkeypatch):
    """Links by variants connect what all pairs connect, with overfull variants split into blocks too."""
    from snapfeed.llm.graph import components

    rng = np.random.default_rng(4)
    for bits, block in ((1, 8192), (3, 8192), (4, 8192), (4, 128), (6, 8192)):
        monkeypatch.setattr(simhash, "BLOCK", block)
        fps = near_groups(rng, 300, bits + 2)
        rows = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
        got = simhash.links(rows, bits)
        pairs = [(r.a % (1 << 64), r.b % (1 << 64)) for r in got.collect()]
        assert all(0 < (a ^ b).bit_count() <= bits for a, b in pairs)
        root = {int(x): int(x) for x in fps}

        def find(a, root=root):
            while root[a] != a:
                a = root[a]
            return a

        for i, x in enumerate(fps):
            for y in fps[:i][np.bitwise_count(fps[:i] ^ x) <= bits]:
                a, b = find(int(x)), find(int(y))
                root[max(a, b)] = min(a, b)
        expected = {}
        for x in fps:
            expected.setdefault(find(int(x)), set()).add(int(x))
        seen = {}
        for r in components(got).collect():
            seen.setdefault(r.root, set()).add(r.node % (1 << 64))
        assert sorted(map(sorted, seen.values())) == sorted(sorted(v) for v in expected.values() if len(v) > 1)


def test_components_of_chains_and_stars(spark):
    from snapfeed.llm.graph import components

    edges = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5000, 5000), (7000, 6999), (6999, 7000), (None, 1)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    sets = {}
    for n, r in got.items():
        sets.setdefault(r, set()).add(n)
    assert sorted(map(len, sets.values())) == [2, 200, 301]
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
