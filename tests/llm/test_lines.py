"""Fuzzy line deduplication against brute force."""

import random

import numpy as np
from pyspark.sql import functions as F

from snapfeed.llm import common, lines

SF = "/root/testdata/sf0.001"


def shingles(line):
    x = lines.normal(line)
    return {x[i: i + 7] for i in range(len(x) - 6)} if len(x) >= 7 else {x}


def brute(rows, least=0.8):
    """doc_id -> new text, for unique ids."""
    own = [(d, i, x) for d, t in sorted(rows) if t is not None for i, x in enumerate(t.split("\n")) if x.strip()]
    sets = [shingles(x) for *_, x in own]
    root = list(range(len(own)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    by = {}
    for i, s in enumerate(sets):
        near = {j for x in s for j in by.get(x, ())}
        for j in near:
            if len(s & sets[j]) >= least * len(s | sets[j]) - 1e-9:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
        for x in s:
            by.setdefault(x, []).append(i)
    stay = {own[i][:2] for i in range(len(own)) if find(i) == i}
    out = {}
    for d, t in rows:
        if t is None:
            out[d] = None
            continue
        parts = t.split("\n")
        full = [i for i, x in enumerate(parts) if x.strip()]
        kept = [i for i in full if (d, i) in stay]
        out[d] = t if len(kept) == len(full) else "\n".join(parts[i] for i in kept)
    return out


def test_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    expected = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    found = {r.doc_id: r.text for r in lines.dedup(docs).collect()}
    assert found == expected


def test_edits(spark, docs):
    """Near copies of long lines, also chains of them, across many documents."""
    rng = random.Random(3)
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(3, 9))) for _ in range(400)]
    rows = []
    for g in range(30):
        line = rng.choices(words, k=40)
        for c in range(6):
            rows.append((len(rows), "own " + " ".join(rng.choices(words, k=12)) + "\n" + " ".join(line)))
            line = line[:]
            line[rng.randrange(40)] = rng.choice(words)
    expected = brute(rows)
    assert {r.doc_id: r.text for r in lines.dedup(docs(rows)).collect()} == expected
    assert sum(t.count("\n") == 0 for t in expected.values()) > 100


def test_cases(docs):
    """Nulls, blanks, short lines, repeats inside a document, equal keys, a null key, clashing columns."""
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "a\n\nb\na"), (5, "A \nc"), (None, "c\nd"), (6, "e\n\nf"), (6, "e\n\nf"), (7, "\ne"), (8, "d")]
    got = lines.dedup(docs(rows), counts=("n", "k"))
    assert got.columns[:8] == docs(rows).columns
    found = sorted(((r.doc_id, r.text, r.n, r.k) for r in got.collect()), key=str)
    assert found == sorted([(1, None, 0, 0), (2, "", 0, 0), (3, " \n\t", 0, 0), (4, "a\nb", 3, 2), (5, "", 2, 0), (None, "c\nd", 2, 2),
                            (6, "e\n\nf", 2, 2), (6, "", 2, 0), (7, "", 1, 0), (8, "", 1, 0)], key=str)
    assert lines.dedup(docs([])).count() == 0


def test_blocks(monkeypatch, docs):
    """Overfull bands split into blocks give the same result."""
    rng = random.Random(5)
    base = [f"word{rng.randrange(1000)}" for _ in range(60)]
    rows = []
    for i in range(400):
        own = base[:]
        own[rng.randrange(60)] = f"other{i}"
        rows.append((i, " ".join(own)))
    expected = brute(rows)
    monkeypatch.setattr(lines, "BLOCK", 64)
    assert {r.doc_id: r.text for r in lines.dedup(docs(rows)).collect()} == expected


def test_very_long_line(docs):
    text = "x" * 400_000 + " " + " ".join(str(i) for i in range(30_000))
    found = {r.doc_id: r.text for r in lines.dedup(docs([(1, text), (2, text + "!")])).collect()}
    assert found == {1: text, 2: ""}


def test_recall():
    """The bands meet in over 0.99 of pairs at the threshold."""
    rng = random.Random(1)
    met = n = 0
    while n < 500:
        words = ["".join(rng.choices("abcdefghijklmnop", k=6)) for _ in range(60)]
        other = words[:]
        for i in rng.sample(range(60), 3):
            other[i] = "".join(rng.choices("abcdefghijklmnop", k=6))
        a, b = " ".join(words), " ".join(other)
        j = len(shingles(a) & shingles(b)) / len(shingles(a) | shingles(b))
        if 0.8 <= j <= 0.84:
            k = lines.band_keys([a, b])
            met += bool((k[0] == k[1]).any())
            n += 1
    assert met >= 0.985 * n


def test_counts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = lines.dedup(docs, counts=("n", "k"))
    assert got.where("k > n").count() == 0 and got.where(F.col("k") < F.col("n")).count() > 10


def test_rows_moved(spark, docs):
    """Band keys are shuffled packed, not in a row each; at the end the lines are read once and texts are not sorted."""
    plan = lambda df: df._jdf.queryExecution().optimizedPlan().toString()
    bands = spark.createDataFrame([(i, lines.band_keys([chr(97 + i // 2) * 7])[0].tobytes()) for i in range(40)], "id long, bands binary")
    runs = lines._runs(bands)
    assert "keys#" in plan(runs) and "RepartitionByExpression [key#" not in plan(runs)
    found = {}
    for r in runs.collect():
        found.setdefault(r.run, set()).add(r.id)
    assert sorted(map(sorted, found.values())) == [[2 * i, 2 * i + 1] for i in range(20)]
    got = lines.dedup(docs([(1, "one line\nanother"), (2, "one line\nthird")]), counts=("n", "k"))
    assert sum("LogicalRDD" in x and "bands#" in x for x in plan(got).split("\n")) == 1
    assert "strategy=shuffle_hash" in plan(got)


def test_dealt_in_parts(monkeypatch, docs):
    """Band keys of a task that are dealt at several times meet all the same."""
    rng = random.Random(7)
    rows = [(i, "\n".join(" ".join(f"w{rng.randrange(30)}" for _ in range(12)) for _ in range(20))) for i in range(30)]
    rows += [(100 + i, t + " end") for i, t in rows]
    expected = brute(rows)
    monkeypatch.setattr(lines, "DEALT", 50)
    assert {r.doc_id: r.text for r in lines.dedup(docs(rows)).collect()} == expected


def test_hash_longs(spark):
    """Places hash alike in Spark and in tasks."""
    rows = [(0, 0), (1, -1), (-(2**63), 2**63 - 1), (123456789012345, 7)]
    a, b = (np.array(c, np.int64) for c in zip(*rows, strict=True))
    of = spark.createDataFrame(rows, "a long, b long").select(F.xxhash64("a", "b"), F.xxhash64("a")).collect()
    assert common.hash_longs(a, b).view(np.int64).tolist() == [r[0] for r in of]
    assert common.hash_longs(a).view(np.int64).tolist() == [r[1] for r in of]
