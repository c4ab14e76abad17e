"""Quality rules: counts against plain loops, trees against their definition, held-out labels."""

import re
from collections import Counter

import numpy as np
import pytest

from snapfeed.llm import quality, queries

SF = "/root/testdata/sf0.01"
WORD = re.compile("[^\x20\x09-\x0d]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    windows = Counter(zip(words, words[1:], words[2:], strict=False))
    covered = {i + j for i in range(len(words) - 2) if windows[tuple(words[i: i + 3])] > 1 for j in range(3)}
    seen, dup, lines = set(), 0, 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered), len(text), lines, len(set(words)),
            len(re.findall("[A-Z]", text)), len(re.findall("[0-9]", text)))


TEXTS = [None, "", " \n\t ", "one", "a b c a b c", "a b c d a b c", "x\n\nx\n x\nx", "é ü ß 日本 #*$ % & | <>", "A\x0bB\x0cc 12",
         "a a a a", "same line\nother\nsame line\nsame line", "word " * 300_000, "x" * 2_500_000]


def test_counts():
    for t in TEXTS:
        assert quality.counts((t or "").encode()) == brute(t), (t or "")[:30]


def test_counts_without_products(monkeypatch):
    """Windows of many distinct words are ranked instead of multiplied."""
    rng = np.random.default_rng(1)
    ids = rng.integers(0, 9, 400)
    assert quality.repeated_words(ids, 9) == quality.repeated_words(ids, 3_000_000)


def test_query(spark):
    rows = queries.op11_quality(spark, SF).collect()
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r.doc_id for r in rows) == sorted(docs)
    for r in rows:
        expected = brute(docs[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected[:5]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
        assert not (r.kept and r.base_failed) and (r.base_failed or r.kept == (r.score >= 0.5))


def test_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    forest = quality.fit(docs, labels.where("doc_id % 3 != 0"))
    left = labels.where("doc_id % 3 = 0")
    truth = {r.doc_id: r.quality for r in left.collect()}
    found = quality.judge(docs.join(left.select("doc_id"), "doc_id", "left_semi"), forest).where("not base_failed").collect()
    good, bad = ([r.kept for r in found if truth[r.key] == q] for q in (1, 0))
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1, (np.mean(good), np.mean(bad))


def plain(forest, x):
    out = []
    for row in x:
        total = forest.start
        for at in forest.roots.tolist():
            while forest.left[at] != at:
                at = int((forest.left if row[forest.feature[at]] <= forest.cut[at] else forest.right)[at])
            total += forest.value[at]
        out.append(total)
    return out


def test_trees():
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(size=(3000, 3)), 2)
    y = (x[:, 0] - np.sin(3 * x[:, 1]) + rng.normal(size=3000) * 0.5 > 0).astype(float)
    forest = quality.grow(x, y, [1, 0, -1], trees=40)
    assert np.allclose(forest.margin(x[:300]), plain(forest, x[:300]))
    assert np.mean((forest.score(x) > 0.5) == y) > 0.85
    for f, sign in ((0, 1), (2, -1)):  # monotonic wherever the other features are
        for row in x[:60]:
            line = np.tile(row, (200, 1))
            line[:, f] = np.linspace(-4, 4, 200)
            assert (sign * np.diff(forest.margin(line)) >= -1e-12).all()
    free = quality.grow(x, y, [0, 0, 0], trees=40)
    line = np.tile(x[0], (400, 1))
    line[:, 1] = np.linspace(-2, 2, 400)
    steps = np.diff(free.margin(line))
    assert steps.min() < -1e-6 and steps.max() > 1e-6  # without a direction it goes both ways
    # against the direction of the data a constrained feature alone can't split
    alone = quality.grow(x[:, :1], y, [-1], trees=5)
    assert len(set(alone.margin(x[:, :1]).tolist())) == 1


def test_boosting_step():
    """One split, by hand: the leaf values are Newton steps."""
    x, y = np.array([[0.0]] * 30 + [[1.0]] * 10), np.array([0.0] * 25 + [1.0] * 5 + [1.0] * 10)
    forest = quality.grow(x, y, [0], trees=1, depth=1, rate=1.0)
    p = 1 / (1 + np.exp(-forest.start))
    for value, rows in ((0.0, slice(0, 30)), (1.0, slice(30, 40))):
        n = len(y[rows])
        assert np.isclose(forest.margin(np.array([[value]]))[0] - forest.start, (y[rows].sum() - n * p) / (n * p * (1 - p) + 1))


def test_cases(spark, docs):
    rows = [(1, None), (2, ""), (None, "a b c"), (3, "x " * 10), (3, "x " * 10), (4, "|".join("abc") * 30)]
    labels = spark.createDataFrame([(1, 1), (None, 0), (3, 0), (3, 1), (9, 1), (2, None)], "doc_id long, quality int")
    forest = quality.fit(docs(rows), labels)
    found = quality.judge(docs(rows), forest).collect()
    assert sorted(str(r.key) for r in found) == sorted(str(k) for k, _ in rows) and all(r.base_failed and not r.kept for r in found)
    empty = quality.fit(docs([]), labels)
    assert len(empty.roots) == 0 and empty.score(np.zeros((1, len(quality.FEATURES))))[0] == pytest.approx(0.5)
    assert quality.judge(docs([]), empty).count() == 0
    none = quality.fit(docs(rows), labels.limit(0))
    long = " ".join(f"w{i}" for i in range(60))
    assert [r.kept for r in quality.judge(docs([(1, long)]), none).collect()] == [True]


def test_sample_bound(spark, docs, monkeypatch):
    """A key that many documents have does not pass the bound."""
    taken = []
    grow = quality.grow
    monkeypatch.setattr(quality, "grow", lambda x, y, *a, **b: taken.append(len(y)) or grow(x, y, *a, **b))
    rows = [(1, f"some text {i}") for i in range(50)] + [(i, f"more {i}") for i in range(2, 40)]
    quality.fit(docs(rows), spark.createDataFrame([(i, i % 2) for i in range(1, 40)], "doc_id long, quality int"), most=20)
    assert taken[0] <= 20
