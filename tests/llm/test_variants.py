"""Spelling variants against all pairs of words."""

import re
import zlib
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from snapfeed.llm import queries, variants

SF = "/root/testdata/sf0.001"
RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words_of(rows, least=7, count=2, one_in=31):
    n = Counter()
    for key, text in rows:
        for run in RUN.findall(text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % one_in == 0 else run] += 1
    return {w: m for w, m in n.items() if len(w) >= least and m >= count}


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def pairs(words):
    """All near words of each, over words bucketed by what is left without one letter (plain strings, no reduced alphabet)."""
    index = {}
    for w in words:
        for part in {w, *((w[:i] + w[i + 1:]) for i in range(len(w)))}:
            index.setdefault(part, []).append(w)
    out = {w: set() for w in words}
    for own in index.values():
        for a in own:
            out[a].update(b for b in own if b != a and one_edit(a, b))
    return out


def brute(n, times=10):
    found, forms = {}, {}
    for w, near in pairs(list(n)).items():
        best = min(near, key=lambda x: (-n[x], x), default=None)
        forms[w] = best if best is not None and n[best] >= times * n[w] else None
        found[w] = len(near)
    out = set()
    for w in n:
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.add((w, n[w], found[w], forms[w], n.get(forms[w]), root))
    return out


def rows(df):
    return sorted(((r.word, r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()), key=repr)


def test_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    expected = sorted(brute(words_of(docs)), key=repr)
    assert rows(queries.op13_variants(spark, SF)) == expected
    assert any(r[3] for r in expected) and any(r[2] == 0 for r in expected)


def test_pairs(spark):
    """Runs of equal letters, replaced, inserted and deleted ones at every place, and words that only look alike when reduced."""
    base = ["aaaaaaa", "aaaaaaaa", "abababa", "bababab", "étéétéé", "zzzzzzzé", "kitchen"]
    letters = "abkzéÀÿ"
    words = set(base)
    for w in base:
        for i in range(len(w) + 1):
            words |= {w[:i] + c + w[i:] for c in letters} | {w[:i] + c + w[i + 1:] for c in letters if i < len(w)} | {w[:i] + w[i + 1:]}
    words.add("")
    df = spark.createDataFrame([(w, 1) for w in sorted(words)], "word string, n long")
    expected = pairs(sorted(words))
    for symbols in (1, 2, 8):
        met = Counter((r.word, r.near) for r in variants.near(variants.coded(df, symbols), symbols).collect())
        assert set(met) == {(a, b) for a, own in expected.items() for b in own} and set(met.values()) == {1}


def test_neighbourhood():
    """The hashes of all edits of reduced words, against edits spelled out; each once."""
    words = ["", "a", "aab", "abba", "zzzz", "éaéb"]
    for symbols in (1, 2, 5):
        for word in words:
            codes = variants.reduced([word], symbols)
            plain = tuple(codes[0].tolist())
            edits = {plain} | {plain[:i] + plain[i + 1:] for i in range(len(plain))} | {plain[:i] + (s,) + plain[j:] for i in range(len(plain) + 1)
                     for j in (i, i + 1) if j <= len(plain) for s in range(1, symbols + 1)}
            expected = {int(variants.forms(np.array([e], np.uint32).reshape(1, len(e)))[0]) for e in edits}
            found = np.concatenate([h for _, h in variants.neighbourhood(codes, symbols)]).tolist()
            assert len(found) == len(set(found)) == len(expected) and set(found) == expected


def test_roots(spark):
    """Long rows of forms are followed to their end."""
    n = {"aaaaaaaa" + "b" * i: 10 ** i for i in range(9)} | {"xxxxxxx": 5, "xxxxxxy": 50, "xxxxxyy": 49, "qqqqqqq": 1}
    df = spark.createDataFrame(list(n.items()), "word string, n long")
    assert rows(variants.group(df)) == sorted(brute(n), key=repr)


def test_ties(spark):
    n = {"wordwor": 1, "wordwoé": 10, "wordwoz": 10, "wordwo": 10}
    found = {r[0]: r for r in rows(variants.group(spark.createDataFrame(list(n.items()), "word string, n long")))}
    assert found["wordwor"][2:5] == (3, "wordwo", 10)


def test_cases(docs):
    texts = [(1, None), (2, ""), (None, "Nothing nothing NOTHING"), (3, "ÀÉnothing àénothing x123456789 nothing"), (3, "ÀÉnothing àénothing x123456789 nothing"),
             (4, "longword " * 100_000 + "longwort"), (5, "longwort a-b-c longword")]
    assert {(r.word, r.n) for r in variants.vocabulary(docs(texts)).collect()} == set(words_of(texts).items())
    assert rows(variants.group(variants.vocabulary(docs(texts)))) == sorted(brute(words_of(texts)), key=repr)
    assert variants.group(variants.vocabulary(docs([]))).count() == 0


def test_deleted(docs):
    """Every run in this table loses a letter."""
    texts = [(i, "abcdefghij") for i in range(40)]
    found = variants.vocabulary(docs(texts), one_in=1, least_count=1)
    assert {(r.word, r.n) for r in found.collect()} == set(words_of(texts, count=1, one_in=1).items())
    assert found.where(F.length("word") != 9).count() == 0
