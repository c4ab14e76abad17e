"""Language ID: held-out accuracy, and scores against a plain sum over n-grams."""

import math
import zlib

import numpy as np
from pyspark.sql import functions as F

from snapfeed.llm import langid

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit(docs.where(~langid.held_out(F.col("doc_id"))))
    found = {r.key: r for r in langid.predict(docs, model).collect()}
    out = [r for r in docs.collect() if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(out) > 200
    assert sum(found[r.doc_id].lang_pred == r.lang for r in out) >= 0.98 * len(out)
    assert all(0 <= r.score <= 1 for r in found.values())
    assert langid.keep(docs, model).count() >= 0.99 * len(found)


def test_held_out_rule(spark):
    ids = spark.createDataFrame([(i,) for i in [*range(50), None]], "doc_id long")
    got = {r.doc_id: r.h for r in ids.select("doc_id", langid.held_out(F.col("doc_id")).alias("h")).collect()}
    assert got == {i: zlib.crc32(b"" if i is None else str(i).encode()) % 4 == 2 for i in [*range(50), None]}


def brute(text, model):
    points = [ord(c) for c in f" {text.lower()} "]
    joint = model.log_prior.copy()
    for order in langid.ORDERS:
        for i in range(len(points) - order + 1):
            joint += model.log_prob[:, langid.buckets(np.array(points[i: i + order], np.uint32), order)[0]]
    return joint


def test_scores(monkeypatch, docs):
    rows = [(i, t) for i, t in enumerate(["das ist gut so", "this is good", "ça va très bien", "x", "É", "a b " * 700])]
    train = docs(rows).withColumn("lang", F.element_at(F.array(*map(F.lit, ["de", "en", "fr"])), (F.col("doc_id") % 3 + 1).cast("int")))
    model = langid.fit(train)
    assert model.languages == ["de", "en", "fr"]
    assert np.allclose(np.exp(model.log_prob).sum(axis=1), 1)
    texts = [t for _, t in rows]
    expected = np.array([brute(t, model) for t in texts])
    assert np.allclose(langid.log_scores(texts, model), expected)
    monkeypatch.setattr(langid, "CHARS", 7)  # long texts come in pieces
    assert np.allclose(langid.log_scores(texts, model), expected)


def test_cases(docs):
    rows = [(1, None), (2, ""), (3, "12 %!"), (4, "good text"), (None, "good text"), (4, "good text")]
    model = langid.fit(docs([(9, "good text"), (10, "more text")]))
    found = sorted(((r.key, r.lang_pred, round(r.score, 6)) for r in langid.predict(docs(rows), model).collect()), key=str)
    assert found == sorted([(1, "und", 0.0), (2, "und", 0.0), (3, "und", 0.0), (4, "en", 1.0), (4, "en", 1.0), (None, "en", 1.0)], key=str)
    assert sorted(str(r.doc_id) for r in langid.keep(docs(rows), model).collect()) == ["4", "4", "None"]
    empty = langid.fit(docs([]))
    assert empty.languages == []
    assert {(r.lang_pred, r.score) for r in langid.predict(docs(rows), empty).collect()} == {("und", 0.0)}
    assert langid.keep(docs(rows), empty).count() == 3
    assert langid.predict(docs([]), model).count() == 0


def test_sample_bound(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    small = langid.fit(docs, most_per_language=30)
    assert len(small.languages) == 4
    held = docs.where(langid.held_out(F.col("doc_id")))
    found = {r.key: r.lang_pred for r in langid.predict(held, small).collect()}
    assert sum(found[r.doc_id] == r.lang for r in held.collect()) >= 0.95 * len(found)
    assert math.isclose(np.exp(small.log_prior).sum(), 1)
