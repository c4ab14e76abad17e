"""Merkle fingerprints: round trip, located edits, and the query against a loop."""

import hashlib
import random

import pytest
import xxhash

from snapfeed.llm import merkle

SF = "/root/testdata/sf0.001"


def brute(rows):
    """key -> (n_chars, sha, fingerprint, edited fingerprint, likenesses), for rows in order."""
    out = []
    for i, (k, t) in enumerate(rows):
        nxt = rows[(i + 1) % len(rows)][1]
        q = len(t) // 4
        new = t[: len(t) - q] + nxt[:q]
        a, b, c = merkle.tree(t), merkle.tree(new), merkle.tree(nxt)
        out.append((k, len(t), hashlib.sha256(new.encode()).hexdigest(), merkle.to_text(a), merkle.to_text(b), merkle.likeness(a, b), merkle.likeness(a, c)))
    return out


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def rows_of(df):
    return [(r.key, r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect()]


def test_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = sorted((r.doc_id, r.text) for r in docs.collect())
    found = sorted(rows_of(merkle.compare_with_next(docs)))
    assert found == sorted(brute(rows))
    assert sum(r[5] for r in found) > 0.6 * len(found) > 10 * sum(r[6] for r in found)


@pytest.mark.parametrize("parts", ["1", "8", "40"])
def test_cases(spark, docs, parts):
    """Nulls, empty and very long texts, equal keys, repeated rows, any partitioning."""
    rows = [(None, "null key first"), (1, None), (2, ""), (3, "abc"), (5, "x" * 300_000), (5, "A. B. C. D."), (5, "A. B. C. D."), (9, "é🙂\n\n" * 9), (-4, "before")]
    held = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        found = sorted(rows_of(merkle.compare_with_next(docs(rows))), key=str)
        one = rows_of(merkle.compare_with_next(docs([(7, "only. this. text. here.")])))
        assert merkle.compare_with_next(docs([])).count() == 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", held)
    order = sorted(((k, t or "") for k, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, signed(xxhash.xxh64_intdigest(r[1], 42)) >> 24))
    assert found == sorted(brute(order), key=str)
    assert one == brute([(7, "only. this. text. here.")])


def test_tree():
    rng = random.Random(1)
    lines = [" ".join(rng.choices(["red", "blue.", "green,", "white"], k=9)) + f" {i}" for i in range(200)]
    text = "\n".join(lines)
    fp = merkle.to_text(merkle.tree(text))
    assert merkle.to_text(merkle.from_text(fp)) == fp
    assert merkle.edits(fp, fp) == []
    other = lines[:]
    other[120] = "something. else"
    changed = merkle.to_text(merkle.tree("\n".join(other)))
    (place,) = merkle.edits(fp, changed)
    sections = merkle.from_text(fp)[1]
    assert sum(len(ps) for _, ps in sections[: place[0]]) + place[1] == 120
    inserted = merkle.to_text(merkle.tree("\n".join([*lines[:50], "new line", *lines[50:]])))
    assert merkle.edits(fp, inserted) == []  # all of its own branches are still there
    assert 0.95 < merkle.likeness(merkle.from_text(fp), merkle.from_text(inserted)) < 1
    assert merkle.tree("a\nb")[0] != merkle.tree("a b")[0] != merkle.tree("a\n\nb")[0]
    assert merkle.likeness(merkle.tree(""), merkle.tree("")) == 1 and merkle.likeness(merkle.tree(""), merkle.tree("x")) == 0


def test_fingerprints(docs):
    got = {r.key: r.fingerprint for r in merkle.fingerprints(docs([(1, None), (2, ""), (3, "a"), (4, "a")])).collect()}
    assert got[1] == got[2] != got[3] == got[4]


def test_equal_keys_are_cut(spark, docs, monkeypatch):
    """A key that most rows have, and a text that many of these have: ranges stay even, and each row has its successor once."""
    monkeypatch.setattr(merkle, "PER_TASK", 20)
    rows = [(None, f"text number {i}. more") for i in range(300)] + [(None, "the same. text")] * 300 + [(i, f"own {i}") for i in range(200)]
    table = docs(rows)
    held = merkle.in_order(table, "text", "doc_id")
    sizes = sorted(r["n"] for r in held.where("not last").groupBy(merkle.F.spark_partition_id()).agg(merkle.F.count("*").alias("n")).collect())
    assert sum(sizes) == len(rows) and len(sizes) >= 35 and sizes[-1] <= 2 * sizes[len(sizes) // 2]
    assert held.where("last").count() == len(sizes)
    found = rows_of(merkle.compare_with_next(table))
    assert sorted((r[0] is None, r[0] or 0, r[1]) for r in found) == sorted((k is None, k or 0, len(t)) for k, t in rows)
    same = [r for r in found if r[1] == len("the same. text")]
    assert sum(r[6] == 1.0 for r in same) >= 299
