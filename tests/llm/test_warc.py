"""WARC archives: exact round trip and revisit rules."""

import gzip
import hashlib
import os
from base64 import b32encode
from collections import Counter

from snapfeed.llm import queries, warc
from snapfeed.llm.common import fresh_path


def sha(payload):
    return b32encode(hashlib.sha1((payload or "").encode()).digest()).decode()


def expected(rows):
    """Of equal payloads the row with the largest (key, url) is the response, the others refer to it."""
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    best, out = {}, []
    for i, r in enumerate(rows):
        d = sha(r[2])
        if d not in best or order(r) > order(rows[best[d]]):
            best[d] = i
    for i, r in enumerate(rows):
        d = sha(r[2])
        own = best[d] == i
        out.append((r[0], len((r[2] or "").encode()), d, "response" if own else "revisit", None if own else rows[best[d]][0]))
    return Counter(out)


def written(spark, rows):
    path = fresh_path(spark, "test-warc")
    warc.write(warc.records(spark.createDataFrame(rows, "page_id long, url string, html string")), path)
    return path


def test_corpus(spark):
    for sf in ("sf0.01", "sf0.1"):
        rows = [tuple(r) for r in spark.read.parquet(f"/root/testdata/{sf}/pages.parquet").select("page_id", "url", "html").collect()]
        assert Counter(tuple(r) for r in queries.op8_warc(spark, f"/root/testdata/{sf}").collect()) == expected(rows)


def test_cases(spark):
    """Nulls, empty payloads, record ends and headers inside payloads and urls, equal keys, repeated rows, long payloads."""
    trap = "x\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n"
    rows = [(1, "http://a", "same"), (2, "http://b", "same"), (5, None, "same"), (None, "http://c", "same"), (3, "http://d", None), (4, "http://e", ""),
            (6, "http://f\r\nX-Evil: 1", trap), (7, "", trap), (8, "http://é", "é🙂\n" * 50_000), (9, "u", "twice"), (9, "u", "twice"), (9, "v", "twice"), (10, "w", "\r\n\r\n")]
    path = written(spark, rows)
    back = warc.read(spark, path, payloads=True)
    assert Counter(tuple(r) for r in warc.resolve(back).collect()) == expected(rows)
    held = back.where("record_type = 'response'").collect()
    assert Counter(r.payload for r in held) == Counter({p or "" for *_, p in rows})
    assert all(r.digest == r.own_digest == sha(r.payload) for r in held)
    ids = [r.record_id for r in back.collect()]
    assert len(set(ids)) == len(ids) == len(rows)


def test_format(spark):
    path = written(spark, [(1, "http://a/", "one"), (2, "http://b/", "one")])
    heads = {}
    for f in os.listdir(path):
        if f.endswith(".gz"):
            with gzip.open(f"{path}/{f}") as g:
                data = g.read()
            assert data.endswith(b"\r\n\r\n")
            heads |= {h["WARC-Type"]: (h, block) for h, block in warc.parse(data)}
    head, block = heads["response"]
    assert head["WARC-Target-URI"] == "http://b/" and block.startswith(b"HTTP/1.1 200 OK\r\n") and block.endswith(b"\r\n\r\none")
    again, short = heads["revisit"]
    assert again["WARC-Refers-To"] == head["WARC-Record-ID"] and again["WARC-Refers-To-Target-URI"] == "http://b/"
    assert again["WARC-Profile"] == warc.PROFILE and short.endswith(b"\r\n\r\n") and b"one" not in short


def test_empty(spark):
    assert warc.records(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_missing_response(spark):
    """A revisit whose response is not in the archives keeps nulls."""
    path = written(spark, [(1, "a", "one"), (2, "b", "one")])
    found = warc.resolve(warc.read(spark, path).where("record_type = 'revisit'")).collect()
    assert [(r.key, r.bytes, r.refers_to_key) for r in found] == [(1, None, None)]
