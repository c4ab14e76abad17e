"""Filter interaction audit against a loop over documents and orders."""

import itertools
import os
import random
import re
from collections import Counter, defaultdict

import pyarrow as pa

from snapfeed.llm import audit, queries

SF = "/root/testdata/sf0.001"
WORD = re.compile("[^\x20\x09-\x0d]+")


def masks(rows, labels):
    """rows: (doc_id, text, lang); labels: doc_id -> (good, toxic)."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    for i, t, lang in rows:
        t = t or ""
        words = WORD.findall(t)
        fails = {"A": len(words) < 100, "B": 100 * len(set(words)) < 80 * len(words), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t),
                 "D": bool(re.search(r"[#$%&*|]", t)), "E": i is not None and least[t] < i}
        yield lang or "", {f for f, x in fails.items() if x}, *labels.get(i, (False, False))


def brute(rows, labels):
    parts, out = defaultdict(list), {}
    for part, *rest in masks(rows, labels):
        parts[part].append(rest)
    for part, docs in parts.items():
        shapley = Counter()
        for order in itertools.permutations("ABCDE"):
            before = set()
            for step, f in enumerate(order):
                here = [d for d in docs if not d[0] & before]
                gone = [d for d in here if f in d[0]]
                out[part, "".join(order), step + 1] = [len(here) - len(gone), len(gone), sum(f in d[0] for d in docs) - len(gone), sum(d[0] == {f} for d in docs),
                                                       sum(d[1] for d in gone), sum(d[2] for d in gone)]
                shapley[f] += len(gone)
                before.add(f)
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def rows_of(df):
    found = df.collect()
    out = {(r.part, r.filter_order, r.step): (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley) for r in found}
    assert len(out) == len(found)
    return out


def test_query(spark):
    docs = [(r.doc_id, r.text, r.lang) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = {r.doc_id: (r.quality == 1, r.toxic == 1) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    assert rows_of(queries.op12_audit(spark, SF)) == brute(docs, labels)


def test_cases(spark, docs, monkeypatch):
    """Nulls, empty and long texts, ties, repeated rows, extra columns, ranges cut many times."""
    monkeypatch.setattr(audit, "LEAST_RANGE", 40)
    monkeypatch.setattr(audit, "TASK_BYTES", 4000)
    monkeypatch.setattr(audit, "HELD", 700)
    monkeypatch.setattr(audit, "PLAN_ONE_IN", 1)
    rng = random.Random(3)
    head = "shared beginning of very many texts " * 30
    texts = [head + str(i) for i in range(40)] + [head, head[:-1], head[:500], "", "one", "ABC DEF", "a#b", "été 日本", "w " * 200_000]
    rows = [(None, None), (1, None), (2, ""), (2, ""), (None, "one"), (None, "one"), (7, "one"), (6, "one"), (6, "one")]
    rows += [(rng.randrange(60), rng.choice(texts)) for _ in range(400)]
    table = docs(rows).drop("lang").withColumn("lang", queries.F.when(queries.F.col("doc_id") % 3 == 0, "en").when(queries.F.col("doc_id") % 3 == 1, "de"))
    labels = [(i, i % 2, (i // 2) % 2) for i in range(40)] + [(3, 0, 1), (None, 1, 1), (5, None, None)]
    named = defaultdict(lambda: [False, False])
    for i, good, toxic in labels:
        if i is not None:
            named[i][0] |= good == 1
            named[i][1] |= toxic == 1
    counted = audit.masks(table, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    expected = brute([(r.doc_id, r.text, r.lang) for r in table.collect()], {k: tuple(v) for k, v in named.items()})
    assert rows_of(audit.audit(counted)) == expected
    cut, tasks = audit.plan(table)
    assert len(cut) >= 7 and tasks >= 8  # prefixes up to over a thousand bytes
    assert len({audit.range_of(t.encode(), cut) for t in texts[:40]}) > 1
    assert audit.audit(audit.masks(docs([]), named_labels(spark))).count() == 0
    one = rows_of(audit.audit(audit.masks(docs([(1, "x")]), named_labels(spark).limit(0))))
    assert one == brute([(1, "x", "en")], {}) and len(one) == 600


def named_labels(spark):
    return spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")


def test_trie():
    rng = random.Random(5)
    words = {bytes(rng.choice(b"ab\x00\xff") for _ in range(rng.randrange(9))) for _ in range(500)} | {b"", b"a" * 3000, b"a" * 2999 + b"b"}
    trie = audit.Trie()
    for turn in range(2):
        for w in rng.sample(sorted(words), len(words)):
            own = trie.terminal(w)[1]
            own[w] = own.get(w, 0) + 1
    held = list(trie.terminals())
    assert sorted(k for _, t in held for k in t) == sorted(words) and all(list(t.values()) == [2] for _, t in held)
    assert sorted(n for n, _ in held) == list(range(len(words)))
    # compressed: no inner node without a terminal has a single child, labels are not empty, sums give the strings back
    open_ = [(trie.root, b"")]
    while open_:
        (label, children, terminal), before = open_.pop()
        assert (label or not before) and (terminal is None or before + label in terminal[1])
        assert terminal is not None or len(children) > 1
        assert all(child[0][0] == first for first, child in children.items())
        open_ += [(child, before + label) for child in children.values()]


def test_combine_keeps_counts():
    """A text that comes to its trie in several rows counts as in one; ids that may have a label pass through with its number."""
    kinds = [pa.int64(), pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()]

    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=[str(i) for i in range(9)])
    rows = [(0, "en", 1, 5, 2, 9, 1, [5, 8], b"x"), (0, "en", 1, 4, 1, 3, 0, [], b"x"), (0, "de", 1, 4, 2, 2, 0, [4], b"x"), (0, "en", 1, None, 0, 2, 2, [], b"x"),
            (0, "en", 3, 7, 1, 1, 0, [], b"y")]
    for order in itertools.permutations(rows):
        out = [r for b in audit._count(iter([batch(order[:1]), batch(order[1:])])) for r in zip(*(c.to_pylist() for c in b.columns), strict=True)]
        assert {r[:2]: r[2] for r in out if r[2] is not None} == {("en", 1): 1 + 3, ("en", 17): 10, ("de", 1): 2, ("en", 3): 1}
        named = [r for r in out if r[2] is None and r[0] is not None]
        assert sorted((r[0], r[4]) for r in named) == [("de", 4), ("en", 5), ("en", 8)] and len({r[3] for r in named}) == 1
        assert [(r[3], r[4]) for r in out if r[0] is None] == [(named[0][3], 4)]


def test_sql(spark):
    """The stated SQL agrees with the loop, too."""
    import duckdb

    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{os.path.join(SF, t)}.parquet'")
    docs = con.sql("SELECT doc_id, text, lang FROM documents").fetchall()
    labels = {i: (q == 1, x == 1) for i, q, x in con.sql("SELECT doc_id, quality, toxic FROM labels").fetchall()}
    found = {r[:3]: r[3:] for r in con.sql(queries.SQL["op12_audit"]).fetchall()}
    assert found == brute(docs, labels)
