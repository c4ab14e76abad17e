"""The pipeline's stages, each against brute force on what its predecessor kept."""

import random

import corpus_pipeline as pipeline
from snapfeed.llm import langid, queries
from snapfeed.llm.common import fresh_path

from . import test_decontaminate, test_lines, test_simhash
from .test_lattice import SP

SF = "/root/testdata/sf0.001"


def written(spark, df):
    path = fresh_path(spark, "test-stage")
    df.write.parquet(path)
    return spark.read.parquet(path)


def texts(df):
    return {r.doc_id: r.text for r in df.collect()}


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    start = docs.schema
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = []
    for (_, stage) in pipeline.STAGES[:-1]:
        docs = written(spark, stage(spark, docs, SF))
        assert [(f.name, f.dataType) for f in docs.schema] == [(f.name, f.dataType) for f in start]
        kept.append(texts(docs))
    before = texts(spark.read.parquet(f"{SF}/documents.parquet"))
    one, two, three, four = kept
    assert one == {d: t for d, t in before.items() if langid.has_letter(t)}
    lines = test_lines.brute(sorted(one.items()))
    assert two == {d: t for d, t in lines.items() if t.strip() or not one[d].strip()}
    assert three == {d: two[d] for d, _, c in test_simhash.groups(sorted(two.items())) if d == c}
    low = lambda t: " ".join(t.lower().split())
    gone = sorted(three.keys() - four.keys())
    assert {d for d, t in three.items() if any(low(i) in low(t) for _, i in items)} <= set(gone) and gone
    assert {d for d, _ in test_decontaminate.brute([(d, three[d]) for d in gone], items)} == set(gone)
    assert four == {d: t for d, t in three.items() if d not in gone}
    rows = pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {(r.doc_id, r["sample"]) for r in rows} == {(d, i) for d in four for i in (1, 2)}
    assert all(r.round_trip and SP.decode(list(r.ids)) == four[r.doc_id] for r in rows)


def test_decontaminate_keeps_no_passage(spark, docs):
    """Planted passages, edited at either end, cut at the text's ends or whole, among other words: brute force over all passages finds
    none in what the stage keeps, and nothing clean is gone."""
    rng = random.Random(3)
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    words = [w for r in spark.read.parquet(f"{SF}/documents.parquet").limit(40).collect() for w in r.text.split()[:200]]
    rows = [(i, " ".join(rng.choices(words, k=60))) for i in range(40)]
    for _, t in items:
        w = t.split()
        for edit in (lambda w: w, lambda w: ["other", *w[1:]], lambda w: [*w[:-1], "other"], lambda w: ["other", *w[1:-1], "word"], lambda w: w[:len(w) // 2] + ["other"] + w[len(w) // 2 + 1:]):
            rows.append((len(rows), " ".join(rng.choices(words, k=rng.randrange(1, 20)) + edit(w) + rng.choices(words, k=rng.randrange(1, 20)))))
        rows.append((len(rows), " ".join(w[len(w) // 8:])))
    kept = {r.doc_id for r in pipeline.decontaminate(spark, docs(rows), SF).collect()}
    dirty = {d for d, _ in test_decontaminate.brute(rows, items)}
    assert kept.isdisjoint(dirty) and set(range(40)) <= kept and len(dirty) >= 3 * len(items)


def test_run(spark, docs, tmp_path):
    """All stages in a row, over nulls, empty texts, equal and null ids and extra columns."""
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(1, None), (2, ""), (3, "12 34"), (None, "some words here and there"), (4, "other words again and again"), (4, "other words again and again"),
            (5, "one line\n\nlast line"), (6, "first line\none line"), (7, f"before {item} after"), (8, "first line")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = {(r.doc_id, SP.decode(list(r.ids))) for r in pipeline.run(spark, str(tmp_path)).collect() if r.round_trip}
    assert found == {(None, "some words here and there"), (4, "other words again and again"), (5, "one line\n\nlast line"), (6, "first line")}


def test_empty(spark, docs):
    for _, stage in (pipeline.STAGES[0], pipeline.STAGES[3], pipeline.STAGES[4]):
        assert stage(spark, docs([]), SF).count() == 0


def test_names():
    assert [n for n, _ in pipeline.STAGES] == ["language", "line_dedup", "near_dedup", "decontaminate", "tokenise"]


def test_registered():
    import __spark_entry__ as entry

    names = list(entry.queries())
    assert "pipeline" in names
    assert [n for n in range(1, 14) if any(x.startswith(f"op{n}_") for x in names)] == list(range(1, 14))
    assert set(entry.oracle_sql()) <= set(names)


def test_rows_not_ids(spark, docs):
    """Null and repeated ids: each row is judged for itself."""
    item = "one two three four five six seven eight nine ten eleven twelve"
    rows = [(None, f"x {item} y"), (None, "nothing of the kind"), (4, f"{item} z"), (4, "clean words only")]
    benchmark = spark.createDataFrame([(1, item)], "item_id long, text string")
    assert {r.text for r in pipeline.decontamination.keep(docs(rows), benchmark).collect()} == {"nothing of the kind", "clean words only"}

    same = "alpha beta gamma delta epsilon zeta eta theta iota kappa"
    other = "some quite different words stand in this text and nowhere else"
    rows = [(None, same), (2, same), (2, same), (3, same), (None, other), (3, "unique words whose id a dropped copy has as well")]
    left = sorted((str(r.doc_id), r.text) for r in pipeline.near_dedup(spark, docs(rows), SF).collect())
    assert left == sorted([("2", same), ("None", other), ("3", rows[-1][1])])
    twice = [(None, "a line\nmore"), (None, "a line\nmore"), (5, "own line"), (5, "own line"), (6, "a line\nnew")]
    left = sorted((str(r.doc_id), r.text) for r in pipeline.line_dedup(spark, docs(twice), SF).collect())
    assert left == [("5", "own line"), ("6", "new"), ("None", "a line\nmore")]


def test_decoded(spark, docs):
    """The last stage and op10 return the decoded texts, and every round trip holds."""
    before = texts(spark.read.parquet(f"{SF}/documents.parquet"))
    for rows in (queries.op10_sentencepiece(spark, SF).collect(), pipeline.tokenise(spark, spark.read.parquet(f"{SF}/documents.parquet"), SF).collect()):
        assert {r.doc_id for r in rows} == set(before)
        assert all(r.round_trip and r.decoded == (before[r.doc_id] or "") for r in rows)
    odd = [(1, None), (2, ""), (3, "é🙂 \n x"), (4, "long words " * 200_000)]
    rows = pipeline.tokenise(spark, docs(odd), SF).collect()
    assert {r.doc_id for r in rows} == {1, 2, 3, 4} and all(r.decoded == (dict(odd)[r.doc_id] or "") for r in rows)
