"""Decontamination against brute force over all windows."""

import random

import numpy as np
import pytest

from snapfeed.llm import decontaminate

SF = "/root/testdata/sf0.01"


def words_of(text):
    return decontaminate.hash_words([text])[0]


def brute(docs, items, least=0.8):
    """(doc, item) pairs with a passage of the item's length (cut at the ends) that is similar enough."""
    index = decontaminate.build_index(items)
    out = set()
    for d, t in docs:
        w = words_of(t)
        for i, own in zip(index.ids, index.words, strict=True):
            if len(w) >= 1 and any(decontaminate.similarity(own, w[p: p + len(own)], index.weights) >= least for p in range(max(1, len(w) - len(own) + 1))):
                out.add((d, i))
    return out


def found(df):
    return {(r.key, r.item) for r in df.collect()}


def test_corpus(spark):
    docs, items = (spark.read.parquet(f"{SF}/{x}.parquet") for x in ("documents", "benchmark"))
    low = lambda t: " ".join(t.lower().split())
    verbatim = {(d.doc_id, i.item_id) for d in docs.collect() for i in items.collect() if low(i.text) in low(d.text)}
    got = found(decontaminate.matches(docs, items))
    assert len(verbatim) > 5 and verbatim <= got
    # what else is found is similar enough by the definition
    texts, index = {r.doc_id: r.text for r in docs.collect()}, [(r.item_id, r.text) for r in items.collect()]
    extra = got - verbatim
    assert {(d, i) for d, i in extra} <= brute([(d, texts[d]) for d, _ in extra], index)
    judged = {r.key: r.contaminated for r in decontaminate.judge(docs, items).collect()}
    assert judged == {d: any(d == x for x, _ in got) for d in texts}
    assert {r.doc_id for r in decontaminate.keep(docs, items).collect()} == {d for d, x in judged.items() if not x}


def test_edited_passages(spark, docs):
    """Passages with a changed word, other case and punctuation, at any place of a text: found as by brute force,
    up to the few that are farther than the radius."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(300)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate(list(range(1, 60, 3)) + [230, 400])]
    rows = []
    for i, t in items:
        for _ in range(5):
            w = t.split()
            w[rng.choice([0, -1, rng.randrange(len(w))])] = rng.choice(vocabulary)
            rows.append((len(rows), " ".join(rng.choices(vocabulary, k=rng.randrange(40)) + w + rng.choices(vocabulary, k=rng.randrange(40)))))
        rows.append((len(rows), "Xx " + t.upper().replace(" ", ", ") + "!"))
    table = spark.createDataFrame(items, "item_id long, text string")
    expected, got = brute(rows, items), found(decontaminate.matches(docs(rows), table))
    assert got <= expected | {(d, i) for d, i in got if len(items[i][1].split()) < 5}
    assert len(got & expected) >= 0.97 * len(expected)
    assert all((6 * n + 5, i) in got for n, (i, _) in enumerate(items))


def edited_rows(rng, vocabulary, items, edits, copies):
    """Documents with one edited passage each, among other words: words at the given places changed, and at times one left out."""
    rows = []
    for edited in edits:
        for _, t in items:
            for _ in range(copies):
                w = t.split()
                for j in edited:
                    w[j % len(w)] = rng.choice(vocabulary)
                if rng.random() < 0.2:
                    del w[rng.randrange(len(w))]
                rows.append((len(rows), " ".join(rng.choices(vocabulary, k=rng.randrange(1, 40)) + w + rng.choices(vocabulary, k=rng.randrange(1, 40)))))
    return rows


def test_recall_of_fingerprints():
    """Edits at either end, inside, and left-out words: of what brute force over all passages finds, the windows find nearly all."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(2000)]
    items = [(i, " ".join(rng.choices(vocabulary, k=n))) for i, n in enumerate([3, 9, 16, 22, 22, 30, 39, 50, 59, 100])]
    items += [(i + 100, " ".join(t.split()[:-2] + rng.choices(vocabulary, k=2))) for i, t in items[4:]]  # share shingles
    rows = edited_rows(rng, vocabulary, items, ([], [0], [-1], [0, 1], [0, -1], [-2, -1], [5], [25], [0, 1, -1]), 2)
    index = decontaminate.build_index(items)
    got = {(d, index.ids[i]) for d, i, *_ in decontaminate.find([t for _, t in rows], index, 0.8)}
    expected = brute(rows, items)
    # beyond brute force's whole-length passages there may be passages cut at a text's end
    assert len(expected) > 100 and len(got & expected) >= 0.97 * len(expected) and len(got - expected) < 10, (len(got), len(expected))
    # cut at the text's ends: four fifths of an item are there
    cut = [(d, " ".join(t.split()[len(t.split()) // 6:] if d % 2 else t.split()[:-(len(t.split()) // 6)])) for d, t in items if len(t.split()) > 12]
    expected = brute(cut, items)
    got = {(cut[d][0], index.ids[i]) for d, i, *_ in decontaminate.find([t for _, t in cut], index, 0.8)}
    assert expected and got <= expected and len(got) >= 0.95 * len(expected)


def test_radius_guarantee():
    """Every pair within the radius meets."""
    rng = np.random.default_rng(2)
    for radius in (0, 3, 7, 10):
        items = [(i, " ".join(f"w{x}" for x in rng.integers(0, 10**6, 8))) for i in range(40)]
        index = decontaminate.build_index(items, radius)
        (size, (item, _, blocks)), = index.classes.items()
        assert size == 8
        own = {int(i): next(decontaminate.windows(index.words[i], [8]))[2][0] for i in item}
        fps, expected = [], set()
        for i, fp in own.items():
            for d in range(radius + 3):
                x = fp
                for b in rng.choice(64, d, replace=False):
                    x = x ^ (np.uint64(1) << np.uint64(b))
                expected |= {(len(fps), j) for j, other in own.items() if int(x ^ other).bit_count() <= radius}
                fps.append(x)
        place, entry = decontaminate._meetings(np.array(fps), blocks, radius)
        assert {(int(p), int(item[e])) for p, e in zip(place, entry, strict=True)} == expected
        assert len(place) == len(set(zip(place.tolist(), entry.tolist(), strict=True)))


@pytest.mark.parametrize("step, piece", [(16, 64), (8192, 1 << 21)])
def test_steps_and_pieces(monkeypatch, step, piece):
    """Windows and hashes do not depend on how the words are taken up."""
    text = " ".join(f"w{i * 7 % 1013}" for i in range(3000))
    plain = decontaminate.hash_words([text, None, "", text])
    monkeypatch.setattr(decontaminate, "STEP", step)
    monkeypatch.setattr(decontaminate, "PIECE", piece)
    h, ends = decontaminate.hash_words([text, None, "", text])
    assert (h == plain[0]).all() and ends.tolist() == [3000, 3000, 3000, 6000]
    bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).astype(int)
    fps = np.concatenate([f for w, _, f in decontaminate.windows(h, [37, 130]) if w == 37])
    slow = [np.packbits(bits[i: i + 37].sum(axis=0) * 2 > 37).view(np.uint64)[0] for i in range(0, 5900, 97)]
    assert (fps[:5900:97] == slow).all()
    items = [(1, " ".join(text.split()[100:150])), (2, "not there at all in this text so no match comes")]
    hits = decontaminate.find([text, None, "zz " + text], decontaminate.build_index(items), 0.8)
    assert sorted((t, i, w) for t, i, _, w in hits) == [(0, 0, 100), (2, 0, 101)] or sorted((t, i) for t, i, *_ in hits) == [(0, 1), (2, 1)]


def test_cases(spark, docs):
    item = "the quick brown fox jumps over the lazy dog and runs away from here now"
    rows = [(1, None), (2, ""), (3, "clean text"), (4, f"a {item} b"), (None, f"{item}"), (None, "null key, clean"), (5, f"{item} " * 2), (4, "clean row of a dirty key")]
    items = spark.createDataFrame([(7, item), (7, item), (8, None), (9, ""), (None, "one two three four five six seven eight nine"), (10, "!!")], "item_id long, text string")
    assert found(decontaminate.matches(docs(rows), items)) == {(4, 7), (None, 7), (5, 7)}
    kept = sorted(r.text or "" for r in decontaminate.keep(docs(rows), items).collect())  # each row for itself, whatever its key
    assert kept == ["", "", "clean row of a dirty key", "clean text", "null key, clean"]
    judged = sorted(((r.key, r.contaminated, r.items) for r in decontaminate.judge(docs(rows), items).collect()), key=str)
    assert judged == sorted([(1, False, ""), (2, False, ""), (3, False, ""), (4, True, "7"), (4, True, "7"), (None, True, "7"), (None, True, "7"), (5, True, "7")], key=str)
    assert decontaminate.matches(docs([]), items).count() == 0
    assert decontaminate.matches(docs(rows), items.limit(0)).count() == 0


def test_passes(monkeypatch, spark, docs):
    """More items than one pass holds: near-variant items fall into different passes, and the results are those of one pass."""
    rng = random.Random(5)
    vocabulary = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 8))) for _ in range(2000)]
    items = [(i, " ".join(f"w{i}x{j}" for j in range(12))) for i in range(8)]
    for i in range(8, 24, 2):
        half = rng.choices(vocabulary, k=15)  # the halves that two items share weigh half
        items += [(i, " ".join(half + rng.choices(vocabulary, k=15))), (i + 1, " ".join(half + rng.choices(vocabulary, k=15)))]
    rows = [(i, f"pre {t} post") for i, t in items] + [(100 + i, " ".join(t.split()[:25])) for i, t in items] + [(200 + i, " ".join(t.split()[5:])) for i, t in items]
    table = spark.createDataFrame(items, "item_id long, text string")
    one = sorted((r.key, r.item, round(r.similarity, 9), r.first_word) for r in decontaminate.matches(docs(rows), table).collect())
    assert {(i, i) for i, _ in items} <= {(d, i) for d, i, *_ in one} and any(d >= 100 for d, *_ in one) and len(one) < 2.5 * len(items)
    left = sorted(r.doc_id for r in decontaminate.keep(docs(rows), table).collect())
    monkeypatch.setattr(decontaminate, "BLOCK_ITEMS", 9)
    many = sorted((r.key, r.item, round(r.similarity, 9), r.first_word) for r in decontaminate.matches(docs(rows), table).collect())
    assert many == one
    assert sorted(r.doc_id for r in decontaminate.keep(docs(rows), table).collect()) == left == sorted({d for d, _ in rows} - {d for d, *_ in one})
