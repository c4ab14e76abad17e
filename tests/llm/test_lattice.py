"""Sampled segmentations: exact probabilities, distribution, exact round trip."""

import math
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from snapfeed.llm import lattice

PATH = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=PATH)
FLAT = lattice.load(PATH, alpha=0.3)


def segmentations(text, m):
    """All piece sequences of a text and their log-probabilities."""
    s, out = SP.normalize(text), {}
    known = {p: i for i, p in enumerate(m.strings) if not (SP.is_control(i) or SP.is_unknown(i) or SP.is_byte(i))}

    def go(at, ids, weight):
        if at == len(s):
            out[tuple(ids)] = weight
        for end in range(at + 1, min(len(s), at + m.longest) + 1):
            if s[at:end] in known:
                go(end, [*ids, known[s[at:end]]], weight + m.log_weight[known[s[at:end]]])
            elif end == at + 1:
                go(end, [*ids, *(int(m.byte_of[b]) for b in s[at].encode())], weight + m.unknown)

    go(0, [], 0.0)
    total = np.logaddexp.reduce(list(out.values()))
    return {k: v - total for k, v in out.items()}


@pytest.mark.parametrize("text", ["the on", "abc\nab", "😀a b", "an", "a"])
def test_without_replacement(text):
    """Distinct, in order, with exact probabilities; each rank distributed as by Gumbel top-k over the enumeration."""
    every, n, k = segmentations(text, FLAT), 6000, 3
    seeds = np.random.default_rng(5).integers(0, 2**63, n).astype(np.uint64)
    got = lattice.sample([text] * n, seeds, k, FLAT, SP)
    keys = list(every)
    log_p = np.array([every[x] for x in keys])
    perturbed = log_p + np.random.default_rng(6).gumbel(size=(n, len(keys)))
    order = np.argsort(-perturbed, axis=1)
    for rows in got:
        assert len({tuple(r[0]) for r in rows}) == len(rows) == min(k, len(keys))
        assert all(abs(every[tuple(r[0].tolist())] - r[1]) < 1e-9 for r in rows)
        assert [r[2] for r in rows] == sorted((r[2] for r in rows), reverse=True)
        if len(keys) <= k:
            assert all(r[3] == 0 for r in rows)
    for rank in range(min(k, len(keys))):
        mine = Counter(tuple(rows[rank][0].tolist()) for rows in got)
        other = Counter(order[:, rank].tolist())
        distance = sum(abs(mine[x] - other[i]) for i, x in enumerate(keys)) / 2 / n
        assert distance < 0.03
        assert abs(np.mean([rows[rank][2] for rows in got]) - np.mean(-np.sort(-perturbed, axis=1)[:, rank])) < 0.08


def test_inclusion_is_unbiased():
    """Sums of p / inclusion over the sample estimate sums over all segmentations: here of p itself, which is 1."""
    n = 8000
    got = lattice.sample(["the on"] * n, np.arange(n).astype(np.uint64) * np.uint64(7919), 4, FLAT, SP)
    estimates = [sum(math.exp(r[1] - r[3]) for r in rows) for rows in got]
    assert abs(np.mean(estimates) - 1) < 0.02


def test_corpus_round_trip(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = lattice.decode(lattice.encode(docs, PATH, k=2), PATH).collect()
    assert Counter(r.key for r in rows) == {d: 2 for d in texts}
    assert all(r.decoded == texts[r.key] for r in rows)
    assert len({(r.key, tuple(r.ids)) for r in rows}) == len(rows)
    again = lattice.encode(docs.repartition(5), PATH, k=2).collect()
    assert {(r.key, r["sample"], tuple(r.ids), r.value) for r in again} == {(r.key, r["sample"], tuple(r.ids), r.value) for r in rows}
    other = lattice.encode(docs, PATH, k=2, seed=1).collect()
    assert sum(tuple(a.ids) != tuple(b.ids) for a, b in zip(sorted(rows, key=lambda r: (r.key, r["sample"])), sorted(other, key=lambda r: (r.key, r["sample"])), strict=True)) > 300


def test_cases(docs):
    """Nulls, empties, blanks, line ends, unknown characters, a very long word, null and repeated keys."""
    rows = [(1, None), (2, ""), (3, " "), (4, "\n\n \t x"), (5, "日本\U0001f9ff語\x00"), (6, "ab" * 4000), (None, "null key"), (7, "twice"), (7, "twice"), (8, "a")]
    got = lattice.decode(lattice.encode(docs(rows), PATH, k=3), PATH).collect()
    texts = {k: t or "" for k, t in rows}
    assert all(r.decoded == texts[r.key] for r in got)
    n = Counter(r.key for r in got)
    assert n[1] == n[2] == 1 and n[6] == n[None] == 3 and n[7] == 6 and n[8] == 2
    assert [(list(r.ids), r.log_p, r.log_inclusion) for r in got if r.key in (1, 2)] == [([], 0.0, 0.0)] * 2
    assert lattice.encode(docs([]), PATH).count() == 0
    assert lattice.decode(docs([(1, "x")]).selectExpr("cast(null as array<int>) ids"), PATH).first().decoded is None


def test_verify(docs):
    """The round trip fails only where decoding takes something away."""
    got = lattice.encode(docs([(1, None), (2, ""), (3, "plain text"), (4, " a  b ")]), PATH, verify=True).collect()
    assert all(r.round_trip for r in got) and {r.key for r in got} == {1, 2, 3, 4}


def test_sharp_weights_give_the_best_path():
    """With a very large alpha the first sample is the segmentation of the highest weight."""
    m = lattice.load(PATH, alpha=200.0)
    for text in ("the on", "hello world", "abcab"):
        every = segmentations(text, m)
        ((first, *_),) = lattice.sample([text], np.array([3], np.uint64), 1, m, SP)
        assert tuple(first[0].tolist()) == max(every, key=every.get)


def test_words_share_the_places_of_their_ends():
    """Work follows the distinct ends of words, not their characters; a long word's beginning has places of its own."""
    words = ["▁" + a + "ationally" for a in ("n", "st", "r", "not", "educ")] + ["日" * 100 + "ationally", "日" * 90 + "語"]
    points, size = lattice.code_points("".join(words)), np.array(list(map(len, words)))
    lat = lattice.build(points, size, FLAT)
    shared = {w[i:] for w in words for i in range(max(0, len(w) - lattice.SHARED), len(w))}
    assert len(lat.at) - 1 == len(shared) + sum(max(0, len(w) - lattice.SHARED) for w in words)
    for w, place in zip(words, lat.start.tolist(), strict=True):
        for c in w:  # the first edge of a place is its single character
            piece = int(lat.piece[lat.at[place]])
            assert piece == -1 - ord(c) or piece >= 0 and FLAT.strings[piece] == c
            place = int(lat.then[lat.at[place]])
        assert place == 0


def test_samples_do_not_depend_on_other_rows():
    """All of a row's results, the inclusion probability too, whether it stands alone or among many."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["national", "station", "the", "only", "thereof", "日本", "x" * 70, "unable"], 12)) for _ in range(300)]
    seeds = rng.integers(0, 2**63, 300).astype(np.uint64)
    m = lattice.load(PATH)
    together = lattice.sample(texts, seeds, 2, m, SP)
    for i in range(300):
        (alone,) = lattice.sample(texts[i: i + 1], seeds[i: i + 1], 2, m, SP)
        assert [(r[0].tolist(), *r[1:]) for r in alone] == [(r[0].tolist(), *r[1:]) for r in together[i]]


def test_spell_is_the_library_s_decoding():
    rng = np.random.default_rng(9)
    texts = ["", " ", "  a", "   ", " a", "a", "\n a", "▁", "日本 x", "\x00", *("".join(rng.choice(list("ab \n▁é日\t.<>"), n)) for n in rng.integers(0, 30, 500))]
    rows = [SP.encode(t) for t in texts] + [rng.integers(0, SP.get_piece_size(), n).tolist() for n in rng.integers(0, 9, 500)]
    rows += [SP.encode("plain words")] * 3
    for some in (rows, rows[-3:], [[]], []):
        got = lattice.spell(np.array([i for r in some for i in r], np.int32), np.array([len(r) for r in some], np.int64), FLAT, SP)
        assert got.to_pylist() == [SP.decode(r, num_threads=1) if r else "" for r in some]
