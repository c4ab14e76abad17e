"""Personal data: patterns against plain regular expressions, disclosure against a loop."""

import hashlib
import math
import random
import re
from collections import defaultdict

from hypothesis import given, settings
from hypothesis import strategies as st

from snapfeed.llm import pii, queries

PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
            "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(digits):
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {"email": True, "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                    "card": 13 <= len(digits) <= 19 and luhn(digits or "0"), "phone": 9 <= len(digits) <= 15}[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_corpus(spark):
    sf = "/root/testdata/sf0.01"
    found = {r.doc_id: r for r in queries.op4_pii(spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    for d in docs:
        spans, r = plain(d.text), found[d.doc_id]
        joined = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in spans) for k in PATTERNS]
        assert r.base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
        assert r.spans.startswith(joined) and all(x.startswith("term:") for x in r.spans[len(joined):].strip(",").split(",") if x)
    assert len(found) == len(docs) and sum(r.n_email + r.n_phone for r in found.values()) > 20


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.sampled_from(["@", ".", "a", "b.c", "1", "255", "256", "+", " ", "-", "(", ")", "é", "a@b.c", "4111 1111 1111 1111", "+1 (555) 555-1234", "1.2.3.4", "\n", "_", "%"])), max_size=40))
def test_any_text(parts):
    text = "".join(parts)
    assert pii.detect(text) == plain(text)


def test_long_runs():
    """Linear in the text: long runs of what may begin a match."""
    for text in ("1" * 200_000, "1." * 100_000, "a" * 200_000 + "@", "a@" * 100_000, "+1" + "(" * 200_000, "1 " * 100_000, "a@" + "b-" * 100_000):
        assert isinstance(pii.detect(text), list)


def disclosed(rows, threshold=0.8, least=3, z=1.645):
    """row number -> term spans, by counting over the distinct texts."""
    texts = sorted({t or "" for _, t in rows})
    entities, words_of, free = defaultdict(set), defaultdict(set), {}
    for t in texts:
        spans = plain(t)
        for kind, s, e in spans:
            entities[kind, t[s:e].lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", t[s:e])].add(t)
        words = [(m.start(), m.end(), m.group().lower()) for m in re.finditer("[0-9A-Za-z_\x80-\U0010ffff]+", t)]
        for *_, w in words:
            words_of[w].add(t)
        free[t] = [w for w in words if not any(w[0] < e and s < w[1] for _, s, e in spans)]
    telling = set()
    for at in entities.values():
        content = -math.log2(len(at) / len(texts))
        for w in {w for t in at for *_, w in free[t]}:
            both, n = sum(any(x == w for *_, x in free[t]) for t in at), len(words_of[w])
            p = both / n
            low = (p + z * z / (2 * n) - z * math.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
            if content > 0 and both >= least and (math.log2(low) + content) / content > threshold:
                telling.add(w)
    return {i: [(a, b) for a, b, w in free[t or ""] if w in telling] for i, (_, t) in enumerate(rows)}, telling


def corpus():
    rng = random.Random(8)
    common = ["the", "a", "of", "and", "to", "in", "word", "other", "more"]
    rows = [(i, " ".join(rng.choices(common, k=20))) for i in range(600)]
    for i in range(0, 120, 10):
        rows[i] = (i, f"Mallory {rows[i][1]} 4711 mallory@example.org x@y.zz" if i else f"Mallory {rows[i][1]} mallory@example.org")
    for i in range(5, 25, 10):  # too few texts with it
        rows[i] = (i, f"seldom {rows[i][1]} seldom@example.org")
    rows[7] = (None, "here MALLORY alone, no address")
    same = f"uncommon words of a copied text {rows[9][1]} copied@example.org"
    return rows + [(1000 + i, same) for i in range(30)] + [(300, None), (301, ""), (302, "card 4111 1111 1111 1111 zebra"), (None, "zebra and 4111111111111111"), (303, "one@two.three single")]


def marked(df):
    return sorted((str(r.key), [(x.start, x.end) for x in r.terms]) for r in df.collect())


def test_disclosure(docs):
    """Terms far from the entity count, and are marked in every document; copies are no evidence; by a loop."""
    rows = corpus()
    expected, telling = disclosed(rows)
    assert {"mallory", "4711"} <= telling and not telling & {"the", "a", "of", "seldom", "uncommon", "copied", "zebra"}
    assert marked(pii.find(docs(rows))) == sorted((str(k), expected[i]) for i, (k, _) in enumerate(rows))
    clean = {(r.doc_id, r.text) for r in pii.sanitise(docs(rows)).collect()}
    text = dict(clean)
    assert len(clean) == len({(k, t) for k, t in rows}) and "allory" not in text[10] and "[EMAIL]" in text[10] and "####" in text[10]
    assert (None, "here  alone, no address") in clean and (None, "zebra and [CARD]") in clean
    assert all((k, t) in clean for i, (k, t) in enumerate(rows) if not plain(t or "") and not expected[i])


def test_copies_change_nothing(docs):
    """Every row twice: the same terms."""
    rows = corpus()
    once, twice = marked(pii.find(docs(rows))), marked(pii.find(docs(rows + rows)))
    assert twice == sorted(once + once)


def test_cases(docs):
    """Nulls, empties, no context, entities side by side, repeated rows, null keys, clashing columns."""
    rows = [(1, None), (2, ""), (3, "a@b.cc"), (4, "a@b.cc x@y.zz"), (None, "solo zebra a@b.cc"), (5, "solo zebra a@b.cc"), (5, "solo zebra a@b.cc"), (6, "é🙂 +1 555 555 5555")]
    got = pii.find(docs(rows)).collect()
    assert not any(r.terms for r in got)  # two texts are too few
    assert sorted(r.base for r in got) == sorted(",".join(f"{k}:{s}:{e}" for k, s, e in plain(t or "")) for _, t in rows)
    clean = pii.sanitise(docs(rows))
    assert clean.columns == docs(rows).columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(k) for k, _ in rows)  # repeated keys do not multiply rows
    assert pii.find(docs([])).count() == 0 and pii.sanitise(docs([])).count() == 0
