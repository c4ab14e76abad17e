"""Host reputation against plain arithmetic."""

import math
from collections import defaultdict

import pytest

from snapfeed.llm import hosts, queries

RULES = queries.RULES


def split(url):
    """Host and path of a url by the stated rule."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
    tail = rest[cut:]
    end = min([tail.find(c) for c in "?#" if c in tail] or [len(tail)])
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:cut]), tail[:end]


def rule(host, path):
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


def domain(host):
    labels = host.split(".")
    keep = 3 if ".".join(labels[-2:]) in hosts.DOUBLE_SUFFIXES else 2
    return ".".join(labels[-keep:])


def suffix(d):
    return d.split(".", 1)[1] if "." in d else d


def strength(members):
    """members: (n, bad, prior mean)."""
    held = [(n, b, m) for n, b, m in members if n]
    total = sum(n for n, *_ in held)
    most = sum(n * m * (1 - m) for n, _, m in held)
    if not total:
        return 1.0
    beyond = (sum(n * (b / n - m) ** 2 for n, b, m in held) - sum(m * (1 - m) for *_, m in held)) / total
    return hosts.STRONGEST if beyond <= 0 else min(hosts.STRONGEST, max(1.0, most / total / beyond - 1))


def posterior(rows):
    """host -> (mean, bound) from (host, bad or None)."""
    by = defaultdict(lambda: [0, 0])
    for h, bad in rows:
        by[h][0] += bad is not None
        by[h][1] += bool(bad)
    total = [sum(v[i] for v in by.values()) for i in (0, 1)]
    mean = {"": (total[1] + 0.5) / (total[0] + 1) if total[0] else 0.5}
    parent_of = lambda x: ""
    for name, parent in ((lambda h: suffix(domain(h)), parent_of), (domain, suffix), (lambda h: h, domain)):
        level = defaultdict(lambda: [0, 0])
        for h, (n, b) in by.items():
            level[name(h)][0] += n
            level[name(h)][1] += b
        s = strength([(n, b, mean[parent(x)]) for x, (n, b) in level.items()])
        new = {x: (mean[parent(x)] * s + b) / (s + n) for x, (n, b) in level.items()}
        size = {x: s + n for x, (n, _) in level.items()}
        mean = new
    return {h: (m, m - 1.645 * math.sqrt(m * (1 - m) / (size[h] + 1))) for h, m in mean.items()}


def test_corpus(spark):
    sf = "/root/testdata/sf0.1"
    pages = [(r.page_id, r.url) for r in spark.read.parquet(f"{sf}/pages.parquet").collect()]
    bad = {r.doc_id: r.quality == 0 or r.toxic == 1 for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    known = posterior([(split(u)[0], bad.get(i)) for i, u in pages])
    found = {r.page_id: r for r in queries.op2_hosts(spark, sf).collect()}
    for i, u in pages:
        h, p = split(u)
        r, own = found[i], rule(h, p)
        mean, bound = known[h]
        assert (r.host, r.path, r.rule) == (h, p, own and own.text)
        assert abs(r.bad_share - mean) < 1e-4 and abs(r.bad_bound - bound) < 1e-4
        assert r.verdict == (own.verdict if own else "block" if bound > 0.3 else "allow")
    assert len(found) == len(pages) and {r.rule for r in found.values()} >= {"org/", "com/fr/", "com/de/"}


def test_posterior_blocks(spark):
    """A host with many bad pages is blocked, one with two bad pages of two is not; unlabelled ones follow their domain."""
    rows = [("http://bad.spam.com/a", i < 57) for i in range(60)] + [("http://two.fine.net/", True)] * 2 + [(f"http://h{i % 9}.fine.net/", i % 20 == 0) for i in range(400)]
    rows = [(i, u, b) for i, (u, b) in enumerate(rows)] + [(9000, "http://new.spam.com/x", None), (None, "http://new.fine.net", None)]
    table = spark.createDataFrame(rows, "page_id long, url string, bad boolean")
    got = {r.host: r for r in hosts.judge(table, table.where("bad is not null").select("page_id", "bad"), []).collect()}
    assert got["bad.spam.com"].verdict == "block" and got["two.fine.net"].verdict == "allow" and got["h3.fine.net"].verdict == "allow"
    assert got["new.spam.com"].bad_share > 3 * got["new.fine.net"].bad_share
    expected = posterior([(split(u)[0], b) for _, u, b in rows])
    assert all(abs(got[h].bad_share - m) < 1e-9 and abs(got[h].bad_bound - b) < 1e-9 for h, (m, b) in expected.items())


@pytest.mark.parametrize("url", [None, "", "no scheme", "http://", "HTTP://EXAMPLE.org/es/1", "x://a.example.org/en/1?q#f", "http://com/fr/", "http://xcom/fr/", "a://b.com/de/x://y.com/fr/",
                                 "http://user@h.com:80/de/", "http://é.org", "http://example.org?/es/", "http://a.com\n/de/", "http://ÀB.com/fr/\n/x"])
def test_urls(spark, url):
    h, p = split(url)
    own = rule(h, p)
    table = spark.createDataFrame([(1, url), (1, url)], "page_id long, url string")
    none = spark.createDataFrame([], "page_id long, bad boolean")
    rows = hosts.judge(table, none, RULES).collect()
    assert [(r.host, r.path, r.rule, r.verdict) for r in rows] == [(h, p, own and own.text, own.verdict if own else "allow")] * 2


def test_empty(spark):
    none = spark.createDataFrame([], "page_id long, url string")
    assert hosts.judge(none, spark.createDataFrame([(1, True)], "page_id long, bad boolean"), RULES).count() == 0
