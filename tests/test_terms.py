"""Keyword spec compile and matching: golden values read from the generator (FIXTURES D)."""

from pyspark.sql import functions as F

from snapfeed.functions.text import DOCUMENTED, OBSERVED
from snapfeed.operators import terms as K

SAMPLE = 'flood,"traffic jam",-"canvey island",-chelmsford,except("museum","country park")'


def compile_one(spark, spec, semantics):
    df = spark.createDataFrame([(spec,)], "spec string")
    r = df.select(K.compile_terms("spec", semantics).alias("t")).first()["t"]
    return list(r["include"]), list(r["exclude"]), [list(g) for g in r["overrides"]]


def test_compile_observed_sample(spark):
    inc, exc, ovr = compile_one(spark, SAMPLE, OBSERVED)
    assert inc == ["traffic jam", "museum", "country park", "flood", "except(", ")"]
    assert exc == ["canvey island", "chelmsford"]
    assert ovr == []


def test_compile_documented_sample(spark):
    inc, exc, ovr = compile_one(spark, SAMPLE, DOCUMENTED)
    assert inc == ["flood", "traffic jam"]
    assert exc == ["canvey island", "chelmsford"]
    assert ovr == [["museum", "country park"]]


def test_compile_observed_blanks(spark):
    inc, exc, ovr = compile_one(spark, "-x,except ( a, b )", OBSERVED)
    assert inc == [] and exc == ["x"] and ovr == [["a", "b"]]


def test_compile_observed_single_quote_exclude_gives_empty_term(spark):
    inc, exc, _ = compile_one(spark, "-'foo bar'", OBSERVED)
    assert inc == ["foo bar"] and exc == [""]


def test_compile_documented_single_quote_exclude(spark):
    inc, exc, _ = compile_one(spark, "-'foo bar',mayor's", DOCUMENTED)
    assert exc == ["foo bar"] and inc == ["mayor's"]


def test_compile_empty(spark):
    assert compile_one(spark, "", DOCUMENTED) == ([], [], [])
    assert compile_one(spark, None, OBSERVED) == ([], [], [])


def _match(spark, title, summary, terms, semantics):
    df = spark.createDataFrame([(title, summary)], "title string, summary string")
    return df.select(K.match_literal("title", "summary", terms, semantics).alias("m")).first()["m"]


def test_override_modes(spark):
    t = K.Terms(include=(), exclude=("canvey island",), overrides=(("museum", "country park"),))
    assert _match(spark, "Canvey Island news", "new museum opens", t, DOCUMENTED) is True
    assert _match(spark, "Canvey Island news", "new museum opens", t, OBSERVED) is False
    assert _match(spark, "Canvey Island news", "nothing", t, DOCUMENTED) is False


def test_no_terms_keeps_all(spark):
    assert _match(spark, "anything", "", K.Terms(), DOCUMENTED) is True


def test_empty_exclude_rejects_everything(spark):
    assert _match(spark, "anything", "", K.Terms(exclude=("",)), OBSERVED) is False


def test_include_must_hit(spark):
    t = K.Terms(include=("flood",))
    assert _match(spark, "River FLOOD warning", "", t, DOCUMENTED) is True
    assert _match(spark, "Sunny", "", t, DOCUMENTED) is False


def test_advert_truth_table(spark):
    df = spark.createDataFrame([
        ("Subscription offer", ""),
        ("Subscribe now", "subscription subscribe digital subscription"),
        ("Plain", "terms and conditions apply. click here to subscribe"),
        ("Plain", "terms and conditions apply"),
    ], "title string, body string")
    got = [r["a"] for r in df.select(K.is_advert("title", "body").alias("a")).collect()]
    assert got == [True, True, True, False]


def test_term_hits_overlapping_terms_count_separately(spark):
    df = spark.createDataFrame([("monthly subscription",)], "t string")
    n = df.select(K.term_hits(F.lower("t"), ["subscription", "monthly subscription"]).alias("n")).first()["n"]
    assert n == 2


def test_registered_spec_compiles_to_its_terms(spark):
    from snapfeed.plans.news import NEWS_SPEC, NEWS_TERMS
    inc, exc, ovr = compile_one(spark, NEWS_SPEC, DOCUMENTED)
    assert (tuple(inc), tuple(exc), tuple(tuple(g) for g in ovr)) == \
        (NEWS_TERMS.include, NEWS_TERMS.exclude, NEWS_TERMS.overrides)


def test_feed_specs_compile_to_oracle_terms(spark):
    from snapfeed.plans.news import FEED_SPECS, FEED_TERMS, _feeds_df
    rows = _feeds_df(spark).select("feed_id", K.compile_terms("spec", DOCUMENTED).alias("t")).collect()
    got = {r["feed_id"]: K.Terms(tuple(r["t"]["include"]), tuple(r["t"]["exclude"]), tuple(map(tuple, r["t"]["overrides"]))) for r in rows}
    assert got == FEED_TERMS and len(FEED_SPECS) == len(FEED_TERMS)


def _one_by_one(items, feeds, semantics):
    """(feed, item) pairs by the single-feed test."""
    out = set()
    for r in feeds.select("feed_id", K.compile_terms("spec", semantics).alias("t")).collect():
        terms = K.Terms(tuple(r["t"]["include"]), tuple(r["t"]["exclude"]), tuple(map(tuple, r["t"]["overrides"])))
        out |= {(r["feed_id"], x["id"]) for x in items.where(K.match_literal("title", "summary", terms, semantics)).collect()}
    return out


def test_match_feeds_equals_one_by_one(spark):
    import random
    rnd = random.Random(7)
    words = ["flood", "road", "museum", "park", "canvey", "rain", "tide", "bus", "x", "ab"]
    rows = [(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 6))), None if i % 9 == 0 else "of") for i in range(300)] + [(900, None, None)]
    items = spark.createDataFrame(rows, "id long, title string, summary string")
    specs = [(1, "flood,road,-canvey,except(museum)"), (2, "-rain,-tide"), (3, '"park road",bus'),
             (4, "-bus,except(park, flood)"), (5, ""), (6, "x,-ab"), (7, "- 'of'"), (8, "nowhere at all"), (9, '"x","x",-"x"')]
    feeds = spark.createDataFrame(specs, "feed_id long, spec string")
    for sem in (DOCUMENTED, OBSERVED):
        got = [(r["feed_id"], r["id"]) for r in K.match_feeds(items, feeds, "id", semantics=sem).collect()]
        assert len(got) == len(set(got)) and set(got) == _one_by_one(items, feeds, sem)


def test_match_feeds_shuffles_no_pairs(spark, monkeypatch):
    """Long and short items against feeds in several passes; what is shuffled grows with the items, not with the pairs, which are judged where the item lies."""
    import random
    import re
    monkeypatch.setattr(K, "PIECE", 8)
    monkeypatch.setattr(K, "HOT_GRAM", 10)
    monkeypatch.setattr(K, "FEEDS", 7)
    rnd = random.Random(3)
    words = ["flood", "road", "tide", "bus", "x", "ab", "é🙂"]
    items = spark.createDataFrame([(i, " ".join(rnd.choice(words) for _ in range(rnd.randint(0, 20))), None) for i in range(80)], "id long, title string, summary string")
    feeds = spark.createDataFrame([(f, ",".join(rnd.choice(["", "-"]) + rnd.choice(words) for _ in range(3)) + rnd.choice(["", f",except({rnd.choice(words)})"]))
                                   for f in range(30)], "feed_id long, spec string")
    for sem in (DOCUMENTED, OBSERVED):
        df = K.match_feeds(items, feeds, "id", semantics=sem)
        got = [(r["feed_id"], r["id"]) for r in df.collect()]
        assert len(got) == len(set(got)) and set(got) == _one_by_one(items, feeds, sem)
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert not re.search(r"Aggregate \[[^]]*feed_id", plan)


def test_match_feeds_judges_rows_as_sets(spark):
    """Rows that share a key, or have none, are judged by their own texts, feeds may have any kind of id, and no pair is judged by a join."""
    rows = [(1, "flood road", None), (1, "tide", "x" * 3000 + " bus"), (None, "road", None), (2, None, None), (3, "bus tide flood", "")]
    items = spark.createDataFrame(rows, "id long, title string, summary string")
    feeds = spark.createDataFrame([("a", "flood,tide"), ("b", "road,bus,-tide"), ("c", "-flood,except(tide)"), ("d", ""), (None, "bus")], "feed_id string, spec string")
    df = K.match_feeds(items, feeds, "id")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and plan.count("Join ") == 1  # terms meet grams; feeds come by arrays
    want = [("a", 1), ("b", 1), ("d", 1), ("a", 1), ("c", 1), ("d", 1), (None, 1), ("b", None), ("c", None), ("d", None), ("c", 2), ("d", 2),
            ("a", 3), ("c", 3), ("d", 3), (None, 3)]
    assert sorted(map(str, ((r["feed_id"], r["id"]) for r in df.collect()))) == sorted(map(str, want))
    none = spark.createDataFrame([], "feed_id long, spec string")
    assert K.match_feeds(items, none, "id").count() == 0


def test_many_feeds_and_a_term_in_all_items(spark):
    """10,000 feeds, one term in every item, and a plan without Python."""
    items = spark.range(50).selectExpr("id", "concat('common word', id) AS title", "'' AS summary")
    feeds = spark.range(10_000).selectExpr("id AS feed_id", "concat('word', id, if(id % 2 = 0, ',-common', '')) AS spec")
    got = K.match_feeds(items, feeds, "id")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan
    want = {(f, i) for i in range(50) for f in range(1, 100, 2) if f"word{f}" in f"common word{i}"}
    assert {(r["feed_id"], r["id"]) for r in got.collect()} == want


def test_text_hits_empty_term(spark):
    items = spark.createDataFrame([(1, "Abc"), (2, None)], "id long, t string")
    for terms, want in ((["", "ab", "zz"], {(1, ""), (1, "ab"), (2, "")}), ([""], {(1, ""), (2, "")}), ([], set())):
        table = spark.createDataFrame([(t,) for t in terms], "term string")
        assert {(r["id"], r["term"]) for r in K.text_hits(items, "id", F.lower("t"), table).collect()} == want


def test_time_is_linear_in_the_text(spark):
    """One item of a million characters costs about as much as the same characters in many items, and its terms are found anywhere."""
    import time

    from pyspark.sql import functions as F

    from snapfeed.operators.terms import text_hits
    words = "some words that repeat and go on "
    taken = {}
    for n in (10_000, 100_000, 1_000_000):
        text = (words * (n // len(words) + 1))[:n // 2] + " needle " + (words * (n // len(words) + 1))[:n // 2] + " thread"
        items = spark.createDataFrame([(1, text), (2, "no such word"), (3, "")], "k long, t string")
        terms = spark.createDataFrame([("needle",), ("thread",), ("absent term",), ("x",), ("go on some words",), ("le some",)], "term string")
        start = time.perf_counter()
        got = {(r["k"], r["term"]) for r in text_hits(items, "k", F.col("t"), terms).collect()}
        taken[n] = time.perf_counter() - start
        assert got == {(1, "needle"), (1, "thread"), (1, "go on some words"), (1, "le some")}
    assert taken[1_000_000] < 20 * max(1.0, taken[100_000]), taken


def test_hits_across_pieces(spark, monkeypatch):
    """Terms that lie across two pieces, longer than a piece, of one to three characters, and hot grams in several salts."""
    import random

    from pyspark.sql import functions as F

    from snapfeed.operators import terms as K
    monkeypatch.setattr(K, "PIECE", 7)
    monkeypatch.setattr(K, "HOT_GRAM", 20)
    rng = random.Random(1)
    texts = [(i, "".join(rng.choice("abcé🙂 ") for _ in range(rng.randrange(60)))) for i in range(200)]
    terms = sorted({"".join(rng.choice("abcé🙂 ") for _ in range(rng.randrange(1, 6))) for _ in range(80)} | {texts[3][1][2:], "ab" * 20, ""} - {""}) + [""]
    items, table = spark.createDataFrame(texts, "k long, t string"), spark.createDataFrame([(t,) for t in terms], "term string")
    got = [(r["k"], r["term"]) for r in K.text_hits(items, "k", F.col("t"), table).collect()]
    assert len(got) == len(set(got)) and set(got) == {(k, x) for k, t in texts for x in terms if x in t}


def test_feeds_by_parameters(spark):
    """Many parameter sets against a sort for each; ages and days that no item or feed has, ties, nulls."""
    import datetime as dt
    import random

    from pyspark.sql import functions as F

    from snapfeed.operators.ranking import top_k_for_feeds
    rng = random.Random(9)
    now = dt.datetime(2024, 3, 1, 12)
    items = [(i, rng.choice(["a", "b", "c", None]), now - dt.timedelta(seconds=rng.randrange(-90_000, 40 * 86_400)) if i % 29 else None,
              rng.choice([1.0, 2.0, 5.5, None, float(i)]), float(i % 50)) for i in range(1500)]
    feeds = [(f, rng.choice(["a", "b", "zz", "", None]), rng.choice([None, 0, 1, 7, 30, 365]), rng.choice(["likes", "views", "odd", None]), rng.choice([None, 1, 5, 50, 99]))
             for f in range(60)]
    df = spark.createDataFrame(items, "id long, cat string, ts timestamp, likes double, views double")
    table = spark.createDataFrame(feeds, "feed_id long, category string, days int, ordering string, limit int")
    got = {}
    for r in top_k_for_feeds(df, table, "cat", "ts", F.lit(now), {"likes": "likes", "views": "views"}, "id").collect():
        got.setdefault(r["feed_id"], {})[r["rank"]] = r["id"]
    for f, cat, days, order, limit in feeds:
        own = [x for x in items if (not cat or x[1] == cat) and (days is None or x[2] is not None and x[2] > now - dt.timedelta(days=days))]
        at = 4 if order == "views" else 3
        own.sort(key=lambda x: (x[at] is None, -(x[at] or 0), x[0]))
        expected = [x[0] for x in own[:min(50, max(1, limit or 1))]]
        assert [got.get(f, {})[i + 1] for i in range(len(got.get(f, {})))] == expected, (f, cat, days, order, limit)
