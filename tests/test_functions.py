"""Scalar functions: golden values from FIXTURES D and properties (hypothesis)."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from snapfeed.functions import cleaners, dates, text as T, urls as U
from snapfeed.functions.entities import HTML4, HTML5, decode_entities
from snapfeed.operators import article as A
from snapfeed.operators import images as I
from snapfeed.operators import ranking as R
from snapfeed.operators import records as M

from .conftest import one


def test_truncate_boundaries(spark):
    text = "abcd efgh ijkl"  # 14 chars
    assert one(spark, T.truncate_words(F.col("v"), 14), text) == text
    assert one(spark, T.truncate_words(F.col("v"), 13), text) == "abcd efgh..."
    assert one(spark, T.truncate_words(F.col("v"), 15), text) == text
    assert one(spark, T.truncate_words(F.col("v"), 3), "abcdef") == "abc..."
    assert one(spark, T.truncate_words(F.col("v"), 5), "  ab  ") == "ab"


@settings(max_examples=25, deadline=None)
@given(st.text(alphabet="ab c\n", max_size=60), st.integers(min_value=1, max_value=30))
def test_truncate_length_bound(spark, s, n):
    out = one(spark, T.truncate_words(F.col("v"), n), s)
    assert len(out) <= n + 3


def test_number_and_date_formats(spark):
    assert one(spark, T.format_int(F.col("v")), 12345, "v long") == "12,345"
    assert one(spark, T.format_1dp(F.col("v")), 4.25, "v double") == "4.3"
    assert one(spark, dates.display_date(F.col("v")), dt.datetime(2024, 5, 3), "v timestamp") == "May 3, 2024"


def test_escape_and_entities(spark):
    assert one(spark, T.html_escape(F.col("v")), "<a href=\"x\">'&'</a>") == \
        "&lt;a href=&quot;x&quot;&gt;&#039;&amp;&#039;&lt;/a&gt;"
    assert one(spark, decode_entities(F.col("v"), HTML4), "&amp;copy; &copy; &#8364; &#x41; &nope;") == \
        "&copy; © € A &nope;"
    assert one(spark, decode_entities(F.col("v"), HTML4), "&apos;") == "&apos;"
    assert one(spark, decode_entities(F.col("v"), HTML5), "&apos;") == "'"


def test_strip_tags_keep(spark):
    html = "<p class='x'>a<b>b</b><br/><pre>c</pre><BR></p>"
    assert one(spark, T.strip_tags_keep_p_br(F.col("v")), html) == "<p class='x'>ab<br/>c<BR></p>"


def test_clean_description_br_runs_and_cap(spark):
    out = one(spark, cleaners.clean_description(F.col("v")), "<p a='1'>x</p>" + "<br>" * 20000 + "<p> </p>")
    assert out == "<p>x</p><br><br>"
    long = "word " * 300
    out = one(spark, cleaners.clean_description(F.col("v")), long)
    assert out.startswith("<p>word") and out.endswith("...</p>") and len(out) <= 800 + 10


def test_script_lines_and_residue(spark):
    src = "  keep me \nvar x = 1\n\n0\nGetElementById here\nlast"
    assert one(spark, cleaners.drop_script_lines(F.col("v")), src) == "keep me\nlast"
    assert one(spark, cleaners.normalise_residue(F.col("v")), " <p> </p><script>x</script>  a\n\nb ") == "x</script> a b".replace("</script>", "")


def test_blocks_to_paragraphs(spark):
    out = one(spark, cleaners.blocks_to_paragraphs(F.col("v")), "<div>One</div><p>Two</p><p>Three<br>Four</p>")
    assert out == "<p>One<br>Two</p><p>Three<br>Four</p>"


def test_url_resolution(spark):
    df = spark.createDataFrame([("https://a.b/x",), ("/p/q",), ("rel/x",), ("//cdn.x/y",)], "h string")
    obs = [r[0] for r in df.select(U.resolve_host_relative("h", F.lit("https://site"), F.lit("https://site/news"))).collect()]
    assert obs == ["https://a.b/x", "https://site/p/q", "https://site/news/rel/x", "https://site//cdn.x/y"]
    doc = [r[0] for r in df.select(U.resolve_host_relative("h", F.lit("https://site"), F.lit("https://site/news"),
                                                           T.DOCUMENTED)).collect()]
    assert doc[3] == "https://cdn.x/y"
    pr = [r[0] for r in df.select(U.resolve_protocol_relative("h", F.lit("https://m"))).collect()]
    assert pr == ["https://a.b/x", "https://m/p/q", "https://mrel/x", "https://cdn.x/y"]


def test_listing_keys_and_names(spark):
    df = spark.createDataFrame([("300", "7", "hotScore"), ("", "", None)], "c string, d string, o string")
    keys = [r[0] for r in df.select(U.html_listing_key("c", "d", "o")).collect()]
    assert keys == ["https://makerworld.com/en/3d-models/300?designCreateSince=7&orderBy=hotScore",
                    "https://makerworld.com/en/3d-models"]
    names = [r[0] for r in df.select(R.html_feed_name("c", "d")).collect()]
    assert names == ["MakerWorld - Hobby & DIY (Last 7 days)", "MakerWorld - All Categories"]
    j = spark.createDataFrame([("14", "30", "likes")], "c string, d string, s string")
    assert j.select(R.json_feed_name("c", "d")).first()[0] == "Printables.com - Trending in Hobby (Last 30 days)"
    assert j.select(R.json_feed_name("c", "d", "s", "documented")).first()[0] == \
        "Printables.com - Most Liked in Hobby (Last 30 days)"


def test_limit_clamp():
    assert [R.clamp_limit(v) for v in (None, 0, 20, 99, "x")] == [1, 1, 20, 50, 1]


def test_validate_json_feeds(spark):
    feeds = spark.createDataFrame([("a", "14", "7", "likes", "99"), ("b", "999", None, None, None),
                                   ("c", None, None, None, None)],
                                  "name string, category string, days string, sort string, limit string")
    ok, bad = R.validate_json_feeds(feeds)
    assert {r["name"]: r["limit_v"] for r in ok.collect()} == {"a": 50, "c": 1}
    assert [r["reason"] for r in bad.collect()] == ["unknown category"]


def test_srcset_best(spark):
    assert one(spark, I.best_srcset(F.col("v")), "a 320w, b 640w, c 640w") == "b"
    assert one(spark, I.best_srcset(F.col("v")), "a, b") is None


def test_merge_present_null_wins(spark):
    df = spark.createDataFrame([('{"id":"1","likesCount":5,"category":{"id":"x"}}',
                                 '{"likesCount":null,"category":{"path":[]}}')], "b string, d string")
    m = df.select(M.merge_records("b", "d").alias("m")).first()["m"]
    assert m["id"] == "1" and m["likesCount"] is None and "likesCount" in m
    assert "id" not in (m["category"] or "")
    base_only = spark.createDataFrame([('{"id":"1"}', None)], "b string, d string")
    assert base_only.select(M.merge_records("b", "d").alias("m")).first()["m"] == {"id": "1"}


def test_payload_gate(spark):
    df = spark.createDataFrame([(1, '{"data":{"models":{"items":[]}}}'), (2, "oops"), (3, '{"errors":[1]}'),
                                (4, '{"errors":null,"data":{"models":{"items":[{"id":"1"}]}}}'),
                                (5, '{"data":{"models":{"items":3}}}'), (6, '{"data":{}}')],
                               "id int, payload string")
    good, bad = M.split_payloads(df)
    assert sorted(r["id"] for r in good.collect()) == [1, 4]
    assert {r["id"]: r["reason"] for r in bad.collect()} == {
        2: "invalid json", 3: "errors: [1]", 5: "unexpected format", 6: "unexpected format"}


def test_payload_gate_goes_by_type(spark):
    cases = {'{"data":{"models":{"items":[]}}} junk': "invalid json", '{"data":{"models":{"items":"[x]"}}}': "unexpected format",
             '{"errors":"null","data":{"models":{"items":[]}}}': "errors: null", '{"data":{"models":{"items":{"k":1}}}}': None,
             '{"data":{"models":{"items":null}}}': "unexpected format", '1, 2': "invalid json", "": "invalid json", "[]": "unexpected format", '{"a":1}}': "invalid json"}
    df = spark.createDataFrame([(p,) for p in cases], "payload string")
    good, bad = M.split_payloads(df)
    got = {r["payload"]: None for r in good.collect()} | {r["payload"]: r["reason"] for r in bad.collect()}
    assert got == cases


def test_url_identity(spark):
    from snapfeed.functions import urls as U
    cases = {"https://h/story?id=1": "https://h/story?id=1", "https://h/story?id=2#x": "https://h/story?id=2", "https://h/a/?utm_source=f&page=2&ref=x": "https://h/a/?page=2",
             "https://h/a?utm_source=f": "https://h/a", "https://h/a?": "https://h/a", "https://h/a.html": "https://h/a.html", "https://h/a?reference=1": "https://h/a?reference=1"}
    for url, key in cases.items():
        assert one(spark, U.canonical_url("v"), url) == key


def test_base_of_a_bare_origin(spark):
    from snapfeed.functions import urls as U
    for url, base in {"https://host": "https://host", "https://host?q=/x": "https://host", "https://host/": "https://host", "https://host/a/b": "https://host/a"}.items():
        assert one(spark, U.base_dir_of("v"), url) == base
        assert one(spark, U.resolve_host_relative(F.lit("rel/x"), U.origin_of("v"), U.base_dir_of("v")), url) == base + "/rel/x"


def test_less_than_is_text(spark):
    from snapfeed.functions.text import strip_tags
    assert one(spark, strip_tags("v"), "sizes 5 < 10 and 12 > 11 <b>ok</b><!-- c --></p>") == "sizes 5 < 10 and 12 > 11 ok"


def test_body_gate_counts_untrimmed_text(spark):
    from snapfeed.operators import article as A
    for blanks, letters, kept in ((60, 45, True), (55, 45, False), (56, 45, True), (0, 100, False), (0, 101, True)):
        html = f"<p class='x'>{' ' * blanks}{'w' * letters}</p>"
        assert one(spark, A.paragraph_body_html(A.paragraphs("v")), html) == (html if kept else None)


def test_junk_patterns_stop_at_line_ends(spark):
    from snapfeed.operators import article as A
    assert one(spark, A.lead_junk(F.col("v")), "a { b\n} c") is False
    assert one(spark, A.lead_junk(F.col("v")), "a { b } c") is True


def test_describe_fallback_sentence(spark):
    df = spark.createDataFrame([(None,)], "x string")
    m = dict(summary=F.lit(None).cast("string"), description=F.lit(None).cast("string"), likes=F.lit(0),
             downloads=F.lit(0), rating=F.lit(0), published=F.lit(None).cast("timestamp"),
             path=F.array().cast("array<string>"), tags=F.array().cast("array<string>"),
             flags=F.array().cast("array<string>"), user=F.lit(None).cast("string"), verified=F.lit(False),
             level=F.lit(0))
    assert df.select(M.describe_model(m)).first()[0] == "<p>3D model available for download from Printables.com</p>"


def test_fallback_excerpt_stop_rule(spark):
    paras = ["x" * 31, "y" * 31, "z" * 31]
    df = spark.createDataFrame([(paras,)], "p array<string>")
    assert df.select(A.fallback_excerpt(F.col("p"), 40)).first()[0] == "x" * 31 + "..."
    assert df.select(A.fallback_excerpt(F.col("p"), 31)).first()[0] == "x" * 31


def test_dates_multi(spark):
    as_of = F.lit(dt.datetime(2024, 1, 10)).cast("timestamp")
    df = spark.createDataFrame([("2024-01-02T03:04:05Z",), ("Jan 5, 2024",), ("3 days ago",), ("soon",), ("2024/01/07",)],
                               "t string")
    got = [r[0] for r in df.select(dates.parse_multi("t", as_of)).collect()]
    assert got == [dt.datetime(2024, 1, 2, 3, 4, 5), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 7),
                   dt.datetime(2024, 1, 10), dt.datetime(2024, 1, 7)]


def test_validate_html_feeds(spark):
    feeds = spark.createDataFrame([("a", None, None, None, None), ("b", "", "", "mostLiked", "0"),
                                   ("c", "999", "7", "hotScore", "5"), ("d", "301", "2", None, "5")],
                                  "name string, category string, days string, orderBy string, limit string")
    ok, bad = R.validate_html_feeds(feeds)
    got = {r["name"]: (r["category_v"], r["days_v"], r["order_v"], r["limit_v"]) for r in ok.collect()}
    assert got == {"a": ("300", "7", "hotScore", 1), "b": ("", "", "mostLiked", 1)}
    assert {r["name"]: r["reason"] for r in bad.collect()} == {"c": "unknown category", "d": "unknown days"}


def test_iso_dates_with_source_zone(spark):
    as_of = F.lit(dt.datetime(2024, 2, 1)).cast("timestamp")
    df = spark.createDataFrame([("2024-07-01T12:00:00",), ("2024-07-01T12:00:00+02:00",), ("bogus",)], "t string")
    london = [r[0] for r in df.select(dates.parse_iso("t", as_of, "Europe/London")).collect()]
    assert london == [dt.datetime(2024, 7, 1, 11, 0), dt.datetime(2024, 7, 1, 10, 0), dt.datetime(2024, 2, 1)]
    utc = [r[0] for r in df.select(dates.parse_iso("t", as_of)).collect()]
    assert utc[0] == dt.datetime(2024, 7, 1, 12, 0)


def test_json_listing_key(spark):
    df = spark.createDataFrame([("14",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(U.json_listing_key("c")).collect()] == [
        "https://www.printables.com/search/models?category=14", "https://www.printables.com/search/models",
        "https://www.printables.com/search/models"]


def test_title_choice_rules(spark):
    df = spark.createDataFrame([("<b>Big &amp; bold</b>", "link"), ("  ", "link"), (None, " Link text "), ("0", "x")],
                               "h1 string, link string")
    doc = [r[0] for r in df.select(A.title_choice(F.col("h1"), F.col("link"), T.DOCUMENTED)).collect()]
    obs = [r[0] for r in df.select(A.title_choice(F.col("h1"), F.col("link"), T.OBSERVED)).collect()]
    # an empty h1 drops the item (no fallback); a missing h1 falls back to the link text
    assert doc == ["Big & bold", None, "Link text", "0"]
    assert obs == ["Big & bold", None, "Link text", None]


def test_lead_prepend_modes(spark):
    df = spark.createDataFrame([("Lead line here rest of text", "Lead line here"), ("", "Lead"),
                                ("text", "var x = function")], "t string, lead string")
    doc = [r[0] for r in df.select(A.lead_prepend(F.col("t"), F.col("lead"), T.DOCUMENTED)).collect()]
    obs = [r[0] for r in df.select(A.lead_prepend(F.col("t"), F.col("lead"), T.OBSERVED)).collect()]
    assert doc == ["Lead line here rest of text", "Lead", "text"]
    assert obs == ["Lead line here Lead line here rest of text", "Lead", "text"]
