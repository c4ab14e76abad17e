"""News generator as Spark jobs: listing links -> articles -> cleaned, filtered feed items,
plus the keyword, advert, dedup and join operators it is made of (W-1, W-3, J-1, J-3,
F-1, F-4..F-7, A-1, TTL, BODY, EXC, STR-8..10, STR-15, U-1/2, SRC-7)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cleaners, dates as D, html as H, rules, text as T, urls as U
from ..functions.entities import HTML4, decode_entities
from ..operators import article as A
from ..operators import images as I
from ..operators import nodes as N
from ..operators import terms as K
from ..operators.dedup import first_rows, first_seen, materialize, newest
from ..operators.sequence import number_rows
from ..session import checkpoint_dir
from ..sources.snapshots import chain_pages, load_table
from . import derived as X
from . import sqlgen as S
from .catalog import register

# Parameters of the registered news queries.  The corpus is invented text, so the terms
# are corpus words (see SURVEY section 5), written in the generator's keyword grammar.
NEWS_SPEC = 'thor,mentel,ation,"der ",-shwh,-blesh,except("que","ier")'
NEWS_TERMS = K.Terms(include=("thor", "mentel", "ation", "der "), exclude=("shwh", "blesh"),
                     overrides=(("que", "ier"),))
DOC_TERMS = K.Terms(include=("thor", "mentel", "ation"), exclude=("shwh", "euxen"), overrides=(("ing",),))
# Pages carry no fetch time; the feed's clock is an explicit parameter.
NEWS_AS_OF = dt.datetime(2024, 2, 1, 0, 0, 0)
EXCERPT_LENGTH = rules.DEFAULT_EXCERPT_LENGTH
FEED_NAME = "news"


# ----------------------------------------------------------------------------------- article job

def _null():
    return F.lit(None).cast("string")


# The requests of one article page: containers by id, lead paragraphs, tags in their container, hero image, first ``time``.
_LEAD = ".article-first-paragraph"
ARTICLE_WANTS = {
    "h1": N.Want("h1", ("inner_html",), first=True), "page_title": N.Want("title", ("text",), first=True),
    "p": N.Want("p", ("open_tag", "inner_html", "text", "classes")),
    "live": N.Want(rules.LIVE_CONTENT_SELECTOR, ("inner_html",), first=True),
    "live_summary": N.Want(rules.LIVE_SUMMARY_SELECTOR, ("inner_html",), first=True),
    "main": N.Want(rules.MAIN_CONTENT_SELECTOR, ("inner_html",), first=True),
    **{f"lead_{c}": N.Want(_LEAD, ("text",), first=True, within=c) for c in ("live", "live_summary", "main")},
    "tags_box": N.Want(rules.TAGS_CONTAINER_SELECTOR, ("node_id",), first=True),
    "tags": N.Want(rules.TAG_SELECTOR, ("text",), within="tags_box"),
    "time": N.Want("time", ("attrs",), first=True),
    **I.hero_wants(),
}


def article_fields(pages: DataFrame, semantics: str = T.OBSERVED, carry: tuple[str, ...] = ()) -> DataFrame:
    """The fields of each article page, read in one pass over the page, whatever markup it has.

    The link text (TTL-1 fallback) comes from the listing when the page was reached through one (crawl); a page taken as an
    article on its own falls back to its ``<title>``.  Scripts, styles and comments are no part of paragraphs."""
    linked = "link_text" in pages.columns
    staged = pages.withColumn("page_text", T.strip_tags(H.content_html("html")))
    read = materialize(N.extract(staged, ARTICLE_WANTS, keep=("url", "page_text", *(("link_text",) if linked else ()), *carry)))
    paras = F.transform("p", lambda x: F.struct(
        x["open_tag"].alias("open"), H.content_html(x["inner_html"]).alias("html"), T.trim_all(x["text"]).alias("text"),
        F.array_contains(x["classes"], "article-first-paragraph").alias("lead")))
    link = F.col("link_text") if linked else T.trim_all(F.col("page_title.text"))
    fields = read.select(
        "page_id", "url", *carry, F.col("h1.inner_html").alias("h1"), F.coalesce(link, F.lit("")).alias("link_text"), "page_text",
        paras.alias("paras"), *[F.col(f"{c}.inner_html").alias(c) for c in ("live", "live_summary", "main")],
        *[T.trim_all(F.col(f"lead_{c}.text")).alias(f"lead_{c}") for c in ("live", "live_summary", "main")],
        F.filter(F.transform("tags", lambda t: T.trim_all(t["text"])), lambda t: t != "").alias("categories"),
        N.attr(F.col("time"), "datetime").alias("time_attr"), *I.hero_wants())
    return I.hero_image(fields, U.origin_of("url"), U.base_dir_of("url"), semantics=semantics)


def with_excerpt(articles: DataFrame, n: int, semantics: str = T.DOCUMENTED) -> DataFrame:
    """``article_fields`` with ``body`` (BODY-1: branch and HTML) and ``excerpt``: of the body's paragraphs with the lead paragraph in front
    (EXC-1, EXC-2), or, without a body, of the page's (EXC-3); entities are decoded."""
    body = A.body_choice(F.col("live"), F.col("live_summary"), F.col("main"), F.col("paras"))
    with_body = materialize(articles.withColumn("body", body))
    lead = (F.when(F.col("body.branch") == 1, F.col("lead_live_summary"))
            .when(F.col("body.branch") == 2, F.col("lead_live"))
            .when(F.col("body.branch") == 3, F.col("lead_main"))
            .when(F.col("body.branch") == 4, F.try_element_at(F.transform(F.filter(
                A.body_paragraphs(F.col("paras")), lambda p: p["lead"]), lambda p: p["text"]), F.lit(1))))
    joined = A.excerpt_join(H.paragraph_texts(F.coalesce(F.col("body.html"), F.lit(""))))
    excerpt = F.when(F.col("body.html").isNotNull(),
                     T.truncate_words(A.lead_prepend(joined, lead, semantics), n)).otherwise(F.lit(""))
    fallback = A.fallback_excerpt(F.transform("paras", lambda p: p["text"]), n)
    ex = with_body.withColumn("excerpt", excerpt)
    ex = ex.withColumn("excerpt", F.when(F.col("body.html").isNull() & (F.col("excerpt") == ""), fallback)
                       .otherwise(F.col("excerpt")))
    return materialize(ex.withColumn("excerpt", A.decode_excerpt(F.col("excerpt"))))


def article_items(pages: DataFrame, terms: K.Terms = NEWS_TERMS, excerpt_length: int = EXCERPT_LENGTH,
                  semantics: str = T.DOCUMENTED, feed: str = FEED_NAME, as_of=NEWS_AS_OF,
                  advert_terms: dict | None = None, source_tz: str = "UTC",
                  carry: tuple[str, ...] = (), with_live_flag: bool = False) -> DataFrame:
    """Articles (one page row each, already de-duplicated) -> feed items.

    One extraction reads every page (``article_fields``); then title (TTL-1) -> live suffix (TTL-2) -> advert drop (F-6) -> body cascade (BODY-1) ->
    excerpt with lead paragraph (EXC-1, EXC-2) or fallback (EXC-3) -> keyword filter
    (F-4/5) -> clean (STR-8..10) -> render (STR-15).  The cleaner runs after the filter."""
    if excerpt_length is None or int(excerpt_length) == 0:
        excerpt_length = EXCERPT_LENGTH
    n = int(excerpt_length)
    advert_terms = advert_terms or {}
    carry = tuple(carry)
    fields = article_fields(pages, semantics, carry)
    staged = materialize(fields.withColumn("title", A.title_choice(F.col("h1"), F.col("link_text"), semantics)))
    titled = staged.where(F.col("title").isNotNull())
    titled = titled.withColumn("is_live", A.is_live(F.col("live"))) \
        .withColumn("title", A.live_title(F.col("title"), F.col("live")))
    kept = titled.where(~K.is_advert("title", "page_text", **advert_terms))
    ex = with_excerpt(kept, n, semantics)
    matched = ex.where(K.match_literal("title", "excerpt", terms, semantics))
    # The 33-rule chain is evaluated once (materialised) before decoding reads it.
    cleaned = materialize(matched.withColumn("clean", cleaners.clean_content(F.coalesce("body.html", F.lit("")),
                                                                             semantics)))
    cleaned = cleaned.withColumn("clean", decode_entities(F.col("clean"), HTML4))
    summary_box = F.when(F.length("excerpt") > 0, F.concat(
        F.lit('<div class="summary"><strong>Summary:</strong> '), T.html_escape(F.col("excerpt")), F.lit("</div>")))
    figure = F.when(F.col("image").isNotNull(), F.concat(
        F.lit('<figure><img src="'), T.html_escape(F.col("image")), F.lit('" alt="'), T.html_escape(F.col("title")),
        F.lit('"></figure>')))
    as_of_col = F.lit(as_of).cast("timestamp")
    ts = F.when(F.col("time_attr").isNotNull() & (F.col("time_attr") != ""),
                D.parse_iso(F.col("time_attr"), as_of_col, source_tz)).otherwise(as_of_col)
    return cleaned.select(
        F.lit(feed).alias("feed"),
        F.col("title"),
        F.col("url").alias("uri"),
        T.strip_tags("clean").alias("content"),
        F.concat(F.coalesce(figure, F.lit("")), F.coalesce(summary_box, F.lit("")), F.col("clean")).alias("content_html"),
        F.unix_timestamp(ts).alias("timestamp"),
        F.col("excerpt").alias("summary"),
        F.coalesce(F.col("image"), F.lit("")).alias("enclosures"),
        F.array_join("categories", "|").alias("categories"),
        F.col("page_id"),
        *carry,
        *([F.col("is_live")] if with_live_flag else []),
    )


def article_feed(spark, sf):
    """E2E news feed over every stored page: first snapshot per canonical URL (W-1),
    URL block (F-1), then the article job."""
    pages = load_table(spark, sf, "pages", ["page_id", "url", "html"])
    articles = first_rows(pages, U.canonical_url("url"), "page_id").where(~F.lower("url").contains(rules.URL_BLOCK_TERM))
    return article_items(articles)


def _article_feed_sql(first_seen_and_block: bool = True, semantics: str = T.DOCUMENTED) -> str:
    n = EXCERPT_LENGTH
    h1_pat = r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>"
    title_pat = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"
    canon = S.canonical("url")
    raw_title = (f"CASE WHEN regexp_matches(html, {S.q(h1_pat)}) THEN "
                 f"{S.trim_all(S.strip_tags(f'regexp_extract(html, {S.q(h1_pat)}, 1)'))} "
                 f"ELSE {S.trim_all(S.strip_tags(f'regexp_extract(html, {S.q(title_pat)}, 1)'))} END")
    page_text = S.strip_tags(S.content_html("html"))
    lt, lc = "lower(title)", f"lower(page_text)"
    advert = (f"(({S.count_hits(lt, rules.SUBSCRIPTION_TERMS)} >= 1 AND {S.count_hits(lc, rules.SUBSCRIPTION_TERMS)} >= 3)"
              f" OR (contains({lt}, 'subscription') AND {S.contains_any(lt, rules.TITLE_OFFER_WORDS)})"
              f" OR {S.count_hits(lc, rules.STRONG_CONTENT_INDICATORS)} >= 2)")
    body_html = (f"CASE WHEN {S.body_text_length('kept')} > 100 THEN "
                 f"array_to_string(list_transform(kept, lambda k: k.open || k.html || '</p>'), '') END")
    body_texts = S.paragraph_text_list("coalesce(body_html, '')")
    excerpt = f"CASE WHEN body_html IS NOT NULL THEN {S.excerpt_from_texts(body_texts, n)} ELSE '' END"
    fallback = S.fallback_excerpt("list_transform(ps, lambda p: p.text)", n)
    text = "lower(title || ' ' || excerpt)"
    excluded = S.contains_any(text, NEWS_TERMS.exclude)
    overridden = (" OR ".join(S.contains_any(text, g) for g in NEWS_TERMS.overrides) or "false") \
        if semantics == T.DOCUMENTED else "false"
    included = S.contains_any(text, NEWS_TERMS.include)
    blank = "('', '0')" if semantics == T.OBSERVED else "('')"
    observed = semantics == T.OBSERVED
    rule_table = rules.CLEAN_RULES_OBSERVED if observed else rules.CLEAN_RULES_DOCUMENTED
    clean = S.decode_corpus_entities(S.normalise_residue(S.drop_script_lines(
        S.apply_rules("coalesce(body_html, '')", rule_table), observed=observed)))
    clean = f"(CASE WHEN coalesce(body_html, '') = '' THEN '' ELSE {clean} END)"
    as_of = int(NEWS_AS_OF.replace(tzinfo=dt.timezone.utc).timestamp())
    firsts = (f"SELECT * FROM (SELECT page_id, url, html, row_number() OVER (PARTITION BY {canon} ORDER BY page_id) "
              f"AS rn FROM pages) WHERE rn = 1 AND NOT contains(lower(url), 'advertisement')"
              if first_seen_and_block else "SELECT page_id, url, html FROM pages")
    return f"""
WITH firsts AS ({firsts}),
st AS (SELECT page_id, url, {raw_title} AS raw, {page_text} AS page_text,
              {S.paragraph_struct_list('html')} AS ps FROM firsts),
ti AS (SELECT *, {S.trim_all(S.strip_tags(S.decode_corpus_entities('raw')))} AS title FROM st
       WHERE raw IS NOT NULL AND raw NOT IN {blank}),
ad AS (SELECT * FROM ti WHERE NOT {advert}),
bo AS (SELECT *, {S.body_paragraphs('ps')} AS kept FROM ad),
b2 AS (SELECT *, {body_html} AS body_html FROM bo),
e1 AS (SELECT *, {excerpt} AS ex0 FROM b2),
e2 AS (SELECT *, CASE WHEN body_html IS NULL AND ex0 = '' THEN {fallback} ELSE ex0 END AS ex1 FROM e1),
e3 AS (SELECT *, CASE WHEN length(ex1) > 0 THEN {S.decode_corpus_entities('ex1')} ELSE ex1 END AS excerpt FROM e2),
m AS (SELECT * FROM e3 WHERE NOT ({excluded} AND NOT ({overridden})) AND {included}),
c AS (SELECT *, {clean} AS clean FROM m)
SELECT '{FEED_NAME}' AS feed, title, url AS uri, {S.strip_tags('clean')} AS content,
       coalesce(CASE WHEN length(excerpt) > 0 THEN '<div class="summary"><strong>Summary:</strong> ' || {S.html_escape('excerpt')} || '</div>' END, '') || clean AS content_html,
       CAST({as_of} AS BIGINT) AS "timestamp", excerpt AS summary, '' AS enclosures, '' AS categories, page_id
FROM c
"""


register("article_feed", _article_feed_sql())(article_feed)


def article_feed_observed(spark, sf):
    """The flagship with ``observed`` semantics throughout (source behaviour as written:
    no override, '0' titles dropped, verbatim clean rules, substring ad-ancestor test)."""
    pages = load_table(spark, sf, "pages", ["page_id", "url", "html"])
    articles = first_rows(pages, U.canonical_url("url"), "page_id").where(~F.lower("url").contains(rules.URL_BLOCK_TERM))
    return article_items(articles, semantics=T.OBSERVED)


register("article_feed_observed", _article_feed_sql(semantics=T.OBSERVED))(article_feed_observed)


# ----------------------------------------------------------------------------------- documents as items

def doc_items(spark, sf):
    """Documents as feed candidates: first line = title, 200-char excerpt = summary
    (materialised, so term tests inside lambdas read the computed values)."""
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    return materialize(docs.select("doc_id", T.trim_all(F.substring_index("text", "\n", 1)).alias("title"),
                                   T.truncate_words("text", EXCERPT_LENGTH).alias("summary"), "text"))


def _doc_items_sql() -> str:
    title = S.trim_all("split_part(text, chr(10), 1)")
    return (f"SELECT doc_id, {title} AS title, "
            f"{S.truncate('text', EXCERPT_LENGTH)} AS summary, text FROM documents")


def _match_sql(terms: K.Terms, documented: bool) -> str:
    text = "lower(title || ' ' || summary)"
    excluded = S.contains_any(text, terms.exclude)
    overridden = (" OR ".join(S.contains_any(text, g) for g in terms.overrides) or "false") if documented else "false"
    included = S.contains_any(text, terms.include) if terms.include else "true"
    return f"(NOT ({excluded} AND NOT ({overridden})) AND {included})"


@register("keyword_match", f"WITH d AS ({_doc_items_sql()}) SELECT doc_id FROM d WHERE {_match_sql(DOC_TERMS, True)}")
def keyword_match(spark, sf):
    d = doc_items(spark, sf)
    return d.where(K.match_literal("title", "summary", DOC_TERMS, T.DOCUMENTED)).select("doc_id")


@register("keyword_match_observed",
          f"WITH d AS ({_doc_items_sql()}) SELECT doc_id FROM d WHERE {_match_sql(DOC_TERMS, False)}")
def keyword_match_observed(spark, sf):
    d = doc_items(spark, sf)
    return d.where(K.match_literal("title", "summary", DOC_TERMS, T.OBSERVED)).select("doc_id")


_OVR_TEXT = "lower(title || ' ' || summary)"


@register("keyword_override", f"""
WITH d AS ({_doc_items_sql()})
SELECT doc_id, {S.contains_any(_OVR_TEXT, DOC_TERMS.exclude)} AS excluded,
       {" OR ".join(S.contains_any(_OVR_TEXT, g) for g in DOC_TERMS.overrides)} AS overridden,
       {_match_sql(DOC_TERMS, True)} AS accepted_documented,
       {_match_sql(DOC_TERMS, False)} AS accepted_observed
FROM d
""")
def keyword_override(spark, sf):
    d = doc_items(spark, sf)
    text = K.match_text("title", "summary")
    excluded = F.exists(K._lit_array(DOC_TERMS.exclude), lambda t: text.contains(t))
    overridden = F.lit(False)
    for g in DOC_TERMS.overrides:
        overridden = overridden | F.exists(K._lit_array(g), lambda t: text.contains(t))
    return d.select("doc_id", excluded.alias("excluded"), overridden.alias("overridden"),
                    K.match_literal("title", "summary", DOC_TERMS, T.DOCUMENTED).alias("accepted_documented"),
                    K.match_literal("title", "summary", DOC_TERMS, T.OBSERVED).alias("accepted_observed"))


# Subscriptions of the many-feeds query (parameters, compiled by F-3 on the cluster).
FEED_SPECS = [
    (1, 'thor,mentel,ation,-shwh,-euxen,except(ing)'),
    (2, '"the ",-"and ",except("ther","tion")'),
    (3, '-euxen,-shwh'),
    (4, "ouch,blesh,quel"),
]


def _feeds_df(spark):
    return spark.createDataFrame(FEED_SPECS, "feed_id long, spec string")


# Compiled (documented grammar) forms of FEED_SPECS, written out by hand for the oracle;
# a test checks that compile_terms produces exactly these.
FEED_TERMS = {
    1: K.Terms(("thor", "mentel", "ation"), ("shwh", "euxen"), (("ing",),)),
    2: K.Terms(("the ",), ("and ",), (("ther", "tion"),)),
    3: K.Terms((), ("euxen", "shwh"), ()),
    4: K.Terms(("ouch", "blesh", "quel"), (), ()),
}


def _many_feeds_sql() -> str:
    parts = [f"SELECT CAST({fid} AS BIGINT) AS feed_id, doc_id FROM d WHERE {_match_sql(t, True)}"
             for fid, t in FEED_TERMS.items()]
    return f"WITH d AS ({_doc_items_sql()}) " + " UNION ALL ".join(parts)


@register("match_many_feeds", _many_feeds_sql())
def match_many_feeds(spark, sf):
    """F-7: every feed's spec against every document."""
    return K.match_feeds(doc_items(spark, sf), _feeds_df(spark), "doc_id", semantics=T.DOCUMENTED).select("feed_id", "doc_id")


# A feed for the first turn of each conversation, its terms taken from the turn's words: a word and a phrase wanted, a word not wanted, for one
# in three with an override; one in fifty wants everything but a word.
FEED_WORDS_SQL = "SELECT conv_id AS feed_id, regexp_extract_all(lower(text), {pattern}, 0) AS w FROM {table} WHERE turn = 0"
FEED_WORD = "[a-zà-ÿ]+"
FEED_SPEC = ("CASE WHEN feed_id % 50 = 49 THEN concat('-', w[5]) ELSE concat(w[2], ',\"', w[3], ' ', w[4], '\",-', w[5], "
             "CASE WHEN feed_id % 3 = 0 THEN concat(',except(', w[6], ')') ELSE '' END) END")


def conversation_feeds(spark, sf) -> DataFrame:
    """(feed_id, spec) of ``FEED_SPEC``, for turns of seven words or more."""
    conv = load_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    words = conv.where("turn = 0").select(F.col("conv_id").alias("feed_id"), F.regexp_extract_all(F.lower("text"), F.lit(FEED_WORD), 0).alias("w"))
    return words.where(F.size("w") > 6).select("feed_id", F.expr(FEED_SPEC).alias("spec"))


@register("match_many_feeds_scaled", f"""
WITH d AS (SELECT doc_id, lower(title || ' ' || summary) AS t FROM ({_doc_items_sql()})),
f AS ({FEED_WORDS_SQL.format(pattern=S.q(FEED_WORD), table='conversations')}),
c AS (SELECT feed_id, w[3] AS a, w[4] || ' ' || w[5] AS b, w[6] AS x, CASE WHEN feed_id % 3 = 0 THEN w[7] END AS o, feed_id % 50 = 49 AS every
      FROM f WHERE len(w) > 6)
SELECT feed_id, doc_id FROM c JOIN d ON (every OR contains(t, a) OR contains(t, b))
       AND NOT (contains(t, x) AND (every OR o IS NULL OR NOT contains(t, o)))
""")
def match_many_feeds_scaled(spark, sf):
    """F-7 with as many feeds as there are conversations, whose specs are compiled on the cluster (F-3)."""
    return K.match_feeds(doc_items(spark, sf), conversation_feeds(spark, sf), "doc_id", semantics=T.DOCUMENTED).select("feed_id", "doc_id")


# Corpus stand-ins for the advert term lists (the source lists do not occur in the corpus).
ADVERT_TERMS = dict(
    subscription_terms=["the ", "ing", "thor", "ation", "tion", "ther", "and ", "der "],
    offer_words=["que", "ier", "ment"],
    strong_terms=["shwh", "euxen", "mentel", "blesh", "ouch"],
)


@register("advert_flag", f"""
WITH d AS ({_doc_items_sql()})
SELECT doc_id,
  CAST({S.count_hits('lower(title)', ADVERT_TERMS['subscription_terms'])} AS BIGINT) AS title_hits,
  CAST({S.count_hits('lower(text)', ADVERT_TERMS['subscription_terms'])} AS BIGINT) AS content_hits,
  CAST({S.count_hits('lower(text)', ADVERT_TERMS['strong_terms'])} AS BIGINT) AS strong_hits,
  (({S.count_hits('lower(title)', ADVERT_TERMS['subscription_terms'])} >= 1
     AND {S.count_hits('lower(text)', ADVERT_TERMS['subscription_terms'])} >= 3)
   OR (contains(lower(title), 'the ') AND {S.contains_any('lower(title)', ADVERT_TERMS['offer_words'])})
   OR {S.count_hits('lower(text)', ADVERT_TERMS['strong_terms'])} >= 2) AS is_advert
FROM d
""")
def advert_flag(spark, sf):
    d = doc_items(spark, sf)
    lt, lc = F.lower("title"), F.lower("text")
    return d.select("doc_id",
                    K.term_hits(lt, ADVERT_TERMS["subscription_terms"]).cast("bigint").alias("title_hits"),
                    K.term_hits(lc, ADVERT_TERMS["subscription_terms"]).cast("bigint").alias("content_hits"),
                    K.term_hits(lc, ADVERT_TERMS["strong_terms"]).cast("bigint").alias("strong_hits"),
                    K.is_advert("title", "text", **ADVERT_TERMS).alias("is_advert"))


@register("term_hits", f"""
SELECT doc_id,
  CAST({S.count_hits('lower(text)', rules.SUBSCRIPTION_TERMS + ADVERT_TERMS['subscription_terms'])} AS BIGINT) AS content_hits,
  CAST({S.count_hits('lower(text)', rules.STRONG_CONTENT_INDICATORS + ADVERT_TERMS['strong_terms'])} AS BIGINT) AS strong_hits
FROM documents
""")
def term_hits_q(spark, sf):
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    lc = F.lower("text")
    return docs.select(
        "doc_id",
        K.term_hits(lc, rules.SUBSCRIPTION_TERMS + ADVERT_TERMS["subscription_terms"]).cast("bigint").alias("content_hits"),
        K.term_hits(lc, rules.STRONG_CONTENT_INDICATORS + ADVERT_TERMS["strong_terms"]).cast("bigint").alias("strong_hits"))


# ----------------------------------------------------------------------------------- dedup, joins, unions

_CANON_SQL = S.canonical("url")


@register("first_seen_url", f"""
SELECT canon, page_id, url FROM (
  SELECT {_CANON_SQL} AS canon, page_id, url, row_number() OVER (PARTITION BY {_CANON_SQL} ORDER BY page_id) AS rn
  FROM pages) WHERE rn = 1
""")
def first_seen_url(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "url"])
    return first_seen(pages.withColumn("canon", U.canonical_url("url")), "canon", "page_id")


@register("first_seen_text", """
SELECT text, doc_id FROM (
  SELECT text, doc_id, row_number() OVER (PARTITION BY text ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1
""")
def first_seen_text(spark, sf):
    """W-1 by whole texts: the first document is chosen by a 128-bit hash of the text, on narrow rows; texts stay where they are."""
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    key = F.when(F.col("text").isNotNull(), F.struct(F.xxhash64("text").alias("a"), F.xxhash64(F.lit(1), F.reverse("text")).alias("b")))
    return first_rows(docs, key, "doc_id").select("text", "doc_id")


def listing_links(pages: DataFrame) -> DataFrame:
    """Listing pages -> (listing_id, pos, href, link_text, url) with resolved URLs."""
    df = pages.select(F.col("page_id").alias("listing_id"), U.origin_of("url").alias("origin"),
                      U.base_dir_of("url").alias("base_dir"), F.posexplode(H.links(H.content_html("html"))).alias("pos", "l"))
    return df.where(F.col("l.href") != "").select(
        "listing_id", F.col("pos").cast("bigint").alias("pos"),
        T.trim_all(T.strip_tags(F.col("l.text"))).alias("link_text"),
        U.resolve_host_relative(F.col("l.href"), F.col("origin"), F.col("base_dir")).alias("url"))


_LINKS_RESOLVED_SQL = f"""
  SELECT page_id AS listing_id, pos, {S.trim_all(S.strip_tags('k.text'))} AS link_text,
         CASE WHEN starts_with(k.href, 'http') THEN k.href WHEN starts_with(k.href, '/') THEN origin || k.href
              ELSE rtrim(base_dir, '/') || '/' || ltrim(k.href, '/') END AS url
  FROM (SELECT page_id, origin, base_dir, CAST(unnest(range(0, len(links))) AS BIGINT) AS pos, unnest(links) AS k
        FROM (SELECT page_id,
                     regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin,
                     {S.base_dir('url')} AS base_dir,
                     {S.links(S.content_html('html'))} AS links
              FROM ({X.LINKED_PAGES_SQL})))
  WHERE k.href <> ''
"""


@register("listing_join", f"""
WITH l AS ({_LINKS_RESOLVED_SQL}),
canon AS (SELECT max(page_id) AS page_id, {_CANON_SQL} AS canon FROM pages GROUP BY canon)
SELECT l.listing_id, l.pos, l.url, c.page_id AS article_id
FROM l JOIN canon c ON {S.canonical('l.url')} = c.canon
""")
def listing_join(spark, sf):
    """J-1: every listing link joined to the stored article with the same canonical URL
    (inner: a missing article drops the link).  Shuffle join on the URL key; AQE splits a
    hot URL (a nav link present on every listing) with its skew-join handling."""
    links = listing_links(X.linked_pages(spark, sf)).withColumn("canon", U.canonical_url("url"))
    arts = newest(load_table(spark, sf, "pages", ["page_id", "url"]), U.canonical_url("url"), "canon", "page_id") \
        .withColumnRenamed("page_id", "article_id")
    return links.join(arts, "canon", "inner").select("listing_id", "pos", "url", "article_id")


@register("listing_left", f"""
WITH l AS ({_LINKS_RESOLVED_SQL}),
canon AS (SELECT max(page_id) AS page_id, {_CANON_SQL} AS canon FROM pages GROUP BY canon)
SELECT l.listing_id, l.pos, l.url, c.page_id AS article_id
FROM l LEFT JOIN canon c ON {S.canonical('l.url')} = c.canon
""")
def listing_left(spark, sf):
    """J-3: listing links kept without enrichment when the detail page is missing."""
    links = listing_links(X.linked_pages(spark, sf)).withColumn("canon", U.canonical_url("url"))
    arts = newest(load_table(spark, sf, "pages", ["page_id", "url"]), U.canonical_url("url"), "canon", "page_id") \
        .withColumnRenamed("page_id", "article_id")
    return links.join(arts, "canon", "left").select("listing_id", "pos", "url", "article_id")


@register("combine_feeds", f"""
WITH a AS (SELECT 'news' AS feed, {S.trim_all(S.strip_tags("regexp_extract(html, '(?is)<h1(?:\\s[^>]*)?>(.*?)</h1\\s*>', 1)"))} AS title,
                  url AS uri, CAST(NULL AS VARCHAR) AS author FROM pages),
     b AS (SELECT 'models' AS feed, p_name AS title,
                  {S.q(rules.JSON_SITE + '/model/')} || CAST(p_partkey AS VARCHAR) || '-' || replace(lower(p_name), ' ', '-') AS uri,
                  p_brand AS author FROM part)
SELECT * FROM a UNION ALL SELECT * FROM b
""")
def combine_feeds_q(spark, sf):
    """U-1: items of two generators in one shape (unionByName with missing columns)."""
    from ..operators.dedup import combine_feeds
    pages = load_table(spark, sf, "pages", ["url", "html"])
    part = load_table(spark, sf, "part", ["p_partkey", "p_name", "p_brand"])
    a = pages.select(F.lit("news").alias("feed"), H.first_tag_text("html", "h1").alias("title"), F.col("url").alias("uri"))
    b = part.select(F.lit("models").alias("feed"), F.col("p_name").alias("title"),
                    U.model_uri("p_partkey", F.replace(F.lower("p_name"), F.lit(" "), F.lit("-"))).alias("uri"),
                    F.col("p_brand").alias("author"))
    return combine_feeds([a, b]).select("feed", "title", "uri", "author")


# ----------------------------------------------------------------------------------- listing-driven crawl

def listing_table(pages: DataFrame, semantics: str = T.DOCUMENTED) -> DataFrame:
    """Every page as a listing, read in one pass where it lies: (page_id, canon, next_canon, has_h1, rank, items), with the candidates
    of the first listing selector that matches (NODE-4) and their links (NODE-5) as items array<struct<link struct<href, text>>>,
    the URL's origin and folder, and the identity of the next listing (null without)."""
    wants = {"next": N.Want(rules.NEXT_PAGE_SELECTOR, ("attrs",), first=True), "items": N.Want(tuple(rules.LISTING_SELECTORS), ("link",)),
             "head": N.Want("h1", ("node_id",), first=True)}
    read = materialize(N.extract(pages, wants))
    origin, base_dir, href = U.origin_of("url"), U.base_dir_of("url"), F.nullif(N.attr(F.col("next"), "href"), F.lit(""))
    return read.select("page_id", U.canonical_url("url").alias("canon"), origin.alias("origin"), base_dir.alias("base_dir"),
                       F.when(href.isNotNull(), U.canonical_url(U.resolve_host_relative(href, origin, base_dir, semantics))).alias("next_canon"),
                       F.col("head").isNotNull().alias("has_h1"), F.col("items_rank").alias("rank"), "items")


def news_crawl_items(pages: DataFrame, seeds: DataFrame, max_pages: int | None = 1, strict: bool = False,
                     semantics: str = T.DOCUMENTED, **article_kwargs) -> DataFrame:
    """The news generator as the source runs it, for many seeds at once.

    Listing chain (SRC-7): from each seed URL, up to ``max_pages`` listing pages, following
    the first ``a.pagination__next``; a missing listing ends the chain (SRC-5).  Candidates (NODE-4) -> link (NODE-5) -> resolved URL
    (URL-1) -> first occurrence per URL across the seed's crawl (W-1) -> URL block (F-1) ->
    inner join to the stored article (J-1) -> article job; ``pos`` is the append order.
    ``strict`` raises, as the source does, when a seed's first listing has no candidates
    (SRC-6); otherwise such seeds yield no items.  Seeds: a DataFrame with ``url``.

    Listings become a narrow link table in one pass; snapshots, hops and links are chosen on narrow rows.  The bodies of the pages that are
    articles of any seed are shuffled once, to meet their links, and the article job runs once per article (for each link
    text, if the article has no headline of its own); its items are then joined back to the places that link to them."""
    n_pages = int(max_pages or 0)
    if n_pages <= 0:
        return article_items(pages.limit(0), semantics=semantics, **article_kwargs).withColumn("seed", _null()) \
            .withColumn("hop", F.lit(0)).withColumn("pos", F.lit(0).cast("bigint"))
    checkpoint_dir(pages.sparkSession)
    pages = pages.select("page_id", "url", "html")
    newest_id = newest(pages.select("page_id", "url"), U.canonical_url("url"), "_canon", "page_id")
    listings = listing_table(pages, semantics).join(newest_id.select("page_id"), "page_id", "left_semi").checkpoint(eager=True)
    start = seeds.select(F.col("url").alias("seed")).distinct().withColumn("canon", U.canonical_url("seed"))
    reached = chain_pages(listings.select("canon", "next_canon"), start, n_pages)
    found = reached.join(listings.select("canon", "origin", "base_dir", "rank", "items"), "canon")
    if strict:
        found = found.withColumn("rank", F.when((F.col("hop") == 1) & F.col("rank").isNull(), F.raise_error(F.lit("No listing nodes found. Update selectors.")).cast("int"))
                                 .otherwise(F.col("rank")))
        found = materialize(found).where(F.coalesce(F.col("rank"), F.lit(0)) >= 0)
    links = found.select("seed", "hop", "origin", "base_dir", F.posexplode("items").alias("pos", "m")).where(F.coalesce(F.col("m.link.href"), F.lit("")) != "")
    links = links.select("seed", "hop", "pos", T.trim_all(F.col("m.link.text")).alias("link_text"),
                         U.resolve_host_relative(F.col("m.link.href"), F.col("origin"), F.col("base_dir"), semantics).alias("link_url"))
    links = links.withColumn("key", F.struct("seed", U.canonical_url("link_url").alias("canon")))
    firsts = first_seen(links, "key", ["hop", "pos"]).withColumn("canon", F.col("key.canon")).drop("key")
    allowed = firsts.where(~F.lower("link_url").contains(rules.URL_BLOCK_TERM))
    placed = allowed.join(listings.select("canon", "page_id", "has_h1"), "canon")
    # an article's own headline makes the link's text immaterial
    placed = placed.select("seed", "hop", "pos", "link_url", "page_id", F.when(F.col("has_h1"), "").otherwise(F.col("link_text")).alias("link_text")).checkpoint(eager=True)
    bodies = pages.join(placed.select("page_id", "link_text").distinct(), "page_id").withColumn("link_key", F.col("link_text"))
    items = article_items(bodies, carry=("link_key",), semantics=semantics, **article_kwargs).checkpoint(eager=True)
    back = placed.withColumnRenamed("link_text", "link_key").join(items.select("page_id", "link_key"), ["page_id", "link_key"])
    numbered = number_rows(back, "seed", ["hop", "pos"], "_at").drop("pos").withColumnRenamed("_at", "pos")
    return items.join(numbered, ["page_id", "link_key"]).withColumn("uri", F.col("link_url")).drop("link_url", "link_key")


def _crawl_feed_sql() -> str:
    """Two stories a listing, in order: the following pages by number, as their newest snapshot, once per
    URL identity; each is an item if the article job over the derived pages gives one."""
    key = S.canonical
    articles = _article_feed_sql(first_seen_and_block=False).strip()
    articles = articles.replace("SELECT page_id, url, html FROM pages", f"SELECT page_id, url, html FROM ({X.LINKED_PAGES_SQL})", 1)
    return f"""
WITH newest AS (SELECT {key('url')} AS canon, max(page_id) AS page_id FROM pages GROUP BY 1),
seeds AS (SELECT page_id, url FROM pages),
listings AS (SELECT s.url AS seed, n.page_id AS listing FROM seeds s JOIN newest n ON n.canon = {key('s.url')}),
stories AS (SELECT l.seed, k.k AS pos, p.url FROM listings l, (SELECT unnest([1, 2]) AS k) k JOIN pages p ON p.page_id = l.listing + k.k),
firsts AS (SELECT seed, pos, url, {key('url')} AS canon,
                  row_number() OVER (PARTITION BY seed, {key('url')} ORDER BY pos) AS rn FROM (SELECT DISTINCT * FROM stories)),
found AS (SELECT f.seed, f.pos, n.page_id FROM firsts f JOIN newest n USING (canon)
          WHERE rn = 1 AND NOT contains(lower(f.url), '{rules.URL_BLOCK_TERM}')),
items AS ({articles})
SELECT seed, items.*, CAST(row_number() OVER (PARTITION BY seed ORDER BY found.pos) - 1 AS BIGINT) AS pos
FROM found JOIN items USING (page_id)
"""


@register("news_crawl_feed", _crawl_feed_sql())
def news_crawl_feed(spark, sf):
    """Every stored page taken as a listing seed, one listing page each (the source's default
    ``maxpages``), over pages with derived links to the pages that follow them."""
    pages = X.linked_pages(spark, sf)
    return news_crawl_items(pages, pages.select("url").distinct(), max_pages=1).drop("hop")
