"""Queries by selector (NODE-1 .. NODE-11, IMG-1 .. IMG-4, A-4) and the HTML models generator.  The stored pages lack most of what the
selectors look for; such queries read pages with structure derived by rule (``derived``), and the oracle states what follows from the rule."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from ..functions import cleaners, dates, rules, text as T, urls as U
from ..functions.entities import HTML4, decode_entities
from ..operators import article as A
from ..operators import images as I
from ..operators import nodes as N
from ..operators.dedup import materialize
from ..operators.ranking import clamp_limit
from ..session import checkpoint_dir
from ..sources.snapshots import load_table
from . import derived as X
from . import sqlgen as S
from .catalog import register
from .news import EXCERPT_LENGTH, article_fields, with_excerpt


def _extract(spark, sf, wants: dict[str, N.Want]):
    return N.extract(load_table(spark, sf, "pages", ["page_id", "url", "html"]), wants)


@register("page_nodes")
def page_nodes(spark, sf):
    """NODE-1: every element of every page with position, ancestors and text.  The tree has no SQL form; a test walks it by another
    parser."""
    nodes = _extract(spark, sf, {"nodes": N.Want("*", ("node_id", "tag", "elem_id", "classes", "depth", "text"))})
    e = nodes.select("page_id", F.explode("nodes").alias("n"))
    return e.select("page_id", F.col("n.node_id").alias("node_id"), F.col("n.tag").alias("tag"),
                    F.col("n.elem_id").alias("elem_id"), F.array_join("n.classes", " ").alias("classes"),
                    F.col("n.depth").alias("depth"), F.col("n.text").alias("text"))


@register("selector_fallback", """
SELECT p.page_id, k.rank, k.pos, k.tag, CASE k.pos WHEN 1 THEN '' WHEN 2 THEN coalesce(b.url, '/missing') ELSE a.url END AS href
FROM pages p LEFT JOIN pages a ON a.page_id = p.page_id + 1 LEFT JOIN pages b ON b.page_id = p.page_id + 2,
     LATERAL (SELECT unnest(CASE WHEN a.url IS NULL THEN [{'rank': 2, 'pos': 0, 'tag': 'article'}]
       ELSE [{'rank': 1, 'pos': 0, 'tag': 'li'}, {'rank': 1, 'pos': 1, 'tag': 'li'}, {'rank': 1, 'pos': 2, 'tag': 'li'}] END) AS k)
""")
def selector_fallback(spark, sf):
    """NODE-4 + NODE-5: listing candidates from the first selector that matches, then the
    link of each candidate (itself if ``a``, else its first descendant ``a``), in any form of ``href``."""
    read = N.extract(X.linked_pages(spark, sf), {"items": N.Want(tuple(rules.LISTING_SELECTORS), ("tag", "link"))})
    e = read.select("page_id", F.col("items_rank").alias("rank"), F.posexplode("items").alias("pos", "m"))
    return e.select("page_id", "rank", "pos", F.col("m.tag").alias("tag"), F.col("m.link.href").alias("href"))


_SELECTOR_PATH_SQL = r"""
SELECT page_id,
  CAST(len(regexp_extract_all(regexp_extract(html, '(?s)<article[^>]*>(.*)</article>', 1), '<p[\s>]')) AS INTEGER) AS article_paragraphs,
  CAST(len(regexp_extract_all(regexp_extract(html, '(?s)<nav[^>]*>(.*?)</nav>', 1), '<a[\s>]')) AS INTEGER) AS nav_links,
  CAST(len(regexp_extract_all(html, '<div class="ad"[\s>]|<footer[\s>]')) AS INTEGER) AS ad_or_footer,
  CASE WHEN regexp_matches(html, '(?s)<h1[\s>]')
       THEN regexp_replace(regexp_extract(html, '(?s)<h1[^>]*>(.*?)</h1>', 1), '<[A-Za-z/!?][^>]*>', '', 'g') END AS h1_text
FROM pages
"""


@register("selector_path", _SELECTOR_PATH_SQL)
def selector_path(spark, sf):
    """NODE-2 with descendant and child chains: article paragraphs and nav links."""
    read = _extract(spark, sf, {"paras": N.Want("article p", ("node_id",)), "links": N.Want("nav > ul > li > a", ("node_id",)),
                                "other": N.Want("div.ad, footer", ("node_id",)), "head": N.Want("h1", ("text",), first=True)})
    return read.select("page_id", F.size("paras").alias("article_paragraphs"), F.size("links").alias("nav_links"),
                       F.size("other").alias("ad_or_footer"), F.col("head.text").alias("h1_text"))


# What the rules give for each kind of derived image markup (``observed``): a hero image made absolute;
# the widest candidate; blocked; only the image outside the advert; none below a class with "ad" in it;
# a srcset without widths hides src; a blocked hero falls back to content.
_HERO_SQL = f"""
SELECT page_id, CASE page_id % 8
  WHEN 1 THEN origin || '/img/h' || page_id || '.jpg'
  WHEN 2 THEN origin || CASE WHEN page_id % 5 * 200 >= 400 THEN '/b.jpg' ELSE '/c.jpg' END
  WHEN 4 THEN 'https://cdn.example/y' || page_id || '.jpg'
  WHEN 7 THEN origin || '/w' || page_id || '.jpg' END AS image
FROM (SELECT page_id, regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin FROM pages)
"""


@register("hero_image", _HERO_SQL)
def hero_image(spark, sf):
    """IMG-3 on every page with derived image markup (null where there is no usable image)."""
    read = N.extract(X.pages_with(spark, sf, "html", X.IMAGES), I.hero_wants())
    return I.hero_image(read, U.origin_of("url"), U.base_dir_of("url")).select("page_id", "image")


_SRCSET_SQL = r"""
WITH s AS (SELECT page_id, regexp_extract_all(html, '(?is)<img\s[^>]*srcset="([^"]*)"', 1) AS sets FROM """ + X.pages_sql("html", X.IMAGES) + r"""),
e AS (SELECT page_id, CAST(unnest(range(0, len(sets))) AS INTEGER) AS pos, unnest(sets) AS srcset FROM s)
SELECT page_id, pos,
  (list_sort(list_transform(list_zip(regexp_extract_all(srcset, '(\S+)\s+(\d+)w', 1),
                                     regexp_extract_all(srcset, '(\S+)\s+(\d+)w', 2),
                                     range(0, len(regexp_extract_all(srcset, '(\S+)\s+(\d+)w', 1)))),
                            lambda x: {'nw': -CAST(x[2] AS BIGINT), 'i': x[3], 'u': x[1]})))[1].u AS best
FROM e
"""


@register("srcset_best", _SRCSET_SQL)
def srcset_best(spark, sf):
    """IMG-1 over every ``img[srcset]`` of every page (``pos``: order among them)."""
    read = N.extract(X.pages_with(spark, sf, "html", X.IMAGES), {"imgs": N.Want("img[srcset]", ("attrs",))})
    imgs = read.select("page_id", F.posexplode("imgs").alias("pos", "n"))
    return imgs.select("page_id", "pos", I.best_srcset(N.attr(F.col("n"), "srcset")).alias("best"))


CONTENT_IMAGES = "#subscription-content img, .article-body img, .mar-article-image img"
COUNTERS = [("img[srcset]", "Images with srcset"), ("img[src]", "Images with src"), (CONTENT_IMAGES, "Content area images")]

# Of each probe the length of its first match's text, and of each counter its matches, on a page with the derived parts and images.
_LIVE = "'live text number ' || page_id || ' with some words more to pass the limit'"
_LEADS = "'Lead number ' || page_id || ' of the live article'"
_SUMMARY = "'summary words that go on for a while number ' || page_id"
_MAIN_LEAD = "'The lead of main article ' || page_id || ' stands here'"
_MAIN = "'main words that go on for a while and then for a while more, number ' || page_id"
_PROBE_SQL = [
    f"CASE page_id % 6 WHEN 0 THEN length({_LIVE} || {_LEADS} || {_SUMMARY}) WHEN 1 THEN length('short live ' || page_id) END",
    f"CASE page_id % 6 WHEN 0 THEN length({_LEADS} || {_SUMMARY}) END",
    f"CASE page_id % 6 WHEN 2 THEN length({_MAIN_LEAD} || {_MAIN}) END",
    "CASE page_id % 3 WHEN 1 THEN 0 END",
    f"CASE page_id % 6 WHEN 0 THEN length({_LEADS}) WHEN 2 THEN length({_MAIN_LEAD}) END",
    "NULL", "NULL",
    "CASE page_id % 3 WHEN 1 THEN 1 ELSE 0 END", "CASE page_id % 3 WHEN 1 THEN 3 WHEN 2 THEN 1 ELSE 0 END", "CASE page_id % 3 WHEN 1 THEN 4 WHEN 2 THEN 1 ELSE 0 END",
]
_PARTS_AND_IMAGES = X.ARTICLE_PARTS.replace("END, html)", f"END, {X.SAMPLES})")


@register("coverage_report", "SELECT selector, label, count(len) AS pages_found, count(*) - count(len) AS pages_missing, round(avg(len), 2) AS avg_len FROM ("
          + " UNION ALL ".join(f"SELECT {S.q(sel)} AS selector, {S.q(label)} AS label, CAST({probe} AS BIGINT) AS len FROM pages"
                               for (sel, label), probe in zip([*rules.COVERAGE_SELECTORS, *COUNTERS], _PROBE_SQL, strict=True))
          + ") GROUP BY selector, label")
def coverage_report(spark, sf):
    """A-4: per diagnostic selector, pages where it is found / missing and the average
    text length when found; plus image counters.  Per-page flags are computed row-locally,
    then one small grouped aggregate (7 + 3 keys, combined map-side)."""
    wants = {f"probe{i}": N.Want(sel, ("text",), first=True) for i, (sel, _) in enumerate(rules.COVERAGE_SELECTORS)}
    wants |= {f"count{i}": N.Want(sel, ("node_id",)) for i, (sel, _) in enumerate(COUNTERS)}
    read = N.extract(X.pages_with(spark, sf, "html", _PARTS_AND_IMAGES), wants, keep=())
    probes = [F.struct(F.lit(sel).alias("selector"), F.lit(label).alias("label"), F.length(F.btrim(F.col(f"probe{i}.text"))).alias("len"))
              for i, (sel, label) in enumerate(rules.COVERAGE_SELECTORS)]
    probes += [F.struct(F.lit(sel).alias("selector"), F.lit(label).alias("label"), F.size(f"count{i}").alias("len")) for i, (sel, label) in enumerate(COUNTERS)]
    e = read.select(F.inline(F.array(*probes)))
    return e.groupBy("selector", "label").agg(
        F.count("len").alias("pages_found"), F.count_if(F.col("len").isNull()).alias("pages_missing"), F.round(F.avg("len"), 2).alias("avg_len"))


@register("image_samples", """
SELECT page_id, s.pos AS pos, s.src AS src, s.alt AS alt FROM (
  SELECT page_id, unnest(CASE page_id % 3
    WHEN 1 THEN [{'pos': 0::BIGINT, 'src': '/one' || page_id || '.jpg', 'alt': 'short...'}, {'pos': 1, 'src': '/two.jpg', 'alt': 'No alt'},
                 {'pos': 2, 'src': 'HAS SRCSET', 'alt': 'an alternative text of more th...'}]
    WHEN 2 THEN [{'pos': 0::BIGINT, 'src': 'NO SRC', 'alt': 'No alt'}] ELSE [] END) AS s FROM pages)
""")
def image_samples(spark, sf):
    """A-4 samples: the first three content images of each page, with their source state and 30
    characters of their alternative text."""
    read = N.extract(X.pages_with(spark, sf, "html", X.SAMPLES), {"imgs": N.Want(CONTENT_IMAGES, ("attrs",))})
    e = read.select("page_id", F.posexplode(F.slice("imgs", 1, 3)).alias("pos", "n"))
    attr = lambda name: F.nullif(N.attr(F.col("n"), name), F.lit(""))
    return e.select("page_id", F.col("pos").cast("bigint").alias("pos"),
                    F.coalesce(attr("src"), F.when(attr("srcset").isNotNull(), "HAS SRCSET").otherwise("NO SRC")).alias("src"),
                    F.coalesce(F.concat(F.substring(attr("alt"), 1, 30), F.lit("...")), F.lit("No alt")).alias("alt"))


_H1_TITLE = S.trim_all(S.strip_tags(S.decode_corpus_entities(S.trim_all(S.strip_tags(r"regexp_extract(html, '(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>', 1)")))))


@register("article_parts", f"""
SELECT page_id, {_H1_TITLE} || CASE page_id % 6 WHEN 0 THEN {S.q(rules.LIVE_SUFFIX)} ELSE '' END AS title, page_id % 6 = 0 AS is_live,
       CASE page_id % 6 WHEN 0 THEN 1 WHEN 2 THEN 3 END AS container,
       CASE page_id % 6 WHEN 0 THEN {_LEADS} || ' ' || {_LEADS} || ' ' || {_SUMMARY} WHEN 2 THEN {_MAIN_LEAD} || ' ' || {_MAIN_LEAD} || ' ' || {_MAIN} END AS excerpt,
       CASE page_id % 6 WHEN 0 THEN {_LEADS} || ' ' || {_SUMMARY} WHEN 2 THEN {_MAIN_LEAD} || ' ' || {_MAIN} END AS excerpt_documented,
       CASE page_id % 6 WHEN 3 THEN 'Tag ' || page_id % 4 || '|Local' ELSE '' END AS categories,
       CASE page_id % 6 WHEN 4 THEN CASE WHEN page_id % 4 = 0 THEN '2024-01-04T10:00:00Z' ELSE '2024-01-15T10:00:00Z' END END AS time_attr
FROM pages WHERE regexp_matches(html, '(?i)<h1[\\s>]')
""")
def article_parts(spark, sf):
    """TTL-2, BODY-1, EXC-2, NODE-11: live titles, the container that the body comes from, its excerpt with the lead paragraph in front
    (as the source does, and without repeating it), tags inside their container only, and the page's time."""
    fields = article_fields(X.pages_with(spark, sf, "html", X.ARTICLE_PARTS)).where(F.col("h1").isNotNull())
    titled = fields.withColumn("is_live", A.is_live(F.col("live"))).withColumn("title", A.live_title(A.title_choice(F.col("h1"), F.col("link_text")), F.col("live")))
    titled = materialize(titled)
    container = F.when(F.col("body.branch") < 4, F.col("body.branch"))
    observed, documented = (with_excerpt(titled, EXCERPT_LENGTH, s) for s in (T.OBSERVED, T.DOCUMENTED))
    second = documented.select(F.col("page_id").alias("_id"), F.when(F.col("body.branch") < 4, F.col("excerpt")).alias("excerpt_documented"))
    return observed.join(second, F.col("page_id") == F.col("_id")).select(
        "page_id", "title", "is_live", container.alias("container"), F.when(container.isNotNull(), F.col("excerpt")).alias("excerpt"), "excerpt_documented",
        F.array_join("categories", "|").alias("categories"), "time_attr")


@register("image_url_block", f"""
SELECT page_id, url, NOT {S.contains_any('lower(url)', rules.IMAGE_URL_BLOCKLIST)} AS valid FROM {X.pages_sql('url', X.BLOCKED_URL)}
""")
def image_url_block(spark, sf):
    """IMG-2 applied to every URL, some with derived blocked words."""
    pages = X.pages_with(spark, sf, "url", X.BLOCKED_URL)
    return pages.select("page_id", "url", I.valid_image("url").alias("valid"))


def html_model_items(pages, limit: int = 20, as_of=None, dedup: bool = False):
    """HTML models generator end to end over stored pages: listing links ``h3 a, h2 a``
    with a non-blank title, first ``limit`` per listing (F-10, T-3), URI resolution (URL-2)
    and a left join to the detail page on canonical URL (J-3), then image (IMG-4),
    description (STR-12), author, tags (A-2), date (DATE-2) and the view link (STR-15).
    Each page is read once and serves both roles; every per-page step is row-local.  ``dedup`` (Q17,
    off by default as in the source) drops repeated hrefs of a listing before the limit."""
    site = F.lit(rules.HTML_SITE)
    wants = {
        "model_links": N.Want(rules.MODEL_LINK_SELECTOR, ("text", "attrs")), "description": N.Want(rules.MODEL_DESCRIPTION_SELECTOR, ("inner_html",), first=True),
        "meta_description": N.Want("meta[name=description]", ("attrs",), first=True), "author_link": N.Want(rules.MODEL_AUTHOR_SELECTOR, ("text",), first=True),
        "tag_links": N.Want(rules.MODEL_TAG_SELECTOR, ("text",)), "date": N.Want(rules.MODEL_DATE_SELECTOR, ("text", "attrs"), first=True), **I.PAGE_IMAGE_WANTS}
    links = F.filter(F.transform("model_links", lambda x: F.struct(T.trim_all(x["text"]).alias("title"), F.coalesce(N.attr(x, "href"), F.lit("")).alias("href"))),
                     lambda l: l["title"] != "")
    if dedup:
        # Q17 documented: keep the first link per href of each listing page (row-local).
        links = F.filter(links, lambda l, i: ~F.exists(F.slice(links, 1, i), lambda e: e["href"] == l["href"]))
    raw = (F.when(F.col("description").isNotNull(), F.col("description.inner_html"))
           .when(F.col("meta_description").isNotNull(), F.concat(F.lit("<p>"), F.coalesce(N.attr(F.col("meta_description"), "content"), F.lit("")), F.lit("</p>")))
           .otherwise(F.lit("")))
    # Every page is read once: its outgoing model links (listing role) and its detail
    # fields (detail role) come out of one projection, and that compact
    # per-page table is checkpointed to the shared folder before the self-join.
    per_page = materialize(N.extract(pages, wants)).select(
        F.col("page_id"), U.canonical_url("url").alias("canon"), F.slice(links, 1, clamp_limit(limit)).alias("links"),
        I.page_image(site).alias("image"), cleaners.blocks_to_paragraphs(raw).alias("desc"),
        T.trim_all(F.col("author_link.text")).alias("author"),
        F.filter(F.transform("tag_links", lambda t: T.trim_all(t["text"])), lambda t: t != "").alias("categories"),
        F.coalesce(F.nullif(N.attr(F.col("date"), "datetime"), F.lit("")), F.col("date.text")).alias("date_txt"))
    checkpoint_dir(pages.sparkSession)
    per_page = per_page.checkpoint(eager=True)
    items = per_page.select(F.col("page_id").alias("listing_id"), F.posexplode("links").alias("pos", "l"))
    items = items.select("listing_id", F.col("pos").cast("bigint").alias("pos"), F.col("l.title").alias("title"),
                         decode_entities(U.resolve_protocol_relative(F.col("l.href"), site), HTML4).alias("uri"))
    newest_page = F.max_by(F.struct("image", "desc", "author", "categories", "date_txt"), F.col("page_id"))
    detail = per_page.groupBy(F.col("canon").alias("d_canon")).agg(newest_page.alias("d")).select("d_canon", "d.*")
    joined = items.join(detail, U.canonical_url(F.col("uri")) == F.col("d_canon"), "left")
    as_of_col = F.lit(as_of).cast("timestamp") if as_of is not None else F.current_timestamp()
    staged = materialize(joined.select(
        "listing_id", "pos", "title", "uri", "image", "desc", "author", "categories",
        F.when(F.length(F.coalesce(F.col("date_txt"), F.lit(""))) > 0,
               dates.parse_multi(F.col("date_txt"), as_of_col)).alias("ts")))
    img_html = F.when(F.col("image").isNotNull(), F.concat(F.lit('<img src="'), F.col("image"), F.lit('"><br>')))
    content = F.concat(F.coalesce(img_html, F.lit("")), F.coalesce(F.col("desc"), F.lit("")),
                       F.lit('<p><a href="'), F.col("uri"), F.lit(f'">{rules.HTML_VIEW_LINK_TEXT}</a></p>'))
    return staged.select(
        F.lit("models_html").alias("feed"), "title", "uri", content.alias("content"),
        F.coalesce(F.col("author"), F.lit("")).alias("author"),
        F.coalesce(F.col("categories"), F.array().cast("array<string>")).alias("categories"),
        F.when(F.col("image").isNotNull(), F.array("image")).otherwise(F.array().cast("array<string>")).alias("enclosures"),
        F.coalesce(F.col("ts"), as_of_col).alias("timestamp"), "listing_id", "pos")


_MODEL_IMAGE = ("CASE m % 4 WHEN 0 THEN 'https://img.example/m' || m || '.jpg' WHEN 1 THEN 'https://makerworld.com/i/' || m || '.png' "
                "WHEN 2 THEN 'https://makerworld.com/i/' || m || '.png' END")


@register("models_html_feed", f"""
WITH links AS (SELECT page_id AS listing_id, CAST(k - 1 AS BIGINT) AS pos, page_id + k AS m FROM pages, (SELECT unnest([1, 2, 3]) AS k)),
known AS (SELECT l.*, p.page_id IS NOT NULL AS stored FROM links l LEFT JOIN pages p ON p.page_id = l.m),
detail AS (SELECT *, 'https://makerworld.com/en/models/' || m AS uri, CASE WHEN stored THEN {_MODEL_IMAGE} END AS image,
  CASE WHEN stored THEN CASE m % 3 WHEN 0 THEN '<p>text of ' || m || '</p><p>more</p>' WHEN 1 THEN '<p>meta text ' || m || '</p>' ELSE '' END ELSE '' END AS descr FROM known)
SELECT 'models_html' AS feed, 'Model ' || m AS title, uri,
       coalesce('<img src="' || image || '"><br>', '') || descr || '<p><a href="' || uri || '">{rules.HTML_VIEW_LINK_TEXT}</a></p>' AS content,
       CASE WHEN stored AND m % 5 <> 0 THEN 'author ' || m % 7 ELSE '' END AS author, CASE WHEN stored THEN 'tag' || m % 3 || '|all' ELSE '' END AS categories,
       coalesce(image, '') AS enclosures, CASE WHEN stored AND m % 3 = 0 THEN '2024-01-05 00:00:00' WHEN stored AND m % 3 = 1 THEN '2024-01-06 00:00:00'
       ELSE '2024-02-01 00:00:00' END AS "timestamp", listing_id, pos
FROM detail
""")
def models_html_feed(spark, sf):
    """HTML models generator end to end over derived pages of the models site: every page is a listing of the three models that follow it
    and the detail page of its own (IMG-4 with NODE-8, STR-12, A-2, DATE-2, J-3)."""
    pages = load_table(spark, sf, "pages", ["page_id"]).select("page_id", F.expr(X.MODEL_URL).alias("url"), F.expr(X.MODEL_HTML).alias("html"))
    items = html_model_items(pages, limit=20, as_of=dt.datetime(2024, 2, 1))
    return items.withColumn("categories", F.array_join("categories", "|")).withColumn("enclosures", F.array_join("enclosures", "|")) \
        .withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
