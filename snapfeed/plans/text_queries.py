"""Text-level operators over whole ``pages`` and ``documents`` tables (NODE-3/5/6/7/10,
STR-3..STR-12, F-1, F-2, EXC-1, EXC-3, TTL-1)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cleaners, html as H, rules, text as T, urls as U
from ..functions.entities import HTML4, decode_entities
from ..operators import article as A
from ..sources.snapshots import load_table
from . import derived as X
from . import sqlgen as S
from .catalog import register

# ---------------------------------------------------------------------------- NODE-10 paragraphs

_PARAS_SQL = f"""
WITH ps AS (SELECT page_id, {S.paragraph_text_list(S.content_html('html'))} AS ts FROM pages)
SELECT page_id, CAST(unnest(range(0, len(ts))) AS BIGINT) AS pos, unnest(ts) AS text FROM ps
"""


@register("page_paragraphs", _PARAS_SQL)
def page_paragraphs(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", F.posexplode(H.paragraph_texts(H.content_html("html"))).alias("pos", "text")) \
        .select("page_id", F.col("pos").cast("bigint").alias("pos"), "text")


# ---------------------------------------------------------------------------- NODE-3 first match

_H1_PAT = r"(?is)<h1(?:\s[^>]*)?>(.*?)</h1\s*>"
_FIRST_SQL = f"""
SELECT page_id, {S.trim_all(S.strip_tags(f"regexp_extract(html, {S.q(_H1_PAT)}, 1)"))} AS h1_text
FROM pages WHERE regexp_matches(html, {S.q(_H1_PAT)})
"""


@register("first_match", _FIRST_SQL)
def first_match(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", H.first_tag_text("html", "h1").alias("h1_text")).where(F.col("h1_text").isNotNull())


# ---------------------------------------------------------------------------- NODE-5 + URL-1 links

_LINKS_SQL = f"""
WITH l AS (
  SELECT page_id,
         regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) AS origin,
         regexp_replace(regexp_replace(url, '[?#].*$', ''), '/[^/]*$', '') AS base_dir,
         {S.links(S.content_html('html'))} AS links
  FROM {X.pages_sql('html', X.LINK_FORMS)}),
e AS (SELECT page_id, origin, base_dir, CAST(unnest(range(0, len(links))) AS BIGINT) AS pos, unnest(links) AS k FROM l)
SELECT page_id, pos, k.href AS href, {S.trim_all(S.strip_tags('k.text'))} AS link_text,
       CASE WHEN starts_with(k.href, 'http') THEN k.href
            WHEN starts_with(k.href, '/') THEN origin || k.href
            ELSE rtrim(base_dir, '/') || '/' || ltrim(k.href, '/') END AS url
FROM e WHERE k.href <> ''
"""


@register("page_links", _LINKS_SQL)
def page_links(spark, sf):
    """NODE-5 + URL-1: every link of every page, after some derived ones with single-quoted, bare and upper-case ``href``."""
    pages = X.pages_with(spark, sf, "html", X.LINK_FORMS)
    df = pages.select("page_id", U.origin_of("url").alias("origin"), U.base_dir_of("url").alias("base_dir"),
                      F.posexplode(H.links(H.content_html("html"))).alias("pos", "l"))
    return df.where(F.col("l.href") != "").select(
        "page_id", F.col("pos").cast("bigint").alias("pos"), F.col("l.href").alias("href"),
        T.trim_all(T.strip_tags(F.col("l.text"))).alias("link_text"),
        U.resolve_host_relative(F.col("l.href"), F.col("origin"), F.col("base_dir")).alias("url"))


# ---------------------------------------------------------------------------- NODE-6 / NODE-7

@register("strip_tags", f"SELECT page_id, {S.strip_tags(S.content_html('html'))} AS text FROM pages")
def strip_tags_q(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", T.strip_tags(H.content_html("html")).alias("text"))


def _keep_p_br_sql(x: str) -> str:
    protected = f"regexp_replace({x}, '(?i)<(/?(?:p|br)[\\s/>])', chr(1) || '\\1', 'g')"
    return f"replace({S.strip_tags(protected)}, chr(1), '<')"


@register("strip_tags_keep", f"SELECT page_id, {_keep_p_br_sql(S.content_html('html'))} AS text FROM pages")
def strip_tags_keep(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", T.strip_tags_keep_p_br(H.content_html("html")).alias("text"))


# ---------------------------------------------------------------------------- STR-3 / STR-5

_TITLE_PAT = r"(?is)<title(?:\s[^>]*)?>(.*?)</title\s*>"


@register("entity_decode", f"""
SELECT page_id, {S.decode_corpus_entities(S.content_html('html'))} AS text FROM pages
""")
def entity_decode(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", decode_entities(H.content_html("html"), HTML4).alias("text"))


@register("html_escape", f"SELECT doc_id, {S.html_escape('text')} AS escaped FROM documents")
def html_escape_q(spark, sf):
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    return docs.select("doc_id", T.html_escape("text").alias("escaped"))


# ---------------------------------------------------------------------------- STR-6 / STR-7

@register("truncate_words", f"""
SELECT doc_id, {S.truncate('text', 199)} AS t199, {S.truncate('text', 200)} AS t200,
       {S.truncate('text', 201)} AS t201 FROM documents
""")
def truncate_words_q(spark, sf):
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    return docs.select("doc_id", T.truncate_words("text", 199).alias("t199"),
                       T.truncate_words("text", 200).alias("t200"), T.truncate_words("text", 201).alias("t201"))


def _cap_sql(x: str, n: int = 800) -> str:
    plain = S.strip_tags(x)
    capped = f"'<p>' || {S.html_escape(S.cut_last_space(f'substring({plain}, 1, {n})'))} || '...</p>'"
    return f"(CASE WHEN length({plain}) > {n} THEN {capped} ELSE {x} END)"


@register("cap_description", f"SELECT doc_id, {_cap_sql('text')} AS description FROM documents")
def cap_description_q(spark, sf):
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    return docs.select("doc_id", T.cap_description("text", rules.DESCRIPTION_CAP).alias("description"))


# ---------------------------------------------------------------------------- STR-8 .. STR-12

@register("clean_content", f"""
SELECT page_id, {S.normalise_residue(S.drop_script_lines(S.apply_rules('html', rules.CLEAN_RULES_OBSERVED)))} AS cleaned
FROM pages
""")
def clean_content_q(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", cleaners.clean_content("html", T.OBSERVED).alias("cleaned"))


@register("clean_content_strict", f"""
SELECT page_id, {S.normalise_residue(S.drop_script_lines(S.apply_rules('html', rules.CLEAN_RULES_DOCUMENTED), observed=False))} AS cleaned
FROM pages
""")
def clean_content_strict(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", cleaners.clean_content("html", T.DOCUMENTED).alias("cleaned"))


@register("drop_script_lines", f"SELECT page_id, {S.drop_script_lines('html')} AS text FROM {X.pages_sql('html', X.SCRIPT_LINES)}")
def drop_script_lines_q(spark, sf):
    """STR-9 over whole pages, with derived lines that hold a script marker, a blank or a zero."""
    pages = X.pages_with(spark, sf, "html", X.SCRIPT_LINES)
    return pages.select("page_id", cleaners.drop_script_lines("html").alias("text"))


@register("normalise_ws", f"SELECT page_id, {S.normalise_residue('html')} AS html FROM pages")
def normalise_ws(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", cleaners.normalise_residue("html").alias("html"))


def _clean_description_sql(x: str) -> str:
    c = S.decode_corpus_entities(x)
    c = S.rx(c, r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>")
    c = S.rx(c, r"(?i)&nbsp;", " ")
    c = S.rx(c, r"\s+", " ")
    c = _keep_p_br_sql(c)
    c = S.rx(c, r"<p[^>]*>", "<p>")
    c = S.rx(c, r"<p>\s*</p>")
    c = S.rx(c, r"(?:<br\s*/?>){3,}", "<br><br>")
    return S.trim_all(_cap_sql(c))


@register("clean_description", f"SELECT page_id, {_clean_description_sql('html')} AS description FROM pages")
def clean_description_q(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", cleaners.clean_description("html").alias("description"))


def _blocks_sql(x: str) -> str:
    c = f"regexp_replace({x}, '(?i)</p>', chr(10)||chr(10), 'g')"
    c = f"regexp_replace({c}, '(?i)</?(div|br|h[1-6]|li|ul|ol|blockquote)[^>]*>', chr(10), 'g')"
    c = S.strip_tags(c)
    c = S.rx(c, r"[ \t]+", " ")
    c = f"regexp_replace({c}, '\\n[ \\t]+', chr(10), 'g')"
    c = f"regexp_replace({c}, '[ \\t]+\\n', chr(10), 'g')"
    c = f"regexp_replace({S.trim_all(c)}, '\\n{{3,}}', chr(10)||chr(10), 'g')"
    c = S.rx(c, r"\n\n+", "</p><p>")
    c = S.rx(c, r"\n", "<br>")
    return f"(CASE WHEN {S.trim_all(c)} <> '' THEN '<p>' || {c} || '</p>' ELSE '' END)"


@register("blocks_to_paragraphs", f"SELECT page_id, {_blocks_sql(S.content_html('html'))} AS content FROM pages")
def blocks_to_paragraphs_q(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", cleaners.blocks_to_paragraphs(H.content_html("html")).alias("content"))


# ---------------------------------------------------------------------------- F-1 / F-2 / EXC / TTL

@register("url_block", f"SELECT page_id, url FROM {X.pages_sql('url', X.BLOCKED_URL)} WHERE NOT contains(lower(url), {S.q(rules.URL_BLOCK_TERM)})")
def url_block(spark, sf):
    pages = X.pages_with(spark, sf, "url", X.BLOCKED_URL).select("page_id", "url")
    return pages.where(~F.lower("url").contains(rules.URL_BLOCK_TERM))


_JUNK_SQL = f"""
WITH p AS (SELECT page_id, {S.paragraph_text_list(S.content_html('html'))} AS ts FROM {X.pages_sql('html', X.JUNK)}),
e AS (SELECT page_id, CAST(unnest(range(0, len(ts))) AS BIGINT) AS pos, unnest(ts) AS text FROM p)
SELECT page_id, pos, {S.body_junk('text')} AS body_junk, {S.fallback_junk('text')} AS fallback_junk,
       {S.excerpt_junk('text')} AS excerpt_junk FROM e
"""


@register("junk_paragraphs", _JUNK_SQL)
def junk_paragraphs(spark, sf):
    pages = X.pages_with(spark, sf, "html", X.JUNK)
    e = pages.select("page_id", F.posexplode(H.paragraph_texts(H.content_html("html"))).alias("pos", "text"))
    return e.select("page_id", F.col("pos").cast("bigint").alias("pos"), A.body_junk("text").alias("body_junk"),
                    A.fallback_junk("text").alias("fallback_junk"), A.excerpt_junk("text").alias("excerpt_junk"))


_EXCERPT_SQL = f"""
WITH p AS (SELECT page_id, {S.paragraph_struct_list('html')} AS ps FROM pages),
b AS (SELECT page_id, {S.body_paragraphs('ps')} AS kept FROM p)
SELECT page_id,
  CASE WHEN {S.body_text_length('kept')} > 100
       THEN {S.excerpt_from_texts("list_transform(kept, lambda k: k.text)", 200)} ELSE '' END AS excerpt
FROM b
"""


@register("article_excerpt", _EXCERPT_SQL)
def article_excerpt(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    paras = A.paragraphs("html")
    texts = F.transform(A.body_paragraphs(paras), lambda p: p["text"])
    has_body = A.body_text_length(paras) > 100
    return pages.select("page_id", F.when(has_body, A.excerpt_from_texts(texts, 200)).otherwise(F.lit("")).alias("excerpt"))


@register("fallback_excerpt", f"""
SELECT page_id, {S.fallback_excerpt(S.paragraph_text_list(S.content_html('html')), 200)} AS excerpt FROM pages
""")
def fallback_excerpt(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    return pages.select("page_id", A.fallback_excerpt(H.paragraph_texts(H.content_html("html")), 200).alias("excerpt"))


def _title_sql() -> str:
    h1 = f"regexp_extract(html, {S.q(_H1_PAT)}, 1)"
    title = f"regexp_extract(html, {S.q(_TITLE_PAT)}, 1)"
    raw = (f"CASE WHEN regexp_matches(html, {S.q(_H1_PAT)}) THEN {S.trim_all(S.strip_tags(h1))} "
           f"ELSE {S.trim_all(S.strip_tags(title))} END")
    return f"""
WITH t AS (SELECT page_id, {raw} AS raw FROM pages)
SELECT page_id, {S.trim_all(S.strip_tags(S.decode_corpus_entities('raw')))} AS title
FROM t WHERE raw IS NOT NULL AND raw NOT IN ('', '0')
"""


@register("title_choice", _title_sql())
def title_choice(spark, sf):
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    t = A.title_choice(H.first_tag_inner("html", "h1"), F.coalesce(H.first_tag_text("html", "title"), F.lit("")))
    return pages.select("page_id", t.alias("title")).where(F.col("title").isNotNull())
