"""Article-level extraction: title, live flag, body cascade, excerpts (TTL-*, BODY-1, EXC-*, F-2).

All functions work on whole columns of a pages table.  Paragraph arrays come from
``snapfeed.functions.html.paragraph_html`` (native) so a page is processed in one row,
without grouping or shuffling.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions import html as H
from ..functions import rules
from ..functions.entities import HTML4, decode_entities
from ..functions.text import (DOCUMENTED, OBSERVED, check_semantics, is_blank, strip_tags,
                              trim_all, truncate_words)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


# --- F-2 junk paragraph predicates ----------------------------------------------------------

def body_junk(text) -> Column:
    return _c(text).rlike(rules.BODY_JUNK_PATTERN)


def fallback_junk(text) -> Column:
    low = F.lower(_c(text))
    hit = F.lit(False)
    for t in rules.FALLBACK_JUNK_TERMS:
        hit = hit | low.contains(t.lower())
    return hit


def excerpt_junk(text) -> Column:
    t = _c(text)
    low = F.lower(t)
    hit = F.lit(False)
    for term in rules.EXCERPT_JUNK_TERMS:
        hit = hit | low.contains(term.lower())
    for pat in rules.EXCERPT_JUNK_PATTERNS:
        hit = hit | t.rlike(pat)
    return hit


def lead_junk(text) -> Column:
    t = _c(text)
    low = F.lower(t)
    hit = t.rlike(rules.LEAD_JUNK_PATTERN)
    for term in rules.LEAD_JUNK_TERMS:
        hit = hit | low.contains(term.lower())
    return hit


# --- paragraphs ----------------------------------------------------------------------------------

def paragraphs(html) -> Column:
    """array<struct<open, html, text, lead>> of the page's paragraphs, document order."""
    content = H.content_html(html)
    return F.transform(
        F.arrays_zip(H.paragraph_openers(content).alias("open"), H.paragraph_html(content).alias("html")),
        lambda p: F.struct(p["open"].alias("open"), p["html"].alias("html"), trim_all(strip_tags(p["html"])).alias("text"),
                           F.lit(False).alias("lead")),
    )


def body_paragraphs(paras: Column) -> Column:
    """BODY-1 last branch: paragraphs longer than 30 characters without junk words."""
    return F.filter(paras, lambda p: (F.length(p["text"]) > 30) & ~body_junk(p["text"]))


def paragraph_body_html(paras: Column) -> Column:
    """Joined outer HTML of the kept paragraphs (start tags as written), or null when its
    tag-free text, untrimmed, is 100 characters or less."""
    return F.when(body_text_length(paras) > 100, F.array_join(
        F.transform(body_paragraphs(paras), lambda p: F.concat(p["open"], p["html"], F.lit("</p>"))), ""))


def body_text_length(paras: Column) -> Column:
    """Characters of the kept paragraphs' joined text, blanks at their ends included."""
    return F.length(strip_tags(F.array_join(F.transform(body_paragraphs(paras), lambda p: p["html"]), "")))


# --- EXC-1 / EXC-3 --------------------------------------------------------------------------------

def _excerpt_junk_pair(p: Column) -> Column:
    hit = _contains_any_lowered(p["l"], rules.EXCERPT_JUNK_TERMS)
    for pat in rules.EXCERPT_JUNK_PATTERNS:
        hit = hit | p["t"].rlike(pat)
    return hit


def excerpt_join(texts: Column) -> Column:
    """EXC-1 selection: paragraphs of 20+ characters without junk, joined with spaces."""
    kept = F.filter(_with_lower(texts), lambda p: (F.length(p["t"]) >= 20) & ~_excerpt_junk_pair(p))
    return F.array_join(F.transform(kept, lambda p: p["t"]), " ")


def excerpt_from_texts(texts: Column, n: int) -> Column:
    """EXC-1: keep paragraphs of 20+ characters without junk, join with spaces, truncate.
    Returns '' for an empty selection."""
    return truncate_words(excerpt_join(texts), n)


def _with_lower(texts: Column) -> Column:
    """Pair each text with its lower-cased form once; lambda bodies are evaluated without
    common-subexpression elimination, so term tests read the stored form."""
    return F.transform(texts, lambda t: F.struct(t.alias("t"), F.lower(t).alias("l")))


def _contains_any_lowered(low: Column, terms) -> Column:
    hit = F.lit(False)
    for term in terms:
        hit = hit | low.contains(term.lower())
    return hit


def fallback_excerpt(texts: Column, n: int) -> Column:
    """EXC-3: paragraphs over 30 characters without fallback junk, appended with a space
    until the running text is longer than ``n``; then truncated.

    Every appended paragraph adds at least 32 characters, so the running text is longer
    than ``n`` after ``n // 32 + 1`` of them: folding over the first ``n // 32 + 2`` kept
    paragraphs gives exactly the same text with bounded work per page."""
    kept = F.filter(_with_lower(texts),
                    lambda p: (F.length(p["t"]) > 30) & ~_contains_any_lowered(p["l"], rules.FALLBACK_JUNK_TERMS))
    head = F.slice(F.transform(kept, lambda p: p["t"]), 1, n // 32 + 2)
    acc = F.aggregate(
        head, F.lit(""),
        lambda a, x: F.when(F.length(a) > n, a).otherwise(F.concat(a, x, F.lit(" "))),
    )
    return truncate_words(acc, n)


# --- TTL-1 / TTL-2 ---------------------------------------------------------------------------------

def title_choice(h1_inner: Column, link_text: Column, semantics: str = OBSERVED) -> Column:
    """TTL-1: trimmed ``h1`` text when an ``h1`` exists, else trimmed link text; null (item
    dropped) when blank; then entity decode, tag strip and trim."""
    raw = F.when(h1_inner.isNotNull(), trim_all(strip_tags(h1_inner))).otherwise(trim_all(link_text))
    cleaned = trim_all(strip_tags(decode_entities(raw, HTML4)))
    return F.when(~is_blank(raw, semantics), cleaned)


def is_live(live_inner: Column) -> Column:
    """TTL-2 flag: the live container holds more than 50 characters of text (Q14: the
    source sets this flag and never reads it; ``with_live_flag`` exposes it)."""
    return F.coalesce(F.length(trim_all(strip_tags(live_inner))) > 50, F.lit(False))


def live_title(title: Column, live_inner: Column) -> Column:
    """TTL-2: append the live suffix when the live container holds more than 50 chars."""
    return F.when(is_live(live_inner), F.concat(title, F.lit(rules.LIVE_SUFFIX))).otherwise(title)


def body_choice(live_inner: Column, live_summary_inner: Column, main_inner: Column, paras: Column) -> Column:
    """BODY-1 with the chosen branch: struct<branch int (1 live summary, 2 live content,
    3 main container, 4 paragraphs, null none), html string>."""
    def tlen(c):
        return F.coalesce(F.length(trim_all(strip_tags(c))), F.lit(0))
    live = tlen(live_inner) > 50
    para_html = paragraph_body_html(paras)
    branch = (F.when(live & (tlen(live_summary_inner) > 50), F.lit(1))
              .when(live & (tlen(live_inner) > 100), F.lit(2))
              .when(tlen(main_inner) > 100, F.lit(3))
              .when(para_html.isNotNull(), F.lit(4)))
    html = (F.when(branch == 1, live_summary_inner).when(branch == 2, live_inner)
            .when(branch == 3, main_inner).when(branch == 4, para_html))
    return F.struct(branch.alias("branch"), html.alias("html"))


def lead_prepend(text: Column, lead_text: Column, semantics: str = OBSERVED) -> Column:
    """EXC-2: prepend a clean lead paragraph.  ``documented`` skips the lead when the text
    already starts with it."""
    t = trim_all(text)
    ok = lead_text.isNotNull() & ~lead_junk(lead_text)
    if check_semantics(semantics) == DOCUMENTED:
        ok = ok & ~t.startswith(lead_text)
    joined = F.when(F.length(t) > 0, F.concat(lead_text, F.lit(" "), text)).otherwise(lead_text)
    return F.when(ok, joined).otherwise(text)


def decode_excerpt(excerpt: Column) -> Column:
    return F.when(F.length(excerpt) > 0, decode_entities(excerpt, HTML4)).otherwise(excerpt)
