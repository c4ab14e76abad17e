"""Native (codegen) extraction from raw page HTML (NODE-1n, NODE-5, NODE-10).

These cover the flat targets (``h1``, ``title``, ``a[href]``, ``p``, ``meta``) with
``regexp_extract``/``split`` so they never leave the JVM.  Nested selectors go through the
node table of ``snapfeed.operators.nodes``.

Paragraph model (shared with the node table): an open ``<p>`` ends at ``</p>``, at the
next ``<p>``, or at the first block-level tag (start or end) that follows it.  Text is the
tag-free content; entities are *not* decoded here.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import strip_tags, trim_all

# Block-level tags that close an open paragraph.
BLOCK_TAGS = [
    "address", "article", "aside", "blockquote", "body", "div", "dl", "fieldset", "footer",
    "form", "h1", "h2", "h3", "h4", "h5", "h6", "header", "hr", "html", "li", "main", "nav",
    "ol", "pre", "section", "table", "ul",
]
NON_CONTENT_PATTERN = r"(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->"
# What may stand in a tag after its name: a ``>`` in a quoted value does not end the tag.  Possessive, so a tag without an end is given
# up in one pass.
ATTRS = r"""(?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?+)*+"""
P_OPEN_PATTERN = rf"(?i)<p(?:[\s/]{ATTRS})?>"
P_END_PATTERN = r"(?is)(?:</p\s*>|</?(?:" + "|".join(BLOCK_TAGS) + r")[\s/>]).*"
LINK_PATTERN = rf"(?is)<a(\s{ATTRS})>(.*?)</a\s*>"
ATTR_PATTERN = r"""([^\s/>="']++)\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]*+)"""


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def content_html(html) -> Column:
    """Drop script, style and comments (their text is never content)."""
    return F.regexp_replace(_c(html), NON_CONTENT_PATTERN, "")


def first_tag_inner(html, tag: str) -> Column:
    """Inner HTML of the first ``<tag>`` element, null when absent."""
    pat = rf"(?is)<{tag}(?:\s{ATTRS})?>(.*?)</{tag}\s*>"
    present = _c(html).rlike(pat)
    return F.when(present, F.regexp_extract(_c(html), pat, 1))


def first_tag_text(html, tag: str) -> Column:
    return trim_all(strip_tags(first_tag_inner(html, tag)))


def paragraph_html(content) -> Column:
    """Inner HTML of every paragraph, in document order."""
    pieces = F.slice(F.split(_c(content), P_OPEN_PATTERN), 2, 1 << 30)
    return F.transform(pieces, lambda p: F.regexp_replace(p, P_END_PATTERN, ""))


def paragraph_openers(content) -> Column:
    """Start tag of every paragraph, in document order."""
    return F.regexp_extract_all(_c(content), F.lit(P_OPEN_PATTERN), 0)


def paragraph_texts(content) -> Column:
    """NODE-10: trimmed tag-free text of every paragraph, in document order."""
    return F.transform(paragraph_html(content), lambda p: trim_all(strip_tags(p)))


def attribute(attrs: Column, name: str) -> Column:
    """The value of an attribute in a tag's text: double-quoted, single-quoted or bare; null without it."""
    names = F.transform(F.regexp_extract_all(attrs, F.lit(ATTR_PATTERN), 1), F.lower)
    value = F.try_element_at(F.regexp_extract_all(attrs, F.lit(ATTR_PATTERN), 2), F.nullif(F.array_position(names, F.lit(name)), F.lit(0)).cast("int"))
    return F.when(value.rlike("^[\"']"), F.substring(value, F.lit(2), F.length(value) - 2)).otherwise(value)


def links(content) -> Column:
    """array<struct<href, text>> of the links, in document order: ``text`` is the inner HTML; an ``a`` without ``href`` is none."""
    found = F.arrays_zip(F.regexp_extract_all(_c(content), F.lit(LINK_PATTERN), 1).alias("attrs"),
                         F.regexp_extract_all(_c(content), F.lit(LINK_PATTERN), 2).alias("text"))
    read = F.transform(found, lambda a: F.struct(attribute(a["attrs"], "href").alias("href"), a["text"].alias("text")))
    return F.filter(read, lambda a: a["href"].isNotNull())


def link_hrefs(content) -> Column:
    return F.transform(links(content), lambda a: a["href"])
