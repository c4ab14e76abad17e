"""Scalar text functions (Column -> Column).

Every function here builds a Catalyst expression: it runs inside whole-stage
codegen over an entire table, never in Python.  Lengths are in characters.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: the default trim set of the source (space, tab, LF, CR, NUL, VT).
TRIM_SET = " \t\n\r\0\x0b"

DOCUMENTED = "documented"
OBSERVED = "observed"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def let(value, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (a one-element ``transform``).  Column
    expressions that use an input several times otherwise copy the whole input expression
    into each use."""
    return F.transform(F.array(_c(value)), fn)[0]


def check_semantics(semantics: str) -> str:
    if semantics not in (DOCUMENTED, OBSERVED):
        raise ValueError(f"semantics must be 'documented' or 'observed', got {semantics!r}")
    return semantics


# --- STR-0 truthiness -------------------------------------------------------------------

def is_blank(col, semantics: str = DOCUMENTED) -> Column:
    """``documented``: null or empty string.  ``observed``: also the string ``'0'`` (PHP ``empty``)."""
    c = _c(col)
    if check_semantics(semantics) == OBSERVED:
        return c.isNull() | c.isin("", "0")
    return c.isNull() | (c == "")


# --- STR-1 trim ---------------------------------------------------------------------------

def trim_all(col) -> Column:
    return F.btrim(_c(col), F.lit(TRIM_SET))


# --- NODE-6 / NODE-7 tag stripping ------------------------------------------------------------

def strip_tags(col) -> Column:
    """Drop tags, closing tags, comments and declarations; a ``<`` before anything else is text."""
    return F.regexp_replace(_c(col), r"<[A-Za-z/!?][^>]*>", "")


def strip_tags_keep_p_br(col) -> Column:
    """Strip every tag except ``<p>`` and ``<br>`` (open, close, self-closing; any case)."""
    return F.regexp_replace(_c(col), r"(?i)<(?=[a-z/!?])(?!/?(?:p|br)[\s/>])[^>]*>", "")


# --- STR-5 escape -------------------------------------------------------------------------------

def html_escape(col) -> Column:
    c = _c(col)
    c = F.replace(c, F.lit("&"), F.lit("&amp;"))
    c = F.replace(c, F.lit("<"), F.lit("&lt;"))
    c = F.replace(c, F.lit(">"), F.lit("&gt;"))
    c = F.replace(c, F.lit('"'), F.lit("&quot;"))
    return F.replace(c, F.lit("'"), F.lit("&#039;"))


# --- STR-6 / STR-7 truncation --------------------------------------------------------------------

def cut_at_last_space(col) -> Column:
    """Drop everything from the last space on; unchanged if there is no space."""
    return F.regexp_replace(_c(col), r" [^ ]*\z", "")


def truncate_words(col, n: int) -> Column:
    """Trim; if longer than ``n`` cut to ``n``, back to the last space, and append ``...``."""
    if n is None or int(n) < 1:
        raise ValueError("truncate length must be >= 1")
    n = int(n)

    def body(t: Column) -> Column:
        cut = cut_at_last_space(F.substring(t, 1, n))
        return F.when(F.length(t) <= n, t).otherwise(F.concat(cut, F.lit("...")))
    return let(trim_all(col), body)


def cap_description(html_col, n: int = 800) -> Column:
    """If the tag-free text is longer than ``n``, replace the whole value by one escaped
    paragraph cut at a word boundary; otherwise keep the HTML as is (no trim)."""
    def body(h: Column) -> Column:
        def inner(plain: Column) -> Column:
            cut = cut_at_last_space(F.substring(plain, 1, n))
            capped = F.concat(F.lit("<p>"), html_escape(cut), F.lit("...</p>"))
            return F.when(F.length(plain) > n, capped).otherwise(h)
        return let(strip_tags(h), inner)
    return let(html_col, body)


# --- STR-13 / STR-14 formatting ---------------------------------------------------------------------

def format_int(col) -> Column:
    """Thousands separators, no decimals."""
    return F.format_number(_c(col).cast("decimal(38,0)"), 0)


def format_1dp(col) -> Column:
    """One decimal, half away from zero (decimal arithmetic, no binary rounding surprises)."""
    return F.format_number(F.round(_c(col).cast("decimal(38,6)"), 1), 1)
