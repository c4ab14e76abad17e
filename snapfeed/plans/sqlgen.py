"""DuckDB SQL fragments for the oracle side of the correctness gate.

These are independent re-statements of the Spark column functions in plain SQL (RE2
regexes, DuckDB list lambdas).  They exist only to build ``oracle_sql()`` strings.
"""

from __future__ import annotations

from ..functions import html as H
from ..functions import rules
from ..functions.cleaners import RESIDUE_RULES

TRIMSET = "(chr(32)||chr(9)||chr(10)||chr(13)||chr(0)||chr(11))"


def q(s: str) -> str:
    """SQL string literal."""
    return "'" + s.replace("'", "''") + "'"


def rx(x: str, pat: str, repl: str = "") -> str:
    return f"regexp_replace({x}, {q(pat)}, {q(repl)}, 'g')"


def trim_all(x: str) -> str:
    return f"trim({x}, {TRIMSET})"


def strip_tags(x: str) -> str:
    return rx(x, "<[A-Za-z/!?][^>]*>")


def canonical(url: str) -> str:
    """URL identity: fragment and tracking parameters dropped, other parameters kept."""
    bare = f"regexp_replace({url}, '#.*$', '')"
    kept = (f"array_to_string(list_filter(string_split(regexp_extract({bare}, '^[^?]*\\?(.*)$', 1), '&'), "
            "lambda p: NOT regexp_matches(p, '^(utm_[A-Za-z0-9_]*|gclid|fbclid|ref)(=|$)')), '&')")
    return f"(regexp_extract({bare}, '^[^?]*', 0) || CASE WHEN {kept} = '' THEN '' ELSE '?' || {kept} END)"


def base_dir(url: str) -> str:
    bare = f"regexp_replace({url}, '[?#].*$', '')"
    return (f"CASE WHEN regexp_matches({bare}, '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*$') THEN {bare} "
            f"ELSE regexp_replace({bare}, '/[^/]*$', '') END")


def re2(pattern: str) -> str:
    """A pattern without possessive quantifiers, which RE2 neither knows nor needs."""
    return pattern.replace("++", "+").replace("*+", "*").replace("?+", "?")


def links(content: str) -> str:
    """List of {href, text} of the links with an href, in order."""
    tag = r"""(?is)<a(\s(?:[^>"']|"[^"]*"|'[^']*')*)>(.*?)</a\s*>"""
    href = r"""(?is)(?:^|\s)href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
    value = f"regexp_extract(a, {q(href)}, 1)"
    bare = f"CASE WHEN left({value}, 1) IN ('\"', chr(39)) THEN substr({value}, 2, length({value}) - 2) ELSE {value} END"
    hrefs = f"list_transform(regexp_extract_all({content}, {q(tag)}, 1), lambda a: CASE WHEN regexp_matches(a, {q(href)}) THEN {bare} END)"
    zipped = f"list_zip({hrefs}, regexp_extract_all({content}, {q(tag)}, 2))"
    return f"list_filter(list_transform({zipped}, lambda z: struct_pack(href := z[1], text := z[2])), lambda l: l.href IS NOT NULL)"


def content_html(x: str) -> str:
    return rx(x, H.NON_CONTENT_PATTERN)


def paragraph_html_list(content: str) -> str:
    parts = f"string_split_regex({content}, {q(re2(H.P_OPEN_PATTERN))})"
    return f"list_transform(({parts})[2:], lambda p: {rx('p', H.P_END_PATTERN)})"


def paragraph_text_list(content: str) -> str:
    return f"list_transform({paragraph_html_list(content)}, lambda p: {trim_all(strip_tags('p'))})"


def paragraph_struct_list(html: str) -> str:
    content = content_html(html)
    openers = f"regexp_extract_all({content}, {q(re2(H.P_OPEN_PATTERN))}, 0)"
    return (f"list_transform({paragraph_html_list(content)}, "
            f"lambda p, i: struct_pack(open := ({openers})[i], html := p, text := {trim_all(strip_tags('p'))}))")


def body_text_length(kept: str) -> str:
    joined = f"array_to_string(list_transform({kept}, lambda k: k.html), '')"
    return f"length({strip_tags(joined)})"


def cut_last_space(x: str) -> str:
    return f"regexp_replace({x}, ' [^ ]*\\z', '')"


def truncate(x: str, n: int) -> str:
    t = trim_all(x)
    return f"(CASE WHEN length({t}) <= {n} THEN {t} ELSE {cut_last_space(f'substring({t}, 1, {n})')} || '...' END)"


def html_escape(x: str) -> str:
    out = x
    for a, b in [("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&#039;")]:
        out = f"replace({out}, {q(a)}, {q(b)})"
    return out


def decode_corpus_entities(x: str) -> str:
    """Single-pass decode restricted to the four references that occur in the corpus;
    ``&amp;`` goes last so ``&amp;copy;`` stays ``&copy;``."""
    out = x
    for a, b in [("&copy;", "©"), ("&middot;", "·"), ("&quot;", '"'), ("&amp;", "&")]:
        out = f"replace({out}, {q(a)}, {q(b)})"
    return out


def contains_any(lowered: str, terms) -> str:
    if not terms:
        return "false"
    return "(" + " OR ".join(f"contains({lowered}, {q(t.lower())})" for t in terms) + ")"


def count_hits(lowered: str, terms) -> str:
    if not terms:
        return "0"
    return "(" + " + ".join(f"CAST(contains({lowered}, {q(t.lower())}) AS INTEGER)" for t in terms) + ")"


def lit_list(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]::VARCHAR[]"


def body_junk(x: str) -> str:
    return f"regexp_matches({x}, {q(rules.BODY_JUNK_PATTERN)})"


def excerpt_junk(x: str) -> str:
    parts = [contains_any(f"lower({x})", rules.EXCERPT_JUNK_TERMS)]
    parts += [f"regexp_matches({x}, {q(p)})" for p in rules.EXCERPT_JUNK_PATTERNS]
    return "(" + " OR ".join(parts) + ")"


def fallback_junk(x: str) -> str:
    return contains_any(f"lower({x})", rules.FALLBACK_JUNK_TERMS)


def body_paragraphs(paras: str) -> str:
    return f"list_filter({paras}, lambda p: length(p.text) > 30 AND NOT {body_junk('p.text')})"


def excerpt_from_texts(texts: str, n: int) -> str:
    kept = f"list_filter({texts}, lambda t: length(t) >= 20 AND NOT {excerpt_junk('t')})"
    return truncate(f"array_to_string({kept}, ' ')", n)


def fallback_excerpt(texts: str, n: int) -> str:
    kept = f"list_filter({texts}, lambda t: length(t) > 30 AND NOT {fallback_junk('t')})"
    acc = f"list_reduce(list_prepend('', {kept}), lambda a, x: CASE WHEN length(a) > {n} THEN a ELSE a || x || ' ' END)"
    return truncate(acc, n)


def apply_rules(x: str, table) -> str:
    out = x
    for rule in table:
        pat, repl = (rule, "") if isinstance(rule, str) else rule
        out = rx(out, pat, repl.replace("$1", "\\1"))
    return out


def drop_script_lines(x: str, observed: bool = True) -> str:
    markers = [m.lower() for m in rules.SCRIPT_LINE_MARKERS]
    blank = "('', '0')" if observed else "('')"
    lines = f"list_transform(string_split({x}, chr(10)), lambda l: {trim_all('l')})"
    keep = f"list_filter({lines}, lambda l: l NOT IN {blank} AND NOT {contains_any('lower(l)', markers)})"
    return f"array_to_string({keep}, chr(10))"


def normalise_residue(x: str) -> str:
    return trim_all(apply_rules(x, RESIDUE_RULES))
