"""Rule-chain cleaners (STR-8 .. STR-12) as folds of ``regexp_replace`` expressions.

A cleaner is one nested expression; callers should evaluate it in a single ``select``
and reference the result column afterwards (never the expression twice), so codegen
does not duplicate the chain.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .entities import HTML5, decode_entities
from .text import (DOCUMENTED, OBSERVED, TRIM_SET, cap_description, check_semantics, let,
                   strip_tags, strip_tags_keep_p_br, trim_all)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def apply_rules(col, rule_table) -> Column:
    """Fold ``regexp_replace`` over an ordered rule table of patterns or (pattern, repl)."""
    def step(acc, rule):
        pat, repl = (rule, "") if isinstance(rule, str) else rule
        return F.regexp_replace(acc, pat, repl)
    return reduce(step, rule_table, _c(col))


def clean_rules(col, semantics: str = OBSERVED) -> Column:
    """STR-8 / STR-8d: the ordered delete-rule chain."""
    table = rules.CLEAN_RULES_OBSERVED if check_semantics(semantics) == OBSERVED else rules.CLEAN_RULES_DOCUMENTED
    return apply_rules(col, table)


def drop_script_lines(col, semantics: str = OBSERVED) -> Column:
    """STR-9: split on LF, trim each line, drop blank lines and lines holding a script
    marker (case-insensitive), join with LF."""
    markers = [m.lower() for m in rules.SCRIPT_LINE_MARKERS]
    blank = {OBSERVED: ["", "0"], DOCUMENTED: [""]}[check_semantics(semantics)]

    def keep(p: Column) -> Column:
        hit = F.lit(False)
        for m in markers:
            hit = hit | p["l"].contains(m)
        return ~p["t"].isin(*blank) & ~hit

    # Each line is trimmed and lower-cased once (lambda bodies get no subexpression reuse).
    lines = F.transform(F.split(_c(col), "\n"), lambda x: F.btrim(x, F.lit(TRIM_SET)))
    pairs = F.transform(lines, lambda t: F.struct(t.alias("t"), F.lower(t).alias("l")))
    return F.array_join(F.transform(F.filter(pairs, keep), lambda p: p["t"]), "\n")


# Residue and whitespace normaliser (STR-10), in order, as in the source.
RESIDUE_RULES = [
    (r"</script>", ""),
    (r"<script[^>]*>", ""),
    (r"<hr[^>]>\s", ""),
    (r"\s<hr[^>]>", ""),
    (r"<p>\s*</p>", ""),
    (r"\s+", " "),
    (r">\s+<", "><"),
    (r"</div>\s</div>\s<p>", "<p>"),
]


def normalise_residue(col) -> Column:
    """STR-10: stray script tags, hr leftovers, empty paragraphs, whitespace; then trim."""
    return trim_all(apply_rules(col, RESIDUE_RULES))


def clean_content(col, semantics: str = OBSERVED) -> Column:
    """STR-8 + STR-9 + STR-10: the full article-body cleaner. Empty input gives ''."""
    c = _c(col)
    out = normalise_residue(drop_script_lines(clean_rules(c, semantics), semantics))
    return F.when(c.isNull() | (c == ""), F.lit("")).otherwise(out)


def clean_description(col, cap: int = rules.DESCRIPTION_CAP) -> Column:
    """STR-11: model description cleaner."""
    c = apply_rules(decode_entities(_c(col), HTML5), rules.DESCRIPTION_RULES)
    c = apply_rules(strip_tags_keep_p_br(c), rules.DESCRIPTION_TAG_RULES)
    return trim_all(cap_description(c, cap))


def blocks_to_paragraphs(col) -> Column:
    """STR-12: block tags to line breaks, strip, squeeze, then LF runs to ``<p>``/``<br>``."""
    c = apply_rules(strip_tags(apply_rules(_c(col), rules.BLOCK_RULES)), rules.BLOCK_SPACE_RULES)
    c = apply_rules(trim_all(c), rules.BLOCK_PARAGRAPH_RULES)
    return let(c, lambda v: F.when(trim_all(v) != "", F.concat(F.lit("<p>"), v, F.lit("</p>"))).otherwise(F.lit("")))
