"""Keyword specs, keyword matching, advert classification (F-3 .. F-7, A-1).

``compile_terms`` runs over a whole ``feeds`` table (one spec per row) as column
expressions.  Matching a single feed uses literal arrays; matching many feeds at once
(``match_feeds``) joins the grams of the items' text pieces with those at which the terms are met, verifies what
meets on the piece and takes an item's feeds as sets from the terms that it contains.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import DOCUMENTED, OBSERVED, check_semantics, let, trim_all
from ..session import checkpoint_dir
from .dedup import materialize

_QUOTES = "\"'"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _lower_trim_quotes(t: Column) -> Column:
    return F.lower(F.btrim(t, F.lit(_QUOTES)))


def _drop_blank(arr: Column, semantics: str) -> Column:
    if semantics == OBSERVED:
        return F.filter(arr, lambda t: ~t.isin("", "0"))
    return F.filter(arr, lambda t: t != "")


# The keyword grammar's patterns.
DOCUMENTED_OVERRIDE = r"(?i)except\s*\(([^)]*)\)"
DOCUMENTED_OVERRIDE_TERM = r"(\"[^\"]+\"|'[^']+'|[^,]+)"
DOCUMENTED_TERM = r"(-?\"[^\"]+\"|-?'[^']+'|[^,]+)"
OBSERVED_QUOTED = r"(-?\"[^\"]+\"|'[^']+')"
OBSERVED_OVERRIDE = r"except\s\(\s([^)]+)\s*\)"
OBSERVED_OVERRIDE_TERM = r"(\"[^\"]+\"|'[^']+'|[^,\s]+)"
OBSERVED_OVERRIDE_LEFT = r"except\s*\([^)]+\)"


def compile_terms(spec, semantics: str = DOCUMENTED) -> Column:
    """F-3: ``struct<include array<string>, exclude array<string>, overrides array<array<string>>>``."""
    s = F.coalesce(_c(spec), F.lit(""))
    if check_semantics(semantics) == DOCUMENTED:
        groups = F.regexp_extract_all(s, F.lit(DOCUMENTED_OVERRIDE), 1)
        overrides = F.filter(
            F.transform(groups, lambda g: _drop_blank(F.transform(
                F.regexp_extract_all(g, F.lit(DOCUMENTED_OVERRIDE_TERM), 1),
                lambda t: _lower_trim_quotes(trim_all(t))), DOCUMENTED)),
            lambda a: F.size(a) > 0)
        rest = F.regexp_replace(s, r"(?i)except\s*\([^)]*\)", "")
        toks = F.transform(F.regexp_extract_all(rest, F.lit(DOCUMENTED_TERM), 1), trim_all)
        toks = F.filter(toks, lambda t: t != "")
        inc = F.transform(F.filter(toks, lambda t: ~t.startswith("-")), lambda t: _lower_trim_quotes(t))
        exc = F.transform(F.filter(toks, lambda t: t.startswith("-")),
                          lambda t: _lower_trim_quotes(trim_all(F.substring(t, 2, 1 << 30))))
        return F.struct(_drop_blank(inc, DOCUMENTED).alias("include"),
                        _drop_blank(exc, DOCUMENTED).alias("exclude"),
                        overrides.alias("overrides"))

    # observed: quoted phrases first (removed with every copy), strict except(), then commas.
    quoted = F.regexp_extract_all(s, F.lit(OBSERVED_QUOTED), 1)
    rest = F.aggregate(quoted, s, lambda acc, m: F.replace(acc, m, F.lit("")))
    groups = F.regexp_extract_all(rest, F.lit(OBSERVED_OVERRIDE), 1)
    overrides = F.filter(
        F.transform(groups, lambda g: _drop_blank(F.transform(
            F.regexp_extract_all(g, F.lit(OBSERVED_OVERRIDE_TERM), 1),
            _lower_trim_quotes), OBSERVED)),
        lambda a: F.size(a) > 0)
    rest = F.when(F.size(groups) > 0, F.regexp_replace(rest, OBSERVED_OVERRIDE_LEFT, "")).otherwise(rest)
    q = F.transform(quoted, trim_all)
    q_inc = F.transform(F.filter(q, lambda t: ~t.startswith("-")), _lower_trim_quotes)
    q_exc = F.transform(F.filter(q, lambda t: t.startswith("-")), lambda t: _lower_trim_quotes(F.substring(t, 2, 1 << 30)))
    words = F.filter(F.transform(F.split(F.lower(rest), ","), trim_all), lambda t: t != "")
    w_inc = F.filter(words, lambda t: ~t.startswith("-"))
    w_exc = F.transform(F.filter(words, lambda t: t.startswith("-")), lambda t: F.substring(t, 2, 1 << 30))
    return F.struct(F.concat(F.filter(q_inc, lambda t: t != ""), w_inc).alias("include"),
                    F.concat(F.filter(q_exc, lambda t: t != ""), w_exc).alias("exclude"),
                    overrides.alias("overrides"))


@dataclass(frozen=True)
class Terms:
    include: tuple[str, ...] = ()
    exclude: tuple[str, ...] = ()
    overrides: tuple[tuple[str, ...], ...] = field(default_factory=tuple)


def _lit_array(values) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def match_text(title, summary) -> Column:
    return F.lower(F.concat(F.coalesce(_c(title), F.lit("")), F.lit(" "), F.coalesce(_c(summary), F.lit(""))))


def match_terms(text: Column, include: Column, exclude: Column, overrides: Column,
                semantics: str = DOCUMENTED) -> Column:
    """F-4/F-5 over array columns: reject on any exclude hit unless an override group hits
    (``documented`` only); accept when there are no includes or any include hits."""
    excluded = F.exists(exclude, lambda t: text.contains(t))
    if check_semantics(semantics) == DOCUMENTED:
        overridden = F.exists(overrides, lambda g: F.exists(g, lambda t: text.contains(t)))
        rejected = excluded & ~overridden
    else:
        rejected = excluded
    included = (F.size(include) == 0) | F.exists(include, lambda t: text.contains(t))
    return ~rejected & included


def _sql_lit(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _any_contains_sql(text_sql: str, terms) -> str:
    return "(" + " OR ".join(f"contains({text_sql}, {_sql_lit(t)})" for t in terms) + ")" if terms else "false"


def match_literal(title, summary, terms: Terms, semantics: str = DOCUMENTED) -> Column:
    """F-4/F-5 with literal term lists (one feed).  With column names the test is plain
    boolean SQL (codegen, one parsed expression); otherwise array lambdas."""
    if isinstance(title, str) and isinstance(summary, str):
        text = f"lower(concat(coalesce(`{title}`, ''), ' ', coalesce(`{summary}`, '')))"
        excluded = _any_contains_sql(text, terms.exclude)
        if check_semantics(semantics) == DOCUMENTED and terms.overrides:
            overridden = " OR ".join(_any_contains_sql(text, g) for g in terms.overrides)
            rejected = f"({excluded} AND NOT ({overridden}))"
        else:
            rejected = excluded
        included = _any_contains_sql(text, terms.include) if terms.include else "true"
        return F.expr(f"(NOT {rejected}) AND {included}")
    text = match_text(title, summary)
    ovr = F.array(*[_lit_array(g) for g in terms.overrides]).cast("array<array<string>>")
    return match_terms(text, _lit_array(terms.include), _lit_array(terms.exclude), ovr, semantics)


# --- F-6 / A-1 -------------------------------------------------------------------------------------

def term_hits(lowered: Column, terms) -> Column:
    total = F.lit(0)
    for t in terms:
        total = total + lowered.contains(t.lower()).cast("int")
    return total


def is_advert(title, page_text, subscription_terms=None, offer_words=None, strong_terms=None) -> Column:
    """F-6: (title hits >= 1 and content hits >= 3) or (title has 'subscription' and an offer
    word) or >= 2 strong content phrases.  Term lists default to the source lists."""
    sub = list(subscription_terms if subscription_terms is not None else rules.SUBSCRIPTION_TERMS)
    offer = list(offer_words if offer_words is not None else rules.TITLE_OFFER_WORDS)
    strong = list(strong_terms if strong_terms is not None else rules.STRONG_CONTENT_INDICATORS)
    if isinstance(title, str) and isinstance(page_text, str):
        lt, lc = f"lower(`{title}`)", f"lower(`{page_text}`)"

        def hits(text_sql, terms):
            return "(" + " + ".join(f"CAST(contains({text_sql}, {_sql_lit(t.lower())}) AS INT)" for t in terms) + ")" \
                if terms else "0"
        first = _sql_lit(sub[0] if sub else "subscription")
        offer_hit = _any_contains_sql(lt, [w.lower() for w in offer])
        return F.expr(f"(({hits(lt, sub)} >= 1 AND {hits(lc, sub)} >= 3) OR (contains({lt}, {first}) AND {offer_hit})"
                      f" OR {hits(lc, strong)} >= 2)")
    lt, lc = F.lower(_c(title)), F.lower(_c(page_text))
    first = sub[0] if sub else "subscription"
    offer_hit = F.lit(False)
    for w in offer:
        offer_hit = offer_hit | lt.contains(w)
    return (((term_hits(lt, sub) >= 1) & (term_hits(lc, sub) >= 3))
            | (lt.contains(first) & offer_hit)
            | (term_hits(lc, strong) >= 2))


# --- F-7 many feeds at once -----------------------------------------------------------------------

# Characters of a gram, at one of which each term is met.
GRAM = 5
# Characters of one piece of a text: what meets a term is verified on a piece, never on a whole text.
PIECE = 256
# Terms (of all feeds together) and feeds that one pass over the items meets by tables that come with the plan; more take more passes.
HOT_GRAM = 250_000
FEEDS = 50_000


def _with_role(terms: Column, role: str) -> Column:
    return F.transform(terms, lambda x: F.struct(x.alias("term"), F.lit(role).alias("role")))


def feed_terms(feeds: DataFrame, id_col: str = "feed_id", spec_col: str = "spec",
               semantics: str = DOCUMENTED) -> DataFrame:
    """Compiled feeds as rows (feed_id, term, role): role include / exclude / override."""
    c = feeds.select(F.col(id_col).alias("feed_id"), compile_terms(spec_col, semantics).alias("t"))
    pairs = F.flatten(F.array(*[_with_role(F.array_distinct(x), r) for x, r in (
        (F.col("t.include"), "include"), (F.col("t.exclude"), "exclude"), (F.flatten("t.overrides"), "override"))]))
    return c.select("feed_id", F.inline(pairs))


def _grams(text: Column, size: int) -> Column:
    """The ``size`` characters at every place (fewer at the last ones), in one pass over the text by a look-ahead."""
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{size}}}))"), 1)


def _pieces(text: Column, longest: int) -> Column:
    """A text in pieces, in one pass over it, every piece with as many characters of the next ones as a term of ``longest``
    characters that begins in it may reach.  The empty text has no pieces."""
    size = max(PIECE, 2 * longest)
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{1,{size + max(0, longest - 1)}}})).{{1,{size}}}"), 1)


def _listed(df: DataFrame, *cols: str) -> DataFrame:
    """One row: each column as an array, all in the same order."""
    rows = df.agg(F.collect_list(F.struct(*cols)).alias("_rows"))
    return rows.select(*[F.col("_rows")[c].alias(c) for c in cols]).checkpoint(eager=True)


def _with(df: DataFrame, **row: Column) -> DataFrame:
    """``df`` with values of one row of another table (``scalar()``) as further columns, each for one use in the next ``select``: Catalyst puts
    them in there, so no row carries them."""
    return df.select("*", *[c.alias(name) for name, c in row.items()])


def _held(items: DataFrame, key: str, text: Column, words: DataFrame) -> DataFrame:
    """(key, _hits), a row for each item: places in the array ``term`` of the one row of ``words`` (distinct terms) of those that its text contains.

    Texts are cut into pieces and these into grams at every place; each term is met at the one of its grams that the fewest terms share (a term
    of fewer characters at itself), in a broadcast table by hash, and what meets is verified on the piece, so a long text costs as much as many short
    ones.  Every text has an empty piece too: there the empty term (possible in ``observed`` specs) is met, and an item without any."""
    terms = words.select(F.posexplode("term").alias("_at", "_term")).withColumn("_size", F.least(F.length("_term"), F.lit(GRAM)))
    known = terms.agg(F.coalesce(F.max(F.length("_term")), F.lit(0)).alias("longest"), F.collect_set("_size").alias("sizes")).first()
    of_terms = terms.select("*", F.explode_outer(F.array_distinct(_grams(F.col("_term"), GRAM))).alias("_gram")).na.fill("", "_gram").where(F.length("_gram") == F.col("_size"))
    shared = of_terms.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    met = of_terms.join(shared, "_gram").groupBy("_at", "_term").agg(F.min(F.struct("_n", "_gram"))["_gram"].alias("_gram"))
    none = words.select(F.lit(None).cast("int").alias("_at"), F.lit("").alias("_term"), F.lit("").alias("_gram"))
    table = met.unionByName(none).select(F.xxhash64("_gram").alias("_gram"), "_at", "_term").checkpoint(eager=True)

    cuts = sorted(n for n in known["sizes"] if n) or [1]
    rows = items.select(F.col(key), F.monotonically_increasing_id().alias("_row"), text.alias("_text"))
    rows = rows.select(key, "_row", F.explode_outer(F.concat(F.array(F.lit("")), _pieces(F.col("_text"), known["longest"]))).alias("_piece"))
    rows = rows.select("*", F.explode_outer(_grams(F.col("_piece"), cuts[-1])).alias("_part")).withColumn("_part", F.coalesce("_part", F.lit("")))
    hashes = F.array(*[F.xxhash64(F.substring("_part", 1, n)) for n in cuts[:-1]], F.xxhash64("_part"))
    hits = rows.select(key, "_row", "_piece", F.explode(hashes).alias("_gram")).join(F.broadcast(table), "_gram").where(F.contains("_piece", "_term"))
    return hits.groupBy(key, "_row").agg(F.collect_set("_at").alias("_hits")).drop("_row")


def text_hits(items: DataFrame, key: str, text: Column, terms: DataFrame) -> DataFrame:
    """(key, term): the terms (a table of distinct ``term``) that each item's text contains."""
    checkpoint_dir(items.sparkSession)
    passes = max(1, -(-terms.count() // HOT_GRAM))
    out = []
    for i in range(passes):
        words = _listed(terms.where(F.pmod(F.xxhash64("term"), F.lit(passes)) == i), "term")
        held = _held(items, key, F.coalesce(text, F.lit("")), words)
        out.append(held.select(key, F.explode("_hits").alias("_at")).select(key, F.get(words.select("term").scalar(), F.col("_at")).alias("term")))
    return reduce(DataFrame.unionByName, out)


def match_feeds(items: DataFrame, feeds: DataFrame, key: str, title="title", summary="summary",
                semantics: str = DOCUMENTED, id_col: str = "feed_id", spec_col: str = "spec") -> DataFrame:
    """F-7 / J-5: (key, feed_id) for every item that a feed's spec accepts, for any number of feeds.

    An item is one row with the terms that its text contains (only these are shuffled); they give the feeds that include, exclude or override them, as
    arrays of numbers, and what is left of these sets is the output.  Pairs, of which there may be as many as items times feeds, are neither
    shuffled nor judged one by one.  A feed without include terms meets all items."""
    checkpoint_dir(items.sparkSession)
    roles = ("include", "exclude", "override")
    terms = feed_terms(feeds, id_col, spec_col, semantics)
    named = feeds.select(F.col(id_col).alias("feed_id")).unionByName(terms, allowMissingColumns=True)
    specs = named.groupBy("feed_id").agg(*[F.collect_set(F.when(F.col("role") == r, F.col("term"))).alias(r) for r in roles]).checkpoint(eager=True)
    known = specs.agg(F.count(F.lit(1)).alias("feeds"), F.coalesce(F.sum(reduce(Column.__add__, [F.size(r) for r in roles])), F.lit(0)).alias("terms")).first()
    passes = max(1, -(-known["feeds"] // FEEDS), -(-known["terms"] // HOT_GRAM))
    text = match_text(title, summary)
    out = []
    for i in range(passes):
        block = _listed(specs.where(F.pmod(F.xxhash64("feed_id"), F.lit(passes)) == i), "feed_id", *roles)
        numbered = block.select(F.posexplode(F.arrays_zip(*roles)).alias("_feed", "_spec"))
        at_terms = numbered.select("_feed", F.inline(F.flatten(F.array(*[_with_role(F.col(f"_spec.{r}"), r) for r in roles]))))
        words = _listed(at_terms.groupBy("term").agg(*[F.collect_list(F.when(F.col("role") == r, F.col("_feed"))).alias(r) for r in roles]), "term", *roles)
        open_feeds = _listed(numbered.where(F.size("_spec.include") == 0), "_feed")

        def at_hits(role: str) -> Column:
            return F.flatten(let(f"_{role}", lambda feeds_of: F.transform("_hits", lambda at: F.get(feeds_of, at))))

        rejected = at_hits("exclude")
        if check_semantics(semantics) == DOCUMENTED:
            rejected = F.array_except(rejected, at_hits("override"))
        held = _with(materialize(_held(items, key, text, words)), _open=open_feeds.scalar(), **{f"_{r}": words.select(r).scalar() for r in roles})
        kept = held.select(key, F.array_except(F.concat("_open", at_hits("include")), rejected).alias("_kept"))
        out.append(materialize(kept).select(key, F.explode("_kept").alias("_feed")).select(key, F.get(block.select("feed_id").scalar(), F.col("_feed")).alias("feed_id")))
    return reduce(DataFrame.unionByName, out)
