"""URL resolution and key building (URL-1 .. URL-4) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import rules
from .text import DOCUMENTED, OBSERVED, check_semantics


def _c(col) -> Column:
    if isinstance(col, Column):
        return col
    return F.col(col)


def origin_of(url_col) -> Column:
    """``scheme://host[:port]`` of an absolute URL ('' when not absolute)."""
    return F.regexp_extract(_c(url_col), r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)


def base_dir_of(url_col) -> Column:
    """Absolute URL of the directory holding the document (no trailing slash); the origin
    when the URL has no path."""
    u = F.regexp_replace(_c(url_col), r"[?#].*$", "")
    return F.when(u.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*$"), u).otherwise(F.regexp_replace(u, r"/[^/]*$", ""))


def resolve_host_relative(href, origin, base_dir, semantics: str = OBSERVED) -> Column:
    """URL-1: ``http*`` as is; ``/x`` -> origin + ``/x``; else base_dir + ``/`` + href
    without leading slashes.  ``observed`` turns ``//cdn/x`` into origin + ``//cdn/x``;
    ``documented`` reads it as protocol-relative."""
    h = _c(href)
    rel = F.concat(F.rtrim(_c(base_dir), F.lit("/")), F.lit("/"), F.ltrim(h, F.lit("/")))
    out = F.when(h.startswith("http"), h)
    if check_semantics(semantics) == DOCUMENTED:
        out = out.when(h.startswith("//"), F.concat(F.lit("https:"), h))
    return out.when(h.startswith("/"), F.concat(_c(origin), h)).otherwise(rel)


def resolve_protocol_relative(href, origin) -> Column:
    """URL-2: ``//x`` -> ``https://x``; ``http*`` as is; else origin + href."""
    h = _c(href)
    return (F.when(h.startswith("//"), F.concat(F.lit("https:"), h))
            .when(h.startswith("http"), h)
            .otherwise(F.concat(_c(origin), h)))


def resolve_image(src, origin) -> Column:
    """Image variant of URL-2 with an exact ``https?://`` test."""
    s = _c(src)
    return (F.when(s.rlike(r"^//"), F.concat(F.lit("https:"), s))
            .when(s.rlike(r"^https?://"), s)
            .otherwise(F.concat(_c(origin), s)))


# Query parameters that only say where a visit came from; pages differ by any other one.
TRACKING_PARAMETER = r"^(utm_[A-Za-z0-9_]*|gclid|fbclid|ref)(=|$)"


def canonical_url(url_col) -> Column:
    """URL identity: the URL without its fragment and without tracking parameters.  All other
    parameters (paging, ids) stay, in order; an empty query loses its ``?``."""
    u = F.regexp_replace(_c(url_col), r"#.*$", "")
    base = F.regexp_extract(u, r"^[^?]*", 0)
    query = F.regexp_extract(u, r"^[^?]*\?(.*)$", 1)
    kept = F.array_join(F.filter(F.split(query, "&"), lambda p: ~p.rlike(TRACKING_PARAMETER)), "&")
    return F.when(kept == "", base).otherwise(F.concat(base, F.lit("?"), kept))


def url_encode(col) -> Column:
    return F.url_encode(_c(col))


def html_listing_key(category, days, order_by) -> Column:
    """URL-3 (HTML models): path category plus ``designCreateSince`` / ``orderBy`` pairs."""
    cat, d, o = _c(category), _c(days), _c(order_by)
    path = F.when((cat.isNotNull()) & (cat != ""),
                  F.concat(F.lit(rules.HTML_SITE + "/en/3d-models/"), cat)).otherwise(F.lit(rules.HTML_SITE + "/en/3d-models"))
    query = F.concat_ws(
        "&",
        F.when((d.isNotNull()) & (d != ""), F.concat(F.lit("designCreateSince="), url_encode(d))),
        F.when((o.isNotNull()) & (o != ""), F.concat(F.lit("orderBy="), url_encode(o))),
    )
    return F.when(query != "", F.concat(path, F.lit("?"), query)).otherwise(path)


def json_listing_key(category) -> Column:
    """URL-3 (JSON models): the public search page of a category."""
    cat = _c(category)
    base = F.lit(rules.JSON_SITE + "/search/models")
    return F.when(cat.isNotNull() & (cat != ""), F.concat(base, F.lit("?category="), cat)).otherwise(base)


def model_uri(model_id, slug) -> Column:
    """URL-4: item link."""
    return F.concat(F.lit(rules.JSON_SITE + "/model/"), _c(model_id).cast("string"), F.lit("-"), _c(slug))


def model_uid(model_id) -> Column:
    return F.concat(F.lit(rules.JSON_UID_PREFIX), _c(model_id).cast("string"))


def media_url(file_path) -> Column:
    return F.concat(F.lit(rules.JSON_MEDIA), _c(file_path))
