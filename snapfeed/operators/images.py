"""Image choice (IMG-1 .. IMG-4) over matches of ``nodes.extract`` and URL columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import rules
from ..functions.text import DOCUMENTED, OBSERVED, check_semantics, let
from ..functions.urls import resolve_host_relative, resolve_image
from .nodes import Want, attr, attr_fallback

_SRCSET_PAIR = r"(\S+)\s+(\d+)w"


def best_srcset(srcset) -> Column:
    """IMG-1: widest ``url NNNw`` candidate; the first one wins ties; null when none."""
    s = F.col(srcset) if isinstance(srcset, str) else srcset
    urls = F.regexp_extract_all(s, F.lit(_SRCSET_PAIR), 1)
    widths = F.regexp_extract_all(s, F.lit(_SRCSET_PAIR), 2)
    ranked = F.transform(F.arrays_zip(urls.alias("u"), widths.alias("w")),
                         lambda x, i: F.struct((-x["w"].cast("long")).alias("nw"), i.alias("i"), x["u"].alias("u")))
    return F.try_element_at(F.array_sort(ranked), F.lit(1))["u"]


def valid_image(url, blocklist=None) -> Column:
    """IMG-2: no block-listed substring in the lower-cased URL."""
    u = F.lower(F.col(url) if isinstance(url, str) else url)
    return ~reduce(lambda a, b: a | b, [u.contains(p) for p in (blocklist if blocklist is not None else rules.IMAGE_URL_BLOCKLIST)], F.lit(False))


def image_url(node: Column, semantics: str = OBSERVED) -> Column:
    """The widest ``srcset`` candidate where there is a ``srcset``, else ``src``.  ``documented`` also falls back to ``src``
    where no candidate has a width."""
    srcset, src = attr(node, "srcset"), F.nullif(attr(node, "src"), F.lit(""))
    best = best_srcset(srcset)
    if check_semantics(semantics) == DOCUMENTED:
        best = F.coalesce(best, src)
    return F.when(F.coalesce(srcset, F.lit("")) != "", best).otherwise(src)


def no_ad_ancestor(node: Column, semantics: str = OBSERVED) -> Column:
    """Whether no ancestor is an advert container: ``observed`` by "ad" anywhere in its classes, ``documented`` by a class of its own."""
    if semantics == OBSERVED:
        return ~F.exists(node["around"], lambda classes: F.lower(F.array_join(classes, " ")).contains("ad"))
    return ~F.exists(node["around"], lambda classes: F.exists(classes, lambda c: F.lower(c).rlike(r"^(ad|ads|advert.*|ad-.*)$")))


def hero_wants(prefix: str = "hero") -> dict[str, Want]:
    """The requests of ``pick_hero``: the first image of each hero selector, all images of each content selector."""
    out = {f"{prefix}{i}": Want(s, ("attrs",), first=True) for i, s in enumerate(rules.HERO_IMAGE_SELECTORS)}
    return out | {f"{prefix}_content{i}": Want(s, ("attrs", "around")) for i, s in enumerate(rules.CONTENT_IMAGE_SELECTORS)}


def pick_hero(origin: Column, base_dir: Column, semantics: str = OBSERVED, prefix: str = "hero") -> Column:
    """IMG-3 over the columns of ``hero_wants``: the first valid image of the hero selectors (only the first match of each is
    tried), else the first valid content image outside ad containers; made absolute."""
    def usable(url: Column) -> Column:
        return F.coalesce((url != "") & valid_image(url), F.lit(False))

    def url_of(node: Column) -> Column:
        return image_url(node, semantics)

    # The hero matches in order, then the content images that are not adverts; each URL is worked out once.
    heroes = F.filter(F.array(*[F.col(f"{prefix}{i}") for i in range(len(rules.HERO_IMAGE_SELECTORS))]), lambda n: n.isNotNull())
    content = [F.filter(F.col(f"{prefix}_content{i}"), lambda n: no_ad_ancestor(n, semantics)) for i in range(len(rules.CONTENT_IMAGE_SELECTORS))]
    urls = F.concat(F.transform(heroes, url_of), *[F.transform(c, url_of) for c in content])
    return let(F.try_element_at(F.filter(urls, usable), F.lit(1)), lambda url: F.when(url.isNotNull(), resolve_host_relative(url, origin, base_dir, semantics)))


def hero_image(df: DataFrame, origin: Column, base_dir: Column, out: str = "image", semantics: str = OBSERVED, prefix: str = "hero") -> DataFrame:
    """IMG-3 as a DataFrame step: the columns of ``hero_wants`` become the image's URL."""
    return df.withColumn(out, pick_hero(origin, base_dir, semantics, prefix)).drop(*hero_wants(prefix))


#: The requests of ``page_image``.
PAGE_IMAGE_WANTS = {"og_image": Want("meta[property=og:image]", ("attrs",), first=True),
                    "media_image": Want(rules.MODEL_IMAGE_SELECTOR, ("attrs",), first=True)}


def page_image(origin: Column, semantics: str = OBSERVED) -> Column:
    """IMG-4 over the columns of ``PAGE_IMAGE_WANTS``: ``og:image`` meta content, else the first media/gallery image (``src``
    then ``data-src``); made absolute with the protocol-relative rules."""
    og, img = F.col("og_image"), F.col("media_image")
    raw = F.when(og.isNotNull(), attr(og, "content")).when(img.isNotNull(), attr_fallback(img, "src", "data-src"))
    return F.when(raw.isNotNull() & (raw != ""), resolve_image(raw, origin))
