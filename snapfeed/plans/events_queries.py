"""Freshness, carry-forward, dates, ordered collection, chain following, positions and
limit-eligible filtering (SRC-2, W-2, DATE-1..3, A-2, A-3, SRC-7, U-2, W-3, F-10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import html as H, text as T, urls as U
from ..operators.ranking import clamp_limit
from ..operators.sequence import ordered_concat as ordered_text
from ..session import checkpoint_dir
from ..sources.snapshots import TTL_NEWS, chain_pages, fresh_snapshot, load_table
from . import derived as X
from . import sqlgen as S
from .catalog import register

TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
_TS_FMT_DUCK = "%Y-%m-%d %H:%M:%S.%f"


FRESH_SQL = f"""
WITH a AS (SELECT max(ts) AS as_of FROM events),
w AS (SELECT * FROM events WHERE ts <= (SELECT as_of FROM a) AND ts >= (SELECT as_of FROM a) - INTERVAL {TTL_NEWS} SECOND)
SELECT user_id, strftime(max(ts), '{_TS_FMT_DUCK}') AS ts, arg_max(value, ts) AS value, arg_max(event_id, ts) AS event_id
FROM w GROUP BY user_id
"""


@register("fresh_snapshot", FRESH_SQL)
def fresh_snapshot_q(spark, sf):
    """SRC-2: newest event per user inside the TTL window ending at the newest event."""
    ev = load_table(spark, sf, "events", ["event_id", "ts", "user_id", "value"])
    as_of = ev.agg(F.max("ts")).scalar()
    fresh = fresh_snapshot(ev, "user_id", "ts", as_of, TTL_NEWS, ["value", "event_id"])
    return fresh.select("user_id", F.date_format("ts", TS_FORMAT).alias("ts"), "value", "event_id")


_IMG_SQL = ("CASE WHEN event_type = 'view' THEN 'img' || CAST(event_id AS VARCHAR) "
            "WHEN event_type = 'error' THEN '' END")


@register("carry_forward", f"""
SELECT event_id, {_IMG_SQL} AS img_documented,
       last_value({_IMG_SQL} IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts, event_id
           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS img_observed
FROM events
""")
def carry_forward(spark, sf):
    """W-2: ``observed`` carries the last image forward per user in time order (an empty
    string blocks it); ``documented`` keeps each row's own value.  Computed as a range-
    partitioned prefix scan (``operators.sequence``), so a hot user is split across tasks."""
    from ..operators.sequence import carry_forward as scan
    ev = load_table(spark, sf, "events", ["event_id", "ts", "user_id", "event_type"])
    img = (F.when(F.col("event_type") == "view", F.concat(F.lit("img"), F.col("event_id").cast("string")))
           .when(F.col("event_type") == "error", F.lit("")))
    e = ev.select("event_id", "ts", "user_id", img.alias("img"))
    filled = scan(e, "user_id", ["ts", "event_id"], "img", "img_observed")
    return filled.select("event_id", F.col("img").alias("img_documented"), "img_observed")


def _date_text_spark():
    k = F.col("event_id") % 5
    return (F.when(k == 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
            .when(k == 1, F.date_format("ts", "MMM d, yyyy"))
            .when(k == 2, F.concat((F.col("event_id") % 9).cast("string"), F.lit(" days ago")))
            .when(k == 3, F.lit("soon"))
            .otherwise(F.date_format("ts", "yyyy/MM/dd")))


@register("parse_dates", """
WITH a AS (SELECT max(ts) AS as_of FROM events),
t AS (SELECT event_id, event_id % 5 AS k, ts FROM events)
SELECT event_id,
  CAST(epoch(CASE WHEN k = 0 THEN date_trunc('second', ts) ELSE (SELECT as_of FROM a) END) AS BIGINT) AS iso_epoch,
  CAST(epoch(CASE WHEN k = 0 THEN date_trunc('second', ts)
                  WHEN k = 1 THEN date_trunc('day', ts)
                  WHEN k = 2 THEN (SELECT as_of FROM a) - to_days(CAST(event_id % 9 AS INTEGER))
                  WHEN k = 4 THEN date_trunc('day', ts)
                  ELSE (SELECT as_of FROM a) END) AS BIGINT) AS multi_epoch
FROM t
""")
def parse_dates(spark, sf):
    """DATE-1 (ISO or default) and DATE-2 (ISO, format list, 'n units ago', default) on
    date texts rendered from the event timestamps in five shapes."""
    ev = load_table(spark, sf, "events", ["event_id", "ts"])
    as_of = ev.agg(F.max("ts")).scalar()
    t = ev.withColumn("txt", _date_text_spark())
    return t.select("event_id",
                    F.unix_timestamp(D.parse_iso("txt", as_of)).alias("iso_epoch"),
                    F.unix_timestamp(D.parse_multi("txt", as_of)).alias("multi_epoch"))


@register("display_date", "SELECT o_orderkey, strftime(o_orderdate, '%b %-d, %Y') AS shown FROM orders")
def display_date(spark, sf):
    orders = load_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    return orders.select("o_orderkey", D.display_date("o_orderdate").alias("shown"))


@register("ordered_collect", f"""
SELECT conv_id, array_to_string(list(role ORDER BY turn) FILTER (WHERE {S.trim_all('role')} <> ''), ',') AS roles,
       CAST(count(*) AS BIGINT) AS turns
FROM conversations GROUP BY conv_id
""")
def ordered_collect(spark, sf):
    """A-2: per conversation, roles in turn order with blanks dropped; a long conversation is sorted and joined in ranges."""
    conv = load_table(spark, sf, "conversations", ["conv_id", "turn", "role"])
    kept = conv.withColumn("role", F.when(T.trim_all("role") != "", F.col("role")))
    return ordered_text(kept, "conv_id", ["turn"], "role", ",", "roles").select("conv_id", "roles", F.col("n").alias("turns"))


@register("ordered_concat", """
SELECT conv_id, string_agg(text, chr(10) ORDER BY turn) AS transcript FROM conversations GROUP BY conv_id
""")
def ordered_concat(spark, sf):
    """A-3: per conversation, turn texts joined in order; a long conversation is sorted and joined in ranges."""
    conv = load_table(spark, sf, "conversations", ["conv_id", "turn", "text"])
    return ordered_text(conv, "conv_id", ["turn"], "text", "\n", "transcript").select("conv_id", "transcript")


# ------------------------------------------------------------------------------------- SRC-7 / U-2

_FIRST_LINK = f"coalesce(({S.links(S.content_html('html'))})[1].href, '')"
_NEXT_SQL = (f"CASE WHEN {_FIRST_LINK} = '' THEN NULL WHEN starts_with({_FIRST_LINK}, 'http') THEN {_FIRST_LINK} "
             f"WHEN starts_with({_FIRST_LINK}, '/') THEN regexp_extract(url, '^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)', 1) || {_FIRST_LINK} "
             f"ELSE rtrim({S.base_dir('url')}, '/') || '/' || ltrim({_FIRST_LINK}, '/') END")
MAX_HOPS = 3


@register("follow_chain", f"""
WITH RECURSIVE n AS (SELECT max(page_id) AS page_id FROM pages GROUP BY {S.canonical('url')}),
p AS (SELECT page_id, url, {S.canonical('url')} AS canon, {_NEXT_SQL} AS nxt FROM ({X.LINKED_PAGES_SQL}) SEMI JOIN n USING (page_id)),
chain(chain, hop, page_id, nxt) AS (
  SELECT s.canon, 1, p.page_id, p.nxt FROM (SELECT DISTINCT canon FROM p) s JOIN p ON s.canon = p.canon
  UNION ALL
  SELECT c.chain, c.hop + 1, p.page_id, p.nxt FROM chain c JOIN p ON {S.canonical('c.nxt')} = p.canon
  WHERE c.hop < {MAX_HOPS} AND c.nxt IS NOT NULL AND c.nxt <> '')
SELECT chain, CAST(hop AS INTEGER) AS hop, page_id FROM chain
""")
def follow_chain_q(spark, sf):
    """SRC-7 + U-2: from the newest snapshot of every URL follow its first link (resolved) for
    up to MAX_HOPS pages; the union of hops is the crawl.  Pages are read once, where they lie; the link table is
    narrow and checkpointed."""
    first = F.try_element_at(H.link_hrefs(H.content_html("html")), F.lit(1))
    nxt = F.when(first != "", U.resolve_host_relative(first, U.origin_of("url"), U.base_dir_of("url")))
    links = X.linked_pages(spark, sf).select(U.canonical_url("url").alias("canon"), "page_id", U.canonical_url(nxt).alias("next_canon"))
    checkpoint_dir(spark)
    links = links.groupBy("canon").agg(F.max("page_id").alias("page_id"), F.max_by("next_canon", "page_id").alias("next_canon")).checkpoint(eager=True)
    reached = chain_pages(links.select("canon", "next_canon"), links.select(F.col("canon").alias("seed"), "canon"), MAX_HOPS)
    return reached.join(links.select("canon", "page_id"), "canon").select(F.col("seed").alias("chain"), F.col("hop").cast("int").alias("hop"), "page_id")


# ------------------------------------------------------------------------------------- W-3 / F-10

LINK_LIMIT = 3


@register("feed_position", f"""
SELECT page_id AS listing_id, CAST(unnest(range(0, len(h))) AS BIGINT) AS pos, unnest(h) AS href
FROM (SELECT page_id, list_filter(list_transform({S.links(S.content_html('html'))}, lambda k: k.href), lambda x: x <> '') AS h FROM pages)
""")
def feed_position(spark, sf):
    """W-3: append position of each usable link inside its listing page (row-local
    ``posexplode``; no global window)."""
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    hrefs = F.filter(H.link_hrefs(H.content_html("html")), lambda h: h != "")
    return pages.select(F.col("page_id").alias("listing_id"), F.posexplode(hrefs).alias("pos", "href")) \
        .select("listing_id", F.col("pos").cast("bigint").alias("pos"), "href")


@register("limit_nonblank", f"""
WITH l AS (SELECT page_id,
  list_filter(list_transform({S.links(S.content_html('html'))}, lambda k: {S.trim_all(S.strip_tags('k.text'))}), lambda t: t <> '') AS ts FROM pages),
k AS (SELECT page_id, ts[1:{LINK_LIMIT}] AS ts FROM l)
SELECT page_id, CAST(unnest(range(0, len(ts))) AS BIGINT) AS pos, unnest(ts) AS title FROM k
""")
def limit_nonblank(spark, sf):
    """F-10 + T-3: the first ``limit`` links with a non-blank title per listing page; blank
    titles do not use up the limit.  Row-local ``filter`` + ``slice``: no window, no shuffle."""
    pages = load_table(spark, sf, "pages", ["page_id", "html"])
    titles = F.transform(H.links(H.content_html("html")), lambda a: T.trim_all(T.strip_tags(a["text"])))
    kept = F.slice(F.filter(titles, lambda t: t != ""), 1, clamp_limit(LINK_LIMIT))
    return pages.select("page_id", F.posexplode(kept).alias("pos", "title")) \
        .select("page_id", F.col("pos").cast("bigint").alias("pos"), "title")
