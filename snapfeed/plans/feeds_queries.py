"""Feed parameters as data (PRM-1, NAME-1, URL-2, URL-3), the feed sink with its check (SNK-1, SRC-6), and items published once (ST-2)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import rules, text as T, urls as U
from ..operators import ranking as R
from ..sources.snapshots import load_table, write_feed
from ..streaming import incremental as ST
from . import sqlgen as S
from .catalog import register

# One feed a customer, its parameters from the customer's number: known, unknown, empty and missing ones.
_HTML = {
    "category": "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '302' WHEN 3 THEN 'nonsense' WHEN 4 THEN '317' ELSE '305' END",
    "days": "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '30' WHEN 3 THEN '90' ELSE '31' END",
    "orderBy": "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'oldest' WHEN 2 THEN 'latest' WHEN 3 THEN 'mostCollected' ELSE 'hotScore' END",
    "limit": "CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN '0' WHEN 2 THEN '17' ELSE '99' END",
}
_JSON = {
    "category": "CASE c_custkey % 6 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN '31' WHEN 3 THEN '300' WHEN 4 THEN '94' ELSE '12' END",
    "days": "CASE c_custkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '8' WHEN 2 THEN '30' ELSE '90' END",
    "sort": "CASE c_custkey % 7 WHEN 0 THEN NULL WHEN 1 THEN 'odd' WHEN 2 THEN 'newest' ELSE 'likes' END",
    "limit": "CASE c_custkey % 4 WHEN 0 THEN 'x' WHEN 1 THEN '-3' WHEN 2 THEN '50' ELSE '51' END",
}


def _columns(rule: dict[str, str], quote: str) -> str:
    return ", ".join(["CAST(c_custkey AS BIGINT) AS feed_id", *(f"{sql} AS {quote}{name}{quote}" for name, sql in rule.items())])


def _values(pairs) -> str:
    return "(VALUES " + ", ".join(f"({S.q(label)}, {S.q(code)})" for label, code in pairs if code is not None) + ") AS v(label, code)"


def _known(column: str, pairs) -> str:
    return f"{column} IN ({', '.join(S.q(code) for _, code in pairs if code is not None)})"


_LIMIT_SQL = 'least(50, greatest(1, coalesce(TRY_CAST("limit" AS INTEGER), 0)))'


@register("html_feed_parameters", f"""
WITH f AS (SELECT {_columns(_HTML, '"')} FROM customer),
d AS (SELECT *, coalesce(category, '300') AS cat, coalesce(days, '7') AS d, coalesce("orderBy", 'hotScore') AS o FROM f)
SELECT feed_id, CASE WHEN NOT {_known('cat', rules.HTML_CATEGORIES)} THEN 'unknown category' WHEN NOT {_known('d', rules.HTML_DAYS)} THEN 'unknown days'
                     WHEN NOT {_known('o', rules.HTML_SORTS)} THEN 'unknown orderBy' ELSE '' END AS reason, {_LIMIT_SQL} AS limit_v,
       {S.q(rules.HTML_FEED_NAME)} || CASE WHEN coalesce(category, '') = '' THEN ' - All Categories' WHEN label IS NOT NULL THEN ' - ' || label ELSE '' END
         || CASE WHEN coalesce(days, '') <> '' THEN ' (Last ' || days || ' days)' ELSE '' END AS name,
       {S.q(rules.HTML_SITE)} || '/en/3d-models' || CASE WHEN cat <> '' THEN '/' || cat ELSE '' END || CASE WHEN d <> '' THEN '?designCreateSince=' || d || '&' ELSE '?' END
         || 'orderBy=' || o AS listing
FROM d LEFT JOIN {_values(rules.HTML_CATEGORIES[1:])} ON code = category
""")
def html_feed_parameters(spark, sf):
    """PRM-1, NAME-1 and URL-3 of the HTML generator: each feed's reason to be refused (empty: none), clamped limit, name and listing."""
    feeds = load_table(spark, sf, "customer", ["c_custkey"]).select(*[F.expr(sql).alias(name) for name, sql in {"feed_id": "CAST(c_custkey AS BIGINT)", **_HTML}.items()])
    good, bad = R.validate_html_feeds(feeds)
    every = good.withColumn("reason", F.lit("")).unionByName(bad)
    return every.select("feed_id", "reason", "limit_v", R.html_feed_name("category", "days").alias("name"),
                        U.html_listing_key("category_v", "days_v", "order_v").alias("listing"))


@register("json_feed_parameters", f"""
WITH f AS (SELECT {_columns(_JSON, '"')} FROM customer),
d AS (SELECT *, coalesce(days, '7') AS d, coalesce(sort, 'trending') AS s FROM f)
SELECT feed_id, CASE WHEN coalesce(category, '') <> '' AND NOT {_known('category', rules.JSON_CATEGORIES)} THEN 'unknown category'
                     WHEN NOT {_known('d', rules.JSON_DAYS)} THEN 'unknown days' WHEN NOT {_known('s', rules.JSON_SORTS)} THEN 'unknown sort' ELSE '' END AS reason,
       {_LIMIT_SQL} AS limit_v, {S.q(rules.JSON_FEED_NAME_PREFIX)} || 'Trending in ' || CASE WHEN coalesce(category, '') = '' THEN 'All Categories' ELSE label END
         || ' (Last ' || coalesce(days, '') || ' days)' AS name,
       {S.q(rules.JSON_SITE)} || '/search/models' || CASE WHEN coalesce(category, '') <> '' THEN '?category=' || category ELSE '' END AS listing
FROM d LEFT JOIN {_values(rules.JSON_CATEGORIES)} ON code = category
""")
def json_feed_parameters(spark, sf):
    """PRM-1, NAME-1 and URL-3 of the JSON generator."""
    feeds = load_table(spark, sf, "customer", ["c_custkey"]).select(*[F.expr(sql).alias(name) for name, sql in {"feed_id": "CAST(c_custkey AS BIGINT)", **_JSON}.items()])
    good, bad = R.validate_json_feeds(feeds)
    every = good.withColumn("reason", F.lit("")).unionByName(bad)
    return every.select("feed_id", "reason", "limit_v", R.json_feed_name("category", "days", "sort").alias("name"), U.json_listing_key("category").alias("listing"))


@register("feed_sink", f"""
SELECT lang AS feed, doc_id, {S.trim_all("split_part(text, chr(10), 1)")} AS title FROM documents
""")
def feed_sink(spark, sf):
    """SNK-1 + SRC-6: documents written as items, partitioned by feed, their rows counted by the writing job itself, and read back."""
    docs = load_table(spark, sf, "documents", ["doc_id", "lang", "text"])
    items = docs.select(F.col("lang").alias("feed"), "doc_id", T.trim_all(F.substring_index("text", "\n", 1)).alias("title"))
    path = ST.scratch_path(spark, "feed-sink")
    write_feed(items, path, nonempty="No items found.")
    return spark.read.schema(items.schema).parquet(path).select("feed", "doc_id", "title")


@register("publish_items_once", f"SELECT DISTINCT {S.q(rules.JSON_UID_PREFIX)} || CAST(o_custkey AS VARCHAR) AS item_uid FROM orders")
def publish_items_once(spark, sf):
    """ST-2 on items: each item is published once by its uid, in event time of its stamp (orders of a customer as versions of one item)."""
    orders = ST.read_table_stream(spark, sf, "orders")
    items = orders.select(U.model_uid("o_custkey").alias("uid"), F.lit(None).cast("string").alias("uri"),
                          F.unix_timestamp(F.col("o_orderdate").cast("timestamp")).alias("timestamp"))
    once = ST.publish_items_once(items, "30 days", uid_col="uid").select("item_uid")
    sink = ST.scratch_path(spark, "items-sink")
    ST.run_available(once, sink, ST.scratch_path(spark, "items-ckpt"))
    return spark.read.parquet(sink)
