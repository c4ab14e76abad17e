"""Model generators as Spark jobs over ``part`` (list records) joined with ``lineitem``
activity (popularity) and ``documents`` (detail descriptions): ranking, limits, filters,
description rendering, URIs, lookups and record merge (T-1..T-4, A-5, F-8..F-11, J-2, J-4,
J-6, MAP-1, STR-13/14/16, URL-4, ARR-1/2, SRC-3/4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import rules, text as T, urls as U
from ..functions.cleaners import clean_description
from ..operators.dedup import materialize
from ..operators import ranking as R
from ..operators import records as M
from ..sources.snapshots import load_table
from . import sqlgen as S
from .catalog import register

TOP_N = 20
TOP_K = 5


def model_records(spark, sf) -> DataFrame:
    """One record per part: list fields from ``part``, counters from ``lineitem``.

    ``as_of`` = newest ship date, a scalar subquery (no driver round trip, no cross join).
    The lineitem aggregation is partial before its shuffle; the part side is then joined on
    the same key."""
    part = load_table(spark, sf, "part", ["p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"])
    li = load_table(spark, sf, "lineitem", ["l_partkey", "l_quantity", "l_shipdate", "l_returnflag", "l_linestatus"])
    as_of = li.agg(F.max("l_shipdate")).scalar()
    stats = (
        li.groupBy("l_partkey").agg(
            F.count(F.lit(1)).alias("likes"),
            F.sum("l_quantity").cast("bigint").alias("downloads"),
            F.count_if(F.col("l_shipdate") > as_of - F.make_interval(days=F.lit(7))).alias("likes_7d"),
            F.min("l_shipdate").alias("published"),
            # "collected" stand-in: fulfilled line items; algebraic, so no extra shuffle
            F.count_if(F.col("l_linestatus") == "F").alias("collected"),
            F.array_sort(F.collect_set("l_returnflag")).alias("tags")))
    rec = part.join(stats, part.p_partkey == stats.l_partkey, "left")
    likes = F.coalesce("likes", F.lit(0))
    return rec.select(
        F.col("p_partkey").alias("id"), F.col("p_name").alias("name"),
        F.replace(F.lower("p_name"), F.lit(" "), F.lit("-")).alias("slug"),
        F.col("p_type").alias("category"), F.col("p_brand").alias("user"),
        likes.alias("likes"), F.coalesce("downloads", F.lit(0)).alias("downloads"),
        F.coalesce("likes_7d", F.lit(0)).alias("likes_7d"), F.col("published"),
        F.coalesce("likes_7d", F.lit(0)).alias("hot_score"), F.coalesce("collected", F.lit(0)).alias("collected"),
        F.coalesce("tags", F.array().cast("array<string>")).alias("tags"),
        (((likes * 7 + F.col("p_size")) % 51).cast("decimal(10,0)") / 10).cast("decimal(10,1)").alias("rating"),
        (F.col("p_size") % 3 == 0).alias("verified"), (F.col("p_size") % 7).alias("level"),
        M.feature_flags(F.col("p_size") % 2 == 0, F.col("p_size") % 5 == 0, F.col("p_retailprice") > 1500,
                        F.col("p_size") > 45).alias("flags"),
        F.array(F.struct(F.col("p_type").alias("name")), F.struct(F.col("p_brand").alias("name"))).alias("path_s"),
        F.when(F.col("p_size") % 4 != 0, F.concat(F.lower("p_brand"), F.lit("/"), F.col("p_partkey").cast("string"),
                                                  F.lit(".png"))).alias("image"),
        F.concat(F.col("p_name"), F.lit(" by "), F.col("p_brand")).alias("summary"),
    )


def _records_sql() -> str:
    flags = ("list_filter([CASE WHEN p_size % 2 = 0 THEN 'Multi-Material' END, "
             "CASE WHEN p_size % 5 = 0 THEN 'AI Generated' END, CASE WHEN p_retailprice > 1500 THEN 'Premium' END, "
             "CASE WHEN p_size > 45 THEN 'NSFW' END], lambda x: x IS NOT NULL)")
    return f"""
asof_t AS (SELECT max(l_shipdate) AS a FROM lineitem),
stats AS (SELECT l_partkey, count(*) AS likes, CAST(sum(l_quantity) AS BIGINT) AS downloads,
                 count(*) FILTER (WHERE l_shipdate > (SELECT a FROM asof_t) - INTERVAL 7 DAY) AS likes_7d,
                 min(l_shipdate) AS published, count(*) FILTER (WHERE l_linestatus = 'F') AS collected,
                 list_sort(list_distinct(list(l_returnflag))) AS tags
          FROM lineitem GROUP BY l_partkey),
rec AS (SELECT p_partkey AS id, p_name AS name, replace(lower(p_name), ' ', '-') AS slug, p_type AS category,
               p_brand AS "user", coalesce(likes, 0) AS likes, coalesce(downloads, 0) AS downloads,
               coalesce(likes_7d, 0) AS likes_7d, published, coalesce(tags, []::VARCHAR[]) AS tags,
               coalesce(likes_7d, 0) AS hot_score, coalesce(collected, 0) AS collected,
               ((coalesce(likes, 0) * 7 + p_size) % 51) AS rating10,
               (p_size % 3 = 0) AS verified, (p_size % 7) AS level, {flags} AS flags,
               [p_type, p_brand] AS path,
               CASE WHEN p_size % 4 <> 0 THEN lower(p_brand) || '/' || CAST(p_partkey AS VARCHAR) || '.png' END AS image,
               p_name || ' by ' || p_brand AS summary
        FROM part LEFT JOIN stats ON p_partkey = l_partkey)"""


def _rating_sql(x: str = "rating10") -> str:
    return f"format('{{:,.1f}}', {x} / 10.0)"


# ------------------------------------------------------------------------------------- STR-16 / STR-15

def _clean_description_sql(x: str) -> str:
    c = S.rx(x, r"\s+", " ")
    plain = c
    cap = (f"(CASE WHEN length({plain}) > {rules.DESCRIPTION_CAP} THEN '<p>' || "
           f"{S.html_escape(S.cut_last_space(f'substring({plain}, 1, {rules.DESCRIPTION_CAP})'))} || '...</p>' ELSE {c} END)")
    return S.trim_all(cap)


def _describe_sql() -> str:
    stats = ("concat_ws(', ', CASE WHEN likes > 0 THEN format('{:,}', likes) || ' likes' END, "
             "CASE WHEN downloads > 0 THEN format('{:,}', downloads) || ' downloads' END, "
             f"CASE WHEN rating10 > 0 THEN {_rating_sql()} || '/5.0 rating' END)")
    creator = ("\"user\" || CASE WHEN verified THEN ' (Verified)' ELSE '' END || "
               "CASE WHEN level <> 0 THEN ' - Level ' || CAST(level AS VARCHAR) ELSE '' END")
    meta = ("concat_ws(' | ', CASE WHEN published IS NOT NULL THEN 'Published: ' || strftime(published, '%b %-d, %Y') END, "
            "CASE WHEN len(path) > 0 THEN 'Category: ' || array_to_string(path, ' > ') END, "
            "CASE WHEN len(tags) > 0 THEN 'Tags: ' || array_to_string(tags, ', ') END, "
            "CASE WHEN len(flags) > 0 THEN 'Features: ' || array_to_string(flags, ', ') END, "
            f"CASE WHEN \"user\" IS NOT NULL THEN 'Creator: ' || {creator} END)")
    desc = _clean_description_sql("description")
    body = (f"concat_ws('', '<p>' || {S.html_escape(S.trim_all(S.strip_tags('summary')))} || '</p>', "
            f"CASE WHEN description IS NOT NULL AND description <> '' AND {desc} <> '' THEN {desc} END, "
            f"CASE WHEN {stats} <> '' THEN '<p>Stats: ' || {stats} || '</p>' END, "
            f"CASE WHEN {meta} <> '' THEN '<p>' || {meta} || '</p>' END)")
    img = (f"CASE WHEN image IS NOT NULL AND image <> '' THEN '<img src=\"' || "
           f"{S.html_escape(S.q(rules.JSON_MEDIA) + ' || image')} || '\" alt=\"' || {S.html_escape('name')} || '\">' ELSE '' END")
    return f"""
WITH {_records_sql()},
d AS (SELECT rec.*, documents.text AS description FROM rec LEFT JOIN documents ON documents.doc_id = rec.id)
SELECT id, '<div class="{rules.JSON_CONTENT_CLASS}">' || {img} || (CASE WHEN ({body}) = '' THEN {S.q(rules.MODEL_FALLBACK_SENTENCE)} ELSE ({body}) END) || '</div>' AS content
FROM d
"""


def _describe_cols(df: DataFrame) -> dict:
    return dict(summary=F.col("summary"), description=F.col("description"), likes=F.col("likes"),
                downloads=F.col("downloads"), rating=F.col("rating"), published=F.col("published"),
                path=M.names_of("path_s"), tags=F.col("tags"), flags=F.col("flags"), user=F.col("user"),
                verified=F.col("verified"), level=F.col("level"))


@register("describe_model", _describe_sql())
def describe_model(spark, sf):
    rec = model_records(spark, sf)
    # Clean every detail description where the detail rows already are (spread over all
    # cores), then join: the join output may sit on few partitions (a small list side).
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    details = materialize(docs.select("doc_id", F.col("text").alias("description"),
                                      clean_description(F.col("text")).alias("description_clean")))
    d = rec.join(details, rec.id == details.doc_id, "left")
    cols = dict(_describe_cols(d), description_clean=F.col("description_clean"))
    return d.select("id", M.render_model("name", "image", M.describe_model(cols)).alias("content"))


# ------------------------------------------------------------------------------------- STR-13/14, URL-4, ARR

@register("format_stats", f"""
WITH {_records_sql()}
SELECT id, concat_ws(', ', CASE WHEN likes > 0 THEN format('{{:,}}', likes) || ' likes' END,
                     CASE WHEN downloads > 0 THEN format('{{:,}}', downloads) || ' downloads' END,
                     CASE WHEN rating10 > 0 THEN {_rating_sql()} || '/5.0 rating' END) AS stats
FROM rec
""")
def format_stats(spark, sf):
    r = model_records(spark, sf)
    stats = F.concat_ws(", ",
                        F.when(F.col("likes") > 0, F.concat(T.format_int("likes"), F.lit(" likes"))),
                        F.when(F.col("downloads") > 0, F.concat(T.format_int("downloads"), F.lit(" downloads"))),
                        F.when(F.col("rating") > 0, F.concat(T.format_1dp("rating"), F.lit("/5.0 rating"))))
    return r.select("id", stats.alias("stats"))


@register("item_uri", f"""
WITH {_records_sql()}
SELECT id, {S.q(rules.JSON_SITE + '/model/')} || CAST(id AS VARCHAR) || '-' || slug AS uri,
       {S.q(rules.JSON_UID_PREFIX)} || CAST(id AS VARCHAR) AS uid,
       CASE WHEN image IS NOT NULL THEN {S.q(rules.JSON_MEDIA)} || image END AS image_url
FROM rec
""")
def item_uri(spark, sf):
    r = model_records(spark, sf)
    return r.select("id", U.model_uri("id", "slug").alias("uri"), U.model_uid("id").alias("uid"),
                    U.media_url("image").alias("image_url"))


@register("flags_array", f"WITH {_records_sql()} SELECT id, array_to_string(flags, ', ') AS flags FROM rec")
def flags_array(spark, sf):
    return model_records(spark, sf).select("id", F.array_join("flags", ", ").alias("flags"))


@register("path_names", f"WITH {_records_sql()} SELECT id, array_to_string(path, ' > ') AS path FROM rec")
def path_names(spark, sf):
    return model_records(spark, sf).select("id", F.array_join(M.names_of("path_s"), " > ").alias("path"))


# ------------------------------------------------------------------------------------- A-5, T-1..T-4

@register("popularity", f"WITH {_records_sql()} SELECT id, likes, downloads, likes_7d FROM rec WHERE likes > 0")
def popularity(spark, sf):
    return model_records(spark, sf).where(F.col("likes") > 0).select("id", "likes", "downloads", "likes_7d")


@register("trending_topk", f"""
WITH {_records_sql()}
SELECT id, name, likes_7d FROM rec ORDER BY likes_7d DESC, id ASC LIMIT {TOP_N}
""")
def trending_topk(spark, sf):
    r = model_records(spark, sf)
    return R.top_n(r, R.metric_for("trending", R.JSON_METRICS), "id", TOP_N).select("id", "name", "likes_7d")


@register("ranked_latest", f"""
WITH {_records_sql()}
SELECT id, strftime(published, '%Y-%m-%d %H:%M:%S') AS published FROM rec
ORDER BY published DESC NULLS LAST, id ASC LIMIT {TOP_N}
""")
def ranked_latest(spark, sf):
    r = model_records(spark, sf)
    top = R.top_n(r, R.metric_for("newest", R.JSON_METRICS), "id", TOP_N)
    return top.select("id", F.date_format("published", "yyyy-MM-dd HH:mm:ss").alias("published"))


@register("topk_per_category", f"""
WITH {_records_sql()}
SELECT category, CAST(rk AS INTEGER) AS rank, id, likes FROM (
  SELECT category, id, likes, row_number() OVER (PARTITION BY category ORDER BY likes DESC, id ASC) AS rk FROM rec)
WHERE rk <= {TOP_K}
""")
def topk_per_category(spark, sf):
    r = model_records(spark, sf)
    return R.top_k_per_group(r, "category", "likes", "id", TOP_K).select("category", "rank", "id", "likes")


# ------------------------------------------------------------------------------------- F-8..F-11, J-6, J-4

@register("category_filter", "SELECT p_partkey FROM part WHERE p_type = 'PROMO'")
def category_filter(spark, sf):
    part = load_table(spark, sf, "part", ["p_partkey", "p_type"])
    return R.category_filter(part, "p_type", "PROMO").select("p_partkey")


@register("age_filter", """
SELECT o_orderkey FROM orders WHERE o_orderdate > (SELECT max(o_orderdate) FROM orders) - INTERVAL 30 DAY
""")
def age_filter(spark, sf):
    orders = load_table(spark, sf, "orders", ["o_orderkey", "o_orderdate"])
    as_of = orders.agg(F.max("o_orderdate")).scalar()
    return R.age_filter(orders, "o_orderdate", as_of, 30).select("o_orderkey")


@register("facet_filter", """
SELECT p_partkey FROM part WHERE p_type IN ('SMALL', 'MEDIUM') AND p_size BETWEEN 10 AND 30 AND p_retailprice >= 950
""")
def facet_filter(spark, sf):
    part = load_table(spark, sf, "part", ["p_partkey", "p_type", "p_size", "p_retailprice"])
    return R.facet_filter(part, any_of={"p_type": ["SMALL", "MEDIUM"]},
                          ranges={"p_size": (10, 30), "p_retailprice": (950, None)}).select("p_partkey")


@register("facet_arrays", """
SELECT p_partkey FROM part
WHERE list_has_any(string_split(p_name, ' '), ['widget', 'red']) AND p_size % 2 = 1
""")
def facet_arrays(spark, sf):
    """F-11 over an array column (words of the name) and a flag (odd size)."""
    part = load_table(spark, sf, "part", ["p_partkey", "p_name", "p_size"])
    pieces = part.withColumn("pieces", F.split("p_name", " ")).withColumn("odd", F.col("p_size") % 2 == 1)
    return R.facet_filter(pieces, any_of={"pieces": ["widget", "red"]}, flags={"odd": True}).select("p_partkey")


# One feed a supplier, its parameters from the supplier's number; two in eleven are over all categories.
_FEED_COLUMNS = {
    "feed_id": "CAST(s_suppkey AS BIGINT)",
    "category": "CASE s_suppkey % 11 WHEN 0 THEN '' WHEN 1 THEN NULL WHEN 2 THEN '5-LOW' WHEN 3 THEN 'none such' ELSE '1-URGENT' END",
    "days": "CASE s_suppkey % 3 WHEN 0 THEN 30 WHEN 1 THEN 90 ELSE NULL END",
    "ordering": "CASE s_suppkey % 5 WHEN 0 THEN 'newest' WHEN 1 THEN 'price' ELSE 'unknown' END",
}
_FEEDS = "SELECT " + ", ".join(f"{c} AS {name}" for name, c in _FEED_COLUMNS.items()) + ', s_suppkey % 70 AS "limit" FROM supplier'


@register("top_k_for_feeds", f"""
WITH feeds AS ({_FEEDS}),
met AS (SELECT f.feed_id, least(50, greatest(1, f."limit")) AS k, o.o_orderkey,
               CASE f.ordering WHEN 'newest' THEN CAST(epoch(CAST(o_orderdate AS TIMESTAMP)) AS DOUBLE) ELSE CAST(o_totalprice AS DOUBLE) END AS metric
        FROM feeds f JOIN orders o ON (coalesce(f.category, '') = '' OR f.category = o.o_orderpriority)
        WHERE f.days IS NULL OR o_orderdate > (SELECT max(o_orderdate) FROM orders) - to_days(f.days))
SELECT feed_id, CAST(rank AS INTEGER) AS rank, o_orderkey
FROM (SELECT *, row_number() OVER (PARTITION BY feed_id ORDER BY metric DESC, o_orderkey) AS rank FROM met) WHERE rank <= k
""")
def top_k_for_feeds(spark, sf):
    """Parameter sets of many feeds from a table: category, age, ordering and limit reach the result."""
    feeds = load_table(spark, sf, "supplier", ["s_suppkey"]).selectExpr(
        *[f"{c} AS {name}" for name, c in _FEED_COLUMNS.items()], "CAST(s_suppkey % 70 AS STRING) AS limit")
    orders = load_table(spark, sf, "orders", ["o_orderkey", "o_orderdate", "o_orderpriority", "o_totalprice"])
    orders = orders.withColumn("published", F.unix_timestamp(F.col("o_orderdate").cast("timestamp")))
    as_of = orders.agg(F.max("o_orderdate")).scalar()
    return R.top_k_for_feeds(orders, feeds, "o_orderpriority", "o_orderdate", as_of, {"price": "o_totalprice", "newest": "published"}, "o_orderkey")


@register("exclude_ids", """
SELECT p_partkey FROM part WHERE p_partkey NOT IN (SELECT l_partkey FROM lineitem WHERE l_quantity >= 50 AND l_partkey IS NOT NULL)
""")
def exclude_ids(spark, sf):
    part = load_table(spark, sf, "part", ["p_partkey"])
    li = load_table(spark, sf, "lineitem", ["l_partkey", "l_quantity"])
    ex = li.where(F.col("l_quantity") >= 50).select("l_partkey")
    return R.facet_filter(part, exclude_ids=ex, id_col="p_partkey").select("p_partkey")


@register("category_name", """
SELECT s_suppkey, n_name, r_name FROM supplier
LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
""")
def category_name(spark, sf):
    """J-4: code -> name lookups against fixed-size dimensions (25 nations, 5 regions);
    their size does not grow with the data, so broadcasting them is safe."""
    sup = load_table(spark, sf, "supplier", ["s_suppkey", "s_nationkey"])
    nation = load_table(spark, sf, "nation", ["n_nationkey", "n_name", "n_regionkey"])
    region = load_table(spark, sf, "region", ["r_regionkey", "r_name"])
    out = sup.join(F.broadcast(nation), sup.s_nationkey == nation.n_nationkey, "left") \
        .join(F.broadcast(region), F.col("n_regionkey") == region.r_regionkey, "left")
    return out.select("s_suppkey", "n_name", "r_name")


# ------------------------------------------------------------------------------------- J-2 + MAP-1

def _merge_inputs(spark, sf):
    part = load_table(spark, sf, "part", ["p_partkey", "p_name", "p_type"])
    li = load_table(spark, sf, "lineitem", ["l_partkey", "l_quantity"])
    stats = li.groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("q"))
    base = part.select("p_partkey", F.concat(
        F.lit('{"id":"'), F.col("p_partkey").cast("string"), F.lit('","name":"'), F.col("p_name"),
        F.lit('","likesCount":5,"downloadCount":1,"category":{"id":"'), F.col("p_type"), F.lit('"}}')).alias("base"))
    detail = stats.select("l_partkey", F.concat(
        F.lit('{"likesCount":'), F.when(F.col("n") % 4 == 0, F.lit("null")).otherwise(F.col("n").cast("string")),
        F.lit(',"downloadCount":'), F.col("q").cast("string"),
        F.lit(',"category":{"path":[{"name":"'), F.col("l_partkey").cast("string"), F.lit('"}]}}')).alias("detail"))
    return base, detail


@register("detail_merge", """
WITH stats AS (SELECT l_partkey, count(*) AS n, CAST(sum(l_quantity) AS BIGINT) AS q FROM lineitem GROUP BY l_partkey)
SELECT p_partkey AS id, p_name AS name,
       CASE WHEN l_partkey IS NULL THEN '5' WHEN n % 4 = 0 THEN NULL ELSE CAST(n AS VARCHAR) END AS likes,
       CASE WHEN l_partkey IS NULL THEN '1' ELSE CAST(q AS VARCHAR) END AS downloads,
       CASE WHEN l_partkey IS NULL THEN p_type END AS category_id,
       CASE WHEN l_partkey IS NULL THEN NULL ELSE CAST(l_partkey AS VARCHAR) END AS category_leaf
FROM part LEFT JOIN stats ON p_partkey = l_partkey
""")
def detail_merge(spark, sf):
    """J-2 + MAP-1: list record left-joined to its detail record; detail keys win, a
    present null included; nested objects are replaced whole (so the base category id is
    lost when the detail carries a category)."""
    base, detail = _merge_inputs(spark, sf)
    j = base.join(detail, base.p_partkey == detail.l_partkey, "left")
    m = j.select(F.col("p_partkey").alias("id"), M.merge_records("base", "detail").alias("m"))
    return m.select("id", F.col("m")["name"].alias("name"), F.col("m")["likesCount"].alias("likes"),
                    F.col("m")["downloadCount"].alias("downloads"),
                    F.get_json_object(F.col("m")["category"], "$.id").alias("category_id"),
                    F.get_json_object(F.col("m")["category"], "$.path[0].name").alias("category_leaf"))


# ------------------------------------------------------------------------------------- SRC-3 / SRC-4

@register("payload_decode", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def payload_decode(spark, sf):
    ev = load_table(spark, sf, "events", ["event_id", "props"])
    return ev.select("event_id", M.decode_payload("props", "struct<k:int>")["k"].alias("k"))


def _payloads(spark, sf):
    """Envelopes derived from events: list payloads of every shape the gate must sort."""
    ev = load_table(spark, sf, "events", ["event_id", "event_type", "props"])
    t = F.col("event_type")
    payload = (F.when(t == "error", F.concat(F.lit('{"errors":[{"message":"e'), F.col("event_id").cast("string"), F.lit('"}]}')))
               .when(t == "signup", F.concat(F.lit("not json "), F.col("event_id").cast("string")))
               .when(t == "click", F.concat(F.lit('{"data":{"models":{"items":'), F.col("props"), F.lit("}}}")))
               .when(t == "purchase", F.lit('{"data":{"models":{"cursor":null}}}'))
               .otherwise(F.concat(F.lit('{"data":{"models":{"cursor":null,"items":['), F.col("props"),
                                   F.lit(']}},"errors":null}'))))
    return ev.select("event_id", payload.alias("payload"))


@register("payload_gate", """
WITH p AS (SELECT event_id, CASE
    WHEN event_type = 'error' THEN '{"errors":[{"message":"e' || CAST(event_id AS VARCHAR) || '"}]}'
    WHEN event_type = 'signup' THEN 'not json ' || CAST(event_id AS VARCHAR)
    WHEN event_type = 'click' THEN '{"data":{"models":{"items":' || props || '}}}'
    WHEN event_type = 'purchase' THEN '{"data":{"models":{"cursor":null}}}'
    ELSE '{"data":{"models":{"cursor":null,"items":[' || props || ']}},"errors":null}' END AS payload
  FROM events)
SELECT event_id, CASE
    WHEN NOT json_valid(payload) THEN 'invalid json'
    WHEN json_extract(payload, '$.errors') IS NOT NULL AND json_type(payload, '$.errors') <> 'NULL' THEN 'errors'
    WHEN json_type(payload, '$.data.models.items') IS NULL OR json_type(payload, '$.data.models.items') NOT IN ('ARRAY', 'OBJECT') THEN 'unexpected format'
  END AS reason
FROM p
""")
def payload_gate(spark, sf):
    good, bad = M.split_payloads(_payloads(spark, sf))
    bad = bad.select("event_id", F.regexp_replace("reason", r"^errors: .*$", "errors").alias("reason"))
    return good.select("event_id", F.lit(None).cast("string").alias("reason")).unionByName(bad)


# ------------------------------------------------------------------------------------- JSON generator E2E

def _models_feed_sql() -> str:
    inner = _describe_sql().strip()
    return f"""
WITH {_records_sql()},
top AS (SELECT id, likes_7d, name, slug, "user", published, path,
               row_number() OVER (ORDER BY likes_7d DESC, id ASC) - 1 AS pos
        FROM rec ORDER BY likes_7d DESC, id ASC LIMIT {TOP_N}),
described AS ({inner})
SELECT 'models' AS feed, top.name AS title,
       {S.q(rules.JSON_SITE + '/model/')} || CAST(top.id AS VARCHAR) || '-' || top.slug AS uri,
       described.content AS content, coalesce(top."user", 'Unknown') AS author,
       CAST(epoch(top.published) AS BIGINT) AS "timestamp", {S.q(rules.JSON_UID_PREFIX)} || CAST(top.id AS VARCHAR) AS uid,
       array_to_string(top.path, '|') AS categories, CAST(top.pos AS BIGINT) AS pos
FROM top JOIN described ON described.id = top.id
"""


@register("models_feed", _models_feed_sql())
def models_feed(spark, sf):
    """JSON models generator end to end: trending rank (T-1) and clamped limit (T-3) on the
    list records *before* the detail join (J-2), so only ``limit`` details are joined and
    rendered (STR-15/16, URL-4, JSON-1, ARR-1)."""
    from pyspark.sql.window import Window
    rec = model_records(spark, sf)
    top = R.top_n(rec, R.metric_for("trending", R.JSON_METRICS), "id", TOP_N)
    top = top.withColumn("pos", (F.row_number().over(Window.orderBy(F.col("likes_7d").desc(), F.col("id"))) - 1)
                         .cast("bigint"))  # window over the <= 50 kept rows only
    docs = load_table(spark, sf, "documents", ["doc_id", "text"])
    d = top.join(docs, top.id == docs.doc_id, "left").withColumnRenamed("text", "description")
    d = materialize(d.withColumn("description_clean", clean_description(F.col("description"))))
    cols = dict(_describe_cols(d), description_clean=F.col("description_clean"))
    return d.select(
        F.lit("models").alias("feed"), F.col("name").alias("title"), U.model_uri("id", "slug").alias("uri"),
        M.render_model("name", "image", M.describe_model(cols)).alias("content"),
        M.with_default(F.col("user")).alias("author"), F.unix_timestamp("published").alias("timestamp"),
        U.model_uid("id").alias("uid"), F.array_join(M.names_of("path_s"), "|").alias("categories"), "pos")


HTML_ORDERINGS = ["hotScore", "latest", "mostLiked", "mostDownloaded", "mostCollected"]
HTML_TOP = 5


def _ranked_html_sql() -> str:
    parts = []
    for name in HTML_ORDERINGS:
        metric = R.metric_for(name, R.HTML_METRICS)
        parts.append(f"""SELECT '{name}' AS order_by, CAST(row_number() OVER (ORDER BY {metric} DESC NULLS LAST, id ASC) - 1 AS BIGINT) AS pos, id
  FROM (SELECT * FROM rec ORDER BY {metric} DESC NULLS LAST, id ASC LIMIT {HTML_TOP})""")
    return f"WITH {_records_sql()} " + " UNION ALL ".join(parts)


@register("ranked_html", _ranked_html_sql())
def ranked_html(spark, sf):
    """T-2: every HTML-generator ordering (hot score = trailing 7-day likes, latest, most
    liked / downloaded / collected) as its own top-n over the same records."""
    from functools import reduce
    from pyspark.sql.window import Window
    rec = model_records(spark, sf)
    frames = []
    for name in HTML_ORDERINGS:
        metric = R.metric_for(name, R.HTML_METRICS)
        top = R.top_n(rec, metric, "id", HTML_TOP)
        w = Window.orderBy(F.col(metric).desc_nulls_last(), F.col("id").asc())  # over <= 50 kept rows
        frames.append(top.select(F.lit(name).alias("order_by"), (F.row_number().over(w) - 1).cast("bigint").alias("pos"), "id"))
    return reduce(lambda a, b: a.unionByName(b), frames)
