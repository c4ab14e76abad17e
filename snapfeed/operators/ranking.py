"""Filters, rankings and limits of the model generators (F-8..F-11, T-1..T-5, A-5),
plus parameter validation and naming over a ``feeds`` table (PRM-1, NAME-1)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType
from pyspark.sql.window import Window

from ..functions import rules


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def clamp_limit(value) -> int:
    """T-3 on the driver for one feed: null/0/garbage -> 1, then 1..50."""
    try:
        n = int(value)
    except (TypeError, ValueError):
        n = 0
    return min(rules.LIMIT_MAX, max(rules.LIMIT_MIN, n))


def clamp_limit_col(col) -> Column:
    """T-3 over a feeds table."""
    n = F.coalesce(F.expr(f"try_cast({col} AS INT)") if isinstance(col, str) else col.try_cast("int"), F.lit(0))
    return F.least(F.lit(rules.LIMIT_MAX), F.greatest(F.lit(rules.LIMIT_MIN), n))


def category_filter(df: DataFrame, col: str, code) -> DataFrame:
    """F-8: equality on the category code; null or '' means all categories."""
    if code is None or code == "":
        return df
    return df.where(F.col(col) == F.lit(code))


def age_filter(df: DataFrame, ts: str, as_of: Column, days) -> DataFrame:
    """F-9: keep rows newer than ``as_of - days``; null/'' days = all time."""
    if days is None or days == "":
        return df
    return df.where(F.col(ts) > as_of - F.make_interval(days=F.lit(int(days))))


def facet_filter(df: DataFrame, eq: dict | None = None, any_of: dict | None = None,
                 ranges: dict | None = None, exclude_ids: DataFrame | None = None, id_col: str | None = None,
                 flags: dict | None = None) -> DataFrame:
    """F-11 / J-6: equality, any-of lists (an array column: any element), inclusive numeric ranges
    (either bound may be None), boolean flags (True or False keep such rows, None keeps all; a null
    flag counts as False) and an exclude-id anti join.  The exclude list is a DataFrame so it can be large;
    Spark picks broadcast or shuffle anti join by its measured size."""
    out = df
    for c, v in (eq or {}).items():
        out = out.where(F.col(c) == F.lit(v))
    for c, vs in (any_of or {}).items():
        if isinstance(df.schema[c].dataType, ArrayType):
            out = out.where(F.arrays_overlap(F.col(c), F.array(*[F.lit(v) for v in vs])))
        else:
            out = out.where(F.col(c).isin(list(vs)))
    for c, wanted in (flags or {}).items():
        if wanted is not None:
            out = out.where(F.coalesce(F.col(c), F.lit(False)) == F.lit(bool(wanted)))
    for c, (lo, hi) in (ranges or {}).items():
        if lo is not None:
            out = out.where(F.col(c) >= F.lit(lo))
        if hi is not None:
            out = out.where(F.col(c) <= F.lit(hi))
    if exclude_ids is not None:
        ex = exclude_ids.select(F.col(exclude_ids.columns[0]).alias("_ex"))
        out = out.join(ex, F.col(id_col) == F.col("_ex"), "left_anti")
    return out


# T-1 / T-2: named metric -> column; unknown names fall back to the first entry.
JSON_METRICS = {"trending": "likes_7d", "likes": "likes", "downloads": "downloads", "newest": "published"}
HTML_METRICS = {"hotScore": "hot_score", "latest": "published", "mostLiked": "likes",
                "mostDownloaded": "downloads", "mostCollected": "collected"}


def metric_for(sort: str | None, table: dict) -> str:
    return table.get(sort or "", next(iter(table.values())))


def top_n(df: DataFrame, metric: str, id_col: str, n: int) -> DataFrame:
    """T-1 + T-3 for one feed: ``orderBy(...).limit(n)`` plans as TakeOrderedAndProject
    (a per-partition top-n, then one merge of n rows per partition)."""
    return df.orderBy(F.col(metric).desc_nulls_last(), F.col(id_col).asc()).limit(clamp_limit(n))


def top_k_for_feeds(items: DataFrame, feeds: DataFrame, category: str, ts: str, as_of: Column, metrics: dict, id_col: str) -> DataFrame:
    """The parameter sets of many feeds at once (F-8, F-9, T-1..T-4): ``feeds`` has feed_id, category (null or '':
    all), days (null: all time), ordering (unknown: the first metric) and limit (clamped).  Gives
    (feed_id, rank, id) of each feed's items.

    Items never meet feeds.  Each item goes once per metric into the run of its category and age: the least of the feeds' ``days``
    that takes it in.  Of each run the items up to the largest limit stay, by a partial limit before the shuffle.  What a
    parameter set takes is the best of the runs up to its age; these heads, not the items, meet the distinct parameter sets, and
    their results the feeds."""
    names = list(metrics)
    feeds = feeds.withColumn("_limit", clamp_limit_col("limit")).withColumn("_category", F.nullif("category", F.lit(""))) \
        .withColumn("_metric", F.when(F.col("ordering").isin(names), F.col("ordering")).otherwise(names[0]))
    # the least whole number of days that takes an item in, and the least of the feeds' that is as large
    age = F.floor((F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(F.col(ts).cast("timestamp"))) / F.lit(86_400_000_000)) + 1
    runs = items.select(F.col(id_col).alias("_id"), F.col(category).alias("_category"), age.cast("int").alias("_age"),
                        F.inline(F.array(*[F.struct(F.lit(n).alias("_metric"), F.col(metrics[n]).cast("double").alias("_value")) for n in names])))
    days = feeds.where("days is not null").select(F.col("days").cast("int").alias("days")).distinct()
    ages = runs.select("_age").distinct()
    order = Window.orderBy(F.col("_at").desc(), F.col("_age").isNotNull()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # a table of the distinct ages in days and of the feeds' days, as narrow as a calendar
    upto = (ages.select(F.col("_age").alias("_at"), "_age", F.lit(None).cast("int").alias("days"))
            .unionByName(days.select(F.col("days").alias("_at"), F.lit(None).cast("int").alias("_age"), "days")))
    upto = upto.withColumn("_days", F.last("days", ignorenulls=True).over(order)).where("_age is not null").select(F.col("_age").alias("_of"), "_days")
    runs = runs.join(upto, F.col("_age") == F.col("_of"), "left")
    everywhere = F.col("_category").isNull()
    heads = _heads(runs.where(~everywhere), ["_category", "_metric", "_days"])
    open_heads = _heads(_heads(runs, ["_category", "_metric", "_days"]).withColumn("_category", F.lit(None).cast("string")), ["_metric", "_days"])
    sets = feeds.select("_category", "_metric", "days").distinct()
    within = F.col("days").isNull() | (F.col("_days") <= F.col("days"))
    met = heads.join(sets.where(~everywhere), ["_category", "_metric"]).where(within)
    met = met.unionByName(open_heads.drop("_category").join(sets.where(everywhere), ["_metric"]).where(within).select(*met.columns))
    ranked = _heads(met, ["_category", "_metric", "days"], rank="rank")
    ranked = ranked.select(F.col("_category").alias("_c"), F.col("_metric").alias("_m"), F.col("days").alias("_d"), "rank", "_id")
    same = F.col("_category").eqNullSafe(F.col("_c")) & (F.col("_metric") == F.col("_m")) & F.col("days").eqNullSafe(F.col("_d"))
    found = feeds.join(ranked, same).where(F.col("rank") <= F.col("_limit"))
    return found.select("feed_id", F.col("rank").cast("int").alias("rank"), F.col("_id").alias(id_col))


def _heads(rows: DataFrame, by: list[str], rank: str = "_rank") -> DataFrame:
    """The rows of each group up to the largest limit, by value, then id."""
    own = Window.partitionBy(*by).orderBy(F.col("_value").desc_nulls_last(), "_id")
    out = rows.withColumn(rank, F.row_number().over(own)).where(F.col(rank) <= rules.LIMIT_MAX)
    return out.drop(rank) if rank == "_rank" else out


def top_k_per_group(df: DataFrame, group: str, metric: str, id_col: str, k: int, rank_col: str = "rank") -> DataFrame:
    """T-4: ``row_number() <= k`` per group.  Spark inserts a partial WindowGroupLimit
    before the shuffle, so each map task ships at most k rows per group; a hot group costs
    k rows per task, not its full size."""
    w = Window.partitionBy(group).orderBy(F.col(metric).desc_nulls_last(), F.col(id_col).asc())
    return df.withColumn(rank_col, F.row_number().over(w)).where(F.col(rank_col) <= int(k))


# --- PRM-1 / NAME-1 over a feeds table -------------------------------------------------------------------

def _label_map(pairs) -> Column:
    args = []
    for label, code in pairs:
        if code is not None:
            args += [F.lit(code), F.lit(label)]
    return F.create_map(*args)


def validate_json_feeds(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PRM-1 for the JSON generator: category/days/sort enums, defaults, limit clamp."""
    cats = [c for _, c in rules.JSON_CATEGORIES if c is not None]
    days = [d for _, d in rules.JSON_DAYS]
    sorts = [s for _, s in rules.JSON_SORTS]
    out = feeds.select(
        "*",
        F.when(F.col("category").isNull() | (F.col("category") == ""), F.lit(None).cast("string"))
        .otherwise(F.col("category")).alias("category_v"),
        F.coalesce(F.col("days"), F.lit("7")).alias("days_v"),
        F.coalesce(F.col("sort"), F.lit("trending")).alias("sort_v"),
        clamp_limit_col("limit").alias("limit_v"),
    )
    reason = (F.when(F.col("category_v").isNotNull() & ~F.col("category_v").isin(cats), F.lit("unknown category"))
              .when(~F.col("days_v").isin(days), F.lit("unknown days"))
              .when(~F.col("sort_v").isin(sorts), F.lit("unknown sort")))
    tagged = out.withColumn("reason", reason)
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())


def validate_html_feeds(feeds: DataFrame) -> tuple[DataFrame, DataFrame]:
    """PRM-1 for the HTML generator: category/days/orderBy enums (defaults 300 / 7 /
    hotScore when null), limit clamp; '' means "all" for category and days."""
    cats = [c for _, c in rules.HTML_CATEGORIES]
    days = [d for _, d in rules.HTML_DAYS]
    orders = [o for _, o in rules.HTML_SORTS]
    out = feeds.select(
        "*",
        F.coalesce(F.col("category"), F.lit("300")).alias("category_v"),
        F.coalesce(F.col("days"), F.lit("7")).alias("days_v"),
        F.coalesce(F.col("orderBy"), F.lit("hotScore")).alias("order_v"),
        clamp_limit_col("limit").alias("limit_v"),
    )
    reason = (F.when(~F.col("category_v").isin(cats), F.lit("unknown category"))
              .when(~F.col("days_v").isin(days), F.lit("unknown days"))
              .when(~F.col("order_v").isin(orders), F.lit("unknown orderBy")))
    tagged = out.withColumn("reason", reason)
    return tagged.where(F.col("reason").isNull()).drop("reason"), tagged.where(F.col("reason").isNotNull())


def json_feed_name(category, days, sort=None, semantics: str = "observed") -> Column:
    """NAME-1 (JSON): always 'Trending' in ``observed``; the sort label in ``documented``."""
    cat = _c(category)
    label = F.when(cat.isNull() | (cat == ""), F.lit("All Categories")).otherwise(_label_map(rules.JSON_CATEGORIES)[cat])
    verb = F.lit("Trending")
    if semantics == "documented" and sort is not None:
        verb = F.coalesce(_label_map(rules.JSON_SORTS)[_c(sort)], F.lit("Trending"))
    return F.concat(F.lit(rules.JSON_FEED_NAME_PREFIX), verb, F.lit(" in "), label, F.lit(" (Last "),
                    F.coalesce(_c(days).cast("string"), F.lit("")), F.lit(" days)"))


def html_feed_name(category, days) -> Column:
    """NAME-1 (HTML): unknown codes leave the label out; days only when set."""
    cat, d = _c(category), _c(days)
    label = _label_map(rules.HTML_CATEGORIES)[cat]
    part_cat = (F.when(cat.isNull() | (cat == ""), F.lit(" - All Categories"))
                .when(label.isNotNull(), F.concat(F.lit(" - "), label)).otherwise(F.lit("")))
    part_days = F.when(d.isNotNull() & (d != ""), F.concat(F.lit(" (Last "), d, F.lit(" days)"))).otherwise(F.lit(""))
    return F.concat(F.lit(rules.HTML_FEED_NAME), part_cat, part_days)
