"""Streaming queries (ST-1..ST-3): each runs a real Structured Streaming job over the
table's parquet files with ``availableNow`` and returns the sink contents."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources.snapshots import TTL_NEWS, fresh_snapshot, load_table
from ..streaming import incremental as ST
from .catalog import register
from .events_queries import FRESH_SQL, TS_FORMAT
from .news import _article_feed_sql, article_items


@register("stream_feed", _article_feed_sql(first_seen_and_block=False))
def stream_feed(spark, sf):
    """ST-1: page snapshots arriving as files -> article job -> parquet sink.  Equal to the
    batch article job over the same pages (checked in tests)."""
    sink = ST.stream_feed(spark, sf, lambda pages: article_items(pages), name="stream-feed")
    return spark.read.parquet(sink)


@register("publish_once", "SELECT DISTINCT user_id FROM events")
def publish_once(spark, sf):
    """ST-2: one published item per id inside the watermark (ids here: users)."""
    ev = ST.read_table_stream(spark, sf, "events")
    once = ST.publish_once(ev.select("user_id", F.col("ts").cast("timestamp").alias("ts")), "user_id", "ts", "30 days")
    sink, ckpt = ST.scratch_path(spark, "publish-sink"), ST.scratch_path(spark, "publish-ckpt")
    ST.run_available(once, sink, ckpt)
    return spark.read.parquet(sink).select("user_id")


@register("trailing_popularity", """
SELECT strftime(date_trunc('day', ts) - to_days(CAST(k AS INTEGER)), '%Y-%m-%d %H:%M:%S') AS window_start,
       user_id, CAST(count(*) AS BIGINT) AS n
FROM (SELECT ts, user_id, unnest(range(0, 7)) AS k FROM events)
GROUP BY 1, 2
""")
def trailing_popularity(spark, sf):
    """ST-3: sliding 7-day / 1-day windows per user with a watermark of one day.  Every micro-batch merges the counts
    that it changed into the sink, so open windows are there with their counts so far; a window's state
    goes once the watermark has passed its end."""
    ev = ST.read_table_stream(spark, sf, "events")
    agg = ST.trailing_popularity(ev.select("user_id", F.col("ts").cast("timestamp").alias("ts")), "user_id", "ts", delay="1 day")
    sink = ST.MergeSink(ST.scratch_path(spark, "pop-sink"), ("window_start", "window_end", "user_id"))
    ST.run_merged(agg, sink, ST.scratch_path(spark, "pop-ckpt"))
    return sink.read(spark, agg.schema).select(F.date_format("window_start", "yyyy-MM-dd HH:mm:ss").alias("window_start"), "user_id",
                                               F.col("n").cast("bigint").alias("n"))


@register("fresh_snapshot_stream", FRESH_SQL)
def fresh_snapshot_stream(spark, sf):
    """SRC-2 as a stream: the newest event of each user, kept in state while a lookup may take it and merged into a table by user; the lookup
    at the newest event reads that table."""
    ev = ST.read_table_stream(spark, sf, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    updates = ST.fresh_updates(ev, "user_id", "ts", TTL_NEWS, ["value", "event_id"])
    sink = ST.MergeSink(ST.scratch_path(spark, "fresh-sink"), ("user_id",))
    ST.run_merged(updates, sink, ST.scratch_path(spark, "fresh-ckpt"))
    newest = sink.read(spark, updates.schema)
    as_of = load_table(spark, sf, "events", ["ts"]).agg(F.max(F.col("ts").cast("timestamp"))).scalar()
    fresh = fresh_snapshot(newest, "user_id", "ts", as_of, TTL_NEWS, ["value", "event_id"])
    return fresh.select("user_id", F.date_format("ts", TS_FORMAT).alias("ts"), "value", "event_id")
