"""Sources and sinks: snapshot scans, freshness-bounded lookup, chain following, feed sink
(SRC-1, SRC-2, SRC-5, SRC-6, SRC-7, SNK-1)."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]

# Snapshot TTLs in seconds (fixed values of the source generators).
TTL_NEWS = 3600
TTL_JSON = 1800
TTL_HTML = 3600


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")


# Session setting that deals every scan out over this many partitions; unset by default.  For
# local runs over files of a single row group, which a scan cannot split.
INPUT_PARTITIONS = "snapfeed.input.partitions"


def load_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """SRC-1: parquet scan; selecting columns here lets the scan read only those.  The scan's own
    splits are kept unless the caller sets ``snapfeed.input.partitions``."""
    df = spark.read.parquet(table_path(sf_dir, name))
    df = df.select(*columns) if columns else df
    parts = spark.conf.get(INPUT_PARTITIONS, None)
    return df.repartition(int(parts)) if parts else df


def fresh_snapshot(snapshots: DataFrame, key: str, ts: str, as_of: Column, ttl_seconds: int,
                   value_cols: list[str]) -> DataFrame:
    """SRC-2: newest snapshot per key fetched within ``[as_of - ttl, as_of]``.

    Grouped ``max_by`` (partial aggregation before the shuffle), so a hot key costs one
    partial row per map task, not a skewed window partition."""
    lo = as_of - F.make_interval(secs=F.lit(ttl_seconds))
    window = snapshots.where((F.col(ts) <= as_of) & (F.col(ts) >= lo))
    packed = F.struct(*[F.col(c) for c in [ts, *value_cols]])
    order = F.struct(F.col(ts), F.xxhash64(*[F.col(c) for c in value_cols]))  # equal times: the same row on every run
    agg = window.groupBy(key).agg(F.max_by(packed, order).alias("_s"))
    return agg.select(key, *[F.col("_s")[c].alias(c) for c in [ts, *value_cols]])


def chain_pages(links: DataFrame, seeds: DataFrame, max_pages: int) -> DataFrame:
    """SRC-7 on narrow rows: (seed, canon, hop) of the stored pages that the chain of each seed (seed, canon) reaches in
    ``max_pages`` pages, the seed's own being hop 1.  ``links`` has (canon, next_canon) of every stored page, once each.

    Pointer doubling: what is reached in up to n pages meets the jumps of n pages, and the jumps meet themselves, so
    the joins are as many as ``max_pages`` has binary digits.  A page that is not stored ends its chain."""
    stored = links.select(F.col("canon").alias("_stored"))
    reached = seeds.select("seed", "canon").join(stored, F.col("canon") == F.col("_stored")).select("seed", "canon", F.lit(1).alias("hop"))
    jumps = links.where("next_canon is not null").join(stored, F.col("next_canon") == F.col("_stored")).select(F.col("canon").alias("_from"), F.col("next_canon").alias("_to"))
    done = 1
    while done < max_pages:
        further = reached.where(F.col("hop") <= max_pages - done).join(jumps, F.col("canon") == F.col("_from"))
        reached = reached.unionByName(further.select("seed", F.col("_to").alias("canon"), (F.col("hop") + done).alias("hop"))).checkpoint(eager=True)
        done *= 2
        if done < max_pages:
            second = jumps.select(F.col("_from").alias("_middle"), F.col("_to").alias("_end"))
            jumps = jumps.join(second, F.col("_to") == F.col("_middle")).select("_from", F.col("_end").alias("_to")).checkpoint(eager=True)
    return reached


def write_feed(items: DataFrame, path: str, mode: str = "overwrite", nonempty: str | None = None) -> int:
    """SNK-1: feed items partitioned by feed; order is kept in the ``pos`` column.  Gives the number of items, which the writing job
    counts as they pass (no second run over the input).  SRC-6: with ``nonempty`` a job without items raises that message."""
    seen = Observation("feed")
    items.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).partitionBy("feed").parquet(path)
    rows = seen.get["rows"]
    if nonempty is not None and not rows:
        raise RuntimeError(nonempty)
    return rows
