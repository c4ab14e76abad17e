"""Structured Streaming forms of the feed jobs (ST-1, ST-2, ST-3).

* ST-1 ``stream_feed``: new page snapshot files -> the same row-local article job as the
  batch feed -> append to a parquet sink (``availableNow`` for catch-up runs, or a
  processing-time trigger for continuous refresh).
* ST-2 ``publish_once``: one item per id while the id is inside the watermark
  (``dropDuplicatesWithinWatermark``); state is bounded by the watermark delay.
* SRC-2 ``fresh_updates``: the newest snapshot of each key, kept while a lookup may take it.
* ST-3 ``trailing_popularity``: sliding 7-day windows per key with a watermark; state is
  bounded by window length + delay.  Counts of open windows are kept current in a ``MergeSink``.

Sinks and checkpoints live under the session's ``spark.checkpoint.dir`` (a shared folder
on a cluster), so a restarted driver or lost executor resumes from the checkpoint.
"""

from __future__ import annotations

import os
import uuid

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupStateTimeout
from pyspark.sql.types import LongType, StructField, StructType

from ..session import checkpoint_dir


def scratch_path(spark: SparkSession, name: str) -> str:
    return os.path.join(checkpoint_dir(spark), f"{name}-{uuid.uuid4().hex[:12]}")


def read_table_stream(spark: SparkSession, directory: str, table: str, max_files: int | None = None) -> DataFrame:
    """File stream of one table's parquet files in ``directory`` (schema from the batch read): of ``<table>*.parquet``, each a file or
    a folder of part files.  ``max_files`` bounds the files of one micro-batch; unset, a batch takes all that are there."""
    schema = spark.read.parquet(os.path.join(directory, f"{table}.parquet")).schema
    stream = spark.readStream.schema(schema)
    return (stream.option("maxFilesPerTrigger", max_files) if max_files else stream).parquet(os.path.join(directory, f"{table}*.parquet"))


def run_available(df: DataFrame, sink: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything available now, then stop (exactly-once file sink)."""
    q = (df.writeStream.format("parquet").option("path", sink).option("checkpointLocation", checkpoint)
         .outputMode(mode).trigger(availableNow=True).start())
    q.awaitTermination()


def stream_feed(spark: SparkSession, directory: str, transform, name: str = "feed") -> str:
    """ST-1: apply a stateless batch transform to the page stream; returns the sink path."""
    pages = read_table_stream(spark, directory, "pages")
    sink, ckpt = scratch_path(spark, f"{name}-sink"), scratch_path(spark, f"{name}-ckpt")
    run_available(transform(pages), sink, ckpt)
    return sink


def publish_once(events: DataFrame, uid_col: str, ts_col: str, delay: str) -> DataFrame:
    """ST-2: drop repeats of an id that arrive within ``delay`` of the watermark."""
    return events.withWatermark(ts_col, delay).dropDuplicatesWithinWatermark([uid_col])


def item_uid(uid_col: str | None, uri_col: str = "uri"):
    """Stable item id: the item's own uid, else the SHA-256 of its URI."""
    sha = F.sha2(F.col(uri_col), 256)
    return F.coalesce(F.col(uid_col), sha) if uid_col else sha


def publish_items_once(items: DataFrame, delay: str = "1 hour", uid_col: str | None = None,
                       epoch_col: str = "timestamp") -> DataFrame:
    """ST-2 for feed items: event time from the item's epoch seconds, one row per stable id
    while it is inside the watermark."""
    keyed = items.withColumn("item_uid", item_uid(uid_col)).withColumn("event_time", F.timestamp_seconds(epoch_col))
    return publish_once(keyed, "item_uid", "event_time", delay)


def trailing_popularity(events: DataFrame, key: str, ts_col: str, delay: str = "1 day",
                        length: str = "7 days", slide: str = "1 day") -> DataFrame:
    """ST-3: sliding-window counts per key (streaming form of A-5)."""
    return (events.withWatermark(ts_col, delay)
            .groupBy(F.window(ts_col, length, slide).alias("w"), F.col(key))
            .agg(F.count(F.lit(1)).alias("n"))
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "n"))


def fresh_updates(snapshots: DataFrame, key: str, ts: str, ttl_seconds: int, value_cols: list[str]) -> DataFrame:
    """SRC-2 on a stream: (key, ts, <value_cols>) of each key's newest snapshot, whenever it changes (update mode).

    State holds one snapshot a key and lets it go when the watermark, ``ttl_seconds`` behind the newest snapshot, has passed it: by
    then no lookup takes it any more.  Equal times are told apart as in the batch lookup.  Null keys form one group."""
    names = dict(zip(("key", *(f"v{i}" for i in range(len(value_cols)))), (key, *value_cols), strict=True))
    values = F.struct(*[F.col(c).alias(n) for n, c in names.items()])
    rows = snapshots.withWatermark(ts, f"{ttl_seconds + 1} seconds").select(
        F.to_json(F.struct(F.col(key).alias("k"))).alias("_group"), F.col(ts), F.unix_micros(F.col(ts)).alias("_at"),
        F.xxhash64(*value_cols).alias("_tie"), F.to_json(values).alias("_row"))
    schema = StructType([StructField(n, snapshots.schema[c].dataType) for n, c in names.items()])

    def newest(group, batches, state):
        import pandas as pd
        if state.hasTimedOut:
            state.remove()
            return
        held = state.get if state.exists else None
        best = held
        for batch in batches:
            last = batch.sort_values(["_at", "_tie"]).iloc[-1]
            new = (int(last["_at"]), int(last["_tie"]), last["_row"])
            best = new if best is None or new[:2] > tuple(best[:2]) else best
        if held is None or best[:2] != tuple(held[:2]):
            state.update(best)
            # a snapshot below the watermark is stale: its state goes at the next chance
            state.setTimeoutTimestamp(max(best[0] // 1000 + 1, state.getCurrentWatermarkMs() + 1))
            yield pd.DataFrame([best], columns=["_at", "_tie", "_row"])

    kept = rows.groupBy("_group").applyInPandasWithState(
        newest, "_at long, _tie long, _row string", "_at long, _tie long, _row string", "update", GroupStateTimeout.EventTimeTimeout)
    read = kept.select("_at", F.from_json("_row", schema).alias("r"))
    return read.select(F.col("r.key").alias(key), F.timestamp_micros("_at").alias(ts), *[F.col(f"r.{n}").alias(c) for n, c in names.items() if n != "key"])


MARK = StructType([StructField("upto", LongType())])


@dataclass(frozen=True)
class MergeSink:
    """A table of rows by key into which the micro-batches of an update-mode stream are merged.

    Each batch is written as a folder of its own, named by its batch id, so a batch that is written again after a
    failure replaces itself.  ``read`` takes each key's row from the newest batch that has one.  ``compact`` merges
    all batches up to one into a base; a base counts once its mark is written, so a lost compaction leaves what was before."""

    path: str
    keys: tuple[str, ...]

    def write(self, batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(int(batch_id)).cast("long")).write.mode("overwrite").parquet(f"{self.path}/batches/id={int(batch_id):012d}")

    def base(self, spark: SparkSession) -> int:
        """The last batch in the newest base; -1 without any."""
        marks = _table(spark, f"{self.path}/marks", MARK)
        return marks.agg(F.coalesce(F.max("upto"), F.lit(-1)).alias("n")).first()["n"]

    def read(self, spark: SparkSession, schema: StructType, upto: int | None = None) -> DataFrame:
        """The newest row of each key, in the columns of ``schema``, after all batches or after batch ``upto``.  One combining
        aggregate: a key ships one row a task."""
        full = StructType([*schema.fields, StructField("_batch", LongType())])
        base = self.base(spark)
        rows = _table(spark, f"{self.path}/batches", StructType([*full.fields, StructField("id", LongType())]))
        rows = rows.where(F.col("id") > base) if upto is None else rows.where(F.col("id").between(base + 1, upto))  # prunes folders
        rows = rows.drop("id")
        if base >= 0:
            rows = rows.unionByName(spark.read.schema(full).parquet(f"{self.path}/bases/upto={base:012d}"))
        others = [f.name for f in schema.fields if f.name not in self.keys]
        newest = rows.groupBy(*self.keys).agg(F.max_by(F.struct(*others), "_batch").alias("_row"))
        return newest.select(*[F.col(f.name) if f.name in self.keys else F.col(f"_row.{f.name}").alias(f.name) for f in schema.fields])

    def compact(self, spark: SparkSession, schema: StructType, upto: int) -> None:
        """Merge the base and the batches up to ``upto``, all of which have been written, into a new base.  The folders of
        the merged batches are no longer read."""
        if upto > self.base(spark):
            merged = self.read(spark, schema, upto).withColumn("_batch", F.lit(upto).cast("long"))
            merged.write.mode("overwrite").parquet(f"{self.path}/bases/upto={upto:012d}")
            spark.createDataFrame([(upto,)], StructType([StructField("n", LongType())])).write.mode("overwrite").parquet(f"{self.path}/marks/upto={upto:012d}")


def _table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table in a folder; without rows where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def run_merged(df: DataFrame, sink: MergeSink, checkpoint: str, compact_every: int = 50) -> None:
    """Merge everything available now into ``sink`` by its keys, in update mode: rows that changed are written again.
    Restarted with the same checkpoint, it goes on where it was."""
    schema = df.schema

    def merge(batch: DataFrame, batch_id: int) -> None:
        sink.write(batch, batch_id)
        if (batch_id + 1) % compact_every == 0:
            sink.compact(batch.sparkSession, schema, batch_id)

    q = (df.writeStream.outputMode("update").foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
