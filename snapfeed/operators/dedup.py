"""First-occurrence dedup, feed positions, unions (W-1, W-3, U-1, U-2)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_seen(df: DataFrame, key: str, order_by: str | list[str]) -> DataFrame:
    """W-1: keep the first row per ``key`` by ``order_by`` (ties: the smallest struct).

    Grouped ``min_by`` rather than ``row_number`` over a window: the aggregation combines
    map-side, so a key that holds a third of all rows (a navigation link on every page)
    sends one partial row per map task instead of one huge window partition."""
    order = [order_by] if isinstance(order_by, str) else list(order_by)
    cols = [c for c in df.columns if c != key]
    packed = F.struct(*[F.col(c) for c in cols])
    ordering = F.struct(*[F.col(c) for c in order])
    agg = df.groupBy(key).agg(F.min_by(packed, ordering).alias("_first"))
    return agg.select(key, *[F.col("_first")[c].alias(c) for c in cols])


def newest(df: DataFrame, key: Column, name: str, id_col: str) -> DataFrame:
    """(name, id_col): the newest row (largest id) of each key.  Only the key and the id are
    shuffled, combined map-side."""
    return df.select(key.alias(name), id_col).groupBy(name).agg(F.max(id_col).alias(id_col))


def first_rows(df: DataFrame, key: Column, id_col: str, last: bool = False) -> DataFrame:
    """Whole rows of the first (or last) id of each key: the choice is made on narrow (key, id)
    rows; the wide rows are then kept by a semi join on the id, which must be unique."""
    pick = F.max if last else F.min
    ids = df.select(key.alias("_key"), id_col).groupBy("_key").agg(pick(id_col).alias("_id")).select("_id")
    return df.join(ids, F.col(id_col) == F.col("_id"), "left_semi")


def combine_feeds(frames: list[DataFrame]) -> DataFrame:
    """U-1: one item shape for all generators (missing columns become null)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def materialize(df: DataFrame) -> DataFrame:
    """Evaluate every column of ``df`` once, in its own projection.

    Catalyst pushes a filter below the projection that defines the filtered columns and
    substitutes their definitions, so a filter on an expensive derived column (a regex
    chain over a whole page) recomputes it.  A one-element ``inline`` is a Generate node:
    predicates on its output are not pushed below it, so downstream filters read the
    computed values instead.  It adds no shuffle and no copy beyond the projection."""
    return df.select(F.inline(F.array(F.struct(*[F.col(c) for c in df.columns]))))
