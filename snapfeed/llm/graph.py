"""Connected components of an edge table by repeated contraction (distributed union-find)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored


def components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(a bigint, b bigint) -> (node bigint, root bigint): equal roots, same component.

    Every round hooks each vertex to the smallest vertex of its closed neighbourhood (by id in
    even rounds, by a fresh random order in odd ones), follows that link once more, and replaces
    the edges' ends by what they were hooked to; only edges between different ends stay.  Each
    pair of rounds shrinks the graph by a constant factor in expectation, so a long chain takes
    O(log n) rounds.  The links of the rounds are joined up at the end.  Loops and repeated
    edges do no harm, null ends are dropped; no edges give no rows.  All tables are
    distributed and written to the shared folder; a vertex with very many neighbours is pre-aggregated by the
    partial ``min`` and split by the adaptive skew join."""
    rest = stored(_simple(edges.select(F.col("a").cast("long"), F.col("b").cast("long"))), "edges")
    links: list[DataFrame] = []
    while not rest.isEmpty():
        if len(links) == max_rounds:
            raise RuntimeError(f"components did not converge in {max_rounds} rounds")
        links.append(_hook(rest, len(links)))
        to = links[-1]
        ends = (rest.join(to.select(F.col("node").alias("a"), F.col("root").alias("_a")), "a")
                .join(to.select(F.col("node").alias("b"), F.col("root").alias("_b")), "b"))
        rest = stored(_simple(ends.select(F.col("_a").alias("a"), F.col("_b").alias("b"))), "edges")
    if not links:
        return rest.select(F.col("a").alias("node"), F.col("b").alias("root"))
    found = links.pop()
    while links:
        later = found.select(F.col("node").alias("root"), F.col("root").alias("_later"))
        found = (links.pop().join(later, "root", "left")
                 .select("node", F.coalesce("_later", "root").alias("root")))
        found = stored(found, "roots")
    return found


def _simple(edges: DataFrame) -> DataFrame:
    """Distinct undirected edges without loops."""
    return (edges.where("a != b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
            .distinct())


def _hook(edges: DataFrame, turn: int) -> DataFrame:
    rank = (lambda c: F.xxhash64(F.lit(turn), F.col(c))) if turn % 2 else (lambda c: F.col(c))
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    best = both.groupBy("a").agg(F.min(rank("b")).alias("_r"), F.min_by("b", rank("b")).alias("_b"))
    hooked = F.when(F.col("_r") < rank("a"), F.col("_b")).otherwise(F.col("a"))
    first = stored(best.select(F.col("a").alias("node"), hooked.alias("root")), "hooks")
    second = first.select(F.col("node").alias("root"), F.col("root").alias("_next"))
    return stored(first.join(second, "root").select("node", F.col("_next").alias("root")), "links")
