"""Ordered carry-forward, numbering and joining of texts without a per-key window (W-2, W-3, A-2, A-3).

``last(value, ignorenulls) over (partition by key order by ...)`` puts every row of a key in
one task; a key holding a third of the data makes that task a third of the job.  This is the
same result as a prefix scan in Spark operators:

1. range-partition on (key, order): a hot key is cut into contiguous ranges; the range's number
   becomes a column, and a checkpoint in the shared folder fixes it;
2. inside each (range, key) the window carries values forward: no window partition is larger
   than a range;
3. one row per (range, key) holds its last non-null value; a window over a key's ranges, as
   many as the key was cut into, gives what it carries into each later range;
4. a join on (range, key) fills the rows before the range's first value.

Numbers (W-3) and joined texts (A-2, A-3) come from the same ranges: each counts or joins its own rows, and what the ranges of a key
give, one row each, is summed or joined in their order.

Nothing reaches the driver, and types are Spark's own throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def _ranged(df: DataFrame, key: str, order_cols: list[str], num_partitions: int | None) -> DataFrame:
    """``df`` in ranges of (key, order), with the range's number as ``_part``, fixed by a checkpoint."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    n = int(num_partitions or spark.conf.get("spark.sql.shuffle.partitions"))
    return df.repartitionByRange(n, key, *order_cols).withColumn("_part", F.spark_partition_id()).checkpoint(eager=True)


def number_rows(df: DataFrame, key: str, order_cols: list[str], out_col: str, num_partitions: int | None = None) -> DataFrame:
    """W-3: ``out_col`` is the number of each row, from 0 on, among the rows of its key in order of ``order_cols``, which
    tell a key's rows apart.  Rows with a null key form one group."""
    ranged = _ranged(df, key, order_cols, num_partitions)
    inside = Window.partitionBy("_part", key).orderBy(*order_cols)
    numbered = ranged.withColumn(out_col, F.row_number().over(inside) - 1)
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    counts = ranged.groupBy("_part", key).agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select(F.col("_part").alias("_of"), F.col(key).alias("_key"), F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    joined = numbered.join(before, (F.col("_part") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_key")))
    return joined.select(*df.columns, (F.col(out_col) + F.col("_before")).cast("bigint").alias(out_col))


def ordered_concat(df: DataFrame, key: str, order_cols: list[str], value_col: str, separator: str, out_col: str,
                   num_partitions: int | None = None) -> DataFrame:
    """A-2 / A-3: (key, out_col, n): the non-null ``value_col`` of each key joined in order of ``order_cols``, null without any, and
    the number of rows.  A range sorts and joins its own rows of a key; the joined texts of a key's ranges, in order, make the
    whole, so no task sorts or holds the rows of a large key."""
    ranged = _ranged(df, key, order_cols, num_partitions)
    pair = F.when(F.col(value_col).isNotNull(), F.struct(*order_cols, F.col(value_col).alias("_value")))
    parts = ranged.groupBy("_part", key).agg(F.array_sort(F.collect_list(pair)).alias("_pairs"), F.count(F.lit(1)).alias("_n"))
    parts = parts.select("_part", key, "_n", F.when(F.size("_pairs") > 0, F.array_join(F.transform("_pairs", lambda p: p["_value"]), separator)).alias("_text"))
    whole = parts.groupBy(key).agg(F.array_sort(F.collect_list(F.when(F.col("_text").isNotNull(), F.struct("_part", "_text")))).alias("_parts"), F.sum("_n").alias("n"))
    return whole.select(key, F.when(F.size("_parts") > 0, F.array_join(F.transform("_parts", lambda p: p["_text"]), separator)).alias(out_col), "n")


def carry_forward(df: DataFrame, key: str, order_cols: list[str], value_col: str, out_col: str,
                  num_partitions: int | None = None) -> DataFrame:
    """W-2: ``out_col`` is the last non-null ``value_col`` of the same key up to each row, in order
    of ``order_cols``.  Rows with a null key form one group."""
    ranged = _ranged(df, key, order_cols, num_partitions)
    inside = Window.partitionBy("_part", key).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = ranged.withColumn(out_col, F.last(value_col, ignorenulls=True).over(inside))
    at = F.when(F.col(value_col).isNotNull(), F.struct(*order_cols))
    ends = ranged.groupBy("_part", key).agg(F.max_by(value_col, at).alias("_end"))
    earlier = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(F.col("_part").alias("_of"), F.col(key).alias("_key"), F.last("_end", ignorenulls=True).over(earlier).alias("_carry"))
    carried = carried.where(F.col("_carry").isNotNull())
    joined = filled.join(carried, (F.col("_part") == F.col("_of")) & F.col(key).eqNullSafe(F.col("_key")), "left")
    return joined.select(*df.columns, F.coalesce(F.col(out_col), F.col("_carry")).alias(out_col))
