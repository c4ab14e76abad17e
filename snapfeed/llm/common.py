"""Helpers shared by the training-data operators."""

from __future__ import annotations

import contextlib
import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes of one Arrow batch, at most.  Documents may be long, so a batch is kept to a few MB.
ARROW_ROWS, ARROW_BYTES = 512, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings the Python stages rely on: Arrow batches are made smaller where the session's are larger."""
    for name, most in (("maxRecordsPerBatch", ARROW_ROWS), ("maxBytesPerBatch", ARROW_BYTES)):
        held = spark.conf.get(f"spark.sql.execution.arrow.{name}", None)
        held = int(re.sub(r"\D", "", held) or 0) if held and not held.startswith("-") else 0
        if not 0 < held <= most:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", str(most))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all machines of the cluster share: ``spark.checkpoint.dir``.  Where that is unset a run on one machine (tests)
    gets a fresh scratch folder; a cluster, whose machines would not see it, raises."""
    sc = spark.sparkContext
    current = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not current:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        current = tempfile.mkdtemp(prefix="llm-checkpoint-")
        spark.conf.set("spark.checkpoint.dir", current)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(current)
    return current


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder below the shared one, for tables that must outlive a stage."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpoint(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint: it survives the loss of any executor."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def stored(df: DataFrame, name: str) -> DataFrame:
    """Cut the lineage with a table written to the shared folder.  Unlike a checkpoint, which keeps the size estimate of the
    plan behind it, the table has its true size: loops that join a result with itself need that, as the estimate
    of a join is a product and would grow without end."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number ``name`` of its own for every row, written so that each read sees the same numbers."""
    return stored(df.withColumn(name, F.monotonically_increasing_id()), "numbered")


def identified(df: DataFrame, name: str) -> DataFrame:
    """``df`` with a number ``name`` that tells its rows apart, the same on every read: a hash of each row's place in its file, where
    ``df`` comes straight from files, else as ``numbered``, which writes the rows.  Two rows of one file table share a hash as
    rarely as 64 bits do; use it only to order rows that are equal otherwise."""
    try:
        return df.withColumn(name, F.xxhash64(F.col("_metadata.file_path"), F.col("_metadata.row_index")))
    except AnalysisException:
        return numbered(df, name)


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """One input table by its path, reading only ``columns``."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def unused(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, in any case."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        out.append(name)
        taken.add(name.lower())
    return out


def partitions(spark: SparkSession, rows: int, per_task: int) -> int:
    """Tasks for ``rows`` rows of which one task holds ``per_task`` at once; never fewer than the
    session's shuffle partitions, so the number of rows in one task stays bounded."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // per_task))


def heavy_keys(keys: DataFrame, key: str, row: str, block: int, most: int = 4000, one_in: int = 64) -> dict[int, int]:
    """Into how many blocks to split the rows of each overfull key: ``{key: blocks}``.

    Sizes are estimated on one row in ``one_in`` (by a hash of ``row``).  They only plan the
    partitioning: a key that the estimate misses makes a larger task, never another result.  At
    most ``most`` keys come back (a key counts as overfull from ``total / most`` rows on)."""
    sample = keys.where(F.pmod(F.xxhash64(F.lit(7), F.col(row)), F.lit(one_in)) == 0)
    counts = sample.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    least = block // one_in
    found = counts.where(F.col("n") >= least).orderBy(F.desc("n"), key).limit(most).collect()
    return {int(r[key]): min(4000, 1 + -(-int(r["n"]) * one_in // block)) for r in found}


def release() -> None:
    """Give memory that a task has freed back to the machine, where the C library can (glibc): a Python worker lives on
    between tasks and would keep the most it ever held."""
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on uint64: a cheap bijective scramble."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))  # a new array; the steps after it work in place
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


def hash_longs(*columns: np.ndarray) -> np.ndarray:
    """What Spark's ``xxhash64`` gives for int64 columns without nulls, as uint64."""
    p1, p2, p3, p4, p5 = (np.uint64(p) for p in (
        0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))

    def turned(x: np.ndarray, by: int) -> np.ndarray:
        return x << np.uint64(by) | x >> np.uint64(64 - by)

    with np.errstate(over="ignore"):
        h = np.full(len(columns[0]), 42, np.uint64)
        for c in columns:
            h = turned(h + (p5 + np.uint64(8)) ^ turned(c.astype(np.int64).view(np.uint64) * p2, 31) * p1, 27) * p1 + p4
            h = (h ^ h >> np.uint64(33)) * p2
            h = (h ^ h >> np.uint64(29)) * p3
            h ^= h >> np.uint64(32)
    return h


def word_chunks(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """The words of ``data`` between ASCII white space (bytes 09-0D and 20), in lists that
    come from about ``size`` bytes each, so that a huge text never makes one huge list."""
    at, n = 0, len(data)
    while at < n:
        end = min(n, at + size)
        while end < n and data[end] not in b" \t\n\r\x0b\x0c":
            end += 1
        yield data[at:end].split()
        at = end


def runs_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and lengths of the runs of equal values in sorted ``keys``."""
    if not len(keys):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return starts, np.diff(np.append(starts, len(keys)))


#: Bits of a membership bitmap: 8 MB, whatever the number of keys.
BITMAP_BITS = 26


def bitmap(keys: DataFrame, key: str) -> np.ndarray:
    """A Bloom filter of 64-bit hashes with two bits each, built by key in tasks.  Its size is fixed, so at most 2^20 words of
    it reach the driver; the more keys, the more others pass it as well, and an exact join must follow."""
    mask = F.lit((1 << BITMAP_BITS) - 1)
    bits = F.explode(F.array(F.col(key).bitwiseAND(mask), F.shiftrightunsigned(F.col(key), 32).bitwiseAND(mask)))
    at = keys.select(bits.alias("at")).select(F.shiftright("at", 6).cast("int").alias("word"), F.col("at").bitwiseAND(F.lit(63)).cast("int").alias("bit"))
    words = at.groupBy("word").agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits")).toArrow()
    out = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    out[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    return out.view(np.uint64)


def in_bitmap(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the uint64 ``keys`` may be among those of the bitmap."""
    mask = np.uint64((1 << BITMAP_BITS) - 1)
    out = np.ones(len(keys), bool)
    for at in (keys & mask, (keys >> np.uint64(32)) & mask):
        out &= (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1
    return out
