"""SimHash near-duplicates by deletion-variant signatures.

1. Each text gets a 64-bit SimHash of its word shingles (XXH64, seed 42), in Arrow batches.
2. Equal fingerprints are grouped first; only distinct ones go on.
3. For a distance of ``r`` bits a fingerprint is cut into ``r // 2 + 1`` segments, so that two
   fingerprints within ``r`` have a segment in which they differ by one bit at most.  Each
   segment is indexed once per bit with that bit left out (one wildcard); two segments that
   differ by at most that bit are then equal.  Fingerprints meet by equality of these variants.
4. Every pair that meets is verified on all 64 bits; the links' components are the groups.

An overfull variant is split into blocks that meet pairwise in tasks of their own, and a large
run yields a spanning forest of its verified links rather than all of its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import checkpoint, heavy_keys, mix64, numbered, partitions, prepare, release, runs_of, unused, word_chunks
from .graph import components

SEED = 42
#: Fingerprints of a variant that one task compares with each other; more are split into blocks.
BLOCK = 8192
#: Runs up to this length are compared by shifts, all runs of a task at once.
SMALL_RUN = 64
KEY_BITS = 27  # up to 64 variants (6 bits) of up to 21 bits


def shingle_hashes(data: bytes, k: int) -> Iterator[list[int]]:
    """XXH64 of each ``k``-word shingle (single-space joined) of lower-cased UTF-8, in lists; a
    text of fewer words is one shingle, one of no words none."""
    carry: list[bytes] = []
    any_full, xx = False, xxhash.xxh64_intdigest
    for words in word_chunks(data):
        words = carry + words
        if len(words) >= k:
            any_full = True
            joined = b" ".join(words)
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
            starts = np.concatenate(([0], ends[:-1]))[: len(words) - k + 1].tolist()
            yield [xx(joined[s:e], SEED) for s, e in zip(starts, (ends[k - 1:] - 1).tolist(), strict=True)]
            carry = words[len(words) - k + 1:]
        else:
            carry = words
    if not any_full and carry:
        yield [xx(b" ".join(carry), SEED)]


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the uint64 ``hashes`` have each of the 64 bits set."""
    total = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 32768):
        bits = np.unpackbits(hashes[at: at + 32768].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        # Sums of up to 255 rows fit a byte: add bytes first, widen after.
        n = len(bits) // 255 * 255
        if n:
            total += np.add.reduce(bits[:n].reshape(-1, 255, 64), axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
        total += bits[n:].sum(axis=0, dtype=np.int64)
    return total


def fingerprint(text: str | None, k: int) -> int:
    """64-bit SimHash: a bit is set if it is set in over half of the shingle hashes."""
    total, n = np.zeros(64, np.int64), 0
    for part in shingle_hashes((text or "").encode("utf-8", "surrogatepass").lower(), k):
        total += bit_counts(np.array(part, np.uint64))
        n += len(part)
    return int(np.packbits(total * 2 > n, bitorder="little").view(np.uint64)[0]) if n else 0


def fingerprints(docs: DataFrame, k: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp bigint) of each row's whole text.  Null, empty and blank texts have fingerprint 0;
    a null key stays null; repeated rows stay repeated; other columns are not read."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fps = np.array([fingerprint(t, k) for t in b.column(1).to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fps)], names=["key", "fp"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, fp long")


def segments(max_bits: int, width: int = 64) -> list[tuple[int, int]]:
    """(first bit, bits) of the ``max_bits // 2 + 1`` segments."""
    n = max_bits // 2 + 1
    cut = [width * i // n for i in range(n + 1)]
    return [(cut[i], cut[i + 1] - cut[i]) for i in range(n)]


def variants(fps: np.ndarray, max_bits: int) -> np.ndarray:
    """(64, n) int64: for each bit position the variant key of the segment that holds it, with
    that bit left out.  The position is part of the key."""
    out = np.empty((64, len(fps)), np.int64)
    for first, bits in segments(max_bits):
        seg = (fps >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        if bits > 22:  # too wide to keep whole next to the position; equal stays equal, pairs are verified
            squeeze = lambda x: mix64(x) >> np.uint64(43)
        else:
            squeeze = lambda x: x
        for j in range(bits):
            low = seg & np.uint64((1 << j) - 1)
            rest = squeeze(low | ((seg >> np.uint64(j + 1)) << np.uint64(j)))
            out[first + j] = (rest | np.uint64((first + j) << 21)).view(np.int64)
    return out


def _first_meeting(diff: np.ndarray, max_bits: int) -> np.ndarray:
    """For each XOR of two fingerprints within ``max_bits`` the one variant (bit position) by
    which the pair is reported: the first segment with at most one difference."""
    at = np.full(len(diff), -1, np.int64)
    for first, bits in segments(max_bits):
        d = (diff >> np.uint64(first)) & np.uint64((1 << bits) - 1)
        n = np.bitwise_count(d)
        here = (at < 0) & (n <= 1)
        # the differing bit, or the segment's first
        bit = np.where(n == 1, np.log2(np.maximum(d, np.uint64(1)).astype(np.float64)).astype(np.int64), 0)
        at[here] = first + bit[here]
    return at


def forest(fps: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the graph that links fingerprints within ``max_bits``."""
    a, b, left = [], [], np.unique(fps)
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            p = queue.pop()
            near = np.bitwise_count(left ^ p) <= max_bits
            if near.any():
                new = left[near]
                a.append(np.full(len(new), p))
                b.append(new)
                queue.extend(new)
                left = left[~near]
    none = np.zeros(0, np.uint64)
    return np.concatenate(a or [none]), np.concatenate(b or [none])


def links(fps: DataFrame, max_bits: int = 4) -> DataFrame:
    """Distinct fingerprints (fp bigint, checkpointed) -> verified links (a bigint, b bigint) that
    connect all fingerprints within ``max_bits`` of each other (a run of over ``SMALL_RUN`` in one
    variant gives a spanning forest of its links)."""
    if not 0 <= max_bits <= 20:
        raise ValueError("max_bits must be 0..20")
    spark = fps.sparkSession
    if max_bits == 0:
        return fps.limit(0).select(F.col("fp").alias("a"), F.col("fp").alias("b"))

    def keyed(heavy: dict[int, int]):
        hot = np.array(sorted(heavy), np.int64)
        parts = np.array([heavy[h] for h in sorted(heavy)], np.int64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                own = np.asarray(b.column(0)).astype(np.int64).view(np.uint64)
                keys, rows = variants(own, max_bits).ravel(), np.tile(own, 64)
                if len(hot):
                    at = np.searchsorted(hot, keys)
                    over = (at < len(hot)) & (hot[np.minimum(at, len(hot) - 1)] == keys)
                    more_k, more_r = [keys[~over]], [rows[~over]]
                    for g in np.unique(parts[at[over]]) if over.any() else ():
                        sel = np.flatnonzero(over)[parts[at[over]] == g]
                        mine = (mix64(rows[sel]) % np.uint64(g)).astype(np.int64)
                        for other in range(int(g)):
                            pair = np.minimum(mine, other) << 12 | np.maximum(mine, other)
                            met = mine != other  # two of one block meet beside any other block
                            more_k.append((keys[sel] | (pair << KEY_BITS) | (1 << 62))[met])
                            more_r.append(rows[sel][met])
                    keys, rows = np.concatenate(more_k), np.concatenate(more_r)
                for i in range(0, len(keys), 65536):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i: i + 65536]), pa.array(rows[i: i + 65536].view(np.int64))], names=["key", "fp"])
        return run

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [(np.asarray(b.column(0)), np.asarray(b.column(1))) for b in batches]
        if not got:
            return
        keys = np.concatenate([g[0] for g in got])
        own = np.concatenate([g[1] for g in got]).view(np.uint64)
        del got
        order = np.argsort(keys, kind="stable")
        keys, own = keys[order], own[order]
        starts, sizes = runs_of(keys)
        out_a, out_b = [], []
        for s, n in zip(starts[sizes > SMALL_RUN].tolist(), sizes[sizes > SMALL_RUN].tolist(), strict=True):
            a, b = forest(own[s: s + n], max_bits)
            out_a.append(a)
            out_b.append(b)
        small = np.repeat((sizes > 1) & (sizes <= SMALL_RUN), sizes)
        keys, own = keys[small], own[small]
        position = (keys >> 21) & 63
        for shift in range(1, SMALL_RUN):
            same = np.flatnonzero(keys[shift:] == keys[:-shift])
            if not len(same):
                break
            diff = own[same] ^ own[same + shift]
            near = (np.bitwise_count(diff) <= max_bits) & (diff != 0)
            same, diff = same[near], diff[near]
            once = (_first_meeting(diff, max_bits) == position[same]) | (keys[same] >> 62 == 1)
            out_a.append(own[same[once]])
            out_b.append(own[same[once] + shift])
        a, b = np.concatenate(out_a or [own[:0]]).view(np.int64), np.concatenate(out_b or [own[:0]]).view(np.int64)
        for i in range(0, len(a), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(a[i: i + 65536]), pa.array(b[i: i + 65536])], names=["a", "b"])
        del keys, own, order, a, b, out_a, out_b
        release()

    fps = fps.select("fp")
    in_sample = F.pmod(F.xxhash64(F.lit(7), F.col("fp")), F.lit(64)) == 0
    heavy = heavy_keys(fps.where(in_sample).mapInArrow(keyed({}), "key long, fp long"), "key", "fp", BLOCK)
    rows = fps.mapInArrow(keyed(heavy), "key long, fp long")
    n = partitions(spark, fps.count() * 64, 1_500_000)
    return rows.repartition(n, "key").mapInArrow(meet, "a long, b long")


def near_duplicates(docs: DataFrame, k: int = 4, max_bits: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fp bigint, component): documents whose fingerprints are linked by steps of at most
    ``max_bits`` bits share a component, named by its smallest key.

    Null or word-less texts have fingerprint 0 and link like any other; a null key belongs to a
    component but never names it (a component of null keys only has a null name); repeated rows
    come back repeated; an empty table gives no rows."""
    own = checkpoint(fingerprints(docs, k, text, key))
    distinct = checkpoint(own.groupBy("fp").agg(F.min("key").alias("least")))
    roots = components(links(distinct, max_bits)).withColumnRenamed("node", "fp")
    named = checkpoint(distinct.join(roots, "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root")))
    names = checkpoint(named.groupBy("root").agg(F.min("least").alias("component")))
    of = checkpoint(named.join(names, "root").select("fp", "component"))
    return own.join(of, "fp").select("key", "fp", "component")


def keep_one(docs: DataFrame, k: int = 4, max_bits: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` without all but one document of each group: the smallest key stays.

    Only the keys to drop are joined with the documents.  Rows with a null key are kept unless the
    group has another key; of rows that repeat the smallest key all are kept."""
    found = near_duplicates(docs, k, max_bits, text, key)
    (name,) = unused(docs, "_drop")
    drop = checkpoint(found.where(F.col("key") != F.col("component")).select(F.col("key").alias(name)).distinct())
    return docs.join(drop, F.col(key) == F.col(name), "left_anti")


def keep_row(docs: DataFrame, k: int = 4, max_bits: int = 4, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of each group of near-duplicates in ``docs``: that with the smallest key, null last; of equal keys that with the
    smallest hash of its text, then the first.  Rows are told apart by a number, so keys may be null or repeated."""
    (row,) = unused(docs, "_row")
    own = numbered(docs, row)
    found = near_duplicates(own, k, max_bits, text, row).select("key", "component")
    order = F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("id"), F.xxhash64(text).alias("hash"), F.col(row).alias("row"))
    named = checkpoint(found.join(own.select(order.alias("order")), F.col("key") == F.col("order.row")).select("component", "order"))
    stay = named.groupBy("component").agg(F.min("order").alias("order")).select(F.col("order.row").alias("stay"))
    drop = checkpoint(named.select(F.col("order.row").alias("_drop")).join(stay, F.col("_drop") == F.col("stay"), "left_anti"))
    name = unused(own, "_drop")[0]
    drop = drop.withColumnRenamed("_drop", name)
    return own.join(drop, F.col(row) == F.col(name), "left_anti").select(docs.columns)
