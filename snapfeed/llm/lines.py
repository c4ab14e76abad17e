"""Fuzzy line deduplication by MinHash.

Lines (between newlines) count as the same if, trimmed and lower-cased, the sets of their character shingles
have a Jaccard similarity over a threshold, directly or by steps; of each group the first line in order of
(document, line) stays.

1. Tasks hash each line and compute its MinHash signature over 7-character shingles; equal lines meet by a
   128-bit hash, with a partial aggregation, and only the first of each goes on.
2. Signatures are cut into 10 bands of 4 (recall over 0.994 from a similarity of 0.8 on).  Lines that share a
   band form a run; equal runs of different bands are taken up once.
3. Only the lines in runs are fetched as text, each from its first place: a bitmap of fixed size lets few other places
   through a second pass, a join by the place leaves those out.  Each run is verified exactly, which gives a spanning forest
   of its links.
4. The links' components by distributed union-find name the lines that go; their numbers and those of all different lines
   meet in their documents.

An overfull band is split into blocks that meet pairwise in tasks of their own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, checkpoint, hash_longs, heavy_keys, identified, in_bitmap, mix64, partitions, prepare, release, runs_of, unused
from .graph import components

SHINGLE = 7
BANDS, ROWS = 10, 4
CHARS = 300_000
#: Lines of a band that one task compares with each other; more are split into blocks.
BLOCK = 4096
#: Band keys of a task that are dealt to the tasks of their shuffle at once.
DEALT = 1 << 20
#: Runs up to this length are compared pair by pair; longer ones as arrays.
SMALL_RUN = 32
LEAST = -(2**63)
PLACE = ["did", "thash", "row", "line"]
_rng = np.random.default_rng(20240)
_A = (_rng.integers(0, 1 << 31, BANDS * ROWS, np.uint32) << np.uint32(1)) | np.uint32(1)
_B = _rng.integers(0, 1 << 32, BANDS * ROWS, np.uint32)


def normal(line: str) -> str:
    return line.strip().lower()


def shingle_hashes(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all character shingles of normal lines, one after the other, and where each line's begin.  A line
    shorter than a shingle is one shingle."""
    padded = [x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\0") for x in lines]
    size = np.fromiter(map(len, padded), np.int64, len(padded))
    c = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    with np.errstate(over="ignore"):
        p = np.uint64(0x9E3779B97F4A7C15)
        two = c[:-1] * p + c[1:]
        four = two[:-2] * (p * p) + two[2:]
        h = mix64(four[:-3] * (p * p * p) + two[4:-1] * p + c[6:])  # characters 1-4, 5-6 and 7
    ends = np.cumsum(size)
    inside = np.ones(len(c), bool)
    for j in range(1, SHINGLE):
        inside[ends - j] = False
    return h[inside[: len(h)]], np.cumsum(size - SHINGLE + 1) - (size - SHINGLE + 1)


def band_keys(lines: list[str]) -> np.ndarray:
    """(lines, BANDS) uint64: the hashes by whose equality lines meet."""
    out, lo = np.empty((len(lines), BANDS), np.uint64), 0
    while lo < len(lines):
        hi, n = lo, 0
        while hi < len(lines) and (hi == lo or n + len(lines[hi]) <= CHARS):
            n += len(lines[hi])
            hi += 1
        h, starts = shingle_hashes(lines[lo:hi])
        x = (h >> np.uint64(32)).astype(np.uint32)
        least = np.empty((BANDS * ROWS, hi - lo), np.uint32)
        t = np.empty_like(x)
        with np.errstate(over="ignore"):
            for i in range(BANDS * ROWS):
                np.multiply(x, _A[i], out=t)
                np.add(t, _B[i], out=t)
                np.minimum.reduceat(t, starts, out=least[i])
            for band in range(BANDS):
                key = np.full(hi - lo, band + 1, np.uint64)
                for row in least[band * ROWS: (band + 1) * ROWS]:
                    key = mix64(key * np.uint64(0x9E3779B97F4A7C15) + row)
                out[lo:hi, band] = key
        lo = hi
    return out


def _digests(lines: list[str]) -> list[bytes]:
    return [xxhash.xxh3_128_digest(x.encode("utf-8", "surrogatepass")) for x in lines]


def _halves(digests: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)


def _split(text: str | None) -> list[tuple[int, str]]:
    """(number, normal line) of each line that is not blank."""
    return [(i, normal(x)) for i, x in enumerate(text.split("\n")) if x.strip(" \t\n\r\x0b\x0c")] if text else []


def first_lines(rows: DataFrame) -> DataFrame:
    """(did, thash, row, text) -> each different line once: the first (did, thash, row, line, n), where n counts the lines of its
    document that are not blank, and its bands."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held: dict[bytes, tuple[int, int, int, int, int]] = {}
            text_of: dict[bytes, str] = {}
            for did, thash, row, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
                own = _split(text)
                for (i, line), d in zip(own, _digests([x for _, x in own]), strict=True):
                    at = (did, thash, row, i, len(own))
                    if d not in held:
                        held[d], text_of[d] = at, line
                    elif at < held[d]:
                        held[d] = at
            if held:
                h, where = _halves(list(held)), list(zip(*held.values(), strict=True))
                keys = band_keys(list(text_of.values()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[:, 0]), pa.array(h[:, 1]), *(pa.array(w, pa.int64()) for w in where), pa.array([k.tobytes() for k in keys], pa.binary())],
                    names=["h1", "h2", "did", "thash", "row", "line", "n", "bands"])

    found = rows.mapInArrow(run, "h1 long, h2 long, did long, thash long, row long, line long, n long, bands binary")
    return (found.groupBy("h1", "h2").agg(F.min(F.struct("did", "thash", "row", "line", "n")).alias("at"), F.first("bands").alias("bands"))
            .select("at", "bands"))


def _runs(lines: DataFrame) -> DataFrame:
    """(id, bands) -> (part, run, id): the lines that share a band, each different set of them once.  Small runs with the same
    first line have the same part."""

    def keyed(heavy: dict[int, int]):
        hot = np.array(sorted(heavy), np.int64)
        parts = np.array([heavy[h] for h in sorted(heavy)], np.int64)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                ids = np.asarray(b.column(0)).astype(np.int64)
                keys = np.frombuffer(b"".join(b.column(1).to_pylist()), np.int64)
                rows = np.repeat(ids, BANDS)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, keys), len(hot) - 1)
                    over = np.flatnonzero(hot[at] == keys)
                    more_k, more_r = [np.delete(keys, over)], [np.delete(rows, over)]
                    for g in np.unique(parts[at[over]]):
                        sel = over[parts[at[over]] == g]
                        mine = (mix64(rows[sel].view(np.uint64)) % np.uint64(g)).astype(np.int64)
                        for other in range(int(g)):
                            met = mine != other  # two of one block meet beside any other block
                            pair = (np.minimum(mine, other) << 12 | np.maximum(mine, other)) + 1
                            more_k.append(mix64(keys[sel].view(np.uint64) ^ mix64(pair.view(np.uint64))).view(np.int64)[met])
                            more_r.append(rows[sel][met])
                    keys, rows = np.concatenate(more_k), np.concatenate(more_r)
                for i in range(0, len(keys), 65536):
                    yield pa.RecordBatch.from_arrays([pa.array(keys[i: i + 65536]), pa.array(rows[i: i + 65536])], names=["key", "id"])
        return run

    def dealt(heavy: dict[int, int], n: int):
        """As ``keyed``, with all keys and ids for one of ``n`` tasks in one row: a row for each key costs more than all else here."""

        def deal(got: list[pa.RecordBatch]) -> pa.RecordBatch:
            keys, ids = (np.concatenate([np.asarray(b.column(c)) for b in got]) for c in (0, 1))
            task = (keys.view(np.uint64) % np.uint64(n)).astype(np.int32)
            order = np.argsort(task)
            starts, sizes = runs_of(task[order])
            ends = (np.append(starts, len(keys)) * 8).astype(np.int32)
            packed = [pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(x[order])]) for x in (keys, ids)]
            return pa.RecordBatch.from_arrays([pa.array(task[order[starts]]), *packed], names=["task", "keys", "ids"])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for b in keyed(heavy)(batches):
                held.append(b)
                size += b.num_rows
                if size >= DEALT:
                    yield deal(held)
                    held, size = [], 0
            if size:
                yield deal(held)
            release()
        return run

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [[np.frombuffer(x.as_py(), np.int64) for x in c] for b in batches for c in b.columns[1:]]
        if not got:
            return
        keys, ids = (np.concatenate([x for c in got[i::2] for x in c]) for i in (0, 1))
        del got
        order = np.argsort(keys)
        keys, ids = keys[order], ids[order]
        starts, sizes = runs_of(keys)
        many = np.repeat(sizes > 1, sizes)
        ids, sizes = ids[many], sizes[sizes > 1]
        if not len(ids):
            return
        begin = np.cumsum(sizes) - sizes
        with np.errstate(over="ignore"):
            run = mix64(np.add.reduceat(mix64(ids.view(np.uint64)), begin) ^ sizes.astype(np.uint64)).view(np.int64)
        part = np.where(sizes <= SMALL_RUN, np.minimum.reduceat(ids, begin), run)
        run, part = np.repeat(run, sizes), np.repeat(part, sizes)
        for i in range(0, len(ids), 65536):
            yield pa.RecordBatch.from_arrays([pa.array(x[i: i + 65536]) for x in (part, run, ids)], names=["part", "run", "id"])
        del keys, order, ids, run, part
        release()

    lines = lines.select("id", "bands")
    in_sample = F.pmod(F.xxhash64(F.lit(7), F.col("id")), F.lit(64)) == 0
    few_tasks = max(1, partitions(lines.sparkSession, 0, 1) // 8)  # a sample is small beside what a task costs
    heavy = heavy_keys(lines.where(in_sample).coalesce(few_tasks).mapInArrow(keyed({}), "key long, id long"), "key", "id", BLOCK)
    n = partitions(lines.sparkSession, lines.count() * BANDS, 1_500_000)
    return (lines.mapInArrow(dealt(heavy, n), "task int, keys binary, ids binary").repartitionById(n, "task")
            .mapInArrow(meet, "part long, run long, id long").distinct())


def shingle_arrays(lines: list[str]) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of each line."""
    out: list[np.ndarray] = []
    lo = 0
    while lo < len(lines):
        hi, n = lo, 0
        while hi < len(lines) and (hi == lo or n + len(lines[hi]) <= CHARS):
            n += len(lines[hi])
            hi += 1
        h, starts = shingle_hashes(lines[lo:hi])
        for x in np.split(h, starts[1:]):
            x.sort()
            out.append(x if len(x) < 2 else x[np.concatenate(([True], x[1:] != x[:-1]))])
        lo = hi
    return out


def alike(a: np.ndarray, b: np.ndarray, least: float) -> bool:
    """Whether the Jaccard similarity of two sorted distinct arrays is at least ``least``."""
    if min(len(a), len(b)) < least * max(len(a), len(b)) - 1e-9:
        return False
    c = np.concatenate((a, b))
    c.sort()
    both = int(np.count_nonzero(c[1:] == c[:-1]))
    return both >= least * (len(c) - both) - 1e-9


def few(runs: list[list[int]], own: dict[int, np.ndarray], least: float) -> list[tuple[int, int]]:
    """Verified links among the lines of small runs that share their first line; lines that are connected already are
    not compared again."""
    root = {i: i for run in runs for i in run}

    def find(i: int) -> int:
        while root[i] != i:
            i = root[i]
        return i

    edges: list[tuple[int, int]] = []
    for run in runs:
        for n, i in enumerate(run):
            for j in run[:n]:
                a, b = find(i), find(j)
                if a != b and alike(own[i], own[j], least):
                    edges.append((i, j))
                    root[max(a, b)] = min(a, b)
    return edges


def forest(lines: list[str], least: float) -> list[tuple[int, int]]:
    """Edges (numbers) of a spanning forest of the graph that links lines with a Jaccard similarity of at least ``least``."""
    own = shingle_arrays(lines)
    edges: list[tuple[int, int]] = []
    left = np.arange(len(lines))
    sizes = np.array([len(x) for x in own], np.int64)
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            p = queue.pop()
            fit = left[(np.minimum(sizes[left], sizes[p]) >= least * np.maximum(sizes[left], sizes[p]) - 1e-9)]
            if not len(fit):
                continue
            flat = np.concatenate([own[i] for i in fit])
            at = np.minimum(np.searchsorted(own[p], flat), sizes[p] - 1)
            both = np.add.reduceat((own[p][at] == flat).astype(np.int64), np.cumsum(sizes[fit]) - sizes[fit])
            new = fit[both >= least * (sizes[fit] + sizes[p] - both) - 1e-9]
            edges += [(p, int(i)) for i in new]
            queue += new.tolist()
            left = np.setdiff1d(left, new, assume_unique=True)
    return edges


def links(lines: DataFrame, rows: DataFrame, least: float) -> tuple[DataFrame, DataFrame]:
    """Verified links (a, b) of the lines (id, at, bands; checkpointed) of the texts in ``rows``, and the lines (id, at) that
    may have one."""
    spark = lines.sparkSession
    runs = checkpoint(_runs(lines))
    need = checkpoint(lines.join(runs.select("id").distinct(), "id").select("id", "at"))
    bits = spark.sparkContext.broadcast(bitmap(need.select(F.xxhash64("at.row", "at.line").alias("place")), "place"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            own = [t.split("\n") if t else [] for t in b.column(3).to_pylist()]
            size = np.fromiter(map(len, own), np.int64, len(own))
            doc = np.repeat(np.arange(len(own)), size)
            line = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size)
            at = np.flatnonzero(in_bitmap(bits.value, hash_longs(np.asarray(b.column(2))[doc], line)))
            if len(at):
                doc, line = doc[at], line[at]
                text = [normal(own[d][i]) for d, i in zip(doc.tolist(), line.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([*(b.column(c).take(pa.array(doc)) for c in range(3)), pa.array(line), pa.array(text, pa.string())], names=[*PLACE, "text"])

    texts = rows.select("did", "thash", "row", "text").mapInArrow(fetch, "did long, thash long, row long, line long, text string")
    members = runs.join(need.select("id", "at.*").join(texts, PLACE).select("id", "text"), "id")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, list[tuple[int, list[int]]]]] = []  # (part, its runs) in order
        text_of: dict[int, str] = {}

        def settle() -> Iterator[pa.RecordBatch]:
            edges: list[tuple[int, int]] = []
            small = sorted({i for _, runs_ in held for _, run in runs_ if len(run) <= SMALL_RUN for i in run})
            own = dict(zip(small, shingle_arrays([text_of[i] for i in small]), strict=True))
            for _, runs_ in held:
                edges += few([run for _, run in runs_ if len(run) <= SMALL_RUN], own, least)
                for _, run in runs_:
                    if len(run) > SMALL_RUN:
                        edges += [(run[a], run[b]) for a, b in forest([text_of[i] for i in run], least)]
            held.clear()
            text_of.clear()
            if edges:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*edges, strict=True)], names=["a", "b"])

        for b in batches:
            for p, r, i, t in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if not held or held[-1][0] != p:
                    if len(text_of) >= 1000:
                        yield from settle()
                    held.append((p, []))
                if not held[-1][1] or held[-1][1][-1][0] != r:
                    held[-1][1].append((r, []))
                held[-1][1][-1][1].append(i)
                text_of[i] = t
        yield from settle()
        release()

    n = partitions(spark, runs.count(), 200_000)
    members = members.select("part", "run", "id", "text").repartition(n, "part").sortWithinPartitions("part", "run", "id")
    return members.mapInArrow(verify, "a long, b long"), need


def dedup(docs: DataFrame, least: float = 0.8, text: str = "text", key: str = "doc_id", counts: tuple[str, str] | None = None) -> DataFrame:
    """``docs`` with the text without the lines that repeat an earlier one of any document, in order of (key, line); with
    ``counts`` also two columns of these names: lines that are not blank, and lines kept.

    A document that keeps all its lines is unchanged; one that loses lines is rebuilt from those it keeps, without its blank
    lines; one that loses all has an empty text.  Blank lines match nothing; null, empty and blank texts are unchanged.  The key is
    an integer; null keys come first.  Rows with equal keys are ordered by a hash of their text, and of rows equal in both the one
    that comes first by its place (``identified``) keeps the lines.  Other columns are carried along, whatever their names."""
    prepare(docs.sparkSession)
    columns = docs.columns
    (row,) = unused(docs, "_place")
    docs = identified(docs, row)
    did, thash = F.coalesce(F.col(key).cast("long"), F.lit(LEAST)), F.xxhash64(F.col(text))
    number = F.col(row)
    rows = docs.select(did.alias("did"), thash.alias("thash"), number.alias("row"), F.col(text).alias("text"))
    lines = checkpoint(first_lines(rows).withColumn("id", F.monotonically_increasing_id()))
    linked, need = links(lines, rows, least)
    roots = components(linked).select(F.col("node").alias("id"), "root")
    found = need.join(roots, "id")
    first = found.groupBy("root").agg(F.min(F.struct("at", "id")).alias("first")).select(F.col("first.id").alias("id"))
    lost = found.join(first, "id", "left_anti").select("at.*", F.lit(True).alias("goes"))
    d, t, r, of, hashed, owner, stay, full = unused(docs, "_did", "_thash", "_row", "_of", "_of_hash", "_of_row", "_stay", "_full")
    number_of = F.col("line").cast("int")
    numbers = lines.select("at.*", F.lit(False).alias("goes")).union(lost).groupBy(F.col("did").alias(of), F.col("thash").alias(hashed), F.col("row").alias(owner)).agg(
        F.collect_list(F.when(~F.col("goes"), number_of)).alias(stay), F.collect_list(F.when(F.col("goes"), number_of)).alias("out"), F.max("n").alias(full))
    numbers = numbers.select(of, hashed, owner, full, F.array_sort(F.array_except(stay, "out")).alias(stay))
    # the hash table has numbers alone; texts are not sorted
    joined = docs.withColumn(d, did).withColumn(t, thash).withColumn(r, number).join(
        numbers.hint("shuffle_hash"), (F.col(d) == F.col(of)) & (F.col(t) == F.col(hashed)) & (F.col(r) == F.col(owner)), "left")
    # a document without a first line of any group has no count
    inked = r"[^ \t\n\r\x0B\f]"
    parts = F.split(F.col(text), "\n", -1)
    keep = F.coalesce(stay, F.array().cast("array<int>"))
    size = F.coalesce(F.col(full), F.size(F.filter(parts, lambda x: x.rlike(inked))).cast("long"), F.lit(0))
    # a lambda's body is evaluated for each element: the text is split once, outside, and bound by a list of one
    rebuilt = F.get(F.transform(F.array(parts), lambda own: F.array_join(F.transform(keep, lambda i: F.get(own, i)), "\n")), F.lit(0))
    new = (F.when(F.size(keep) == F.col(full), F.col(text)).when(F.size(keep) > 0, rebuilt)
           .when(F.col(text).rlike(inked), F.lit("")).otherwise(F.col(text)))
    extra = [size.alias(counts[0]), F.size(keep).cast("long").alias(counts[1])] if counts else []
    return joined.select(*[new.alias(c) if c == text else F.col(c) for c in columns], *extra)
