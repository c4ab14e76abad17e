"""Benchmark decontamination by SimHash over item-sized windows.

An item is known by the fingerprints of windows inside it: of W words at places W / 4 apart, W the largest step of a fixed ladder
that is at most 0.6 of its length (the whole item up to eight words).  What a similarity of 0.8 allows to differ in five-word
shingles is an edit at the ends or one in some tens of words, so of these windows, which leave out either end or both, some stay as
they are or lose a word.  In every document the fingerprints of all windows of W words come from sums of the
words' hash bits.  Of r // 2 + 1 blocks (four at least) two fingerprints within r bits differ by one bit at most in some block;
each block's index lists an item under all values that close to its own (multi-index hashing), so every pair within the radius is
found.  A window says where in the document the item would lie; candidates are verified exactly: the item's shingles (five
words, the whole item if shorter) against those of the passage at that place, as weighted Jaccard similarity with
multiplicities.  A shingle of the item weighs 1 / number of items that contain it, any other 1.

The windows are found by fingerprints alone, so a passage whose windows all differ by more than the radius is lost: recall is
high, not certain (README).  Weights are counted over the whole benchmark and windows follow from an item's own
length, so how items are dealt out over passes changes no result.

Words are runs of letters, digits, ``_`` and non-ASCII characters of the lower-cased text.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import checkpoint, mix64, prepare, release, stored

SHINGLE = 5
#: Window sizes: whole short items, then steps of a third up to what fits a byte.
WINDOWS = (1, 2, 3, 4, 5, 6, 7, 8, 11, 15, 20, 27, 36, 48, 64, 85, 113, 150, 200)
WHOLE = 8  # words up to which an item is its own window
#: Benchmark items and bytes broadcast at once; more are taken in further passes over the documents.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 32 << 20
PIECE = 1 << 19  # bytes hashed at once
STEP = 8192  # window places taken up at once
BASE = 0x9E3779B97F4A7C15
_WORD = bytes(b if b >= 128 or chr(b).isalnum() or b == 95 else 32 for b in range(256))
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the hash base and of its inverse."""
    if not _powers or len(_powers[0]) < n:
        _powers[:] = [np.multiply.accumulate(np.append(np.uint64(1), np.full(n, b, np.uint64)))
                      for b in (np.uint64(BASE), np.uint64(pow(BASE, -1, 1 << 64)))]
    return _powers


def _hash_piece(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(hash, end) of each word of blank-separated bytes."""
    raw = np.frombuffer(data, np.uint8)
    edge = np.diff((raw != 32).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _power_tables(max(len(raw), PIECE))
    with np.errstate(over="ignore"):
        sums = np.append(np.uint64(0), np.cumsum(raw * power[: len(raw)], dtype=np.uint64))
        return mix64((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), ends


def hash_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Word hashes of all texts in a row, and where each text ends; null texts have no words."""
    hashes, counts = [], np.zeros(len(texts), np.int64)
    group: list[bytes] = []
    owners: list[int] = []
    size = 0

    def settle() -> None:
        nonlocal group, owners, size
        if group:
            h, ends = _hash_piece(b" ".join(group))
            upto = np.searchsorted(ends, np.cumsum([len(g) + 1 for g in group]))
            np.add.at(counts, owners, np.diff(upto, prepend=0))
            hashes.append(h)
        group, owners, size = [], [], 0

    for i, t in enumerate(texts):
        data = (t or "").lower().encode("utf-8", "surrogatepass").translate(_WORD)
        at = 0
        while at < len(data):
            end = min(len(data), at + PIECE)
            if end < len(data):
                blank = data.find(b" ", end)
                end = len(data) if blank < 0 else blank
            if size and size + end - at > PIECE:
                settle()
            group.append(data[at:end])
            owners.append(i)
            size += end - at + 1
            at = end
    settle()
    return np.concatenate(hashes or [np.zeros(0, np.uint64)]), np.cumsum(counts)


def shingles(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of the ``k`` words from each place on."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for j in range(k):
            h = (h + words[j: n + j]) * np.uint64(0xD6E8FEB86659FD93 + 2 * j)
    return mix64(h)


def windows(words: np.ndarray, sizes: list[int]) -> Iterator[tuple[int, int, np.ndarray]]:
    """(size, first place, SimHashes of the windows from there on), by steps of places."""
    largest = max(sizes)
    for at in range(0, len(words), STEP):
        part = words[at: at + STEP + largest - 1]
        # sums of 1, 2, 4, ... words; a window of at most 200 words fits a byte
        sums = [np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1)]
        while 2 << len(sums) - 1 <= min(largest, len(part)):
            half = 1 << len(sums) - 1
            sums.append(sums[-1][half:] + sums[-1][:-half])
        for w in sizes:
            n = min(STEP, len(part) - w + 1)
            if n > 0:
                own, done = None, 0
                for j in reversed(range(w.bit_length())):
                    if w >> j & 1:
                        some = sums[j][done: done + n]
                        own, done = some if own is None else own + some, done + (1 << j)
                yield w, at, np.packbits((own > w // 2).ravel()).view(np.uint64)


@dataclass
class Block:
    """Fingerprints of one class by the values of one block that differ from theirs by at most one bit."""

    shift: int
    mask: int
    held: np.ndarray  # whether any has the value
    first: np.ndarray  # value -> first entry
    fp: np.ndarray
    entry: np.ndarray  # -> (item, offset of the fingerprint's window in it)


@dataclass
class Index:
    """The items of one pass."""

    ids: list
    words: list[np.ndarray]
    weights: dict[int, float]  # of shingles that several items contain; any other weighs 1
    totals: np.ndarray  # weight of each item's shingles
    classes: dict[int, tuple[np.ndarray, np.ndarray, list[Block]]]  # window -> items and offsets by entry, blocks
    keys: np.ndarray  # of (item, shingle), sorted
    key_weights: np.ndarray
    radius: int


def window_of(length: int) -> int:
    """The window size of an item of ``length`` words."""
    return length if length <= WHOLE else max(w for w in WINDOWS if w <= 0.6 * length)


def item_shingles(text: str | None) -> np.ndarray:
    """Hashes of an item's shingles; none without words."""
    words = hash_words([text])[0]
    return shingles(words, min(SHINGLE, len(words))) if len(words) else np.zeros(0, np.uint64)


def build_index(items: list[tuple], radius: int = 7, shared: dict[int, int] | None = None) -> Index:
    """Items (id, text) with at least one word; null and word-less ones match nothing and are left out.  ``shared`` has the shingles that
    several items of the whole benchmark contain, with the number of items; by default ``items`` are the whole benchmark."""
    if not 0 <= radius <= 15:
        raise ValueError("radius must be 0..15")
    held = [(i, w) for i, w in ((i, hash_words([t])[0]) for i, t in items if t) if len(w)]
    own = [shingles(w, min(SHINGLE, len(w))) for _, w in held]
    if shared is None:
        shared = {x: n for x, n in Counter(x for s in own for x in set(s.tolist())).items() if n > 1}
    weights = {x: 1.0 / n for x, n in shared.items()}
    weight = [np.array([weights.get(x, 1.0) for x in s.tolist()]) for s in own]
    classes: dict[int, list[int]] = {}
    for j, (_, w) in enumerate(held):
        classes.setdefault(window_of(len(w)), []).append(j)
    built = {}
    n_blocks = max(4, radius // 2 + 1)
    cuts = [64 * i // n_blocks for i in range(n_blocks + 1)]
    for size, members in classes.items():
        entries = sorted({(j, off) for j in members for off in (*range(0, len(held[j][1]) - size, max(1, size // 4)), len(held[j][1]) - size)})
        item, offset = (np.array(x, np.int64) for x in zip(*entries, strict=True))
        fp = np.concatenate([next(windows(held[j][1][o: o + size], [size]))[2] for j, o in entries])
        blocks = []
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            mask = (1 << (hi - lo)) - 1
            value = ((fp >> np.uint64(lo)) & np.uint64(mask)).astype(np.int64)
            near = np.array([0, *(1 << j for j in range(hi - lo))])
            value, entry = (value[:, None] ^ near).ravel(), np.repeat(np.arange(len(fp)), len(near))
            order = np.argsort(value, kind="stable")
            n = np.bincount(value, minlength=mask + 1)
            blocks.append(Block(lo, mask, n > 0, np.append(0, np.cumsum(n)), fp[entry[order]], entry[order]))
        built[size] = (item, offset, blocks)
    keys = np.concatenate([_item_keys(np.full(len(s), j), s) for j, s in enumerate(own)] or [np.zeros(0, np.uint64)])
    order = np.argsort(keys, kind="stable")
    return Index([i for i, _ in held], [w for _, w in held], weights, np.array([w.sum() for w in weight]), built, keys[order],
                 np.concatenate(weight or [np.zeros(0)])[order], radius)


def _item_keys(items: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    return mix64(hashes ^ mix64(items.astype(np.uint64) + np.uint64(1)))


def _meetings(fps: np.ndarray, blocks: list[Block], radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, entry) of all fingerprints within the radius of an entry's, each pair once."""
    places, entries = [], []
    for b in blocks:
        value = ((fps >> np.uint64(b.shift)) & np.uint64(b.mask)).astype(np.int64)
        some = np.flatnonzero(b.held[value])
        if len(some):
            value = value[some]
            lo = b.first[value]
            n = b.first[value + 1] - lo
            place = np.repeat(some, n)
            at = np.arange(len(place)) + np.repeat(lo - (np.cumsum(n) - n), n)
            near = np.bitwise_count(fps[place] ^ b.fp[at]) <= radius
            places.append(place[near])
            entries.append(b.entry[at[near]])
    if not any(map(len, places)):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    both = np.unique(np.concatenate(places) << 32 | np.concatenate(entries))
    return both >> 32, both & 0xFFFFFFFF


def similarity(item: np.ndarray, passage: np.ndarray, weights: dict[int, float]) -> float:
    """Weighted Jaccard similarity of two passages' shingles (word hashes), with multiplicities.  ``weights`` are those of the
    item's shingles that do not weigh 1."""
    k = min(SHINGLE, len(item))
    a, b = Counter(shingles(item, k).tolist()), Counter(shingles(passage, k).tolist())
    both = sum(weights.get(x, 1.0) * n for x, n in (a & b).items())
    either = sum((weights.get(x, 1.0) if x in a else 1.0) * n for x, n in (a | b).items())
    return both / either if either else 0.0


def find(texts: list[str | None], index: Index, least: float) -> list[tuple[int, int, float, int]]:
    """(text, item, similarity, first word) of the best passage for each text and item of at least ``least``, of those that windows
    within the radius point to."""
    if not index.classes:
        return []
    words, ends = hash_words(texts)
    starts = ends - np.diff(ends, prepend=0)
    lens = np.array([len(w) for w in index.words], np.int64)
    by_size = {k: shingles(words, k) for k in {min(SHINGLE, int(n)) for n in lens}}
    best: dict[tuple[int, int], tuple[float, int]] = {}
    for size, first, fps in windows(words, sorted(index.classes)):
        item_of, offset_of, blocks = index.classes[size]
        place, entry = _meetings(fps, blocks, index.radius)
        if not len(place):
            continue
        place += first
        item = item_of[entry]
        text = np.searchsorted(ends, place, side="right")
        inside = place + size <= ends[np.minimum(text, len(ends) - 1)]
        begin = np.maximum(place - offset_of[entry], starts[text])
        stop = np.minimum(place - offset_of[entry] + lens[item], ends[text])
        seen = np.unique(np.stack([item, begin, stop, text])[:, inside], axis=1)
        for k, hashes in by_size.items():
            item, begin, stop, text = seen[:, np.minimum(lens[seen[0]], SHINGLE) == k]
            n = np.maximum(stop - begin - k + 1, 0)
            item, begin, stop, text, n = (x[n > 0] for x in (item, begin, stop, text, n))
            if not len(item):
                continue
            # the weight of the passage's shingles that the item has bounds the intersection
            flat = np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())
            keys = _item_keys(np.repeat(item, n), hashes[flat])
            at = np.minimum(np.searchsorted(index.keys, keys), len(index.keys) - 1)
            common = np.add.reduceat(np.where(index.keys[at] == keys, index.key_weights[at], 0.0), np.cumsum(n) - n)
            for j in np.flatnonzero(common >= least * index.totals[item] - 1e-9).tolist():
                s = similarity(index.words[item[j]], words[begin[j]: stop[j]], index.weights)
                if s >= least:
                    pair, found = (int(text[j]), int(item[j])), (s, -int(begin[j] - starts[text[j]]))
                    best[pair] = max(best.get(pair, found), found)
    return [(t, i, s, -w) for (t, i), (s, w) in best.items()]


def matches(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, radius: int = 7, text: str = "text", key: str = "doc_id",
            item_text: str = "text", item_key: str = "item_id") -> DataFrame:
    """(key, item, similarity double, first_word bigint): for each row of ``docs`` and item the passage most like the
    item, of those found with a similarity of at least ``least`` (of equals the first).

    Null and word-less texts or items match nothing; keys and item ids may be null or repeated (each row counts);
    an empty table on either side gives no rows.  The items are broadcast in blocks of at most about
    ``BLOCK_ITEMS`` items or ``BLOCK_BYTES``, one pass over the documents for each; if there are several, what a pass finds is
    written, and its block released, before the next."""
    prepare(docs.sparkSession)
    items = benchmark.select(F.col(item_key).alias("item"), F.col(item_text).alias("text")).where("text is not null")
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    key_kind, item_kind = docs.schema[key].dataType, benchmark.schema[item_key].dataType
    key_type, item_type = to_arrow_type(key_kind), to_arrow_type(item_kind)

    def one(index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                found = find(b.column(1).to_pylist(), index.value, least)
                if found:
                    keys = b.column(0).to_pylist()
                    yield pa.RecordBatch.from_arrays([
                        pa.array([keys[t] for t, *_ in found], key_type), pa.array([index.value.ids[i] for _, i, *_ in found], item_type),
                        pa.array([s for _, _, s, _ in found]), pa.array([w for *_, w in found], pa.int64())],
                        names=["key", "item", "similarity", "first_word"])
            release()
        return rows.mapInArrow(run, f"key {key_kind.simpleString()}, item {item_kind.simpleString()}, similarity double, first_word long")

    out = None
    for index, more in _indexes(items, radius):
        found = one(index)
        if more or out is not None:
            found = stored(found, "decontaminate-matches")
            index.unpersist()
        out = found if out is None else out.unionAll(found)
    return out


def _indexes(items: DataFrame, radius: int) -> Iterator[tuple[Broadcast, bool]]:
    """Broadcast indexes of (item, text) rows, in blocks, and whether there are more.  Shingles are counted over all items."""
    spark = items.sparkSession
    size = items.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    passes = max(1, -(-size["n"] // BLOCK_ITEMS), -(-size["bytes"] // BLOCK_BYTES))
    block = F.pmod(F.xxhash64("text"), F.lit(passes)).cast("int")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for p, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                own = np.unique(item_shingles(t)).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(own), p, np.int32)), pa.array(own)], names=["block", "shingle"])

    cut = items.select(block.alias("block"), "text").mapInArrow(run, "block int, shingle long")
    shared = cut.groupBy("shingle").agg(F.count(F.lit(1)).alias("n"), F.collect_set("block").alias("blocks")).where("n > 1")
    shared = shared.select("n", "shingle", F.explode("blocks").alias("block"))
    shared = checkpoint(shared) if passes > 1 else shared
    for p in range(passes):
        some = items.where(block == p).collect()
        counts = shared.where(F.col("block") == p).toArrow()  # no more than the block's items have shingles
        known = dict(zip(counts.column("shingle").to_numpy().view(np.uint64).tolist(), counts.column("n").to_pylist(), strict=True))
        yield spark.sparkContext.broadcast(build_index([(r["item"], r["text"]) for r in some], radius, known)), p + 1 < passes


def keep(docs: DataFrame, benchmark: DataFrame, least: float = 0.8, radius: int = 7, text: str = "text", item_text: str = "text",
         item_key: str = "item_id") -> DataFrame:
    """The rows of ``docs`` without a match.  Rows pass through their tasks whole, so neither keys nor other columns matter; a
    further block of items sees what the former kept."""
    prepare(docs.sparkSession)
    place = docs.columns.index(text)

    def one(docs, index):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                gone = {t for t, *_ in find(b.column(place).to_pylist(), index.value, least)}
                if len(gone) < b.num_rows:
                    yield b.take(pa.array([i for i in range(b.num_rows) if i not in gone], pa.int32()))
            release()
        return docs.mapInArrow(run, docs.schema)

    items = benchmark.select(F.col(item_key).alias("item"), F.col(item_text).alias("text")).where("text is not null")
    for index, more in _indexes(items, radius):
        docs = one(docs, index)
        if more:
            docs = stored(docs, "decontaminate-kept")
            index.unpersist()
    return docs


def judge(docs: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id", **options) -> DataFrame:
    """(key, contaminated boolean, n_items bigint, items string, similarity double) for every row of ``docs``: the items
    found (distinct ids in order, comma-joined) and the largest similarity (null without a match).  Rows with equal
    keys, null included, are judged together."""
    found = (matches(docs, benchmark, text=text, key=key, **options).groupBy("key")
             .agg(F.array_sort(F.collect_set("item")).alias("_items"), F.max("similarity").alias("similarity"), F.lit(True).alias("_hit")))
    own = docs.select(F.col(key).alias("_own"))
    return (own.join(found, F.col("_own").eqNullSafe(F.col("key")), "left")
            .select(F.col("_own").alias("key"), F.coalesce("_hit", F.lit(False)).alias("contaminated"),
                    F.coalesce(F.size("_items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce(F.array_join(F.col("_items").cast("array<string>"), ","), F.lit("")).alias("items"), "similarity"))
