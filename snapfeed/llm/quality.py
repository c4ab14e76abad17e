"""Quality rules: gradient-boosted trees over document statistics.

Statistics of every whole text are counted in tasks.  Boosted regression trees for the logistic loss are grown on the
statistics of a bounded sample of labelled documents, by histograms of quantile bins.  On chosen statistics the score is
monotonic: a split that would break the direction is not taken, and the middle of a split's two values bounds all
values below it.  The trees are flattened into node arrays in which leaves point at themselves, so a batch of documents is
scored by as many vectorised steps as the trees are deep.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare, word_chunks

#: Counts of a text, in order.  ``n_words`` to ``n_repeat_words`` are the base rules' own.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_distinct", "n_upper", "n_digits")
#: Features made of them, each with the direction in which the score may go as it grows (0: either).
FEATURES = {"words": 0, "word_length": 0, "symbol_share": -1, "dup_line_share": -1, "repeat_share": -1, "line_words": 0, "distinct_share": 0,
            "upper_share": 0, "digit_share": -1}
SYMBOLS = b"#*$%&|<>"
UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
BLANK = b" \t\n\r\x0b\x0c"
FOLLOWING = bytes(range(0x80, 0xC0))  # UTF-8 bytes that begin no code point


def _without(data: bytes, what: bytes) -> int:
    return len(data) - len(data.translate(None, what))


def repeated_words(ids: np.ndarray, distinct: int, width: int = 3) -> int:
    """Places covered by windows of ``width`` word numbers that occur at least twice, first occurrences included."""
    n = len(ids) - width + 1
    if n < 2:
        return 0
    key, size = ids[:n], distinct
    for j in range(1, width):
        if size * distinct >= 1 << 62:  # ranks instead of products, which would not fit
            key = np.unique(key, return_inverse=True)[1]
            size = int(key.max()) + 1
        key, size = key * distinct + ids[j: n + j], size * distinct
    _, which, many = np.unique(key, return_inverse=True, return_counts=True)
    hit = many[which] > 1
    covered = np.zeros(len(ids), bool)
    for j in range(width):
        covered[j: n + j] |= hit
    return int(covered.sum())


def counts(data: bytes) -> tuple[int, ...]:
    """``COUNTS`` of a text in UTF-8.  Words are runs without ASCII white space; repeated lines are those with a word."""
    known: dict[bytes, int] = {}
    parts = [np.fromiter((known.setdefault(w, len(known)) for w in some), np.int64, len(some)) for some in word_chunks(data)]
    ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
    lines = [x for x in data.split(b"\n") if x.strip(BLANK)]
    return (len(ids), len(data.translate(None, BLANK + FOLLOWING)), _without(data, SYMBOLS), len(lines) - len(set(lines)),
            repeated_words(ids, len(known)), len(data) - _without(data, FOLLOWING), len(lines), len(known), _without(data, UPPER), _without(data, DIGITS))


def features(found: np.ndarray) -> np.ndarray:
    """(rows, FEATURES) of (rows, COUNTS)."""
    words, word_chars, symbols, dup, repeat, chars, lines, distinct, upper, digits = found.astype(float).T
    some = np.maximum(words, 1)
    return np.stack([words, word_chars / some, symbols / np.maximum(chars, 1), dup / np.maximum(lines, 1), repeat / some, words / np.maximum(lines, 1),
                     distinct / some, upper / np.maximum(word_chars, 1), digits / np.maximum(word_chars, 1)], axis=1)


@dataclass
class Forest:
    """All trees' nodes end to end: at an inner node a row goes ``left`` if its ``feature`` is at most ``cut``, else ``right``;
    a leaf is its own successor.  ``value`` counts at leaves."""

    start: float
    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int

    def margin(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row of features."""
        if not len(self.roots):
            return np.full(len(x), self.start)
        node = np.tile(self.roots, (len(x), 1))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = np.where(x[row, self.feature[node]] <= self.cut[node], self.left[node], self.right[node])
        return self.start + self.value[node].sum(axis=1)

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -700, 700)))


def grow(x: np.ndarray, y: np.ndarray, directions: list[int], trees: int = 60, depth: int = 4, rate: float = 0.2, bins: int = 64,
         least_weight: float = 1.0, ridge: float = 1.0) -> Forest:
    """Boosted trees of 0/1 outcomes ``y``.  ``directions`` has 1, -1 or 0 for each feature; ``least_weight`` is the smallest
    sum of second derivatives on a side of a split.  Without both outcomes there are no trees, only the prior log-odds."""
    prior = (y.sum() + 0.5) / (len(y) + 1)
    start = float(np.log(prior / (1 - prior)))
    none = np.zeros(0, np.int64)
    if not 0 < y.sum() < len(y):
        return Forest(start, none, none, np.zeros(0), none, none, np.zeros(0), depth)
    # a bin holds the values up to and including its cut, so binned and plain comparisons agree
    cuts = [np.unique(np.quantile(column, np.arange(1, bins) / bins, method="lower")) for column in x.T]
    binned = np.stack([np.searchsorted(c, column, side="left") for c, column in zip(cuts, x.T, strict=True)], axis=1)
    sign = np.array(directions)
    feature, cut, left, right, value, roots = [], [], [], [], [], []

    def node() -> int:
        for column, v in ((feature, 0), (cut, 0.0), (left, len(left)), (right, len(right)), (value, 0.0)):
            column.append(v)
        return len(feature) - 1

    def best(rows: np.ndarray, g: np.ndarray, h: np.ndarray, lo: float, hi: float) -> tuple | None:
        """The split with the largest gain: (gain, feature, bin, value on the left, value on the right)."""
        found = None
        all_g, all_h = g[rows].sum(), h[rows].sum()
        before = _gain(all_g, all_h, np.clip(-all_g / (all_h + ridge), lo, hi), ridge)
        for f in range(x.shape[1]):
            if not len(cuts[f]):
                continue
            own = binned[rows, f]
            gl = np.cumsum(np.bincount(own, g[rows], len(cuts[f]) + 1))[:-1]
            hl = np.cumsum(np.bincount(own, h[rows], len(cuts[f]) + 1))[:-1]
            gr, hr = all_g - gl, all_h - hl
            wl, wr = np.clip(-gl / (hl + ridge), lo, hi), np.clip(-gr / (hr + ridge), lo, hi)
            gain = _gain(gl, hl, wl, ridge) + _gain(gr, hr, wr, ridge) - before
            gain[(hl < least_weight) | (hr < least_weight) | (sign[f] * (wr - wl) < 0)] = -np.inf
            b = int(gain.argmax())
            if gain[b] > 1e-9 and (found is None or gain[b] > found[0]):
                found = (float(gain[b]), f, b, float(wl[b]), float(wr[b]))
        return found

    margin = np.full(len(y), start)
    for _ in range(trees):
        p = 1 / (1 + np.exp(-margin))
        g, h = p - y, p * (1 - p)
        roots.append(node())
        open_ = [(roots[-1], np.arange(len(y)), -np.inf, np.inf, 0)]
        while open_:
            at, rows, lo, hi, level = open_.pop()
            split = best(rows, g, h, lo, hi) if level < depth else None
            if split is None:
                value[at] = rate * float(np.clip(-g[rows].sum() / (h[rows].sum() + ridge), lo, hi))
                margin[rows] += value[at]
                continue
            _, f, b, wl, wr = split
            feature[at], cut[at], left[at], right[at] = f, float(cuts[f][b]), node(), node()
            middle = (wl + wr) / 2
            to_left = binned[rows, f] <= b
            bounds = {1: ((lo, middle), (middle, hi)), -1: ((middle, hi), (lo, middle)), 0: ((lo, hi), (lo, hi))}[int(sign[f])]
            open_.append((left[at], rows[to_left], *bounds[0], level + 1))
            open_.append((right[at], rows[~to_left], *bounds[1], level + 1))
    return Forest(start, *(np.array(c) for c in (roots, feature, cut, left, right, value)), depth)


def _gain(g, h, w, ridge: float):
    """How much of the loss a leaf with these sums and value takes away."""
    return -(g * w + (h + ridge) * w * w / 2)


def statistics(docs: DataFrame, forest: Forest | None = None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, COUNTS as long) of every whole text, with ``score`` double by ``forest`` where that is given.  Null texts count
    as empty (all zero); rows are independent of each other, so null and repeated keys and further columns make no difference."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(forest)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for b in batches:
            found = np.array([counts(t or b"") for t in b.column(1).to_pylist()], np.int64).reshape(-1, len(COUNTS))
            out = [b.column(0), *(pa.array(column) for column in found.T.copy())]
            if model is not None:
                out.append(pa.array(model.score(features(found))))
            yield pa.RecordBatch.from_arrays(out, names=["key", *COUNTS, *(["score"] if model is not None else [])])

    kind = docs.schema[key].dataType.simpleString()
    schema = ", ".join([f"key {kind}", *(f"{c} long" for c in COUNTS), *(["score double"] if forest is not None else [])])
    return docs.select(F.col(key).alias("key"), F.col(text).cast("binary").alias("text")).mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, most: int = 20_000, text: str = "text", key: str = "doc_id", good: str = "quality", **growth) -> Forest:
    """Trees for ``good`` (1 or 0) of the documents that ``labels`` (key, good) names.

    They are grown on at most ``most`` documents: the labelled keys with the smallest hashes are broadcast to find their
    texts (equal or not), of which again those with the smallest hashes stay, so a repeated key doesn't pass the bound.  Labels without a
    key or a value don't count; a key with several labels is good if one of them is 1.  Without labelled documents the forest has no trees and scores 0.5."""
    prepare(docs.sparkSession)
    named = labels.select(F.col(key).alias("key"), (F.col(good) == 1).alias("good")).where("key is not null and good is not null")
    named = named.groupBy("key").agg(F.max("good").alias("good"))
    chosen = named.orderBy(F.xxhash64(F.lit(3), F.col("key")), "key").limit(most)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text")).join(F.broadcast(chosen.withColumnRenamed("key", "of")), F.col("key") == F.col("of"))
    rows = rows.select(F.struct(F.xxhash64(F.lit(5), F.col("key"), F.col("text")).alias("place"), "good").alias("key"), "text")
    found = statistics(rows, key="key").select("key.place", "key.good", *COUNTS).orderBy("place", "good").limit(most).toPandas()
    y = found["good"].to_numpy(float)
    x = features(found[list(COUNTS)].to_numpy(np.int64).reshape(-1, len(COUNTS)))
    return grow(x, y, list(FEATURES.values()), **growth)


def base_failed() -> Column:
    """The base rules: fewer than 50 words, or over half of the words in repeated three-word windows."""
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def judge(docs: DataFrame, forest: Forest, least: float = 0.5, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, COUNTS, score, base_failed, kept): a document is kept if the base rules hold and its score is at least ``least``."""
    return (statistics(docs, forest, text, key).withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("score") >= least)))
