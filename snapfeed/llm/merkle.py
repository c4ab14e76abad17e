"""Merkle-tree fingerprints of documents.

Leaves are the clauses of a line (up to and with their punctuation, 200 bytes at most), a paragraph is a line
over its leaves, a section a group of paragraphs over them, the root covers the sections.  A section ends
after a blank line or after a paragraph whose hash is a multiple of 8, so it is cut by content: an edit
changes the branches it touches and leaves the others as they were.  Equal roots mean equal texts; where roots
differ, only differing branches are descended.

The fingerprint is text: ``root|section:paragraph leaf leaf...,paragraph...|section:...`` in hex without the
blanks (root 32 digits, all else 8), so a tree can be read back from it.
"""

from __future__ import annotations

import hashlib
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import identified, partitions, prepare, unused

LEAF = re.compile(rb"[^.,;:!?]{0,199}+[.,;:!?]+ *|[^.,;:!?]{1,200}")
LEAST = -(2**63)

Paragraph = tuple[bytes, list[bytes]]
Section = tuple[bytes, list[Paragraph]]
Tree = tuple[str, list[Section]]


def tree(text: str) -> Tree:
    """Root (hex) and sections of a text; the empty text has no sections."""
    leaf_hash = node_hash = xxhash.xxh3_64_digest
    tops: list[bytes] = []
    sections: list[Section] = []
    own: list[Paragraph] = []
    full: list[bytes] = []
    lines = text.encode("utf-8", "surrogatepass").split(b"\n") if text else []
    for i, line in enumerate(lines):
        leaves = [leaf_hash(x) for x in LEAF.findall(line)]
        digest = node_hash(b"p" + b"".join(leaves))
        full.append(digest)
        own.append((digest[:4], [x[:4] for x in leaves]))
        if digest[-1] & 7 == 0 or not line.strip() or i == len(lines) - 1:
            top = node_hash(b"s" + b"".join(full))
            tops.append(top)
            sections.append((top[:4], own))
            own, full = [], []
    return xxhash.xxh3_128_hexdigest(b"r" + b"".join(tops)), sections


def to_text(t: Tree) -> str:
    """The fingerprint of a tree."""
    return "|".join([t[0], *(s.hex() + ":" + ",".join([(p + b"".join(leaves)).hex() for p, leaves in ps]) for s, ps in t[1])])


def from_text(fingerprint: str) -> Tree:
    root, *rest = fingerprint.split("|")
    sections = []
    for part in rest:
        top, _, below = part.partition(":")
        ps = [bytes.fromhex(x) for x in below.split(",")]
        sections.append((bytes.fromhex(top), [(p[:4], [p[i: i + 4] for i in range(4, len(p), 4)]) for p in ps]))
    return root, sections


def _differing(a: list, b: list) -> tuple[list, list]:
    """Branches of each side without those that the other side has as well (as often)."""
    common = Counter(x[0] for x in a) & Counter(x[0] for x in b)

    def rest(nodes: list) -> list:
        left, out = dict(common), []
        for x in nodes:
            if left.get(x[0], 0):
                left[x[0]] -= 1
            else:
                out.append(x)
        return out
    return rest(a), rest(b)


def _leaves(nodes: list[Paragraph]) -> int:
    return sum(len(leaves) or 1 for _, leaves in nodes)  # an empty paragraph counts as one


def likeness(a: Tree, b: Tree) -> float:
    """2 x common / all leaves, from 0 to 1; equal roots give 1."""
    if a[0] == b[0]:
        return 1.0
    total = sum(_leaves(ps) for t in (a, b) for _, ps in t[1])
    sa, sb = _differing(a[1], b[1])
    pa_, pb = _differing([p for _, ps in sa for p in ps], [p for _, ps in sb for p in ps])
    alone_a, alone_b = _leaves(pa_), _leaves(pb)
    common = (Counter(x for _, leaves in pa_ for x in leaves) & Counter(x for _, leaves in pb for x in leaves)).total()
    return min(1.0, (total - alone_a - alone_b + 2 * common) / total)


def edits(a: str, b: str) -> list[tuple[int, int]]:
    """Where fingerprint ``a`` differs from ``b``: (section, paragraph) numbers of a's branches that b lacks."""
    ta, tb = from_text(a), from_text(b)
    if ta[0] == tb[0]:
        return []
    place = {id(p): (i, j) for i, (_, ps) in enumerate(ta[1]) for j, p in enumerate(ps)}
    sa, sb = _differing(ta[1], tb[1])
    pa_, _ = _differing([p for _, ps in sa for p in ps], [p for _, ps in sb for p in ps])
    return [place[id(p)] for p in pa_]


def fingerprints(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, fingerprint) of each whole text; null counts as empty.  Keys may be null or repeated."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([to_text(tree(t or "")) for t in b.column(1).to_pylist()], pa.string())],
                                             names=["key", "fingerprint"])

    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("key"), F.col(text).alias("text")).mapInArrow(run, f"key {kind}, fingerprint string")


def edited(text: str, following: str) -> str:
    """The text with its last quarter (floor) of code points replaced by as many of the following text's first."""
    q = len(text) // 4
    return text[: len(text) - q] + following[:q] if q else text


#: Rows of one range, and places sampled for each range to cut them; at most so many places in all.
PER_TASK, PLACES, MOST_PLACES = 20_000, 32, 1 << 20


class Ranges:
    """Ranges of (key, hash) places, cut at sampled places: a range begins at a cut and ends before the next."""

    def __init__(self, at: np.ndarray, tie: np.ndarray, n: int):
        order = np.lexsort((tie, at))
        take = np.unique(len(order) * np.arange(1, n) // n) if len(order) else np.zeros(0, np.int64)
        at, tie = at[order][take], tie[order][take]
        new = np.append(True, (at[1:] != at[:-1]) | (tie[1:] != tie[:-1]))[: len(at)]
        self.at, self.tie = at[new], tie[new]

    def find(self, at: np.ndarray, tie: np.ndarray) -> np.ndarray:
        """The range of each place: how many cuts are not after it."""
        lo, hi = np.searchsorted(self.at, at, side="left"), np.searchsorted(self.at, at, side="right")
        out = lo.copy()
        some = np.flatnonzero(lo < hi)  # keys at which there are cuts
        for first in np.unique(lo[some]).tolist():
            own = some[lo[some] == first]
            out[own] += np.searchsorted(self.tie[first: int(hi[own[0]])], tie[own], side="right")
        return out


def in_order(docs: DataFrame, text: str, key: str) -> DataFrame:
    """Documents dealt out by ranges of (key, hash of the text, place), each range in this order and followed by the first document of
    the next range (``last`` true; after the last range: of the first), so that every document's successor is in
    its own task.  One shuffle of the texts, each range to a task of its own; ranges are cut at a sample of narrow places (which only plans
    the partitioning, so equal keys are cut as well), and one place for each range reaches the driver.  Null keys come first."""
    spark = docs.sparkSession
    (place,) = unused(docs, "_place")
    held = identified(docs, place)
    # the tie: the text's hash, and, for equal texts, the place in the file
    tie = F.shiftleft(F.shiftrightunsigned(F.xxhash64(F.coalesce(F.col(text), F.lit(""))), 24), 24) + F.shiftrightunsigned(F.xxhash64(F.col(place)), 40)
    rows = held.select(F.col(key).cast("long").alias("key"), F.coalesce(F.col(key).cast("long"), F.lit(LEAST)).alias("_at"),
                       tie.alias("_tie"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = docs.count()
    n = partitions(spark, total, PER_TASK)
    wanted = min(MOST_PLACES, PLACES * n)
    share = F.lit(min(1.0, wanted / max(1, total)) * 2.0**63)
    sample = rows.where(F.abs(F.xxhash64(F.lit(17), "_at", "_tie")).cast("double") <= share).select("_at", "_tie").toArrow()
    ranges = Ranges(sample.column("_at").to_numpy(), sample.column("_tie").to_numpy(), n)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            part = ranges.find(b.column("_at").to_numpy(), b.column("_tie").to_numpy())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(part.astype(np.int32))], names=[*b.schema.names, "part"])

    narrow = rows.select("_at", "_tie").mapInArrow(dealt, "_at long, _tie long, part int")
    firsts = narrow.groupBy("part").agg(F.min(F.struct("_at", "_tie")).alias("first")).orderBy("part").select("part", "first._at", "first._tie").toArrow()
    parts, first_at, first_tie = (firsts.column(c).to_numpy() for c in ("part", "_at", "_tie"))

    def also(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each row in its range, and the first of each range once more, at the end of the range before."""
        for b in dealt(batches):
            at, tie, part = (b.column(c).to_numpy() for c in ("_at", "_tie", "part"))
            own = np.searchsorted(parts, part)
            hit = np.flatnonzero((first_at[own] == at) & (first_tie[own] == tie))
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.zeros(len(at), bool))], names=[*b.schema.names, "last"])
            if len(hit):
                more = b.take(pa.array(hit)).set_column(4, "part", pa.array(parts[own[hit] - 1]))
                yield pa.RecordBatch.from_arrays([*more.columns, pa.array(np.ones(len(hit), bool))], names=[*b.schema.names, "last"])

    out = rows.mapInArrow(also, "key long, _at long, _tie long, text string, part int, last boolean")
    return out.repartitionById(max(1, len(ranges.at) + 1), "part").sortWithinPartitions("part", "last", "_at", "_tie")


def compare_with_next(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """For each document: key, n_chars, SHA-256 of its edited text (``edited``: the last quarter replaced by the
    next document's beginning), both texts' fingerprints, and the likeness of the document's fingerprint to the
    edited text's and to the next document's.

    The key is an integer column.  Null texts count as empty (likeness of two empty texts: 1); null keys come
    first; rows with equal keys follow each other by the first 40 bits of their text's xxhash64, repeated rows stay repeated; a single document is
    its own successor; an empty table gives no rows."""
    prepare(docs.sparkSession)
    names = ["key", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: tuple | None = None  # (part, key, text, tree) that waits for its successor
        done = False  # whether the part's sentinel has been seen: others of the same key are no documents of the part
        for b in batches:
            out: list[tuple] = []
            for k, t, part, last in zip(*(b.column(c).to_pylist() for c in ("key", "text", "part", "last")), strict=True):
                if held is not None and held[0] != part:
                    held, done = None, False
                if done:
                    continue
                own = tree(t)
                if held is not None:
                    text_, tree_ = held[2], held[3]
                    new = edited(text_, t)
                    of_new = tree(new)
                    out.append((held[1], len(text_), hashlib.sha256(new.encode("utf-8", "surrogatepass")).hexdigest(),
                                to_text(tree_), to_text(of_new), likeness(tree_, of_new), likeness(tree_, own)))
                held, done = (part, k, t, own), last
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

    return in_order(docs, text, key).select("key", "text", "part", "last").mapInArrow(
        run, "key long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
