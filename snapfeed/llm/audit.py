"""Filter interaction audit: what each of five filters removes, in every order, by radix text tries.

Whether a document repeats another one's whole text (filter E) is found with tries: the texts are dealt out by prefixes
that are longer where texts are many (a prefix doubles until what begins with it fits one range), and each task inserts its
ranges' whole texts into a compressed trie whose terminals hold the least id of the text.  A traversal gives the mask of the filters that
a text's documents fail.  Tasks combine equal texts before they are sent, so copies cross the network
once a task, not once a document.  Masks are counted by part; all orders follow from these counts.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import bitmap, in_bitmap, partitions, prepare, release, stored, word_chunks

FILTERS = "ABCDE"
#: Bytes of distinct texts in one task's ranges, and the least a range is cut for.
TASK_BYTES, LEAST_RANGE = 32 << 20, 1 << 20
#: Bytes of texts that a task combines at once.
HELD = 32 << 20
#: The ranges are planned on the distinct texts whose hash is divisible by this; it decides no result.
PLAN_ONE_IN = 16
SHORTEST = 8  # bytes of the first prefixes
REPEATED = 16  # the mask's bit of filter E
UPPER, MARKS, FOLLOWING = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))


def own_mask(data: bytes) -> int:
    """The filters A to D that a text in UTF-8 fails: bit 0 is A."""
    n, known = 0, set()
    for words in word_chunks(data):
        n += len(words)
        known.update(words)
    points = len(data.translate(None, FOLLOWING))
    return ((n < 100) | (100 * len(known) < 80 * n) << 1 | (100 * (len(data) - len(data.translate(None, UPPER))) > 10 * points) << 2
            | (len(data.translate(None, MARKS)) < len(data)) << 3)


def plan(docs: DataFrame, text: str = "text") -> tuple[dict[int, set[int]], int]:
    """(prefix length -> hashes of the prefixes that are cut further, number of tasks).

    A prefix is cut where the distinct texts that go on behind it have over a quarter of a task's bytes, so there are at most four
    such prefixes a task and length.  Sizes are estimated on whole distinct texts, one in ``PLAN_ONE_IN``."""
    spark = docs.sparkSession
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text")).withColumn("h", F.xxhash64("text"))
    sample = stored(rows.where(F.pmod("h", F.lit(PLAN_ONE_IN)) == 0).groupBy("h").agg(F.first("text").alias("text")), "audit-plan").withColumn("size", F.length("text").cast("long"))
    size = sample.agg(F.coalesce(F.sum("size"), F.lit(0)).alias("n")).first()["n"] * PLAN_ONE_IN
    tasks = partitions(spark, size, TASK_BYTES)
    most = max(LEAST_RANGE, size // (4 * tasks)) // PLAN_ONE_IN
    cut, length = {}, SHORTEST
    while True:
        heads = sample.where(F.col("size") > length).groupBy(F.xxhash64(F.substring("text", 1, length)).alias("head")).agg(F.sum("size").alias("size"))
        found = heads.where(F.col("size") > most).select("head").toArrow().column("head").to_numpy()
        if not len(found):
            return cut, tasks
        cut[length] = set(found.view(np.uint64).tolist())
        length *= 2


def range_of(data: bytes, cut: dict[int, set[int]]) -> int:
    """The range of a text: the hash of its shortest prefix that is not cut further, as a signed long."""
    length = SHORTEST
    while True:
        h = xxhash.xxh64_intdigest(data[:length], 42)
        if len(data) <= length or h not in cut.get(length, ()):
            return h - (1 << 64) if h >= 1 << 63 else h
        length *= 2


def merge(into: list | None, least, at_least: int, rows: int, without: int) -> list:
    """[least id, rows with it, rows, rows without an id], of two sets of rows."""
    if into is None:
        return [least, at_least, rows, without]
    if least is not None:
        if into[0] is None or least < into[0]:
            into[0], into[1] = least, at_least
        elif least == into[0]:
            into[1] += at_least
    into[2] += rows
    into[3] += without
    return into


class Trie:
    """A compressed trie of byte strings.  A node is [label, children by first byte, terminal or None]; a terminal is
    [its number, counts by group]."""

    def __init__(self) -> None:
        self.root: list = [b"", {}, None]
        self.size = 0

    def terminal(self, data: bytes) -> list:
        """The terminal of ``data``, put in if need be."""
        node, at = self.root, 0
        while at < len(data):
            child = node[1].get(data[at])
            if child is None:
                child = node[1][data[at]] = [data[at:], {}, None]
                node, at = child, len(data)
            elif data.startswith(child[0], at):
                node, at = child, at + len(child[0])
            else:  # the label and the text part within the label
                same = _common(child[0], data, at)
                upper = [child[0][:same], {child[0][same]: child}, None]
                child[0] = child[0][same:]
                node[1][data[at]] = upper
                node, at = upper, at + same
        if node[2] is None:
            node[2] = [self.size, {}]
            self.size += 1
        return node[2]

    def terminals(self) -> Iterator[list]:
        open_ = [self.root]
        while open_:
            _, children, terminal = open_.pop()
            open_ += children.values()
            if terminal is not None:
                yield terminal


def _common(label: bytes, data: bytes, at: int) -> int:
    """Bytes that ``label`` and ``data`` from ``at`` on have in common, where neither goes on as the other to its end."""
    n = min(len(label), len(data) - at)
    differ = np.frombuffer(label, np.uint8, n) != np.frombuffer(data, np.uint8, n, at)
    return int(differ.argmax()) if differ.any() else n


#: Equal texts of a part on the way to their trie; ``named`` has the ids among them that may have a label.
COMBINED = "range long, part string, mask int, least {0}, at_least long, rows long, without long, named array<{0}>, text binary"
#: What a task's tries give: rows counted by part and mask (``n`` set), the ids that may have a label, by their text's number, and of these texts
#: the least id (``n`` and ``part`` null).
COUNTED = "part string, mask int, n long, of long, id {}"


def _combine(docs: DataFrame, cut: dict[int, set[int]], bits: np.ndarray) -> DataFrame:
    """(key, text, part, h) as ``COMBINED`` rows: equal texts of up to ``HELD`` bytes of a task become one row for each part."""
    context = docs.sparkSession.sparkContext
    shared, labelled = context.broadcast(cut), context.broadcast(bits)
    key_type = to_arrow_type(docs.schema["key"].dataType)

    def rows(held: dict) -> Iterator[pa.RecordBatch]:
        flat = [(text, part, *counts) for text, groups in held.items() for part, counts in groups.items()]
        size = np.cumsum([len(r[0]) + 16 * len(r[-1]) for r in flat])
        cuts = np.unique(np.append(0, np.searchsorted(size, np.arange(1 << 20, size[-1], 1 << 20)))).tolist()
        known = {text: (range_of(text, shared.value), own_mask(text)) for text in held}
        for at, end in zip(cuts, [*cuts[1:], len(flat)], strict=True):
            some = flat[at:end]
            column = lambda i: [r[i] for r in some]
            yield pa.RecordBatch.from_arrays([
                pa.array([known[r[0]][0] for r in some], pa.int64()), pa.array(column(1), pa.string()), pa.array([known[r[0]][1] for r in some], pa.int32()),
                pa.array(column(2), key_type), *(pa.array(column(i), pa.int64()) for i in (3, 4, 5)), pa.array(column(6), pa.list_(key_type)),
                pa.array(column(0), pa.binary())], names=["range", "part", "mask", "least", "at_least", "rows", "without", "named", "text"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[bytes, dict] = {}
        size = 0
        for b in batches:
            may = in_bitmap(labelled.value, b.column(3).to_numpy().view(np.uint64)).tolist()
            for key, text, part, named in zip(*(c.to_pylist() for c in b.columns[:3]), may, strict=True):
                groups = held.get(text)
                if groups is None:
                    groups = held[text] = {}
                    size += len(text)
                own = groups[part] = merge(groups.get(part), key, int(key is not None), 1, int(key is None))
                if len(own) == 4:
                    own.append([])
                if named and key is not None:
                    own[4].append(key)
                    size += 16
            if size >= HELD:
                yield from rows(held)
                held, size = {}, 0
        if held:
            yield from rows(held)
        del held
        release()

    return docs.select("key", "text", "part", "h").mapInArrow(run, COMBINED.format(docs.schema["key"].dataType.simpleString()))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One task's ranges as ``COUNTED`` rows.  Ids that may have a label pass through; a terminal holds counts only."""
    trie, task = Trie(), TaskContext.get().partitionId() if TaskContext.get() else 0
    key_type = None

    def out(part, mask, n, of, ids) -> pa.RecordBatch:
        columns = (part, mask, n, of, ids)
        kinds = (pa.string(), pa.int32(), pa.int64(), pa.int64(), key_type)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["part", "mask", "n", "of", "id"])

    asked: set[int] = set()
    for b in batches:
        key_type = b.column(3).type
        passed: list[tuple] = []
        for _, part, mask, least, at_least, rows, without, named, text in zip(*(c.to_pylist() for c in b.columns), strict=True):
            number, own = trie.terminal(text)
            own[part, mask] = merge(own.get((part, mask)), least, at_least, rows, without)
            if named:
                asked.add(number)
                passed += [(part, mask, None, task << 40 | number, key) for key in named]
        if passed:
            yield out(*zip(*passed, strict=True))
    found: dict[tuple, int] = {}
    leasts: list[tuple] = []
    for number, own in trie.terminals():
        first = min((g[0] for g in own.values() if g[0] is not None), default=None)
        if number in asked:
            leasts.append((None, None, None, task << 40 | number, first))
        for (part, mask), (least, at_least, rows, without) in own.items():
            new = without + (at_least if least is not None and least == first else 0)
            for m, n in ((mask, new), (mask | REPEATED, rows - new)):
                if n:
                    found[part, m] = found.get((part, m), 0) + n
    del trie
    release()
    for some in (leasts, [(part, mask, n, None, None) for (part, mask), n in found.items()]):
        for at in range(0, len(some), 10_000):
            yield out(*zip(*some[at: at + 10_000], strict=True))


def masks(docs: DataFrame, labels: DataFrame, text: str = "text", key: str = "doc_id", part: str = "lang", good: str = "quality", toxic: str = "toxic") -> DataFrame:
    """(part string, mask int, n, good, toxic long): how many documents of each part fail exactly the filters of ``mask``
    (bit 0 is A), and how many of them ``labels`` (key, good, toxic) calls good or toxic.

    A: under 100 words.  B: distinct words under 80 % of the words.  C: over 10 % of the code points are A-Z.  D: one of ``MARKS``.
    E: another row anywhere with the same text has a smaller key.  Null texts count as empty, null parts as the empty string; a
    null key is neither smaller nor larger than any other and has no labels; repeated rows count each, and none repeats the other.
    A key with several labels has what any of them says.

    Texts are shuffled once.  Labels meet ids, not texts: a bitmap of fixed size tells which ids may have a label, the tries pass
    these on with their text's number, and an exact join leaves the others out."""
    prepare(docs.sparkSession)
    cut, tasks = plan(docs, text)
    named = labels.select(F.col(key).alias("id"), F.col(good).alias("good"), F.col(toxic).alias("toxic")).where("id is not null")
    named = named.groupBy("id").agg(F.max(F.col("good") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).where("good or toxic")
    # both sides' ids as text, so that equal ids of two types have one hash
    hashed = lambda c: F.coalesce(F.xxhash64(F.col(c).cast("string")), F.lit(0))
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"), F.coalesce(F.col(part), F.lit("")).alias("part"))
    combined = _combine(rows.withColumn("h", hashed("key")), cut, bitmap(named.select(hashed("id").alias("h")), "h"))
    kind = docs.schema[key].dataType.simpleString()
    counted = stored(combined.repartition(tasks, "range").mapInArrow(_count, COUNTED.format(kind)), "audit-counts")
    # Repeated ids are counted before they meet their labels, and a text's rows before they meet its least id: no hot keys.
    ids = counted.where("of is not null and part is not null").groupBy("of", "part", "mask", "id").agg(F.count(F.lit(1)).alias("rows"))
    said = ids.join(named, "id").groupBy("of", "part", "mask", "good", "toxic").agg(
        F.sum("rows").alias("all"), F.min("id").alias("own"), F.min_by("rows", "id").alias("first"))
    leasts = counted.where("of is not null and part is null").select("of", F.col("id").alias("least"))
    first = F.when(F.col("own") == F.col("least"), F.col("first")).otherwise(0)
    said = said.join(leasts, "of").select("part", "good", "toxic", F.inline(F.array(
        F.struct(F.col("mask"), first.alias("rows")), F.struct(F.col("mask").bitwiseOR(F.lit(REPEATED)).alias("mask"), (F.col("all") - first).alias("rows")))))
    flag = lambda c: F.when(F.col(c), F.col("rows")).otherwise(0).cast("long").alias(c)
    every = counted.where("n is not null").select("part", "mask", "n", F.lit(0).cast("long").alias("good"), F.lit(0).cast("long").alias("toxic"))
    every = every.unionByName(said.select("part", "mask", F.lit(0).cast("long").alias("n"), flag("good"), flag("toxic")))
    return every.groupBy("part", "mask").agg(*[F.sum(c).alias(c) for c in ("n", "good", "toxic")])


def steps() -> list[tuple[str, int, str, int, int]]:
    """(order, step, filter, the filter's bit, bits of the filters before it) of all orders of the filters."""
    out = []
    for order in itertools.permutations(FILTERS):
        before = 0
        for i, name in enumerate(order):
            bit = 1 << FILTERS.index(name)
            out.append(("".join(order), i + 1, name, bit, before))
            before |= bit
    return out


def audit(counted: DataFrame) -> DataFrame:
    """(part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley) of ``masks``: for each
    order of the filters, in which each sees what those before it left, and each step of it, zeros included.  ``shapley`` is the
    step's filter's ``removed`` summed over all orders.  A part without documents has no rows."""
    places = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(i).alias("step"), F.lit(f).alias("filter"), F.lit(b).alias("bit"), F.lit(p).alias("before"))
                       for o, i, f, b, p in steps()])
    rows = counted.select("*", F.explode(places).alias("at")).select("part", "mask", "n", "good", "toxic", "at.*")
    fails, left = F.col("mask").bitwiseAND(F.col("bit")) != 0, F.col("mask").bitwiseAND(F.col("before")) == 0
    total = lambda when, what, name: F.sum(F.when(when, F.col(what)).otherwise(0)).alias(name)
    found = rows.groupBy("part", "filter_order", "step", "filter").agg(
        total(left & ~fails, "n", "kept"), total(left & fails, "n", "removed"), total(~left & fails, "n", "redundant"),
        total(F.col("mask") == F.col("bit"), "n", "unique_fails"), total(left & fails, "good", "good_lost"), total(left & fails, "toxic", "toxic_lost"))
    return found.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "filter"))).drop("filter")
