"""Personal data: base entities by pattern, and terms that reveal them by corpus co-occurrence.

Protected entities are e-mail and IP addresses, card and phone numbers.  The terms of a corpus are judged by
what they disclose: with P over its distinct texts, an entity e has the information content
IC(e) = -log2 P(e), and a term t reveals PMI(t; e) = log2 (P(e | t) / P(e)) of it, where P(e | t) is the share
of the texts with t that have e anywhere.  Copies of a text are one piece of evidence, and P(e | t) is taken at the lower bound of
its Wilson interval, so a word that stands by chance in the few texts of an entity proves little.  A term that
reveals a larger share of an entity's IC than a threshold, in enough texts with it, is sanitised wherever it stands, also in documents
without the entity: numbers are generalised to their shape, other terms removed.

Text frequencies are counted exactly, over all texts, of the terms that can matter: those that disclose
enough by a lower bound of their frequency.  A bitmap of fixed size lets few others through the counting pass, and
a join by the term leaves those out.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .common import bitmap, checkpoint, identified, in_bitmap, prepare, unused
from .decontaminate import hash_words

KINDS = ("email", "ip", "card", "phone")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
# A run of digits is taken from its start only: from within it nothing else could match.
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
#: Words as ``hash_words`` sees them.
WORD = re.compile("[0-9A-Za-z_\x80-\U0010ffff]+")

Span = tuple[str, int, int]
PAIRS = 1 << 19  # pairs of terms and entities, or of terms and texts, summed up at once


def emails(text: str) -> list[Span]:
    """Leftmost non-overlapping addresses, found from their ``@``; linear in the text."""
    out, taken, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > taken and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            out.append(("email", start, m.end()))
            taken = m.end()
        at = text.find("@", m.end() if m else at + 1)
    return out


def luhn(digits: str) -> bool:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def detect(text: str) -> list[Span]:
    """(kind, start, end) of the base entities by kind as in KINDS, then start; code points, end exclusive."""
    out = emails(text) if "@" in text else []
    if DIGIT.search(text):
        out += [("ip", m.start(), m.end()) for m in IP.finditer(text)
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m.group().split("."))]
        for m in CARD.finditer(text):
            digits = re.sub("[ -]", "", m.group()) if m.end() - m.start() <= 64 else ""
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
        if "+" in text:
            out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]
    return out


def entity(kind: str, value: str) -> int:
    """Id of a protected entity: its kind and its value without case or separators."""
    norm = value.lower() if kind in ("email", "ip") else re.sub("[^0-9]", "", value)
    return xxhash.xxh3_64_intdigest(f"{kind}:{norm}") - (1 << 63)


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def _words(text: str, spans: list[Span]) -> list[tuple[int, int, int]]:
    """(number, start, end) of the words outside of base spans."""
    out, at, covered = [], 0, sorted((s, e) for _, s, e in spans)
    upto = 0  # furthest end of the spans that start before the word's end
    for i, m in enumerate(WORD.finditer(text)):
        while at < len(covered) and covered[at][0] < m.end():
            upto = max(upto, covered[at][1])
            at += 1
        if upto <= m.start():
            out.append((i, m.start(), m.end()))
    return out


#: One-sided 95 %: the lower bound of P(e | t).
Z = 1.645


def _owners(hashes: np.ndarray, repeated: np.ndarray) -> np.ndarray:
    """For each text 0, or its hash if it may be there more than once."""
    return np.where(in_bitmap(repeated, hashes.view(np.uint64)), hashes, 0)


def _summed(columns: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """The distinct rows of some columns, and how many there are of each."""
    found, n = np.unique(np.stack(columns), axis=1, return_counts=True)
    return pa.RecordBatch.from_arrays([*(pa.array(c) for c in found), pa.array(n.astype(np.int64))], names=[*names, "n"])


def _texts(counts: DataFrame, by: list[str], name: str) -> DataFrame:
    """Counts of distinct texts by ``by``, out of (by, of, n): a text that may be repeated (``of``) counts once."""
    once = counts.groupBy(*by, "of").agg(F.sum("n").alias("n")).select(*by, F.when(F.col("of") == 0, F.col("n")).otherwise(1).alias("n"))
    return once.groupBy(*by).agg(F.sum("n").alias(name))


def _together(rows: DataFrame, repeated: Broadcast, least_texts: int) -> tuple[DataFrame, DataFrame]:
    """(entity, n_entity) and (term, entity, both): distinct texts with an entity, and with a term and an entity; of both only what
    is in ``least_texts`` or more.  Counts are summed up within tasks first."""
    spark = rows.sparkSession

    def entities(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            owners = _owners(b.column(1).to_numpy(), repeated.value).tolist()
            own = [(x, of) for t, of in zip(b.column(0).to_pylist(), owners, strict=True) if t for x in {entity(k, t[s:e]) for k, s, e in detect(t)}]
            if own:
                yield _summed([np.array(c, np.int64) for c in zip(*own, strict=True)], ["entity", "of"])

    texts = rows.select("text", "h")
    of_entity = checkpoint(_texts(texts.mapInArrow(entities, "entity long, of long, n long"), ["entity"], "n_entity").where(F.col("n_entity") >= least_texts))
    bits = spark.sparkContext.broadcast(bitmap(of_entity, "entity"))

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for b in batches:
            owners = _owners(b.column(1).to_numpy(), repeated.value).tolist()
            for t, of in zip(b.column(0).to_pylist(), owners, strict=True):
                spans = detect(t) if t else []
                own = np.array(sorted({entity(k, t[s:e]) for k, s, e in spans}), np.int64)
                own = own[in_bitmap(bits.value, own.view(np.uint64))]
                if not len(own):
                    continue
                terms = np.unique(hash_words([t[s:e] for _, s, e in _words(t, spans)])[0].view(np.int64))
                step = max(1, PAIRS // max(1, len(terms)))
                for at in range(0, len(own), step):
                    some = own[at: at + step]
                    held.append((np.tile(terms, len(some)), np.repeat(some, len(terms)), np.full(len(terms) * len(some), of)))
                    size += len(held[-1][0])
                    if size >= PAIRS:
                        yield _summed([np.concatenate(c) for c in zip(*held, strict=True)], ["term", "entity", "of"])
                        held, size = [], 0
        if size:
            yield _summed([np.concatenate(c) for c in zip(*held, strict=True)], ["term", "entity", "of"])

    beside = _texts(texts.mapInArrow(pairs, "term long, entity long, of long, n long"), ["term", "entity"], "both").where(F.col("both") >= least_texts)
    return of_entity, beside


def find(docs: DataFrame, threshold: float = 0.8, least_texts: int = 3, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_email, n_ip, n_card, n_phone bigint, base string, base_sha256, terms array<struct<start int, end int>>) for each row: base spans
    as comma-joined ``kind:start:end``, and the spans of the terms that disclose over ``threshold`` of an entity's information
    content, seen with it in ``least_texts`` distinct texts or more.

    Null and empty texts have no spans and count as one text.  Keys may be null or repeated: every row is judged for itself, and no copy of a row
    changes what is found.  An entity that is in all texts has no information content, and nothing discloses it.  Other columns are
    not read."""
    spark = prepare(docs.sparkSession)
    key_type = to_arrow_type(docs.schema[key].dataType)
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("h"))
    span_type = pa.list_(pa.struct([("term", pa.int64()), ("start", pa.int32()), ("end", pa.int32())]))
    hashes = checkpoint(rows.groupBy("h").agg(F.count(F.lit(1)).alias("n")))
    total = hashes.count()
    repeated = spark.sparkContext.broadcast(bitmap(hashes.where("n > 1"), "h"))
    of_entity, beside = _together(rows, repeated, least_texts)
    content = -F.log2(F.col("n_entity") / F.lit(total))
    n = F.greatest("n_term", "both")
    share = F.col("both") / n
    low = (share + Z * Z / (2 * n) - Z * F.sqrt(share * (1 - share) / n + Z * Z / (4 * n * n))) / (1 + Z * Z / n)
    disclosed = (F.log2(low) + F.col("content")) / F.col("content")
    pairs = beside.join(of_entity, "entity").withColumn("content", content).where("content > 0")

    def counted(pairs: DataFrame, some: DataFrame) -> DataFrame:
        """``pairs`` with n_term, the number of distinct texts of ``some`` rows with the term."""
        bits = spark.sparkContext.broadcast(bitmap(pairs.select("term").distinct(), "term"))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, size = [], 0
            for b in batches:
                words, ends = hash_words(b.column(0).to_pylist())
                at = np.flatnonzero(in_bitmap(bits.value, words))
                own = np.searchsorted(ends, at, side="right")
                seen = np.unique(np.stack([own, words[at].view(np.int64)]), axis=1)  # a term once a text
                held.append((seen[1], _owners(b.column(1).to_numpy(), repeated.value)[seen[0]]))
                size += seen.shape[1]
                if size >= PAIRS:
                    yield _summed([np.concatenate(c) for c in zip(*held, strict=True)], ["term", "of"])
                    held, size = [], 0
            if size:
                yield _summed([np.concatenate(c) for c in zip(*held, strict=True)], ["term", "of"])

        n_term = _texts(some.select("text", "h").mapInArrow(run, "term long, of long, n long"), ["term"], "n_term")
        return pairs.join(n_term, "term", "left").withColumn("n_term", F.coalesce("n_term", F.lit(0)))

    # A term's texts among some of them are a lower bound of all: what discloses too little even by that, as common words
    # do, is out before the count over all rows.
    some = rows.where(F.pmod(F.xxhash64(F.lit(3), F.col("h")), F.lit(16)) == 0)
    pairs = checkpoint(counted(checkpoint(pairs), some).where(disclosed > threshold).drop("n_term"))
    telling = checkpoint(counted(pairs, rows).where(disclosed > threshold).select("term").distinct())
    bits = spark.sparkContext.broadcast(bitmap(telling, "term"))

    def base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = b.column(1).to_pylist()
            words, ends = hash_words(texts)
            hits = np.split(in_bitmap(bits.value, words), ends[:-1])
            out, near = [], []
            for t, hit in zip(texts, hits, strict=True):
                spans = detect(t) if t else []
                joined = _joined(spans)
                out.append((*(sum(s[0] == k for s in spans) for k in KINDS), joined, hashlib.sha256(joined.encode()).hexdigest()))
                some = set(np.flatnonzero(hit).tolist())  # the words that may disclose, by their number in the text
                near.append([(t[s:e], s, e) for i, s, e in _words(t, spans) if i in some] if some else [])
            terms = iter(hash_words([w for own in near for w, *_ in own])[0].view(np.int64).tolist())
            near = [[{"term": next(terms), "start": s, "end": z} for _, s, z in own] for own in near]
            cols = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([b.column(0).cast(key_type), *(pa.array(c, pa.int64()) for c in cols[:4]), pa.array(cols[4], pa.string()),
                                              pa.array(cols[5], pa.string()), pa.array(near, span_type)],
                                             names=["key", *(f"n_{k}" for k in KINDS), "base", "base_sha256", "near"])

    kind = docs.schema[key].dataType.simpleString()
    found = checkpoint(rows.select("key", "text").mapInArrow(base, f"key {kind}, n_email long, n_ip long, n_card long, n_phone long, base string, base_sha256 string, "
                                                             "near array<struct<term: long, start: int, end: int>>")
                       .withColumn("row", F.monotonically_increasing_id()))
    spans = (found.select("row", F.inline("near")).join(telling, "term").select("row", "start", "end")
             .groupBy("row").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("terms")))
    none = F.array().cast("array<struct<start:int,end:int>>")
    return found.drop("near").join(spans, "row", "left").withColumn("terms", F.coalesce("terms", none)).drop("row")


def all_spans(base: str = "base", terms: str = "terms"):
    """The column of all spans, the base ones first: comma-joined ``kind:start:end``."""
    own = F.array_join(F.transform(terms, lambda x: F.concat_ws(":", F.lit("term"), x["start"].cast("string"), x["end"].cast("string"))), ",")
    return F.concat(F.col(base), F.when((F.col(base) != "") & (own != ""), ",").otherwise(""), own)


def redacted(text: str, spans: list[Span]) -> str:
    """The text with base entities replaced by their kind, disclosing numbers by their shape and other disclosing terms by nothing.
    Of spans that overlap the one that starts first counts."""
    out, at = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start < at:
            continue
        own = text[start:end]
        out += [text[at:start], f"[{kind.upper()}]" if kind != "term" else re.sub("[0-9]", "#", own) if own.isdigit() else ""]
        at = end
    return "".join(out) + text[at:]


def sanitise(docs: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` with the text redacted, each row for itself; rows with a null text or without spans come back as they are."""
    names = docs.columns
    place, own, extra = unused(docs, "_place", "_key", "_spans")
    docs = identified(docs, place)
    found = find(docs, text=text, key=place, **options).select(F.col("key").alias(own), all_spans().alias(extra)).where(F.col(extra) != "")
    found = found.dropDuplicates([own])
    joined = docs.join(found, F.col(place) == F.col(own), "left").select(*names, extra)
    at, spans, schema = names.index(text), len(names), joined.drop(extra).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            new = [t if not s or t is None else redacted(t, [(k, int(a), int(z)) for k, a, z in (x.split(":") for x in s.split(","))])
                   for t, s in zip(b.column(at).to_pylist(), b.column(spans).to_pylist(), strict=True)]
            cols = [pa.array(new, pa.string()) if i == at else c for i, c in enumerate(b.columns) if i != spans]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return joined.mapInArrow(run, schema)
