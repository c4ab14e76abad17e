"""Language identification: multinomial naive Bayes over hashed character n-grams.

The n-grams (orders 1 to 3, of the lower-cased text between two blanks) are hashed into a fixed number of
buckets.  Training counts (language, bucket) in tasks and sums them by key; the log-probability matrix
(languages x buckets) is broadcast.  A batch of texts is scored as one sparse product in numpy: the bucket
of every n-gram selects a matrix row, rows are summed by text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import prepare

ORDERS = (1, 2, 3)
BUCKETS = 1 << 15
#: Characters held at once; longer texts are taken piece by piece with the overlap their n-grams need.
CHARS = 400_000
UNKNOWN = "und"
_MULT = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))


@dataclass
class Model:
    """Languages in order and their log-probabilities: (languages, BUCKETS), and the classes' log priors."""

    languages: list[str]
    log_prob: np.ndarray
    log_prior: np.ndarray


def held_out(key: Column, modulus: int = 4, rest: int = 2) -> Column:
    """Whether crc32 of the key's text leaves ``rest``; a null key counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(key.cast("string"), F.lit(""))), F.lit(modulus)) == rest


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "surrogatepass"), np.uint32)


def buckets(points: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the ``order``-gram that starts at each place (fewer places than points)."""
    n = len(points) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, order * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
    for j in range(order):
        h = (h ^ points[j: n + j]) * _MULT[j]
        h ^= h >> np.uint32(15)
    return ((h * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - 15)).astype(np.int64)


def _pieces(texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray, np.ndarray]]:
    """(text numbers, code points, starts, places that may begin an n-gram) of bounded groups of texts; a text of
    over CHARS comes in pieces, each with the characters that its last n-grams reach into."""
    over = max(ORDERS) - 1
    ids, parts, limits, size = [], [], [], 0
    for i, t in enumerate(texts):
        p = code_points(t)
        for at in range(0, len(p), CHARS):
            part = p[at: at + CHARS + over]
            ids.append(i)
            parts.append(part)
            limits.append(min(CHARS, len(part)))
            size += len(part)
            if size >= CHARS:
                yield _packed(ids, parts, limits)
                ids, parts, limits, size = [], [], [], 0
    if parts:
        yield _packed(ids, parts, limits)


def _packed(ids, parts, limits):
    lens = np.array([len(p) for p in parts], np.int64)
    return ids, np.concatenate(parts), np.cumsum(lens) - lens, np.array(limits, np.int64)


def grams(texts: list[str]) -> Iterator[tuple[list[int], np.ndarray, np.ndarray]]:
    """(text numbers, starts, buckets) for groups of texts and each order; a place without an n-gram has bucket BUCKETS."""
    for ids, points, starts, limits in _pieces(texts):
        ends = np.append(starts[1:], len(points))
        for order in ORDERS:
            b = np.full(len(points), BUCKETS, np.int64)
            found = buckets(points, order)
            b[: len(found)] = found
            for j in range(1, max(ORDERS)):  # the last places of each part: beyond its limit, or n-grams that leave it
                at = ends - j
                b[at[(at >= starts) & ((j < order) | (at - starts >= limits))]] = BUCKETS
            yield ids, starts, b


def fit(docs: DataFrame, most_per_language: int = 5000, most_languages: int = 200, smoothing: float = 0.5,
        text: str = "text", lang: str = "lang", key: str = "doc_id") -> Model:
    """Learn from a sample of the rows with a text and a language: at most about ``most_per_language`` of each
    language, chosen by a hash of key and text (all rows of a language that has fewer), so a key that many rows have is no larger a share.  More than ``most_languages``
    languages raise an error, so the broadcast matrix stays below most_languages x BUCKETS x 8 bytes.  No rows: a model without languages."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(text).alias("text"), F.col(lang).alias("lang"), F.col(key).cast("string").alias("key")) \
        .where("text is not null and lang is not null")
    sizes = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).limit(most_languages + 1).collect()}
    if len(sizes) > most_languages:
        raise ValueError(f"over {most_languages} languages")
    languages = sorted(sizes)
    if not languages:
        return Model([], np.zeros((0, BUCKETS)), np.zeros(0))
    # a share of the hash range, in millionths; rows equal in key and text are drawn or left as a whole
    share = F.create_map(*[F.lit(x) for name in languages for x in (name, 1_000_000 * most_per_language // sizes[name] + 1)])
    sample = rows.where(F.pmod(F.xxhash64(F.lit(11), F.col("key"), F.col("text")), F.lit(1_000_000)) < share[F.col("lang")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for b in batches:
            names = np.array(b.column(1).to_pylist(), object)
            texts = np.array(b.column(0).to_pylist(), object)
            for name in set(names):
                into = sums.setdefault(name, np.zeros(BUCKETS + 1, np.int64))
                for _, _, found in grams(texts[names == name].tolist()):
                    into += np.bincount(found, minlength=BUCKETS + 1)
        for name, n in sums.items():
            at = np.flatnonzero(n[:BUCKETS])
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array(at.astype(np.int32)), pa.array(n[at])],
                                             names=["lang", "bucket", "n"])

    counts = sample.select("text", "lang").mapInArrow(run, "lang string, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    table = np.full((len(languages), BUCKETS), smoothing)
    found = counts.toArrow()  # at most most_languages x BUCKETS rows
    place = {name: i for i, name in enumerate(languages)}
    row = np.array([place[x] for x in found.column("lang").to_pylist()], np.int64)
    np.add.at(table, (row, found.column("bucket").to_numpy()), found.column("n").to_numpy())
    size = np.array([sizes[x] for x in languages], float)
    return Model(languages, np.log(table / table.sum(axis=1, keepdims=True)), np.log(size / size.sum()))


def log_scores(texts: list[str], model: Model) -> np.ndarray:
    """(texts, languages) joint log-probabilities."""
    padded = np.concatenate([model.log_prob, np.zeros((len(model.languages), 1))], axis=1)
    out = np.tile(model.log_prior, (len(texts), 1))
    for ids, starts, found in grams(texts):
        for j in range(len(model.languages)):
            np.add.at(out[:, j], ids, np.add.reduceat(padded[j][found], starts))
    return out


def best(joint: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The most probable language's number (of equals the first) and its posterior probability."""
    return joint.argmax(axis=1), 1 / np.exp(joint - joint.max(axis=1, keepdims=True)).sum(axis=1)


def has_letter(text: str | None) -> bool:
    return text is not None and any(c.isalpha() for c in text)


def predict(docs: DataFrame, model: Model, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, lang_pred string, score double) for every row: the most probable language (of equals the first by name)
    and its posterior probability.

    Null texts, texts without a letter, and all texts under a model without languages get ``und`` and 0.0.  Keys may
    be null or repeated.  Only the text is used; other columns are not read."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(1).to_pylist()
            names, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
            at = [i for i, t in enumerate(texts) if m.languages and has_letter(t)]
            if at:
                found, scores[at] = best(log_scores([texts[i] for i in at], m))
                for i, j in zip(at, found.tolist(), strict=True):
                    names[i] = m.languages[j]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(names, pa.string()), pa.array(scores)],
                                             names=["key", "lang_pred", "score"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind}, lang_pred string, score double"))


def keep(docs: DataFrame, model: Model, above: float = 0.5, text: str = "text") -> DataFrame:
    """The rows of ``docs`` whose language is found with a posterior probability over ``above``: null texts and texts
    without a letter go.  Under a model without languages every text with a letter stays.  Rows pass through their
    tasks whole, so neither keys nor other columns matter."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    place = docs.columns.index(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            texts = b.column(place).to_pylist()
            good = [i for i, t in enumerate(texts) if has_letter(t)]
            if good and m.languages:
                _, score = best(log_scores([texts[i] for i in good], m))
                good = [i for i, s in zip(good, score.tolist(), strict=True) if s > above]
            if good:
                yield b.take(pa.array(good, pa.int32()))

    return docs.mapInArrow(run, docs.schema)
