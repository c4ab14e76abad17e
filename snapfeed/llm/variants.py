"""Spelling variant grouping by a reduced alphabet.

A hash maps the letters to a few symbols.  Words one edit apart have reduced forms at most one edit apart, so the full
one-edit neighbourhood of every reduced word, joined with the reduced vocabulary, meets every pair of near words; a pair
that meets is verified on the original strings.  With few symbols a neighbourhood is small: a word of L letters has
about 2 L times the symbols as neighbours instead of 2 L times the letters of its script.

Reduced words are known by a polynomial hash, from which those of all edits follow without spelling them out.  Every neighbour is
generated once (a symbol put into or taken out of a run of equal ones counts at the run's beginning), so
every pair of words meets once.  A bitmap of the reduced vocabulary, of fixed size, leaves out nearly all neighbours that no word
has before they are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bitmap, in_bitmap, mix64, prepare, stored

#: The letters of words: ASCII letters and U+00C0 to U+00FF.
LETTERS = "A-Za-zÀ-ÿ"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def vocabulary(docs: DataFrame, least_length: int = 7, least_count: int = 2, one_in: int = 31, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(word, n long): the words of all whole texts with at least ``least_length`` letters and ``least_count`` occurrences.

    A word is a maximal run of ``LETTERS`` with A-Z lower-cased.  Where ``one_in`` divides the crc32 h of "key:run", the run's
    letter h % length is taken out first.  Null texts have no words; a null key counts as empty in "key:run".  Occurrences are
    summed in tasks before they are shuffled by word, so frequent words and repeated rows are no hot keys."""
    # a run only gets shorter, so shorter ones are left out at once; a match begins where its run does
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("key"), F.regexp_extract_all(F.col(text), F.lit(f"([{LETTERS}]{{{least_length},}})"), 1).alias("runs"))
    runs = runs.select("key", F.explode("runs").alias("run")).select("key", F.translate("run", UPPER, LOWER).alias("run"))
    hashed = runs.select("run", F.crc32(F.concat("key", F.lit(":"), "run").cast("binary")).alias("h"))
    at = F.pmod("h", F.length("run").cast("long")).cast("int")
    shorter = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    words = hashed.select(F.when(F.pmod("h", F.lit(one_in)) == 0, shorter).otherwise(F.col("run")).alias("word"))
    return words.where(F.length("word") >= least_length).groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least_count)


BASE = 0x9E3779B97F4A7C15
#: Words taken up together, and neighbours held at once.
ROWS, HELD = 1 << 15, 1 << 20


def _powers(n: int) -> np.ndarray:
    """The hash base to the powers -1 to n."""
    out = np.multiply.accumulate(np.append(np.uint64(1), np.full(n, BASE, np.uint64)))
    return np.append(np.uint64(pow(BASE, -1, 1 << 64)), out)


def reduced(words: list[str], symbols: int) -> np.ndarray:
    """(words, letters) symbols, from 1 on, of words of one length."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), -1) if words[0] else np.zeros((len(words), 0), np.uint32)
    return ((points * np.uint32(0x9E3779B1)) >> np.uint32(16)) % np.uint32(symbols) + np.uint32(1)


def forms(codes: np.ndarray) -> np.ndarray:
    """Hashes of reduced words: the sum of symbol x base ** place, scrambled."""
    return mix64((codes.astype(np.uint64) * _powers(codes.shape[1])[1: codes.shape[1] + 1]).sum(axis=1, dtype=np.uint64))


def neighbourhood(codes: np.ndarray, symbols: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, hashes) of the reduced words themselves and of all that one edit makes of them, each once a row."""
    n, length = codes.shape
    codes, power = codes.astype(np.uint64), _powers(length + 1)
    terms = codes * power[1: length + 1]
    before = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)  # up to each place
    after = before[:, -1:] - before  # from each place on
    rows = np.arange(n)
    yield rows, mix64(before[:, -1])
    for i in range(length + 1):
        last = codes[:, i - 1] if i else np.zeros(n, np.uint64)
        if i < length:
            own = np.flatnonzero(codes[:, i] != last)
            yield own, mix64(before[own, i] + after[own, i + 1] * power[0])
        for s in range(1, symbols + 1):
            symbol = power[i + 1: i + 2] * np.uint64(s)
            if i < length:
                own = np.flatnonzero(codes[:, i] != s)
                yield own, mix64(before[own, i] + symbol + after[own, i + 1])
            own = np.flatnonzero(last != s)
            yield own, mix64(before[own, i] + symbol + after[own, i] * power[2])


def _large(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``ROWS``, for steps that cost as much for few words as for many."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.num_rows for x in held) >= ROWS:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def _by_length(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str], np.ndarray]]:
    """(batch, words, their numbers) of the words of one length each; ``word`` is the first column."""
    for b in _large(batches):
        words = b.column(0).to_pylist()
        lens = np.fromiter(map(len, words), np.int64, len(words))
        for n in np.unique(lens):
            at = np.flatnonzero(lens == n)
            yield b, [words[i] for i in at.tolist()], at


def coded(words: DataFrame, symbols: int) -> DataFrame:
    """(word, n, form): (word, n) with the hash of the reduced word."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, some, at in _by_length(batches):
            out = b.take(pa.array(at))
            yield pa.RecordBatch.from_arrays([*out.columns, pa.array(forms(reduced(some, symbols)).view(np.int64))], names=["word", "n", "form"])

    return words.select("word", "n").mapInArrow(run, "word string, n long, form long")


def near(held: DataFrame, symbols: int = 8) -> DataFrame:
    """(word, n, near, near_n): all ordered pairs of words that differ by exactly one inserted, deleted or replaced letter, out
    of (word, n, form) by ``coded`` with distinct words, which is read three times."""
    bits = held.sparkSession.sparkContext.broadcast(bitmap(held.select("form").distinct(), "form"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b, some, at in _by_length(batches):
            step = max(1, HELD // max(1, 2 * symbols * (len(some[0]) + 1)))
            for k in range(0, len(some), step):
                rows, hashes = [], []
                for own, h in neighbourhood(reduced(some[k: k + step], symbols), symbols):
                    hit = in_bitmap(bits.value, h)
                    rows.append(at[k: k + step][own[hit]])
                    hashes.append(h[hit])
                out = b.take(pa.array(np.concatenate(rows)))
                yield pa.RecordBatch.from_arrays([*out.columns, pa.array(np.concatenate(hashes).view(np.int64))], names=["word", "n", "form"])

    edited = held.select("word", "n").mapInArrow(run, "word string, n long, form long")
    met = edited.join(held.select("form", F.col("word").alias("near"), F.col("n").alias("near_n")), "form")
    return met.where(F.levenshtein("word", "near", 1) == 1).select("word", "n", "near", "near_n")


def group(words: DataFrame, times: int = 10, symbols: int = 8) -> DataFrame:
    """(word, n, n_near long, form, form_n, root) for (word, n) with distinct words.

    ``form`` is the near word with the largest n (of equals the first in code-point order), if that is at least ``times``
    (2 or more) the word's own; else null.  ``root`` is the last of the forms that follow each other from the word on, the word
    itself without any.  Roots are found by doubling: the n of forms grows ``times``-fold from link to link, so the links end
    after as many as a count has digits, and log2 of that many joins find the last."""
    prepare(words.sparkSession)
    words = stored(coded(words, symbols), "words")
    pairs = near(words, symbols).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("near"))).alias("best"))
    found = words.join(pairs, "word", "left")
    has = -F.col("best.minus") >= times * F.col("n")
    found = stored(found.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(has, F.col("best.near")).alias("form"),
                                F.when(has, -F.col("best.minus")).alias("form_n")), "word-forms")
    links = found.where("form is not null").select("word", F.col("form").alias("root"))
    while True:
        further = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        links = stored(links.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "word-roots")
        if links.where("moved").isEmpty():
            break
        links = links.drop("moved")
    return found.join(links.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))
