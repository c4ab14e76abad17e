"""Byte-level BPE token counts by rank-synchronous merging of ragged arrays.

All distinct pre-tokens of a batch lie in one flat symbol array.  A step looks up the rank of every
neighbouring pair, takes each sequence's lowest one, and merges all its places in all sequences at
once; sequences without a pair that merges leave with their number of symbols.  Since a merged symbol
only ever takes part in later merges than the one that made it, this is the same result as merging one
pair at a time.  Counts of pre-tokens are remembered by the worker up to a fixed number.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import prepare

#: The byte-level pre-tokeniser's split, a fixed value of the vocabulary's format.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Pre-tokens whose count a worker remembers; beyond it the memory starts anew.
REMEMBERED = 400_000
#: Characters and pre-tokens taken up at once.
CHARS, TOKENS = 4_000_000, 1_000_000
NONE = np.int32(2**31 - 1)


@dataclass
class Vocabulary:
    """Symbols of the 256 bytes, special strings, and the merges as hash tables of pair -> rank."""

    name: str
    size: int
    byte_symbol: np.ndarray
    merged: np.ndarray  # rank -> symbol
    tables: list[tuple[np.ndarray, np.ndarray]]  # (pair, rank) by slot; a pair whose slot is taken is in the next one
    special: list[str]

    SHIFT = np.uint64(64 - 19)

    @staticmethod
    def slot(pairs: np.ndarray) -> np.ndarray:
        return ((pairs.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> Vocabulary.SHIFT).astype(np.int64)

    def rank(self, pairs: np.ndarray) -> np.ndarray:
        at = self.slot(pairs)
        out = np.full(len(pairs), NONE, np.int32)
        for held, ranks in self.tables:
            hit = held[at] == pairs
            out[hit] = ranks[at[hit]]
        return out


def byte_alphabet() -> list[str]:
    """The character that stands for each byte: itself if printable Latin-1, else the next from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(spare)) for b in range(256)]


def load(path: str) -> Vocabulary:
    """The vocabulary of a byte-level BPE ``tokenizer.json`` without normalizer or added prefix space."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    if model["type"] != "BPE" or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or spec.get("normalizer"):
        raise ValueError(f"{path}: not a plain byte-level BPE vocabulary")
    added = spec.get("added_tokens", [])
    if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in added):
        raise ValueError(f"{path}: added tokens that take neighbouring characters")
    vocab = model["vocab"]
    merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
    size = max(vocab.values()) + 1
    pairs = np.array([vocab[a] * size + vocab[b] for a, b in merges], np.int64)
    ranks, tables = np.arange(len(pairs), dtype=np.int32), []
    while len(pairs):
        held, rank = np.full(1 << 19, -1, np.int64), np.full(1 << 19, NONE, np.int32)
        at = Vocabulary.slot(pairs)
        first = np.unique(at, return_index=True)[1]
        held[at[first]], rank[at[first]] = pairs[first], ranks[first]
        tables.append((held, rank))
        left = np.setdiff1d(np.arange(len(pairs)), first)
        pairs, ranks = pairs[left], ranks[left]
    return Vocabulary(path, size, np.array([vocab[c] for c in byte_alphabet()], np.int32),
                      np.array([vocab[a + b] for a, b in merges], np.int32), tables,
                      sorted((t["content"] for t in added), key=len, reverse=True))


def count_symbols(words: list[bytes], vocab: Vocabulary) -> np.ndarray:
    """Symbols that remain of each pre-token (bytes, none empty) after all merges."""
    lens = np.fromiter(map(len, words), np.int64, len(words))
    sym = vocab.byte_symbol[np.frombuffer(b"".join(words), np.uint8)].astype(np.int64)
    own = np.repeat(np.arange(len(words)), lens)
    out = lens.copy()
    while len(sym):
        starts = np.flatnonzero(np.concatenate(([True], own[1:] != own[:-1])))
        inside = np.flatnonzero(own[1:] == own[:-1])
        rank = np.full(len(sym), NONE, np.int32)
        rank[inside] = vocab.rank(sym[inside] * vocab.size + sym[inside + 1])
        least = np.minimum.reduceat(rank, starts)
        sizes = np.diff(np.append(starts, len(sym)))
        out[own[starts]] = sizes
        live = np.repeat(least != NONE, sizes)
        if not live.any():
            break
        at = np.flatnonzero(live & (rank == np.repeat(least, sizes)))
        # 'aaa': of places that overlap, every second one from the left
        fresh = np.concatenate(([True], at[1:] != at[:-1] + 1))
        begin = np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))
        at = at[(np.arange(len(at)) - begin) % 2 == 0]
        sym[at] = vocab.merged[rank[at]]
        live[at + 1] = False
        sym, own = sym[live], own[live]
    return out


_remembered: dict[str, dict[str, int]] = {}


def pre_tokens(text: str, split: regex.Pattern, special: regex.Pattern | None) -> Iterator[tuple[int, list[str]]]:
    """(special strings, pre-tokens) of a text, in bounded lists."""
    parts = special.split(text) if special else [text]
    yield len(parts) - 1, []
    for part in parts:
        if len(part) <= CHARS:
            yield 0, split.findall(part)
        else:
            found = (m.group() for m in split.finditer(part))
            while some := list(islice(found, TOKENS)):
                yield 0, some


def count(texts: list[str], vocab: Vocabulary) -> np.ndarray:
    """Tokens of each text."""
    split = regex.compile(SPLIT)
    special = regex.compile("|".join(map(regex.escape, vocab.special))) if vocab.special else None
    known = _remembered.setdefault(vocab.name, {})
    totals = np.zeros(len(texts), np.int64)
    held: list[tuple[int, list[str]]] = []
    size = 0

    def settle() -> None:
        nonlocal held, size
        new = list(set().union(*(words for _, words in held)) - known.keys())
        for at in range(0, len(new), 200_000):
            some = new[at: at + 200_000]
            known.update(zip(some, count_symbols([w.encode() for w in some], vocab).tolist(), strict=True))
        for i, words in held:
            totals[i] += sum(map(known.__getitem__, words))
        held, size = [], 0
        if len(known) > REMEMBERED:
            known.clear()

    for i, text in enumerate(texts):
        for extra, words in pre_tokens(text, split, special):
            totals[i] += extra
            if words:
                held.append((i, words))
                size += len(words)
            if size >= TOKENS:
                settle()
    settle()
    return totals


def token_counts(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, n_bytes bigint, n_tokens bigint) of every whole text, as the tokenizer file at ``path`` gives them
    without begin, end or added special tokens; a special string inside a text is one token.

    A null text counts as empty: 0 bytes, 0 tokens.  Keys may be null or repeated; other columns are not read.
    The file is read on the driver and its arrays (a few MB, by the vocabulary's size) are broadcast."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(load(path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = shared.value
        for b in batches:
            texts = pc.fill_null(b.column(1), "")
            n = count(texts.to_pylist(), vocab)
            yield pa.RecordBatch.from_arrays([b.column(0), pc.cast(pc.binary_length(texts), pa.int64()), pa.array(n)],
                                             names=["key", "n_bytes", "n_tokens"])

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind}, n_bytes long, n_tokens long"))
