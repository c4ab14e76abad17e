"""SentencePiece encoding by sampling segmentations without replacement, and decoding.

The pieces that spell a text form a lattice; a segmentation's probability is the product of its pieces'
weights, normalised over the lattice.  Adding a Gumbel variable to the log-probability of every segmentation
and taking the k largest sums draws k distinct segmentations without replacement.  They are found best first,
as by A*: a node stands for all segmentations that continue it, its value is the largest perturbed
log-probability among them - drawn from the node's total mass, cut off at its parent's value - so the first
complete segmentation taken off the queue is the best of all that are left.

No piece crosses a word boundary, so a text's lattice is a chain of word lattices.  The distinct words of a
batch, and of these the distinct ends, get their backward sums once, in numpy; the chain of a path is drawn for all words of the batch at once; what
leaves a path first at one word is queued as one node and opened up only if it is taken.  All random numbers
are hashes of the row's key, the seed and the place, so a row's samples depend on nothing else.

The k + 1-th largest value is the threshold from which a sample's inclusion probability follows:
1 - exp(-exp(log p - threshold)).
"""

from __future__ import annotations

import heapq
import math
import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StringType, StructField, StructType

from .common import mix64, prepare, release

SPACE = "▁"
#: Characters of the texts taken up at once (a single text may be longer).
CHARS = 1_000_000
SHARED = 64  # characters of a word's end for which places are shared
BATCH = 1 << 20  # ids and characters of one batch of results
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
PRIME = np.uint64(0x100000001B3)


@dataclass
class Pieces:
    """A model's pieces: log weights, and all their beginnings in hash tables (hash of characters -> piece or -1)."""

    proto: bytes
    strings: list[str]
    spelled: pa.Array  # the text of each piece, and then once more without the blank in front
    lead: np.ndarray  # (pieces) how its text begins: 0 no blank, 1 one, 2 more, 3 is one blank; 4 where a piece alone does not say it
    prefixed: bool  # whether decoding drops the blank in front of a text
    log_weight: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray]]
    goes_on: np.ndarray  # whether a longer piece begins with a piece; the last two, as -2 and -1: what ``find`` gives for no piece
    longest: int
    byte_of: np.ndarray  # 256 piece ids
    breaks: tuple[bool, bool]  # whether words begin at blanks, and at and after line breaks
    unknown: float

    BITS = np.uint64(64 - 18)

    @staticmethod
    def slot(h: np.ndarray) -> np.ndarray:
        return ((h * GOLDEN) >> Pieces.BITS).view(np.int64)

    def find(self, h: np.ndarray) -> np.ndarray:
        """Piece of each hash, -1 for a beginning only, -2 for neither."""
        at, out = self.slot(h), np.full(len(h), -2, np.int32)
        open_ = np.arange(len(h))
        for held, piece in self.tables:
            p, same = piece[at], held[at] == h
            hit = np.flatnonzero(same)
            out[open_[hit]] = p[hit]
            left = np.flatnonzero(~same & (p != -2))  # a hash whose slot is free is in no later table either
            if not len(left):
                break
            at, h, open_ = at[left], h[left], open_[left]
        return out


def _hashes(codes: np.ndarray) -> np.ndarray:
    """Hash after each of the characters."""
    out, h = np.empty(len(codes), np.uint64), np.uint64(0xCBF29CE484222325)
    with np.errstate(over="ignore"):
        for i, c in enumerate(codes.astype(np.uint64)):
            h = (h ^ c) * PRIME
            out[i] = h
    return out


def load(path: str, alpha: float = 1.0) -> Pieces:
    """Pieces of a SentencePiece model.  Unigram scores are log-probabilities; the scores of a BPE model are
    negative merge ranks and are read by Zipf's law as -log(2 + rank).  ``alpha`` sharpens (> 1) or flattens."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    strings = [sp.id_to_piece(i) for i in range(n)]
    plain = [not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) or sp.is_byte(i)) for i in range(n)]
    score = np.array([sp.get_score(i) for i in range(n)])
    usual = score[[i for i in range(n) if plain[i] and score[i] > -1e8]]
    if len(usual) and (usual == np.round(usual)).all():
        rank = np.where(score > -1e8, -score, np.arange(n))
        weight = -np.log(2.0 + np.maximum(rank, 0))
    else:
        weight = score.copy()
    floor = float(weight[plain].min()) - 10.0 if any(plain) else -20.0
    byte_of = np.array([sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)], np.int32)
    if not sp.is_byte(int(byte_of[0])):
        byte_of[:] = sp.unk_id()
    entries: dict[int, int] = {}
    begins: set[int] = set()
    for i in range(n):
        if plain[i]:
            hs = _hashes(np.array([ord(c) for c in strings[i]], np.uint32)).tolist()
            begins.update(hs[:-1])
            for h in hs[:-1]:
                entries.setdefault(h, -1)
            entries[hs[-1]] = i
    goes_on = np.zeros(n + 2, bool)
    goes_on[-1] = True
    goes_on[[i for h, i in entries.items() if i >= 0 and h in begins]] = True
    keys, vals = np.array(list(entries), np.uint64), np.array(list(entries.values()), np.int32)
    tables = []
    while len(keys):
        held, piece = np.zeros(1 << 18, np.uint64), np.full(1 << 18, -2, np.int32)
        at = Pieces.slot(keys)
        first = np.unique(at, return_index=True)[1]
        held[at[first]], piece[at[first]] = keys[first], vals[first]
        tables.append((held, piece))
        left = np.setdiff1d(np.arange(len(keys)), first)
        keys, vals = keys[left], vals[left]
    many = [s for s, ok in zip(strings, plain, strict=True) if ok and len(s) > 1]
    # pieces may cross words (the whole text is one lattice) or line breaks
    breaks = (not any(SPACE in s.lstrip(SPACE) for s in many), not any("\n" in s for s in many))
    spelled = [s.replace(SPACE, " ") if ok else None for s, ok in zip(strings, plain, strict=True)]
    for b in range(128):  # a byte of ASCII is a character of its own
        if b != 32 and sp.is_byte(int(byte_of[b])):
            spelled[byte_of[b]] = chr(b)
    lead = np.array([4 if s is None else 3 if s == " " else min(2, len(s) - len(s.lstrip(" "))) for s in spelled], np.int8)
    spelled = pa.array([s or "" for s in spelled] + [(s or "").removeprefix(" ") for s in spelled], pa.string())
    worded = next((i for i, s in enumerate(strings) if plain[i] and len(s) > 1 and s[0] == SPACE and SPACE not in s[1:]), None)
    prefixed = worded is not None and sp.decode([worded]) == strings[worded][1:]
    return Pieces(sp.serialized_model_proto(), strings, spelled, lead, prefixed, alpha * weight, tables, goes_on, max(map(len, strings)), byte_of, breaks, alpha * floor)


@dataclass
class Lattice:
    """Word lattices.  A place is what is left of a word from a character on, so words with one ending share its places; they are
    numbered by what is left, from 1 on, and 0 is the end of a word.  Each place has a run of edges in order of length."""

    start: np.ndarray  # (words) first place
    at: np.ndarray  # (places) first edge
    many: np.ndarray  # (places) edges
    place: np.ndarray  # (edges) place
    piece: np.ndarray  # (edges) piece, or -1 - code point for a character unknown to the model
    then: np.ndarray  # (edges) next place
    log_p: np.ndarray  # (edges) log-probability at the place; 0 for an only edge
    cum: np.ndarray  # (edges) cumulative probabilities of the place's edges; 2 at the last


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def distinct_words(texts: list[str], m: Pieces) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of each word's lattice, words of each text, code points of the distinct words end to end, their sizes).

    A word begins where blanks do, and at and after a line break.  Words are told apart by a hash; that equal hashes are equal
    words is verified."""
    points = code_points("".join(texts))
    n = len(points)
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(lens)
    begin = np.zeros(n, bool)
    begin[(ends - lens)[lens > 0]] = True
    if m.breaks[0]:
        blank = points == ord(SPACE)
        begin[1:] |= blank[1:] & ~blank[:-1]
        if m.breaks[1]:
            line = points == 10
            begin |= line
            begin[1:] |= line[:-1]
    starts = np.flatnonzero(begin)
    sizes = np.diff(np.append(starts, n))
    per_text = np.diff(np.searchsorted(starts, ends), prepend=0)
    if not n:
        return starts, per_text, points, sizes
    inside = np.arange(n) - np.repeat(starts, sizes)
    with np.errstate(over="ignore"):
        h = np.add.reduceat(mix64(points + (inside + 1).view(np.uint64) * GOLDEN), starts)
    which = pa.array(h).dictionary_encode().indices.to_numpy()  # in order of appearance: frequent words lie close together
    first = np.empty(int(which.max()) + 1, np.int64)
    first[which[::-1]] = np.arange(len(which))[::-1]
    own = first[which]
    if not ((sizes[own] == sizes).all() and (points[np.repeat(starts[own], sizes) + inside] == points).all()):  # two words with one hash
        words = ["".join(map(chr, points[a: a + k].tolist())) for a, k in zip(starts.tolist(), sizes.tolist(), strict=True)]
        _, first, which = np.unique(np.array(words, object), return_index=True, return_inverse=True)
    sizes = sizes[first]
    at = np.repeat(starts[first] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return which, per_text, points[at], sizes


def places(points: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code point of each place, place after it, first place of each word, number of places by what is left of a word)."""
    end, codes = np.cumsum(size), points.astype(np.int64)
    start = np.zeros(len(size), np.int64)
    code, after, many = [np.zeros(1, np.int64)], [np.zeros(1, np.int64)], [1]
    live, n = np.arange(len(size)), 1
    while len(live) and len(many) <= SHARED:  # a place is told by its character and the place after it
        told = pa.array(codes[end[live] - len(many)] << 32 | start[live]).dictionary_encode()
        start[live] = told.indices.to_numpy() + n
        told = told.dictionary.to_numpy()
        code.append(told >> 32)
        after.append(told & 0xFFFFFFFF)
        n += len(told)
        live = live[size[live] >= len(many) + 1]
        many.append(len(told))
    if len(live):  # the beginnings of long words have places of their own
        own = size[live] - SHARED
        last = np.cumsum(own) - 1
        left = np.repeat(SHARED + 1 + last, own) - np.arange(own.sum())
        order = np.argsort(left, kind="stable")
        place = np.empty(len(left), np.int64)
        place[order] = np.arange(n, n + len(left))
        to = np.append(place[1:], 0)
        to[last] = start[live]
        start[live] = place[last + 1 - own]
        code.append(codes[np.repeat(end[live], own) - left][order])
        after.append(to[order])
        many.extend(np.bincount(left)[SHARED + 1:].tolist())
    return np.concatenate(code), np.concatenate(after), start, np.array(many)


def build(points: np.ndarray, size: np.ndarray, m: Pieces) -> Lattice:
    """The lattices of distinct words (their code points end to end and their sizes) and their backward sums."""
    code, after, start, levels = places(points, size)
    n = len(code)
    codes, h = code.astype(np.uint64), np.full(n - 1, 0xCBF29CE484222325, np.uint64)
    live = to = np.arange(1, n)
    many = np.zeros(n, np.int64)
    found = []
    for step in range(1, m.longest + 1):
        with np.errstate(over="ignore"):
            h = (h ^ codes[to]) * PRIME
        to = after[to]
        p = m.find(h)
        if step == 1:  # a single character is an edge in any case; unknown ASCII ones are their byte's piece
            alone = np.where(code < 128, m.byte_of[np.minimum(code, 127)], -1 - code)[1:]
            found.append((many[1:].copy(), live, np.where(p < 0, alone, p), to, np.where(p < 0, m.unknown, m.log_weight[np.maximum(p, 0)])))
            many[1:] = 1
        else:
            edge = np.flatnonzero(p >= 0)
            own, p_own = live[edge], p[edge]
            found.append((many[own], own, p_own, to[edge], m.log_weight[p_own]))
            many[own] += 1
        go = np.flatnonzero(m.goes_on[p] & (to > 0))
        if not len(go):
            break
        live, h, to = live[go], h[go], to[go]
    ends = np.cumsum(many)
    first = ends - many
    n_edges = int(ends[-1])
    piece, then, weight = np.empty(n_edges, np.int32), np.empty(n_edges, np.int32), np.empty(n_edges)
    for slot, at, p, to, w in found:
        e = first[at] + slot
        piece[e], then[e], weight[e] = p, to, w
    total, log_p = np.zeros(n), np.empty(n_edges)
    hi = 1
    for count in levels[1:].tolist():  # a place's successors come before it
        lo, hi = hi, hi + count
        a, b, k = int(first[lo]), int(ends[hi - 1]), many[lo:hi]
        s = weight[a:b] + total[then[a:b]]
        at = first[lo:hi] - a
        top = np.maximum.reduceat(s, at)
        total[lo:hi] = top + np.log(np.add.reduceat(np.exp(s - np.repeat(top, k)), at))
        log_p[a:b] = s - np.repeat(total[lo:hi], k)
    cum = np.exp(log_p)
    more, slot = np.flatnonzero(many > 1), 1
    while len(more):  # sums of each place alone: they must not depend on the other words
        e = first[more] + slot
        cum[e] += cum[e - 1]
        slot += 1
        more = more[many[more] > slot]
    cum[ends[1:] - 1] = 2.0  # a random number below 1 never passes the last edge
    return Lattice(start, first, many, np.repeat(np.arange(n), many), piece, then, log_p, cum)


def _uniform(base: np.ndarray, step: int) -> np.ndarray:
    """In (0, 1), from uint64 streams."""
    with np.errstate(over="ignore"):
        x = mix64(base + np.uint64(step + 1) * GOLDEN)
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def draw(lat: Lattice, which: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each word occurrence (number of its lattice, random stream): the edges drawn, in order of occurrence,
    their number and the log-probability."""
    own = np.arange(len(which))
    log_p, n = np.zeros(len(which)), np.zeros(len(which), np.int64)
    steps, streams, step = [], base, 0
    edge = lat.at[lat.start][which]
    while len(own):
        u = _uniform(streams, step)
        open_ = np.flatnonzero(lat.cum[edge] <= u)
        while len(open_):  # most stop at the first few edges
            e = edge[open_] + 1
            edge[open_] = e
            open_ = open_[lat.cum[e] <= u[open_]]
        steps.append((own, edge))
        log_p[own] += lat.log_p[edge]
        n[own] += 1
        then = lat.then[edge]
        going = np.flatnonzero(then)
        own, streams, edge = own[going], streams[going], lat.at[then[going]]
        step += 1
    where = np.cumsum(n) - n
    edges = np.empty(int(n.sum()), np.int64)
    for i, (who, edge) in enumerate(steps):
        edges[where[who] + i] = edge
    return edges, n, log_p


def _cut_gumbel(phi: np.ndarray, top: np.ndarray, u: np.ndarray) -> np.ndarray:
    """A Gumbel variable at ``phi`` below ``top``."""
    with np.errstate(divide="ignore"):
        return -np.logaddexp(-top, np.log(-np.log(u)) - phi)


def _log_rest(log_p: np.ndarray) -> np.ndarray:
    """log(1 - p)."""
    with np.errstate(divide="ignore"):
        return np.log(-np.expm1(np.minimum(log_p, 0.0)))


@dataclass
class Path:
    """One segmentation of each text of a batch that has one: pieces by word occurrence."""

    edges: list[np.ndarray]
    log_p: list[np.ndarray]
    counts: list[np.ndarray]


def sample(texts: list[str], seeds: np.ndarray, k: int, m: Pieces, sp: sentencepiece.SentencePieceProcessor) -> list[list[tuple[np.ndarray, float, float, float]]]:
    """For each text up to ``k`` distinct segmentations, best perturbed value first: (ids, log p, value, log inclusion).
    A text with fewer segmentations gets them all, each with inclusion probability 1."""
    which, per_text, points, sizes = distinct_words([sp.normalize(t) if t else "" for t in texts], m)
    lat = build(points, sizes, m)
    first = np.cumsum(per_text) - per_text
    of = np.repeat(np.arange(len(texts)), per_text)
    index = np.arange(len(which)) - first[of]
    full = per_text > 0
    value = -np.log(-np.log(_uniform(mix64(seeds), 0)))
    out: list[list] = [[] for _ in texts]
    queues: list[list] = [[] for _ in texts]
    rngs: list[random.Random | None] = [None] * len(texts)
    paths: list[list[tuple[np.ndarray, np.ndarray, np.ndarray]]] = [[] for _ in texts]
    begin = {int(i): (0, None) for i in range(len(texts))}  # text -> (first word drawn anew, what comes before it)
    for turn in range(k):
        # draw the words from ``begin`` on, for all texts at once
        live = np.array([i in begin for i in range(len(texts))])
        cut = np.array([begin[i][0] if i in begin else 0 for i in range(len(texts))], np.int64)
        sel = np.flatnonzero(live[of] & (index >= cut[of])) if len(of) else np.zeros(0, np.int64)
        with np.errstate(over="ignore"):
            base = mix64(seeds[of[sel]] + mix64(index[sel].astype(np.uint64) * GOLDEN + np.uint64(turn + 1)))
        edges, n, log_p = draw(lat, which[sel], base)
        edge_end = np.cumsum(n)
        bounds = np.searchsorted(of[sel], np.arange(len(texts) + 1))
        sofar = np.empty(len(sel))
        for i, (_, prefix) in begin.items():
            lo, hi = bounds[i], bounds[i + 1]
            new = (edges[(edge_end[lo - 1] if lo else 0): (edge_end[hi - 1] if hi else 0)], n[lo:hi], log_p[lo:hi])
            path = new if prefix is None else tuple(np.concatenate([p, q]) for p, q in zip(prefix, new, strict=True))
            paths[i].append(path)
            run = np.cumsum(path[2])  # of this text alone: sums must not depend on the other rows
            sofar[lo:hi] = run[len(run) - (hi - lo):] - log_p[lo:hi]
            out[i].append((path, float(run[-1]) if len(run) else 0.0, float(value[i])))
        # what leaves the path first at each of the new words, as one node a word
        if len(sel):
            phi = sofar + _log_rest(log_p)
            g = _cut_gumbel(phi, value[of[sel]], _uniform(base ^ np.uint64(0x5851F42D4C957F2D), 1 << 20))
            starts = bounds[:-1][bounds[:-1] < bounds[1:]]
            for _ in range(k - turn):  # no more than these can still be taken or be the threshold
                best = np.maximum.reduceat(g, starts)
                some = np.flatnonzero(best > -np.inf)
                if not len(some):
                    break
                hit = np.flatnonzero(g == np.repeat(best, np.diff(np.append(starts, len(g)))))
                hit = hit[np.unique(of[sel][hit], return_index=True)[1]]
                hit = hit[g[hit] > -np.inf]
                for j in hit.tolist():
                    i = int(of[sel[j]])
                    heapq.heappush(queues[i], (-float(g[j]), len(queues[i]) + turn * 1_000_000, int(index[sel[j]]), turn, None))
                g[hit] = -np.inf
        if turn + 1 == k:
            break
        begin = {}
        for i, q in enumerate(queues):
            if q:
                if rngs[i] is None:
                    rngs[i] = random.Random(int(seeds[i]))
                found = _open(q, lat, paths[i], rngs[i])
                if found is not None:
                    begin[i], value[i] = found[:2], found[2]
    result: list[list[tuple[np.ndarray, float, float, float]]] = []
    for i, found in enumerate(out):
        limit = -queues[i][0][0] if queues[i] else -math.inf
        rows = []
        for path, log_p, v in found:
            x = log_p - limit
            log_q = 0.0 if limit == -math.inf or x > 700 else (x if x < -30 else math.log(-math.expm1(-math.exp(x))))
            rows.append((_ids(lat.piece[path[0]], m) if full[i] else np.zeros(0, np.int32), log_p, v, log_q))
        result.append(rows)
    return result


def _open(q: list, lat: Lattice, paths: list, rng: random.Random) -> tuple[int, tuple, float] | None:
    """Take the best node off a text's queue and follow it to the end of its word.  What is left of it goes back to
    the queue.  Gives the next word, the pieces up to there and the node's value; nothing if no node is left."""
    def probs(place: int) -> list[float]:
        c = lat.cum[lat.at[place]: lat.at[place] + lat.many[place]].tolist()
        c[-1] = 1.0
        return [max(0.0, x - y) for x, y in zip(c, [0.0, *c], strict=False)]

    def push(phi: float, top: float, node: tuple) -> None:
        if phi > -math.inf:
            e = rng.expovariate(1.0) or 1e-300
            a, b = -top, math.log(e) - phi
            g = -(max(a, b) + math.log1p(math.exp(-abs(a - b))))
            heapq.heappush(q, (-g, rng.random(), *node))

    def log(x: float) -> float:
        return math.log(x) if x > 0 else -math.inf

    negative, _, word, turn, node = heapq.heappop(q)
    top = -negative
    edges, counts, log_p = paths[turn]
    at = int(counts[:word].sum())
    base = float(log_p[:word].sum())
    if node is None:  # all that leaves path ``turn`` first at this word: choose the edge where it leaves
        own = edges[at: at + int(counts[word])].tolist()
        options, phi = [], base
        for j, e in enumerate(own):
            place = int(lat.place[e])
            p, slot = probs(place), e - int(lat.at[place])
            options.append((phi + log(sum(x for s, x in enumerate(p) if s != slot)), (own[:j], place, (slot,), phi)))
            phi += log(p[slot])
        highest = max(o[0] for o in options)
        if highest == -math.inf:  # what leaves the path here is below the smallest number
            return _open(q, lat, paths, rng) if q else None
        mass = [math.exp(o[0] - highest) for o in options]
        pick = rng.choices(range(len(options)), mass)[0]
        for j, (phi, rest) in enumerate(options):
            if j != pick:
                push(phi, top, (word, turn, rest))
        node = options[pick][1]
    head, place, taken, phi = node  # edges of the word so far, a place, edges of it that are used up, log mass up to the place
    p = [0.0 if s in taken else x for s, x in enumerate(probs(place))]
    slot = rng.choices(range(len(p)), p)[0] if sum(p) > 0 else next(s for s in range(len(p)) if s not in taken)
    rest = sum(x for s, x in enumerate(p) if s != slot)
    push(phi + log(rest), top, (word, turn, (head, place, (*taken, slot), phi)))
    edge = int(lat.at[place]) + slot
    head = [*head, edge]
    phi += log(p[slot])
    while place := int(lat.then[edge]):
        p = probs(place)
        slot = rng.choices(range(len(p)), p)[0]
        push(phi + log(sum(x for s, x in enumerate(p) if s != slot)), top, (word, turn, (head, place, (slot,), phi)))
        edge = int(lat.at[place]) + slot
        head = [*head, edge]
        phi += log(p[slot])
    own_log = float(sum(lat.log_p[e] for e in head))
    prefix = (np.append(edges[:at], np.array(head, np.int64)), np.append(counts[:word], len(head)), np.append(log_p[:word], own_log))
    return word + 1, prefix, top


def _ids(pieces: np.ndarray, m: Pieces) -> np.ndarray:
    """Piece ids; an unknown character becomes its UTF-8 bytes' pieces."""
    if not len(pieces) or pieces.min() >= 0:
        return pieces
    out, at = [], 0
    for j in np.flatnonzero(pieces < 0).tolist():
        out.append(pieces[at:j])
        out.append(m.byte_of[list(chr(-1 - int(pieces[j])).encode("utf-8", "surrogatepass"))])
        at = j + 1
    return np.concatenate([*out, pieces[at:]]).astype(np.int32)


def spell(ids: np.ndarray, lens: np.ndarray, m: Pieces, sp: sentencepiece.SentencePieceProcessor) -> pa.Array:
    """The texts of rows of piece ids (end to end, and their numbers).  The texts of plain pieces are taken one after the other, so
    that a row is a stretch of them; the library decodes rows that have other pieces, or begin with more than one blank."""
    ends = np.cumsum(lens)
    full = np.flatnonzero(lens)
    first, some = (ends - lens)[full], lens[full]
    lead = m.lead[ids]
    plain = np.bitwise_or.reduceat(lead == 4, first) == 0 if len(full) else np.zeros(0, bool)
    begins = lead[first]
    if m.prefixed:
        second = np.where(some > 1, lead[np.minimum(first + 1, len(ids) - 1)], 4)
        cut = (begins == 1) | ((begins == 3) & (second == 0))
        plain &= cut | (begins == 0)
    else:
        cut = np.zeros(len(full), bool)
        plain &= begins == 0
    at, spelled = ids.astype(np.int32), m.spelled
    at[first[cut]] += len(m.strings)
    odd = np.flatnonzero(~plain)
    if len(odd):  # these become entries of their own, one for a row
        whole = [sp.decode(ids[first[j]: first[j] + some[j]].tolist(), num_threads=1) for j in odd.tolist()]
        at[first[odd]] = len(spelled) + np.arange(len(odd))
        keep = np.repeat(plain, some)
        keep[first[odd]] = True
        at, spelled, lens = at[keep], pa.concat_arrays([spelled, pa.array(whole, pa.string())]), lens.copy()
        lens[full[odd]] = 1
        ends = np.cumsum(lens)
    taken = spelled.take(pa.array(at))
    _, offsets, data = taken.buffers()
    offsets = np.frombuffer(offsets, np.int32, len(at) + 1) if len(at) else np.zeros(1, np.int32)
    return pa.StringArray.from_buffers(len(lens), pa.py_buffer(offsets[np.append(0, ends)]), data or pa.py_buffer(b""))


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """Keys and texts with about CHARS characters in all."""
    keys, texts, size = [], [], 0
    for b in batches:
        for k, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            keys.append(k)
            texts.append(t or "")
            size += len(texts[-1])
            if size >= CHARS:
                yield keys, texts
                keys, texts, size = [], [], 0
    if keys:
        yield keys, texts


def encode(docs: DataFrame, path: str, k: int = 2, seed: int = 0, alpha: float = 1.0, text: str = "text", key: str = "doc_id",
           verify: bool = False) -> DataFrame:
    """(key, sample int, ids array<int>, log_p double, value double, log_inclusion double): up to ``k`` distinct
    segmentations of every whole text, sampled without replacement, sample 1 with the largest perturbed value first.

    Null and empty texts have the one empty segmentation (log_p 0, log_inclusion 0); a text with fewer than k
    segmentations has one row for each.  Equal keys with equal texts get equal samples; null keys share one seed.  The model is
    read on the driver and broadcast (a few MB, by its number of pieces); other columns are not read.  ``verify`` decodes
    every sample again and adds ``decoded`` string, the text its ids spell, and ``round_trip`` boolean: whether that is the
    text (null texts count as empty)."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(load(path, alpha))
    key_type = to_arrow_type(docs.schema[key].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        sp = sentencepiece.SentencePieceProcessor(model_proto=m.proto)
        for keys, texts in _groups(batches):
            seeds = np.array([xxhash.xxh64_intdigest(str(x), seed) for x in keys], np.uint64)
            found = sample(texts, seeds, k, m, sp)
            rows = [(key, j + 1, *r, i) for i, (key, own) in enumerate(zip(keys, found, strict=True)) for j, r in enumerate(own)]
            del found
            # so many rows that their ids and decoded texts stay small
            upto = np.cumsum([len(r[2]) + len(texts[r[-1]]) * verify for r in rows])
            cuts = np.unique(np.append(np.arange(0, len(rows), 512), np.searchsorted(upto, np.arange(BATCH, upto[-1], BATCH)))).tolist()
            for at, end in zip(cuts, [*cuts[1:], len(rows)], strict=True):
                some = rows[at:end]
                lens = np.array([len(r[2]) for r in some], np.int64)
                ids = np.concatenate([r[2] for r in some])
                decoded = spell(ids, lens, m, sp) if verify else None
                yield pa.RecordBatch.from_arrays([
                    pa.array([r[0] for r in some], key_type), pa.array([r[1] for r in some], pa.int32()),
                    pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(lens)).astype(np.int32)), pa.array(ids)),
                    *(pa.array([r[c] for r in some], pa.float64()) for c in (3, 4, 5)), *([decoded, pc.equal(decoded, pa.array([texts[r[-1]] for r in some], pa.string()))] if verify else [])],
                    names=["key", "sample", "ids", "log_p", "value", "log_inclusion", *["decoded", "round_trip"] * verify])
            del rows
        release()

    kind = docs.schema[key].dataType.simpleString()
    return (docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
            .mapInArrow(run, f"key {kind}, sample int, ids array<int>, log_p double, value double, log_inclusion double" + ", decoded string, round_trip boolean" * verify))


def decode(rows: DataFrame, path: str, ids: str = "ids") -> DataFrame:
    """``rows`` with a column ``decoded``: the text its piece ids spell.  Null ids give a null text."""
    spark = prepare(rows.sparkSession)
    with open(path, "rb") as f:
        shared = spark.sparkContext.broadcast(f.read())
    places = rows.columns.index(ids)
    schema = StructType([*rows.schema.fields, StructField("decoded", StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = sentencepiece.SentencePieceProcessor(model_proto=shared.value)
        for b in batches:
            texts = [None if x is None else sp.decode(x, num_threads=1) if x else "" for x in b.column(places).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(texts, pa.string())], names=[*b.schema.names, "decoded"])

    return rows.mapInArrow(run, schema)
