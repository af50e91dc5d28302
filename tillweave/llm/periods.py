"""Periodic runs of words by internal pattern matching.

A run is a stretch of words with smallest period q that is at least three periods long.
The words of many texts are laid out in one line, with marks between them that equal
nothing. For each power of two B, the line is cut into blocks of B words; a run with
B <= q < 2 B (B = 8: any q < 16) holds a whole block and its copy q words on. Where a
block occurs in that neighbouring window is asked of the suffix array: the block's rows
are an interval, and a wavelet matrix over the array's places gives the next place in a
window (range successor). Occurrences in a window no longer than the block form one
arithmetic progression, whose difference is the block's own period p; one or two of them
are candidate periods as they are, and of more only the first and the two that map the stretch
with period p around the block onto that around its copies, start to start or end to end.

Candidates are extended both ways with the ranks of all blocks of 2^k words that the
suffix sorting leaves behind. What reaches the wanted length is a run; multiples of its
period give the same stretch and fall.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .fmindex import Bits

SHORTEST = 24
#: Words whose runs are searched together.
AT_ONCE = 1 << 18
_SMALL = 8
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
Rewrite = Callable[[object, list[bytes]], list[bytes]]


class Places:
    """A wavelet matrix over the places of a suffix array: counts and selections in intervals of rows, many at once."""

    def __init__(self, places: np.ndarray):
        self.levels: list[tuple[int, Bits, int]] = []
        for shift in range(max(len(places) - 1, 1).bit_length() - 1, -1, -1):
            bit = ((places >> shift) & 1).astype(bool)
            self.levels.append((shift, Bits(bit), int(len(bit) - bit.sum())))
            places = np.concatenate([places[~bit], places[bit]])

    def below(self, low: np.ndarray, high: np.ndarray, value: np.ndarray) -> np.ndarray:
        """How many places in rows low to high are below each value."""
        low, high, out = low.copy(), high.copy(), np.zeros(len(low), dtype=np.int64)
        for shift, bits, zeros in self.levels:
            a, b = bits.rank(low), bits.rank(high)
            one = (value >> shift) & 1 == 1
            out += np.where(one, (high - b) - (low - a), 0)
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return out

    def smallest(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        """The place with ``nth`` smaller ones in rows low to high."""
        low, high, nth, out = low.copy(), high.copy(), nth.copy(), np.zeros(len(low), dtype=np.int64)
        for shift, bits, zeros in self.levels:
            a, b = bits.rank(low), bits.rank(high)
            none = (high - b) - (low - a)
            one = nth >= none
            nth -= np.where(one, none, 0)
            out += one.astype(np.int64) << shift
            low, high = np.where(one, zeros + a, low - a), np.where(one, zeros + b, high - b)
        return out


class Line:
    """Suffix array of a line of symbols, with the rank of each block of 2^k symbols among all of that length."""

    def __init__(self, symbols: np.ndarray, deepest: int):
        """``deepest``: no block longer than this is asked for."""
        n = self.n = len(symbols)
        self.order = np.argsort(symbols, kind="stable")
        ordered = symbols[self.order]
        new = np.concatenate([[True], ordered[1:] != ordered[:-1]]) if n else np.zeros(0, dtype=bool)
        first = np.flatnonzero(new)
        self.size = np.ones(n, dtype=np.int64)  # of the class that begins at a row
        self.size[first] = np.diff(np.append(first, n))
        rank = np.empty(n, dtype=np.int64)
        rank[self.order] = first[np.cumsum(new) - 1]
        self.ranks, self.sizes = [rank], [self.size]
        width = 1
        while 2 * width <= deepest:
            rank, size = self.ranks[-1].copy(), self.sizes[-1].copy()
            rows = np.flatnonzero(size[rank[self.order]] > 1)  # classes of one are settled
            if not len(rows):
                break
            at = self.order[rows]
            after = np.where(at + width < n, self.ranks[-1][np.minimum(at + width, n - 1)], -1)
            resort = np.lexsort((after, self.ranks[-1][at]))
            at, after = at[resort], after[resort]
            self.order[rows] = at
            old = self.ranks[-1][at]
            new = np.concatenate([[True], (old[1:] != old[:-1]) | (after[1:] != after[:-1])])
            starts = np.flatnonzero(new)
            rank[at] = rows[starts][np.cumsum(new) - 1]
            size[rows] = 1
            size[rows[starts]] = np.diff(np.append(starts, len(rows)))
            self.ranks.append(rank)
            self.sizes.append(size)
            width *= 2

    def right(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols from a on equal those from b on (a < b)."""
        a, b = a.copy(), b.copy()
        began = a.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            active = np.arange(len(a))
            while len(active):
                active = active[b[active] + (1 << k) <= self.n]
                active = active[self.ranks[k][a[active]] == self.ranks[k][b[active]]]
                a[active] += 1 << k
                b[active] += 1 << k
                if k < len(self.ranks) - 1:
                    break  # only the longest blocks match more than once
        return a - began

    def left(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How many symbols before a equal those before b (a < b)."""
        a, b = a.copy(), b.copy()
        began = a.copy()
        for k in range(len(self.ranks) - 1, -1, -1):
            active = np.arange(len(a))
            while len(active):
                active = active[a[active] >= 1 << k]
                active = active[self.ranks[k][a[active] - (1 << k)] == self.ranks[k][b[active] - (1 << k)]]
                a[active] -= 1 << k
                b[active] -= 1 << k
                if k < len(self.ranks) - 1:
                    break
        return began - a


def candidates(line: Line, places: Places, width: int, level: int, near: int, far: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, period): blocks of ``width`` = 2^level words and how far on they may recur, from ``near`` to before ``far``."""
    at = np.arange(0, line.n - width + 1, width)
    low = line.ranks[level][at]
    high = low + line.sizes[level][low]
    some = high - low > 1
    at, low, high = at[some], low[some], high[some]
    skipped = places.below(low, high, np.minimum(at + near, line.n - 1))
    found = places.below(low, high, np.minimum(at + far, line.n - 1)) - skipped
    some = found > 0
    at, low, high, skipped, found = at[some], low[some], high[some], skipped[some], found[some]
    first = places.smallest(low, high, skipped)
    more = found > 1
    second = places.smallest(low[more], high[more], skipped[more] + 1)
    few = found[more] == 2
    out = [(at, first - at), (at[more][few], (second - at[more])[few])]
    # a progression: its difference is the block's period
    x, y, p = at[more][~few], first[more][~few], (second - first[more])[~few]
    if len(x):
        start = [v - line.left(v, v + p) for v in (x, y)]
        stop = [v + p + line.right(v, v + p) for v in (x, y)]
        for a, b in (start, stop):
            kept = b > a
            out.append((x[kept], (b - a)[kept]))
    return tuple(np.concatenate(c) for c in zip(*out))


def runs_of(symbols: np.ndarray, longest: int, shortest: int = SHORTEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of a line, by start and period; no run is longer than ``longest``."""
    line = Line(symbols, max(longest // 3, _SMALL))
    places, found = Places(line.order), []
    level = _SMALL.bit_length() - 1
    while level < len(line.ranks):
        width = 1 << level
        for near, far in ((1, width), (width, 2 * width)) if width == _SMALL else ((width, 2 * width),):
            at, q = candidates(line, places, width, level, near, far)
            pair = np.unique(at * (line.n + 1) + q)
            at, q = pair // (line.n + 1), pair % (line.n + 1)
            inside = at + q < line.n
            at, q = at[inside], q[inside]
            start = at - line.left(at, at + q)
            stop = at + q + line.right(at, at + q)
            long = stop - start >= np.maximum(shortest, 3 * q)
            found.append(np.stack([start[long], stop[long], q[long]]))
        level += 1
    start, stop, q = np.concatenate(found, axis=1) if found else np.zeros((3, 0), dtype=np.int64)
    order = np.lexsort((q, stop, start))  # of one stretch the smallest period counts
    start, stop, q = start[order], stop[order], q[order]
    kept = np.ones(len(q), dtype=bool)
    kept[1:] = (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    start, stop, q = start[kept], stop[kept], q[kept]
    order = np.lexsort((q, start))
    return start[order], (stop - start)[order], q[order]


def recurring(symbols: np.ndarray, of: np.ndarray, width: int = _SMALL) -> np.ndarray:
    """The texts in which some window of ``width`` words may recur, by hashes: the others hold no run. ``of``: each word's text, ascending."""
    if len(symbols) <= width:
        return np.zeros(0, dtype=np.int64)
    h = (symbols.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    step = 1
    while step < width:
        h = h[:-step] + np.uint64(pow(0x94D049BB133111EB, step, 1 << 64)) * h[step:]
        step *= 2
    whole = of[:len(h)] == of[width - 1:]
    h = (h ^ (of[:len(h)].astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)))[whole]
    own = of[:len(whole)][whole]
    order = np.argsort(h)
    h = h[order]
    return np.unique(own[order[1:][h[1:] == h[:-1]]])


def _search(texts: list[list[bytes]], shortest: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The runs of each text."""
    none = tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    out = [none] * len(texts)
    numbers: defaultdict[bytes, int] = defaultdict(count().__next__)
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    symbols = np.fromiter((numbers[w] for t in texts for w in t), np.int64, int(sizes.sum()))
    ends = np.cumsum(sizes)
    chosen = recurring(symbols, np.repeat(np.arange(len(texts)), sizes))
    chosen = chosen[sizes[chosen] >= shortest]
    if not len(chosen):
        return out
    parts, begins, at = [], [], 0
    for mark, k in enumerate(chosen.tolist(), len(numbers)):
        parts += [symbols[ends[k] - sizes[k]:ends[k]], [mark]]
        begins.append(at)
        at += int(sizes[k]) + 1
    start, length, q = runs_of(np.concatenate(parts), int(sizes[chosen].max()), shortest)
    cut = np.searchsorted(start, [*begins, at])
    for k, begin, a, b in zip(chosen.tolist(), begins, cut, cut[1:]):
        out[k] = (start[a:b] - begin, length[a:b], q[a:b])
    return out


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shortest: int = SHORTEST, rewrite: Rewrite | None = None) -> DataFrame:
    """id, n_words, runs (start, length, period by start and period), collapsed: the text without what repeats in a run.

    Words end at ASCII white space. A run is a stretch with smallest period q of at
    least max(shortest, 3 q) words that no neighbouring word extends; shortest is 24 or
    more. ``collapsed`` holds, joined by one space, the words that no run contains after
    its first q words. ``rewrite`` may change a text's words first; it gets the id.

    Nothing is shuffled: texts are read some 260,000 words at a time, and memory grows
    with the longest text. A null text has no words; null and repeated ids are kept, other
    columns are ignored, an empty table gives no rows.
    """
    if shortest < SHORTEST:
        raise ValueError("blocks of eight words find runs of 24 words and more")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, begin, size = [], 0, 0
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                texts.append(rewrite(name, words) if rewrite else words)
                size += len(words)
                if size >= AT_ONCE:
                    yield given(batch.column(0).slice(begin, len(texts)), texts)
                    texts, begin, size = [], begin + len(texts), 0
            yield given(batch.column(0).slice(begin), texts)

    def given(names: pa.Array, texts: list[list[bytes]]) -> pa.RecordBatch:
        runs, lists, kept = _search(texts, shortest), [], []
        for words, (start, length, q) in zip(texts, runs):
            lists.append([{"start": a, "length": b, "period": c} for a, b, c in zip(start.tolist(), length.tolist(), q.tolist())])
            if len(start):
                change = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(change, start + q, 1)
                np.add.at(change, start + length, -1)
                words = [words[k] for k in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]
            kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
        return pa.RecordBatch.from_arrays([names, pa.array([len(t) for t in texts], pa.int64()), pa.array(lists, pa.list_(_RUN)), pa.array(kept, pa.string())],
                                          names=["id", "n_words", "runs", "collapsed"])

    kind = docs.schema[id_col].dataType.simpleString()
    found = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(
        run, f"id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")
    return found.withColumnRenamed("id", id_col)
