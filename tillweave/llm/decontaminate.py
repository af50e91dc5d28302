"""Benchmark decontamination by pigeonhole pieces and Myers' bit-parallel distance.

Texts and items are lowered and reduced to their words. An item of m characters may differ
by k = rate * m edits; cut into k + 1 pieces, at least one piece of any such occurrence is
untouched. One pass over the documents finds all exact piece hits with an automaton; the
windows around them are verified with Myers' algorithm, which lets the match start anywhere.
Items are a stated query set: they are taken in blocks of bounded size, one pass a block,
and only a block is ever broadcast.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from .steps import Steps

#: Edits an occurrence may have, as a share of the item's characters.
RATE = 0.05
#: Items with fewer characters than this are found as they are only, on word bounds; the stage doesn't search them, as they are too common to tell a leak.
LEAST = 25
#: Characters of benchmark items in one pass, at most (one longer item is a pass of its own).
BLOCK = 4_000_000
_WORD = re.compile(r"\w+")


def words(text: str | None) -> str:
    return " ".join(_WORD.findall((text or "").lower()))


class Pattern:
    """One item's bit vectors, forward and backward."""

    def __init__(self, text: str, rate: float):
        self.text, self.short = text, len(text) < LEAST
        self.budget = 0 if self.short else int(rate * len(text))
        self.masks = [self._masks(text), self._masks(text[::-1])]

    @staticmethod
    def _masks(text: str) -> dict[str, int]:
        out: dict[str, int] = defaultdict(int)
        for k, c in enumerate(text):
            out[c] |= 1 << k
        return dict(out)

    def pieces(self) -> list[tuple[int, str]]:
        n, m = self.budget + 1, len(self.text)
        cuts = [m * k // n for k in range(n + 1)]
        return [(a, self.text[a:b]) for a, b in zip(cuts, cuts[1:])]

    def ends(self, text: str, backward: bool = False) -> tuple[int, int]:
        """(least distance, first end) of an occurrence that starts anywhere in ``text``."""
        masks, m = self.masks[backward], len(self.text)
        full, top = (1 << m) - 1, 1 << (m - 1)
        pv, mv, score, best, at = full, 0, m, m, 0
        for j, c in enumerate(text, 1):
            eq = masks.get(c, 0)
            xv, xh = eq | mv, (((eq & pv) + pv) ^ pv) | eq
            ph, mh = (mv | ~(xh | pv)) & full, pv & xh
            if ph & top:
                score += 1
            elif mh & top:
                score -= 1
            ph, mh = (ph << 1) & full, (mh << 1) & full
            pv, mv = (mh | ~(xv | ph)) & full, ph & xv
            if score < best:
                best, at = score, j
        return best, at

    def find(self, text: str, start: int, end: int) -> tuple[int, int, int] | None:
        """(distance, start, end) of the best occurrence within text[start:end] and the budget."""
        if self.short:
            whole = (not start or text[start - 1] == " ") and text[end:end + 1] in ("", " ")
            return (0, start, end) if whole else None
        exact = text.find(self.text, start, end)
        if exact >= 0:
            return 0, exact, exact + len(self.text)
        best, stop = self.ends(text[start:end])
        if best > self.budget:
            return None
        _, back = self.ends(text[start:start + stop][::-1], backward=True)
        return best, start + stop - back, start + stop


class Index:
    """All pieces of a block of items in one automaton."""

    def __init__(self, items: list[tuple[int, str]], rate: float):
        self.patterns = [(number, Pattern(text, rate)) for number, text in items]
        places: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for k, (_, pattern) in enumerate(self.patterns):
            for offset, piece in pattern.pieces():
                places[piece].append((k, offset))
        self.automaton = ahocorasick.Automaton()
        for piece, where in places.items():
            self.automaton.add_word(piece, (len(piece), where))
        self.automaton.make_automaton()

    def search(self, text: str) -> list[tuple[int, int, int, int, int]]:
        """(item, distance, budget, start, end) for every item with an occurrence, the best one each."""
        near: dict[int, list[int]] = defaultdict(list)
        for last, (length, where) in self.automaton.iter(text):
            for k, offset in where:
                near[k].append(last - length + 1 - offset)
        out = []
        for k, starts in near.items():
            number, pattern = self.patterns[k]
            slack, best = pattern.budget, None
            starts.sort()
            if pattern.short:
                found = (pattern.find(text, s, s + len(pattern.text)) for s in starts)
                if (best := next(filter(None, found), None)):
                    out.append((number, best[0], 0, best[1], best[2]))
                continue
            low = high = None
            for s in (*starts, None):
                if low is not None and (s is None or s - slack > high):
                    found = pattern.find(text, max(low, 0), high)
                    best = min(filter(None, (best, found)), default=None)
                    low = None
                if s is not None:
                    low = s - slack if low is None else low
                    high = s + len(pattern.text) + slack
            if best:
                out.append((number, best[0], pattern.budget, best[1], best[2]))
        return out


def blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", least: int = 1, size: int = BLOCK) -> Iterator[list[tuple[int, str]]]:
    """The items' ids and words in blocks of at most ``size`` characters; those with fewer than ``least`` are left out."""
    block, held = [], 0
    for row in items.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).toLocalIterator():
        text = words(row["text"])
        if len(text) < least:
            continue
        if block and held + len(text) > size:
            yield block
            block, held = [], 0
        block.append((row["id"], text))
        held += len(text)
    if block:
        yield block


MATCH = "item_id long, distance int, budget int, start long, end long"


def _pass(docs: DataFrame, shared: Broadcast, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*shared.value)
        for batch in batches:
            rows, at = [], []
            for k, text in enumerate(batch.column(1).to_pylist()):
                for match in index.search(words(text)):
                    rows.append(match)
                    at.append(k)
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *[pa.array(c, t) for c, t in zip(zip(*rows), kinds)]],
                                                 names=["doc_id", "item_id", "distance", "budget", "start", "end"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string")).mapInArrow(run, f"doc_id {kind}, {MATCH}")


def _one_by_one(items: Iterator[list[tuple[int, str]]], spark: SparkSession, rate: float) -> Iterator[tuple[Broadcast, bool]]:
    """Each block as a broadcast, and whether it is the only one; a block is released before the next one is sent."""
    block = next(items, None)
    first = True
    while block is not None:
        shared = spark.sparkContext.broadcast((block, rate))
        block = next(items, None)
        yield shared, first and block is None
        if not (first and block is None):
            shared.destroy()
        first = False


def contaminated(docs: DataFrame, items: DataFrame, rate: float = RATE, id_col: str = "doc_id", text_col: str = "text",
                 least: int = 1, size: int = BLOCK) -> DataFrame:
    """doc_id, item_id, distance, budget, start, end: the best occurrence of each item in each document row.

    Spans count characters of the reduced text (``words``). Items of fewer than ``LEAST``
    characters are found without edits, on word bounds. Null and empty texts and items
    match nothing; null ids stay null; repeated rows and items repeat their matches, extra
    columns are ignored. Several blocks are searched one after another, each result written.
    """
    found = None
    for shared, only in _one_by_one(blocks(items, least=least, size=size), docs.sparkSession, rate):
        part = _pass(docs, shared, id_col, text_col)
        part = part if only else materialise(part, "matches")
        found = part if found is None else found.unionByName(part)
    if found is None:
        return docs.sparkSession.createDataFrame([], f"doc_id {docs.schema[id_col].dataType.simpleString()}, {MATCH}")
    return found


def without_leaks(docs: DataFrame, items: DataFrame, rate: float = RATE, text_col: str = "text", least: int = LEAST, size: int = BLOCK) -> DataFrame:
    """The rows in which no item of at least ``least`` characters occurs, unchanged; no shuffle.

    Several blocks of items are searched one after another, and what each leaves is written.
    """
    steps, before = Steps(docs.sparkSession), ()
    for shared, only in _one_by_one(blocks(items, least=least, size=size), docs.sparkSession, rate):
        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(*shared.value)
            for batch in batches:
                column = batch.column(batch.schema.get_field_index(text_col))
                yield batch.filter(pa.array([not index.search(words(t)) for t in column.to_pylist()], pa.bool_()))

        docs = docs.mapInArrow(run, docs.schema)
        if not only:
            docs = steps.write(docs, "clean", before)
            before = (docs,)
    return docs
