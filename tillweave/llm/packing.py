"""Best-fit packing of token sequences with exact complements.

Documents longer than a sequence are cut into full pieces and one rest. Packing works
on the histogram of piece lengths, whose size is the sequence length and not the data:
lengths are matched with single, pair and triple sums that fill the gap exactly, as
often as their counts allow; what is left goes, longest first, into the fullest open
sequence that still takes it. The result says which ranks of a length go to which
sequences and at which offset; ranks come from a window salted against hot lengths.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .tokens import WordTokenizer

SIZE = 2048
#: Parts in which the rows of one length are ranked, each on its own.
SALTS = 64
#: Ranks a length may have, as a shift in the interval keys.
_RANKS = 50
PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = 0, id_col: str = "doc_id", text_col: str = "text",
        with_ids: bool = False) -> DataFrame:
    """Pieces of the documents' ids, ``end`` appended: doc_id, piece, start, length, ids_crc32 (and ids as binary).

    A null text counts as empty: one piece with the end id alone.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = WordTokenizer(tokenizer), np.array([end], dtype="<u4").tobytes()
        for batch in batches:
            names = batch.column(0).to_pylist()
            rows: list[tuple] = []
            for name, ids in zip(names, words.encode([t or "" for t in batch.column(1).to_pylist()])):
                ids += last
                for k, at in enumerate(range(0, len(ids), 4 * size)):
                    piece = ids[at:at + 4 * size]
                    rows.append((name, k, at // 4, len(piece) // 4, zlib.crc32(piece), piece))
            cols = list(zip(*rows)) if rows else [[]] * 6
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()][:5 + with_ids]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32", "ids"][:5 + with_ids])

    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, PIECES + ", ids binary" * with_ids)


def plan(histogram: np.ndarray, size: int = SIZE) -> list[tuple[int, int, int, int, int]]:
    """(length, first rank, count, first sequence, offset) for counts by length, ``histogram[length]``."""
    have = [int(n) for n in histogram] + [0] * (size + 1 - len(histogram))
    used, out, sequences = [0] * (size + 1), [], 0

    def emit(lengths: tuple[int, ...], times: int) -> None:
        nonlocal sequences
        offset = 0
        for length in lengths:
            out.append((length, used[length], times, sequences, offset))
            used[length] += times
            offset += length
        sequences += times

    def times(lengths: tuple[int, ...]) -> int:
        return min(have[x] // lengths.count(x) for x in lengths)

    def fill(lengths: tuple[int, ...]) -> bool:
        n = times(lengths)
        if n:
            for x in lengths:
                have[x] -= n
            emit(lengths, n)
        return bool(n)

    fill((size,))
    for a in range(size - 1, 0, -1):  # one more piece fills the gap
        if have[a] and 2 * a >= size:
            fill((a, size - a))
    for a in range(size - 1, 0, -1):  # two more
        gap = size - a
        for b in range(min(a, gap - 1), (gap - 1) // 2, -1):
            if not have[a]:
                break
            if have[b] and have[gap - b]:
                fill((a, b, gap - b))
    for a in range(size - 1, 0, -1):  # three more
        gap = size - a
        for b in range(min(a, gap - 2), 0, -1):
            if not have[a]:
                break
            if have[b]:
                rest = gap - b
                for c in range(min(b, rest - 1), (rest - 1) // 2, -1):
                    if have[c] and have[rest - c] and fill((a, b, c, rest - c)) and not (have[a] and have[b]):
                        break
    open_: dict[int, list[tuple[tuple[int, ...], int]]] = {}
    gaps: list[int] = []

    def keep(gap: int, lengths: tuple[int, ...], n: int) -> None:
        if gap not in open_:
            bisect.insort(gaps, gap)
            open_[gap] = []
        open_[gap].append((lengths, n))

    closed: list[tuple[tuple[int, ...], int]] = []
    for a in range(size, 0, -1):  # best fit, longest first
        left, have[a] = have[a], 0
        while left:
            at = bisect.bisect_left(gaps, a)
            if at == len(gaps):
                per = size // a
                if left >= per:
                    lengths, n = (a,) * per, left // per
                else:
                    lengths, n = (a,) * left, 1
                left -= n * len(lengths)
                keep(size - a * len(lengths), lengths, n)
                continue
            gap = gaps[at]
            lengths, n = open_[gap].pop()
            if not open_[gap]:
                del open_[gap], gaps[at]
            per = min(gap // a, left)
            fit = min(n, left // per)
            left -= fit * per
            if n > fit:
                keep(gap, lengths, n - fit)
            keep(gap - a * per, (*lengths, *(a,) * per), fit)
    closed += [x for group in open_.values() for x in group]
    for lengths, n in closed:
        emit(lengths, n)
    return out


def pack(pieces: DataFrame, size: int = SIZE, salts: int = SALTS) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; at most ``size`` tokens a sequence, no gaps.

    Reads ``length`` (1 to size), and doc_id, piece, ids_crc32 for a stable order; equal
    rows are interchangeable, null ids sort first. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)).cast("int"))
    counts = np.zeros((size + 1, salts), dtype=np.int64)  # the histogram: size x salts numbers, whatever the data
    for r in salted.groupBy("length", "salt").count().collect():
        counts[r["length"], r["salt"]] = r["count"]
    before = spark.sparkContext.broadcast(np.cumsum(counts, axis=1) - counts)
    rows = sorted(plan(counts.sum(axis=1), size))
    table = spark.sparkContext.broadcast(np.array(rows, dtype=np.int64).reshape(-1, 5))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = salted.withColumn("rank", F.row_number().over(order).cast("long") - 1)

    def place(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        t = table.value
        keys = (t[:, 0] << _RANKS) + t[:, 1]
        for f in frames:
            length = f["length"].to_numpy()
            rank = f.pop("rank").to_numpy() + before.value[length, f.pop("salt").to_numpy()]
            at = np.searchsorted(keys, (length << _RANKS) + rank, side="right") - 1
            f["sequence_id"] = t[at, 3] + rank - t[at, 1]
            f["offset"] = t[at, 4]
            yield f

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema.fields)
    return ranked.mapInPandas(place, schema + ", sequence_id long, offset long")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``cut`` and ``pack``; the pieces are written once, so no text is tokenised twice."""
    return pack(materialise(cut(docs, tokenizer, size, end, id_col, text_col), "pieces"), size)


def sequences(placed: DataFrame) -> DataFrame:
    """sequence_id, ids (binary, at most one sequence long) from placed pieces that carry ``ids``."""
    return placed.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")).select(
        "sequence_id", F.expr("aggregate(transform(parts, p -> p.ids), cast('' as binary), (a, x) -> concat(a, x))").alias("ids"))
