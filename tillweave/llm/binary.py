"""Packing by power-of-two decomposition: no sequence crosses documents, and none needs padding.

A document of n tokens is cut by the binary digits of n: full pieces of the sequence
length first, then one piece for each set bit of the rest, longest first. Every piece is
a sequence of its own; pieces of equal length form a bucket, in which they are numbered
without gaps, so a batch of any bucket is a dense block of tokens.

Tokenising tasks number the pieces of each bucket as they write them. What a bucket holds
in earlier tasks is added from one row per task and length, so the pieces are neither
sorted nor gathered: a hot document, length or key makes no task longer than its own text.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .tokens import WordTokenizer

SIZE = 2048
COLUMNS = {"doc_id": pa.int64(), "start": pa.int64(), "length": pa.int64(), "ids_crc32": pa.int64(), "doc_tokens": pa.int64(),
           "task": pa.int32(), "nth": pa.int64(), "ids": pa.binary()}
#: Pieces handed over at once.
_ROWS = 20_000


def cuts(n: int, size: int = SIZE) -> list[tuple[int, int]]:
    """(start, length) of the pieces of n tokens: full ones, then the binary digits of the rest."""
    full = n - n % size
    out = [(at, size) for at in range(0, full, size)]
    for bit in range(size.bit_length() - 2, -1, -1):
        if n >> bit & 1:
            out.append((full, 1 << bit))
            full += 1 << bit
    return out


def decompose(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = 1, id_col: str = "doc_id", text_col: str = "text",
              with_ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, start, length (a power of two), ids_crc32, doc_tokens, task, nth (and ids as binary).

    ``end`` is appended to each document. ``nth`` counts the pieces of one length within
    ``task``; both hold only in what one run has written, so the result is to be written
    before it is numbered on. A null text counts as empty: one piece, the end id alone.
    Null and repeated ids are kept, other columns are ignored, an empty table gives no rows.
    """
    if size < 1 or size & (size - 1):
        raise ValueError("the sequence length is a power of two")
    names = list(COLUMNS)[:7 + with_ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, last = WordTokenizer(tokenizer), np.array([end], dtype="<u4").tobytes()
        task, seen = TaskContext.get().partitionId(), [0] * (size.bit_length() + 1)
        rows: list[tuple] = []

        def given() -> pa.RecordBatch:
            cols = list(zip(*rows)) if rows else [[]] * len(COLUMNS)
            return pa.RecordBatch.from_arrays([pa.array(c, COLUMNS[n]) for n, c in zip(names, cols)], names=names)

        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for name, ids in zip(batch.column(0).to_pylist(), words.encode(texts)):
                ids += last
                n = len(ids) // 4
                for start, length in cuts(n, size):
                    piece, bucket = ids[4 * start:4 * (start + length)], length.bit_length()
                    rows.append((name, start, length, zlib.crc32(piece), n, task, seen[bucket], piece))
                    seen[bucket] += 1
                if len(rows) >= _ROWS:
                    yield given()
                    rows.clear()
        yield given()

    schema = ", ".join(f"{n} {'int' if n == 'task' else 'binary' if n == 'ids' else 'long'}" for n in names)
    return docs.select(F.col(id_col).cast("long"), F.col(text_col).cast("string")).mapInArrow(run, schema)


def bucketed(pieces: DataFrame) -> DataFrame:
    """Written pieces with ``slot`` (from 0, gapless within a length), ``sequence_id`` (from 0, gapless, long ones first) and ``offset`` 0.

    Reads length, task and nth. The counts have one row per length and task; only they
    are shuffled and ordered, and Spark chooses how to join them.
    """
    counts = pieces.groupBy("length", "task").agg(F.count("*").alias("n"))
    shorter = F.expr("explode(transform(filter(sequence(0, 62), k -> shiftleft(1L, k) < length), k -> shiftleft(1L, k)))")
    before = counts.groupBy("length").agg(F.sum("n").alias("n")).select(shorter.alias("length"), "n").groupBy("length").agg(
        F.sum("n").alias("base"))  # what longer buckets hold: a row per power of two
    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "task", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("first")).join(
        before, "length", "left").withColumn("base", F.coalesce("base", F.lit(0)))
    return pieces.join(first, ["length", "task"]).withColumn("slot", F.col("first") + F.col("nth")).withColumn(
        "sequence_id", F.col("base") + F.col("slot")).withColumn("offset", F.lit(0).cast("long")).drop("first", "base", "task", "nth")


def pack_documents(docs: DataFrame, tokenizer: str, size: int = SIZE, end: int = 1, id_col: str = "doc_id", text_col: str = "text",
                   with_ids: bool = False) -> DataFrame:
    """``decompose``, written once, and ``bucketed``."""
    return bucketed(materialise(decompose(docs, tokenizer, size, end, id_col, text_col, with_ids), "pieces"))


def batches(placed: DataFrame, tokens: int) -> DataFrame:
    """length, batch, ids: the sequences of one length in blocks of ``tokens`` ids at most, by slot; reads ``ids``.

    A block holds tokens / length sequences, so all full blocks cost a training step the same.
    """
    block = F.floor(F.col("slot") / F.greatest(F.lit(1), F.floor(F.lit(tokens) / F.col("length")))).alias("batch")
    return placed.groupBy("length", block).agg(F.expr("transform(array_sort(collect_list(struct(slot, ids))), x -> x.ids)").alias("ids"))
