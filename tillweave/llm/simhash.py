"""SimHash near-duplicates through an inverted index on byte positions.

A fingerprint has eight bytes. Two fingerprints that differ in at most two bits differ in
at most two bytes. A family of triples of positions covers every pair of positions, so at
least one triple holds all bytes in which two such fingerprints differ. Each fingerprint
is posted once a triple, under its bytes at the other five positions, and meets every
partner in at least one list. There the shared positional bytes of a pair are tallied: the
five of the list and those of the triple that agree. Pairs below the guaranteed minimum
of six (seven for one bit) fall, and the rest is verified by the differing bits. (Lists of
single bytes would hold a 256th of all fingerprints each, and pairs of them would grow
with the square of the corpus.)

Equal fingerprints enter once. A posting list's members differ in three bytes only, so it
holds at most 2**24 of them; short lists are compared pair by pair, long ones by looking
up the neighbours of each member, and give a spanning forest, not all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialise
from .graph import components

#: Longest posting list that is compared pair by pair.
SHORT = 16
#: Hashes whose bits are counted at once.
_BLOCK = 1 << 16


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles, repeats included; 0 without words.

    Words end at ASCII white space and A-Z are lowered. Fewer words than ``width`` make
    one shingle. A bit is set if it is set in over half of the shingles' XXH64.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    spaces = np.flatnonzero(np.frombuffer(line, dtype=np.uint8) == 32)
    starts = np.concatenate([[0], spaces + 1])
    ends = np.concatenate([spaces, [len(line)]])
    last = max(len(words) - width + 1, 1)
    starts, ends = starts[:last], ends[min(width, len(words)) - 1:]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, dtype=np.int64)
    for at in range(0, last, _BLOCK):
        part = [digest(line[s:e], seed) for s, e in zip(starts[at:at + _BLOCK].tolist(), ends[at:at + _BLOCK].tolist())]
        octets = np.array(part, dtype="<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > last, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42) -> DataFrame:
    """(id, fp): one row per document, fp as a signed long."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t, width, seed) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(values, dtype=np.uint64).view(np.int64))],
                                             names=["id", "fp"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string")).mapInArrow(run, f"id {kind}, fp long")


def triples(most: int) -> list[tuple[int, ...]]:
    """Triples of byte positions such that any ``most`` positions lie in one of them: twelve at most."""
    wanted, out = set(combinations(range(8), most)), []
    while wanted:
        out.append(max(combinations(range(8), 3), key=lambda t: len(wanted.intersection(combinations(t, most)))))
        wanted -= set(combinations(out[-1], most))
    return out


def tally(differing: np.ndarray) -> np.ndarray:
    """Shared positional bytes of pairs of fingerprints, from their differing bits."""
    return (differing.view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


def _near(run: np.ndarray, most: int) -> list[np.ndarray]:
    """(member, partner) of a long posting list: all members linked to some other, as a forest.

    A neighbour within ``most`` bits has the guaranteed number of bytes in common by itself.
    """
    run = np.sort(run)
    differing = int(np.bitwise_or.reduce(run ^ run[0]))
    bits = [1 << b for b in range(64) if (differing >> b) & 1]
    flips = [sum(c) for n in range(1, most + 1) for c in combinations(bits, n)]
    label = np.arange(len(run))
    while True:
        before = label.copy()
        for flip in flips:
            other = run ^ np.uint64(flip)
            at = np.minimum(np.searchsorted(run, other), len(run) - 1)
            linked = run[at] == other
            label[linked] = np.minimum(label[linked], label[at[linked]])
        label = label[label]
        if (label == before).all():
            moved = label != np.arange(len(run))
            return [run[moved], run[label[moved]]]


def links(prints: DataFrame, most: int = 2) -> DataFrame:
    """(a, b): links between different fingerprints ``fp`` that connect all pairs within ``most`` bits."""
    if most not in (1, 2):
        raise ValueError("one or two differing bits")
    masks = [sum(255 << (8 * p) for p in range(8) if p not in free) for free in triples(most)]
    signed = [int(np.uint64(m).view(np.int64)) for m in masks]
    choice = np.array(masks, dtype=np.uint64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        carry = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64))
        for batch in (*batches, None):
            which, fp = carry
            if batch is not None:
                which = np.concatenate([which, batch.column(0).to_numpy()])
                fp = np.concatenate([fp, batch.column(1).to_numpy().view(np.uint64)])
            if not len(fp):
                continue
            key = fp & choice[which]
            new = np.concatenate([[True], (which[1:] != which[:-1]) | (key[1:] != key[:-1])])
            starts = np.flatnonzero(new)
            stop = len(fp) if batch is None else starts[-1]  # the last list may go on
            carry = (which[stop:], fp[stop:])
            fp, starts = fp[:stop], starts[starts < stop]
            sizes = np.diff(np.append(starts, stop))
            found: list[list[np.ndarray]] = []
            short = np.repeat(sizes <= SHORT, sizes)
            place = np.arange(stop) - np.repeat(starts, sizes)
            room = np.repeat(sizes, sizes) - place
            for lag in range(1, int(min(sizes.max(initial=0), SHORT))):
                a = np.flatnonzero(short & (room > lag))
                x = fp[a] ^ fp[a + lag]
                enough = tally(x) >= 8 - most
                a, x = a[enough], x[enough]
                near = np.bitwise_count(x) <= most
                found.append([fp[a[near]], fp[a[near] + lag]])
            found += [_near(fp[s:s + n], most) for s, n in zip(starts[sizes > SHORT], sizes[sizes > SHORT])]
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    postings = prints.select(F.posexplode(F.array(*[F.lit(m) for m in signed])).alias("which", "mask"), "fp").select("which", "fp", (
        F.col("fp").bitwiseAND(F.col("mask"))).alias("key"))
    lists = postings.repartition("which", "key").sortWithinPartitions("which", "key").select(F.col("which").cast("long"), "fp")
    return lists.mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42,
                    most: int = 2) -> DataFrame:
    """id, fingerprint (16 hex digits), component_id (smallest id reachable, itself included) per row.

    Null and wordless texts have fingerprint zero and are linked like any other. Rows
    with equal ids share a row's fate through their own texts; null ids never name a
    component unless all its ids are null. Other columns are ignored; an empty table
    gives no rows.
    """
    prints = materialise(fingerprints(docs, id_col, text_col, width, seed), "fingerprints")
    first = prints.groupBy("fp").agg(F.min("id").alias("first"))
    root = components(links(first.select("fp"), most)).withColumnRenamed("node", "fp")
    named = first.join(root, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = named.groupBy("root").agg(F.min("first").alias("component_id"))
    table = materialise(named.join(least, "root").select("fp", "component_id"), "classes")
    return prints.join(table, "fp").select(F.col("id").alias(id_col), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, seed: int = 42, most: int = 2) -> DataFrame:
    """Exactly one row of each component of ``near_duplicates``, all columns: one of the smallest id, null ids last.

    Rows are decided one by one, also where they repeat or lack an id. Of rows with one id
    the one of the smallest text hash stays; rows equal in id and text are one key, of
    which any one row stays. They are reduced where they are read, before any shuffle.
    Other columns may have any name and type; an empty table gives no rows.
    """
    text = F.col(text_col).cast("string")
    hashes = {"h1": F.xxhash64(text), "h2": F.xxhash64(F.lit("text"), text)}
    key = F.struct(F.col(id_col).isNull().alias("none"), F.col(id_col).alias("id"), *(h.alias(c) for c, h in hashes.items()))
    found = near_duplicates(docs.select(key.alias("key"), text.alias("text")), "key", "text", width, seed, most)
    kept = found.where(F.col("key").eqNullSafe(F.col("component_id"))).select("key.*").distinct().toDF("none", "kept_id", "k1", "k2")
    rows = docs.select(F.col(id_col).alias("id"), *(h.alias(c) for c, h in hashes.items()), F.struct(*(docs[c] for c in docs.columns)).alias("row"))
    same = rows["id"].eqNullSafe(kept["kept_id"]) & (rows["h1"] == kept["k1"]) & (rows["h2"] == kept["k2"])
    return rows.dropDuplicates(["id", "h1", "h2"]).join(kept, same, "left_semi").select("row.*")
