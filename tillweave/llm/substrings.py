"""Repeated passages: a compressed FM-index per shard, matched against the documents that can share text.

A window of consecutive words is repeated if its words also start earlier. Streaming every
document through the index of every shard would take time with the square of the corpus,
so shards are cut by content: each window has an anchor (the run of words in it with the
least hash), equal windows have equal anchors, and a document is a row of segments, runs of
windows with one anchor. Only segments whose anchor occurs twice can hold repeats.

1. Count the anchors of all documents; keep the segments with repeated ones, with a digest.
2. Equal segments become one class, its first occurrence stands for it; in all others every
   window is repeated.
3. Classes that share an anchor get their words and go to one shard. A shard is concatenated, indexed, and its
   segments are streamed through by backward search over the wavelet matrix; the rows that
   match over the whole window tell where it starts first, and later ones are reported.
   An anchor with very many classes would overfill a shard: its classes are cut into
   windows, which go through step 2 on their own, pre-aggregated, whatever their number.
4. Reported intervals go back to their documents.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .anchors import bounds, line_of, segments
from .fmindex import FMIndex
from .steps import Steps

WINDOW = 20
#: Words of an anchor.
WIDTH = 6
#: Words of a shard at which it is closed, and classes of an anchor beyond which they are cut into windows.
SHARD, CLASSES = 120_000, 1000
_LOW = -(1 << 63)
#: What names a row.
ROW = ["doc", "tell", "tell2"]


def _digest(piece: bytes) -> tuple[int, int]:
    return tuple(np.frombuffer(hashlib.blake2b(piece, digest_size=16).digest(), dtype="<i8").tolist())


def _told(rows: DataFrame, text_col: str) -> DataFrame:
    """The rows with the 128 bits (tell, tell2) that tell rows with equal ids apart: MD5 of the text, a null one like an empty one."""
    digest = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    return rows.withColumns({name: F.conv(F.substring(digest, at, 16), 16, -10).cast("long") for name, at in (("tell", 1), ("tell2", 17))})


def _rows(docs: DataFrame, id_col: str, text_col: str, steps: Steps) -> DataFrame:
    """(doc, tell, tell2, text): rows equal in id and text once."""
    told = _told(docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_LOW)).alias("doc"), F.col(text_col).cast("string").alias("text")), "text")
    # mostly a small table, so that the texts of all other rows need not move
    often = steps.write(told.groupBy(*ROW).count().where("count > 1").select(*ROW), "often")
    repeated = told.join(often, ROW, "left_semi").groupBy(*ROW).agg(F.first("text").alias("text"))
    return told.join(often, ROW, "left_anti").unionByName(repeated)


def _anchors(rows: DataFrame, window: int, width: int, whole: bool) -> DataFrame:
    """(anchor) or (anchor, doc, tell, tell2, at, n) of all segments of all documents."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            for text, *row in zip(*(c.to_pylist() for c in batch.columns)):
                anchor, at, n = segments(line_of(text), window, width)
                held.append((anchor, *(np.full(len(at), x) for x in row), at, n) if whole else (anchor,))
                size += len(at)
                if size > 100_000:
                    yield out(held)
                    held, size = [], 0
            if size:
                yield out(held)

    def out(held: list[tuple]) -> pa.RecordBatch:
        cols = [np.concatenate(x) for x in zip(*held)]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["anchor", *ROW, "at", "n"] if whole else ["anchor"])

    return rows.select("text", *(ROW if whole else [])).mapInArrow(
        run, "anchor long, doc long, tell long, tell2 long, at long, n long" if whole else "anchor long")


def candidates(rows: DataFrame, window: int, width: int, steps: Steps) -> DataFrame:
    """Segments whose anchor occurs at least twice, with a digest of their words; written."""
    repeated = steps.write(_anchors(rows, window, width, False).groupBy("anchor").count().where("count > 1").select("anchor"), "anchors")
    kept = _anchors(rows, window, width, True).join(repeated, "anchor", "left_semi")
    lists = steps.write(kept.groupBy(*ROW).agg(F.collect_list(F.struct("anchor", "at", "n")).alias("found")), "segments", (repeated,))

    found = _pieces(rows, lists, window, "anchor long, at long, n long, h1 long, h2 long, doc long, tell long, tell2 long", lambda piece: _digest(piece))
    return steps.write(found, "candidates", (lists,))


def _pieces(rows: DataFrame, lists: DataFrame, window: int, schema: str, make: Callable[[bytes], tuple]) -> DataFrame:
    """What ``make`` gives for the words of each listed segment, between the list's fields and the row's name."""
    names = [x.split()[0] for x in schema.split(", ")]
    kinds = [pa.binary() if x.endswith("binary") else pa.int64() for x in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held: list[tuple] = []
            for text, found, *row in zip(*(c.to_pylist() for c in batch.columns)):
                line = line_of(text)
                starts, ends = (x.tolist() for x in bounds(line))
                held += [(*f.values(), *make(line[starts[f["at"]]:ends[f["at"] + f["n"] + window - 2]]), *row) for f in found]
                if len(held) > 20_000:
                    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)
                    held = []
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held), kinds)], names=names)

    return rows.join(lists, ROW).select("text", "found", *ROW).mapInArrow(run, schema)


def _later(found: DataFrame, keys: list[str], classes: DataFrame) -> DataFrame:
    """Occurrences that are not their class's first: every window of theirs is repeated."""
    first = classes.select(*keys, F.col("first.doc").alias("d"), F.col("first.tell").alias("t"), F.col("first.tell2").alias("t2"), F.col("first.at").alias("a"))
    return found.join(first, keys).where("doc <> d or tell <> t or tell2 <> t2 or at <> a").select(*ROW, "at", "n")


def _in_windows(pieces: DataFrame, window: int) -> DataFrame:
    """The windows of segments with their words, each with its digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = []
            for at, n, line, *row in zip(*(c.to_pylist() for c in batch.columns)):
                starts, ends = (x.tolist() for x in bounds(line))
                held += [(*_digest(line[starts[k]:ends[k + window - 1]]), *row, at + k, 1) for k in range(n)]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (zip(*held) if held else [[]] * 7)],
                                             names=["h1", "h2", *ROW, "at", "n"])

    return pieces.select("at", "n", "words", *ROW).mapInArrow(
        run, "h1 long, h2 long, doc long, tell long, tell2 long, at long, n long")


def search(pieces: list[bytes], doc: np.ndarray, tell: np.ndarray, at: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(piece, window in it) of all windows of a shard that also start earlier in it."""
    number: dict[bytes, int] = {}
    ids = [number.setdefault(w, len(number) + 1) for p in pieces for w in (*p.split(b" "), b"")]
    text = np.array(ids, dtype=np.int64)
    text[text == number[b""]] = 0  # the end of a piece
    place = np.concatenate([[0], np.flatnonzero(text == 0)[:-1] + 1])
    piece = np.repeat(np.arange(len(pieces)), n)
    inner = np.arange(len(piece)) - np.repeat(np.cumsum(n) - n, n)
    where = place[piece] + inner
    index = FMIndex(text, len(number) + 1, window)
    low, high, matched = index.matching(where, window)
    rank = np.empty(len(piece), dtype=np.int64)  # how early each window starts
    rank[np.lexsort((at[piece] + inner, tell[piece], doc[piece]))] = np.arange(len(piece))
    early = np.full(len(text), np.iinfo(np.int64).max)
    early[where] = rank
    early = early[index.order]
    shared = np.flatnonzero((matched == window) & (high - low > 1))
    if not len(shared):
        return shared, shared
    rows, back = np.unique(low[shared], return_inverse=True)
    ends = np.zeros(len(rows), dtype=np.int64)
    ends[back] = high[shared]
    edges = np.stack([rows, ends], axis=1).ravel()
    first = np.minimum.reduceat(np.append(early, np.iinfo(np.int64).max), edges)[::2]
    later = shared[rank[shared] > first[back]]
    return piece[later], inner[later]


def _shards(pieces: DataFrame, window: int, shard: int) -> DataFrame:
    """(doc, tell, tell2, at, n): repeated windows among segments that share an anchor."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size, last = 0, None
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if size >= shard and row[0] != last:
                    yield out(held)
                    held, size = [], 0
                held.append(row)
                size, last = size + row[5] + window, row[0]
        if held:
            yield out(held)

    def out(held: list[tuple]) -> pa.RecordBatch:
        _, doc, tell, tell2, at, n, words = zip(*held)
        doc, tell, tell2, at, n = (np.array(x, dtype=np.int64) for x in (doc, tell, tell2, at, n))
        both = np.empty(len(tell), dtype=[("a", np.int64), ("b", np.int64)])
        both["a"], both["b"] = tell, tell2
        piece, inner = search(list(words), doc, np.unique(both, return_inverse=True)[1], at, n, window)
        cols = (doc[piece], tell[piece], tell2[piece], at[piece] + inner, np.ones(len(piece), dtype=np.int64))
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=[*ROW, "at", "n"])

    rows = pieces.select("anchor", *ROW, "at", "n", "words")
    return rows.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(run, "doc long, tell long, tell2 long, at long, n long")


def repeats(docs: DataFrame, window: int = WINDOW, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
            shard: int = SHARD, classes_most: int = CLASSES) -> DataFrame:
    """(doc, tell, tell2, runs): runs of windows that also start earlier, by what names their document."""
    steps = Steps(docs.sparkSession)
    rows = _rows(docs, id_col, text_col, steps)
    found = candidates(rows, window, width, steps)
    keys = ["anchor", "h1", "h2"]
    classes = steps.write(found.groupBy(*keys).agg(F.min(F.struct(*ROW, "at", "n")).alias("first")), "classes")
    crowd = steps.write(classes.groupBy("anchor").agg(F.count("*").alias("size")).where("size > 1"), "crowds")
    # words are only needed where an anchor has several classes
    mixed = classes.join(crowd, "anchor").groupBy("first.doc", "first.tell", "first.tell2").agg(
        F.collect_list(F.struct("anchor", "size", "first.at", "first.n")).alias("found"))
    mixed = steps.write(mixed, "mixed", (crowd,))
    pieces = steps.write(_pieces(rows, mixed, window, "anchor long, size long, at long, n long, words binary, doc long, tell long, tell2 long",
                                 lambda piece: (piece,)), "pieces", (mixed,))
    single = steps.write(_in_windows(pieces.where(F.col("size") > classes_most), window), "windows")
    ones = steps.write(single.groupBy("h1", "h2").agg(F.min(F.struct(*ROW, "at")).alias("first")), "ones")
    parts = [_later(found, keys, classes), _later(single, ["h1", "h2"], ones),
             _shards(pieces.where(F.col("size") <= classes_most), window, shard)]
    out = parts[0].unionByName(parts[1]).unionByName(parts[2])
    return steps.write(out.groupBy(*ROW).agg(F.collect_list(F.struct("at", "n")).alias("runs")), "repeats",
                       (found, classes, pieces, single, ones))


def kept_words(line: bytes, runs: list[dict], window: int) -> tuple[int, bytes]:
    """(words removed, the others joined by one space)."""
    starts, ends = bounds(line)
    if not runs:
        return 0, line
    edge = np.zeros(len(starts) + 1, dtype=np.int64)
    np.add.at(edge, [r["at"] for r in runs], 1)
    np.add.at(edge, [r["at"] + r["n"] + window - 1 for r in runs], -1)
    drop = np.cumsum(edge[:-1]) > 0
    turn = np.flatnonzero(np.diff(np.concatenate([[True], drop, [True]]).astype(np.int8)))
    return int(drop.sum()), b" ".join(line[starts[a]:ends[b - 1]] for a, b in zip(turn[::2].tolist(), turn[1::2].tolist()))


def without_repeats(docs: DataFrame, window: int = WINDOW, width: int = WIDTH, id_col: str = "doc_id", text_col: str = "text",
                    shard: int = SHARD, classes_most: int = CLASSES) -> DataFrame:
    """All rows and columns, with n_words, n_removed and kept (the words that no repeated window covers).

    Words end at ASCII white space. Null texts and texts of fewer words than a window keep
    what they have. Earlier means a smaller id (null first), then the smaller digest of
    the text where rows share an id, then the earlier word; rows equal in id and text are
    one document and share its result.
    """
    clash = {"n_words", "n_removed", "kept", "doc", "tell", "tell2", "runs"} & set(docs.columns)
    if clash:
        raise ValueError(f"columns exist already: {sorted(clash)}")
    runs = repeats(docs, window, width, id_col, text_col, shard, classes_most)
    rows = docs.withColumn("doc", F.coalesce(F.col(id_col).cast("long"), F.lit(_LOW)))
    place = rows.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, found in zip(batch.column(place).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                line = line_of(text)
                removed, kept = kept_words(line, found or [], window)
                out.append((line.count(b" ") + 1 if line else 0, removed, kept.decode("utf-8", "surrogatepass")))
            cols = list(zip(*out)) if out else [[]] * 3
            batch = batch.select(list(range(batch.num_columns - 1)))
            for name, col, kind in zip(("n_words", "n_removed", "kept"), cols, (pa.int64(), pa.int64(), pa.string())):
                batch = batch.append_column(name, pa.array(col, kind))
            yield batch

    told = _told(rows, text_col)
    names = [f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields]
    joined = told.join(runs, ROW, "left").select(*docs.columns, "runs")
    return joined.mapInArrow(run, ", ".join(names) + ", n_words long, n_removed long, kept string")
