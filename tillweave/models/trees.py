"""Boosted regression trees for several fits at once, from one binned table.

Features are binned once. The binned rows are written in blocks of arrays with each row's
target, day and key, and every fit (a fold, a split, the whole table) is a range of days
in them. One job per tree level serves all fits: tasks add up the residuals of their
blocks by node, feature and bin. A few MB of these sums are added up by the driver, which
saves half of a short job; more of them meet in tasks by fit and node, and only what is
chosen there, a split per node, reaches the driver. Of two siblings only the smaller is counted
where the driver has their parent's sums. The blocks, and the sums of the trees so far, are files of
the executors that tasks map into memory; what a lost executor had is laid out anew from the written blocks.
"""

from __future__ import annotations

import contextlib
import glob
import itertools
import math
import os
import random
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import RDD, StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..schema import DATE, SERIES, TARGET
from ..session import materialise

BINS = 32
#: Rows of a block: some 100 bytes each.
BLOCK = 1 << 15
#: Rows that are sorted at a time for the bounds of the bins, and values of a column kept of them: some 60 MB.
SORTED, POINTS = 100_000, 1000
#: Blocks to a task, which reads them one after the other.
DEALT = 64
#: Rows of a file that a task maps and counts at a time: some 50 MB with what it works out of them.
PIECE = 1 << 17
#: Bytes of a level's partial sums, of all tasks, that the driver adds up itself; more of them meet in tasks.
NEAR = 64 << 20
#: Cells of a joint count: features are counted together as long as the product of their bins is no more.
CELLS = 1024
#: Picked rows of a pair of nodes from which on only the smaller one is counted: the other is what remains of their parent.
PAIRED = 10_000
#: Packs the bins of a block on their way between executors and Python: rows of a series have many bins in common.
CODEC = "lz4_raw"
#: Rounds whose trees are sent along with jobs, for tasks that find no newer sums; each task keeps the sums that it has added up.
KEPT = 2
_BLOCKS = "block long, n int, x binary, y binary, day binary, key binary, sums binary"


@dataclass(frozen=True)
class Fit:
    """Days (since 1970) of the training rows, and of those that judge each round if training may stop early."""

    first: int
    last: int
    val_first: int | None = None
    val_last: int | None = None


@dataclass
class Tree:
    """Nodes in heap order: the children of k are 2 k + 1 (bin at most ``bin``) and 2 k + 2; feature -1 is a leaf."""

    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray
    rows: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Tree:
        n = (2 << depth) - 1
        return cls(np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n), np.zeros(n, dtype=np.int64))

    def leaves(self, x: np.ndarray, depth: int) -> np.ndarray:
        """Node of each row; x has a line of bins per feature."""
        kind = np.min_scalar_type((2 << depth) - 2)
        at = np.zeros(x.shape[1], dtype=kind)
        for node in np.flatnonzero(self.feature[:(1 << depth) - 1] >= 0).tolist():  # parents before their children
            here = at == node
            right = here & (x[int(self.feature[node])] > int(self.bin[node]))
            at += here.astype(kind) * kind.type(node + 1)
            at += right.astype(kind)
        return at


@dataclass
class Ensemble:
    """base + rate * the sum of the trees."""

    edges: list[list[float]]
    base: float
    rate: float
    depth: int
    trees: list[Tree] = field(default_factory=list)
    history: list[float] = field(default_factory=list)  # mean squared validation error of the rounds that were run
    grown: int = 0

    def binned(self, values: np.ndarray) -> np.ndarray:
        """values: a row of features each; the bin of a value is the number of edges below it."""
        return binned(values, self.edges)

    def predict(self, values: np.ndarray) -> np.ndarray:
        x = self.binned(values)
        return self.base + self.rate * sum((t.value[t.leaves(x, self.depth)] for t in self.trees), np.zeros(len(values)))

    def importance(self) -> np.ndarray:
        """Share of each feature in what the splits have gained."""
        gains = np.zeros(len(self.edges))
        for t in self.trees:
            split = t.feature >= 0
            np.add.at(gains, t.feature[split], t.gain[split])
        return gains / gains.sum() if gains.sum() > 0 else gains


def binned(values: np.ndarray, edges: Sequence[Sequence[float]]) -> np.ndarray:
    out = np.empty((len(edges), len(values)), dtype=np.uint8)
    for k, e in enumerate(edges):
        out[k] = np.searchsorted(np.asarray(e, dtype=float), values[:, k], side="left")
    return out


def _counted(values: np.ndarray, points: int = POINTS) -> tuple[np.ndarray, np.ndarray]:
    """Rising values and the rows that each stands for: all different ones, or the upper ends of ``points`` equal shares of the rows."""
    values = np.sort(values[~np.isnan(values)])
    if not len(values):
        return values, np.zeros(0, dtype=np.int64)
    last = np.append(np.flatnonzero(values[1:] != values[:-1]), len(values) - 1)
    if len(last) > points:
        last = np.unique(-(-np.arange(1, points + 1) * len(values) // points) - 1)
    return values[last], np.diff(last, prepend=-1)


def edges_of(df: DataFrame, columns: Sequence[Column], bins: int = BINS) -> list[list[float]]:
    """Up to bins - 1 rising bounds per column: its quantiles, in one pass. Values above the last make the last bin.

    Tasks sort some rows at a time, column by column. Exact for columns of at most ``POINTS`` different
    values, else within 1 / ``POINTS`` of the rows. Nulls and NaN don't count.
    """
    width = len(columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def given() -> Iterator[pa.RecordBatch]:
            for k in range(width if held else 0):
                values, rows = _counted(np.concatenate([h[:, k] for h in held]))
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(values), k, dtype=np.int32)), pa.array(values), pa.array(rows)], names=["f", "value", "n"])
            held.clear()

        for b in batches:
            if len(b):
                held.append(b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(b), width))
            if sum(len(h) for h in held) >= SORTED:
                yield from given()
        yield from given()

    counted = df.select(F.array(*columns).alias("x")).mapInArrow(run, "f int, value double, n long").groupBy("f", "value").agg(F.sum("n").alias("n"))
    upto = Window.partitionBy("f").orderBy("value")
    whole = F.sum("n").over(Window.partitionBy("f"))
    ranked = counted.withColumns({"upto": F.sum("n").over(upto.rowsBetween(Window.unboundedPreceding, 0)), "whole": whole})
    # k / bins of the rows are reached with this value, and were not before it
    share = F.least(F.floor(F.col("upto") * bins / F.col("whole")), F.lit(bins - 1))
    bound = (share > 0) & ((F.col("upto") - F.col("n")) * bins < share * F.col("whole"))
    out: list[list[float]] = [[] for _ in columns]
    for r in ranked.where(bound).select("f", "value").orderBy("f", "value").collect():
        out[r["f"]].append(float(r["value"]))
    return out


def blocks(df: DataFrame, columns: Sequence[Column], edges: Sequence[Sequence[float]], size: int = BLOCK) -> DataFrame:
    """The binned rows in blocks, written once: feature by feature one byte a row. Rows without a target or date are left out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def given(done: bool) -> Iterator[pa.RecordBatch]:
            while held and (done or sum(len(h[1]) for h in held) >= size):
                x, y, day, key = (np.concatenate([h[k] for h in held], axis=-1) for k in range(4))
                parts = [(x[:, :size], x[:, size:]), *((v[:size], v[size:]) for v in (y, day, key))]
                held[:] = [tuple(p[1] for p in parts)] if len(y) > size else []
                x, y, day, key = (np.ascontiguousarray(p[0]) for p in parts)
                row = [int(key[0]), len(y), x.tobytes(), y.tobytes(), day.tobytes(), key.tobytes(), b""]
                yield pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, _kinds())], names=_names())

        for b in batches:
            if len(b):
                values = b.column(0).flatten().to_numpy(zero_copy_only=False).reshape(len(b), len(edges))
                y, day, key = (b.column(k).to_numpy(zero_copy_only=False) for k in (1, 2, 3))
                held.append((binned(values, edges), y.astype("<f8"), day.astype("<i4"), key.astype("<i8")))
            yield from given(False)
        yield from given(True)

    rows = df.where(F.col(TARGET).isNotNull() & F.col(DATE).isNotNull()).select(
        F.array(*columns).alias("x"), F.col(TARGET).cast("double").alias("y"), F.unix_date(F.to_date(DATE)).alias("day"), F.xxhash64(*SERIES, DATE).alias("key"))
    return materialise(rows.mapInArrow(run, _BLOCKS), "blocks")


def _names() -> list[str]:
    return [c.split()[0] for c in _BLOCKS.split(", ")]


def _kinds() -> list[pa.DataType]:
    return [pa.int64(), pa.int32(), *[pa.binary()] * 5]


def picked(key: np.ndarray, seed: int, round_: int, share: float) -> np.ndarray:
    """The rows that take part in a round: a share of them by the hash of their keys, however they are dealt out."""
    h = key.view(np.uint64) ^ np.uint64(random.Random(f"{seed} rows {round_}").getrandbits(64))
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        h ^= h >> np.uint64(shift)
        h *= np.uint64(factor)
    h >>= np.uint64(11)
    return h < np.uint64(math.ceil(share * 2.0 ** 53))


def drawn(seed: int, round_: int, width: int, share: float) -> list[int]:
    """The features that the tree of a round may split on."""
    return sorted(random.Random(f"{seed} columns {round_}").sample(range(width), max(1, round(share * width))))


#: What a round adds to the sums of each fit: a constant, or a rate times a tree.
Step = list[tuple[float, float, Tree | None]]


def _state(table: DataFrame) -> RDD:
    """The blocks as plain tuples of bytes, their bins packed, dealt evenly over the cores: some ``DEALT`` to a task where there are many."""
    def packed(row: tuple) -> tuple:
        block, n, x, *rest = row
        return (block, n, pa.compress(x, CODEC, asbytes=True), *map(bytes, rest))

    n, cores = table.count(), table.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(n, cores * -(-n // (cores * DEALT))))
    return table.repartition(parts).rdd.map(packed)


def _folder(at: str, part: int) -> str:
    """Where this executor keeps the files of a part: among its own blocks, which go when it ends."""
    return os.path.join(os.environ.get("SPARK_LOCAL_DIRS", tempfile.gettempdir()).split(",")[0], at, str(part))


def _put(path: str, *arrays: np.ndarray) -> None:
    """A whole file or none, also where a task runs twice."""
    part = f"{path}.{os.getpid()}"
    with open(part, "wb") as f:
        for a in arrays:
            a.tofile(f)
    os.replace(part, path)


def _advance(sums: np.ndarray, x: np.ndarray, steps: Sequence[Step], depth: int) -> np.ndarray:
    for step in steps:
        for k, (constant, rate, tree) in enumerate(step):
            sums[k] += constant if tree is None else constant + (rate * tree.value).take(tree.leaves(x, depth))
    return sums


#: A part, the smallest number of its blocks, and (file, rows) of its pieces.
Names = tuple[int, int, list[tuple[str, int]]]


def _laid(part: int, rows: Iterator[tuple], at: str, width: int, fits: int, steps: Sequence[Step], depth: int) -> Iterator[Names]:
    """Writes a part's blocks as files of this executor, some ``PIECE`` rows a file, with their sums after ``steps``."""
    folder, first, names, held = _folder(at, part), None, [], []

    def put() -> None:
        y, day, key = (np.concatenate([h[k] for h in held]) for k in (1, 2, 3))
        x = np.concatenate([h[0] for h in held], axis=1)
        path = f"{folder}/{len(names)}"
        _put(path, y, key, day, x)
        if steps:
            _put(f"{path}.sums{len(steps)}", _advance(np.zeros((fits, len(y))), x, steps, depth))
        names.append((path, len(y)))
        held.clear()

    os.makedirs(folder, exist_ok=True)
    for block, n, x, y, day, key, _ in rows:
        first = block if first is None else min(first, block)
        x = np.frombuffer(pa.decompress(x, width * n, CODEC), dtype=np.uint8).reshape(width, n)
        held.append((x, np.frombuffer(y, "<f8"), np.frombuffer(day, "<i4"), np.frombuffer(key, "<i8")))
        if sum(len(h[1]) for h in held) >= PIECE:
            put()
    if held:
        put()
    if first is not None:
        yield part, first, names


def _dropped(names: Names) -> None:
    folder = os.path.dirname(names[2][0][0])
    shutil.rmtree(folder, ignore_errors=True)
    with contextlib.suppress(OSError):  # other parts still have files there
        os.rmdir(os.path.dirname(folder))


class _Laid:
    """The blocks as files of the executors. Jobs move the files' names only; tasks map the files.

    ``rdd`` has a part's names where its files are. A task that runs elsewhere finds none and says so: then the
    blocks are laid out anew from ``source``, with the sums of all rounds so far, and its job is run again.
    """

    def __init__(self, source: RDD, width: int, fits: int, depth: int):
        self.source, self.width, self.fits, self.depth = source, width, fits, depth
        self.steps: list[Step] = []  # whose sums are kept
        self.last = 0  # how many of them came last
        self.rdd: RDD | None = None
        self.lay()

    def lay(self) -> None:
        self.drop()
        at, width, fits, steps, depth = f"trees-{uuid.uuid4().hex}", self.width, self.fits, list(self.steps), self.depth
        self.rdd = self.source.mapPartitionsWithIndex(lambda part, rows: _laid(part, rows, at, width, fits, steps, depth)).persist(StorageLevel.MEMORY_AND_DISK)

    def drop(self) -> None:
        if self.rdd is not None:
            self.rdd.filter(_dropped).collect()
            self.rdd.unpersist()
            self.rdd = None

    def reader(self, pending: Sequence[Step]):
        """What a task calls with a file and its rows: bins, target, day, key and sums, or None where there is no such file."""
        width, fits, depth, rounds = self.width, self.fits, self.depth, len(self.steps) + len(pending)
        last = [*self.steps, *pending][-len(pending) - max(self.last, 1):]

        def read(path: str, n: int) -> tuple[np.ndarray, ...] | None:
            try:
                raw = np.asarray(np.memmap(path, dtype=np.uint8, mode="r"))
            except FileNotFoundError:
                return None
            x, kept = raw[20 * n:].reshape(width, n), f"{path}.sums"
            for known in range(rounds, max(rounds - len(last), 0) - 1, -1):
                if known == 0:
                    sums = np.zeros((fits, n))
                    break
                with contextlib.suppress(FileNotFoundError):
                    sums = np.fromfile(f"{kept}{known}").reshape(fits, n)
                    break
            else:
                return None
            if known < rounds:  # the sums before stay for a task that runs twice
                _put(f"{kept}{rounds}", _advance(sums, x, last[len(last) - (rounds - known):], depth))
                for old in glob.glob(f"{glob.escape(kept)}*"):
                    if (of := old[len(kept):]).isdigit() and int(of) < known:
                        with contextlib.suppress(FileNotFoundError):
                            os.remove(old)
            return x, raw[:8 * n].view("<f8"), raw[16 * n:20 * n].view("<i4"), raw[8 * n:16 * n].view("<i8"), sums

        return read


def _add(state: _Laid, pending: Sequence[Step]) -> _Laid:
    """The blocks with the pending rounds added to their sums: from here on they need not be sent along."""
    state.steps, state.last = [*state.steps, *pending], len(pending)
    return state


def _together(features: Sequence[int], sizes: Sequence[int]) -> list[list[int]]:
    """The places of the features, in groups whose joint cells are no more than ``CELLS``; sizes: bins of every feature."""
    groups: list[tuple[int, list[int]]] = []
    for i in sorted(range(len(features)), key=lambda i: -sizes[features[i]]):
        of = next((g for g, (cells, _) in enumerate(groups) if cells * sizes[features[i]] <= CELLS), None)
        if of is None:
            groups.append((sizes[features[i]], [i]))
        else:
            groups[of] = (groups[of][0] * sizes[features[i]], [*groups[of][1], i])
    return [group for _, group in groups]


def _each(joint: np.ndarray, sizes: Sequence[int]) -> list[np.ndarray]:
    """Sums by node and bin of each feature from those by node and joint cell."""
    cube = joint.reshape(-1, *sizes)
    return [cube.sum(axis=tuple(a for a in range(1, cube.ndim) if a != i + 1)) for i in range(len(sizes))]


def _chosen(sums: np.ndarray, features: Sequence[int]) -> tuple | None:
    """(feature, bin, gain, rows and mean left, rows and mean right) of the best split; sums: counts and residuals by feature and bin."""
    left = np.cumsum(sums, axis=2)[:, :, :-1]
    whole = sums.sum(axis=2)[:, :, None]
    n, s = left
    m, t = whole - left
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = np.where((n > 0) & (m > 0), s * s / n + t * t / m - (whole[1] ** 2 / np.maximum(whole[0], 1)), 0.0)
    f, b = np.unravel_index(np.argmax(gain), gain.shape)
    if gain[f, b] <= 1e-12 * max(1.0, float(whole[1][f, 0] ** 2)):
        return None
    return features[f], int(b), float(gain[f, b]), int(n[f, b]), float(s[f, b] / n[f, b]), int(m[f, b]), float(t[f, b] / m[f, b])


def _smaller(tree: Tree, nodes: Sequence[int], above: Iterable[int]) -> dict[int, int]:
    """The nodes that need no count because their parent's is known (``above``), each with its smaller sibling."""
    out = {}
    for left in nodes:
        n, m = tree.rows[left:left + 2].tolist()
        if left % 2 and (left - 1) // 2 in above and n + m >= PAIRED:
            out |= {left: left + 1} if n > m else {left + 1: left}
    return out


_ERRORS = -1  # in place of a node
_LOST = -1  # in place of a fit: a part whose files are not where its task ran
Sums = dict[tuple[int, int], np.ndarray]


def _level(state: _Laid, sizes: Sequence[int], fits: Sequence[Fit], trees: dict[int, Tree], open_: dict[int, list[int]], level: int, features: Sequence[int],
           seed: int, round_: int, share: float, errors: bool, pending: Sequence[Step], depth: int,
           above: Sums) -> tuple[dict[tuple[int, int], tuple], dict[int, tuple[float, float]], Sums]:
    """For all open nodes of the growing trees their best splits, (fit, node) -> split; each fit's squared validation error and rows; and
    the nodes' sums, if the driver has added them up. ``above`` has those of the level before."""
    bins, groups = max(sizes), _together(features, sizes)
    cells = [math.prod(sizes[features[i]] for i in group) for group in groups]
    keys = sum(len(nodes) + errors for nodes in open_.values())
    own_bins = np.array([sizes[f] for f in features])
    ends, there = np.cumsum(own_bins).tolist(), np.arange(bins) < own_bins[:, None]  # a feature's sums travel without bins it lacks
    near = state.rdd.getNumPartitions() * keys * 16 * ends[-1] <= NEAR
    remains = {k: _smaller(trees[k], nodes, [node for of, node in above if of == k]) if near else {} for k, nodes in open_.items()}
    open_ = {k: [node for node in nodes if node not in remains[k]] for k, nodes in open_.items()}

    read = state.reader(pending)

    def partial(parts: Iterator[Names]) -> Iterator[tuple]:
        held = {k: [np.zeros((2, len(nodes) * n)) for n in cells] for k, nodes in open_.items()}
        wrong = {k: np.zeros(2) for k in open_}
        first = None
        for part, path, n, block in ((part, path, n, block) for part, block, names in parts for path, n in names):
            first = block if first is None else min(first, block)
            found = read(path, n)
            if found is None:
                yield (_LOST, part, block), b""
                return
            x, y, day, key, sums = found
            some = picked(key, seed, round_, share)
            joint = []
            for group in groups:
                cell = x[features[group[0]]].astype(np.uint16)
                for i in group[1:]:
                    cell *= np.uint16(sizes[features[i]])
                    cell += x[features[i]]
                joint.append(cell)
            for k, nodes in open_.items():
                fit = fits[k]
                rest = y - sums[k]
                if errors and fit.val_first is not None:
                    judged = rest[(day >= fit.val_first) & (day <= fit.val_last)]
                    wrong[k] += (judged @ judged, len(judged))
                spot = np.full((2 << level) - 1, -1, dtype=np.int64)
                spot[nodes] = range(len(nodes))
                at = spot[trees[k].leaves(x, level)]
                mine = np.flatnonzero(some & (day >= fit.first) & (day <= fit.last) & (at >= 0))
                at, rest = at[mine], rest[mine]
                for n, cell, total in zip(cells, joint, held[k]):
                    cell = at * n + cell.take(mine)
                    total[0] += np.bincount(cell, minlength=len(nodes) * n)
                    total[1] += np.bincount(cell, weights=rest, minlength=len(nodes) * n)
        if first is None:
            return
        for k, nodes in open_.items():
            own = np.zeros((len(nodes), 2, ends[-1]))
            for group, total in zip(groups, held[k]):
                of = [sizes[features[i]] for i in group]
                for what in (0, 1):
                    for i, n, by_bin in zip(group, of, _each(total[what], of)):
                        own[:, what, ends[i] - n:ends[i]] = by_bin
            for node, its in zip(nodes, own):
                yield (k, node, first), its.tobytes()
            if errors:
                yield (k, _ERRORS, first), wrong[k].tobytes()

    def whole(parts: Iterator[tuple]) -> Iterator[tuple]:
        for of, same in itertools.groupby(parts, key=lambda part: part[0][:2]):
            if of[0] == _LOST:
                yield of, None
                continue
            total = reduce(np.add, (np.frombuffer(raw, dtype=np.float64) for _, raw in same))
            if of[1] == _ERRORS:
                yield of, tuple(total.tolist())
                continue
            padded = np.zeros((2, len(features), bins))
            padded[:, there] = total.reshape(2, -1)
            yield of, padded

    def chosen(totals: Iterator[tuple]) -> Iterator[tuple]:
        return ((of, total if total is None or of[1] == _ERRORS else _chosen(total, features)) for of, total in totals)

    # in one order either way, so that equal runs give equal sums
    def near_sums() -> list[tuple]:
        return list(whole(iter(sorted(state.rdd.mapPartitions(partial).collect(), key=lambda part: part[0]))))

    def far_splits() -> list[tuple]:
        meeting = min(keys, state.source.context.defaultParallelism)
        met = state.rdd.mapPartitions(partial).repartitionAndSortWithinPartitions(meeting, lambda of: of[0] * 61 + of[1])
        return met.mapPartitions(lambda parts: chosen(whole(parts))).collect()

    found, kept = _there(state, near_sums if near else far_splits), {}
    if near:
        totals = dict(found)
        for k, pairs in remains.items():
            for node, sibling in pairs.items():
                if (k, sibling) in totals:
                    total = above[k, (node - 1) // 2] - totals[k, sibling]
                    total[1][total[0] == 0] = 0.0
                    totals[k, node] = total
        found = list(chosen(iter(totals.items())))
        kept = {of: total for of, total in totals.items() if of[1] != _ERRORS}
    return {of: v for of, v in found if of[1] != _ERRORS and v is not None}, {of[0]: v for of, v in found if of[1] == _ERRORS}, kept


def _there(state: _Laid, job: Callable[[], list[tuple]], times: int = 5) -> list[tuple]:
    """What the job gives, run again with blocks laid out anew while some of its tasks find no files."""
    for _ in range(times):
        found = job()
        if not any(of[0] == _LOST for of, _ in found):
            return found
        state.lay()
    raise RuntimeError("the files of the blocks are not where Spark runs their tasks")


def _means(state: _Laid, fits: Sequence[Fit]) -> dict[int, float]:
    """Mean target of each fit's training rows; fits without such rows are left out."""
    read = state.reader([])

    def run(names: Names) -> list[tuple]:
        part, block, files = names
        sums = np.zeros((len(fits), 2))
        for path, n in files:
            found = read(path, n)
            if found is None:
                return [((_LOST, part), (block, 0.0, 0))]
            _, y, day, *_ = found
            for k, f in enumerate(fits):
                some = y[(day >= f.first) & (day <= f.last)]
                sums[k] += some.sum(), len(some)
        return [((k, _ERRORS), (block, float(s), int(n))) for k, (s, n) in enumerate(sums)]

    added = state.rdd.flatMap(run).groupByKey().mapValues(lambda parts: [sum(c) for c in list(zip(*sorted(parts)))[1:]])
    return {of[0]: s / n for of, (s, n) in _there(state, added.collect) if n}


def grow(table: DataFrame, edges: list[list[float]], fits: Sequence[Fit], trees: int, depth: int, rate: float, row_share: float, feature_share: float,
         seed: int, patience: int = 10) -> list[Ensemble | None]:
    """Boost squared errors for all fits side by side; None for a fit without training rows.

    The first value of a fit is its mean; each round fits one tree to what is left of the
    picked rows, on the features drawn for that round, and adds ``rate`` times its leaves'
    means. A fit with validation days stops after ``patience`` rounds without a lower
    error and keeps the trees up to its best round: no tree is grown beyond that rule.
    """
    sizes = [len(e) + 1 for e in edges]
    state = _Laid(_state(table), len(edges), len(fits), depth)
    try:
        return _grown(state, edges, sizes, fits, trees, depth, rate, row_share, feature_share, seed, patience)
    finally:
        state.drop()


def _grown(state: _Laid, edges: list[list[float]], sizes: Sequence[int], fits: Sequence[Fit], trees: int, depth: int, rate: float, row_share: float,
           feature_share: float, seed: int, patience: int) -> list[Ensemble | None]:
    base, width = _means(state, fits), len(edges)
    out = [Ensemble(edges, base[k], rate, depth) if k in base else None for k in range(len(fits))]
    pending: list[Step] = [[(base.get(k, 0.0), 0.0, None) for k in range(len(fits))]]
    running = set(base)
    for round_ in range(1, trees + 2):
        if round_ > trees and all(fits[k].val_first is None for k in running):
            break
        if round_ % KEPT == 0:
            state, pending = _add(state, pending), []
        features = drawn(seed, round_, width, feature_share)
        new = {k: Tree.empty(depth) for k in running}
        open_ = {k: [0] for k in running}
        above: Sums = {}
        for level in range(depth):
            if not open_:
                break
            first = level == 0
            splits, judged, above = _level(state, sizes, fits, new, open_, level, features, seed, round_, row_share, first, pending, depth, above)
            if first:
                for k, (wrong, n) in judged.items():  # of the rounds before this one
                    model = out[k]
                    if round_ > 1 and fits[k].val_first is not None and n:
                        model.history.append(wrong / n)
                        if len(model.history) - 1 - int(np.argmin(model.history)) >= patience:
                            running.discard(k)
                running = {k for k in running if round_ <= trees}
            following: dict[int, list[int]] = {}
            for (k, node), (feature, at, gain, n, left, m, right) in splits.items():
                if k in running:
                    tree = new[k]
                    tree.feature[node], tree.bin[node], tree.gain[node] = feature, at, gain
                    tree.rows[node] = n + m
                    for child, rows, value in ((2 * node + 1, n, left), (2 * node + 2, m, right)):
                        tree.value[child], tree.rows[child] = value, rows
                        following.setdefault(k, []).append(child)
            open_ = {k: sorted(nodes) for k, nodes in following.items()}
        if not running:
            break
        for k in running:
            out[k].trees.append(new[k])
            out[k].grown += 1
        pending = [*pending, [(0.0, rate if k in running else 0.0, new.get(k) if k in running else None) for k in range(len(fits))]]
    for model in out:
        if model is not None and model.history:
            model.trees = model.trees[:1 + int(np.argmin(model.history))]
    return out
