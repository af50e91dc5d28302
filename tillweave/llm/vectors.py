"""Near-duplicate embeddings: spherical k-means cells, blocked cosine products, one representative per group.

Vectors are compared only under the same label. Equal directions enter once, with their
number. Labels with more than a cell's worth of vectors get cells from a k-means on a
bounded sample; a vector joins every cell whose centre is nearly as close as the nearest
one, and a pair that meets in several cells counts in the first of them. Cells are cut
into blocks, and a task multiplies two blocks. It returns link counts and a spanning
forest, never the pairs.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialise
from .graph import components

#: Vectors wanted in a cell, and of a block at most (in the mean).
CELL = 2048
BLOCK = 1024
#: Bounds the cells of all labels to twice this number, and so what is collected and broadcast.
CELLS = 4096
#: Vectors of the k-means sample for each cell.
PER_CELL = 32
#: A vector also joins cells whose cosine is lower than the best by this much.
MARGIN = 0.15


def _units(batch: pa.RecordBatch) -> Iterator[bytes | None]:
    """Each vector divided by its length, as the bytes of doubles; None if it can link with nothing."""
    for name, vector, label in zip(*(batch.column(c).to_pylist() for c in ("id", "vector", "label"))):
        if name is None or vector is None or label is None or not len(vector) or any(x is None for x in vector):
            yield None
            continue
        v = np.array(vector, dtype=np.float64)
        if not np.isfinite(v).all() or not v.any():
            yield None
            continue
        v = v / np.abs(v).max()  # neither over- nor underflow in the squares
        yield (v / np.sqrt(v @ v)).tobytes()


def prepare(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """id, label, unit (binary), key (of label and unit; null where the vector can't link)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = list(_units(batch))
            labels = batch.column("label").to_pylist()
            sizes = [None if u is None else f"{len(u) // 8}:{label}" for u, label in zip(units, labels)]
            keys = [None if u is None else hashlib.blake2b(u, digest_size=16, key=hashlib.blake2b(size.encode()).digest()).hexdigest()
                    for u, size in zip(units, sizes)]
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(sizes, pa.string()), pa.array(units, pa.binary()),
                                              pa.array(keys, pa.string())], names=["id", "label", "unit", "key"])

    kind = vectors.schema[id_col].dataType.simpleString()
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"), F.col(label_col).cast("string").alias("label"))
    return rows.mapInArrow(run, f"id {kind}, label string, unit binary, key string")


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = 8, seed: int = 7) -> np.ndarray:
    """k unit centres. Empty cells take the vectors that lie farthest from their centre."""
    centres = x[np.random.default_rng(seed).permutation(len(x))[:k]]
    for _ in range(rounds):
        score = x @ centres.T
        cell = score.argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, x)
        empty = np.flatnonzero(np.bincount(cell, minlength=len(centres)) == 0)
        if len(empty):
            sums[empty] = x[np.argsort(score[np.arange(len(x)), cell], kind="stable")[:len(empty)]]
        length = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(length > 0, sums / np.where(length > 0, length, 1), centres)
    return centres


def centres(reps: DataFrame, cell: int = CELL, cells: int = CELLS, per_cell: int = PER_CELL) -> dict[str, np.ndarray]:
    """Centres of the labels that need more than one cell: at most ``2 * cells`` rows in all.

    The sample has ``per_cell`` vectors for each cell of a label, those of the least key. Keys
    are hashes, so a range of them holds some four times the sample and cuts it off where
    the vectors are read, before any are ranked.
    """
    spark = reps.sparkSession
    size = max(cell, -(-reps.count() // cells))
    large = {r["label"]: -(-r["count"] // size) for r in reps.groupBy("label").count().where(F.col("count") > size).collect()}
    if not large:
        return {}
    wanted = spark.createDataFrame([(label, k, f"{min((1 << 64) - 1, (4 * per_cell << 64) // size):016x}g") for label, k in large.items()],
                                   "label string, k int, below string")
    counted = reps.join(F.broadcast(wanted), "label").where(F.col("key") < F.col("below"))

    sample = counted.withColumn("n", F.row_number().over(Window.partitionBy("label").orderBy("key"))).where(
        (F.col("n") <= per_cell * cells) & (F.col("n") <= per_cell * F.col("k"))).select("label", "k", "unit")

    def fit(f: pd.DataFrame) -> pd.DataFrame:
        x = np.stack([np.frombuffer(u) for u in f["unit"]])
        found = spherical_kmeans(x, int(f["k"].iloc[0]))
        return pd.DataFrame({"label": f["label"].iloc[0], "cell": np.arange(len(found)), "centre": [c.tobytes() for c in found]})

    rows = sample.groupBy("label").applyInPandas(fit, "label string, cell int, centre binary").collect()
    out: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: (r["label"], r["cell"])):
        out.setdefault(r["label"], []).append(np.frombuffer(r["centre"]))
    return {label: np.stack(c) for label, c in out.items()}


def _first_common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least cell that both rows of cells (padded with -1) have."""
    out = np.full(len(a), np.iinfo(np.int32).max)
    for k in range(a.shape[1]):
        shared = ((a[:, k:k + 1] == b) & (a[:, k:k + 1] >= 0)).any(axis=1)
        out[shared] = np.minimum(out[shared], a[shared, k])
    return out


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The least position each of n positions reaches by the links (a, b)."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def compare(f: pd.DataFrame, least: float) -> pd.DataFrame:
    """Links of one pair of blocks: per vector the linked ones' number and the least position it reaches here."""
    f = f.sort_values("key", ignore_index=True)
    i, j, here = int(f["i"].iloc[0]), int(f["j"].iloc[0]), int(f["cell"].iloc[0])
    x = np.stack([np.frombuffer(u) for u in f["unit"]])
    block, n, key = f["block"].to_numpy(), f["n"].to_numpy(), f["key"].to_numpy()
    width = max(map(len, f["cells"]))
    cells = np.full((len(f), width), -1, dtype=np.int32)
    for k, c in enumerate(f["cells"]):
        cells[k, :len(c)] = c
    left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
    ones, others = [], []
    for at in range(0, len(left), 256):
        part = left[at:at + 256]
        a, b = np.nonzero(x[part] @ x[right].T >= least)
        a, b = part[a], right[b]
        keep = a < b if i == j else a != b
        a, b = a[keep], b[keep]
        if width > 1:
            first = _first_common(cells[a], cells[b]) == here
            a, b = a[first], b[first]
        ones.append(a)
        others.append(b)
    a, b = np.concatenate([*ones, left[:0]]), np.concatenate([*others, left[:0]])
    links = np.bincount(a, n[b], len(f)) + np.bincount(b, n[a], len(f))
    root = _forest(a, b, len(f))
    found = links > 0
    return pd.DataFrame({"key": key[found], "links": links[found].astype(np.int64), "root": key[root[found]]})


def near_duplicates(vectors: DataFrame, least: float = 0.93, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                    cell: int = CELL, block: int = BLOCK, cells: int = CELLS, margin: float = MARGIN) -> DataFrame:
    """id, n_links, component_id, kept: one row per input row.

    Links join vectors of one label (and length) whose cosine in double precision is at
    least ``least``. Null, empty and zero vectors, vectors with a null or non-finite
    component and rows without a label or an id link with nothing and form their own component.
    Rows with equal directions link with each other, also where they share an id; ids may
    repeat, and a component is named by the smallest of its rows. Other columns are ignored.
    """
    spark = vectors.sparkSession
    rows = materialise(prepare(vectors, id_col, vector_col, label_col), "units")
    reps = materialise(rows.where("key is not null").groupBy("label", "key").agg(
        F.min("id").alias("rep"), F.count("*").alias("n"), F.first("unit").alias("unit")), "reps")
    model = spark.sparkContext.broadcast(centres(reps, cell, cells))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.array(batch.column(0).to_pylist(), dtype=object)
            homes = [[0]] * len(labels)
            for label in set(labels.tolist()) & set(model.value):
                rows = np.flatnonzero(labels == label)
                score = np.stack([np.frombuffer(u) for u in batch.column(3).take(pa.array(rows)).to_pylist()]) @ model.value[label].T
                near = score >= score.max(axis=1, keepdims=True) - margin
                for k, line in zip(rows.tolist(), near):
                    homes[k] = np.flatnonzero(line).tolist()
            yield batch.append_column("cells", pa.array(homes, pa.list_(pa.int32())))

    placed = materialise(reps.select("label", "key", "n", "unit").mapInArrow(
        assign, "label string, key string, n long, unit binary, cells array<int>"), "cells")
    spread = placed.withColumn("cell", F.explode("cells"))
    # only the cells of labels with centres can hold more than a block or two: their sizes are bounded in number
    large = spread.where(F.col("label").isin(list(model.value))) if model.value else spread.limit(0)
    sizes = {(r["label"], r["cell"]): r["count"] for r in large.groupBy("label", "cell").count().collect()}
    parts = spark.createDataFrame([(a, b, -(-n // block)) for (a, b), n in sizes.items()], "label string, cell int, parts int")
    spread = spread.join(F.broadcast(parts), ["label", "cell"], "left").withColumn(
        "parts", F.coalesce("parts", F.lit(-(-cell // block)) if cell > block else F.lit(1)))
    spread = spread.withColumn("block", F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).withColumn(
        "i", F.least("block", "other")).withColumn("j", F.greatest("block", "other"))
    found = materialise(spread.select("label", "cell", "i", "j", "block", "key", "n", "unit", "cells").groupBy(
        "label", "cell", "i", "j").applyInPandas(lambda f: compare(f, least), "key string, links long, root string"), "found")
    root = components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))).withColumnRenamed("node", "key")
    links = found.groupBy("key").agg(F.sum("links").alias("links"))
    grouped = reps.select("key", "rep", "n").join(links, "key", "left").join(root, "key", "left").withColumn("root", F.coalesce("root", "key"))
    grouped = materialise(grouped, "grouped")
    names = grouped.groupBy("root").agg(F.min("rep").alias("component_id"))
    table = grouped.join(names, "root").select("key", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    table = materialise(table, "classes")
    linked = rows.where("key is not null").join(table, "key").select("id", "n_links", "component_id")
    alone = rows.where("key is null").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.union(alone).select(F.col("id").alias(id_col), "n_links", "component_id",
                                      F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))
