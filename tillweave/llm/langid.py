"""Language identification: sparse multinomial logistic regression on TF-IDF character n-grams.

Texts are lowered, everything but letters becomes a space, and the grams of one to three
characters are hashed into a fixed number of features. Document frequencies are counted
over all training documents; the weights are fitted by follow-the-regularised-leader with
an elastic-net penalty on a bounded sample, and a temperature is set on the part of the
sample that the fit doesn't see.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Hashed features, as a power of two.
BITS = 15
#: Labelled rows the classifier is fitted on, at most, for each language.
ROWS = 500
#: Every how many-th sample row is left for the temperature.
ASIDE = 5
UNKNOWN = "und"
_CHUNK = 1 << 20
_MIX = np.array([2654435761, 2246822519, 3266489917, 668265263, 374761393, 2870177449], dtype=np.uint32)


@cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000)


def grams(text: str | None, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers, ascending, and how often each occurs; both empty without a letter."""
    total, shift, known = None, np.uint32(32 - bits), _letters()
    text = (text or "").lower()
    for at in range(0, len(text), _CHUNK):  # two characters over, so that no gram is lost
        c = np.frombuffer(text[max(at - 2, 0):at + _CHUNK].encode("utf-32-le", "surrogatepass"), dtype="<u4")
        alpha = known[c]
        c = np.where(alpha, c, np.uint32(32))
        new = 0 if at == 0 else 2
        one, two, three = c * _MIX[0], c[:-1] * _MIX[1] + c[1:] * _MIX[2], c[:-2] * _MIX[3] + c[1:-1] * _MIX[4] + c[2:] * _MIX[5]
        ids = np.concatenate([one[new:][alpha[new:]], two[max(new - 1, 0):][(alpha[:-1] | alpha[1:])[max(new - 1, 0):]], three[alpha[1:-1]]]) >> shift
        counts = np.bincount(ids, minlength=1 << bits)
        total = counts if total is None else total + counts
    if total is None:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    found = np.flatnonzero(total)
    return found, total[found]


def vector(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Log-scaled counts times inverse document frequency, of length one."""
    x = np.log1p(counts) * idf
    return x / (np.linalg.norm(x) or 1.0)


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], features: int, classes: int, epochs: int = 4, alpha: float = 2.0,
         beta: float = 1.0, l1: float = 0.01, l2: float = 0.001) -> np.ndarray:
    """Weights (features x classes); coordinates whose sum of gradients stays within l1 are exactly zero."""
    z, n, w = (np.zeros((features, classes)) for _ in range(3))
    for _ in range(epochs):
        for at, x, y in rows:
            p = _softmax(x @ w[at])
            p[y] -= 1
            g = np.outer(x, p)
            root = np.sqrt(n[at])
            n[at] += g * g
            grown = np.sqrt(n[at])
            z[at] += g - (grown - root) / alpha * w[at]
            w[at] = np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + grown) / alpha + l2))
    return w


def temperature(logits: np.ndarray, y: np.ndarray) -> float:
    """The divisor of the logits with the least log loss, from a grid between 1/4 and 4."""
    grid = 2.0 ** np.linspace(-2, 2, 33)
    loss = [-np.log(np.maximum(_softmax(logits / t)[np.arange(len(y)), y], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])


@dataclass(frozen=True)
class Model:
    labels: list[str]
    weights: np.ndarray
    idf: np.ndarray
    heat: float
    bits: int

    def predict(self, text: str | None) -> tuple[str, float]:
        """Language and calibrated probability; ``und`` and 0 without a letter or without any training row."""
        at, counts = grams(text, self.bits)
        if not len(at) or not self.labels:
            return UNKNOWN, 0.0
        p = _softmax(vector(counts, self.idf[at]) @ self.weights[at] / self.heat)
        best = int(p.argmax())
        return self.labels[best], float(p[best])


def _counted(docs: DataFrame, bits: int) -> DataFrame:
    """(feature, docs): document frequencies over all rows; each task sums its own first. Feature -1 counts the rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            for text in batch.column(0).to_pylist():
                df[grams(text, bits)[0]] += 1
                n += 1
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, -1)), pa.array(np.append(df[at], n))], names=["feature", "docs"])

    return docs.select("text").mapInArrow(run, "feature long, docs long").groupBy("feature").agg(F.sum("docs").alias("docs"))


def fit(rows: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_language: int = ROWS,
        bits: int = BITS) -> Model:
    """Fit on the rows with a language and a text.

    The sample has at most ``per_language`` rows of each language, those with the least
    hash of their id. What reaches the driver is bounded by the features, the languages
    and the sample; frequencies are counted over all rows.
    """
    spark = rows.sparkSession
    slim = rows.select(F.xxhash64(id_col, text_col).alias("h"), F.col(text_col).cast("string").alias("text"),
                       F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    frequency = {r["feature"]: r["docs"] for r in _counted(slim, bits).collect()}
    sizes = {r["lang"]: r["count"] for r in slim.groupBy("lang").count().collect()}
    labels = sorted(sizes)
    idf = np.full(1 << bits, np.log(1 + frequency.get(-1, 0)) + 1)
    for feature, n in frequency.items():
        if feature >= 0:
            idf[feature] = np.log((1 + frequency[-1]) / (1 + n)) + 1
    if not labels:
        return Model([], np.zeros((1 << bits, 0)), idf, 1.0, bits)
    # twice the wanted share of the hash range holds enough rows; the window then cuts exactly
    share = F.create_map(*[F.lit(v) for k in labels for v in (k, min(1.0, 2 * per_language / sizes[k] + 20 / sizes[k]))])
    near = slim.where(F.pmod("h", F.lit(1 << 40)) < F.element_at(share, F.col("lang")) * (1 << 40))
    near = near.withColumn("n", F.row_number().over(Window.partitionBy("lang").orderBy("h", "text"))).where(F.col("n") <= per_language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [grams(t, bits) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([f[0] for f in found], pa.list_(pa.int64())),
                                              pa.array([f[1] for f in found], pa.list_(pa.int64()))], names=["h", "lang", "at", "counts"])

    sample = near.select("h", "lang", "text").mapInArrow(run, "h long, lang string, at array<long>, counts array<long>").collect()
    number = {name: k for k, name in enumerate(labels)}
    data = [(np.array(r["at"]), vector(np.array(r["counts"]), idf[np.array(r["at"])]), number[r["lang"]])
            for r in sorted(sample, key=lambda r: (r["h"], r["lang"])) if r["at"]]
    aside = data[::ASIDE] if len(data) >= 10 * ASIDE else []
    weights = ftrl([row for k, row in enumerate(data) if not aside or k % ASIDE], 1 << bits, len(labels))
    heat = temperature(np.array([x @ weights[at] for at, x, _ in aside]), np.array([y for _, _, y in aside])) if aside else 1.0
    return Model(labels, weights, idf, heat, bits)


def predict(docs: DataFrame, model: Model, text_col: str = "text", out: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """All columns of the rows with the predicted language and its score; only the text is read for it."""
    taken = set(out) & set(docs.columns)
    if taken:
        raise ValueError(f"columns exist already: {sorted(taken)}")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shared.value.predict(t) for t in batch.column(batch.schema.get_field_index(text_col)).to_pylist()]
            yield batch.append_column(out[0], pa.array([f[0] for f in found], pa.string())).append_column(
                out[1], pa.array([f[1] for f in found], pa.float64()))

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    return docs.mapInArrow(run, f"{schema}, `{out[0]}` string, `{out[1]}` double")


def held_out(id_col: str = "doc_id", part: int = 1, of: int = 3) -> Column:
    """Whether the checksum of the id falls into the held-out part; false for a null id, which is not trained on either."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % of == part, F.lit(False))


def trained_on(id_col: str = "doc_id") -> Column:
    return F.col(id_col).isNotNull() & ~held_out(id_col)
