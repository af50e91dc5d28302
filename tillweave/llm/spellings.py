"""Spelling variants of a corpus's words by reduced-alphabet neighbourhoods.

Letters are hashed to a few symbols. For each word the full one-edit neighbourhood of its
reduced form is generated (the form itself, all deletions, replacements and insertions of
a symbol) and joined with the reduced vocabulary; every pair that meets is verified on the
original strings. Reduction keeps edits: words one edit apart have reduced forms at most
one edit apart, so no pair is missed.

Words of m letters take as many symbols as keep their reduced forms rare among the words
they can meet. Two words meet in the alphabet of the shorter one, so the vocabulary has a
key per word for partners of its length or longer, and one for shorter partners. A key is
a polynomial hash of the reduced form, which all edits of a word share prefixes of; that
two forms may have one key only costs a verification.

Neighbours that no word of the vocabulary can have are left out where they are generated,
by a bitmap of the vocabulary's keys that has the same size for every corpus. All joins are
sort-merge joins: written words are small on file and large in the driver's memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .steps import Steps

LETTERS = r"[A-Za-zÀ-ÿ]+"
#: Reduced forms that there are at least for each word that may have one.
ROOM = 16
#: Bits of the bitmap of keys: 16 MB.
BITS = 1 << 27
#: Keys that a task holds at once.
_KEYS = 1 << 21
_BASE = 0x9E3779B97F4A7C15  # odd, so that shifts by a place can be undone
_ALL = (1 << 64) - 1
_BACK = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well mixed bits of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def symbols_for(counts: dict[int, int], room: int = ROOM, most: int = 90) -> dict[int, int]:
    """Symbols of the alphabet in which words of m letters meet those of m and m + 1: at least 2, at most the letters there are."""
    out = {}
    for m in {*counts, *(n - 1 for n in counts)}:
        words, s = counts.get(m, 0) + counts.get(m + 1, 0), 2
        while s < most and m * np.log(s) < np.log(room * max(words, 1)):
            s += 1
        out[m] = s
    return out


class Reduced:
    """Keys of the reduced forms of words of one length, in the alphabet of words of ``short`` letters."""

    def __init__(self, codes: np.ndarray, short: int, symbols: int):
        """codes: a row of code points per word."""
        self.n, self.length = codes.shape
        self.short, self.symbols = short, symbols
        self.values = _mixed(np.arange(symbols, dtype=np.uint64) + np.uint64(1))
        self.form = ((codes.astype(np.uint64) * np.uint64(2654435761) >> np.uint64(16)) % np.uint64(symbols)).astype(np.int64)
        powers = np.ones(self.length + 2, dtype=np.uint64)
        powers[1:] = _BASE
        self.powers = np.cumprod(powers)
        self.terms = self.values[self.form] * self.powers[:self.length]
        self.before = np.zeros((self.n, self.length + 1), dtype=np.uint64)
        np.cumsum(self.terms, axis=1, out=self.before[:, 1:])

    def _key(self, hashes: np.ndarray, length: int) -> np.ndarray:
        return _mixed(hashes + np.uint64((self.short + length) * 0xD6E8FEB86659FD93 & _ALL)).view(np.int64)

    def own(self) -> np.ndarray:
        return self._key(self.before[:, -1], self.length)

    def deletions(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, key) of the forms with one symbol less, each form once."""
        whole = self.before[:, -1:]
        keys = self.before[:, :-1] + (whole - self.before[:, 1:]) * np.uint64(_BACK)
        fresh = np.ones((self.n, self.length), dtype=bool)
        fresh[:, 1:] = self.form[:, 1:] != self.form[:, :-1]  # in a run of one symbol any deletion gives the same
        word, at = np.nonzero(fresh)
        return word, self._key(keys[word, at], self.length - 1)

    def replacements(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, key) of the form itself and those with another symbol at one place."""
        words, keys = [np.arange(self.n)], [self.before[:, -1]]
        for c in range(self.symbols):
            word, at = np.nonzero(self.form != c)
            words.append(word)
            keys.append(self.before[word, -1] - self.terms[word, at] + self.values[c] * self.powers[at])
        return np.concatenate(words), self._key(np.concatenate(keys), self.length)

    def insertions(self) -> tuple[np.ndarray, np.ndarray]:
        """(word, key) of the forms with one symbol more, each form once."""
        words, keys = [], []
        for c in range(self.symbols):
            fresh = np.ones((self.n, self.length + 1), dtype=bool)
            fresh[:, :-1] = self.form != c  # before an equal symbol it gives the same as behind it
            word, at = np.nonzero(fresh)
            words.append(word)
            head = self.before[word, at]
            keys.append(head + self.values[c] * self.powers[at] + (self.before[word, -1] - head) * np.uint64(_BASE))
        return np.concatenate(words), self._key(np.concatenate(keys), self.length + 1)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, code points) of words of one length, in blocks that keep their keys within bounds."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    order = np.argsort(lengths, kind="stable")
    for length in np.unique(lengths).tolist():
        places = order[np.searchsorted(lengths[order], length):np.searchsorted(lengths[order], length, "right")]
        step = max(1, _KEYS // (200 * length))
        for k in range(0, len(places), step):
            part = places[k:k + step]
            text = "".join([words[i] for i in part.tolist()])
            yield part, np.frombuffer(text.encode("utf-32-le"), "<u4").reshape(-1, length)


def near_pairs(vocabulary: DataFrame, steps: Steps, room: int = ROOM) -> DataFrame:
    """(word, near, n): each word with every word of the vocabulary at exactly one edit, and that word's n. Reads word, n."""
    spark = vocabulary.sparkSession
    counts = {r["m"]: r["n"] for r in vocabulary.groupBy(F.length("word").alias("m")).agg(F.count("*").alias("n")).collect()}
    symbols = symbols_for(counts, room)

    def own_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for places, codes in _by_length(batch.column(0).to_pylist()):
                length, rows = codes.shape[1], batch.take(pa.array(places))
                for m in (length - 1, length):
                    yield pa.RecordBatch.from_arrays([pa.array(Reduced(codes, m, symbols[m]).own()), *rows.columns], names=["key", "near", "n"])

    keyed = steps.write(vocabulary.select("word", "n").mapInArrow(own_keys, "key long, near string, n long"), "keys")
    spot = F.expr(f"(key & {BITS - 1}L) + 1")
    parts = keyed.groupBy(F.bitmap_bucket_number(spot).alias("at")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(spot)).alias("bits"))
    bitmap = np.zeros(BITS // 8, dtype=np.uint8)
    for r in parts.collect():  # 4,096 parts of 4 kB
        raw = np.frombuffer(r["bits"], dtype=np.uint8)
        bitmap[(r["at"] - 1) * 4096:(r["at"] - 1) * 4096 + len(raw)] = raw
    known = spark.sparkContext.broadcast(bitmap)

    def around(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = known.value
        for batch in batches:
            for places, codes in _by_length(batch.column(0).to_pylist()):
                length, names = codes.shape[1], batch.column(0).take(pa.array(places))
                here = Reduced(codes, length, symbols[length])
                for kind in (here.replacements, here.insertions, Reduced(codes, length - 1, symbols[length - 1]).deletions):
                    word, key = kind()
                    at = key & (BITS - 1)
                    there = (bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
                    yield pa.RecordBatch.from_arrays([pa.array(key[there]), names.take(pa.array(word[there]))], names=["key", "word"])

    neighbours = vocabulary.select("word").mapInArrow(around, "key long, word string")
    # Spark sizes the neighbours by the vocabulary's file, though each word has hundreds: they must never be broadcast
    met = neighbours.hint("merge").join(keyed.hint("merge"), "key").where("word != near and abs(length(word) - length(near)) <= 1")
    return met.where("levenshtein(word, near, 1) = 1").select("word", "near", "n")


def word_counts(docs: DataFrame, changed: Column | None = None, id_col: str = "doc_id", text_col: str = "text", shortest: int = 5,
                least: int = 3, pattern: str = LETTERS) -> DataFrame:
    """(word, n) of the corpus: maximal runs of letters, A-Z lowered, with at least ``shortest`` letters and ``least`` occurrences.

    ``changed`` may rewrite an occurrence; it reads the columns ``id`` and ``word``. A
    null text has no words. Counts are added up in each task before they are shuffled.
    """
    runs = docs.select(F.col(id_col).alias("id"), F.explode(F.regexp_extract_all(F.col(text_col).cast("string"), F.lit(pattern), F.lit(0))).alias("run"))
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    lowered = F.when(F.length("run") == F.octet_length("run"), F.lower("run")).otherwise(F.translate("run", upper, upper.lower()))
    words = runs.select("id", lowered.alias("word"))
    if changed is not None:
        words = words.select(changed.alias("word"))
    return words.where(F.length("word") >= shortest).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least)


def variants(vocabulary: DataFrame, room: int = ROOM, times: int = 2) -> DataFrame:
    """word, n, n_near, form, form_n, root for each row of a vocabulary (word unique, n).

    Two words are near at exactly one inserted, deleted or replaced letter. A word's form
    is its near word of largest n (ties: smallest in code-point order) if that n is at
    least ``times`` its own, else null; root follows forms to the last. Words with equal n
    never name each other for times > 1, so chains end, and their length grows with the
    logarithm of n; each round doubles the steps that are followed. Null and empty words
    take no part, other columns are ignored, an empty vocabulary gives no rows.
    """
    steps = Steps(vocabulary.sparkSession)
    words = steps.write(vocabulary.where("word != ''").select("word", F.col("n").cast("long")), "vocabulary")
    pairs = near_pairs(words, steps, room)
    best = pairs.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("n")).alias("less"), F.col("near").alias("near"))).alias("best"))
    formed = F.col("best.less") <= -times * F.col("n")
    known = steps.write(words.join(best.hint("merge"), "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(formed, F.col("best.near")).alias("form"),
        F.when(formed, -F.col("best.less")).alias("form_n")), "forms")
    reached = steps.write(known.where("form is not null").select("word", F.col("form").alias("to")), "reached")
    while True:
        step = reached.join(reached.select(F.col("word").alias("to"), F.col("to").alias("next")).hint("merge"), "to", "left")
        new = steps.write(step.select("word", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "reached")
        more = new.where("moved").limit(1).count()
        reached = new.select("word", "to")
        if not more:
            break
    return known.join(reached.hint("merge"), "word", "left").select("word", "n", "n_near", "form", "form_n", F.coalesce("to", "word").alias("root"))
