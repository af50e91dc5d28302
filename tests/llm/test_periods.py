"""Periodic runs against all periods and stretches of small texts."""

import hashlib
import re
import zlib
from fractions import Fraction

import numpy as np
import pandas as pd
import pytest

from tillweave.llm import periods, queries

ROOT = "/root/testdata/sf0.001"


def plain_runs(words, shortest=24):
    n, found = len(words), {}
    ids = np.unique(np.array(words, dtype=object), return_inverse=True)[1] if words else np.zeros(0, int)
    for q in range(1, n // 3 + 1):
        same = np.concatenate([[False], ids[q:] == ids[:-q], [False]])
        edge = np.flatnonzero(same[1:] != same[:-1])
        for start, stop in zip(edge[::2].tolist(), edge[1::2].tolist()):
            if stop - start + q >= max(shortest, 3 * q):
                found.setdefault((start, stop + q), q)  # the smallest period of a stretch comes first
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def test_query(spark):
    docs = pd.read_parquet(f"{ROOT}/documents.parquet").set_index("doc_id")
    got = queries.QUERIES["op13_periodic_runs"](spark, ROOT).toPandas().set_index("doc_id")
    assert sorted(got.index) == sorted(docs.index) and (got.n_runs > 0).sum() > 5
    for d, t in docs.text.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", t or "")
        n, h = len(words), zlib.crc32(str(d).encode())
        g = h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
        runs, r = plain_runs(words), got.loc[d]
        assert r.n_runs == len(runs)
        if runs:
            best = min(runs, key=lambda x: (-Fraction(x[1], x[2]), x[0], x[2]))
            assert (r.start, r.length, r.period, r.exponent_milli) == (*best, 1000 * best[1] // best[2])
        else:
            assert r[["start", "length", "period", "exponent_milli"]].isna().all()
        gone = {i for s, n, q in runs for i in range(s + q, s + n)}
        assert r.runs_sha256 == hashlib.sha256("".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()).hexdigest()
        assert r.collapsed_sha256 == hashlib.sha256(" ".join(w for i, w in enumerate(words) if i not in gone).encode()).hexdigest()


def texts(seed):
    """Periodic, nested, broken and overlapping stretches over few words."""
    r = np.random.default_rng(seed)
    out = []
    for _ in range(60):
        words = []
        for _ in range(int(r.integers(1, 7))):
            kind, k = int(r.integers(0, 4)), int(r.integers(2, 4))
            unit = [f"w{x}" for x in r.integers(0, k, int(r.integers(1, 40)))]
            if kind == 0:
                unit = ["a"] * int(r.integers(1, 30)) + ["b"] * int(r.integers(0, 3))
            if kind == 1:
                unit = unit[:3] * int(r.integers(1, 9)) + unit[3:5]
            words += (unit * 9)[:int(r.integers(1, 5 * len(unit) + 1))]
            if kind == 3:
                words += [f"u{x}" for x in r.integers(0, 999, int(r.integers(0, 20)))]
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(8))
def test_runs(seed):
    lists = texts(seed) + [[], ["a"] * 23, ["a"] * 24, ["a"] * 500, ["a", "b"] * 12, (["a"] * 7 + ["b"]) * 3, (["a"] * 11 + ["b"]) * 4 + ["a"] * 20]
    found = periods._search([[w.encode() for w in t] for t in lists], 24)
    for words, (start, length, q) in zip(lists, found):
        assert list(zip(start.tolist(), length.tolist(), q.tolist())) == plain_runs(words)


def test_binary_words():
    """Fibonacci and Thue-Morse words and all-equal words: many nested repetitions."""
    fib, morse = ["a", "a b"], "a"
    while len(fib[-1].split()) < 900:
        fib.append(fib[-1] + " " + fib[-2])
    while len(morse) < 1000:
        morse += morse.translate(str.maketrans("ab", "ba"))
    for words in (fib[-1].split(), list(morse), list(morse[:50] * 4), fib[-1].split()[:89] * 4):
        (start, length, q), = periods._search([[w.encode() for w in words]], 24)
        assert list(zip(start.tolist(), length.tolist(), q.tolist())) == plain_runs(words)


def test_range_successor():
    r = np.random.default_rng(0)
    for n in (1, 2, 37, 500):
        values = r.permutation(n)
        places = periods.Places(values)
        low = r.integers(0, n, 200)
        high = np.array([int(r.integers(a, n)) + 1 for a in low])
        bound = r.integers(0, n, 200)
        below = places.below(low, high, bound)
        for a, b, v, c in zip(low, high, bound, below):
            assert c == (values[a:b] < v).sum()
        some = below < high - low
        assert places.smallest(low[some], high[some], below[some]).tolist() == [
            min(x for x in values[a:b].tolist() if x >= v) for a, b, v in zip(low[some], high[some], bound[some])]


def test_rows(spark):
    """Null texts and ids, repeated rows, clashing columns, text ids, an empty table, blocks of texts."""
    rows = [(1, "x y " * 20, 1, 2), (1, "x y " * 20, 1, 2), (None, None, 1, 2), (None, "", 1, 2), (None, "z\t" * 30, 1, 2), (7, "q " * 30000, 3, 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, id long, runs long")
    got = sorted(((r["doc_id"] or 0, r["n_words"], [tuple(x) for x in r["runs"]], r["collapsed"]) for r in periods.periodic_runs(docs).collect()), key=str)
    assert got == sorted([(1, 40, [(0, 40, 2)], "x y")] * 2 + [(0, 0, [], "")] * 2 + [(0, 30, [(0, 30, 1)], "z"), (7, 30000, [(0, 30000, 1)], "q")], key=str)
    named = periods.periodic_runs(docs.selectExpr("cast(doc_id as string) as name", "text"), id_col="name").collect()
    assert sorted(r["n_words"] for r in named) == [0, 0, 30, 40, 40, 30000]
    assert periods.periodic_runs(docs.limit(0)).count() == 0
    with pytest.raises(ValueError):
        periods.periodic_runs(docs, shortest=10)
