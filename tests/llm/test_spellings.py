"""Spelling variants against all pairs of a small vocabulary and against plain counting."""

import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest

from tillweave.llm import queries, spellings
from tillweave.llm.steps import Steps

ROOT = "/root/testdata/sf0.001"


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if a == b or len(b) - len(a) > 1:
        return False
    k = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def plain(counts):
    gone = {}
    for w in counts:  # words one edit apart share a word with one letter less, or are that word
        for v in {w, *(w[:k] + w[k + 1:] for k in range(len(w)))}:
            gone.setdefault(v, set()).add(w)
    near = {w: set() for w in counts}
    for group in gone.values():
        for a in group:
            near[a] |= {b for b in group if b not in near[a] and one_edit(a, b)}
    form = {}
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 2 * n else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return {w: (n, len(near[w]), form[w], form[w] and counts[form[w]], root(w)) for w, n in counts.items()}


def test_query(spark):
    docs = pd.read_parquet(f"{ROOT}/documents.parquet")
    counts = Counter()
    for d, t in zip(docs.doc_id, docs.text):
        for run in re.findall("[A-Za-zÀ-ÿ]+", t):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            h = zlib.crc32(f"{d}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    want = plain({w: n for w, n in counts.items() if len(w) >= 5 and n >= 3})
    got = queries.QUERIES["op12_spelling_variants"](spark, ROOT).collect()
    assert {r["word"]: (r["n"], r["n_near"], r["form"], r["form_n"], r["root"]) for r in got} == want and len(got) == len(want) > 500
    assert any(r["form"] for r in got)


@pytest.mark.parametrize("seed,letters", [(0, "ab"), (1, "abcdé"), (2, "abcdefghijklmnopqrstuvwxyzàÿ")])
def test_variants(spark, seed, letters):
    r = np.random.default_rng(seed)
    words = {"".join(r.choice(list(letters), int(r.integers(1, 9)))) for _ in range(700)} | {"x" * 300, "x" * 301, "x" * 299 + "y", "×÷a"}
    for w in list(words)[:80]:
        k = int(r.integers(0, len(w)))
        words |= {w[:k] + w[k + 1:], w[:k] + letters[0] + w[k:], w[:k] + letters[-1] + w[k + 1:]}
    counts = {w: int(2 ** r.integers(0, 12)) for w in sorted(words - {""})}
    want = plain(counts)
    df = spark.createDataFrame([*((w, n, "k", 0) for w, n in counts.items()), (None, 5, "k", 0), ("", 7, "k", 0)], "word string, n int, key string, near int").repartition(3)
    got = spellings.variants(df).collect()
    assert {x["word"]: (x["n"], x["n_near"], x["form"], x["form_n"], x["root"]) for x in got} == want and len(got) == len(want)
    assert spellings.variants(df.limit(0)).count() == 0


def test_neighbourhoods_are_full():
    """All forms at one edit of the reduced word, each once."""
    for word in ("aabca", "zzzzz", "éa"):
        for symbols in (2, 3, 5):
            n = len(word)
            codes = np.array([[ord(c) for c in word]], dtype=np.uint32)
            here = spellings.Reduced(codes, n, symbols)
            s = here.form[0].tolist()

            def key(form):
                other = spellings.Reduced(np.zeros((1, len(form)), np.uint32), min(n, len(form)), symbols)
                other.before[0, -1] = sum(int(other.values[c]) * int(p) for c, p in zip(form, other.powers)) % (1 << 64)
                return int(other.own()[0])

            want = {key(s[:k] + [c] + s[k + 1:]) for k in range(n) for c in range(symbols)}
            assert sorted(here.replacements()[1].tolist()) == sorted(want)
            want = {key(s[:k] + [c] + s[k:]) for k in range(n + 1) for c in range(symbols)}
            assert sorted(here.insertions()[1].tolist()) == sorted(want)
            want = {key(s[:k] + s[k + 1:]) for k in range(n)}
            assert sorted(spellings.Reduced(codes, n - 1, symbols).deletions()[1].tolist()) == sorted(want)


def test_bitmap_drops_no_pair(spark):
    """Few keys reach the join, and with one symbol fewer or more room the pairs are the same."""
    words = [(f"{a}{b}word{c}", 1) for a in "abcdef" for b in "ghijk" for c in "xyz"]
    df = spark.createDataFrame(words, "word string, n long")
    found = [{(r["word"], r["near"]) for r in spellings.near_pairs(df, Steps(spark), room).collect()} for room in (1, 16, 10 ** 6)]
    want = {(a, b) for a, _ in words for b, _ in words if one_edit(a, b)}
    assert found == [want] * 3


def test_rows(spark):
    """Null texts and ids, empty and repeated rows, extra columns."""
    rows = [(1, "Apple apple APPLE aple", "w"), (1, "Apple apple APPLE aple", "w"), (None, None, "w"), (None, "", "w"), (2, "aple Àpple", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, word string")
    got = {r["word"]: r["n"] for r in spellings.word_counts(docs, shortest=1, least=1).collect()}
    assert got == {"apple": 6, "aple": 3, "Àpple": 1}
    assert spellings.word_counts(docs.limit(0)).count() == 0


def test_neighbours_are_not_broadcast_however_small_the_vocabulary_is_on_file(spark):
    words = spark.createDataFrame([(a + b + c + "letters", 1 + k) for a in "abcd" for b in "efgh" for k, c in enumerate("ijkl")], "word string, n long")
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) > 0
    for found in (spellings.near_pairs(words, Steps(spark)), spellings.variants(words)):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
        assert found.count()
