"""The rows that the near-duplicate stage keeps, against plain fingerprints."""

import itertools

import numpy as np
import pandas as pd
import pytest
from test_against_brute_force import ROOT, classes, plain_simhash

from tillweave.llm import simhash


def plain_kept(rows):
    """One (id, text) of each component: smallest id, null last."""
    prints = {t: plain_simhash(t or "") for _, t in rows}
    group = classes(set(prints.values()), [(a, b) for a, b in itertools.combinations(set(prints.values()), 2) if (a ^ b).bit_count() <= 2])
    best = {}
    for d, t in rows:
        best.setdefault(group[prints[t]], []).append((d is None, d, t))
    return best


def test_documents(spark):
    docs = spark.read.parquet(f"{ROOT}/documents.parquet")
    got = sorted(r["doc_id"] for r in simhash.without_near_duplicates(docs).collect())
    plain = pd.read_parquet(f"{ROOT}/documents.parquet")
    assert got == sorted(min(x[1] for x in g) for g in plain_kept(list(zip(plain.doc_id.tolist(), plain.text))).values()) and len(got) < docs.count()


def test_rows(spark):
    """Null and repeated ids, equal rows, null and empty texts, clashing names, map columns."""
    a, b, c = ("the quick brown fox jumps over the lazy dog " + x for x in ("alpha beta gamma delta " * 9, "one two three four " * 9, "x " * 40))
    rows = [(None, a), (None, a), (5, a), (5, a), (5, b), (None, b), (None, c), (None, c), (9, None), (8, ""), (9, " \t"), (3, "single words"), (3, "other thing here")]
    data = [(d, t, {"k": k}, k, k) for k, (d, t) in enumerate(rows)]
    docs = spark.createDataFrame(data, "doc_id long, text string, key map<string,int>, row int, h1 int").repartition(3)
    got = simhash.without_near_duplicates(docs)
    assert got.schema == docs.schema
    kept = [(r["doc_id"], r["text"]) for r in got.collect()]
    groups = plain_kept(rows)
    assert len(kept) == len(groups)
    for members in groups.values():
        first = min(members, key=lambda x: (x[0], x[1] or 0))
        mine = [k for k in kept if any(k == m[1:] for m in members)]
        assert len(mine) == 1 and (mine[0][0] is None, mine[0][0]) == first[:2]
    assert simhash.without_near_duplicates(docs.limit(0)).count() == 0


def test_posting_lists_cover_all_pairs():
    """Any one or two bytes lie in one triple; a pair within the bits has the guaranteed tally, and the tally rejects others."""
    for most, lists in ((1, 3), (2, 11)):
        made = simhash.triples(most)
        assert len(made) == lists and all(any(set(pair) <= set(t) for t in made) for pair in itertools.combinations(range(8), most))
    assert simhash.tally(np.array([0, 1, 3, 257, 0x010101, 0xFF00FF], dtype=np.uint64)).tolist() == [8, 7, 7, 6, 5, 6]


@pytest.mark.parametrize("most", [1, 2])
def test_links_against_all_pairs(spark, most):
    """Fingerprints around a few centres, more of them than a short list holds: the classes are those of all pairs."""
    r = np.random.default_rng(most)
    prints = set()
    for centre in r.integers(-2**63, 2**63, 30).tolist():
        for _ in range(int(r.choice([3, 10, 60]))):
            x = centre & (2**64 - 1)
            for bit in r.integers(0, [64, 24, 8][centre % 3], int(r.integers(0, 5))).tolist():
                x ^= 1 << bit
            prints.add(x - 2**64 if x >= 2**63 else x)
    pairs = [(a, b) for a, b in itertools.combinations(sorted(prints), 2) if ((a ^ b) & (2**64 - 1)).bit_count() <= most]
    found = [tuple(x) for x in simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long").repartition(5), most).collect()]
    assert {tuple(sorted(x)) for x in found} <= classes_pairs(prints, pairs) and classes(dict.fromkeys(prints), found) == classes(dict.fromkeys(prints), pairs)


def classes_pairs(prints, pairs):
    """All pairs within a class."""
    of = classes(dict.fromkeys(prints), pairs)
    return {(a, b) for a, b in itertools.combinations(sorted(prints), 2) if of[a] == of[b]}
