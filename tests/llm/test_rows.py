"""Rows that lack or repeat an id."""

import hashlib

from tillweave.llm import substrings

DOC = "doc_id long, text string"
LINE = " ".join(f"w{k}" for k in range(60))


def found(df):
    return sorted(((r["doc_id"], r["text"], r["n_words"], r["n_removed"]) for r in substrings.without_repeats(df).collect()), key=repr)


def test_passages_of_texts_with_equal_short_checksums(spark):
    long, short = f"{LINE} a169309", " ".join(LINE.split()[:24]) + " b9355"
    assert len({hashlib.blake2b(t.encode(), digest_size=4).digest() for t in (long, short)}) == 1
    got = found(spark.createDataFrame([(None, long), (None, short), (7, LINE)], DOC).repartition(3))
    taken = {t: (n, gone) for _, t, n, gone in got}
    # whichever of the two is first keeps all its words
    assert taken[LINE] == (60, 60) and (taken[long], taken[short]) in [((61, 0), (25, 24)), ((61, 24), (25, 0))]


def test_passages_of_equal_rows(spark):
    """They are one document: none of them is an earlier copy for another."""
    data = [(None, LINE)] * 4 + [(3, f"before {LINE}")] * 3 + [(4, LINE + " x")] + [(5, "short")] * 2
    got = found(spark.createDataFrame(data, DOC).repartition(4))
    want = [(None, LINE, 60, 0)] * 4 + [(3, f"before {LINE}", 61, 60)] * 3 + [(4, LINE + " x", 61, 60)] + [(5, "short", 1, 0)] * 2
    assert got == sorted(want, key=repr)
    segments = substrings.candidates(substrings._rows(spark.createDataFrame(data, DOC), "doc_id", "text", substrings.Steps(spark)), 20, 6, substrings.Steps(spark))
    assert segments.count() == segments.distinct().count()
