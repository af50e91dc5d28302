"""Power-of-two packing against the library's tokenizer, on whole tables and odd rows."""

import zlib

import numpy as np
import pandas as pd
import pytest
from tokenizers import Tokenizer

from tillweave.llm import binary, queries

ROOT = "/root/testdata/sf0.001"


@pytest.mark.parametrize("size", [1, 2, 8, 2048])
def test_cuts(size):
    for n in range(0, 5 * size + 3):
        parts = binary.cuts(n, size)
        assert [a for a, _ in parts] == list(np.cumsum([0] + [x for _, x in parts])[:len(parts)]) and sum(x for _, x in parts) == n
        assert all(x & (x - 1) == 0 and x <= size for _, x in parts)
        assert len(parts) == n // size + (n % size).bit_count()


def test_query(spark):
    docs = pd.read_parquet(f"{ROOT}/documents.parquet").set_index("doc_id")
    got = queries.QUERIES["op11_power_of_two_packing"](spark, ROOT).toPandas()
    plain = Tokenizer.from_file(queries.TOKENIZER)
    ids = {d: plain.encode(t, add_special_tokens=False).ids + [1] for d, t in docs.text.items()}
    assert got.groupby("doc_id").length.sum().to_dict() == {d: len(v) for d, v in ids.items()}
    for r in got.itertuples():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32 and r.doc_tokens == len(ids[r.doc_id])
    for _, g in got.sort_values("start").groupby("doc_id"):
        assert g.start.tolist() == [0, *np.cumsum(g.length)[:-1]]
    assert sorted(got.sequence_id) == list(range(len(got))) and (got.offset == 0).all()
    for _, g in got.groupby("length"):
        assert sorted(g.slot) == list(range(len(g)))
    assert ((got.length & (got.length - 1)) == 0).all() and got.length.max() <= 2048


def test_rows(spark):
    """Null texts and ids, repeated rows, clashing columns, an empty table."""
    rows = [(1, "a b c", 1, 2), (1, "a b c", 1, 2), (None, None, 1, 2), (None, "", 3, 4), (5, "word " * 5000, 5, 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, task int, length long").repartition(3)
    got = binary.pack_documents(docs, queries.TOKENIZER, 8, with_ids=True).toPandas()
    assert sorted(got.sequence_id) == list(range(len(got)))
    assert sorted(got.length[got.doc_id == 1]) == [4, 4] and sorted(got.length[got.doc_id.isna()]) == [1, 1]
    long = got[got.doc_id == 5].sort_values("start")
    assert long.length.tolist() == [8] * 625 + [1] and all(len(x) == 4 * n for x, n in zip(got.ids, got.length))
    blocks = binary.batches(binary.pack_documents(docs, queries.TOKENIZER, 8, with_ids=True), 64).collect()
    assert sum(len(b["ids"]) for b in blocks) == len(got) and max(len(b["ids"]) * b["length"] for b in blocks) == 64
    assert binary.pack_documents(docs.limit(0), queries.TOKENIZER).count() == 0
    with pytest.raises(ValueError):
        binary.decompose(docs, queries.TOKENIZER, 12)
