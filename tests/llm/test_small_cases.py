"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing extra columns, for every operator."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tillweave.llm import decontaminate, extract, langid, packing, queries, rollup, sharding, simhash, substrings, vectors, warc

TOKENIZER = public_tokenizers.path("word_bpe_49k.json")
DOC = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"word{i % 977} flows{i % 131}" for i in range(60_000))


@pytest.fixture(scope="module")
def odd(spark):
    """A null id, null, empty and wordless texts, a very long text, repeated rows and repeated ids."""
    rows = [(None, "no id here", "en", "a", 1), (1, None, "en", "a", None), (2, "", None, None, 0), (3, " \t\n ", "en", "a", 3),
            (4, LONG, "en", "a", len(LONG)), (5, "twice the same row", "en", "b", 1), (5, "twice the same row", "en", "b", 1),
            (6, "same id first", "en", "b", 1), (6, "same id second", "fr", "b", 1), (7, "12345 !!! 678", "en", "b", 1)]
    return spark.createDataFrame(rows, DOC)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DOC)


@pytest.fixture(scope="module")
def clashing(odd):
    """Columns with names that operators use inside."""
    names = "id size place arc rank salt length piece fp root node component first key unit label cell block item_id page html".split()
    return odd.withColumns({n: F.lit("x") for n in names})


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def test_sharding(odd, none, clashing):
    got = sharding.assign_shards(odd, 3)
    assert got.count() == 10 and sharding.assign_shards(none, 3).count() == 0
    assert rows(got, "doc_id", "size", "text_crc32", "shard", "slot") == rows(sharding.assign_shards(clashing, 3), "doc_id", "size", "text_crc32", "shard", "slot")
    by = {}
    for shard, slot in rows(got, "shard", "slot"):
        by.setdefault(shard, []).append(slot)
    assert sorted(map(len, by.values())) == [3, 3, 4] and all(sorted(s) == list(range(len(s))) for s in by.values())
    assert (1, 1, 0) in rows(got, "doc_id", "size", "text_crc32") and (None, 11, zlib.crc32(b"no id here")) in rows(got, "doc_id", "size", "text_crc32")
    with pytest.raises(ValueError):
        sharding.assign_shards(odd, 0)


def test_packing(odd, none, clashing):
    got = packing.pack_documents(odd, TOKENIZER)
    assert packing.pack_documents(none, TOKENIZER).count() == 0
    assert rows(got, "doc_id", "piece", "length") == rows(packing.pack_documents(clashing, TOKENIZER), "doc_id", "piece", "length")
    short = [r for r in got.collect() if r["doc_id"] in (1, 2, 3)]
    assert [r["length"] for r in short] == [1, 1, 1]
    long = sorted((r for r in got.collect() if r["doc_id"] == 4), key=lambda r: r["piece"])
    assert [r["start"] for r in long] == [2048 * k for k in range(len(long))] and {r["length"] for r in long[:-1]} == {2048}


def test_language(odd, none, clashing):
    model = langid.fit(odd)
    assert model.labels == ["en", "fr"]
    found = dict(rows(langid.predict(odd, model), "doc_id", "lang_pred"))
    assert found[1] == found[2] == found[3] == found[7] == "und" and found[4] in model.labels
    assert langid.predict(clashing, model).count() == 10 and langid.predict(none, model).count() == 0
    empty = langid.fit(none)
    assert {r["lang_pred"] for r in langid.predict(odd, empty).collect()} == {"und"}
    assert not [r for r in odd.select(langid.held_out().alias("h")).collect() if r["h"] is None]
    with pytest.raises(ValueError):
        langid.predict(odd.withColumn("score", F.lit(1)), model)


def test_simhash(odd, none, clashing):
    got = simhash.near_duplicates(odd)
    assert got.count() == 10 and simhash.near_duplicates(none).count() == 0
    assert rows(got, "doc_id", "fingerprint", "component_id") == rows(simhash.near_duplicates(clashing), "doc_id", "fingerprint", "component_id")
    wordless = [r for r in got.collect() if r["doc_id"] in (1, 2, 3)]
    assert {(r["fingerprint"], r["component_id"]) for r in wordless} == {("0" * 16, 1)}


def test_warc(spark, tmp_path):
    schema = "page_id long, url string, html string, digest string, bytes string, refers_to string, key string"
    body = "<p>a\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\nü</p>"
    data = [(1, "http://a/", body), (2, "http://a/\r\nx", body), (3, None, None), (4, "", ""), (5, "http://b/", "x" * 300_000), (6, "http://c/", "one"),
            (6, "http://c/", "one"), (None, "http://d/", "one"), (7, "http://e/", "\r\n\r\n")]
    pages = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in data], schema)
    warc.write_warc(pages, f"{tmp_path}/a", per_file=2)
    records = warc.read_warc(spark, f"{tmp_path}/a", payload=True).cache()
    assert records.count() == 3 * len(data)
    got = warc.transactions(records).select("response.*", "metadata.fields", F.col("request.target_uri").alias("asked")).collect()
    assert len(got) == len(data) and all(r["digest_ok"] in (None, True) for r in got)
    pages_of = sorted((r["fields"].get("page") or "", r["record_type"], r["refers_to"]) for r in got)
    assert pages_of == [("", "revisit", "6"), ("1", "revisit", "2"), ("2", "response", None), ("3", "revisit", "4"), ("4", "response", None),
                        ("5", "response", None), ("6", "response", None), ("6", "response", None), ("7", "response", None)]
    payloads = {r["fields"].get("page"): bytes(r["payload"]).decode() for r in got if r["payload"] is not None}
    assert payloads["2"] == body and payloads["5"] == "x" * 300_000 and payloads["7"] == "\r\n\r\n" and payloads["4"] == ""
    warc.write_warc(pages.limit(0), f"{tmp_path}/b")
    assert warc.transactions(warc.read_warc(spark, f"{tmp_path}/b")).count() == 0


def test_decontamination(spark, odd, none, clashing):
    items = spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog today"), (2, None), (3, "short"), (None, "x" * 40), (4, "")], "item_id long, text string")
    assert decontaminate.contaminated(odd, items).count() == 0
    docs = spark.createDataFrame([(1, "So: the quick, brown fox jumps over a lazy dog today!"), (1, "So: the quick, brown fox jumps over a lazy dog today!"), (2, "nothing"), (3, None)], "doc_id long, text string")
    assert rows(decontaminate.contaminated(docs, items, rate=0.1), "doc_id", "item_id", "distance") == [(1, 1, 3)] * 2
    assert rows(decontaminate.without_leaks(docs, items, rate=0.1), "doc_id") == [(2,), (3,)]
    assert decontaminate.contaminated(docs, items.limit(0)).count() == 0 and decontaminate.without_leaks(none, items).count() == 0
    assert decontaminate.without_leaks(clashing, items).columns == clashing.columns
    # short items as they are, on word bounds; null ids stay; the stage leaves short ones alone
    short = spark.createDataFrame([(1, "capital of"), (2, "zz"), (None, "the quick"), (4, "apital of"), (5, "...")], "item_id long, text string")
    text = spark.createDataFrame([(1, "what is the capital of"), (2, "zz"), (3, "the capital officer, the quick")], "doc_id long, text string")
    assert rows(decontaminate.contaminated(text, short), "doc_id", "item_id", "distance", "start") == [(1, 1, 0, 12), (2, 2, 0, 0), (3, None, 0, 20)]
    assert decontaminate.contaminated(text, short, size=1).count() == 3
    assert decontaminate.without_leaks(text, short).count() == 3 and rows(decontaminate.without_leaks(text, short, least=1, size=1), "doc_id") == []
    # one item a pass gives the same
    many = items.union(spark.createDataFrame([(9, "So the quick brown fox jumps over")], "item_id long, text string"))
    assert rows(decontaminate.contaminated(docs, many, rate=0.1, size=1), "doc_id", "item_id") == rows(decontaminate.contaminated(docs, many, rate=0.1), "doc_id", "item_id")


def test_extraction(spark):
    page = "<html><body><nav><a>menu</a></nav><article><h1>T{0}</h1><p>one &amp; <b>two<p>x{0}  y<script>no</script></article><div class=ad>buy</div></body></html>"
    data = [(1, "http://h.example/1", page.format(1)), (1, "http://h.example/1", page.format(1)), (2, "http://h.example/2", page.format(2)), (3, None, None),
            (4, "nonsense", ""), (None, "http://h.example/3", "<" * 50), (5, "http://deep.example/", "<div>" * 5000 + "deep"), (6, "http://long.example/", "<article>" + "<p>w</p>" * 20_000 + "</article>")]
    pages = spark.createDataFrame([(*r, "x", "x") for r in data], "page_id long, url string, html string, host string, rules string")
    assert extract.Reader("[null,null]").text('<article><p data-id="ad-12" data-hidden="false">kept</p><p class="ad">gone</p></article>') == "kept"
    assert extract.Reader("[null,null]").text('<body><form id="all"><article><p>in a form</p><form class="search"><p>not this</p></form></article></form>') == "in a form"
    got = extract.main_text(pages)
    found = rows(got, "page_id", "text")
    assert len(found) == len(data)
    assert found.count((1, "T1\none & two\nx1 y")) == 2 and (2, "T2\none & two\nx2 y") in found and (3, "") in found and (4, "") in found
    assert (5, "deep") in found and (6, "\n".join(["w"] * 20_000)) in found
    assert extract.main_text(pages.limit(0)).count() == 0


def test_passages(odd, none):
    extra = odd.withColumns({n: F.lit("x") for n in "anchor at n words h1 h2 first size d t".split()})
    got = substrings.without_repeats(odd)
    assert rows(got, "doc_id", "n_words", "n_removed") == rows(substrings.without_repeats(extra), "doc_id", "n_words", "n_removed")
    found = dict(((r["doc_id"], r["text"]), (r["n_words"], r["n_removed"], r["kept"])) for r in got.collect())
    assert found[1, None] == (0, 0, "") and found[3, " \t\n "] == (0, 0, "") and found[5, "twice the same row"] == (4, 0, "twice the same row")
    assert found[4, LONG][0] == 120_000 and substrings.without_repeats(none).count() == 0
    with pytest.raises(ValueError):
        substrings.without_repeats(odd.withColumn("kept", F.lit(1)))


def test_vectors(spark):
    nan = float("nan")
    data = [(0, [1.0, 0.0], 1), (1, [2.0, 0.0], 1), (2, [1.0, 0.1], 1), (3, [1.0, 0.0], 2), (4, [0.0, 0.0], 1), (5, None, 1), (6, [1.0, None], 1),
            (7, [nan, 1.0], 1), (8, [1.0, 0.0], None), (9, [1.0, 0.0, 0.0], 1), (10, [], 1), (10, [], 1), (11, [1e300, 1e299], 1), (None, [5.0, 5.0], 3)]
    df = spark.createDataFrame([(*r, "x", "x") for r in data], "vec_id long, embedding array<double>, label int, key string, unit string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in vectors.near_duplicates(df).collect()}
    assert got[0] == (3, 0, True) and got[1] == (3, 0, False) and got[2] == (3, 0, False) and got[11] == (3, 0, False)
    assert all(got[k] == (0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, None))
    assert vectors.near_duplicates(df).count() == len(data) and vectors.near_duplicates(df.limit(0)).count() == 0


def test_vectors_that_share_an_id(spark):
    rows_ = [(1, [1.0, 0.0], "a"), (1, [1.0, 0.0], "b"), (1, [0.0, 1.0], "a"), (2, [1.0, 0.01], "a"), (5, [0.0, 2.0], "b"), (4, [0.01, 1.0], "b")]
    got = vectors.near_duplicates(spark.createDataFrame(rows_, "vec_id long, embedding array<double>, label string"))
    assert rows(got, "vec_id", "n_links", "component_id") == sorted([(1, 1, 1), (1, 0, 1), (1, 0, 1), (2, 1, 1), (4, 1, 4), (5, 1, 4)], key=repr)


def test_rollup_of_documents(spark, tmp_path):
    """Null texts and ids and repeated rows: one row of each text moves on to the new tokenizer, nothing stays behind."""
    spark.createDataFrame([(1, "a b", "en", "s"), (2, None, "en", "s"), (3, "c", "en", "s"), (None, "a b", "en", "s"), (3, "c", "en", "s"), (None, "d", None, "s"), (None, "d", None, "s")],
                          "doc_id long, text string, lang string, source string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["op9_token_rollup"](spark, str(tmp_path))
    assert rows(got, "lang", "tokenizer", "n_docs", "n_bytes") == sorted([("en", "word-bpe-49k", 3, 4), (None, "word-bpe-49k", 1, 1)], key=repr)


def test_rollup(spark, tmp_path):
    schema = "op string, source string, lang string, tokenizer string, n_tokens long, n_bytes long, old_source string, old_lang string, old_tokenizer string, old_tokens long, old_bytes long"
    first = spark.createDataFrame([("insert", "a", None, "v1", 5, 9, *[None] * 5), ("insert", "a", None, "v1", 5, 9, *[None] * 5), ("insert", "b", "en", "v1", None, None, *[None] * 5),
                                   ("what", "b", "en", "v1", 7, 7, *[None] * 5)], schema)
    second = spark.createDataFrame([("delete", "b", "en", "v1", None, None, *[None] * 5), ("revise", "a", "fr", "v2", 4, 9, "a", None, "v1", 5, 9)], schema)
    store = str(tmp_path)
    assert rollup.commit(first, store, "1") and not rollup.commit(second, store, "1") and rollup.commit(second, store, "2")
    want = [("a", "fr", "v2", 1, 4, 9), ("a", None, "v1", 1, 5, 9)]
    cols = (*rollup.KEYS, *rollup.SUMS)
    assert rows(rollup.totals(spark, store, ["1", "2", "2", "missing"]), *cols) == want
    assert rollup.compact(spark, store, ["1", "2"], "all") and not rollup.compact(spark, store, ["1"], "all")
    assert rows(rollup.totals(spark, store, ["all"]), *cols) == want
    assert rollup.commit(first.limit(0), store, "empty") and rollup.totals(spark, store, ["empty"]).count() == 0
    with pytest.raises(ValueError):
        rollup.commit(first, store, "../x")


def test_stages(spark, odd, none, tmp_path):
    """Every stage takes odd and empty tables, and all but the last return the columns of documents."""
    spark.createDataFrame([(1, "The quick brown fox jumps over the lazy dog today")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs in (odd, none, odd.withColumn("size", F.lit(1))):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            got = stage(spark, docs, str(tmp_path))
            assert got.count() <= (10 if k < len(corpus_pipeline.STAGES) - 1 else 1000)
            if k == 1 and docs is odd:  # one row of each group: all texts without words are one
                assert sorted(r["doc_id"] or 0 for r in got.collect()) == [0, 1, 4, 5, 6, 6, 7]
            assert k == len(corpus_pipeline.STAGES) - 1 or got.columns == docs.columns


def test_temperature_flattens_overconfidence():
    logits = np.array([[9.0, 0.0], [9.0, 0.0], [0.0, 9.0], [0.0, 9.0]])
    assert langid.temperature(logits, np.array([0, 1, 1, 1])) == 4.0 and langid.temperature(logits, np.array([0, 0, 1, 1])) == 0.25
