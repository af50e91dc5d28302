"""The queries without SQL, and the parts below them, against plain versions on whole small tables."""

import base64
import hashlib
import html
import itertools
import json
import re
import zlib

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from tillweave.llm import anchors, decontaminate, extract, fmindex, graph, packing, queries, sharding, simhash, substrings, vectors
from tillweave.llm.tokens import WordTokenizer

ROOT = "/root/testdata/sf0.001"
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs():
    return pd.read_parquet(f"{ROOT}/documents.parquet").set_index("doc_id").sort_index()


def got(spark, name):
    return queries.QUERIES[name](spark, ROOT).toPandas()


def classes(nodes, links):
    up = {n: n for n in nodes}

    def root(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        up[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def test_shards(spark, docs):
    r = got(spark, "op1_consistent_hash_shards")
    assert sorted(r.doc_id) == list(docs.index) and r["shard"].value_counts().max() - r["shard"].value_counts().min() <= 1
    assert all(sorted(g.slot) == list(range(len(g))) for _, g in r.groupby("shard"))
    assert all(zlib.crc32(docs.text[d].encode()) == c and len(docs.text[d].encode()) + 1 == s for d, c, s in zip(r.doc_id, r.text_crc32, r["size"]))


def test_a_new_shard_moves_little():
    counts = {a: 3 for a in range(0, 1 << 16, 7)}

    def place(shards, slack):
        return {(arc, k): s for arc, first, last, s, _, _ in sharding.walk(counts, shards, slack) for k in range(first, last + 1)}

    before, after = place(8, 0.25), place(9, 0.25)
    assert set(before) == set(after) and len(before) == 3 * len(counts)
    assert sum(before[k] != after[k] for k in before) / len(before) < 0.4  # a plain remainder would move 8 of 9
    assert max(pd.Series(after).value_counts()) <= -(-1.25 * len(after) // 9)
    assert set(sharding.ring(8)) == {x for x in sharding.ring(9) if x[1] != 8}


def test_token_ids(docs):
    plain, words = Tokenizer.from_file(TOKENIZER), WordTokenizer(TOKENIZER)
    odd = ["<|endoftext|> a<|startoftext|>b, ", "ÀÉ é x", "it's, we'll. don't.\n", "ΣΑΣ. İstanbul", "a\x1cb c d e", "", " \n\t ", "中文字 12ab!! x_, y",
           "foo.., bar", "a., b", "ﬁ Ⅷ ①", "'s 't !'s", "\r\n\tx"]
    for text in odd + list(docs.text):
        assert np.frombuffer(words.encode([text])[0], "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids


def test_packing(spark, docs):
    p = got(spark, "op2_best_fit_packing")
    plain = Tokenizer.from_file(TOKENIZER)
    ids = {d: plain.encode(t, add_special_tokens=False).ids + [0] for d, t in docs.text.items()}
    assert p.groupby("doc_id").length.sum().to_dict() == {d: len(v) for d, v in ids.items()}
    for r in p.itertuples():
        part = ids[r.doc_id][r.start:r.start + r.length]
        assert len(part) == r.length <= 2048 and r.start == 2048 * r.piece and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
    for _, g in p.sort_values("offset").groupby("sequence_id"):
        assert g.offset.tolist() == [0, *np.cumsum(g.length)[:-1]] and g.length.sum() <= 2048
    assert p.sequence_id.nunique() <= 1.02 * -(-p.length.sum() // 2048)


@pytest.mark.parametrize("seed", range(6))
def test_plan(seed):
    r = np.random.default_rng(seed)
    size = int(r.integers(5, 60))
    lengths = r.integers(1, size + 1, int(r.integers(0, 400)))
    counts = np.bincount(lengths, minlength=size + 1)
    fill, seen = {}, np.zeros(size + 1, dtype=int)
    for length, first, n, sequence, offset in sorted(packing.plan(counts, size)):
        assert first == seen[length]
        seen[length] += n
        for k in range(n):
            fill.setdefault(sequence + k, []).append((offset, length))
    assert (seen == counts).all()
    for parts in fill.values():
        parts.sort()
        assert [o for o, _ in parts] == [0, *np.cumsum([x for _, x in parts])[:-1]] and sum(x for _, x in parts) <= size
    bins = []  # first fit, longest first
    for length in sorted(lengths, reverse=True):
        at = next((k for k, room in enumerate(bins) if room >= length), None)
        if at is None:
            bins.append(size)
            at = -1
        bins[at] -= length
    assert len(fill) <= len(bins) + 1


def test_sequences(spark):
    rows = spark.createDataFrame([(1, "a b c"), (2, "d"), (3, None)], "doc_id long, text string")
    pieces = packing.cut(rows, TOKENIZER, 8, with_ids=True)
    placed = packing.pack(pieces, 8)
    whole = {r["sequence_id"]: np.frombuffer(bytes(r["ids"]), "<u4") for r in packing.sequences(placed).collect()}
    assert sum(map(len, whole.values())) == 7 and all(whole[r["sequence_id"]][r["offset"] + r["length"] - 1] == 0 for r in placed.collect())


def test_language(spark, docs):
    r = got(spark, "op3_language_id").set_index("doc_id").join(docs)
    assert sorted(r.index) == list(docs.index) and all(r.held_out == [zlib.crc32(str(d).encode()) % 3 == 1 for d in r.index])
    assert (r[r.held_out].lang_pred == r[r.held_out].lang).mean() >= 0.95 and r.score.between(0, 1).all()


def plain_simhash(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum((2 * sum(h >> b & 1 for h in hashes) > len(hashes)) << b for b in range(64))


def test_simhash(spark, docs):
    o = got(spark, "op4_simhash_near_dedup").set_index("doc_id")
    prints = {d: plain_simhash(t) for d, t in docs.text.items()}
    assert {d: f"{p:016x}" for d, p in prints.items()} == o.fingerprint.to_dict()
    want = classes(prints, [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2])
    assert o.component_id.to_dict() == want


@pytest.mark.parametrize("spread", [2, 5, 9])
def test_simhash_links_of_crowded_lists(spark, spread):
    """Many fingerprints around few centres: long posting lists, all classes found, no link beyond the bits."""
    r = np.random.default_rng(spread)
    prints = set()
    for centre in r.integers(0, 1 << 62, 3):
        for _ in range(150):
            flip = r.choice(spread + 8, int(r.integers(0, 4)), replace=False)
            prints.add(int(centre) ^ sum(1 << int(b) for b in flip))
    prints = sorted(prints)
    found = simhash.links(spark.createDataFrame([(p,) for p in prints], "fp long")).collect()
    want = classes(prints, [(a, b) for a, b in itertools.combinations(prints, 2) if (a ^ b).bit_count() <= 2])
    assert classes(prints, [(x["a"], x["b"]) for x in found]) == want
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), 3)


def test_components(spark):
    r = np.random.default_rng(1)
    links = [tuple(map(int, r.integers(0, 300, 2))) for _ in range(220)] + [(k, k + 1) for k in range(400, 460)] + [(7, 7), (None, 3)]
    rows = graph.components(spark.createDataFrame(links, "a long, b long")).collect()
    plain = [(a, b) for a, b in links if a is not None and a != b]
    assert {x["node"]: x["root"] for x in rows} == classes({n for x in plain for n in x}, plain) and len(rows) == len({x["node"] for x in rows})


def distance_in(item, text):
    """Least edit distance of an item to any part of a text, the plain way."""
    row = list(range(len(item) + 1))
    best = row[-1]
    for c in text:
        last, row = row, [0]
        for k, x in enumerate(item, 1):
            row.append(min(last[k - 1] + (x != c), last[k] + 1, row[-1] + 1))
        best = min(best, row[-1])
    return best


def test_decontamination(spark, docs):
    r = got(spark, "op6_benchmark_decontamination")
    items = pd.read_parquet(f"{ROOT}/benchmark.parquet")
    words = {d: decontaminate.words(t) for d, t in docs.text.items()}
    exact = {(d, i) for i, t in zip(items.item_id, items.text) for d, w in words.items() if decontaminate.words(t) in w}
    found = set(zip(r.doc_id, r.item_id))
    assert exact == set(zip(r.doc_id[r.distance == 0], r.item_id[r.distance == 0])) and exact <= found and (r.distance <= r.budget).all()


def test_edit_matches():
    """Random edits within the budget are all found, with the true distance and a span of that distance."""
    r = np.random.default_rng(3)
    letters = np.array(list("abcdefgh "))
    for _ in range(60):
        item = "".join(r.choice(letters, 60))
        index = decontaminate.Index([(7, item)], 0.1)
        edits, broken = int(r.integers(0, 9)), list(item)
        for _ in range(edits):
            at, kind = int(r.integers(0, len(broken))), r.integers(0, 3)
            broken[at:at + (kind < 2)] = [str(r.choice(letters))] * int(kind != 1)
        text = "".join(r.choice(letters, 40)) + "".join(broken) + "".join(r.choice(letters, 40))
        true, found = distance_in(item, text), index.search(text)
        assert bool(found) == (true <= 6)
        if found:
            _, best, budget, start, end = found[0]
            assert (best, budget) == (true, 6) and distance_in(item, text[start:end]) == true


def test_extraction(spark):
    pages = pd.read_parquet(f"{ROOT}/pages.parquet").set_index("page_id").sort_index()
    r = got(spark, "op7_html_wrapper").set_index("page_id").sort_index()

    def plain(page):
        body = re.search("<article>(.*?)</article>", page, re.S)[1]
        parts = [" ".join(html.unescape(re.sub("</?(b|br)>", "", p)).split()) for p in re.split("</?(?:p|h1)>", body)]
        return "\n".join(p for p in parts if p)

    assert r.text.to_dict() == pages.html.map(plain).to_dict() and (r.n_chars == r.text.str.len()).all()


def text_of(pages):
    shapes = [extract.shape(extract.tree(p)) for p in pages]
    labels = [extract._flat(s, (0,), 5) for s in shapes]
    centre = shapes[labels.index(max(labels, key=lambda x: (labels.count(x), x)))]
    found = {}
    for s in shapes:
        for node, up, key, label, block, own, whole, size in extract.rows(s, centre):
            found.setdefault((node, up, key, label, block), []).append((own, whole, size))
    counts = [(*k, len(v), *(f(x[c] for x in v) for c in (0, 1) for f in (min, max)), sum(x[2] for x in v)) for k, v in found.items()]
    wrapper = extract._flat(extract.wrapper(extract.template(counts)), (0, 1, 2, 3, 4, 6), 5)
    reader = extract.Reader(f"[{wrapper}]")
    return [reader.text(p) for p in pages]


def test_wrappers_of_other_layouts():
    """Pages without an article element: the wrapper finds where the varying text sits and what is always the same."""
    plain = """<body><div id="top"><a>Home</a></div><div class="cookie-notice">We use cookies {0}</div><div id="wrap"><div class="post"><h2>Title {0}</h2>
      <p>First paragraph {0} that is long enough.</p><p>Second &ndash; {0}<br>with a break.</p><p>Always the same line.</p><ul><li>item {0}</li></ul></div>
      <div class="sidebar"><p>Related {0} stuff</p></div><div class="comments"><p>reader {0} says hi</p></div></div><div>Copyright</div></body>"""
    want = "Title {0}\nFirst paragraph {0} that is long enough.\nSecond – {0} with a break.\nAlways the same line.\nitem {0}"
    assert text_of([plain.format(k) for k in range(12)]) == [want.format(k) for k in range(12)]
    table = "<BODY><DIV CLASS=menu>m</DIV><TABLE><TR><TD>nav links</TD><TD><P>Story {0} is here<P>and more {0}</TD></TR></TABLE>"
    assert text_of([table.format(k) for k in range(5)])[2] == "Story 2 is here\nand more 2"
    marked = """<header><h1>Site</h1></header><main><article class="post comments-open"><header><h1>T{0}</h1></header><p>Body {0}</p><aside>pull {0}</aside>
      <form>ask {0}</form><pre>a  b\n c</pre><p hidden>no</p></article><article class="comment"><p>c {0}</p></article></main><footer>f{0}</footer>"""
    assert text_of([marked.format(k) for k in range(3)])[1] == "T1\nBody 1\na b c"
    assert text_of(["<p>same copy</p>"] * 9) == ["same copy"] * 9


@pytest.mark.parametrize("seed", range(4))
def test_anchors(seed):
    """Segments cover every window once, and equal windows have equal anchors."""
    r = np.random.default_rng(seed)
    words = [f"w{x}" for x in r.integers(0, 1 + 30 ** (seed % 3), 400)]
    line = anchors.line_of(" \n".join(words))
    anchor, at, n = anchors.segments(line, 20, 6)
    of = np.repeat(anchor, n)
    assert at.tolist() == [0, *np.cumsum(n)[:-1]] and len(of) == 381
    seen = {}
    for k, a in enumerate(of.tolist()):
        assert seen.setdefault(tuple(words[k:k + 20]), a) == a
    small = anchors.PART
    try:
        anchors.PART = 300
        again = anchors.segments(line, 20, 6)
        assert np.repeat(again[0], again[2]).tolist() == of.tolist()
    finally:
        anchors.PART = small


def test_fm_index():
    r = np.random.default_rng(5)
    text = np.append(r.integers(1, 5, 600), 0)
    index = fmindex.FMIndex(text, 5, 6)
    for length in range(1, 7):
        at = np.arange(len(text) - length - 1)
        low, high, matched = index.matching(at, length)
        runs = [tuple(text[k:k + length]) for k in at]
        for k in at[::7]:
            same = sum(runs[k] == x for x in runs) + (runs[k] == tuple(text[len(text) - 1 - length:-1]))
            assert same == high[k] - low[k] if matched[k] == length else same == 1
            assert k + length - matched[k] in index.order[low[k]:high[k]]


def plain_repeats(texts, window):
    first, out = {}, {}
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", t or "") for d, t in texts.items()}
    for d in sorted(words):
        gone = set()
        for k in range(len(words[d]) - window + 1):
            key = tuple(words[d][k:k + window])
            if key in first:
                gone.update(range(k, k + window))
            first.setdefault(key, (d, k))
        out[d] = (len(words[d]), len(gone), " ".join(w for k, w in enumerate(words[d]) if k not in gone))
    return out


@pytest.mark.parametrize("shard,most", [(120_000, 1000), (200, 1000), (200, 1)])
def test_passages(spark, shard, most):
    """Shared, overlapping, repeated and periodic passages; tiny shards and crowded anchors give the same."""
    r = np.random.default_rng(8)
    passages = [[f"p{k}x{i}" for i in range(int(r.integers(8, 60)))] for k in range(12)]
    texts = {}
    for d in range(120):
        words = []
        for _ in range(int(r.integers(1, 6))):
            p = passages[int(r.integers(0, 12))]
            a = int(r.integers(0, 6))
            words += p[a:] + [f"u{int(x)}" for x in r.integers(0, 3000, int(r.integers(0, 30)))]
        texts[d] = " ".join(words)
    texts |= {200: "a b " * 60, 201: "a b a b " * 20, 202: texts[3], 203: "z " * 90, 204: None}
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    found = {x["doc_id"]: (x["n_words"], x["n_removed"], x["kept"]) for x in substrings.without_repeats(df, shard=shard, classes_most=most).collect()}
    assert found == plain_repeats(texts, 20)


def test_embedding_recall(spark):
    """Small cells: at least 0.9 of the links that brute force finds, no wrong one, whole classes."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    data = df.toPandas().sort_values("vec_id", ignore_index=True)
    x = np.stack(data.embedding).astype(np.float64)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    near = (x @ x.T >= 0.93) & (data.label.to_numpy()[:, None] == data.label.to_numpy())
    np.fill_diagonal(near, False)
    for cell in (2048, 40):
        got = vectors.near_duplicates(df, cell=cell, block=32).toPandas().sort_values("vec_id", ignore_index=True)
        assert got.n_links.sum() >= (1 if cell == 2048 else 0.9) * near.sum() and (got.n_links <= near.sum(axis=1)).all()
        if got.n_links.sum() == near.sum():
            want = classes(range(len(data)), [(int(a), int(b)) for a, b in zip(*np.nonzero(near)) if a < b])
            assert dict(enumerate(np.searchsorted(data.vec_id, got.component_id).tolist())) == want


def test_kmeans_finds_the_centres():
    r = np.random.default_rng(2)
    true = np.linalg.qr(r.normal(size=(8, 8)))[0][:4]
    x = np.repeat(true, 30, axis=0) + r.normal(size=(120, 8)) * 0.05
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    centres = vectors.spherical_kmeans(x, 4)
    assert ((centres @ true.T).max(axis=0) > 0.98).all()


def test_rollup_equals_recount(spark, docs):
    r = got(spark, "op9_token_rollup")
    plain, raw = Tokenizer.from_file(TOKENIZER), docs.reset_index()
    first = raw.drop_duplicates("text").copy()
    first["n_tokens"] = [len(plain.encode(t, add_special_tokens=False).ids) for t in first.text]
    first["n_bytes"] = [len(t.encode()) for t in first.text]
    want = first.groupby(["source", "lang"]).agg(n_docs=("doc_id", "size"), n_tokens=("n_tokens", "sum"), n_bytes=("n_bytes", "sum")).reset_index()
    assert (r.tokenizer == "word-bpe-49k").all()
    cols = list(want.columns)
    assert r[cols].sort_values(cols[:2], ignore_index=True).equals(want.sort_values(cols[:2], ignore_index=True))


def test_payload_digest(spark):
    r = got(spark, "op5_warc_transactions").set_index("page_id")
    pages = pd.read_parquet(f"{ROOT}/pages.parquet").set_index("page_id")
    assert r.payload_digest.to_dict() == {p: base64.b32encode(hashlib.sha1(h.encode()).digest()).decode() for p, h in pages.html.items()}


def test_pipeline(spark, docs):
    """All stages against plain versions of them, each on what its predecessor kept."""
    items = pd.read_parquet(f"{ROOT}/benchmark.parquet")
    texts = {d: t for d, t in docs.text.items() if re.search(r"[^\W\d_]", t)}
    prints = {d: plain_simhash(t) for d, t in texts.items()}
    group = classes(prints, [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 2])
    texts = {d: t for d, t in texts.items() if group[d] == d}
    cut = plain_repeats(texts, 20)
    texts = {d: cut[d][2] if cut[d][1] else t for d, t in texts.items() if cut[d][1] < cut[d][0] or not cut[d][0]}
    words = [decontaminate.words(t) for t in items.text]
    texts = {d: t for d, t in texts.items() if not any(w in decontaminate.words(t) for w in words)}
    plain = Tokenizer.from_file(TOKENIZER)
    want = {d: len(plain.encode(t, add_special_tokens=False).ids) + 1 for d, t in texts.items()}
    got = corpus_pipeline.run(spark, ROOT).toPandas()
    assert got.groupby("doc_id").length.sum().to_dict() == want
    assert got.groupby("sequence_id").length.sum().max() <= 2048 and got.sequence_id.nunique() <= 1.05 * -(-got.length.sum() // 2048)


@pytest.mark.parametrize("name", ["op5_warc_transactions", "op8_repeated_passages", "op10_embedding_near_dedup"])
def test_equals_sql(spark, name):
    import duckdb

    from tillweave.llm.oracle import ORACLE

    con = duckdb.connect()
    for t in ("documents", "pages", "embeddings"):
        con.execute(f"create view {t} as select * from '{ROOT}/{t}.parquet'")
    want = con.sql(ORACLE[name]).df()
    have = got(spark, name)
    assert sorted(want.columns) == sorted(have.columns)
    cols = sorted(want.columns, key=lambda c: (not c.endswith("_id"), c))
    a, b = (x[cols].astype(object).where(x[cols].notna(), None).sort_values(cols[0], ignore_index=True) for x in (want, have))
    assert [tuple(map(str, r)) for r in a.to_numpy()] == [tuple(str(int(v)) if isinstance(v, float) else str(v) for v in r) for r in b.to_numpy()]
