"""One query per operator over its whole table, with production parameters, in the columns its contract names."""

from __future__ import annotations

import zlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise, scratch_path
from . import binary, decontaminate, extract, langid, packing, periods, rollup, sharding, simhash, spellings, substrings, vectors, warc
from .tokens import token_counts

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
TOKENIZER = public_tokenizers.path("word_bpe_49k.json")


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


@query
def op1_consistent_hash_shards(spark: SparkSession, root: str) -> DataFrame:
    """All documents on 8 shards whose counts differ by one at most; home is the shard that the ring alone names."""
    shards = sharding.assign_shards(table(spark, root, "documents"), 8)
    return shards.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"), "home")


@query
def op2_best_fit_packing(spark: SparkSession, root: str) -> DataFrame:
    return packing.pack_documents(table(spark, root, "documents"), TOKENIZER)


@query
def op4_simhash_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, root, "documents"))


@query
def op5_warc_transactions(spark: SparkSession, root: str) -> DataFrame:
    archive = scratch_path(spark, "warc")
    warc.write_warc(table(spark, root, "pages"), archive)
    captures = warc.transactions(materialise(warc.read_warc(spark, archive).drop("payload").withColumn(
        "payload", F.lit(None).cast("binary")), "records"))
    return captures.select(
        F.col("metadata.fields")["page"].cast("long").alias("page_id"),
        F.coalesce("response.payload_bytes", F.col("metadata.fields")["payload-bytes"].cast("long")).alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"), F.col("response.record_type").alias("record_type"),
        F.col("response.refers_to").cast("long").alias("refers_to"), F.col("response.digest_ok").alias("digest_ok"),
        F.col("request.target_uri").alias("target_uri"))


@query
def op9_token_rollup(spark: SparkSession, root: str) -> DataFrame:
    """Token totals of all documents after a load, a retraction of exact repeats and a change of tokenizer.

    The load inserts every document with its count of words (``words-v1``), the second
    batch deletes all but one row of each text (the smallest doc_id, null last), the third
    revises the kept ones to their count of ids (``word-bpe-49k``). The load is committed
    twice. A null text is like no other and kept; of rows that repeat an id and its text one is kept.
    """
    docs = table(spark, root, "documents")
    counted = token_counts(docs, TOKENIZER, keep=("source", "lang"))
    counted = materialise(counted.withColumn("row", F.monotonically_increasing_id()), "counts")  # written, so a row keeps its number
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "row")
    first = materialise(counted.where("text_key is not null").groupBy("text_key").agg(F.min(order).alias("first")).select("first.row"), "firsts")
    texts = counted.where("text_key is not null")
    kept = texts.join(first, "row", "left_semi").unionByName(counted.where("text_key is null"))
    words = [F.col("source"), F.col("lang"), F.lit("words-v1").alias("tokenizer"), F.col("n_words").alias("n_tokens"), F.col("n_bytes")]
    no_old = [F.lit(None).cast(t).alias(c) for c, t in (("old_source", "string"), ("old_lang", "string"), (
        "old_tokenizer", "string"), ("old_tokens", "long"), ("old_bytes", "long"))]
    load = counted.select(F.lit("insert").alias("op"), *words, *no_old)
    drop = texts.join(first, "row", "left_anti").select(F.lit("delete").alias("op"), *words, *no_old)
    revise = kept.select(
        F.lit("revise").alias("op"), "source", "lang", F.lit("word-bpe-49k").alias("tokenizer"), F.col("n_ids").alias("n_tokens"),
        "n_bytes", F.col("source").alias("old_source"), F.col("lang").alias("old_lang"), F.lit("words-v1").alias("old_tokenizer"),
        F.col("n_words").alias("old_tokens"), F.col("n_bytes").alias("old_bytes"))
    store = scratch_path(spark, "rollup")
    for name, events in (("load", load), ("repeats", drop), ("load", load), ("bpe", revise)):
        rollup.commit(events, store, name)
    return rollup.totals(spark, store, ["load", "repeats", "bpe"])


@query
def op3_language_id(spark: SparkSession, root: str) -> DataFrame:
    docs = table(spark, root, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(langid.trained_on()))
    return langid.predict(docs.drop("lang"), model).select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score")


@query
def op6_benchmark_decontamination(spark: SparkSession, root: str) -> DataFrame:
    """One row per document and benchmark item that occurs in it, with the distance and the place of the best occurrence."""
    return decontaminate.contaminated(table(spark, root, "documents"), table(spark, root, "benchmark"))


@query
def op10_embedding_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return vectors.near_duplicates(table(spark, root, "embeddings"))


@query
def op7_html_wrapper(spark: SparkSession, root: str) -> DataFrame:
    return extract.main_text(table(spark, root, "pages"))


@query
def op8_repeated_passages(spark: SparkSession, root: str) -> DataFrame:
    cut = substrings.without_repeats(table(spark, root, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


@query
def op11_power_of_two_packing(spark: SparkSession, root: str) -> DataFrame:
    """Pieces of power-of-two lengths, each a sequence of its own; slot is its place among those of its length."""
    placed = binary.pack_documents(table(spark, root, "documents"), TOKENIZER)
    return placed.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "slot")


@query
def op12_spelling_variants(spark: SparkSession, root: str) -> DataFrame:
    """Words of all documents with the spelling they vary; one occurrence in 97 loses a letter first, by its document and word."""
    h = "crc32(cast(concat(coalesce(cast(id as string), ''), ':', word) as binary))"
    kept = F.expr(f"case when {h} % 97 = 0 then overlay(word placing '' from cast({h} % length(word) as int) + 1 for 1) else word end")
    found = spellings.variants(spellings.word_counts(table(spark, root, "documents"), kept))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def repeated_from(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of one document in ten repeat from a place on, both by the id's checksum; a null id changes nothing."""
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is None or h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + (words[a:a + p] * ((n - a) // p + 1))[:n - a]


@query
def op13_periodic_runs(spark: SparkSession, root: str) -> DataFrame:
    found = periods.periodic_runs(table(spark, root, "documents"), rewrite=repeated_from)
    best = F.expr("""aggregate(runs, cast(null as struct<start: bigint, length: bigint, period: bigint>), (b, r) ->
        if(b is null or r.length * b.period > b.length * r.period, r, b))""")  # runs come by start, then period
    listed = F.expr("concat_ws('', transform(runs, r -> concat(r.start, ',', r.length, ',', r.period, chr(10))))")
    return found.withColumn("best", best).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "best.start", "best.length", "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"), F.sha2(listed.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"))
