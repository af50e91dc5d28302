"""A training corpus from raw documents: language, near duplicates, repeated passages, benchmark leaks, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillweave.llm import decontaminate, langid, packing, simhash, substrings
from tillweave.llm.queries import TOKENIZER
from tillweave.session import scratch_path

#: Below this calibrated probability no language is believed.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that the model knows: text without a letter, or like none of them, goes."""
    model = langid.fit(docs.where(langid.trained_on()))
    found = langid.predict(docs, model, out=("_lang", "_score"))
    return found.where((F.col("_lang") != langid.UNKNOWN) & (F.col("_score") >= LEAST_SCORE)).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of documents whose SimHash fingerprints link: the one with the smallest doc_id.

    Three-word shingles and at most two differing bits, as in op4. Rows without a doc_id come last, so a
    unique text stays without one; rows that repeat an id, a text or both are decided one by one.
    """
    return simhash.without_near_duplicates(docs, width=3, most=2)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of repeated passages; nothing but repeats leaves no document.

    A document that loses no word keeps its text as it is; from others the kept words
    stay, joined by one space, with their new length.
    """
    cut = substrings.without_repeats(docs).where("n_removed < n_words or n_words = 0")
    changed = F.col("n_removed") > 0
    new = {"text": F.when(changed, F.col("kept")).otherwise(F.col("text")),
           "n_chars": F.when(changed, F.length("kept").cast("long")).otherwise(F.col("n_chars"))}
    return cut.select(*[new[c].alias(c) if c in new else F.col(c) for c in docs.columns])


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark item occurs within the error budget."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, TOKENIZER)


STAGES = [("language ID", language), ("SimHash near-dedup", near_duplicates), ("substring dedup", repeated_passages),
          ("benchmark decontamination", benchmark_leaks), ("best-fit packing", pack)]
#: The stages work on learned weights, XXH64, edit distances and token ids, which SQL can't express; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; each result is written to the shared folder and reread as the next one's documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        path = scratch_path(spark, f"stage{k}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
