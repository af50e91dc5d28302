"""Token totals kept up to date by signed deltas.

A batch is a table of events: ``insert`` and ``delete`` carry a document's counts,
``revise`` carries old and new ones. Events become signed rows, are pre-aggregated to
additive totals per source, language and tokenizer version, and are committed as one
folder per batch. A batch id that is already committed is left alone, so a repeated
commit changes nothing; a commit that was cut short left no marker and is written anew.
Totals are the sum over committed batches; ``compact`` folds them into one.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("source", "lang", "tokenizer")
SUMS = ("n_docs", "n_tokens", "n_bytes")
EVENT = "op, source, lang, tokenizer, n_tokens, n_bytes, old_source, old_lang, old_tokenizer, old_tokens, old_bytes"


def signed(events: DataFrame) -> DataFrame:
    """Additive totals of a batch. Null keys are keys of their own, null counts are zero; other ops fall."""
    def part(sign: int, prefix: str, tokens: str, size: str) -> Column:
        return F.struct(*[F.col(prefix + k).cast("string").alias(k) for k in KEYS], F.lit(sign).cast("long").alias("n_docs"),
                        (sign * F.coalesce(F.col(tokens), F.lit(0))).cast("long").alias("n_tokens"),
                        (sign * F.coalesce(F.col(size), F.lit(0))).cast("long").alias("n_bytes"))

    plus, minus = part(1, "", "n_tokens", "n_bytes"), part(-1, "", "n_tokens", "n_bytes")
    old = part(-1, "old_", "old_tokens", "old_bytes")
    parts = F.when(F.col("op") == "insert", F.array(plus)).when(F.col("op") == "delete", F.array(minus)).when(
        F.col("op") == "revise", F.array(old, plus))
    return events.select(F.explode(parts).alias("d")).select("d.*").groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS])


def _folder(store: str, batch: str) -> str:
    if not re.fullmatch(r"[A-Za-z0-9_.-]+", batch):
        raise ValueError("a batch id has letters, digits, _, . and - only")
    return f"{store.rstrip('/')}/batch={batch}"


def _exists(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at)


def commit(events: DataFrame, store: str, batch: str) -> bool:
    """Write the batch's totals; False if it was committed before. The marker file comes last."""
    path = _folder(store, batch)
    if _exists(events.sparkSession, path + "/_SUCCESS"):
        return False
    signed(events).write.mode("overwrite").parquet(path)
    return True


def totals(spark: SparkSession, store: str, batches: list[str]) -> DataFrame:
    """The sums over the named committed batches; keys whose documents are all gone fall."""
    paths = [p for p in (_folder(store, b) for b in dict.fromkeys(batches)) if _exists(spark, p + "/_SUCCESS")]
    schema = ", ".join([f"{k} string" for k in KEYS] + [f"{c} long" for c in SUMS])
    rows = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    return rows.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in SUMS]).where(" or ".join(f"{c} <> 0" for c in SUMS))


def compact(spark: SparkSession, store: str, batches: list[str], into: str) -> bool:
    """Fold batches into one new batch; readers then name it instead of them. Repeating it changes nothing."""
    path = _folder(store, into)
    if _exists(spark, path + "/_SUCCESS"):
        return False
    totals(spark, store, batches).write.mode("overwrite").parquet(path)
    return True
