"""File sources and sinks.

Sinks write directories of part files, one per task; nothing is coalesced. Each
returns the path so that calls can be chained with the matching scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CSV = {"header": "true", "nullValue": "NA", "emptyValue": "", "dateFormat": "yyyy-MM-dd"}


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV scan with a header. ``NA`` is null; a malformed row or a missing
    path fails. No inference, so the file is read once."""
    return spark.read.options(**_CSV).option("mode", "FAILFAST").schema(schema).csv(path)


def write_csv(df: DataFrame, path: str) -> str:
    df.write.mode("overwrite").options(**_CSV).csv(path)
    return path


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet scan. With a schema the columns come in its order and types, those
    that are folder names included (Spark would guess their types)."""
    if schema is None:
        return spark.read.parquet(path)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def write_parquet(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> str:
    """Rows are gathered by folder and rebalanced by size first, so that no task opens
    every folder."""
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def write_json(df: DataFrame, path: str) -> str:
    """Report sink, one JSON object per row."""
    df.write.mode("overwrite").option("ignoreNullFields", "false").json(path)
    return path


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_predictions(preds: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Backtest predictions, one folder per model and fold.

    The rows are gathered by folder and then rebalanced by size, so that no task
    opens every folder and a large folder is written by several tasks.
    """
    writer = preds.hint("rebalance", "model", "fold").write.mode("overwrite").partitionBy("model", "fold")
    (writer.options(**_CSV) if fmt == "csv" else writer).format(fmt).save(path)
    return path


def read_predictions(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet") -> DataFrame:
    """All folds of all models; ``model`` and ``fold`` come from the folder names,
    so a filter on them prunes folders."""
    reader = spark.read.schema(schema)
    df = (reader.options(**_CSV) if fmt == "csv" else reader).format(fmt).load(path)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
