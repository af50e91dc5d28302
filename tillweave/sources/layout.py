"""Panel tables stored in buckets, so that joins and look-back windows need no exchange."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..schema import KEY, SERIES

#: Lets buckets by some of a join's keys serve the whole join, as (Store, Date) by Store.
PART_OF_KEYS = "spark.sql.requireAllClusterKeysForCoPartition"
#: Rows of a part: some 300 MB while all features of a panel are worked out.
PART_ROWS = 100_000
#: Rows of a part while the panel is joined by store and day: some 150 to 300 MB.
JOINED = 250_000


def store(df: DataFrame, table: str, path: str, by: Sequence[str] = SERIES, order: Sequence[str] = KEY, buckets: int | None = None) -> DataFrame:
    """Write ``df`` as the table ``table`` at ``path``, one sorted file a bucket, and read it back.

    Stored by series, a table serves every window over a series, and joins with other tables
    stored so. Stored by store, it also joins the covariates and the store dimension, if
    these are stored by store too, with as many buckets; use that where no store holds a large part of
    the rows, for a store is then in one task. Null keys share a bucket. Joins by more
    columns than the buckets' need ``in_place``.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [c for c in order if c in df.columns]
    (df.repartition(buckets, *by).write.format("parquet").bucketBy(buckets, *by).sortBy(*order)
     .option("path", path).mode("overwrite").saveAsTable(table))
    return spark.table(table)


def dealt(df: DataFrame, rows: int, by: Sequence[str] = SERIES, size: int = PART_ROWS) -> DataFrame:
    """``df``, which has some ``rows`` rows, dealt by key into parts of some ``size`` rows.

    The number of shuffle partitions is a setting, so the rows of a task would grow with the
    table. Where the setting gives parts of that size or smaller, ``df`` stays as it is.
    """
    parts = -(-rows // size)
    return df.repartition(parts, *by) if parts > int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) else df


def in_place(spark: SparkSession) -> SparkSession:
    """The session, set so that a join by more columns than its tables' buckets leaves the rows where they are.

    A runtime setting: it holds for plans made from now on.
    """
    spark.conf.set(PART_OF_KEYS, "false")
    return spark
