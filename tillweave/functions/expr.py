"""Small column helpers shared by the operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def ratio(num: str | Column, den: str | Column) -> Column:
    """``num / den``, null where the denominator is zero (a plain division would raise)."""
    return F.try_divide(col(num), col(den))


def zero_if_null(c: str | Column) -> Column:
    return F.coalesce(col(c), F.lit(0.0))


def is_infinite(c: str | Column) -> Column:
    return F.abs(col(c)) == F.lit(float("inf"))


def unpivot(df: DataFrame, values: Mapping[str, Column], name: str, value: str, keep=()) -> DataFrame:
    """Turn the columns of a small frame into (name, value) rows."""
    pairs = F.array(*[F.struct(F.lit(k).alias(name), v.alias(value)) for k, v in values.items()])
    return df.select(*keep, F.explode(pairs).alias("_pair")).select(*keep, f"_pair.{name}", f"_pair.{value}")


def one_row(df: DataFrame, small: DataFrame) -> DataFrame:
    """Attach the columns of a one-row aggregate to every row, as a scalar subquery: no join."""
    row = small.select(F.struct(*[F.col(c) for c in small.columns]).alias("row")).scalar()
    return df.withColumn("_row", row).select(*df.columns, *[F.col(f"_row.{c}").alias(c) for c in small.columns])
