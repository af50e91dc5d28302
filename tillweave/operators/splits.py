"""Time-ordered splits. All are ranges over the distinct dates.

The dates are gathered as one sorted array: one element per calendar day, however
many rows the panel has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.expr import one_row
from ..schema import DATE


def _dates(df: DataFrame, column: str = DATE) -> DataFrame:
    days = df.select(column).where(F.col(column).isNotNull()).distinct()
    return days.agg(F.sort_array(F.collect_list(column)).alias("dates")).withColumn("n", F.size("dates"))


def _at(index: Column | str) -> Column:
    """Date at a position from 0; null beyond the end."""
    return F.get("dates", index if isinstance(index, Column) else F.col(index))


def split_dates(df: DataFrame, test: float = 0.2, column: str = DATE) -> DataFrame:
    """Last training date and first test date."""
    at = F.floor(F.col("n") * F.lit(1 - test)).cast("int")
    return _dates(df, column).select(_at(at - 1).alias("train_end"), _at(at).alias("test_start"))


def time_split(df: DataFrame, test: float = 0.2, column: str = DATE) -> DataFrame:
    """Adds ``split``: train up to and including the date at the split position, test after it."""
    at = F.floor(F.col("n") * F.lit(1 - test)).cast("int")
    bound = _dates(df, column).select(_at(at).alias("_bound"))
    return one_row(df, bound).withColumn(
        "split", F.when(F.col(column) <= F.col("_bound"), "train").otherwise("test")).drop("_bound")


def fold_bounds(df: DataFrame, folds: int = 4, horizon: int = 13, column: str = DATE) -> DataFrame:
    """Rolling origin: fold f trains on the first ``f * (n // (folds + 1))`` dates and
    is tested on the next ``horizon`` ones. Too few dates give no folds."""
    size = F.floor(F.col("n") / (folds + 1)).cast("int")
    numbered = _dates(df, column).select(
        "dates", "n", size.alias("size"), F.explode(F.sequence(F.lit(1), F.lit(folds))).alias("fold"))
    start = F.col("fold") * F.col("size")
    end = F.least(start + horizon, F.col("n"))
    return numbered.where((F.col("size") > 0) & (end > start)).select(
        "fold", _at(F.lit(0)).alias("train_start"), _at(start - 1).alias("train_end"),
        _at(start).alias("test_start"), _at(end - 1).alias("test_end"))


def expanding_bounds(df: DataFrame, n_splits: int = 5, column: str = DATE) -> DataFrame:
    """Expanding window: equal test blocks at the end of the dates, each trained on
    everything before it."""
    size = F.floor(F.col("n") / (n_splits + 1)).cast("int")
    numbered = _dates(df, column).select(
        "dates", "n", size.alias("size"), F.explode(F.sequence(F.lit(1), F.lit(n_splits))).alias("fold"))
    start = F.col("n") - (n_splits + 1 - F.col("fold")) * F.col("size")
    return numbered.where("size > 0").select(
        "fold", _at(F.lit(0)).alias("train_start"), _at(start - 1).alias("train_end"),
        _at(start).alias("test_start"), _at(start + F.col("size") - 1).alias("test_end"))


def as_array(bounds: DataFrame) -> DataFrame:
    """All folds' bounds in one row, by fold."""
    return bounds.agg(F.sort_array(F.collect_list(F.struct("fold", "train_start", "train_end", "test_start", "test_end"))).alias("_bounds"))


def assign_folds(df: DataFrame, bounds: DataFrame, column: str = DATE) -> DataFrame:
    """Each row once per fold that it belongs to, with its ``role``. The bounds reach
    the rows as one array, so there is no join."""
    d = F.col(column)

    def role(b: Column) -> Column:
        return F.when(d.between(b["train_start"], b["train_end"]), "train").when(d.between(b["test_start"], b["test_end"]), "test")

    held = F.filter(F.transform("_bounds", lambda b: F.struct(b["fold"].alias("fold"), role(b).alias("role"))), lambda x: x["role"].isNotNull())
    return one_row(df, as_array(bounds)).select(F.explode(held).alias("_held"), *[F.col(c) for c in df.columns]).select(
        "_held.fold", "_held.role", *[F.col(c) for c in df.columns])


def expanding_cv(df: DataFrame, n_splits: int = 5, column: str = DATE) -> DataFrame:
    return assign_folds(df, expanding_bounds(df, n_splits, column), column)
