"""Joins, filters, top-k and unions of the panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import DATE, DEPT, KEY, SERIES, STORE, TARGET


def cast_keys(df: DataFrame) -> DataFrame:
    """Keys to their canonical types, where present."""
    kinds = {STORE: "long", DEPT: "long", DATE: "date", "IsHoliday": "boolean"}
    return df.withColumns({c: F.col(c).cast(t) for c, t in kinds.items() if c in df.columns})


def join_features(sales: DataFrame, features: DataFrame) -> DataFrame:
    """Left join on store and date; the sales side's IsHoliday wins. No hint: the
    covariates grow with the stores, so the size decides between broadcast and
    merge join, and a hot store is split by the skew-join rule."""
    return sales.join(features.drop("IsHoliday"), [STORE, DATE], "left")


def join_stores(df: DataFrame, stores: DataFrame) -> DataFrame:
    """Left join with the store dimension, again broadcast only by measured size."""
    return df.join(stores, STORE, "left")


def merge_sources(sales: DataFrame, features: DataFrame, stores: DataFrame) -> DataFrame:
    return join_stores(join_features(sales, features), stores)


def canonical_sort(df: DataFrame, by: Sequence[str] = SERIES, order: Sequence[str] = KEY) -> DataFrame:
    """Series together and rows in order within each partition; for sinks only,
    windows sort for themselves. Rebalancing evens out the partitions' sizes: small
    ones are merged, and a hot series is spread over several."""
    return df.hint("rebalance", *by).sortWithinPartitions(*order)


def filter_panel(df: DataFrame, store=None, dept=None, model=None, start=None, end=None) -> DataFrame:
    """Conjunction of the given conditions on plain columns, so that all of them
    reach the parquet scan."""
    for column, value in ((STORE, store), (DEPT, dept), ("model", model)):
        if value is not None:
            df = df.where(F.col(column) == value)
    if start is not None:
        df = df.where(F.col(DATE) >= F.lit(start).cast("date"))
    if end is not None:
        df = df.where(F.col(DATE) <= F.lit(end).cast("date"))
    return df


def top_series(df: DataFrame, n: int = 50, by: Sequence[str] = SERIES, value: str = TARGET) -> DataFrame:
    """The ``n`` series with the largest total; equal totals go by key. The sort
    and limit run as a top-k per partition."""
    totals = df.groupBy(*by).agg(F.sum(value).alias("total_revenue"))
    return totals.orderBy(F.desc("total_revenue"), *by).limit(n)


def restrict_to_series(df: DataFrame, series: DataFrame, min_points: int = 10, by: Sequence[str] = SERIES, few: bool = False) -> DataFrame:
    """Rows of the listed series that have at least ``min_points`` rows.

    The row counts come from an aggregate on the keys, not from a window over the
    rows, so no series is gathered in one task. ``few`` says that the list is short, as
    that of ``top_series``: it is broadcast, and no row of another series is shuffled.
    """
    by, sent = list(by), F.broadcast if few else (lambda keys: keys)
    listed = df.join(sent(series.select(*by)), by, "left_semi")
    enough = listed.groupBy(*by).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_points)
    return listed.join(sent(enough.select(*by)), by, "left_semi")


def union_forecasts(*forecasts: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), forecasts)


def with_defaults(df: DataFrame, defaults: Mapping[str, Column] | None = None) -> DataFrame:
    """Add columns that ``df`` lacks; present columns stay as they are."""
    if defaults is None:
        actual = F.col(TARGET) if TARGET in df.columns else F.lit(0.0)
        defaults = {"y_true": actual, "y_pred": F.lit(0.0), "fold": F.lit(1), "MarkDownSum": F.lit(0.0)}
    return df.withColumns({c: v for c, v in defaults.items() if c not in df.columns})


def filter_options(df: DataFrame, store: int | None = None) -> DataFrame:
    """Choices of the dashboard's filters as (option, value) rows of text: models,
    stores, departments (of one store if given), first and last date."""
    keys = {option: c for option, c in (("model", "model"), ("store", STORE), ("dept", DEPT)) if c in df.columns}
    # one pass over the rows; the options come from the distinct combinations
    known = df.groupBy(*keys.values()).agg(F.min(DATE).alias("_lo"), F.max(DATE).alias("_hi"))

    def row(option: str, value: Column) -> Column:
        return F.struct(F.lit(option).alias("option"), value.cast("string").alias("value"), F.col("_lo").alias("lo"), F.col("_hi").alias("hi"))

    wanted = {option: row(option, F.col(c)) for option, c in keys.items()}
    if store is not None and STORE in df.columns and "dept" in wanted:
        wanted["dept"] = F.when(F.col(STORE) == store, wanted["dept"])
    wanted |= {end: row(end, F.lit(None)) for end in ("min_date", "max_date")}
    rows = known.select(F.explode(F.array(*wanted.values())).alias("_row")).where("_row is not null").select("_row.*")
    ends = F.when(F.col("option") == "min_date", F.min("lo").cast("string")).when(
        F.col("option") == "max_date", F.max("hi").cast("string")).otherwise(F.col("value"))
    return rows.groupBy("option", "value").agg(ends.alias("_value")).select("option", F.col("_value").alias("value")).orderBy("option", "value")
