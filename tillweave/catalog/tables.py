"""The three panel tables of a star-schema folder, each derived once per session.

A table is written to the session's shared folder when a query first asks for it, and
read back from there by every query. Queries over sales alone don't derive the
covariates, which takes a join of all line items with their orders.
"""

from __future__ import annotations

from functools import cached_property, partial

from pyspark.sql import DataFrame, SparkSession

from ..operators import cleaning
from ..operators.features import build_features
from ..session import materialise, memo, remove, staged
from ..sources import layout, starschema

_DERIVED: dict[tuple[str, str], Tables] = memo()


class Tables:
    def __init__(self, spark: SparkSession, root: str):
        self._spark, self._root = spark, root

    @cached_property
    def sales(self) -> DataFrame:
        return materialise(starschema.sales(self._spark, self._root), "sales")

    @cached_property
    def features(self) -> DataFrame:
        return materialise(starschema.features(self._spark, self._root), "features")

    @cached_property
    def stores(self) -> DataFrame:
        return materialise(starschema.stores(self._spark, self._root), "stores")


def tables(spark: SparkSession, root: str) -> Tables:
    key = (spark.sparkContext.applicationId, root)
    if key not in _DERIVED:
        _DERIVED[key] = Tables(spark, root)
    return _DERIVED[key]


_FEATURED: dict[tuple[str, str], DataFrame] = memo()


def clean(spark: SparkSession, root: str) -> DataFrame:
    t = tables(spark, root)
    return cleaning.clean_panel(t.sales, t.features, t.stores, stage=partial(materialise, name="days"))


def featured(spark: SparkSession, root: str) -> DataFrame:
    """The feature table that the models learn from, built once per session."""
    key = (spark.sparkContext.applicationId, root)
    if key not in _FEATURED:
        panel = clean(spark, root)
        path = staged(panel, "cleaned")
        cleaned = spark.read.schema(panel.schema).parquet(path)
        _FEATURED[key] = materialise(build_features(layout.dealt(cleaned, cleaned.count())), "featured")
        remove(spark, path)  # read by the features alone
    return _FEATURED[key]
