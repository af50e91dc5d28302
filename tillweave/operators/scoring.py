"""Forecast errors as frames: overall, by group, and over rolling windows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import metrics as m
from ..schema import DATE, SERIES


def metrics(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    return df.agg(*m.all_metrics(y, p))


def metrics_by(df: DataFrame, groups: Sequence[str], y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """All metrics per group: plain aggregates, combined before the shuffle."""
    return df.groupBy(*groups).agg(*m.all_metrics(y, p))


def rolling_metrics(df: DataFrame, rows: int = 13, by: Sequence[str] | None = None, y: str = "y_true",
                    p: str = "y_pred") -> DataFrame:
    """MAE, RMSE and MAPE of the last ``rows`` rows; null until the window is full.

    By default each model's forecasts of a series are a series of their own; a date
    that several folds test counts once per fold, in their order.
    """
    if by is None:
        by = [*(["model"] if "model" in df.columns else []), *SERIES]
    order = [DATE, *(["fold"] if "fold" in df.columns else [])]
    frame = Window.partitionBy(*by).orderBy(*order).rowsBetween(-(rows - 1), 0)

    def over(agg: Column) -> Column:
        return agg.over(frame)

    full = F.count(F.when(F.col(y).isNotNull() & F.col(p).isNotNull(), 1)).over(frame) == rows
    return df.withColumns({
        f"rolling_{name}": F.when(full, metric(y, p, over=over))
        for name, metric in (("mae", m.mae), ("rmse", m.rmse), ("mape", m.mape))})
