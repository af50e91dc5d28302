"""Forecast error metrics as aggregate columns.

Each works as a plain aggregate and, through ``over``, as a windowed one. Rows
where either side is null do not count.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .expr import col, ratio

Aggregate = Callable[[Column], Column]


def _plain(agg: Column) -> Column:
    return agg


def mae(y="y_true", p="y_pred", over: Aggregate = _plain) -> Column:
    return over(F.avg(F.abs(col(y) - col(p))))


def rmse(y="y_true", p="y_pred", over: Aggregate = _plain) -> Column:
    error = col(y) - col(p)
    return F.sqrt(over(F.avg(error * error)))


def mape(y="y_true", p="y_pred", guard: bool = True, over: Aggregate = _plain) -> Column:
    """Mean absolute percentage error. ``guard`` leaves out rows with a zero actual;
    without it such a row makes the result infinite (NaN if the forecast is zero too)."""
    y, p = col(y), col(p)
    term = F.when(y != 0, F.abs((y - p) / y))
    if not guard:
        term = term.when((y == 0) & (p != 0), float("inf")).when(y == 0, float("nan"))
    return 100 * over(F.avg(term))


def smape(y="y_true", p="y_pred", over: Aggregate = _plain) -> Column:
    y, p = col(y), col(p)
    size = F.abs(y) + F.abs(p)
    return 100 * over(F.avg(F.when(size != 0, 2 * F.abs(p - y) / size)))


def wape(y="y_true", p="y_pred", over: Aggregate = _plain) -> Column:
    """Total absolute error relative to the signed total of the actuals."""
    y, p = col(y), col(p)
    both = y.isNotNull() & p.isNotNull()
    return 100 * ratio(over(F.sum(F.abs(y - p))), over(F.sum(F.when(both, y))))


def all_metrics(y="y_true", p="y_pred") -> list[Column]:
    return [mae(y, p).alias("mae"), rmse(y, p).alias("rmse"), mape(y, p).alias("mape"),
            smape(y, p).alias("smape"), wape(y, p).alias("wape")]
