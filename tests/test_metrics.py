"""Metrics on fixed arrays, with values worked out by hand or by numpy."""

import math

import numpy as np
import pytest

from tillweave.functions import metrics as m
from tillweave.operators import scoring

CASES = {
    "plain": ([100, 200, 300, 400, 500], [110, 190, 310, 390, 510]),
    "zeros": ([0, 100, 200, 0, 300], [10, 110, 190, 20, 310]),
    "negatives": ([-100, 100, 200, -50, 300], [-90, 110, 190, -40, 310]),
}


def frame(spark, y, p):
    return spark.createDataFrame([(i, float(a), float(b)) for i, (a, b) in enumerate(zip(y, p))], "i int, y_true double, y_pred double")


@pytest.mark.parametrize("case", CASES)
def test_against_numpy(spark, case):
    y, p = (np.array(v, dtype=float) for v in CASES[case])
    got = scoring.metrics(frame(spark, y, p)).first()
    some, size = y != 0, np.abs(y) + np.abs(p)
    assert got.mae == pytest.approx(np.mean(np.abs(y - p)))
    assert got.rmse == pytest.approx(np.sqrt(np.mean((y - p) ** 2)))
    assert got.mape == pytest.approx(100 * np.mean(np.abs((y[some] - p[some]) / y[some])))
    assert got.smape == pytest.approx(100 * np.mean(2 * np.abs(p - y) / size))
    assert got.wape == pytest.approx(100 * np.sum(np.abs(y - p)) / np.sum(y))


def test_plain_case_by_hand(spark):
    got = scoring.metrics(frame(spark, *CASES["plain"])).first()
    assert (got.mae, got.rmse) == (10, 10) and got.wape == pytest.approx(10 / 3)


def test_edges(spark):
    empty = scoring.metrics(frame(spark, [], [])).first()
    assert all(v is None for v in empty)
    zero = scoring.metrics(frame(spark, [0, 0], [0, 0])).first()
    assert (zero.mae, zero.rmse, zero.mape, zero.smape, zero.wape) == (0, 0, None, None, None)
    one = scoring.metrics(frame(spark, [100], [110])).first()
    assert one.mae == 10


def test_unguarded_mape(spark):
    assert frame(spark, [0, 100], [10, 110]).agg(m.mape(guard=False)).first()[0] == math.inf
    assert math.isnan(frame(spark, [0, 100], [0, 110]).agg(m.mape(guard=False)).first()[0])


def test_fold_values(spark):
    got = scoring.metrics(frame(spark, [10000, 20000, 30000], [11000, 19000, 31000])).first()
    assert got.mae == 1000 and got.rmse == 1000 and got.wape == pytest.approx(5)


def test_rolling_needs_a_full_window(spark):
    df = frame(spark, range(1, 21), range(2, 22)).selectExpr(
        "1L as Store", "1L as Dept", "date_add(date'2020-01-05', 7 * i) as Date", "y_true", "y_pred")
    rows = scoring.rolling_metrics(df).orderBy("Date").collect()
    assert [r.rolling_mae for r in rows] == [None] * 12 + [1.0] * 8
