import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]


@pytest.fixture(scope="session")
def spark():
    from tillweave.session import clear_scratch, local_session

    session = local_session(4, "tests", "4g")
    yield session
    clear_scratch(session)
    session.stop()


@pytest.fixture(scope="session")
def panel(spark):
    """Three stores, two departments, 156 Sundays: 936 rows, no randomness."""
    rows = spark.range(156).withColumnRenamed("id", "w").crossJoin(spark.range(1, 4).toDF("Store")).crossJoin(
        spark.range(1, 3).toDF("Dept"))
    return rows.selectExpr(
        "Store", "Dept", "date_add(date'2020-01-05', cast(7 * w as int)) as Date",
        "cast(10000 + 100 * Store + 10 * Dept + (w * 7919 + Store * 104729 + Dept * 1299709) % 40000 as double) as Weekly_Sales",
        "w % 13 = 0 as IsHoliday").repartition(4)
