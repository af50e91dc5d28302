"""Every query that has SQL, against DuckDB on the smallest tables."""

import os

import pytest

import oracle_check
from tillweave.catalog.oracle import ORACLE
from tillweave.catalog.queries import QUERIES
from tillweave.session import clear_scratch

ROOT = "/root/testdata/sf0.001"

#: Ten more fits of 100 trees, run with TILLWEAVE_SLOW=1; the boosted_small_ queries compare the same operators by value.
LONG = {"boosted_cv", "boosted_backtest", "boosted_early_stop", "boosted_fit_metrics"}


@pytest.fixture(scope="module")
def con():
    return oracle_check.duck(ROOT)


def test_every_statement_has_a_query():
    assert set(ORACLE) <= set(QUERIES)


SLOW = pytest.mark.skipif(os.environ.get("TILLWEAVE_SLOW") != "1", reason="minutes of tree growing; set TILLWEAVE_SLOW=1")


@pytest.mark.parametrize("name", [pytest.param(n, marks=[SLOW] if n in LONG else []) for n in sorted(ORACLE)])
def test_equals_sql(spark, con, name):
    assert oracle_check.differences(spark, con, ROOT, QUERIES[name], ORACLE[name]) == []


def test_queries_run_again_after_the_scratch_space_is_cleared(spark):
    before = QUERIES["sales_stats"](spark, ROOT).collect()
    clear_scratch(spark)
    assert QUERIES["sales_stats"](spark, ROOT).collect() == before
