"""Every registered query against its DuckDB oracle on sf0.001."""

import pytest

from datasets import SMALL

import __spark_entry__ as E
from paidpath.oracle import ORACLE
from paidpath.registry import QUERIES

NAMES = sorted(QUERIES)


def test_every_query_has_an_oracle():
    assert set(ORACLE) == set(QUERIES)


def test_entry_registers_every_query():
    assert set(QUERIES) <= set(E.queries()) and set(ORACLE) <= set(E.oracle_sql())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, name):
    from tools.oracle_check import compare
    res = compare(spark, SMALL, [name], verbose=False)[name]
    assert res[0] == "ok", res


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert df.columns[:2] == ["month", "metrics"]
