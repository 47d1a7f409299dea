"""Every registered query of the effort operators against its DuckDB twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from burnup.plans.registry import load_all
from conftest import SMALL
from oracle import compare

QUERIES, ORACLE = load_all()


def test_every_query_has_an_oracle():
    missing = sorted(set(QUERIES) - set(ORACLE))
    assert missing == [], missing


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_oracle(spark, duck_small, name):
    res = compare(QUERIES[name](spark, SMALL), ORACLE[name], duck_small)
    assert res["values_match"] and res["types_match"], res


def test_entry_holds_them():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "estimated_points" in df.columns
