"""Every SQL-expressible catalogue key equals its DuckDB oracle exactly
(column names, types, rows, values bit for bit) on the smallest tables."""

import pytest

import __spark_entry__ as E
from tools.check_oracle import compare

from conftest import SF_SMALL

KEYS = sorted(E.oracle_sql())


def test_every_query_has_a_catalogue_entry():
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_smoke(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) >= 1
    assert df.columns == ["store_type", "n_stores", "avg_sales", "total_sales", "avg_customers"]


@pytest.mark.parametrize("key", KEYS)
def test_matches_oracle(spark, key):
    res = compare(spark, SF_SMALL, [key], verbose=False)
    assert res[key][0] == "MATCH", res[key]
