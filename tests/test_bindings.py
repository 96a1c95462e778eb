"""Every SQL-expressible binding against DuckDB at sf0.001, and the driver contract."""

import os

import pytest

import __spark_entry__ as entry
from riskframe.plans import bindings
from scripts.check_oracle import compare, duck
from tests.conftest import SF001

def test_contract_keys():
    qs, sql = entry.queries(), entry.oracle_sql()
    assert set(sql) <= set(qs)
    assert set(bindings.REGISTRY) <= set(qs) and set(bindings.ORACLE) <= set(sql)


def test_entry_runs(spark):
    df = entry.entry(spark)
    rows = df.collect()
    assert df.columns == ["p_brand", "total_loans", "charged_off_count", "default_rate_pct"]
    assert len(rows) <= 10


@pytest.fixture(scope="module")
def con():
    if not os.path.exists(f"{SF001}/orders.parquet"):
        pytest.skip("test data missing")
    return duck(SF001)


@pytest.mark.parametrize("name", sorted(bindings.ORACLE))
def test_binding_matches_oracle(spark, con, name):
    problems = compare(spark, con, entry.queries()[name], entry.oracle_sql()[name], SF001)
    assert not problems, problems


@pytest.mark.parametrize("name", sorted(set(bindings.REGISTRY) - set(bindings.ORACLE)))
def test_rows_only_bindings_run(spark, name):
    first = sorted(map(str, entry.queries()[name](spark, SF001).collect()))
    assert first and first == sorted(map(str, entry.queries()[name](spark, SF001).collect()))
