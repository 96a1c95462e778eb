"""Physical-plan checks: no single-partition exchange, no Python UDF, broadcast
only where the size is checked, one scan for the compare operators."""

import contextlib
import io

import pytest

import __spark_entry__ as entry
from riskframe.plans import bindings
from tests.conftest import SF001

PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                "PythonUDF")


def plan(df):
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


@pytest.mark.parametrize("name", ["q08_age_quantile_profile", "q11_quantile_success",
                                  "win_ntile_exact", "win_ntile_ties",
                                  "loan_q08_age_quantile_profile", "loan_q11_quantile_success"])
def test_ntile_has_no_single_partition(spark, name):
    p = plan(entry.queries()[name](spark, SF001))
    assert "SinglePartition" not in p
    assert "Window" not in p


@pytest.mark.parametrize("name", sorted(n for n in bindings.REGISTRY if not n.startswith("ml_") and n != "loan_ml_job"))
def test_no_python_udf(spark, name):
    p = plan(entry.queries()[name](spark, SF001))
    assert not any(n in p for n in PYTHON_NODES)


def test_group_mean_is_broadcast_not_window(spark):
    p = plan(entry.queries()["q06_diff_from_group_mean"](spark, SF001))
    assert "BroadcastHashJoin" in p and "Window" not in p


@pytest.mark.parametrize("name", ["q10_compare_to_overall", "q12_compare_to_subgroup",
                                  "join_vs_overall", "join_vs_subgroup"])
def test_compare_reads_source_once(spark, name):
    # the per-group aggregate is computed once (one scan of the source) and
    # checkpointed; the answer then reads only that small table
    df = entry.queries()[name](spark, SF001)
    p = plan(df)
    assert "Scan parquet" not in p and "Scan ExistingRDD" in p, p


def test_filters_and_columns_pushed(spark):
    p = plan(entry.queries()["q02_conditional_count"](spark, SF001))
    assert "PushedFilters: [IsNotNull(l_quantity), IsNotNull(l_returnflag), GreaterThan(l_quantity,45.0)" in p
    assert "ReadSchema: struct<l_quantity:double,l_returnflag:string>" in p
