"""Every registered query against its check, and what its plan must not contain."""

import pytest

import __spark_entry__ as entry
from tests.compare import compare, duck
from transferlens.workload.catalog import CHECKS, QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_check(spark, con, name):
    assert compare(spark, con, FOLDER, name, QUERIES, CHECKS) is None


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.columns and df.limit(1).collect()


def test_checks_belong_to_queries():
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith("stream_")])
def test_plan_has_no_cross_join_and_no_python(spark, name, capsys):
    QUERIES[name](spark, FOLDER).explain("simple")
    plan = capsys.readouterr().out
    for banned in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas", "SinglePartition, REPARTITION"):
        assert banned not in plan
