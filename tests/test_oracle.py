"""Every query with SQL gives the same rows on Spark and on DuckDB."""

import os

import pytest
from compare import compare, connect

import __spark_entry__ as entry_module

SF = "/root/testdata/sf0.001"
# Whole runs and fits with every default take most of the time of all queries:
# they are compared on demand (SLOW=1) or with tests/compare.py.
SLOW = {
    "classification_run", "clustering_run", "compare_models", "run_clustering", "segmentation", "random_search_logistic",
    "classifier_gradient_boosting", "classifier_round_trip",
}
NAMES = [n for n in sorted(entry_module.oracle_sql()) if os.environ.get("SLOW") or n not in SLOW]


@pytest.fixture(scope="module")
def duck():
    return connect(SF)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows(spark, duck, name):
    queries, sql = entry_module.queries(), entry_module.oracle_sql()
    same, rows, _, note = compare(spark, duck, name, queries[name], sql[name], SF)
    assert same, note


def test_entry(spark):
    out = entry_module.entry(spark)
    assert out.count() == 4 and "prediction" in out.columns


def test_every_sql_belongs_to_a_query():
    assert set(entry_module.oracle_sql()) <= set(entry_module.queries())
