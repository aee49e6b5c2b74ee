"""Every registered query against its SQL twin, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from scriptorium.plans.oracle import ORACLE
from scriptorium.plans.registry import QUERIES
from tests.compare import connect, differences

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def connection():
    return connect(FOLDER)


@pytest.mark.parametrize("key", sorted(oracle_sql()))
def test_equals_sql(spark, connection, key):
    assert differences(queries()[key](spark, FOLDER), connection, oracle_sql()[key]) == []


def test_only_the_approximate_query_has_no_sql():
    assert set(QUERIES) - set(ORACLE) == {"knn_approx"}
    assert set(oracle_sql()) <= set(queries())


def test_approximate_neighbours_are_mostly_the_exact_ones(spark):
    for folder in (FOLDER, "/root/testdata/sf0.01"):
        exact = {r["paper_id"] for r in queries()["knn_cosine"](spark, folder).collect()}
        near = {r["paper_id"] for r in queries()["knn_approx"](spark, folder).collect()}
        assert len(near) == len(exact) == 100
        assert len(near & exact) >= 90


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
