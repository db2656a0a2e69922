"""Every registered query against its SQL, at the smallest scale."""

from __future__ import annotations

import pytest

import __spark_entry__ as spark_entry
from headway.verify.compare import differences, duck
from headway.verify.oracle import ORACLE
from headway.verify.queries import QUERIES


@pytest.fixture(scope="module")
def connection(sf_dir):
    return duck(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(spark_entry.queries()) and set(ORACLE) <= set(spark_entry.oracle_sql())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, sf_dir, connection, name):
    problem = differences(QUERIES[name](spark, sf_dir), connection, ORACLE[name])
    assert not problem, problem


def test_entry(spark):
    df = spark_entry.entry(spark)
    assert "lines_by_stop" in df.columns
    assert df.count() > 0
