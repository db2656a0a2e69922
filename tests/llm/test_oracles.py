"""Registered queries against DuckDB, on whole tables."""

import duckdb
import pytest

import __spark_entry__
from headway.llm.queries import ORACLE, QUERIES


def _rows(frame):
    plain = lambda v: None if v is None or v != v else round(v, 5) if isinstance(v, float) else v
    return sorted(([plain(v) for v in r] for r in frame), key=str)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(llm, sf_dir, name):
    db = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "labels", "embeddings"):
        db.sql(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    found = QUERIES[name](llm, sf_dir)
    columns = sorted(found.columns)
    wanted = db.sql(f"select {', '.join(columns)} from ({ORACLE[name]})").fetchall()
    assert _rows(found.select(*columns).collect()) == _rows(wanted)


def test_registered_sql_is_of_registered_queries():
    assert set(ORACLE) <= set(QUERIES)
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())


def test_all_are_registered():
    registered = __spark_entry__.queries()
    assert {name.split("_")[0] for name in registered if name.startswith("op")} == {f"op{n}" for n in range(1, 14)}
    assert "pipeline" in registered
