"""Every registered query against its DuckDB SQL on the smallest data set."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as entry
from mailtax.plans.queries import all_queries

SF_DIR = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def _sorted(rows):
    return sorted(rows, key=lambda row: tuple((v is None, str(type(v)), v if v is not None else 0) for v in row))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_duckdb(spark, duck, name):
    found = entry.queries()[name](spark, SF_DIR)
    columns = sorted(found.columns)
    expected = duck.sql(f"SELECT {', '.join(columns)} FROM ({entry.oracle_sql()[name]})")
    assert sorted(duck.sql(entry.oracle_sql()[name]).columns) == columns
    rows = _sorted(tuple(r) for r in found.select(*columns).collect())
    assert rows
    assert rows == _sorted(expected.fetchall())


@pytest.mark.parametrize("one, other", [
    ("session_line_item_batches", "session_line_item_batches_strict"),
    ("non_service_lines_with_item", "non_service_lines_with_catalogue_item"),
    ("link_details_to_transactions", "link_details_last_wins"),
])
def test_variants_have_different_rows(duck, one, other):
    sql = entry.oracle_sql()
    assert duck.sql(f"SELECT 1 FROM (SELECT * FROM ({sql[one]}) EXCEPT SELECT * FROM ({sql[other]})) UNION ALL "
                    f"SELECT 1 FROM (SELECT * FROM ({sql[other]}) EXCEPT SELECT * FROM ({sql[one]}))").fetchall()


def test_every_job_has_sql():
    assert set(all_queries()) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
