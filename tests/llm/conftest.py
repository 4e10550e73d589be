from __future__ import annotations

import random

import duckdb
import pytest

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="session")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, an extra column whose name an operator could use itself."""
    long = "word other " * 20_000
    rows = [(1, None), (2, ""), (3, " \n"), (4, "one two"), (4, "one two"), (5, long), (6, long + "x"), (None, "one two"), (None, None)]
    return spark.createDataFrame([(i, t, "x", i) for i, t in rows], "doc_id long, text string, k1 string, fp long")


@pytest.fixture(scope="session")
def empty(odd):
    return odd.limit(0)


@pytest.fixture
def duck():
    """``duck(tables, sql)``: sorted rows of DuckDB SQL over {name: (columns, rows)}."""

    def run(tables, sql, columns):
        con = duckdb.connect()
        for name, (kinds, rows) in tables.items():
            con.sql(f"CREATE TABLE {name} ({kinds})")
            if rows:
                con.executemany(f"INSERT INTO {name} VALUES ({', '.join('?' * len(rows[0]))})", rows)
        return sorted(con.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall(), key=str)

    return run


@pytest.fixture
def rng():
    return random.Random(11)
