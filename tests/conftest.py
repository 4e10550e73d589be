from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql.pandas.types import to_arrow_schema

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402

from mailtax import schemas  # noqa: E402
from mailtax.plans.session import configure  # noqa: E402

AS_OF = datetime(2024, 1, 31)


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("mailtax-tests")
    session = (
        configure(builder)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def table(spark):
    """``table(name, rows)``: a DataFrame of that schema; columns missing in a row are NULL."""

    def make(name: str, rows: list[dict]):
        names = schemas.columns(name)
        for row in rows:
            assert set(row) <= set(names), set(row) - set(names)
        arrow = pa.Table.from_pylist(rows, schema=to_arrow_schema(schemas.schema(name)))
        return spark.createDataFrame(arrow, schemas.schema(name))

    return make


@pytest.fixture
def billing(table):
    """A small billing world as ``{table: rows}`` merged over defaults; returns the DataFrames."""

    def make(**rows):
        base = {
            "sessions": [{"session_key": 1, "session_id": "s1", "client_configuration_key": 9}],
            "invoices": [{"invoice_key": 10, "session_key": 1, "client_configuration_key": 9}],
            "sales_tax_codes": [{"sales_tax_code_key": 1, "tax_code": "P0"}],
            "sales_tax_batch_statuses": [
                {"status_key": 5, "status_id": "7BB2234C-2EEC-4AC3-BBA0-E4F9EF019E9C"}
            ],
            "client_configurations": [
                {"client_configuration_key": 9, "account_code": "A9", "taxable_city": "HOME",
                 "taxable_state": "HS", "taxable_postal_code": "00009"}
            ],
            "customers": [{"customer_id": 77, "account": "A9"}],
        }
        base.update(rows)
        return {name: table(name, base.get(name, [])) for name in schemas.SCHEMAS}

    return make
