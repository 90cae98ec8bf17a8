from __future__ import annotations

import os
import sys
from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from ratelens.session import configure  # noqa: E402
from ratelens.sources.schemas import FILINGS  # noqa: E402

AS_OF = date(2024, 6, 15)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("ratelens-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture(scope="session")
def as_of():
    return AS_OF


@pytest.fixture(scope="session")
def make(spark):
    """Filings from short rows; what is not given gets a default."""

    def build(*rows: dict):
        full = []
        for i, row in enumerate(rows):
            values = {
                "Record_ID": f"r{i:03d}",
                "Company": "Acme",
                "State": "Ohio",
                "Product_Line": "Auto",
                "Effective_Date": AS_OF,
                "Premium_Change_Number": "0.05",
                "Policyholders_Affected_Number": 10,
                "Impact_Score": "1",
                **row,
            }
            for name in ("Premium_Change_Number", "Impact_Score", "Total_Written_Premium_Number", "Previous_Increase_Number"):
                if values.get(name) is not None:
                    values[name] = Decimal(values[name])
            full.append(tuple(values.get(f.name) for f in FILINGS.fields))
        return spark.createDataFrame(full, FILINGS)

    return build
