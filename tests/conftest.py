from __future__ import annotations

import os
import sys
from datetime import datetime, timedelta
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from paytide import build_session  # noqa: E402

T0 = datetime(2024, 1, 10, 12, 0, 0)
TX_SCHEMA = (
    "id BIGINT, external_id STRING, amount DECIMAL(18,2), currency STRING, status STRING, "
    "type STRING, source_institution STRING, destination_institution STRING, "
    "source_account_id BIGINT, destination_account_id BIGINT, created_at TIMESTAMP, "
    "settled_at TIMESTAMP, updated_at TIMESTAMP, metadata STRING"
)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "6g",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def payment(i, at, amount="149.90", status="settled", src=1, dst=2, type_="pix", inst="001", **over):
    row = {
        "id": i,
        "external_id": f"e{i}",
        "amount": Decimal(amount),
        "currency": "BRL",
        "status": status,
        "type": type_,
        "source_institution": inst,
        "destination_institution": "002",
        "source_account_id": src,
        "destination_account_id": dst,
        "created_at": at,
        "settled_at": at + timedelta(seconds=2) if status == "settled" else None,
        "updated_at": at + timedelta(seconds=2) if status == "settled" else at,
        "metadata": "{}",
    }
    row.update(over)
    return tuple(row.values())


@pytest.fixture()
def make_tx(spark):
    return lambda rows: spark.createDataFrame(rows, TX_SCHEMA)


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def executed(df) -> str:
    """The plan as run, after adaptive execution."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()
