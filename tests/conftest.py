from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tests")]

from parcelscope.schemas import BRONZE  # noqa: E402
from parcelscope.settings import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory) -> SparkSession:
    base = tmp_path_factory.mktemp("spark")
    session = build_session(
        "parcelscope-tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(base / "checkpoints"),
            "spark.sql.warehouse.dir": str(base / "warehouse"),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def ts(text: str | None) -> datetime | None:
    return None if text is None else datetime.fromisoformat(text)


@pytest.fixture
def bronze(spark):
    """bronze('orders', {...}, {...}) builds a bronze table from partial rows; the rest is null."""

    def build(table: str, *rows: dict):
        schema = BRONZE[table]
        return spark.createDataFrame(
            [tuple(row.get(name) for name in schema.fieldNames()) for row in rows], schema
        )

    return build


def order(order_id, customer_id=None, bought="2017-03-01", delivered=None, due=None, status="delivered"):
    return {
        "order_id": order_id,
        "customer_id": customer_id or f"c{order_id}",
        "order_status": status,
        "order_purchase_timestamp": ts(bought),
        "order_delivered_customer_date": ts(delivered),
        "order_estimated_delivery_date": ts(due),
    }


def rows(df, *columns):
    """Rows as plain tuples, sorted."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=str)
