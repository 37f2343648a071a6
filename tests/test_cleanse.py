import datetime as dt

import pytest
from pyspark.sql import functions as F

from helpers import rows, transactions
from ledgerstar.operators.cleanse import cleanse


def test_removes_failed_and_unknown_status(spark):
    raw = transactions(
        spark, *[{"status": s} for s in ("Completed", "Pending", "Failed", None, "Unknown")]
    )
    assert {r["status"] for r in rows(cleanse(raw))} == {"Completed", "Pending", "Unknown"}


@pytest.mark.parametrize("amount_type", ["decimal(18,4)", "double"])
def test_flag_before_rounding(spark, amount_type):
    raw = transactions(
        spark, *[{"amount": a} for a in ("4500.00", "4500.004", "4500.01", "1.005", None)]
    ).withColumn("amount", F.col("amount").cast(amount_type))
    found = {r["transaction_id"]: (r["amount"], r["is_anomaly"]) for r in rows(cleanse(raw))}
    assert found == {
        "t0": (4500.0, False),
        "t1": (4500.0, True),
        "t2": (4500.01, True),
        "t3": (1.01, False),
        "t4": (None, False),
    }


@pytest.mark.parametrize("timestamp", ["timestamp", "timestamp_ntz"])
def test_calendar_features(spark, timestamp):
    moments = [
        dt.datetime(2024, 5, 3, 23, 59, 59),  # Friday
        dt.datetime(2024, 5, 4, 0, 0, 0),
        dt.datetime(2024, 5, 5, 7, 30, 0),
        dt.datetime(2024, 12, 31, 23, 0, 0),
        dt.datetime(2025, 1, 1, 0, 0, 0),
    ]
    raw = transactions(spark, *[{"transaction_date": m} for m in moments], timestamp=timestamp)
    found = [
        (r["tx_year"], r["tx_month"], r["tx_day_of_week"], r["tx_hour"])
        for r in sorted(rows(cleanse(raw)), key=lambda r: r["transaction_id"])
    ]
    assert found == [
        (2024, 5, 6, 23),
        (2024, 5, 7, 0),
        (2024, 5, 1, 7),
        (2024, 12, 3, 23),
        (2025, 1, 4, 0),
    ]


def test_threshold_and_status_are_arguments(spark):
    raw = transactions(spark, {"amount": "11"}, {"amount": "9", "status": "Pending"})
    found = rows(cleanse(raw, threshold=10, removed_status="Pending"))
    assert [(r["amount"], r["is_anomaly"]) for r in found] == [(11.0, True)]


def test_column_order(spark):
    assert cleanse(transactions(spark, {})).columns == [
        "transaction_id", "customer_id", "transaction_date", "transaction_type", "amount",
        "status", "is_anomaly", "tx_year", "tx_month", "tx_day_of_week", "tx_hour",
    ]
