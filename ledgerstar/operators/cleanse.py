"""Cleansing and enrichment of raw transactions: one narrow stage, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerstar.schemas import ANOMALY_THRESHOLD, REMOVED_STATUS


def cleanse(
    transactions: DataFrame,
    threshold: float = ANOMALY_THRESHOLD,
    removed_status: str = REMOVED_STATUS,
) -> DataFrame:
    """Drop removed transactions, flag anomalies, add calendar features, round the amount.

    A null status is dropped with the removed ones. The flag looks at the amount before
    rounding, and is false for a null amount.
    """
    return transactions.filter(F.col("status") != removed_status).withColumns(
        {
            "is_anomaly": F.coalesce(F.col("amount") > threshold, F.lit(False)),
            "tx_year": F.expr("year(transaction_date)"),
            "tx_month": F.expr("month(transaction_date)"),
            "tx_day_of_week": F.expr("dayofweek(transaction_date)"),
            "tx_hour": F.expr("hour(transaction_date)"),
            "amount": F.expr("CAST(round(amount, 2) AS DOUBLE)"),
        }
    )
