"""Mergeable rollups: the only aggregation that reads the fact table.

A rollup row holds partial aggregates that add up, so it can be rolled up again to any
subset of its keys. Reports read rollups, never the fact. A standalone report asks for just
its own keys; a batch run writes two wide rollups once and answers every report from them.
Each task reduces its rows to one per key before the shuffle, so a key that holds a third of
all rows costs no more there than any other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ledgerstar.functions import money

MEASURES = ("tx_count", "amount_count", "amount_blocks", "amount_rest", "anomaly_count")

ACTIVITY_KEYS = (
    "date_key",
    "tx_year",
    "tx_month",
    "tx_day_of_week",
    "tx_hour",
    "transaction_type",
    "is_anomaly",
)
CUSTOMER_KEYS = ("customer_id", "transaction_type")


def rollup(frame: DataFrame, *keys: str, **extra: Column) -> DataFrame:
    """Measures per ``keys`` of a fact table, or of a finer rollup, with ``extra`` aggregates."""
    if set(MEASURES) <= set(frame.columns):
        measures = [F.expr(f"sum({name}) AS {name}") for name in MEASURES]
    else:
        measures = [
            F.expr("count(*) AS tx_count"),
            F.expr("count(amount) AS amount_count"),
            F.expr(f"{money.sum_blocks('amount')} AS amount_blocks"),
            F.expr(f"{money.sum_rest('amount')} AS amount_rest"),
            F.expr("count_if(is_anomaly) AS anomaly_count"),
        ]
    return frame.groupBy(*keys).agg(*measures, *[c.alias(name) for name, c in extra.items()])


# Expressions over the measures of a rollup row; a null amount counts in no total or mean
TOTAL_CENTS = money.total_cents("amount_blocks", "amount_rest")
REVENUE = money.dollars(TOTAL_CENTS)
MEAN_AMOUNT = money.mean_dollars(TOTAL_CENTS, "amount_count")
ANOMALY_PERCENT = money.percent("anomaly_count", "tx_count", 2)
