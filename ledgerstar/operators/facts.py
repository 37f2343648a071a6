"""The transaction fact table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerstar.functions import calendar
from ledgerstar.operators.dimensions import dim_transaction_type


def fact_transactions(processed: DataFrame, types: DataFrame | None = None) -> DataFrame:
    """Cleansed transactions with surrogate keys; an unknown type gets a null ``type_key``.

    The standard type dimension is a literal of four rows and always broadcast: a shuffle by
    type would send the whole fact to as many tasks as there are types. Another dimension may
    be passed; its join strategy is left to Spark, as its size is not known here.
    """
    if types is None:
        types = F.broadcast(dim_transaction_type(processed.sparkSession))
    keys = types.select("type_key", "type_name")
    joined = processed.join(keys, F.col("transaction_type") == F.col("type_name"), "left")
    return joined.selectExpr(
        "transaction_id",
        "customer_id",
        f"{calendar.date_key('transaction_date')} AS date_key",
        "type_key",
        "transaction_type",
        "amount",
        "status",
        "is_anomaly",
        "transaction_date",
        "tx_year",
        "tx_month",
        "tx_day_of_week",
        "tx_hour",
    )
