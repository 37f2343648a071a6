"""Dimension tables of the star schema."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerstar.functions import calendar
from ledgerstar.schemas import TYPE_DIMENSION_ROWS


def dim_customers(customers: DataFrame, as_of: datetime.date | None = None) -> DataFrame:
    """Customers with their tenure in days on ``as_of`` (today when not given)."""
    today = F.current_date() if as_of is None else F.lit(as_of)
    return customers.select(
        "customer_id",
        "first_name",
        "last_name",
        "email",
        "phone_number",
        "account_type",
        "join_date",
        F.datediff(today, "join_date").alias("tenure_days"),
    )


def dim_date(observed: DataFrame) -> DataFrame:
    """One row per observed transaction date, in date order; gaps are not filled.

    ``observed`` is any frame with ``date_key`` (the fact, or a rollup of it) or else with
    ``transaction_date``. The distinct runs before the derived columns, so those are computed
    once per date and only dates are shuffled.
    """
    if "date_key" in observed.columns:
        dates = observed.select("date_key").distinct().selectExpr(
            "date_key", f"{calendar.date_of_key('date_key')} AS full_date"
        )
    else:
        dates = observed.selectExpr("to_date(transaction_date) AS full_date").distinct().selectExpr(
            f"{calendar.date_key('full_date')} AS date_key", "full_date"
        )
    return dates.selectExpr(
        "date_key",
        "full_date",
        "year(full_date) AS year",
        "quarter(full_date) AS quarter",
        "month(full_date) AS month",
        "date_format(full_date, 'MMMM') AS month_name",
        "day(full_date) AS day",
        "dayofweek(full_date) AS day_of_week",
        "date_format(full_date, 'EEEE') AS day_name",
        f"{calendar.is_weekend('full_date')} AS is_weekend",
    ).orderBy("date_key")


def dim_transaction_type(spark: SparkSession) -> DataFrame:
    """The four known transaction types, as an inline table with known size."""
    rows = ", ".join(f"({key}, '{name}', '{text}')" for key, name, text in TYPE_DIMENSION_ROWS)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(type_key, type_name, type_description)")
