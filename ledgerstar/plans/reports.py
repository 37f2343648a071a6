"""The six warehouse reports.

``activity`` and ``spending`` are the fact table or a rollup that holds at least the keys a
report names. Joins to dimensions run on rolled-up rows: at most one per customer (and type)
or day, so neither hot customers nor the row count of the fact reach a join. ``customers`` may
be left out where ``spending`` comes from :func:`customer_spending`, which has joined them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ledgerstar.operators.rollups import CUSTOMER_KEYS, MEAN_AMOUNT, REVENUE, rollup
from ledgerstar.schemas import TENURE_SEGMENTS

CUSTOMER_ATTRIBUTES = ("first_name", "last_name", "account_type", "tenure_days")


def customer_spending(spending: DataFrame, customers: DataFrame) -> DataFrame:
    """Rollup per customer and type with the customer's attributes: one join for all reports.

    Transactions without a known customer drop out. The dimension is on the left, which a
    sort-merge join streams: it buffers only the rollup rows of one customer.
    """
    return customers.select("customer_id", *CUSTOMER_ATTRIBUTES).join(
        rollup(spending, *CUSTOMER_KEYS), "customer_id"
    )


def by_customer(
    spending: DataFrame, customers: DataFrame | None, *attributes: str
) -> DataFrame:
    """Measures per customer and attributes; transactions without a known customer drop out.

    Grouping again after the join merges repeated dimension rows, should the key not be
    unique. The rows are already partitioned by customer, so it adds no shuffle.
    """
    if customers is not None:
        spending = customers.select("customer_id", *attributes).join(
            rollup(spending, "customer_id"), "customer_id"
        )
    return rollup(spending, "customer_id", *attributes)


def tenure_segment(days: str) -> str:
    """SQL for the label of a tenure bucket; an unknown tenure falls into the open bucket."""
    *bounded, (_, last) = TENURE_SEGMENTS
    branches = " ".join(f"WHEN {days} < {bound} THEN '{label}'" for bound, label in bounded)
    return f"CASE {branches} ELSE '{last}' END"


def monthly_revenue(activity: DataFrame) -> DataFrame:
    """Transactions, revenue and mean amount per month."""
    return (
        rollup(activity, "tx_year", "tx_month")
        .selectExpr(
            "tx_year",
            "tx_month",
            "tx_count AS total_transactions",
            f"{REVENUE} AS total_revenue",
            f"{MEAN_AMOUNT} AS avg_transaction_amount",
        )
        .orderBy("tx_year", "tx_month")
    )


def revenue_by_account(spending: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Revenue and number of paying customers per account type, largest first."""
    per_customer = by_customer(spending, customers, "account_type")
    return (
        rollup(per_customer, "account_type", people=F.count("*"))
        .selectExpr(
            "account_type",
            "tx_count AS transaction_count",
            f"{REVENUE} AS total_revenue",
            f"{MEAN_AMOUNT} AS avg_amount",
            "people AS unique_customers",
        )
        .orderBy(F.desc("total_revenue"), "account_type")
    )


def top_customers(
    spending: DataFrame, customers: DataFrame | None = None, k: int = 10
) -> DataFrame:
    """The ``k`` customers with the highest spend; equal spend is ordered by customer."""
    return (
        by_customer(spending, customers, "first_name", "last_name", "account_type")
        .selectExpr(
            "customer_id",
            "concat(first_name, ' ', last_name) AS customer_name",
            "account_type",
            "tx_count AS transaction_count",
            f"{REVENUE} AS total_spend",
        )
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(k)
    )


def weekend_weekday(activity: DataFrame, dates: DataFrame) -> DataFrame:
    """Weekend against weekday activity."""
    per_day = dates.select("date_key", "is_weekend").join(rollup(activity, "date_key"), "date_key")
    return (
        rollup(per_day, "is_weekend")
        .selectExpr(
            "is_weekend",
            "CASE WHEN is_weekend THEN 'Weekend' ELSE 'Weekday' END AS period",
            "tx_count AS transaction_count",
            f"{REVENUE} AS total_revenue",
            f"{MEAN_AMOUNT} AS avg_amount",
        )
        .orderBy("is_weekend")
    )


def anomaly_summary(activity: DataFrame) -> DataFrame:
    """Count and amounts per transaction type and anomaly flag."""
    return (
        rollup(activity, "transaction_type", "is_anomaly")
        .selectExpr(
            "transaction_type",
            "is_anomaly",
            "tx_count AS count",
            f"{REVENUE} AS total_amount",
            f"{MEAN_AMOUNT} AS avg_amount",
        )
        .orderBy("transaction_type", "is_anomaly")
    )


def tenure_segments(spending: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Paying customers, transactions and revenue per tenure bucket, largest revenue first."""
    segment = {"tenure_segment": F.expr(tenure_segment("tenure_days"))}
    if customers is None:
        spending = spending.withColumns(segment)
    else:
        customers = customers.withColumns(segment)
    per_customer = by_customer(spending, customers, "tenure_segment")
    return (
        rollup(per_customer, "tenure_segment", people=F.count("*"))
        .selectExpr(
            "tenure_segment",
            "people AS customer_count",
            "tx_count AS transaction_count",
            f"{REVENUE} AS total_revenue",
        )
        .orderBy(F.desc("total_revenue"), "tenure_segment")
    )
