"""Datasets behind the six charts, and the headline figures.

Arguments are as in :mod:`ledgerstar.plans.reports`. Each result is small and complete; a
caller that plots it may take it to the driver.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerstar.functions import calendar, money
from ledgerstar.operators.rollups import (
    ANOMALY_PERCENT,
    MEAN_AMOUNT,
    MEASURES,
    REVENUE,
    TOTAL_CENTS,
    rollup,
)
from ledgerstar.plans.reports import by_customer
from ledgerstar.schemas import TRANSACTION_TYPES

DAYS, HOURS = 7, 24
REST = "other"  # the pivot's column for types that are not listed
PERIOD = calendar.period_label("tx_year", "tx_month")


def monthly_volume(activity: DataFrame) -> DataFrame:
    """Transactions and revenue per month, labelled ``YYYY-MM``."""
    return (
        rollup(activity, "tx_year", "tx_month")
        .selectExpr(
            "tx_year", "tx_month", "tx_count", f"{REVENUE} AS total_revenue", f"{PERIOD} AS period"
        )
        .orderBy("tx_year", "tx_month")
    )


def type_distribution(activity: DataFrame) -> DataFrame:
    """Count and revenue per transaction type, each with its share of the whole in percent.

    The whole is a scalar subquery over the same rollup, not a window without partitions: the
    types are not validated, so their number has no bound.
    """
    per_type = rollup(activity, "transaction_type").selectExpr(
        "transaction_type", "tx_count", f"{TOTAL_CENTS} AS cents"
    )
    whole = per_type.agg(F.expr("struct(sum(tx_count) AS rows, sum(cents) AS cents)"))
    return per_type.withColumn("whole", whole.scalar()).selectExpr(
        "transaction_type",
        "tx_count AS count",
        f"{money.dollars('cents')} AS total",
        f"{money.percent('tx_count', 'whole.rows', 1)} AS count_share",
        f"{money.percent('cents', 'whole.cents', 1)} AS revenue_share",
    )


def top_customers(
    spending: DataFrame, customers: DataFrame | None = None, k: int = 10
) -> DataFrame:
    """The ``k`` customers with the highest spend, with the columns a bar chart labels."""
    return (
        by_customer(spending, customers, "first_name", "last_name", "account_type")
        .selectExpr(
            "customer_id",
            "first_name",
            "last_name",
            "account_type",
            f"{REVENUE} AS total_spend",
            "tx_count",
            "concat(first_name, ' ', last_name) AS name",
        )
        .orderBy(F.desc("total_spend"), "customer_id")
        .limit(k)
    )


def _cells(spending: DataFrame, customers: DataFrame | None) -> DataFrame:
    """A rollup per account type and transaction type."""
    if customers is not None:
        spending = customers.select("customer_id", "account_type").join(
            rollup(spending, "customer_id", "transaction_type"), "customer_id"
        )
    return rollup(spending, "account_type", "transaction_type")


def account_revenue(spending: DataFrame, customers: DataFrame | None = None) -> DataFrame:
    """Revenue per account type and transaction type, one row per pair."""
    return _cells(spending, customers).selectExpr(
        "account_type", "transaction_type", f"{REVENUE} AS revenue"
    )


def account_pivot(
    spending: DataFrame,
    customers: DataFrame | None = None,
    types: Sequence[str] = TRANSACTION_TYPES,
) -> DataFrame:
    """Account types by transaction types, zero where there is no revenue.

    There is a column for each of ``types``, and ``other`` (``REST``) for every other and for null types, so each
    row adds up to the account's revenue whatever the types in the data. A declared type of that name
    is refused, as its column would be the one of the rest. Null account types are a row. Cents are
    summed, so the result does not depend on the order of tasks.
    """
    if REST in types:
        raise ValueError(f"no column can be named {REST!r}: it holds all types that are not listed")
    cells = _cells(spending, customers).selectExpr("account_type", "transaction_type", f"{TOTAL_CENTS} AS cents")
    listed = F.coalesce(F.col("transaction_type").isin(*types), F.lit(False))
    tests = {name: F.col("transaction_type").eqNullSafe(name) for name in types} | {REST: ~listed}
    sums = cells.groupBy("account_type").agg(
        *[F.sum(F.when(test, F.col("cents"))).alias(name) for name, test in tests.items()]
    )
    return sums.select(
        "account_type",
        *[F.expr(f"coalesce({money.dollars(f'`{name}`')}, 0D)").alias(name) for name in tests],
    )


def anomaly_rate(activity: DataFrame) -> DataFrame:
    """Anomalies per month and their share in percent."""
    return (
        rollup(activity, "tx_year", "tx_month")
        .selectExpr(
            "tx_year",
            "tx_month",
            "tx_count AS total",
            "anomaly_count AS anomalies",
            f"{PERIOD} AS period",
            f"{ANOMALY_PERCENT} AS anomaly_rate",
        )
        .orderBy("tx_year", "tx_month")
    )


def undated(activity: DataFrame) -> DataFrame:
    """One row with the transactions that have no date, and so no cell in :func:`heatmap`."""
    return rollup(activity.filter("tx_day_of_week IS NULL OR tx_hour IS NULL")).na.fill(0).select("tx_count")


def heatmap(activity: DataFrame) -> DataFrame:
    """Transactions per day of week and hour: all 168 cells, zeros included.

    ``above_mean`` marks the cells that a plot annotates. The window has no partition, but
    never more than 168 rows.
    """
    cells = DAYS * HOURS
    counts = (
        rollup(activity, "tx_day_of_week", "tx_hour")
        .dropna(subset=["tx_day_of_week", "tx_hour"])
        .select("tx_day_of_week", "tx_hour", "tx_count")
    )
    zeros = activity.sparkSession.range(0, cells, 1, 1).selectExpr(
        f"int(id div {HOURS}) + 1 AS tx_day_of_week", f"int(id % {HOURS}) AS tx_hour", "0L AS tx_count"
    )
    grid = (
        counts.unionByName(zeros)
        .groupBy("tx_day_of_week", "tx_hour")
        .agg(F.sum("tx_count").alias("tx_count"))
    )
    return grid.selectExpr(
        "tx_day_of_week",
        f"{calendar.day_label('tx_day_of_week')} AS day_label",
        "tx_hour",
        f"{calendar.hour_label('tx_hour')} AS hour_label",
        "tx_count",
        f"tx_count * {cells} > sum(tx_count) OVER () AS above_mean",
    ).orderBy("tx_day_of_week", "tx_hour")


def kpi_summary(activity: DataFrame, customers: DataFrame) -> DataFrame:
    """Six headline figures in one row; amounts and rate are null without transactions."""
    facts = rollup(activity).withColumn("customers", F.lit(0).cast("bigint"))
    people = customers.agg(F.count("*").alias("customers")).selectExpr(
        *[f"CAST(NULL AS BIGINT) AS {name}" for name in MEASURES], "customers"
    )
    joint = facts.unionByName(people)
    return joint.agg(*[F.expr(f"sum({name}) AS {name}") for name in joint.columns]).selectExpr(
        "coalesce(tx_count, 0L) AS total_transactions",
        f"{REVENUE} AS total_revenue",
        f"{MEAN_AMOUNT} AS avg_transaction",
        "customers AS total_customers",
        "coalesce(anomaly_count, 0L) AS anomalies",
        f"{ANOMALY_PERCENT} AS anomaly_rate",
    )
