"""Transactions and customers derived from the generated tables by fixed formulas."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession

from ledgerstar.operators.cleanse import cleanse
from ledgerstar.operators import dimensions, facts
from ledgerstar.scratch import folder as scratch  # noqa: F401  (used as fixtures.scratch)

AS_OF = datetime.date(2001, 8, 2)  # stands in for the wall clock

# Types of the derived key and time columns
CUSTOMER_ID = "long"
TIMESTAMP = "timestamp_ntz"

# Columns of the generated tables; declared, as reading a footer would cost a job per query
ORDERS = (
    "o_orderkey LONG, o_custkey LONG, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING"
)
CUSTOMER = "c_custkey LONG, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"

# Fixed values of the mapping; "Fee" lies outside the valid types on purpose
TYPES = {
    "1-URGENT": "Deposit",
    "2-HIGH": "Withdrawal",
    "3-MEDIUM": "Transfer",
    "4-NOT SPECIFIED": "Payment",
    "5-LOW": "Fee",
}
STATUSES = {"F": "Completed", "O": "Pending", "P": "Failed"}
ACCOUNTS = {
    "BUILDING": "Checking",
    "HOUSEHOLD": "Checking",
    "AUTOMOBILE": "Savings",
    "FURNITURE": "Savings",
    "MACHINERY": "Credit",
}
ALL_TYPES = tuple(TYPES.values())


def _translate(column: str, values: dict[str, str]) -> str:
    branches = " ".join(f"WHEN '{key}' THEN '{value}'" for key, value in values.items())
    return f"CASE {column} {branches} END"


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet").selectExpr(
        "CAST(o_orderkey AS STRING) AS transaction_id",
        "o_custkey AS customer_id",
        "o_orderdate + make_dt_interval(0, int(o_orderkey % 24), int(o_orderkey % 60), 0)"
        " AS transaction_date",
        f"{_translate('o_orderpriority', TYPES)} AS transaction_type",
        "CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 0.01BD AS DECIMAL(18,4)) AS amount",
        f"{_translate('o_orderstatus', STATUSES)} AS status",
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(CUSTOMER).parquet(f"{sf_dir}/customer.parquet").selectExpr(
        "c_custkey AS customer_id",
        "split_part(c_name, '#', 1) AS first_name",
        "split_part(c_name, '#', 2) AS last_name",
        "lower(replace(c_name, '#', '.')) || '@example.com' AS email",
        "lpad(CAST(c_custkey AS STRING), 10, '0') AS phone_number",
        f"{_translate('c_mktsegment', ACCOUNTS)} AS account_type",
        "date_add(DATE '1996-08-02', int((c_custkey * 37) % 1825)) AS join_date",
    )


def processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cleanse(transactions(spark, sf_dir))


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return facts.fact_transactions(processed(spark, sf_dir))


def dim_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_customers(customers(spark, sf_dir), AS_OF)
