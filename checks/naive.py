"""Baseline for the benchmark: keys and measures by SQL that joins all rows before it aggregates.

Labels, shares and distinct customers are left out, so the library's queries do a little more.

The texts are put together from a table of keys and measures. Quality is one action per column
and per value set of the library's declarations.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from ledgerstar.operators import dimensions
from ledgerstar.schemas import CRITICAL_COLUMNS, STATUSES, TRANSACTION_TYPES

MEASURES = {"n": "COUNT(*)", "total": "ROUND(SUM(amount), 2)", "mean": "ROUND(AVG(amount), 2)"}
JOINS = {
    "": "fact",
    "people": "fact JOIN people USING (customer_id)",
    "days": "fact JOIN days USING (date_key)",
}

# Query: the joined table, its keys, and the measures it shows
SHAPES = {
    "q1_monthly_revenue": ("", "tx_year, tx_month", "n total mean"),
    "q2_revenue_by_account": ("people", "account_type", "n total mean"),
    "q4_weekend_weekday": ("days", "is_weekend", "n total mean"),
    "q5_anomaly_summary": ("", "transaction_type, is_anomaly", "n total mean"),
    "chart1_monthly_volume": ("", "tx_year, tx_month", "n total"),
    "chart4_account_revenue": ("people", "account_type, transaction_type", "total"),
}


def query(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of ``SHAPES`` over views of the derived tables."""
    fact = fx.fact(spark, sf_dir)
    fact.createOrReplaceTempView("fact")
    fx.dim_customers(spark, sf_dir).createOrReplaceTempView("people")
    dimensions.dim_date(fact).select("date_key", "is_weekend").createOrReplaceTempView("days")
    table, keys, measures = SHAPES[name]
    columns = ", ".join(f"{MEASURES[x]} AS {x}" for x in measures.split())
    return spark.sql(f"SELECT {keys}, {columns} FROM {JOINS[table]} GROUP BY {keys}")


def quality(raw: DataFrame) -> None:
    """An action per critical column and per declared set of values."""
    sets = {"transaction_type": TRANSACTION_TYPES, "status": STATUSES}
    tests = [F.col(name).isNull() for name in CRITICAL_COLUMNS]
    tests += [~F.col(name).isin(*values) for name, values in sets.items()]
    for test in tests:
        raw.filter(test).count()
