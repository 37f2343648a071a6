"""Table schemas, value domains and limits shared by every layer."""

from __future__ import annotations

from pyspark.sql.types import StructType

# Fixed values of the data model -------------------------------------------------
TRANSACTION_TYPES = ("Deposit", "Withdrawal", "Transfer", "Payment")
STATUSES = ("Completed", "Pending", "Failed")
REMOVED_STATUS = "Failed"
ANOMALY_THRESHOLD = 4500
CRITICAL_COLUMNS = ("transaction_id", "customer_id", "amount", "transaction_date")

TYPE_DIMENSION_ROWS = (
    (1, "Deposit", "Funds added to account"),
    (2, "Withdrawal", "Funds removed from account"),
    (3, "Transfer", "Funds moved between accounts"),
    (4, "Payment", "Payment for goods or services"),
)

# (upper bound in days, exclusive; label); the last bucket is open
TENURE_SEGMENTS = ((365, "< 1 Year"), (730, "1-2 Years"), (1095, "2-3 Years"), (None, "3+ Years"))

DAY_LABELS = ("Sun", "Mon", "Tue", "Wed", "Thu", "Fri", "Sat")

# Declared column limits of the two source tables
CUSTOMER_LENGTHS = {
    "first_name": 50,
    "last_name": 50,
    "email": 100,
    "phone_number": 20,
    "account_type": 20,
}
TRANSACTION_LENGTHS = {"transaction_id": 36, "transaction_type": 20, "status": 20}
AMOUNT_LIMIT = 100_000_000  # DECIMAL(10,2): eight digits before the point
# ---------------------------------------------------------------------------------

PROCESSED_PARTITIONS = ("transaction_type",)
FACT_PARTITIONS = ("tx_year", "tx_month")


def _schema(**types: str) -> StructType:
    schema = StructType()
    for name, type_name in types.items():
        schema.add(name, type_name)
    return schema


def raw_schemas(customer_id: str = "integer", timestamp: str = "timestamp") -> dict[str, StructType]:
    """Schemas of the two landed tables.

    ``amount`` keeps four decimals on read although the source column holds two, because the
    anomaly flag is decided before rounding.
    """
    return {
        "customers": _schema(
            customer_id=customer_id,
            first_name="string",
            last_name="string",
            email="string",
            phone_number="string",
            account_type="string",
            join_date="date",
        ),
        "transactions": _schema(
            transaction_id="string",
            customer_id=customer_id,
            transaction_date=timestamp,
            transaction_type="string",
            amount="decimal(18,4)",
            status="string",
        ),
    }


def table_schemas(customer_id: str = "integer", timestamp: str = "timestamp") -> dict[str, StructType]:
    """Schemas of the cleansed table and the star schema, in their logical column order."""
    return {
        "processed": _schema(
            transaction_id="string",
            customer_id=customer_id,
            transaction_date=timestamp,
            transaction_type="string",
            amount="double",
            status="string",
            is_anomaly="boolean",
            tx_year="integer",
            tx_month="integer",
            tx_day_of_week="integer",
            tx_hour="integer",
        ),
        "dim_customers": _schema(
            customer_id=customer_id,
            first_name="string",
            last_name="string",
            email="string",
            phone_number="string",
            account_type="string",
            join_date="date",
            tenure_days="integer",
        ),
        "dim_date": _schema(
            date_key="integer",
            full_date="date",
            year="integer",
            quarter="integer",
            month="integer",
            month_name="string",
            day="integer",
            day_of_week="integer",
            day_name="string",
            is_weekend="boolean",
        ),
        "dim_transaction_type": _schema(
            type_key="integer", type_name="string", type_description="string"
        ),
        "fact_transactions": _schema(
            transaction_id="string",
            customer_id=customer_id,
            date_key="integer",
            type_key="integer",
            transaction_type="string",
            amount="double",
            status="string",
            is_anomaly="boolean",
            transaction_date=timestamp,
            tx_year="integer",
            tx_month="integer",
            tx_day_of_week="integer",
            tx_hour="integer",
        ),
    }


STAR_TABLES = ("fact_transactions", "dim_customers", "dim_date", "dim_transaction_type")
