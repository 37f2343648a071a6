import datetime as dt

from pyspark.sql import functions as F

from ledgerstar.schemas import raw_schemas

RAW = raw_schemas("long", "timestamp")
NOON = dt.datetime(2024, 5, 1, 12, 0)  # a Wednesday


def transactions(spark, *rows, timestamp="timestamp"):
    """Raw transactions from dicts; fields left out get an unremarkable value."""
    plain = {
        "customer_id": 1,
        "transaction_date": NOON,
        "transaction_type": "Deposit",
        "amount": "10.00",
        "status": "Completed",
    }
    filled = [{"transaction_id": f"t{i}", **plain, **row} for i, row in enumerate(rows)]
    names = RAW["transactions"].names
    types = {**{name: "string" for name in names}, "customer_id": "long"}
    types["transaction_date"] = timestamp
    ddl = ", ".join(f"{name} {types[name]}" for name in names)
    frame = spark.createDataFrame([tuple(row[name] for name in names) for row in filled], ddl)
    return frame.withColumn("amount", F.col("amount").cast("decimal(18,4)"))


def customers(spark, *rows):
    plain = {
        "first_name": "Ada",
        "last_name": "Byron",
        "phone_number": "0123",
        "account_type": "Checking",
        "join_date": dt.date(2020, 1, 1),
    }
    filled = [
        {**plain, "email": f"c{row['customer_id']}@example.com", **row} for row in rows
    ]
    schema = RAW["customers"]
    return spark.createDataFrame(
        [tuple(row[name] for name in schema.names) for row in filled], schema
    )


def rows(frame):
    return [row.asDict() for row in frame.collect()]


def checks(frame):
    return {row["check"]: (row["status"], row["bad_count"]) for row in frame.collect()}
