import datetime as dt

from helpers import customers, rows, transactions
from ledgerstar.operators import dimensions, facts
from ledgerstar.operators.cleanse import cleanse
from ledgerstar.operators.rollups import rollup
from ledgerstar.schemas import table_schemas


def test_unknown_type_has_no_key(spark):
    types = ["Deposit", "Withdrawal", "Transfer", "Payment", "Fee", None]
    processed = cleanse(transactions(spark, *[{"transaction_type": t} for t in types]))
    found = {r["transaction_type"]: r["type_key"] for r in rows(facts.fact_transactions(processed))}
    assert found == {
        "Deposit": 1, "Withdrawal": 2, "Transfer": 3, "Payment": 4, "Fee": None, None: None,
    }


def test_fact_with_own_type_dimension(spark):
    processed = cleanse(transactions(spark, {"transaction_type": "Fee"}, {}))
    types = spark.createDataFrame([(9, "Fee", "Charges")], dimensions.dim_transaction_type(spark).schema)
    found = {r["transaction_type"]: r["type_key"] for r in rows(facts.fact_transactions(processed, types))}
    assert found == {"Fee": 9, "Deposit": None}


def test_date_key(spark):
    moments = [dt.datetime(2024, 12, 31, 23, 59, 59), dt.datetime(2025, 1, 1), None]
    processed = cleanse(transactions(spark, *[{"transaction_date": m} for m in moments]))
    found = [r["date_key"] for r in sorted(rows(facts.fact_transactions(processed)), key=lambda r: r["transaction_id"])]
    assert found == [20241231, 20250101, None]


def test_dim_date_has_observed_dates_only(spark):
    moments = [dt.datetime(2024, 5, 3, 23, 59), dt.datetime(2024, 5, 3, 1), dt.datetime(2024, 5, 6), None]
    processed = cleanse(transactions(spark, *[{"transaction_date": m} for m in moments]))
    found = rows(dimensions.dim_date(processed))
    assert [r["date_key"] for r in found] == [None, 20240503, 20240506]
    assert found[0]["is_weekend"] is False
    assert found[1] == {
        "date_key": 20240503, "full_date": dt.date(2024, 5, 3), "year": 2024, "quarter": 2,
        "month": 5, "month_name": "May", "day": 3, "day_of_week": 6, "day_name": "Friday",
        "is_weekend": False,
    }


def test_dim_date_is_the_same_from_every_frame(spark):
    moments = [dt.datetime(2024, 5, d) for d in range(1, 29)] + [dt.datetime(2023, 12, 31), None]
    processed = cleanse(transactions(spark, *[{"transaction_date": m} for m in moments]))
    fact = facts.fact_transactions(processed)
    expected = rows(dimensions.dim_date(processed))
    assert rows(dimensions.dim_date(fact)) == expected
    assert rows(dimensions.dim_date(rollup(fact, "date_key", "tx_hour"))) == expected


def test_weekend_days(spark):
    moments = [dt.datetime(2024, 5, d) for d in range(3, 8)]  # Friday to Tuesday
    processed = cleanse(transactions(spark, *[{"transaction_date": m} for m in moments]))
    assert [r["is_weekend"] for r in rows(dimensions.dim_date(processed))] == [
        False, True, True, False, False,
    ]


def test_tenure(spark):
    as_of = dt.date(2024, 1, 1)
    frame = customers(spark, {"customer_id": 1, "join_date": dt.date(2023, 1, 1)}, {"customer_id": 2, "join_date": None})
    found = {r["customer_id"]: r["tenure_days"] for r in rows(dimensions.dim_customers(frame, as_of))}
    assert found == {1: 365, 2: None}
    today = dimensions.dim_customers(customers(spark, {"customer_id": 1, "join_date": dt.date(2000, 1, 1)}))
    assert rows(today)[0]["tenure_days"] >= (dt.date.today() - dt.date(2000, 1, 1)).days - 1


def test_schemas_match_the_declared_ones(spark):
    declared = table_schemas("long", "timestamp")
    processed = cleanse(transactions(spark, {}))
    built = {
        "processed": processed,
        "fact_transactions": facts.fact_transactions(processed),
        "dim_customers": dimensions.dim_customers(customers(spark, {"customer_id": 1})),
        "dim_date": dimensions.dim_date(processed),
        "dim_transaction_type": dimensions.dim_transaction_type(spark),
    }
    for name, frame in built.items():
        assert dict(frame.dtypes) == {f.name: f.dataType.simpleString() for f in declared[name]}, name
        assert frame.columns == declared[name].names
