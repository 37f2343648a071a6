import datetime as dt

from pyspark.sql import functions as F

from helpers import checks, customers, rows, transactions
from ledgerstar.operators import quality


def report(raw):
    return quality.quality_report(
        quality.profile(raw), quality.distribution(raw), quality.duplicates(raw, "transaction_id")
    )


def test_clean_input_passes(spark):
    raw = transactions(spark, {}, {"transaction_type": "Transfer", "status": "Failed"})
    found = checks(report(raw))
    assert set(found.values()) == {("PASS", 0)}
    assert list(found) == [
        "record_counts", "null_critical_columns", "amount_positive", "unique_transaction_ids",
        "valid_transaction_type", "valid_status", "overall",
    ]


def test_empty_input_passes(spark):
    raw = transactions(spark, {}).filter("false")
    assert set(checks(report(raw)).values()) == {("PASS", 0)}


def test_missing_critical_values(spark):
    raw = transactions(
        spark,
        {"transaction_id": ""}, {"transaction_id": None}, {"customer_id": None}, {"amount": None},
        {"transaction_date": None}, {},
    )
    assert rows(quality.null_check(quality.profile(raw))) == [
        {"null_transaction_id": 2, "null_customer_id": 1, "null_amount": 1,
         "null_transaction_date": 1, "status": "FAIL"}
    ]
    found = {r["check"]: r for r in report(raw).collect()}
    assert found["null_critical_columns"]["bad_count"] == 5
    assert found["null_critical_columns"]["details"] == {
        "transaction_id": "2", "customer_id": "1", "amount": "1", "transaction_date": "1",
    }
    assert (found["overall"]["status"], found["overall"]["bad_count"]) == ("FAIL", 1)


def test_amounts_must_be_positive(spark):
    raw = transactions(spark, *[{"amount": a} for a in ("0.00", "-1.00", "0.01", None)])
    assert rows(quality.amount_check(quality.profile(raw))) == [{"invalid_count": 2, "status": "FAIL"}]


def test_duplicates_count_null_as_one_value(spark):
    raw = transactions(spark, *[{"transaction_id": i} for i in ("a", "b", "b", None, None)])
    by_hand = raw.count() - raw.select("transaction_id").distinct().count()
    assert rows(quality.duplicate_check(quality.duplicates(raw, "transaction_id"))) == [
        {"duplicate_count": by_hand, "status": "FAIL"}
    ]
    assert by_hand == 2


def test_domains_reject_null_and_unknown(spark):
    raw = transactions(
        spark, {}, {}, {"transaction_type": "Fee"}, {"transaction_type": None},
        {"status": "Unknown"}, {"status": None},
    )
    counted = quality.distribution(raw)
    types = {r["transaction_type"]: (r["row_count"], r["is_valid"]) for r in rows(quality.domain_check(counted, "transaction_type"))}
    assert types == {"Deposit": (4, True), "Fee": (1, False), None: (1, False)}
    found = checks(report(raw))
    assert found["valid_transaction_type"] == ("FAIL", 2)
    assert found["valid_status"] == ("FAIL", 2)
    values = {(r["column"], r["value"]): (r["row_count"], r["is_valid"]) for r in rows(quality.domain_values(counted))}
    assert values[("status", None)] == (1, False)
    assert values[("status", "Completed")] == (4, True)
    assert len(values) == 6


def test_removed_rows_are_told_apart(spark):
    raw = transactions(spark, {}, {"status": "Failed"}, {"status": "Failed"}, {"status": None})
    details = report(raw).filter("check = 'record_counts'").first()["details"]
    assert details == {
        "total_raw_records": "4", "processed_record_count": "1", "removed": "2",
        "removed_null_status": "1",
    }


def test_amount_stats(spark):
    raw = transactions(spark, *[{"amount": a} for a in ("1.004", "2", "4", None)])
    found = rows(quality.amount_stats(quality.profile(raw)))[0]
    assert (found["amount_count"], found["amount_min"], found["amount_max"]) == (3, 1.0, 4.0)
    assert found["amount_mean"] == 2.333333
    assert found["amount_stddev"] == 1.527525


def test_constraints(spark):
    tx = transactions(
        spark, {"transaction_id": "a"}, {"transaction_id": "a"}, {"transaction_id": None},
        {"transaction_id": "x" * 37}, {"amount": "99999999.99"}, {"amount": "99999999.995"},
        {"status": "s" * 21},
    )
    people = customers(
        spark, {"customer_id": 1}, {"customer_id": 1, "email": "other"}, {"customer_id": 2, "email": "other"},
        {"customer_id": 3, "email": None}, {"customer_id": 4, "email": None, "first_name": "n" * 51},
    )
    assert checks(quality.constraint_report(tx, people)) == {
        "transactions_primary_key": ("FAIL", 2),
        "customers_primary_key": ("FAIL", 1),
        "customers_unique_email": ("FAIL", 1),
        "transactions_text_lengths": ("FAIL", 2),
        "transactions_amount_range": ("FAIL", 1),
        "customers_text_lengths": ("FAIL", 1),
        "overall": ("FAIL", 6),
    }
    good = checks(quality.constraint_report(transactions(spark, {}), customers(spark, {"customer_id": 1})))
    assert set(good.values()) == {("PASS", 0)}


def test_references(spark):
    tx = transactions(spark, *[{"customer_id": c} for c in (1, 1, 2, 9, 9, 8, None)])
    people = customers(spark, {"customer_id": 1}, {"customer_id": 2})
    assert sorted((r["customer_id"], r["row_count"]) for r in rows(quality.orphans(tx, people))) == [(8, 1), (9, 2)]
    found = quality.reference_report(tx, people).first()
    assert (found["status"], found["bad_count"], found["details"]) == ("FAIL", 3, {"missing_keys": "2"})
    kept = tx.filter("customer_id < 3 OR customer_id IS NULL")
    assert quality.reference_report(kept, people).first()["status"] == "PASS"


def test_ntz_timestamps(spark):
    raw = transactions(spark, {}, {"transaction_date": None}, timestamp="timestamp_ntz")
    assert checks(report(raw))["null_critical_columns"] == ("FAIL", 1)
    assert raw.schema["transaction_date"].dataType.typeName() == "timestamp_ntz"
    assert raw.filter(F.col("transaction_date") == dt.datetime(2024, 5, 1, 12)).count() == 1
