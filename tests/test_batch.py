import datetime as dt
import json
import glob
import shutil

import pytest

from pyspark.sql import functions as F

from helpers import customers, transactions
from ledgerstar.operators import quality
from ledgerstar.plans import batch
from ledgerstar.sinks import versions
from ledgerstar.sources import files

AS_OF = dt.date(2024, 12, 31)


@pytest.fixture(scope="module")
def landing(spark, tmp_path_factory):
    base = str(tmp_path_factory.mktemp("landing"))
    tx = [
        {"customer_id": 1 + i % 3, "transaction_date": dt.datetime(2024, 1 + i % 4, 1 + i, i),
         "amount": f"{i * 400 + 1}.50", "transaction_type": ["Deposit", "Fee"][i % 2],
         "status": ["Completed", "Failed", "Pending"][i % 3]}
        for i in range(12)
    ]
    tables = {
        "customers": customers(spark, *[{"customer_id": c} for c in (1, 2, 3)]),
        "transactions": transactions(spark, *tx, {"status": None}),
    }
    batch.land(tables, base)
    with open(f"{base}/raw/raw_transactions.csv/more.csv", "w") as extra:
        extra.write("transaction_id,customer_id,transaction_date,transaction_type,amount,status\n")
        extra.write("bad,zero,2024-02-03 04:05:06,Deposit,7,Completed\n")
    return base


@pytest.fixture(scope="module")
def finished(spark, landing):
    """The folder of the published run, and its outputs."""
    outputs = batch.run(spark, landing, AS_OF)
    return versions.resolve(spark, landing), outputs


def documents(folder):
    return [json.loads(line) for path in glob.glob(f"{folder}/*.json") for line in open(path)]


def test_outputs(spark, finished):
    base, outputs = finished
    assert len(outputs) == 15
    for name, frame in outputs.items():
        written = documents(f"{base}/{name}")
        assert len(written) == frame.count() > 0, name
        assert set(written[0]) == set(frame.columns), name
    kpi = documents(f"{base}/dashboard/kpi_summary")[0]
    assert kpi["total_transactions"] == 9 and kpi["total_customers"] == 3
    assert {d["account_type"] for d in documents(f"{base}/analytics/revenue_by_account")} == {"Checking"}


def test_malformed_row_is_kept_and_reported(spark, finished):
    base, _ = finished
    assert [d["transaction_id"] for d in documents(f"{base}/rejected/transactions")] == ["bad"]
    found = {d["check"]: d["status"] for d in documents(f"{base}/quality/report")}
    assert found["null_critical_columns"] == "FAIL"
    assert found["valid_transaction_type"] == "FAIL"
    assert found["unique_transaction_ids"] == "PASS"
    assert found["overall"] == "FAIL"


def test_counts_reconcile(spark, landing, finished):
    counts = {r["stage"]: r["row_count"] for r in batch.verify(spark, landing).collect()}
    assert counts["raw_transactions"] == 14
    assert counts["kept"] == counts["processed"] == counts["fact_transactions"] == 9
    assert (counts["removed"], counts["removed_null_status"]) == (4, 1)
    assert counts["raw_customers"] == counts["dim_customers"] == 3


def test_run_from_tables_of_any_source(spark, finished, tmp_path):
    base, outputs = finished
    tables = {n: spark.read.parquet(f"{base}/staged/{n}") for n in ("customers", "transactions")}
    direct = batch.run(spark, str(tmp_path), AS_OF, tables=tables)
    assert not (tmp_path / "raw").exists()
    for name in ("analytics/monthly_revenue", "dashboard/kpi_summary", "analytics/tenure_segments"):
        assert direct[name].collect() == outputs[name].collect()


def test_run_that_keeps_no_transaction(spark, tmp_path):
    tables = {
        "customers": customers(spark, {"customer_id": 1}),
        "transactions": transactions(spark, {"status": "Failed"}),
    }
    outputs = batch.run(spark, str(tmp_path), AS_OF, tables=tables)
    assert outputs["dashboard/kpi_summary"].first()["total_transactions"] == 0
    assert outputs["analytics/revenue_by_account"].count() == 0
    assert outputs["dashboard/heatmap"].count() == 168
    assert outputs["dashboard/undated"].first()["tx_count"] == 0


def test_second_run_replaces_the_first(spark, landing, finished):
    batch.run(spark, landing, AS_OF)
    assert versions.resolve(spark, landing) != finished[0]
    assert files.load_star(spark, landing)["fact_transactions"].count() == 9


def test_chosen_checks_stop_the_run(spark, finished):
    base, _ = finished
    with pytest.raises(batch.QualityError, match="null_critical_columns"):
        batch.check_quality(spark, base, fail_on=("null_critical_columns", "unique_transaction_ids"))
    batch.check_quality(spark, base, fail_on=("unique_transaction_ids",))


def test_lost_output_is_noticed(spark, landing, finished, tmp_path):
    copy = str(tmp_path / "copy")
    shutil.copytree(landing, copy, ignore=lambda folder, names: ["dim_date"] if folder.endswith("warehouse") else [])
    with pytest.raises(batch.OutputError, match="dim_date"):
        batch.verify(spark, copy)


def test_lost_rows_are_noticed(spark, tmp_path):
    copy = str(tmp_path)
    tx = [{"customer_id": 1, "amount": f"{i}.50"} for i in range(9)]
    tables = {"customers": customers(spark, {"customer_id": 1}), "transactions": transactions(spark, *tx)}
    batch.run(spark, copy, AS_OF, tables=tables)
    batch.verify(spark, copy, landed=False)
    fact = f"{versions.resolve(spark, copy)}/warehouse/fact_transactions"
    spark.read.parquet(fact).limit(8).write.parquet(f"{copy}/fewer")
    spark.read.parquet(f"{copy}/fewer").write.mode("overwrite").partitionBy("tx_year", "tx_month").parquet(fact)
    with pytest.raises(batch.OutputError, match="counts do not agree"):
        batch.verify(spark, copy, landed=False)


def test_unknown_checks_are_refused(spark, tmp_path):
    tables = {
        "customers": customers(spark, {"customer_id": 1}),
        "transactions": transactions(spark, {}),
    }
    with pytest.raises(ValueError, match="no such checks: nonsense"):
        batch.run(spark, str(tmp_path), fail_on=("nonsense",), tables=tables)
    assert not list(tmp_path.iterdir())  # refused before any work


def test_repeated_and_unknown_customers(spark, tmp_path):
    """A join would count the first twice and lose the second; the checks say so."""
    tables = {
        "customers": customers(spark, {"customer_id": 1}, {"customer_id": 1, "email": None}),
        "transactions": transactions(spark, {}, {"customer_id": 9}),
    }
    with pytest.raises(batch.QualityError, match="customer_id_reference, customers_primary_key"):
        names = ("customers_primary_key", "customer_id_reference", "transactions_primary_key")
        batch.run(spark, str(tmp_path), AS_OF, fail_on=names, tables=tables)
    batch.run(spark, str(tmp_path), AS_OF, tables=tables)
    report = {d["check"]: d for d in documents(f"{versions.resolve(spark, str(tmp_path))}/quality/report")}
    assert list(report) == list(quality.CHECKS)
    assert {name for name, d in report.items() if d["status"] == "FAIL"} == {
        "customers_primary_key", "customer_id_reference", "overall",
    }
    assert report["customers_primary_key"]["details"] == {"repeats": "1", "nulls": "0"}


@pytest.mark.parametrize("line_break", ["\n", "\r\n", "\r"])
def test_line_breaks_in_landed_text(spark, tmp_path, line_break):
    tables = {
        "customers": customers(
            spark, {"customer_id": 1, "first_name": f"A{line_break}B"}, {"customer_id": 2, "last_name": line_break}
        ),
        "transactions": transactions(spark, {"customer_id": 1}, {"customer_id": 2}),
    }
    direct = batch.run(spark, str(tmp_path / "direct"), AS_OF, tables=tables)
    batch.land({name: frame.coalesce(1) for name, frame in tables.items()}, str(tmp_path / "text"), rows_per_file=1)
    assert len(glob.glob(f"{tmp_path}/text/raw/raw_customers.csv/*.csv")) == 2
    text = batch.run(spark, str(tmp_path / "text"), AS_OF)
    assert set(text) == set(direct)
    for name, frame in text.items():
        assert frame.collect() == direct[name].collect(), name
    assert not documents(f"{versions.resolve(spark, str(tmp_path / 'text'))}/rejected/customers")


def test_whole_numbers_with_a_zero_fraction(spark, tmp_path):
    tables = {
        "customers": customers(spark, {"customer_id": 10000001}),
        "transactions": transactions(spark, {"customer_id": 10000001}, {"customer_id": None}),
    }
    plain = batch.run(spark, str(tmp_path / "plain"), AS_OF, tables=tables)
    as_double = tables["transactions"].withColumn("customer_id", F.col("customer_id").cast("decimal(12,1)"))
    batch.land(tables | {"transactions": as_double}, str(tmp_path / "text"))
    landed = "".join(open(p).read() for p in glob.glob(f"{tmp_path}/text/raw/raw_transactions.csv/*.csv"))
    assert "10000001.0" in landed
    text = batch.run(spark, str(tmp_path / "text"), AS_OF)
    for name, frame in text.items():
        assert frame.collect() == plain[name].collect(), name
    assert not documents(f"{versions.resolve(spark, str(tmp_path / 'text'))}/rejected/transactions")


def test_any_number_of_types(spark, tmp_path):
    """Types beyond the declared ones, and null, end in the pivot's last column."""
    names = [f"type {i}" for i in range(40)] + ["Deposit", None]
    tables = {
        "customers": customers(spark, {"customer_id": 1}, {"customer_id": 2, "account_type": None}),
        "transactions": transactions(
            spark, *[{"transaction_type": name, "customer_id": c} for name in names for c in (1, 2)]
        ),
    }
    outputs = batch.run(spark, str(tmp_path), AS_OF, tables=tables)
    revenue = {r["account_type"]: r["total_revenue"] for r in outputs["analytics/revenue_by_account"].collect()}
    pivot = {r["account_type"]: sum(r[1:]) for r in outputs["dashboard/account_pivot"].collect()}
    assert pivot == revenue == {"Checking": 420.0, None: 420.0}


def test_undated_rows_are_counted_beside_the_heatmap(spark, tmp_path):
    tables = {
        "customers": customers(spark, {"customer_id": 1}),
        "transactions": transactions(spark, {}, {"transaction_date": None}, {"transaction_date": None}),
    }
    outputs = batch.run(spark, str(tmp_path), AS_OF, tables=tables)
    shown = sum(r["tx_count"] for r in outputs["dashboard/heatmap"].collect())
    assert (shown, outputs["dashboard/undated"].first()["tx_count"]) == (1, 2)


def test_decimal_ids(spark, tmp_path):
    tables = {
        "customers": customers(spark, {"customer_id": 1}),
        "transactions": transactions(spark, {}),
    }
    wide = {
        name: frame.withColumn("customer_id", frame["customer_id"].cast("decimal(12,0)"))
        for name, frame in tables.items()
    }
    plain = batch.run(spark, str(tmp_path / "plain"), tables=tables)
    found = batch.run(spark, str(tmp_path / "wide"), tables=wide)
    name = "analytics/revenue_by_account"
    assert found[name].collect() == plain[name].collect()
