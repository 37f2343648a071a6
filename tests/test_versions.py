"""Published runs: whole or not at all, changed partitions alone, contents that agree."""

import datetime as dt
import glob
import json
import os

import duckdb
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helpers import customers, transactions
from ledgerstar.functions.fingerprint import MEASURES, added, fingerprint
from ledgerstar.plans import batch
from ledgerstar.sinks import versions
from ledgerstar.sources import files

AS_OF = dt.date(2024, 12, 31)
COLUMNS = ("k", "a", "x", "t")


def tables(spark, **changes):
    """Six months of transactions; ``changes`` replaces fields of single rows, by their number."""
    made = [
        {
            "customer_id": 1 + i % 4,
            "transaction_date": dt.datetime(2024, 1 + i % 6, 1 + i % 28, i % 24),
            "amount": f"{i * 37 % 5000}.25",
            "transaction_type": ["Deposit", "Payment", "Fee"][i % 3],
            "status": "Failed" if i % 11 == 5 else "Completed",
        }
        for i in range(60)
    ]
    for number, fields in changes.items():
        made[int(number[1:])].update(fields)
    people = [{"customer_id": c, "account_type": ["Checking", "Savings"][c % 2]} for c in (1, 2, 3, 4)]
    return {"customers": customers(spark, *people), "transactions": transactions(spark, *made)}


def same_outputs(one, other):
    assert set(one) == set(other)
    for name, frame in one.items():
        assert sorted(map(str, frame.collect())) == sorted(map(str, other[name].collect())), name


def months_written(spark, base):
    found = glob.glob(f"{versions.resolve(spark, base)}/warehouse/fact_transactions/tx_year=*/tx_month=*")
    return sorted(os.path.basename(x) for x in found)


def star_of(spark, base):
    return {name: sorted(map(str, x.collect())) for name, x in files.load_star(spark, base).items()}


# Fingerprints ----------------------------------------------------------------------------


def rows_of(spark, rows):
    return spark.createDataFrame(rows, "k long, a string, x double, t timestamp_ntz")


NOON = dt.datetime(2024, 5, 1, 12)
SOME = [(1, "a", 1.5, NOON), (2, None, None, None), (2, None, None, None), (3, "12:a", -0.01, NOON)]


def test_fingerprint_of_rows_in_any_order(spark):
    one = fingerprint(rows_of(spark, SOME), COLUMNS).collect()
    assert one == fingerprint(rows_of(spark, SOME[::-1]).repartition(3), COLUMNS).collect()
    assert one[0]["row_count"] == 4
    for other in (
        SOME[:3],  # a row less
        [*SOME[:1], *SOME[3:], *SOME[3:], *SOME[3:]],  # other repeats
        [(1, "a", -0.01, NOON), *SOME[1:3], (3, "12:a", 1.5, NOON)],  # two amounts swapped
        [(1, None, 1.5, NOON), (2, "a", None, None), *SOME[2:]],
    ):
        assert fingerprint(rows_of(spark, other), COLUMNS).collect() != one


def test_neighbouring_texts_are_told_apart(spark):
    frames = [spark.createDataFrame([row], "a string, b string") for row in (("ab", "c"), ("a", "bc"), ("ab", ""), ("ab", None))]
    assert len({tuple(fingerprint(x, ("a", "b")).first()) for x in frames}) == 4


def test_parts_add_up_and_equal_duckdb(spark):
    frame = rows_of(spark, SOME)
    parts = fingerprint(frame, COLUMNS, ("k",)).collect()
    whole = fingerprint(frame, COLUMNS).first()
    assert added([tuple(x[m] for m in MEASURES) for x in parts]) == tuple(whole)
    arrow = frame.toArrow()  # noqa: F841  (read by DuckDB)
    texts = ["CAST(k AS VARCHAR)", "a", "CAST(CAST(x AS DECIMAL(30,4)) AS VARCHAR)", "CAST(t AS VARCHAR)"]
    row = " || ".join(f"coalesce(length({x}) || ':' || {x}, 'n')" for x in texts)
    found = duckdb.sql(
        f"""SELECT count(*), CAST(sum(CAST('0x' || substr(d, 1, 15) AS BIGINT)) AS VARCHAR),
                   bit_xor(CAST('0x' || substr(d, 17, 15) AS BIGINT)) FROM (SELECT md5({row}) AS d FROM arrow)"""
    ).fetchall()[0]
    assert found == tuple(whole)
    assert tuple(fingerprint(frame.limit(0), COLUMNS).first()) == (0, "0", 0) == added([])


# Runs ------------------------------------------------------------------------------------


def test_nothing_is_seen_of_a_run_that_breaks(spark, tmp_path, monkeypatch):
    base = str(tmp_path)
    batch.run(spark, base, AS_OF, tables=tables(spark))
    before, current = star_of(spark, base), versions.resolve(spark, base)
    for broken in ("write_rollups", "verify"):
        with monkeypatch.context() as patch:
            patch.setattr(batch, broken, lambda *args, **more: 1 / 0)
            with pytest.raises(ZeroDivisionError):
                batch.run(spark, base, AS_OF, tables=tables(spark, _7={"amount": "1.00"}))
        assert versions.resolve(spark, base) == current
        assert star_of(spark, base) == before
        batch.verify(spark, base, landed=False)


def test_one_changed_row_rewrites_one_month(spark, tmp_path):
    base = str(tmp_path / "again")
    batch.run(spark, base, AS_OF, tables=tables(spark))
    assert len(months_written(spark, base)) == 6
    changed = tables(spark, _8={"amount": "4999.99"})  # a row of March
    outputs = batch.run(spark, base, AS_OF, tables=changed)
    assert months_written(spark, base) == ["tx_month=3"]
    rollups = glob.glob(f"{versions.resolve(spark, base)}/warehouse/rollups/activity/tx_year=*/tx_month=*")
    assert len(rollups) == 1
    same_outputs(outputs, batch.run(spark, str(tmp_path / "full"), AS_OF, tables=changed))
    assert star_of(spark, base) == star_of(spark, str(tmp_path / "full"))


# Partitioned tables ------------------------------------------------------------------------

KEYS = ("y", "m")
SCHEMA = StructType().add("k", "long").add("x", "double").add("y", "integer").add("m", "integer")
MONTHS = [(k, k / 4, 2024 if k % 5 else None, 1 + k % 4) for k in range(40)]


def step(spark, base, rows, types="long"):
    """One run of a table and of sums that follow it; the partitions written, and both tables."""
    previous, manifest = versions.load(spark, base), versions.start(spark, base)
    manifest.types = {"k": types}
    frame = spark.createDataFrame(rows, SCHEMA)
    build = lambda part: part.withColumn("x", F.col("x") + 1)
    n = versions.refresh(base, manifest, previous, "t", frame, KEYS, SCHEMA.names, build)
    fresh = versions.read(spark, base, manifest, "t", SCHEMA, KEYS, only=manifest.folder) if n else None
    sums = None if fresh is None else fresh.groupBy(*KEYS).agg(F.sum("x").alias("x"))
    versions.follow(base, manifest, "t", "sums", KEYS, sums)
    versions.publish(spark, base, manifest)
    of_sums = StructType().add("y", "integer").add("m", "integer").add("x", "double")
    found = [
        sorted(map(tuple, versions.read(spark, base, manifest, name, schema, KEYS).collect()), key=str)
        for name, schema in (("t", SCHEMA), ("sums", of_sums))
    ]
    return n, *found


def expected(rows):
    sums = {}
    for _, x, y, m in rows:
        sums[y, m] = sums.get((y, m), 0) + x + 1
    return sorted([(k, x + 1, y, m) for k, x, y, m in rows], key=str), sorted([(*k, x) for k, x in sums.items()], key=str)


def test_only_changed_partitions_are_written(spark, tmp_path):
    base, rows = str(tmp_path), list(MONTHS)
    assert step(spark, base, rows) == (8, *expected(rows))
    assert step(spark, base, rows[::-1]) == (0, *expected(rows))
    rows[7] = (7, 99.0, *rows[7][2:])  # a value changes
    assert step(spark, base, rows) == (1, *expected(rows))
    rows[10] = (10, 2.5, 2025, 9)  # a row of a null year moves to a new month
    assert step(spark, base, rows) == (2, *expected(rows))
    rows = [row for row in rows if row[2:] != (2024, 2)]  # a month empties
    assert step(spark, base, rows) == (0, *expected(rows))
    rows.append(rows[0])  # a row comes twice
    assert step(spark, base, rows) == (1, *expected(rows))
    rows.append((7, 1.0, 2024, 2))  # a month comes back, with other rows
    assert step(spark, base, rows) == (1, *expected(rows))
    assert step(spark, base, rows, "decimal(12,0)")[0] == len(expected(rows)[1])  # other types: all anew
    assert step(spark, base, []) == (0, [], [])


def test_many_folders_are_gathered_again(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(versions, "MOST_FOLDERS", 2)
    base, rows = str(tmp_path), list(MONTHS)
    written = []
    for k in (None, 7, 8):
        if k:
            rows[k] = (k, 99.0, *rows[k][2:])
        n, *found = step(spark, base, rows)
        assert tuple(found) == expected(rows)
        written.append(n)
    assert written == [8, 1, 8]


def test_expired_runs(spark, tmp_path):
    base, rows = str(tmp_path), list(MONTHS)
    for k in range(4):
        rows[k] = (k, 50.0 + k, *rows[k][2:])
        step(spark, base, rows)
    (tmp_path / "versions" / "00000002-broken").mkdir()
    (tmp_path / "versions" / "00000005-under-way").mkdir()
    kept = {part.folder for part in versions.load(spark, base).parts["t"]}
    gone = versions.expire(spark, base, keep=1)
    assert gone == ["00000002-broken"] and len(kept) == 4  # each run still holds a part
    assert len(glob.glob(f"{base}/published/*.json")) == 1
    step(spark, base, [row[:1] + (0.0,) + row[2:] for row in rows])
    assert set(versions.expire(spark, base, keep=1)) == kept | {"00000005-under-way"}
    assert step(spark, base, rows)[1:] == expected(rows)


def test_two_runs_cannot_publish_one_number(spark, tmp_path):
    base = str(tmp_path)
    one, other = versions.start(spark, base), versions.start(spark, base)
    versions.publish(spark, base, one)
    with pytest.raises(versions.PublishError):
        versions.publish(spark, base, other)
    assert versions.load(spark, base).folder == one.folder
    assert json.load(open(f"{base}/published/00000001.json"))["folder"] == one.folder


# Contents ----------------------------------------------------------------------------------


def test_swapped_amounts_and_changed_customers_are_noticed(spark, tmp_path):
    """Counts and totals stay the same."""
    base = str(tmp_path / "base")
    batch.run(spark, base, AS_OF, tables=tables(spark))
    batch.verify(spark, base, landed=False)
    folder = versions.resolve(spark, base)
    swap = "CASE transaction_id WHEN 't2' THEN {0}D WHEN 't8' THEN {1}D ELSE amount END"
    for i, (table, keys) in enumerate(
        [("warehouse/fact_transactions", ("tx_year", "tx_month")), ("processed/fact_transactions", ("transaction_type",))]
    ):
        rows = spark.read.parquet(f"{folder}/{table}")
        two = rows.filter("transaction_id IN ('t2', 't8')").orderBy("transaction_id").collect()
        swapped = rows.withColumn("amount", F.expr(swap.format(two[1]["amount"], two[0]["amount"])))
        noticed(spark, base, f"{folder}/{table}", swapped, keys, str(tmp_path / f"swap{i}"))
    people = spark.read.parquet(f"{folder}/warehouse/dim_customers")
    other = people.withColumn("email", F.lit("x@example.com"))
    noticed(spark, base, f"{folder}/warehouse/dim_customers", other, (), str(tmp_path / "people"))
    batch.verify(spark, base, landed=False)


def noticed(spark, base, path, changed, keys, scratch):
    """Puts other rows into a table, looks, and puts the former ones back."""
    spark.read.parquet(path).write.partitionBy(*keys).parquet(f"{scratch}/former")
    changed.write.partitionBy(*keys).parquet(f"{scratch}/changed")
    spark.read.parquet(f"{scratch}/changed").write.mode("overwrite").partitionBy(*keys).parquet(path)
    with pytest.raises(batch.OutputError, match="contents"):
        batch.verify(spark, base, landed=False)
    spark.read.parquet(f"{scratch}/former").write.mode("overwrite").partitionBy(*keys).parquet(path)
