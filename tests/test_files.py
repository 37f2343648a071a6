import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from helpers import RAW, customers, rows, transactions
from ledgerstar.operators import dimensions, facts
from ledgerstar.operators.cleanse import cleanse
from ledgerstar.schemas import FACT_PARTITIONS, PROCESSED_PARTITIONS, raw_schemas, table_schemas
from ledgerstar.sinks import files as sinks
from ledgerstar.sources import files as sources
from ledgerstar.sources.jdbc import hash_slices, number_slices, range_slices, text_slices

TABLES = table_schemas("long", "timestamp")


def as_set(frame):
    return sorted(map(str, frame.collect()))


def test_csv_round_trip(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    people = customers(
        spark,
        {"customer_id": 1, "first_name": 'Ann "A." , Jr', "last_name": "  spaced  "},
        {"customer_id": 2, "first_name": "back\\slash", "phone_number": "007"},
        {"customer_id": 3, "first_name": None, "join_date": None},
    )
    sinks.write_csv(people, path)
    assert as_set(sources.read_csv(spark, path, RAW["customers"])) == as_set(people)
    sinks.write_csv(people.limit(1).withColumn("first_name", F.lit("")), path)  # replaces
    assert sources.read_csv(spark, path, RAW["customers"]).first()["first_name"] is None
    assert sources.read_csv(spark, path, RAW["customers"]).count() == 1


def test_csv_with_line_breaks(spark, tmp_path):
    path = str(tmp_path / "t.csv")
    people = customers(spark, {"customer_id": 1, "first_name": "two\nlines"})
    sinks.write_csv(people, path)
    assert as_set(sources.read_csv(spark, path, RAW["customers"], multi_line=True)) == as_set(people)


def test_csv_written_elsewhere(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text(
        "transaction_id,customer_id,transaction_date,transaction_type,amount,status\n"
        'a,1,2024-05-03 23:59:59,Deposit,4500.004,"Comp""leted"\n'
        "b,x,2024-05-03 00:00:00,Payment,12.5,Failed\n"
        "c,3,not a time,Payment,ten,Failed\n"
        ",,,,,\n"
    )
    plain = sources.read_csv(spark, str(path), RAW["transactions"])
    assert plain.columns == RAW["transactions"].names
    found = {r["transaction_id"]: r for r in plain.collect()}
    assert str(found["a"]["amount"]) == "4500.0040"
    assert found["a"]["status"] == 'Comp"leted'
    assert found["a"]["transaction_date"] == dt.datetime(2024, 5, 3, 23, 59, 59)
    assert found["b"]["customer_id"] is None and str(found["b"]["amount"]) == "12.5000"
    assert found["c"]["transaction_date"] is None and found["c"]["amount"] is None
    assert all(value is None for value in found[None])
    kept = sources.read_csv(spark, str(path), RAW["transactions"], keep_corrupt=True)
    staged = str(tmp_path / "staged")
    sinks.write_parquet(kept, staged)
    corrupt = sources.corrupt_rows(spark.read.parquet(staged))
    assert {r["transaction_id"]: r["_corrupt_record"] for r in corrupt.collect()} == {
        "b": "b,x,2024-05-03 00:00:00,Payment,12.5,Failed",
        "c": "c,3,not a time,Payment,ten,Failed",
    }
    assert raw_schemas()["transactions"].names == RAW["transactions"].names


def test_csv_whole_numbers(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text('i,l,s\n1.0,9223372036854775807,"a, b"\n2147483648,7.00,b\n1.5,-3,c\n,,\nx,1,d\n')
    schema = StructType.fromDDL("i INT, l BIGINT, s STRING")
    found = sources.read_csv(spark, str(path), schema, keep_corrupt=True)
    assert found.schema.simpleString() == "struct<i:int,l:bigint,s:string,_corrupt_record:string>"
    assert [tuple(r) for r in found.collect()] == [
        (1, 2**63 - 1, "a, b", None),
        (None, 7, "b", "2147483648.000000000000000000,7.000000000000000000,b"),
        (None, -3, "c", "1.500000000000000000,-3.000000000000000000,c"),
        (None, None, None, None),
        (None, 1, "d", "x,1,d"),
    ]
    assert sources.read_csv(spark, str(path), schema).select("i").collect() == found.select("i").collect()


@pytest.mark.parametrize("keep_corrupt", [False, True])
def test_csv_columns_in_another_order_are_refused(spark, tmp_path, keep_corrupt):
    path = tmp_path / "t.csv"
    path.write_text("customer_id,transaction_id,transaction_date,transaction_type,amount,status\n"
                    "1,a,2024-05-03 00:00:00,Deposit,1.00,Completed\n")
    frame = sources.read_csv(spark, str(path), RAW["transactions"], keep_corrupt=keep_corrupt)
    with pytest.raises(Exception, match="(?i)header"):
        frame.collect()


def test_null_date_round_trip(spark, tmp_path):
    path = str(tmp_path / "fact")
    fact = facts.fact_transactions(cleanse(transactions(spark, {"transaction_date": None}, {})))
    sinks.write_parquet(fact, path, FACT_PARTITIONS)
    assert as_set(sources.read_parquet(spark, path, TABLES["fact_transactions"])) == as_set(fact)


def test_processed_round_trip(spark, tmp_path):
    path = str(tmp_path / "processed")
    types = ["Deposit", "Fee", "12", None]
    frame = cleanse(transactions(spark, *[{"transaction_type": t} for t in types]))
    sinks.write_parquet(frame, path, PROCESSED_PARTITIONS)
    back = sources.read_parquet(spark, path, TABLES["processed"])
    assert back.columns == frame.columns
    assert as_set(back) == as_set(frame)  # "12" is still text
    assert {os.path.basename(p) for p in glob.glob(path + "/transaction_type=*")} == {
        "transaction_type=Deposit", "transaction_type=Fee", "transaction_type=12",
        "transaction_type=__HIVE_DEFAULT_PARTITION__",
    }


def test_fact_round_trip_and_pruning(spark, tmp_path):
    path = str(tmp_path / "fact")
    moments = [dt.datetime(2024, m, 3, 5) for m in range(1, 13)]
    fact = facts.fact_transactions(cleanse(transactions(spark, *[{"transaction_date": m} for m in moments])))
    sinks.write_parquet(fact, path, FACT_PARTITIONS)
    back = sources.read_parquet(spark, path, TABLES["fact_transactions"])
    assert back.columns == fact.columns and back.dtypes == fact.dtypes
    assert as_set(back) == as_set(fact)
    pruned = back.filter("tx_year = 2024 AND tx_month = 5")
    assert pruned.count() == 1
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(tx_year" in plan and "(tx_month" in plan


def test_hot_partition_value_is_written_by_many_tasks(spark, tmp_path):
    """Rebalancing splits a value by size, and bounds the number of files."""
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(advisory)
    frame = spark.range(0, 400_000, 1, 8).selectExpr(
        "sha2(CAST(id AS STRING), 256) AS text",
        "CASE WHEN id % 3 = 0 THEN 'hot' ELSE CAST(id % 30 AS STRING) END AS kind",
    )
    spark.conf.set(advisory, "1m")
    try:
        sinks.write_parquet(frame, str(tmp_path / "t"), ("kind",))
    finally:
        spark.conf.set(advisory, before)
    folders = glob.glob(f"{tmp_path}/t/kind=*")
    files = {os.path.basename(f): len(glob.glob(f"{f}/*.parquet")) for f in folders}
    assert files["kind=hot"] > 3
    assert sum(files.values()) < 8 * len(files)  # a file per task and value otherwise
    assert spark.read.parquet(str(tmp_path / "t")).count() == 400_000


def test_json_keeps_null_fields(spark, tmp_path):
    path = str(tmp_path / "j")
    sinks.write_json(spark.sql("SELECT 1 AS a, CAST(NULL AS STRING) AS b"), path)
    lines = [line for p in glob.glob(path + "/*.json") for line in open(p)]
    assert [json.loads(line) for line in lines] == [{"a": 1, "b": None}]


def test_load_star_and_sql(spark, tmp_path):
    base = str(tmp_path)
    processed = cleanse(transactions(spark, {"customer_id": 1}, {"customer_id": 2, "transaction_type": "Fee"}))
    fact = facts.fact_transactions(processed)
    sinks.write_parquet(fact, f"{base}/fact_transactions", FACT_PARTITIONS)
    sinks.write_parquet(dimensions.dim_customers(customers(spark, {"customer_id": 1})), f"{base}/dim_customers")
    sinks.write_parquet(dimensions.dim_date(fact), f"{base}/dim_date")
    sinks.write_parquet(dimensions.dim_transaction_type(spark), f"{base}/dim_transaction_type")
    star = sources.load_star(spark, base, TABLES)
    assert set(star) == {"fact_transactions", "dim_customers", "dim_date", "dim_transaction_type"}
    sources.register_views(star)
    found = spark.sql(
        "SELECT t.type_name, d.day_name FROM fact_transactions f JOIN dim_date d USING (date_key) "
        "JOIN dim_transaction_type t USING (type_key) JOIN dim_customers c USING (customer_id)"
    )
    assert rows(found) == [{"type_name": "Deposit", "day_name": "Wednesday"}]


@pytest.mark.parametrize("count", [1, 2, 7])
def test_hash_slices_cover_every_row_once(spark, count):
    frame = spark.range(1000).selectExpr("IF(id % 10 = 0, NULL, CAST(id AS STRING)) AS k", "id")
    slices = hash_slices("CRC32(CAST(k AS BINARY))", count)
    assert len(slices) == count
    matches = frame.select("id", *[F.expr(f"COALESCE(INT({s}), 0)").alias(f"s{i}") for i, s in enumerate(slices)])
    totals = matches.selectExpr(" + ".join(f"s{i}" for i in range(count)) + " AS n").distinct().collect()
    assert [r["n"] for r in totals] == [1]


@pytest.mark.parametrize("count", [1, 3, 400])
def test_range_slices_cover_every_row_once(spark, count):
    first, last = dt.date(2024, 1, 1), dt.date(2024, 12, 31)
    frame = spark.range(-500, 900).selectExpr(
        "IF(id = 0, NULL, date_add(DATE '2024-01-01', INT(id))) AS d"
    )
    slices = range_slices("d", first, last, count)
    assert len(slices) <= count
    total = " + ".join(f"COALESCE(INT({s}), 0)" for s in slices)
    assert [r["n"] for r in frame.selectExpr(f"{total} AS n").distinct().collect()] == [1]


@pytest.mark.parametrize("count", [1, 3, 64])
def test_number_slices_cover_every_row_once(spark, count):
    frame = spark.range(-500, 900).selectExpr("NULLIF(id, 0) AS k")
    slices = number_slices("k", 1, 800, count)
    assert len(slices) == count
    total = " + ".join(f"COALESCE(INT({s}), 0)" for s in slices)
    assert [r["n"] for r in frame.selectExpr(f"{total} AS n").distinct().collect()] == [1]


@pytest.mark.parametrize("bounds", [[], ["m"], ["40", "80", "c0"], ["0'1", "5"]])
def test_text_slices_cover_every_row_once(spark, bounds):
    frame = spark.range(1000).selectExpr("CASE id % 9 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE md5(STRING(id)) END AS k")
    slices = text_slices("k", [b.replace("'", "") for b in bounds])
    assert len(slices) == len(bounds) + 1 or not bounds
    total = " + ".join(f"COALESCE(INT({s}), 0)" for s in slices)
    assert [r["n"] for r in frame.selectExpr(f"{total} AS n").distinct().collect()] == [1]


def test_text_slices_quote_their_bounds():
    assert text_slices("k", ["o'x"]) == ["(k < 'o''x' OR k IS NULL)", "k >= 'o''x'"]
