"""Layouts: how little a read opens, joins without a shuffle, distinct counts from bitmaps."""

import glob
import re

import duckdb
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks import oracles
from ledgerstar.operators import audience
from ledgerstar.operators.rollups import CUSTOMER_KEYS, rollup
from ledgerstar.plans import reports
from ledgerstar.sinks import layouts
from ledgerstar.sinks.files import write_parquet

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def fact(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("fact"))
    fx.fact(spark, SF_DIR).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def opened(path, **between):
    """Share of row groups whose statistics do not rule out all of the given ranges."""
    kept = total = 0
    for file in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(file).metadata
        names = meta.schema.names
        for i in range(meta.num_row_groups):
            total += 1
            stats = {name: meta.row_group(i).column(names.index(name)).statistics for name in between}
            kept += all(stats[n].min <= high and stats[n].max >= low for n, (low, high) in between.items())
    return kept / total


def test_a_week_of_a_customer_is_in_few_files(spark, fact, tmp_path):
    hashed, ordered = str(tmp_path / "hashed"), str(tmp_path / "ordered")
    fact.repartition(64, "transaction_id").write.parquet(hashed)
    layouts.write_clustered(fact, ordered, ("date_key", "customer_id"), 64)
    back = spark.read.parquet(ordered)
    assert back.columns == fact.columns
    assert sorted(map(str, back.collect())) == sorted(map(str, fact.collect()))
    week = {"date_key": (19970310, 19970316), "customer_id": (700, 700)}
    assert opened(hashed, **week) > 0.9
    assert opened(ordered, **week) <= 0.05
    assert opened(ordered, date_key=week["date_key"]) <= 0.25
    assert opened(ordered, customer_id=week["customer_id"]) <= 0.25


def test_frequent_places_fill_several_files(spark, tmp_path):
    """A customer with a third of all rows, all on one day; nulls; far values."""
    frame = spark.range(30_000).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 7 WHEN id % 97 = 0 THEN NULL WHEN id = 5 THEN 1000000000000 ELSE id END AS c",
        "CASE WHEN id % 3 = 0 THEN DATE '2024-01-01' ELSE date_add(DATE '2024-01-01', INT(id % 300)) END AS d",
        "id",
    )
    path = str(tmp_path / "t")
    layouts.write_clustered(frame, path, ("c", "d"), 16, cells=32)
    sizes = [pq.ParquetFile(x).metadata.num_rows for x in glob.glob(f"{path}/*.parquet")]
    assert sum(sizes) == 30_000 and max(sizes) <= 2 * 30_000 / 16
    assert spark.read.parquet(path).exceptAll(frame).count() == 0
    layouts.write_clustered(frame.limit(0), str(tmp_path / "none"), ("c", "d"), 4)
    assert spark.read.parquet(str(tmp_path / "none")).count() == 0


def test_curve_interleaves_ranks(spark):
    frame = spark.range(64).selectExpr("id % 8 AS a", "id div 8 AS b")
    got = {(r["a"], r["b"]): r["z"] for r in frame.withColumn("z", layouts.curve(frame, ("a", "b"), 8)).collect()}

    def spread(n):
        return sum((n >> i & 1) << 2 * i for i in range(4))

    ranks = sorted({a for a, _ in got})
    assert got == {(a, b): spread(ranks.index(a)) | spread(ranks.index(b)) << 1 for a, b in got}


def test_bucketed_tables_join_without_a_shuffle(spark, fact, tmp_path):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        people = layouts.write_bucketed(
            fx.dim_customers(spark, SF_DIR), "bucketed_people", str(tmp_path / "people"), "customer_id", 8
        )
        spending = layouts.write_bucketed(
            rollup(fact, *CUSTOMER_KEYS), "bucketed_spending", str(tmp_path / "spending"), "customer_id", 8
        )
        for report in (reports.revenue_by_account, reports.top_customers):
            plan = report(spending, people)._jdf.queryExecution().executedPlan().toString()
            join = plan[plan.index("SortMergeJoin"):]
            assert "Exchange" not in join and join.count("FileScan") == 2
            plain = report(fact, fx.dim_customers(spark, SF_DIR))
            assert report(spending, people).collect() == plain.collect()
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in people.schema)
        again = layouts.attach_bucketed(spark, "again", str(tmp_path / "people"), columns, "customer_id", 8)
        plan = again.groupBy("customer_id").count()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and again.count() == people.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        for name in ("bucketed_people", "bucketed_spending", "again"):
            spark.sql(f"DROP TABLE IF EXISTS {name}")


@pytest.mark.parametrize(
    "keys", [(), ("tx_year",), ("transaction_type",), ("tx_year", "tx_month"), ("tx_year", "tx_month", "transaction_type")]
)
def test_distinct_customers_of_any_keys(spark, fact, tmp_path, keys):
    all_keys = ("tx_year", "tx_month", "transaction_type")
    path = str(tmp_path / "active")
    write_parquet(audience.customer_bitmaps(rollup(fact, "customer_id", *all_keys), *all_keys), path)
    got = {tuple(r) for r in audience.distinct_customers(spark.read.parquet(path), *keys).collect()}
    duck = duckdb.connect()
    for name in ("customer", "orders"):
        duck.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    listed = "".join(f"{k}, " for k in keys)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    sql = f"{oracles._STAR} SELECT {listed}COUNT(DISTINCT customer_id) FROM fact {group}"
    assert got == set(duck.execute(sql).fetchall())


def test_customer_numbers_at_the_edges(spark):
    numbers = [0, 1, 32768, 32769, 10**15, -5, None, 1]
    rows = spark.createDataFrame([("a" if i % 2 else None, n) for i, n in enumerate(numbers)], "t string, customer_id long")
    bitmaps = audience.customer_bitmaps(rows, "t")
    assert {tuple(r) for r in audience.distinct_customers(bitmaps, "t").collect()} == {(None, 3), ("a", 3)}
    assert audience.distinct_customers(bitmaps).first()["customers"] == 6
    assert audience.distinct_customers(audience.customer_bitmaps(rows.limit(0), "t"), "t").collect() == []
    assert re.search("bitmap_or_agg", bitmaps.groupBy().agg(F.expr("bitmap_or_agg(members)")).columns[0])
