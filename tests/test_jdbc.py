"""The database reader without a database: what it asks Spark for."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerstar.sources import jdbc
from ledgerstar.sources.jdbc import counts_in_frame, counts_in_source, even_slices, extract_tables, hash_slices


class Reader:
    def __init__(self):
        self.calls = []

    def jdbc(self, url, table, predicates, properties):
        self.calls.append((url, table, predicates, properties))
        return table


class Session:
    def __init__(self):
        self.read = Reader()


def test_every_table_is_read_in_its_slices():
    session = Session()
    slices = {"transactions": hash_slices("CRC32(transaction_id)", 3)}
    found = extract_tables(session, "jdbc:x:y", slices, {"user": "u"})
    assert found == {"customers": "customers", "transactions": "transactions"}
    (_, _, whole, options), (url, _, sliced, _) = session.read.calls
    assert url == "jdbc:x:y"
    assert whole == ["1 = 1"]
    assert sliced == [
        "(MOD(CRC32(transaction_id), 3) = 0 OR (CRC32(transaction_id)) IS NULL)",
        "MOD(CRC32(transaction_id), 3) = 1",
        "MOD(CRC32(transaction_id), 3) = 2",
    ]
    assert options == {"fetchsize": "10000", "user": "u"}


# Even slices -------------------------------------------------------------------------------

SKEWED = {
    "uniform": "id",
    "far values": "CASE WHEN id % 50 = 0 THEN id * 1000000 ELSE id END",
    "powers": "CAST(pow(1.003, id) AS BIGINT)",
    "one end": "9000000 - CAST(sqrt(id) * 90 AS BIGINT)",
}


def depths(frame, slices):
    """Rows per slice; each row lies in one."""
    rows = frame.agg(
        *[F.count_if(F.expr(x)).alias(f"s{i}") for i, x in enumerate(slices)],
        F.sum(sum((F.coalesce(F.expr(x).cast("int"), F.lit(0)) for x in slices), F.lit(0))).alias("all"),
        F.max(sum((F.coalesce(F.expr(x).cast("int"), F.lit(0)) for x in slices), F.lit(0))).alias("most"),
        F.count("*").alias("n"),
    ).first()
    assert rows["all"] == rows["n"] and rows["most"] == 1
    return list(rows)[: len(slices)]


@pytest.mark.parametrize("kind", SKEWED)
def test_slices_are_even_under_skew(spark, kind):
    frame = spark.range(6000).selectExpr(f"{SKEWED[kind]} AS k", "id").repartition(1)
    frame = frame.withColumn("k", F.expr("CASE WHEN id % 500 = 1 THEN NULL ELSE k END"))
    low, high = frame.agg(F.min("k"), F.max("k")).first()
    asked = []

    def counted(conditions):
        asked.append(len(conditions))
        return counts_in_frame(frame)(conditions)

    slices = even_slices(counted, "k", low, high, 12)
    found = depths(frame, slices)
    if kind != "powers":  # its small keys are frequent
        assert max(found) <= 2 * 6000 / len(slices)
        assert 8 <= len(slices) <= 18
    assert len(asked) <= 12 and max(asked) <= jdbc.AT_ONCE


def test_frequent_keys_are_dealt_by_another_column(spark):
    frame = spark.range(6000).selectExpr("CASE WHEN id % 3 = 0 THEN 777 WHEN id % 3 = 1 THEN NULL ELSE id END AS k", "id")
    alone = even_slices(counts_in_frame(frame), "k", 2, 5999, 10)
    assert sorted(depths(frame, alone))[-2:] == [2000, 2000]
    dealt = even_slices(counts_in_frame(frame), "k", 2, 5999, 10, tie="id")
    found = depths(frame, dealt)
    assert max(found) <= 2 * 6000 / len(dealt)


def test_keys_that_are_not_numbers(spark):
    first = dt.date(2024, 1, 1)
    days = spark.range(4000).selectExpr("date_add(DATE '2024-01-01', CAST(sqrt(id) * 20 AS INT)) AS d")
    slices = even_slices(counts_in_frame(days), "d", 0, 1265, 8, lambda n: f"'{first + dt.timedelta(n)}'")
    assert max(depths(days, slices)) <= 2 * 4000 / len(slices)
    texts = spark.range(4000).selectExpr("CASE WHEN id % 2 = 0 THEN 'abc' || md5(STRING(id)) ELSE md5(STRING(id)) END AS k")
    slices = even_slices(counts_in_frame(texts), "k", 0, 16**6 - 1, 8, lambda n: f"'{n:06x}'")
    assert max(depths(texts, slices)) <= 2 * 4000 / len(slices)


def test_awkward_keys(spark):
    none = spark.range(0).selectExpr("id AS k")
    assert len(even_slices(counts_in_frame(none), "k", 0, 9, 4)) >= 1
    outside = spark.range(-50, 50).selectExpr("id AS k")
    depths(outside, even_slices(counts_in_frame(outside), "k", 0, 9, 4))
    one = spark.range(9).selectExpr("5L AS k")
    depths(one, even_slices(counts_in_frame(one), "k", 5, 5, 4))


def test_counting_asks_the_source_once_for_many_ranges():
    class Rows:
        def first(self):
            return (3, None)

    class Source:
        def jdbc(self, url, table, properties):
            self.asked = url, table, properties
            return Rows()

    session = Session()
    session.read = Source()
    assert counts_in_source(session, "jdbc:x:y", "t", {"user": "u"})(["k < 1", "k >= 1"]) == [3, 0]
    query = "(SELECT SUM(CASE WHEN k < 1 THEN 1 ELSE 0 END) AS c0, SUM(CASE WHEN k >= 1 THEN 1 ELSE 0 END) AS c1 FROM t) AS counted"
    assert session.read.asked == ("jdbc:x:y", query, {"user": "u"})
