"""Distinct customers that add up: exact bitmaps per rollup row.

A count of distinct customers per month and type says nothing about the quarter or about all types. A bitmap
does: those of any rows can be united, and the bits of the union counted. Customer numbers fall
into buckets of 32,768; a rollup row per key and bucket holds one bit per number (4 KB). So the rollup is bounded
by keys times buckets in use, whatever the number of transactions, and a customer with a third of
all rows is one bit. Any subset of the keys is answered from it without reading the fact again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

NUMBER = "CAST(customer_id AS BIGINT)"


def customer_bitmaps(rows: DataFrame, *keys: str) -> DataFrame:
    """``keys, bucket, members`` of a fact table or of any rollup of it by customer.

    Customers are whole numbers; rows without one count for nobody. Each key and customer is
    reduced to one row before bitmaps are built, as building them sorts rows by key.
    """
    seen = rows.filter("customer_id IS NOT NULL").select(*keys, F.expr(f"{NUMBER} AS number")).distinct()
    return seen.groupBy(*keys, F.expr("bitmap_bucket_number(number) AS bucket")).agg(
        F.expr("bitmap_construct_agg(bitmap_bit_position(number)) AS members")
    )


def united(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """The bitmaps of fewer keys; a customer in several rows is one member."""
    return bitmaps.groupBy(*keys, "bucket").agg(F.expr("bitmap_or_agg(members) AS members"))


def distinct_customers(bitmaps: DataFrame, *keys: str) -> DataFrame:
    """``keys, customers``: how many different customers have rows, for any subset of the keys."""
    return united(bitmaps, *keys).groupBy(*keys).agg(
        F.expr("coalesce(sum(bitmap_count(members)), 0L) AS customers")
    )
