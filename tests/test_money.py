from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerstar.functions import money
from ledgerstar.operators.rollups import MEAN_AMOUNT, REVENUE, TOTAL_CENTS, rollup

CENTS = st.integers(-9_999_999_999, 9_999_999_999)


def fact(spark, cents):
    return spark.createDataFrame(
        [(c / 100 if c is not None else None,) for c in cents], "amount double"
    ).withColumn("is_anomaly", F.lit(False))


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(CENTS, min_size=1, max_size=40))
def test_sum_and_mean_are_exact(spark, cents):
    found = rollup(fact(spark, cents)).selectExpr(
        f"{TOTAL_CENTS} AS total", f"{REVENUE} AS revenue", f"{MEAN_AMOUNT} AS mean"
    ).first()
    total = sum(cents)
    mean = Decimal(total) / Decimal(len(cents))
    assert int(found["total"]) == total
    assert found["revenue"] == float(Decimal(total) / 100)
    exact = mean.quantize(Decimal(1), ROUND_HALF_UP) / 100
    assert Decimal(str(found["mean"])) == exact or found["mean"] == float(exact)


@pytest.mark.parametrize(
    "numerator, denominator, digits, expected",
    [(1, 2, 0, 1.0), (-1, 2, 0, -1.0), (1, 3, 2, 0.33), (2, 3, 1, 0.7), (5, 0, 2, None),
     (1, 8, 2, 0.13), (0, 5, 1, 0.0)],
)
def test_half_up_ratio(spark, numerator, denominator, digits, expected):
    text = money.half_up_ratio("n", "d", digits)
    frame = spark.createDataFrame([(numerator, denominator)], "n bigint, d bigint")
    assert frame.selectExpr(text).first()[0] == expected


def test_huge_totals_do_not_overflow(spark):
    """Partial sums as after some 1e12 rows of the largest declared amount."""
    frame = spark.createDataFrame(
        [(10**12, 10**12, 9999 * 10**12, 999_999 * 10**12, 0)] * 2,
        "tx_count bigint, amount_count bigint, amount_blocks bigint, amount_rest bigint, "
        "anomaly_count bigint",
    )
    found = rollup(frame).selectExpr(f"{TOTAL_CENTS} AS t", f"{MEAN_AMOUNT} AS m").first()
    assert int(found["t"]) == 2 * 10**12 * 9_999_999_999
    assert found["m"] == 99_999_999.99


def test_nulls_count_in_no_mean(spark):
    found = rollup(fact(spark, [100, None, 300])).selectExpr(
        f"{REVENUE} AS revenue", f"{MEAN_AMOUNT} AS mean", "tx_count"
    ).first()
    assert tuple(found) == (4.0, 2.0, 3)
    empty = rollup(fact(spark, [None])).selectExpr(f"{REVENUE} AS r", f"{MEAN_AMOUNT} AS m").first()
    assert tuple(empty) == (None, None)


def test_rollup_of_rollup_adds_up(spark):
    frame = fact(spark, range(1, 200)).withColumn("a", F.expr("int(amount * 100) % 7")).withColumn(
        "b", F.expr("int(amount * 100) % 3")
    )
    direct = rollup(frame, "a")
    twice = rollup(rollup(frame, "a", "b"), "a")
    assert sorted(direct.collect()) == sorted(twice.collect())
    assert Fraction(int(rollup(twice).selectExpr(f"{TOTAL_CENTS} AS t").first()["t"])) == sum(
        range(1, 200)
    )
