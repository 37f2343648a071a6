"""Reports against plain SQL that joins first, on frames with awkward rows."""

import datetime as dt
import random

import pytest

from helpers import customers, rows, transactions
from ledgerstar.operators import dimensions, facts
from ledgerstar.operators.cleanse import cleanse
from ledgerstar.operators.rollups import ACTIVITY_KEYS, CUSTOMER_KEYS, rollup
from ledgerstar.plans import charts, reports
from ledgerstar.sources.files import register_views

AS_OF = dt.date(2024, 12, 31)
TENURES = [0, 364, 365, 729, 730, 1094, 1095, 4000]


@pytest.fixture(scope="module")
def star(spark):
    """Hot customer, orphans, null keys and amounts, and one customer listed three times."""
    pick = random.Random(7)
    tx = [
        {
            "customer_id": pick.choice([1, 1, 1, 1, *range(2, 9), 77, None]),
            "transaction_date": dt.datetime(2024, pick.randint(1, 12), pick.randint(1, 28), pick.randint(0, 23)),
            "transaction_type": pick.choice(["Deposit", "Withdrawal", "Transfer", "Payment", "Fee", None]),
            "amount": pick.choice([None, f"{pick.randint(1, 500000) / 100:.2f}"]) if pick.random() < 0.2
            else f"{pick.randint(1, 500000) / 100:.2f}",
            "status": pick.choice(["Completed", "Completed", "Pending", "Failed", None]),
        }
        for _ in range(600)
    ]
    people = [
        {
            "customer_id": i + 1,
            "account_type": ["Checking", "Savings", "Credit", None][i % 4],
            "join_date": AS_OF - dt.timedelta(days=days),
        }
        for i, days in enumerate(TENURES)
    ]
    repeated = [{**people[1], "account_type": "Credit", "join_date": None}, dict(people[1])]
    unused = [{"customer_id": 50}]
    processed = cleanse(transactions(spark, *tx))
    fact = facts.fact_transactions(processed).cache()
    tables = {
        "fact_transactions": fact,
        "dim_customers": dimensions.dim_customers(customers(spark, *people, *repeated, *unused), AS_OF).cache(),
        "dim_date": dimensions.dim_date(processed).cache(),
        "dim_transaction_type": dimensions.dim_transaction_type(spark),
    }
    register_views(tables)
    return tables


@pytest.fixture(scope="module", params=["fact", "rollups", "joined"])
def inputs(request, star):
    """Activity and spending as the fact itself, as wide rollups, and with customers joined."""
    fact, people = star["fact_transactions"], star["dim_customers"]
    if request.param == "fact":
        return fact, [fact, people]
    activity = rollup(fact, *ACTIVITY_KEYS).cache()
    if request.param == "rollups":
        return activity, [rollup(fact, *CUSTOMER_KEYS).cache(), people]
    return activity, [reports.customer_spending(fact, people).cache()]


REVENUE = "CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)"
MEAN = "CAST(ROUND(SUM(CAST(amount AS DECIMAL(18,2))) / COUNT(amount), 2) AS DOUBLE)"
JOINED = "FROM fact_transactions f JOIN dim_customers c ON f.customer_id = c.customer_id"
TENURE = """CASE WHEN tenure_days < 365 THEN '< 1 Year' WHEN tenure_days < 730 THEN '1-2 Years'
            WHEN tenure_days < 1095 THEN '2-3 Years' ELSE '3+ Years' END"""


def same(found, expected, ordered_by=()):
    found, expected = rows(found), rows(expected)
    assert len(expected) > 0
    for column in ordered_by:
        assert [r[column] for r in found] == [r[column] for r in expected]
    key = lambda row: sorted((k, str(v)) for k, v in row.items())
    assert sorted(found, key=key) == sorted(expected, key=key)


def test_monthly_revenue(spark, inputs):
    same(
        reports.monthly_revenue(inputs[0]),
        spark.sql(f"""SELECT tx_year, tx_month, COUNT(*) total_transactions, {REVENUE} total_revenue,
            {MEAN} avg_transaction_amount FROM fact_transactions GROUP BY ALL ORDER BY 1, 2"""),
        ["tx_year", "tx_month"],
    )


def test_revenue_by_account(spark, inputs):
    same(
        reports.revenue_by_account(*inputs[1]),
        spark.sql(f"""SELECT account_type, COUNT(*) transaction_count, {REVENUE} total_revenue,
            {MEAN} avg_amount, COUNT(DISTINCT f.customer_id) unique_customers
            {JOINED} GROUP BY account_type ORDER BY total_revenue DESC"""),
        ["account_type"],
    )


def test_top_customers(spark, star, inputs):
    same(
        reports.top_customers(*inputs[1], k=5),
        spark.sql(f"""SELECT c.customer_id, CONCAT(first_name, ' ', last_name) customer_name, account_type,
            COUNT(*) transaction_count, {REVENUE} total_spend {JOINED}
            GROUP BY c.customer_id, first_name, last_name, account_type
            ORDER BY total_spend DESC, c.customer_id LIMIT 5"""),
        ["customer_id"],
    )


def test_weekend_weekday(spark, star, inputs):
    same(
        reports.weekend_weekday(inputs[0], star["dim_date"]),
        spark.sql(f"""SELECT is_weekend, IF(is_weekend, 'Weekend', 'Weekday') period,
            COUNT(*) transaction_count, {REVENUE} total_revenue, {MEAN} avg_amount
            FROM fact_transactions f JOIN dim_date d ON f.date_key = d.date_key
            GROUP BY is_weekend ORDER BY is_weekend"""),
        ["period"],
    )


def test_anomaly_summary(spark, inputs):
    same(
        reports.anomaly_summary(inputs[0]),
        spark.sql(f"""SELECT transaction_type, is_anomaly, COUNT(*) count, {REVENUE} total_amount,
            {MEAN} avg_amount FROM fact_transactions GROUP BY ALL ORDER BY 1, 2"""),
        ["transaction_type", "is_anomaly"],
    )


def test_tenure_segments(spark, star, inputs):
    same(
        reports.tenure_segments(*inputs[1]),
        spark.sql(f"""SELECT {TENURE} tenure_segment, COUNT(DISTINCT c.customer_id) customer_count,
            COUNT(*) transaction_count, {REVENUE} total_revenue {JOINED}
            GROUP BY ALL ORDER BY total_revenue DESC"""),
        ["tenure_segment"],
    )


def test_monthly_volume(spark, inputs):
    same(
        charts.monthly_volume(inputs[0]),
        spark.sql(f"""SELECT tx_year, tx_month, COUNT(*) tx_count, {REVENUE} total_revenue,
            format_string('%d-%02d', tx_year, tx_month) period
            FROM fact_transactions GROUP BY ALL ORDER BY 1, 2"""),
        ["period"],
    )


def test_type_distribution(spark, inputs):
    same(
        charts.type_distribution(inputs[0]),
        spark.sql(f"""SELECT transaction_type, COUNT(*) count, {REVENUE} total,
            CAST(ROUND(COUNT(*) * 100BD / SUM(COUNT(*)) OVER (), 1) AS DOUBLE) count_share,
            CAST(ROUND(SUM(CAST(amount AS DECIMAL(18,2))) * 100
              / SUM(SUM(CAST(amount AS DECIMAL(18,2)))) OVER (), 1) AS DOUBLE) revenue_share
            FROM fact_transactions GROUP BY transaction_type"""),
    )


def test_top_customers_chart(spark, star, inputs):
    same(
        charts.top_customers(*inputs[1]),
        spark.sql(f"""SELECT c.customer_id, first_name, last_name, account_type, {REVENUE} total_spend,
            COUNT(*) tx_count, CONCAT(first_name, ' ', last_name) name {JOINED}
            GROUP BY c.customer_id, first_name, last_name, account_type
            ORDER BY total_spend DESC, c.customer_id LIMIT 10"""),
        ["customer_id"],
    )


def test_account_pivot(spark, star, inputs):
    def total(test):
        return f"CAST(COALESCE(SUM(IF({test}, CAST(amount AS DECIMAL(18,2)), NULL)), 0) AS DOUBLE)"

    for types in (["Deposit", "Withdrawal", "Transfer", "Payment"], ["Fee"]):
        listed = ", ".join(f"'{t}'" for t in types)
        columns = [f"{total(f"transaction_type = '{t}'")} {t}" for t in types]
        columns.append(f"{total(f'transaction_type IS NULL OR transaction_type NOT IN ({listed})')} other")
        expected = spark.sql(f"SELECT account_type, {', '.join(columns)} {JOINED} GROUP BY account_type")
        observed = charts.account_pivot(*inputs[1], types=types)
        assert observed.columns == ["account_type", *types, "other"]
        same(observed, expected)


def test_account_revenue(spark, star, inputs):
    same(
        charts.account_revenue(*inputs[1]),
        spark.sql(f"SELECT account_type, transaction_type, {REVENUE} revenue {JOINED} GROUP BY ALL"),
    )


def test_anomaly_rate(spark, inputs):
    same(
        charts.anomaly_rate(inputs[0]),
        spark.sql("""SELECT tx_year, tx_month, COUNT(*) total, COUNT_IF(is_anomaly) anomalies,
            format_string('%d-%02d', tx_year, tx_month) period,
            CAST(ROUND(COUNT_IF(is_anomaly) * 100BD / COUNT(*), 2) AS DOUBLE) anomaly_rate
            FROM fact_transactions GROUP BY ALL ORDER BY 1, 2"""),
        ["period"],
    )


def test_kpi_summary(spark, star, inputs):
    same(
        charts.kpi_summary(inputs[0], star["dim_customers"]),
        spark.sql(f"""SELECT COUNT(*) total_transactions, {REVENUE} total_revenue, {MEAN} avg_transaction,
            (SELECT COUNT(*) FROM dim_customers) total_customers, COUNT_IF(is_anomaly) anomalies,
            CAST(ROUND(COUNT_IF(is_anomaly) * 100BD / COUNT(*), 2) AS DOUBLE) anomaly_rate
            FROM fact_transactions"""),
    )


def test_ties_are_ordered_by_customer(spark):
    tx = transactions(spark, *[{"customer_id": c, "amount": a} for c, a in [(3, "5"), (2, "5"), (1, "4"), (4, "9")]])
    people = dimensions.dim_customers(customers(spark, *[{"customer_id": c} for c in range(1, 5)]))
    fact = facts.fact_transactions(cleanse(tx))
    assert [r["customer_id"] for r in rows(reports.top_customers(fact, people, k=2))] == [4, 2]


def test_tenure_bucket_edges(spark):
    labels = spark.createDataFrame([(d,) for d in [*TENURES, None]], "d int").selectExpr(
        f"{reports.tenure_segment('d')} AS label"
    )
    assert [r["label"] for r in labels.collect()] == [
        "< 1 Year", "< 1 Year", "1-2 Years", "1-2 Years", "2-3 Years", "2-3 Years",
        "3+ Years", "3+ Years", "3+ Years",
    ]


def test_heatmap_is_dense(spark):
    sunday = dt.datetime(2024, 5, 5, 7, 15)
    tx = transactions(spark, {"transaction_date": sunday}, {"transaction_date": sunday}, {"transaction_date": None})
    found = rows(charts.heatmap(facts.fact_transactions(cleanse(tx))))
    assert len(found) == 168
    assert [(r["tx_day_of_week"], r["tx_hour"]) for r in found] == [(d, h) for d in range(1, 8) for h in range(24)]
    assert [r for r in found if r["tx_count"] or r["above_mean"]] == [
        {"tx_day_of_week": 1, "day_label": "Sun", "tx_hour": 7, "hour_label": "07:00", "tx_count": 2, "above_mean": True}
    ]


def test_no_transactions(spark):
    fact = facts.fact_transactions(cleanse(transactions(spark, {"status": "Failed"})))
    people = dimensions.dim_customers(customers(spark, {"customer_id": 1}))
    assert rows(charts.kpi_summary(fact, people)) == [
        {"total_transactions": 0, "total_revenue": None, "avg_transaction": None,
         "total_customers": 1, "anomalies": 0, "anomaly_rate": None}
    ]
    assert rows(charts.type_distribution(fact)) == []
    assert rows(reports.monthly_revenue(fact)) == []
    assert {r["tx_count"] for r in rows(charts.heatmap(fact))} == {0}
