"""Properties of physical plans that decide how queries scale."""

import re

import pytest

import __spark_entry__ as contract
from checks import fixtures as fx
from ledgerstar.operators import quality
from ledgerstar.plans import charts, reports

SF_DIR = "/root/testdata/sf0.001"


def plan_of(frame, run=False):
    if run:
        frame.collect()
    plan = frame._jdf.queryExecution().executedPlan().toString()
    return plan.split("== Initial Plan ==")[0]


@pytest.fixture()
def no_broadcast(spark):
    """As with dimensions beyond the broadcast limit."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_cleansing_does_not_shuffle(spark):
    assert "Exchange" not in plan_of(fx.processed(spark, SF_DIR))


def test_fact_is_never_shuffled(spark, no_broadcast):
    plan = plan_of(fx.fact(spark, SF_DIR))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


@pytest.mark.parametrize(
    "name", ["q2_revenue_by_account", "q3_top10_customers", "q6_tenure_segments",
             "chart3_top_customers", "chart4_account_revenue", "dq_fk_integrity"]
)
def test_facts_are_aggregated_before_joins(spark, no_broadcast, name):
    """Below the join on the fact side, whatever is shuffled has been aggregated."""
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    fact_side = plan[plan.index("SortMergeJoin [customer_id"):]
    if name != "dq_fk_integrity":  # the dimension is the left side, with a shuffle of its own
        fact_side = fact_side[re.search(r"\n *\+- (\*\(\d+\) )?Sort \[customer_id", fact_side).start():]
    lines = [line for line in fact_side.splitlines() if re.search(r"HashAggregate|Exchange hash|FileScan", line)]
    scan = next(i for i, line in enumerate(lines) if "FileScan" in line)
    shuffles = [i for i in range(scan) if "Exchange hash" in lines[i]]
    assert shuffles and re.search("partial_(count|sum)", lines[scan - 1])
    assert all("HashAggregate" in lines[i + 1] for i in shuffles)


@pytest.mark.parametrize("name", ["q2_revenue_by_account", "q3_top10_customers", "q6_tenure_segments"])
def test_grouping_again_after_the_join_adds_no_shuffle(spark, no_broadcast, name):
    plan = plan_of(contract.queries()[name](spark, SF_DIR))
    assert plan.count("hashpartitioning(customer_id") == 2  # one per side of the join


def test_top_k_is_not_a_global_sort(spark):
    plan = plan_of(contract.queries()["q3_top10_customers"](spark, SF_DIR))
    assert "TakeOrderedAndProject(limit=10" in plan and "rangepartitioning" not in plan


def test_checks_share_one_pass(spark):
    raw = fx.transactions(spark, SF_DIR)
    report = quality.quality_report(
        quality.profile(raw), quality.distribution(raw), quality.duplicates(raw, "transaction_id")
    )
    assert plan_of(report).count("FileScan") == 3


def test_all_checks_read_transactions_four_times(spark):
    passes = quality.passes(fx.transactions(spark, SF_DIR), fx.customers(spark, SF_DIR))
    scans = [line for frame in passes.values() for line in plan_of(frame).splitlines() if "FileScan" in line]
    assert sum("orders.parquet" in line for line in scans) == 4


def test_warehouse_query_shuffles_no_fact_row(spark, no_broadcast):
    """What is shuffled above a scan of the fact has been aggregated."""
    plan = plan_of(contract.queries()["src_warehouse"](spark, SF_DIR))
    lines = [x for x in plan.splitlines() if re.search(r"HashAggregate|Exchange hash|FileScan", x)]
    fact = next(i for i, x in enumerate(lines) if "FileScan" in x and "type_key" in x and "customer_id" in x)
    assert "partial_count" in lines[fact - 1] and "Exchange hash" in lines[fact - 2]


def test_profile_reads_only_what_a_check_needs(spark):
    raw = fx.transactions(spark, SF_DIR)
    schema = re.search(r"FileScan parquet \[(.*?)\]", plan_of(quality.amount_check(quality.profile(raw)))).group(1)
    assert [name.split("#")[0] for name in schema.split(",")] == ["o_totalprice"]


def test_shares_reuse_the_rollup(spark):
    plan = plan_of(charts.type_distribution(fx.fact(spark, SF_DIR)), run=True)
    assert "ReusedExchange" in plan


def test_reports_read_few_columns(spark):
    plan = plan_of(reports.anomaly_summary(fx.fact(spark, SF_DIR)))
    schema = re.search(r"FileScan parquet \[(.*?)\]", plan).group(1)
    assert {name.split("#")[0] for name in schema.split(",")} == {
        "o_orderstatus", "o_totalprice", "o_orderpriority",
    }


def test_no_cross_join_and_no_python_rows(spark):
    slow = {name for name in contract.queries() if name.startswith(("batch_", "sink_", "src_")) or "bucketed" in name}
    for name, query in contract.queries().items():
        if name in slow:
            continue
        plan = plan_of(query(spark, SF_DIR))
        for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "ExistingRDD"):
            assert operator not in plan, (name, operator)
