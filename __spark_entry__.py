
from __future__ import annotations

import logging
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks import fixtures as fx
from checks import oracles
from ledgerstar.functions.fingerprint import fingerprint
from ledgerstar.operators import audience, dimensions, quality
from ledgerstar.operators.rollups import CUSTOMER_KEYS, REVENUE, rollup
from ledgerstar.plans import batch, charts, reports
from ledgerstar.schemas import (
    FACT_PARTITIONS,
    PROCESSED_PARTITIONS,
    raw_schemas,
    table_schemas,
)
from ledgerstar.sinks import files as sinks, layouts
from ledgerstar.sources import files as sources

try:
    import corpus_pipeline
    from ledgerstar.llm import queries as corpus_queries
except ImportError as error:  # the subpackage, or something that it alone needs, can be left out
    logging.getLogger(__name__).warning("no corpus queries: %s", error)
    corpus_pipeline = corpus_queries = None

MULTI_LINE_BYTES = 256 << 10  # a range, so that the tables at hand are split

Query = Callable[[SparkSession, str], DataFrame]

RAW = raw_schemas(fx.CUSTOMER_ID, fx.TIMESTAMP)
TABLES = table_schemas(fx.CUSTOMER_ID, fx.TIMESTAMP)

# Check rows with their figures as one text, in the order of names
FIGURES = "transform(array_sort(map_entries(details)), x -> x.key || '=' || x.value)"
CHECK_COLUMNS = ("check", "status", "bad_count", f"array_join({FIGURES}, ',') AS details")


def entry(spark: SparkSession) -> DataFrame:
    """Whole batch on the smallest tables; returns revenue by account type."""
    return _batch(spark, "/root/testdata/sf0.001")[1]["analytics/revenue_by_account"]


def _batch(spark: SparkSession, sf_dir: str) -> tuple[str, dict[str, DataFrame]]:
    base = fx.scratch(spark)
    landed = {
        "customers": fx.customers(spark, sf_dir),
        "transactions": fx.transactions(spark, sf_dir),
    }
    batch.land(landed, base)
    return base, batch.run(
        spark, base, fx.AS_OF, customer_id=fx.CUSTOMER_ID, timestamp=fx.TIMESTAMP
    )


# Star schema ---------------------------------------------------------------------


def _dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_date(fx.processed(spark, sf_dir))


def _dim_transaction_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension, with the number of transactions that use each row."""
    used = rollup(fx.fact(spark, sf_dir), "type_key").select(
        "type_key", F.col("tx_count").alias("used_by")
    )
    return dimensions.dim_transaction_type(spark).join(used, "type_key", "left").na.fill(0)


# Reports and charts --------------------------------------------------------------


def _on_fact(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(fx.fact(spark, sf_dir))


def _on_customers(plan: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(fx.fact(spark, sf_dir), fx.dim_customers(spark, sf_dir))


def _weekend_weekday(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fx.fact(spark, sf_dir)
    return reports.weekend_weekday(fact, dimensions.dim_date(fact))


# Quality -------------------------------------------------------------------------


def _on_raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, sf_dir: plan(fx.transactions(spark, sf_dir))


def _amount_stats(raw: DataFrame) -> DataFrame:
    return quality.amount_stats(quality.profile(raw))


def _duplicate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return quality.duplicate_check(quality.duplicates(lines, "l_orderkey", "l_linenumber"))


def _report(raw: DataFrame) -> DataFrame:
    return quality.quality_report(
        quality.profile(raw),
        quality.distribution(raw),
        quality.duplicates(raw, "transaction_id"),
    )


def _constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = quality.constraint_report(
        fx.transactions(spark, sf_dir), fx.customers(spark, sf_dir)
    )
    return checks.selectExpr(*CHECK_COLUMNS)


def _references(spark: SparkSession, sf_dir: str) -> DataFrame:
    checks = quality.reference_report(
        fx.transactions(spark, sf_dir), fx.customers(spark, sf_dir)
    )
    return checks.selectExpr(*CHECK_COLUMNS)


def _orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders that no line refers to: a key with natural orphans."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    lines = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    return quality.orphans(
        orders, lines.select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey"
    )


def _reconciled(spark: SparkSession, sf_dir: str) -> DataFrame:
    fact = fx.fact(spark, sf_dir)
    return batch.reconcile(
        quality.profile(fx.transactions(spark, sf_dir)),
        {
            "raw_customers": fx.customers(spark, sf_dir),
            "processed": fx.processed(spark, sf_dir),
            "fact_transactions": fact,
            "dim_customers": fx.dim_customers(spark, sf_dir),
            "dim_date": dimensions.dim_date(fact),
            "dim_transaction_type": dimensions.dim_transaction_type(spark),
        },
    )


def _reconciled_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of the rows from cleansing to the written fact, and of customers."""
    fact, people = fx.fact(spark, sf_dir), fx.dim_customers(spark, sf_dir)
    stages = {
        "processed": (fx.processed(spark, sf_dir), batch.CONTENTS),
        "fact_transactions": (
            _parquet(spark, fact, TABLES["fact_transactions"], FACT_PARTITIONS), batch.CONTENTS
        ),
        "raw_customers": (fx.customers(spark, sf_dir), batch.CUSTOMER_CONTENTS),
        "dim_customers": (_parquet(spark, people, TABLES["dim_customers"]), batch.CUSTOMER_CONTENTS),
    }
    return batch.reconcile_contents(stages)


def _month_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What tells a run which months have changed."""
    return fingerprint(fx.processed(spark, sf_dir), batch.CONTENTS, FACT_PARTITIONS)


def _tenure_today(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with their tenure on the day of the query."""
    return dimensions.dim_customers(fx.customers(spark, sf_dir))


def _batch_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch.verify(spark, _batch(spark, sf_dir)[0])


def _batch_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _batch(spark, sf_dir)[1]["analytics/revenue_by_account"]


# Sources and sinks: write, then read back -----------------------------------------


def _csv(spark: SparkSession, frame: DataFrame, schema, multi_line: bool = False) -> DataFrame:
    path = f"{fx.scratch(spark)}/table.csv"
    sinks.write_csv(frame, path)
    return sources.read_csv(spark, path, schema, multi_line, range_bytes=MULTI_LINE_BYTES)


def _parquet(spark: SparkSession, frame: DataFrame, schema, partition_by=()) -> DataFrame:
    path = f"{fx.scratch(spark)}/table"
    sinks.write_parquet(frame, path, partition_by)
    return sources.read_parquet(spark, path, schema)


def _csv_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = _csv(spark, fx.transactions(spark, sf_dir), RAW["transactions"])
    return back.withColumn("amount", F.col("amount").cast("double"))


def _csv_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _csv(spark, fx.customers(spark, sf_dir), RAW["customers"])


def _csv_multiline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long texts with line breaks, in a file per task that wrote, read by a task per range of bytes."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return _csv(spark, documents, documents.schema, multi_line=True)


def _csv_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _csv(spark, fx.processed(spark, sf_dir), TABLES["processed"])


def _parquet_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parquet(spark, fx.dim_customers(spark, sf_dir), TABLES["dim_customers"])


def _parquet_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = fx.processed(spark, sf_dir)
    return _parquet(spark, frame, TABLES["processed"], PROCESSED_PARTITIONS)


def _parquet_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    frame = fx.fact(spark, sf_dir)
    return _parquet(spark, frame, TABLES["fact_transactions"], FACT_PARTITIONS)


def _partitioned_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Aggregate over the partition columns of the written fact."""
    return rollup(
        _parquet_by_month(spark, sf_dir), "tx_year", "tx_month", "transaction_type"
    ).selectExpr(
        "tx_year", "tx_month", "transaction_type", "tx_count AS row_count", f"{REVENUE} AS revenue"
    )


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact in files that each cover few days of few customers."""
    path = f"{fx.scratch(spark)}/clustered"
    layouts.write_clustered(fx.fact(spark, sf_dir), path, ("transaction_date", "customer_id"), 16)
    return sources.read_parquet(spark, path, TABLES["fact_transactions"])


def _on_buckets(plan: Callable[[DataFrame, DataFrame], DataFrame]) -> Query:
    """Reports from a rollup and a dimension that are filed by customer, joined without a shuffle."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        base = fx.scratch(spark)
        name = base.rsplit("-", 1)[-1]
        spending = rollup(fx.fact(spark, sf_dir), *CUSTOMER_KEYS)
        tables = {"spending": spending, "people": fx.dim_customers(spark, sf_dir)}
        filed = {
            key: layouts.write_bucketed(frame, f"{key}_{name}", f"{base}/{key}", "customer_id", 8)
            for key, frame in tables.items()
        }
        return plan(filed["spending"], filed["people"])

    return query


def _distinct_customers(*keys: str) -> Query:
    """From the written bitmaps per month and type, for fewer keys."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        path = f"{fx.scratch(spark)}/active"
        wide = ("tx_year", "tx_month", "transaction_type")
        sinks.write_parquet(audience.customer_bitmaps(fx.fact(spark, sf_dir), *wide), path)
        return audience.distinct_customers(spark.read.parquet(path), *keys)

    return query


def _json(spark: SparkSession, frame: DataFrame) -> DataFrame:
    path = f"{fx.scratch(spark)}/result"
    sinks.write_json(frame, path)
    return spark.read.schema(frame.schema).json(path)


def _json_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json(spark, reports.monthly_revenue(fx.fact(spark, sf_dir)))


def _json_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _json(spark, _report(fx.transactions(spark, sf_dir))).selectExpr(*CHECK_COLUMNS)


def _warehouse_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SQL text over views of the loaded star schema; the fact is grouped before it is joined."""
    base = f"{fx.scratch(spark)}/warehouse"
    fact = fx.fact(spark, sf_dir)
    sinks.write_parquet(fact, f"{base}/fact_transactions", FACT_PARTITIONS)
    sinks.write_parquet(fx.dim_customers(spark, sf_dir), f"{base}/dim_customers")
    sinks.write_parquet(dimensions.dim_date(fact), f"{base}/dim_date")
    sinks.write_parquet(
        dimensions.dim_transaction_type(spark), f"{base}/dim_transaction_type"
    )
    sources.register_views(sources.load_star(spark, base, TABLES))
    return spark.sql(
        """
        WITH f AS (
          SELECT customer_id, date_key, type_key, COUNT(*) AS n,
                 SUM(CAST(amount AS DECIMAL(18,2))) AS revenue
          FROM fact_transactions GROUP BY customer_id, date_key, type_key)
        SELECT d.year, d.month_name, c.account_type, t.type_name,
               SUM(f.n) AS transaction_count, CAST(SUM(f.revenue) AS DOUBLE) AS total_revenue
        FROM f
        JOIN dim_customers c ON f.customer_id = c.customer_id
        JOIN dim_date d ON f.date_key = d.date_key
        LEFT JOIN dim_transaction_type t ON f.type_key = t.type_key
        GROUP BY d.year, d.month_name, c.account_type, t.type_name
        """
    )


def queries() -> dict[str, Query]:
    return _star_queries() | _corpus_queries()


def _corpus_queries() -> dict[str, Query]:
    if corpus_queries is None:
        return {}
    return corpus_queries.queries() | {"pipeline": corpus_pipeline.run}


def _star_queries() -> dict[str, Query]:
    return {
        "tx_clean": fx.processed,
        "dim_customers": fx.dim_customers,
        "dim_date": _dim_date,
        "dim_transaction_type": _dim_transaction_type,
        "fact_transactions": fx.fact,
        "q1_monthly_revenue": _on_fact(reports.monthly_revenue),
        "q2_revenue_by_account": _on_customers(reports.revenue_by_account),
        "q3_top10_customers": _on_customers(reports.top_customers),
        "q4_weekend_weekday": _weekend_weekday,
        "q5_anomaly_summary": _on_fact(reports.anomaly_summary),
        "q6_tenure_segments": _on_customers(reports.tenure_segments),
        "chart1_monthly_volume": _on_fact(charts.monthly_volume),
        "chart2_type_distribution": _on_fact(charts.type_distribution),
        "chart3_top_customers": _on_customers(charts.top_customers),
        "chart4_account_revenue": _on_customers(charts.account_revenue),
        "chart4_account_pivot": _on_customers(charts.account_pivot),
        "chart5_anomaly_rate": _on_fact(charts.anomaly_rate),
        "chart6_heatmap": _on_fact(charts.heatmap),
        "kpi_summary": _on_customers(charts.kpi_summary),
        "dq_null_critical": _on_raw(lambda raw: quality.null_check(quality.profile(raw))),
        "dq_amount_positive": _on_raw(lambda raw: quality.amount_check(quality.profile(raw))),
        "dq_duplicate_ids": _on_raw(
            lambda raw: quality.duplicate_check(quality.duplicates(raw, "transaction_id"))
        ),
        "dq_duplicate_lines": _duplicate_lines,
        "dq_valid_types": _on_raw(
            lambda raw: quality.domain_check(quality.distribution(raw), "transaction_type")
        ),
        "dq_valid_statuses": _on_raw(
            lambda raw: quality.domain_check(quality.distribution(raw), "status")
        ),
        "dq_amount_stats": _on_raw(_amount_stats),
        "dq_status_distribution": _on_raw(
            lambda raw: quality.value_counts(quality.distribution(raw), "status")
        ),
        "dq_type_distribution": _on_raw(
            lambda raw: quality.value_counts(quality.distribution(raw), "transaction_type")
        ),
        "dq_report": _on_raw(lambda raw: _report(raw).selectExpr(*CHECK_COLUMNS)),
        "dq_constraints": _constraints,
        "dq_fk_integrity": _references,
        "dq_fk_orphans": _orphans,
        "recon_counts": _reconciled,
        "recon_contents": _reconciled_contents,
        "recon_months": _month_prints,
        "dim_customers_today": _tenure_today,
        "batch_run_outputs": _batch_outputs,
        "batch_run_revenue": _batch_revenue,
        "src_csv_transactions": _csv_transactions,
        "src_csv_customers": _csv_customers,
        "src_csv_multiline": _csv_multiline,
        "src_parquet_partitioned": _partitioned_scan,
        "src_warehouse": _warehouse_sql,
        "sink_csv": _csv_processed,
        "sink_parquet": _parquet_customers,
        "sink_parquet_by_type": _parquet_by_type,
        "sink_parquet_by_month": _parquet_by_month,
        "sink_parquet_clustered": _clustered,
        "q2_bucketed": _on_buckets(reports.revenue_by_account),
        "q3_bucketed": _on_buckets(reports.top_customers),
        "customers_by_month_type": _distinct_customers("tx_year", "tx_month", "transaction_type"),
        "customers_by_year": _distinct_customers("tx_year"),
        "customers_by_type": _distinct_customers("transaction_type"),
        "sink_json": _json_report,
        "sink_quality_report": _json_quality,
    }


def oracle_sql() -> dict[str, str]:
    return oracles.oracle_sql() | ({} if corpus_queries is None else corpus_queries.oracle_sql())
