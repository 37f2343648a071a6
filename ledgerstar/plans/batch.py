"""The daily batch: raw tables to warehouse, reports and chart data.

Every stage ends in a written table, and the next one reads it back. A lost executor thus
costs the tasks it ran, and a failed run leaves nothing cached. All reports come from rollups. Writes that do
not depend on each other are submitted together, so that the last tasks of one leave no executor idle.

A run has a folder of its own and is published by its last act (:mod:`ledgerstar.sinks.versions`): until
then, and if it breaks, readers of ``base`` see the run before. Fingerprints of the rows per type and per month
tell which partitions of the cleansed table, of the fact and of its rollups have to be written. The same
fingerprints are compared between the stages. The big table is read once for each of: staging, four quality
passes, the fingerprints of the staged and of the cleansed rows, and the two contents checks; cleansing, the fact and
its rollups read it once more each, but only for what has changed.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from ledgerstar.functions.fingerprint import MEASURES, added, fingerprint
from ledgerstar.operators import dimensions, facts, quality
from ledgerstar.operators.cleanse import cleanse
from ledgerstar.operators.rollups import ACTIVITY_KEYS, CUSTOMER_KEYS, rollup
from ledgerstar.plans import charts, reports
from ledgerstar.schemas import (
    FACT_PARTITIONS,
    PROCESSED_PARTITIONS,
    STAR_TABLES,
    raw_schemas,
    table_schemas,
)
from ledgerstar.sinks import versions
from ledgerstar.sinks.files import write_csv, write_json, write_parquet
from ledgerstar.sinks.versions import Manifest
from ledgerstar.sources import files

# Partitioned tables of a run
PROCESSED = "processed/fact_transactions"
FACT = "warehouse/fact_transactions"
ACTIVITY = "warehouse/rollups/activity"
MONTHLY = "warehouse/rollups/customers"

# What a transaction consists of from cleansing on; all other columns follow from these
CONTENTS = (
    "transaction_id", "customer_id", "transaction_date", "transaction_type", "amount", "status", "is_anomaly",
)
CUSTOMER_CONTENTS = tuple(raw_schemas()["customers"].names)


class QualityError(Exception):
    """A check named in ``fail_on`` did not pass."""


class OutputError(Exception):
    """An output is missing, or the row counts or contents of two stages do not agree."""


def land(tables: Mapping[str, DataFrame], base: str, rows_per_file: int = 1_000_000) -> None:
    """Write extracted tables to the landing zone."""
    for name, frame in tables.items():
        write_csv(frame, f"{base}/raw/raw_{name}.csv", rows_per_file)


def run(
    spark: SparkSession,
    base: str,
    as_of: datetime.date | None = None,
    fail_on: tuple[str, ...] = (),
    tables: Mapping[str, DataFrame] | None = None,
    customer_id: str = "integer",
    timestamp: str = "timestamp",
    multi_line: bool = True,
) -> dict[str, DataFrame]:
    """Process the landing zone below ``base`` and publish; returns the reports and chart datasets.

    With ``tables`` (``customers`` and ``transactions`` from any source) these are taken instead
    of landed text, which is then neither needed nor parsed. ``customer_id`` and ``timestamp`` are
    the types that landed text is read with. ``multi_line`` allows quoted line breaks in it; without
    them, ``False`` spares the pass that counts quotes. Failed quality checks are reported and do not
    stop the run, unless named in ``fail_on``. A run that stops is not published.
    """
    refuse_unknown(fail_on)
    previous, manifest = versions.load(spark, base), versions.start(spark, base)
    folder = versions.folder(base, manifest)
    if tables is None:
        stage_landed(spark, base, folder, customer_id, timestamp, multi_line)
    else:
        writes = {f"{folder}/staged/{name}": tables[name] for name in raw_schemas()}
        write_all(*[partial(write_parquet, frame, path) for path, frame in writes.items()])
    check_quality(spark, folder, fail_on)

    transactions = spark.read.parquet(f"{folder}/staged/transactions").drop(files.CORRUPT)
    staged = {field.name: field.dataType.jsonValue() for field in transactions.schema}
    manifest.types = {name: staged[name] for name in ("customer_id", "transaction_date")}
    versions.refresh(
        base, manifest, previous, PROCESSED, cleanse(transactions), PROCESSED_PARTITIONS, CONTENTS
    )
    build_star(spark, base, manifest, previous, as_of)
    outputs = report(spark, base, manifest)
    verify(spark, base, tables is None, manifest)
    versions.publish(spark, base, manifest)
    return outputs


def schemas_of(manifest: Manifest) -> dict[str, StructType]:
    return table_schemas(manifest.types["customer_id"], manifest.types["transaction_date"])


def partitioned(
    spark: SparkSession, base: str, manifest: Manifest, name: str, only: str | None = None
) -> DataFrame:
    """One of a run's partitioned tables, or the part of it that the run ``only`` has written."""
    schemas = schemas_of(manifest)
    if name == PROCESSED:
        return versions.read(spark, base, manifest, name, schemas["processed"], PROCESSED_PARTITIONS, only)
    schema = schemas["fact_transactions"]
    if name != FACT:
        keys = ACTIVITY_KEYS if name == ACTIVITY else (*FACT_PARTITIONS, *CUSTOMER_KEYS)
        schema = rollup(spark.createDataFrame([], schema), *keys).schema
    return versions.read(spark, base, manifest, name, schema, FACT_PARTITIONS, only)


def write_all(*writes: Callable[[], None]) -> None:
    """Run independent writes as concurrent Spark jobs; the first error is raised."""
    with ThreadPoolExecutor(max_workers=8) as pool:
        for done in [pool.submit(write) for write in writes]:
            done.result()


def stage_landed(
    spark: SparkSession,
    base: str,
    folder: str,
    customer_id: str,
    timestamp: str,
    multi_line: bool = True,
) -> None:
    """Parse the landed text once, into columns; rows with malformed cells are also set aside."""

    def stage_table(name: str, schema: StructType) -> None:
        path = f"{base}/raw/raw_{name}.csv"
        landed = files.read_csv(spark, path, schema, multi_line, keep_corrupt=True)
        staged = f"{folder}/staged/{name}"
        write_parquet(landed, staged)
        write_json(files.corrupt_rows(spark.read.parquet(staged)), f"{folder}/rejected/{name}")

    schemas = raw_schemas(customer_id, timestamp)
    write_all(*[partial(stage_table, name, schema) for name, schema in schemas.items()])


def refuse_unknown(checks: tuple[str, ...]) -> None:
    if unknown := set(checks) - set(quality.CHECKS):
        raise ValueError(f"no such checks: {', '.join(sorted(unknown))}")


def check_quality(spark: SparkSession, folder: str, fail_on: tuple[str, ...] = ()) -> None:
    """Run the checks on the staged tables of a run's folder and write their findings."""
    refuse_unknown(fail_on)
    passes = quality.passes(
        spark.read.parquet(f"{folder}/staged/transactions"),
        spark.read.parquet(f"{folder}/staged/customers"),
    )
    target = f"{folder}/quality"
    write_all(
        *[partial(write_parquet, frame, f"{target}/passes/{name}") for name, frame in passes.items()]
    )
    found = {name: spark.read.parquet(f"{target}/passes/{name}") for name in passes}
    checks = quality.full_report(found)
    findings = {
        "report": checks,
        "domain_values": quality.domain_values(found["distribution"]),
        "amount_stats": quality.amount_stats(found["profile"]),
    }
    write_all(
        *[partial(write_json, frame, f"{target}/{name}") for name, frame in findings.items()]
    )
    if fail_on:
        statuses = {row["check"]: row["status"] for row in checks.collect()}  # one row per check
        if names := [name for name in fail_on if statuses[name] != "PASS"]:
            raise QualityError(", ".join(sorted(names)))


def build_star(
    spark: SparkSession,
    base: str,
    manifest: Manifest,
    previous: Manifest | None,
    as_of: datetime.date | None,
) -> None:
    """Write the dimensions, and of the fact and its rollups the months that have changed."""
    folder = versions.folder(base, manifest)
    customers = spark.read.parquet(f"{folder}/staged/customers").drop(files.CORRUPT)
    small = {
        "dim_customers": dimensions.dim_customers(customers, as_of),
        "dim_transaction_type": dimensions.dim_transaction_type(spark),
    }
    write_all(
        *[partial(write_parquet, frame, f"{folder}/warehouse/{name}") for name, frame in small.items()]
    )
    processed = partitioned(spark, base, manifest, PROCESSED)
    versions.refresh(
        base, manifest, previous, FACT, processed, FACT_PARTITIONS, CONTENTS, facts.fact_transactions
    )
    write_rollups(spark, base, manifest)


def write_rollups(spark: SparkSession, base: str, manifest: Manifest) -> None:
    """Roll up the months just written, and gather what reports read over all months."""
    folder = versions.folder(base, manifest)
    keys = {ACTIVITY: ACTIVITY_KEYS, MONTHLY: (*FACT_PARTITIONS, *CUSTOMER_KEYS)}
    fresh = None
    if manifest.folder in manifest.written[FACT]:
        fresh = partitioned(spark, base, manifest, FACT, only=manifest.folder)
    write_all(*[
        partial(
            versions.follow, base, manifest, FACT, name, FACT_PARTITIONS,
            None if fresh is None else rollup(fresh, *key),
        )
        for name, key in keys.items()
    ])
    schema = schemas_of(manifest)["dim_customers"]
    people = files.read_parquet(spark, f"{folder}/warehouse/dim_customers", schema)
    spending = reports.customer_spending(partitioned(spark, base, manifest, MONTHLY), people)
    dates = dimensions.dim_date(partitioned(spark, base, manifest, ACTIVITY))
    write_all(
        partial(write_parquet, spending, f"{folder}/warehouse/rollups/spending"),
        partial(write_parquet, dates, f"{folder}/warehouse/dim_date"),
    )


def report(spark: SparkSession, base: str, manifest: Manifest) -> dict[str, DataFrame]:
    """Write all reports and chart datasets as line JSON; returns them, still lazy."""
    folder = versions.folder(base, manifest)
    star = files.star_of(spark, base, manifest, schemas_of(manifest))
    activity = partitioned(spark, base, manifest, ACTIVITY)
    spending = spark.read.parquet(f"{folder}/warehouse/rollups/spending")
    dates = star["dim_date"]
    outputs = {
        "analytics/monthly_revenue": reports.monthly_revenue(activity),
        "analytics/revenue_by_account": reports.revenue_by_account(spending),
        "analytics/top_customers": reports.top_customers(spending),
        "analytics/weekend_weekday": reports.weekend_weekday(activity, dates),
        "analytics/anomaly_summary": reports.anomaly_summary(activity),
        "analytics/tenure_segments": reports.tenure_segments(spending),
        "dashboard/monthly_volume": charts.monthly_volume(activity),
        "dashboard/type_distribution": charts.type_distribution(activity),
        "dashboard/top_customers": charts.top_customers(spending),
        "dashboard/account_pivot": charts.account_pivot(spending),
        "dashboard/account_revenue": charts.account_revenue(spending),
        "dashboard/anomaly_rate": charts.anomaly_rate(activity),
        "dashboard/heatmap": charts.heatmap(activity),
        "dashboard/undated": charts.undated(activity),
        "dashboard/kpi_summary": charts.kpi_summary(activity, star["dim_customers"]),
    }
    write_all(*[partial(write_json, frame, f"{folder}/{name}") for name, frame in outputs.items()])
    return outputs


def row_counts(stages: Mapping[str, DataFrame]) -> DataFrame:
    """One row per stage with its number of rows."""
    counts = [
        frame.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("stage"), "row_count")
        for name, frame in stages.items()
    ]
    joined, *rest = counts
    for frame in rest:
        joined = joined.unionByName(frame)
    return joined


def reconcile(profiled: DataFrame, stages: Mapping[str, DataFrame]) -> DataFrame:
    """Raw rows split into kept and removed, followed by the rows of each later stage."""
    raw = profiled.select(
        F.inline(
            F.array(*[
                F.struct(F.lit(stage).alias("stage"), F.col(column).alias("row_count"))
                for stage, column in (
                    ("raw_transactions", "row_count"),
                    ("kept", "kept_rows"),
                    ("removed", "removed_rows"),
                    ("removed_null_status", "null_status_rows"),
                )
            ])
        )
    )
    return raw.unionByName(row_counts(stages))


def reconcile_contents(stages: Mapping[str, tuple[DataFrame, tuple[str, ...]]]) -> DataFrame:
    """One row per stage with the fingerprint of the given columns of its rows."""
    prints = [
        fingerprint(frame, columns).select(F.lit(stage).alias("stage"), *MEASURES)
        for stage, (frame, columns) in stages.items()
    ]
    joined, *rest = prints
    for frame in rest:
        joined = joined.unionByName(frame)
    return joined


def verify(
    spark: SparkSession, base: str, landed: bool = True, manifest: Manifest | None = None
) -> DataFrame:
    """Check that all outputs exist and that no row got lost or changed between stages.

    ``landed`` tells whether the run started from landed text; ``manifest`` is that of a run not yet
    published. Counting reads file footers only; contents are read once per stage. Returns the
    counts; raises :class:`OutputError`.
    """
    manifest = versions.load(spark, base) if manifest is None else manifest
    if manifest is None:
        raise OutputError(f"missing: {base}/{versions.PUBLISHED}")
    folder = versions.folder(base, manifest)
    tables = {"processed": PROCESSED, **{name: f"warehouse/{name}" for name in STAR_TABLES}}
    paths = [
        f"{base}/{versions.VERSIONS}/{where}/{table}"
        for table in tables.values()
        for where in (manifest.written[table] if table in manifest.written else [manifest.folder])
    ]
    paths += [f"{folder}/staged/customers", f"{folder}/quality/passes/profile"]
    paths += [f"{base}/raw/raw_{name}.csv" for name in raw_schemas()] if landed else []
    if missing := [path for path in paths if not versions.exists(spark, path)]:
        raise OutputError("missing: " + ", ".join(missing))

    star = files.star_of(spark, base, manifest, schemas_of(manifest))
    processed = partitioned(spark, base, manifest, PROCESSED)
    customers = spark.read.parquet(f"{folder}/staged/customers")
    stages = {"raw_customers": customers, "processed": processed, **star}
    counts = reconcile(spark.read.parquet(f"{folder}/quality/passes/profile"), stages)
    rows = {row["stage"]: row["row_count"] for row in counts.collect()}  # one row per stage
    kept_and_removed = rows["kept"] + rows["removed"] + rows["removed_null_status"]
    if not (
        rows["raw_transactions"] == kept_and_removed
        and rows["kept"] == rows["processed"] == rows["fact_transactions"]
        and rows["raw_customers"] == rows["dim_customers"]
    ):
        raise OutputError(f"row counts do not agree: {rows}")

    found = reconcile_contents({
        "processed": (processed, CONTENTS),
        "fact_transactions": (star["fact_transactions"], CONTENTS),
        "raw_customers": (customers, CUSTOMER_CONTENTS),
        "dim_customers": (star["dim_customers"], CUSTOMER_CONTENTS),
    })
    prints = {row["stage"]: tuple(row[x] for x in MEASURES) for row in found.collect()}
    # what cleansing made of the staged rows, as each partition's fingerprint was taken before writing
    prints["cleansed"] = added([x.print for x in manifest.parts[PROCESSED]])
    if not (
        prints["cleansed"] == prints["processed"] == prints["fact_transactions"]
        and prints["raw_customers"] == prints["dim_customers"]
    ):
        raise OutputError(f"contents do not agree: {prints}")
    return counts
