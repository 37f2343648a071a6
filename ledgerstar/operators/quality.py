"""Data-quality checks on raw tables.

Whatever the number of checks, a transaction table is read four times (:func:`passes`): one global
aggregate (:func:`profile`), one small group-by (:func:`distribution`), one shuffle by id
(:func:`duplicates`) and one of the customers in use (:func:`lost_references`). The first two shuffle
a row per task or value. The third is apart since a distinct count beside plain aggregates would
shuffle all of them per id.

Checks are rows of ``check, status, bad_count, details``; they report and never stop a run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import StringType

from ledgerstar.functions import money
from ledgerstar.schemas import (
    AMOUNT_LIMIT,
    CRITICAL_COLUMNS,
    CUSTOMER_LENGTHS,
    REMOVED_STATUS,
    STATUSES,
    TRANSACTION_LENGTHS,
    TRANSACTION_TYPES,
)

DOMAINS = {"transaction_type": TRANSACTION_TYPES, "status": STATUSES}

# Names of the rows of full_report
CHECKS = (
    "record_counts",
    "null_critical_columns",
    "amount_positive",
    "unique_transaction_ids",
    *[f"valid_{name}" for name in DOMAINS],
    "transactions_primary_key",
    "customers_primary_key",
    "customers_unique_email",
    "transactions_text_lengths",
    "transactions_amount_range",
    "customers_text_lengths",
    "customer_id_reference",
    "overall",
)


# Passes over the data ------------------------------------------------------------


def profile(
    transactions: DataFrame,
    critical: Sequence[str] = CRITICAL_COLUMNS,
    removed_status: str = REMOVED_STATUS,
) -> DataFrame:
    """One row with all counts and amount statistics. Unused columns are pruned by Catalyst.

    ``long_<column>`` counts texts beyond their declared length, ``amount_beyond_limit`` amounts beyond
    DECIMAL(10,2).
    """
    rounded = "CAST(round(amount, 2) AS DOUBLE)"
    removed = F.col("status") == removed_status
    return transactions.agg(
        F.expr("count(*) AS row_count"),
        F.count_if(~removed).alias("kept_rows"),
        F.count_if(removed).alias("removed_rows"),
        F.expr("count_if(status IS NULL) AS null_status_rows"),
        *[F.expr(f"count_if({_missing(transactions, c)}) AS null_{c}") for c in critical],
        F.expr("count_if(amount <= 0) AS non_positive_amounts"),
        F.expr("count(amount) AS amount_count"),
        F.expr(f"min({rounded}) AS amount_min"),
        F.expr(f"max({rounded}) AS amount_max"),
        F.expr(f"{money.sum_blocks(rounded)} AS amount_blocks"),
        F.expr(f"{money.sum_rest(rounded)} AS amount_rest"),
        F.expr(f"stddev_samp({rounded}) AS amount_stddev"),
        *_long_texts(transactions, TRANSACTION_LENGTHS),
        F.expr(f"count_if(abs(round(amount, 2)) >= {AMOUNT_LIMIT}) AS amount_beyond_limit"),
    )


def customer_profile(customers: DataFrame) -> DataFrame:
    """One row with the texts of each column that are beyond their declared length."""
    return customers.agg(*_long_texts(customers, CUSTOMER_LENGTHS))


def distribution(transactions: DataFrame) -> DataFrame:
    """Row counts per transaction type and status."""
    return transactions.groupBy("transaction_type", "status").agg(F.expr("count(*) AS row_count"))


def duplicates(frame: DataFrame, *keys: str) -> DataFrame:
    """One row on repeated keys: ``duplicate_count`` has the rows beyond the first of each key.

    There null keys count as one value. ``repeats`` leaves out keys with a null in any column, and
    ``nulls`` has the rows with such a key; a primary key allows neither.
    """
    null = " OR ".join(f"{key} IS NULL" for key in keys)
    return frame.groupBy(*keys).agg(F.expr("count(*) AS n")).agg(
        F.expr("coalesce(sum(n - 1), 0L) AS duplicate_count"),
        F.expr(f"coalesce(sum(n - 1) FILTER (WHERE NOT ({null})), 0L) AS repeats"),
        F.expr(f"coalesce(sum(n) FILTER (WHERE {null}), 0L) AS nulls"),
    )


def orphans(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Rows per foreign key without a parent row; null keys are exempt.

    Both sides are reduced to one row per key before the join, so a key that holds a third of
    either is one row there. Their shuffles serve the join as well.
    """
    counted = child.filter(F.col(key).isNotNull()).groupBy(key).agg(F.expr("count(*) AS row_count"))
    return counted.join(parent.select(key).distinct(), key, "left_anti")


def lost_references(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """One row with the rows whose parent is missing, and how many keys they carry."""
    return orphans(child, parent, key).agg(
        F.expr("coalesce(sum(row_count), 0L) AS lost_rows"), F.expr("count(*) AS missing_keys")
    )


def passes(transactions: DataFrame, customers: DataFrame) -> dict[str, DataFrame]:
    """Everything that :func:`full_report` needs; write these down and pass what is read back."""
    return {
        "profile": profile(transactions),
        "distribution": distribution(transactions),
        "duplicates": duplicates(transactions, "transaction_id"),
        "references": lost_references(transactions, customers),
        "customers": customer_profile(customers),
        "customer_ids": duplicates(customers, "customer_id"),
        "emails": duplicates(customers.filter("email IS NOT NULL"), "email"),
    }


# Single checks -------------------------------------------------------------------


def null_check(profiled: DataFrame, critical: Sequence[str] = CRITICAL_COLUMNS) -> DataFrame:
    """Missing values per critical column."""
    names = [f"null_{name}" for name in critical]
    return profiled.selectExpr(*names, f"{_status(' + '.join(names))} AS status")


def amount_check(profiled: DataFrame) -> DataFrame:
    """Amounts that are zero or negative; a null is not counted."""
    bad = "non_positive_amounts"
    return profiled.selectExpr(f"{bad} AS invalid_count", f"{_status(bad)} AS status")


def duplicate_check(duplicated: DataFrame) -> DataFrame:
    """Repeated ids."""
    bad = "duplicate_count"
    return duplicated.selectExpr(bad, f"{_status(bad)} AS status")


def domain_check(
    distributed: DataFrame, column: str, valid: Sequence[str] | None = None
) -> DataFrame:
    """Every value of ``column`` with its row count and whether it is allowed; null is not."""
    allowed = DOMAINS[column] if valid is None else valid
    return value_counts(distributed, column).withColumn("is_valid", _allowed(column, allowed))


def value_counts(distributed: DataFrame, column: str) -> DataFrame:
    """Rows per value of ``column``."""
    return distributed.groupBy(column).agg(F.expr("sum(row_count) AS row_count"))


def amount_stats(profiled: DataFrame) -> DataFrame:
    """Count, minimum, maximum, mean and sample standard deviation of the rounded amount."""
    total = money.total_cents("amount_blocks", "amount_rest")
    return profiled.selectExpr(
        "amount_count",
        "amount_min",
        "amount_max",
        f"{money.mean_dollars(total, 'amount_count', 6)} AS amount_mean",
        "round(amount_stddev, 6) AS amount_stddev",
    )


# Reports -------------------------------------------------------------------------


def quality_report(
    profiled: DataFrame,
    distributed: DataFrame,
    duplicated: DataFrame,
    critical: Sequence[str] = CRITICAL_COLUMNS,
    domains: Mapping[str, Sequence[str]] = DOMAINS,
) -> DataFrame:
    """All checks of transactions and, in a last row, whether all of them passed."""
    return with_overall(quality_checks(profiled, distributed, duplicated, critical, domains))


def full_report(found: Mapping[str, DataFrame]) -> DataFrame:
    """All checks, declared constraints and references of :func:`passes`, and whether all passed."""
    checks = quality_checks(found["profile"], found["distribution"], found["duplicates"])
    return with_overall(
        checks.unionByName(constraint_checks(found)).unionByName(reference_check(found["references"]))
    )


def quality_checks(
    profiled: DataFrame,
    distributed: DataFrame,
    duplicated: DataFrame,
    critical: Sequence[str] = CRITICAL_COLUMNS,
    domains: Mapping[str, Sequence[str]] = DOMAINS,
) -> DataFrame:
    """The checks of transactions, one row each.

    Invalid values are counted here; :func:`domain_values` lists them, one row each, since
    there may be any number of them.
    """
    nulls = {name: f"null_{name}" for name in critical}
    counts = {
        "total_raw_records": "row_count",
        "processed_record_count": "kept_rows",
        "removed": "removed_rows",
        "removed_null_status": "null_status_rows",
    }
    columns = _checks(
        profiled,
        _check("record_counts", "0", counts),
        _check("null_critical_columns", " + ".join(nulls.values()), nulls),
        _check("amount_positive", "non_positive_amounts"),
    )
    ids = _checks(duplicated, _check("unique_transaction_ids", "duplicate_count"))
    invalid = {
        name: F.expr(f"count_if(`column` = '{name}' AND NOT is_valid) AS {name}") for name in domains
    }
    values = _checks(
        domain_values(distributed, domains).agg(*invalid.values()),
        *[_check(f"valid_{name}", name, {"distinct_invalid": name}) for name in domains],
    )
    return columns.unionByName(ids).unionByName(values)


def domain_values(
    distributed: DataFrame, domains: Mapping[str, Sequence[str]] = DOMAINS
) -> DataFrame:
    """Distributions of all domain columns in long form: column, value, row count, validity."""
    pairs = [
        F.struct(
            F.lit(name).alias("column"),
            F.col(name).alias("value"),
            F.col("row_count"),
            _allowed(name, allowed).alias("is_valid"),
        )
        for name, allowed in domains.items()
    ]
    return (
        distributed.select(F.inline(F.array(*pairs)))
        .groupBy("column", "value", "is_valid")
        .agg(F.sum("row_count").alias("row_count"))
        .select("column", "value", "row_count", "is_valid")
    )


def constraint_report(transactions: DataFrame, customers: DataFrame) -> DataFrame:
    """Declared column constraints: primary keys, unique email, text lengths, amount range."""
    return with_overall(constraint_checks(passes(transactions, customers)))


def constraint_checks(found: Mapping[str, DataFrame]) -> DataFrame:
    """The declared constraints, one row each, from the shared :func:`passes`."""
    keys = {"repeats": "repeats", "nulls": "nulls"}
    checks, *rest = [
        _checks(found["duplicates"], _check("transactions_primary_key", "repeats + nulls", keys)),
        _checks(found["customer_ids"], _check("customers_primary_key", "repeats + nulls", keys)),
        _checks(found["emails"], _check("customers_unique_email", "repeats")),
        _checks(
            found["profile"],
            _length_check("transactions", TRANSACTION_LENGTHS),
            _check("transactions_amount_range", "amount_beyond_limit"),
        ),
        _checks(found["customers"], _length_check("customers", CUSTOMER_LENGTHS)),
    ]
    for more in rest:
        checks = checks.unionByName(more)
    return checks


def reference_report(child: DataFrame, parent: DataFrame, key: str = "customer_id") -> DataFrame:
    """Foreign-key check: rows whose parent is missing, and how many keys they carry."""
    return reference_check(lost_references(child, parent, key), key)


def reference_check(lost: DataFrame, key: str = "customer_id") -> DataFrame:
    return _checks(lost, _check(f"{key}_reference", "lost_rows", {"missing_keys": "missing_keys"}))


def with_overall(checks: DataFrame) -> DataFrame:
    """``checks`` with a closing row that passes only if every check did.

    The check rows go through one array: there is one element per check, whatever the data.
    """
    return checks.agg(
        F.expr("collect_list(struct(*)) AS rows"), F.expr("count_if(status != 'PASS') AS failed")
    ).selectExpr(f"inline(concat(rows, array({_check('overall', 'failed')})))")


# Helpers -------------------------------------------------------------------------


def _missing(frame: DataFrame, name: str) -> str:
    """Null, or empty text. Comparing a number or time with '' is an error in ANSI mode."""
    if isinstance(frame.schema[name].dataType, StringType):
        return f"{name} IS NULL OR {name} = ''"
    return f"{name} IS NULL"


def _allowed(name: str, valid: Sequence[str]) -> Column:
    return F.coalesce(F.col(name).isin(*valid), F.lit(False))


def _status(bad: str) -> str:
    return f"CASE WHEN {bad} = 0 THEN 'PASS' ELSE 'FAIL' END"


def _check(name: str, bad: str, details: Mapping[str, str] | None = None) -> str:
    """SQL for one check: it passes if ``bad`` is zero; ``details`` are named figures."""
    pairs = ", ".join(f"'{key}', CAST({value} AS STRING)" for key, value in (details or {}).items())
    return (
        f"named_struct('check', '{name}', 'status', {_status(bad)}, "
        f"'bad_count', CAST({bad} AS BIGINT), 'details', CAST(map({pairs}) AS MAP<STRING, STRING>))"
    )


def _checks(one_row: DataFrame, *checks: str) -> DataFrame:
    return one_row.selectExpr(f"inline(array({', '.join(checks)}))")


def _long_texts(frame: DataFrame, lengths: Mapping[str, int]) -> list[Column]:
    """Texts beyond their declared length; columns of another type have none."""
    texts = {name for name in lengths if isinstance(frame.schema[name].dataType, StringType)}
    return [
        F.expr(f"count_if({f'length({name}) > {limit}' if name in texts else 'false'}) AS long_{name}")
        for name, limit in lengths.items()
    ]


def _length_check(table: str, lengths: Mapping[str, int]) -> str:
    long = {name: f"long_{name}" for name in lengths}
    return _check(f"{table}_text_lengths", " + ".join(long.values()), long)
