"""File sinks. Every one replaces the whole target, and writes from the tasks directly."""

from __future__ import annotations

from pyspark.sql import DataFrame

from ledgerstar.sources.files import CSV_OPTIONS


def write_csv(frame: DataFrame, path: str, rows_per_file: int = 0) -> None:
    """CSV with a header; white space at the ends of text is kept. Zero rows a file: no bound."""
    options = {
        **CSV_OPTIONS,
        "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False,
        "maxRecordsPerFile": rows_per_file,
    }
    frame.write.mode("overwrite").options(**options).csv(path)


def write_parquet(frame: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet, with one directory per combination of ``partition_by``.

    Rows are rebalanced by those columns first. Adaptive execution then cuts a large partition
    value into many tasks of the advisory size and merges small ones: neither does a value with
    a third of all rows end up in one task, nor does each task write a file per value.
    """
    if partition_by:
        frame = frame.hint("rebalance", *partition_by)
    frame.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_json(frame: DataFrame, path: str) -> None:
    """One JSON document per line; nulls are written, so every line has all fields."""
    frame.write.mode("overwrite").option("ignoreNullFields", False).json(path)
