"""Layouts of written tables that later reads profit from.

:func:`write_clustered` orders rows along a space-filling curve over several columns, so that each file and row group
covers a small range of every one of them, and a filter on any of them skips most. :func:`write_bucketed`
files rows by the hash of a key, so that joins and groupings by it need no shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

CELLS = 1 << 8  # steps of each column on the curve
ROWS_PER_GROUP_BYTES = 16 << 20
BUCKETS = 64


# Space-filling curve ---------------------------------------------------------------------------


def _number(frame: DataFrame, name: str) -> Column:
    """A column as a number whose order is the column's."""
    kind = frame.schema[name].dataType
    if isinstance(kind, (DateType, TimestampType, TimestampNTZType)):
        return F.unix_date(F.col(name).cast("date")).cast("double")
    return F.col(name).cast("double")


def _spread(cell: Column, columns: int, bits: int) -> Column:
    """The bits of a cell with room for those of the other columns between them."""
    found = F.lit(0).cast("bigint")
    for i in range(bits):
        bit = F.shiftright(cell, i).bitwiseAND(F.lit(1))
        found = found.bitwiseOR(F.shiftleft(bit, i * columns))
    return found


def curve(frame: DataFrame, columns: Sequence[str], cells: int = CELLS) -> Column:
    """The place of a row on a Z-curve over numbers and dates, from one pass over their quantiles.

    Steps hold equal shares of the rows, so a few far values do not squeeze all others into one; a value
    that is more frequent takes one step. Null comes before all.
    """
    shares = [i / cells for i in range(1, cells)]
    numbers = {name: _number(frame, name) for name in columns}
    found = frame.agg(
        *[F.percentile_approx(number, shares, 4 * cells).alias(name) for name, number in numbers.items()]
    ).first()  # cells - 1 numbers a column
    bits = (cells - 1).bit_length()
    place = F.lit(0).cast("bigint")
    for i, (name, number) in enumerate(numbers.items()):
        bounds = sorted(set(found[name] or []))
        cell = F.coalesce(_steps_below(number, bounds), F.lit(0)).cast("bigint")
        # the cell is bound to a variable, so its search is one expression and not one for each bit
        spread = F.transform(F.array(cell), lambda x: _spread(x, len(columns), bits))[0]
        place = place.bitwiseOR(F.shiftleft(spread, i))
    return place


def _steps_below(number: Column, bounds: Sequence[float]) -> Column:
    """How many bounds lie below ``number``, by halving: a search without a loop over all bounds."""
    if not bounds:
        return F.lit(0)
    middle = len(bounds) // 2
    if len(bounds) <= 8:
        return F.when(number.isNotNull(), sum((F.when(number > x, 1).otherwise(0) for x in bounds), F.lit(0)))
    low, high = _steps_below(number, bounds[:middle]), _steps_below(number, bounds[middle:])
    return F.when(number <= bounds[middle], low).otherwise(high + middle)


def write_clustered(
    frame: DataFrame, path: str, columns: Sequence[str], files: int, cells: int = CELLS
) -> None:
    """Parquet in ``files`` files of neighbouring rows on the curve.

    Rows of one place are dealt by a hash of all their columns, so a frequent place may fill several files, though not a
    row that is repeated as a whole. Numbers and dates can be ``columns``; text has no place on the curve.
    """
    place = curve(frame, columns, cells)
    rows = frame.withColumn("_place", place).withColumn("_tie", F.xxhash64(*frame.columns))
    (
        rows.repartitionByRange(files, "_place", "_tie")
        .sortWithinPartitions("_place")
        .drop("_place", "_tie")
        .write.mode("overwrite")
        .option("parquet.block.size", ROWS_PER_GROUP_BYTES)
        .parquet(path)
    )


# Buckets ---------------------------------------------------------------------------------------


def write_bucketed(
    frame: DataFrame, table: str, path: str, key: str, buckets: int = BUCKETS
) -> DataFrame:
    """A catalog table at ``path`` in buckets of ``key``, sorted by it; returned as read back.

    Meant for tables with few rows per key, such as dimensions and rollups: a bucket is a task, and a key with a
    third of a fact's rows would fill one.
    """
    (
        frame.repartition(buckets, key)  # one file a bucket
        .write.mode("overwrite")
        .option("path", path)
        .bucketBy(buckets, key)
        .sortBy(key)
        .saveAsTable(table)
    )
    return frame.sparkSession.table(table)


def attach_bucketed(
    spark: SparkSession, table: str, path: str, columns: str, key: str, buckets: int = BUCKETS
) -> DataFrame:
    """Make a folder that :func:`write_bucketed` has written known to another session's catalog."""
    spark.sql(
        f"CREATE TABLE {table} ({columns}) USING parquet "
        f"CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(table)
