"""Database source: a table is read in slices, by as many tasks as there are slices."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

SOURCE_TABLES = ("customers", "transactions")

# Rows that each of some conditions matches
RowCounter = Callable[[Sequence[str]], Sequence[int]]
AT_ONCE = 200  # conditions counted by one query
FINE = 4  # ranges per slice in the first round


def extract_tables(
    spark: SparkSession,
    url: str,
    slices: Mapping[str, Sequence[str]],
    properties: Mapping[str, str] | None = None,
    tables: Sequence[str] = SOURCE_TABLES,
) -> dict[str, DataFrame]:
    """Whole tables, by name, each read in the slices given for it.

    Slices are SQL conditions that between them match every row once; build them with
    :func:`number_slices`, :func:`text_slices`, :func:`range_slices` or :func:`hash_slices`. A table
    without slices is read by one task, which suits only small ones.

    ``fetchsize`` bounds the rows a task holds. MySQL's driver heeds it only with
    ``useCursorFetch=true`` among the properties or in the URL; without it a task buffers its slice.
    """
    options = {"fetchsize": "10000", **(properties or {})}
    frames = {}
    for table in tables:
        conditions = list(slices.get(table, ())) or ["1 = 1"]
        frames[table] = spark.read.jdbc(url, table, predicates=conditions, properties=options)
    return frames


def number_slices(column: str, lower: int, upper: int, count: int) -> list[str]:
    """Slices of a numeric key, equally wide between the bounds, for sources with an index on it.

    The outer ones are open, so the bounds decide only how even the slices are; nulls go first.
    """
    span = upper - lower
    return _between(column, [str(cut) for cut in _cuts(lower, span, count)])


def text_slices(column: str, bounds: Sequence[str]) -> list[str]:
    """Slices of a text key between ``bounds``, which ascend in the order of the source's collation.

    For uuids, ``[f"{i:02x}" for i in range(4, 256, 4)]`` gives 64 even slices. Nulls go first.
    """
    return _between(column, ["'" + bound.replace("'", "''") + "'" for bound in bounds])


def range_slices(column: str, first: datetime.date, last: datetime.date, count: int) -> list[str]:
    """Slices by date, for sources with an index on it. The outer ones are open; nulls go first."""
    days = _cuts(0, (last - first).days, count)
    return _between(column, [f"'{first + datetime.timedelta(days=day)}'" for day in days])


def hash_slices(hashed: str, count: int) -> list[str]:
    """Slices by the remainder of a non-negative integer expression of the source dialect.

    For keys without an index: every slice scans the whole source table, so ``count`` slices cost
    ``count`` scans. With a hash of a unique key, such as ``CRC32(transaction_id)``, slices are of
    equal size however skewed other columns are. Rows where the expression is null go with the first.
    """
    slices = [f"MOD({hashed}, {count}) = {remainder}" for remainder in range(count)]
    slices[0] = f"({slices[0]} OR ({hashed}) IS NULL)"
    return slices


# Slices without known bounds ------------------------------------------------------------------


def counts_in_source(
    spark: SparkSession, url: str, table: str, properties: Mapping[str, str] | None = None
) -> RowCounter:
    """Counts by one query of the source per ``AT_ONCE`` conditions; a row comes back."""

    def counted(conditions: Sequence[str]) -> list[int]:
        found: list[int] = []
        for at in range(0, len(conditions), AT_ONCE):
            part = conditions[at : at + AT_ONCE]
            sums = ", ".join(f"SUM(CASE WHEN {x} THEN 1 ELSE 0 END) AS c{i}" for i, x in enumerate(part))
            query = f"(SELECT {sums} FROM {table}) AS counted"
            found += [int(x or 0) for x in spark.read.jdbc(url, query, properties=dict(properties or {})).first()]
        return found

    return counted


def counts_in_frame(frame: DataFrame) -> RowCounter:
    """Counts by one pass over a DataFrame per ``AT_ONCE`` conditions."""

    def counted(conditions: Sequence[str]) -> list[int]:
        found: list[int] = []
        for at in range(0, len(conditions), AT_ONCE):
            part = conditions[at : at + AT_ONCE]
            found += list(frame.agg(*[F.count_if(F.expr(x)).alias(f"c{i}") for i, x in enumerate(part)]).first())
        return found

    return counted


def even_slices(
    counted: RowCounter,
    column: str,
    lower: int,
    upper: int,
    count: int,
    literal: Callable[[int], str] = str,
    tie: str | None = None,
) -> list[str]:
    """Some ``count`` slices of about equally many rows, however the key is distributed.

    ``lower`` and ``upper`` are the least and the greatest key. Rows are counted per range, and ranges with
    more than half a slice's rows are cut again, until none is left that can be; neighbours are then joined.
    So a slice has at most a quarter more than its share, but for single keys with more. Such a key is dealt
    over several slices by ``tie``, a non-negative integer expression of the source's, if there is one.

    ``literal`` writes a number as the key: dates as days (``lambda n: f"'{first + timedelta(n)}'"``),
    or hexadecimal text by its first digits (``lambda n: f"'{n:06x}'"``). Every row is matched once, nulls and keys
    outside the bounds too.
    """
    edges = sorted({lower, *_cuts(lower, upper + 1 - lower, FINE * count), upper + 1})
    ranges = list(zip(edges, edges[1:]))

    def condition(low: int, high: int) -> str:
        tests = [f"{column} >= {literal(low)}"] if low > lower else []
        tests += [f"{column} < {literal(high)}"] if high <= upper else []
        return " AND ".join(tests) or f"{column} IS NOT NULL"

    nulls, *depths = counted([f"{column} IS NULL", *[condition(*x) for x in ranges]])
    total = nulls + sum(depths)
    most = max(total / (2 * count), 1)
    while heavy := [i for i, (low, high) in enumerate(ranges) if depths[i] > most and high - low > 1]:
        cut = {}
        for i in heavy:
            low, high = ranges[i]
            inner = sorted({low, *_cuts(low, high - low, min(high - low, int(2 * depths[i] / most) + 1)), high})
            cut[i] = list(zip(inner, inner[1:]))
        found = iter(counted([condition(*x) for parts in cut.values() for x in parts]))
        pieces = [
            (part, next(found) if i in cut else depths[i])
            for i, x in enumerate(ranges)
            for part in cut.get(i, [x])
        ]
        ranges, depths = [x for x, _ in pieces], [n for _, n in pieces]

    slices = _dealt(f"{column} IS NULL", nulls, 2 * most, tie)
    begin, held = lower, 0
    for (low, high), depth in zip(ranges, depths):
        if held and held + depth > 2.5 * most:
            slices.append(condition(begin, low))
            begin, held = low, 0
        held += depth
        if held > 2.5 * most:  # one key alone
            slices += _dealt(condition(begin, high), held, 2 * most, tie)
            begin, held = high, 0
    if begin <= upper:
        slices.append(condition(begin, upper + 1))
    return slices


def _dealt(condition: str, depth: float, share: float, tie: str | None) -> list[str]:
    """A condition, in as many parts as its rows are times ``share``."""
    parts = int(-(-depth // share)) if tie else 1
    if parts <= 1:
        return [condition]
    return [f"{condition} AND {x}" for x in hash_slices(tie, parts)]


def _cuts(lower: int, span: int, count: int) -> list[int]:
    return sorted({lower + span * step // count for step in range(1, count)})


def _between(column: str, cuts: Sequence[str]) -> list[str]:
    """Conditions between neighbouring literals, open at both ends; nulls go with the first."""
    if not cuts:
        return ["1 = 1"]
    middle = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:])]
    return [
        f"({column} < {cuts[0]} OR {column} IS NULL)",
        *middle,
        f"{column} >= {cuts[-1]}",
    ]
