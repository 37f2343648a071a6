"""Order-free fingerprints of the rows of a table.

Two tables with the same rows, repeated ones included, have the same fingerprint in whatever order and however
many files: the number of rows, the sum of one hash of each row and the xor of another. Each is a
plain aggregate, so it takes one pass and a row per task. A row's hashes are the halves of the MD5
of a text that any SQL database can put together, so a source can be asked for the same figures.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DataType, DecimalType, DoubleType, FloatType

MEASURES = ("row_count", "hash_sum", "hash_xor")
DIGITS = 15  # hexadecimal; 60 bits of each half fit a BIGINT


def _text(name: str, kind: DataType) -> str:
    """A value with its length before it, so that neighbours cannot be told apart in two ways."""
    if isinstance(kind, (DecimalType, DoubleType, FloatType)) and getattr(kind, "scale", 1):
        name = f"CAST({name} AS DECIMAL(30,4))"
    value = f"CAST({name} AS STRING)"
    return f"coalesce(length({value}) || ':' || {value}, 'n')"


def _half(place: int) -> str:
    return f"CAST(conv(substr(digest, {place}, {DIGITS}), 16, 10) AS BIGINT)"


def fingerprint(frame: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """``row_count``, ``hash_sum`` and ``hash_xor`` over ``columns``, one row or one per ``by``.

    ``hash_sum`` is text, as it is wider than a BIGINT. Amounts count with four decimals.
    """
    row = " || ".join(_text(name, frame.schema[name].dataType) for name in columns)
    return (
        frame.select(*by, F.expr(f"md5({row}) AS digest"))
        .groupBy(*by)
        .agg(
            F.expr("count(*) AS row_count"),
            F.expr(f"CAST(coalesce(sum(CAST({_half(1)} AS DECIMAL(38,0))), 0BD) AS STRING) AS hash_sum"),
            F.expr(f"coalesce(bit_xor({_half(17)}), 0L) AS hash_xor"),
        )
    )


def added(prints: Sequence[tuple[int, str, int]]) -> tuple[int, str, int]:
    """The fingerprint of several disjoint parts together."""
    rows, total, mixed = 0, 0, 0
    for n, hash_sum, hash_xor in prints:
        rows, total, mixed = rows + n, total + int(hash_sum), mixed ^ hash_xor
    return rows, str(total), mixed
