"""Exact money arithmetic on DOUBLE columns that hold whole cents, as SQL expressions.

Sums of doubles depend on the order in which tasks finish, and sums of DECIMAL leave the
fast path of the aggregate. So amounts are summed as integer cents: two BIGINT sums per
group (millions of cents, and the rest) that cannot overflow below some 9e12 rows per group.
The two parts are joined to one DECIMAL only after aggregation, once per output row.

All functions take and return SQL text, for ``selectExpr`` and ``expr``.
"""

from __future__ import annotations


def cents(amount: str) -> str:
    """Whole cents of an amount already rounded to two decimals (exact up to about 4e13)."""
    return f"CAST(rint({amount} * 100) AS BIGINT)"


def sum_blocks(amount: str) -> str:
    """Partial sum, high part."""
    return f"sum({cents(amount)} div 1000000)"


def sum_rest(amount: str) -> str:
    """Partial sum, low part."""
    return f"sum({cents(amount)} % 1000000)"


def total_cents(blocks: str, rest: str) -> str:
    """Exact total from the two partial sums."""
    return f"(CAST({blocks} AS DECIMAL(20,0)) * 1000000 + CAST({rest} AS DECIMAL(20,0)))"


def dollars(total: str) -> str:
    """A total in cents as a DOUBLE amount with two decimals."""
    return f"CAST(CAST({total} AS DECIMAL(36,0)) * 0.01BD AS DOUBLE)"


def half_up_ratio(numerator: str, denominator: str, digits: int) -> str:
    """``numerator / denominator`` rounded half away from zero, as DOUBLE; null over zero.

    Both sides are integers, so the rounding is exact where dividing first and rounding
    afterwards would round twice.
    """
    scaled = f"abs(CAST({numerator} AS DECIMAL(38,0))) * {10**digits}"
    whole = f"nullif(CAST({denominator} AS DECIMAL(20,0)), 0BD)"
    quotient = f"(({scaled} * 2 + {whole}) div ({whole} * 2))"
    return f"(sign({numerator}) * {quotient} / {10**digits})"


def mean_dollars(total: str, count: str, digits: int = 2) -> str:
    """Mean amount from a total in cents, rounded half away from zero to ``digits`` >= 2."""
    scaled = f"CAST({total} AS DECIMAL(34,0)) * {10 ** (digits - 2)}"
    return f"({half_up_ratio(scaled, count, 0)} / {10**digits})"


def percent(part: str, whole: str, digits: int) -> str:
    """``part`` as a percentage of ``whole``; null when ``whole`` is zero."""
    return half_up_ratio(f"CAST({part} AS DECIMAL(34,0)) * 100", whole, digits)
