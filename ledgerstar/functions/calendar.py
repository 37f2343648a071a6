"""Calendar expressions as SQL text, for DATE, TIMESTAMP and TIMESTAMP_NTZ columns."""

from __future__ import annotations

from ledgerstar.schemas import DAY_LABELS


def date_key(moment: str) -> str:
    """``yyyyMMdd`` as an int. Arithmetic on date parts, as formatting text per row costs more."""
    return f"(year({moment}) * 10000 + month({moment}) * 100 + day({moment}))"


def date_of_key(key: str) -> str:
    """The date behind a ``yyyyMMdd`` int."""
    return f"make_date(int({key} div 10000), int({key} % 10000 div 100), {key} % 100)"


def is_weekend(moment: str) -> str:
    """True on Saturday and Sunday; an unknown day is not a weekend."""
    return f"coalesce(dayofweek({moment}) IN (1, 7), false)"


def period_label(year: str, month: str) -> str:
    """``YYYY-MM``."""
    return f"concat({year}, '-', lpad({month}, 2, '0'))"


def day_label(day_of_week: str) -> str:
    """``Sun`` … ``Sat`` for 1 … 7."""
    labels = ", ".join(f"'{label}'" for label in DAY_LABELS)
    return f"element_at(array({labels}), {day_of_week})"


def hour_label(hour: str) -> str:
    """``00:00`` … ``23:00``."""
    return f"format_string('%02d:00', {hour})"
