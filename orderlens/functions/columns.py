"""Column helpers: warehouse date arithmetic, exact money, guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ntz(value: str | Column) -> Column:
    """A zone-free timestamp from literal text or a column."""
    return (F.lit(value) if isinstance(value, str) else value).cast("timestamp_ntz")


def time_floor(unit: str, ts: Column) -> Column:
    """``date_trunc`` that keeps the zone-free type."""
    return F.date_trunc(unit, ts).cast("timestamp_ntz")


def hour_floor(ts: Column) -> Column:
    return time_floor("hour", ts)


def boundaries(unit: str, start: Column, end: Column) -> Column:
    """Unit boundaries crossed between two instants (00:59 -> 01:01 is one hour)."""
    return F.timestamp_diff(unit, F.date_trunc(unit, start), F.date_trunc(unit, end))


def money(col: Column, scale: int = 2) -> Column:
    return col.cast(f"decimal(18,{scale})")


def dbl(col: Column) -> Column:
    return col.cast("double")


def ratio(num: Column, den: Column) -> Column:
    """Double division that is NULL for a zero denominator."""
    return dbl(num) / F.nullif(dbl(den), F.lit(0.0))


def pct(num: Column, den: Column) -> Column:
    return F.round(ratio(num, den) * 100, 2)


def mean(total: Column, n: Column) -> Column:
    """Mean from an exact sum and a count; NULL when nothing was counted."""
    return ratio(total, n)


def json_text(doc: Column, key: str) -> Column:
    """Text at a top-level key; NULL for a missing key or broken document."""
    return F.get_json_object(doc, f"$.{key}")
