"""Exact money aggregates.

Prices are summed as DECIMAL so a sum does not depend on the order in which
partitions are combined; the result is handed back as DOUBLE. A mean is one
division of the exact sum by the count, so it is the correctly rounded value
of the exact mean. Twelve decimal places keep every digit of a price that a
DOUBLE of a thousandth or more can hold, so no price is rounded to cents;
``scale=None`` falls back to plain DOUBLE aggregates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCALE = 12


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_sum(c: Column | str, scale: int | None = DEFAULT_SCALE) -> Column:
    """Sum that is independent of partitioning (DECIMAL(38, scale) inside)."""
    c = _col(c)
    if scale is None:
        return F.sum(c.cast("double"))
    return F.sum(c.cast(f"decimal(38,{scale})")).cast("double")


def exact_mean(c: Column | str, scale: int | None = DEFAULT_SCALE) -> Column:
    """Mean as one division of the exact sum by the count of non-NULL values."""
    c = _col(c)
    if scale is None:
        return F.avg(c.cast("double"))
    return exact_sum(c, scale) / F.nullif(F.count(c), F.lit(0)).cast("double")
