"""Display formatting (X5-X9), all as JVM-side column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def percent(c: Column | str, digits: int = 1) -> Column:
    """0.1234 -> '12.3%' (X5)."""
    return F.concat(F.format_number(_col(c) * F.lit(100.0), digits), F.lit("%"))


def currency(c: Column | str, digits: int = 2, symbol: str = "$") -> Column:
    """-5 -> '-$5.00': the sign goes before the symbol (X6, §1.4-17)."""
    c = _col(c)
    body = F.format_number(F.abs(c), digits)
    return F.when(c < 0, F.concat(F.lit("-" + symbol), body)).otherwise(
        F.concat(F.lit(symbol), body))


def round_half_even(c: Column | str, digits: int = 2) -> Column:
    """Round half to even, as R's ``round`` does."""
    return F.bround(_col(c), digits)


def plain_number(c: Column | str) -> Column:
    """A number as text, whole values without a decimal point: -3.0 -> '-3', 2.5 -> '2.5'."""
    c = _col(c)
    whole = (c == F.floor(c)) & (F.abs(c) < F.lit(1e15))
    return F.when(whole, c.cast("bigint").cast("string")).otherwise(c.cast("string"))


def template(*lines: Column) -> Column:
    """Multi-line text, one expression per line."""
    return F.concat_ws("\n", *lines)


def labelled(label: str, value: Column) -> Column:
    return F.concat(F.lit(label + ": "), value.cast("string"))


# Display names of the action table, in the order the table
# shows them (the result of the reference's rename followed by replacing "_"
# with a blank and title-casing each word).
ACTION_TABLE_NAMES = {
    "spend_actual_vs_pred": "Actual Vs Prediction",
    "spend_90_total": "90-Day Spend (Actual)",
    "pred_total": "90-Day Spend (Predict)",
    "customer_id": "Cust Id",
    "recency": "Recency",
    "frequency": "Frequency",
    "price_sum": "Monetary (Total)",
    "price_mean": "Monetary (Avg)",
}
