"""Transaction sources: S1 (delimited text), S2 (column pick), S3 (dates), F1.

Every source returns the same shape::

    customer_id, date DATE, quantity DOUBLE, price DOUBLE

Adapters for the driver's test tables live here too (§7.2): ``orders`` is
the main purchase log, ``events`` with ``event_type = 'purchase'`` the second.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clvspark.functions.dates import as_date, parse_ymd

TRANSACTION_COLUMNS = ("customer_id", "date", "quantity", "price")


def drop_incomplete(df: DataFrame) -> DataFrame:
    """Keep complete rows only (F1). NaN counts as missing, as R's NA test does."""
    conds = []
    for name, dtype in df.dtypes:
        c = F.col(f"`{name}`")
        cond = c.isNotNull()
        if dtype in ("double", "float"):
            cond = cond & ~F.isnan(c)
        conds.append(cond)
    if not conds:
        return df
    keep = conds[0]
    for cond in conds[1:]:
        keep = keep & cond
    return df.filter(keep)


def _blank_to_null(c: Column) -> Column:
    return F.nullif(F.trim(c), F.lit(""))


def read_transactions(spark: SparkSession, path: str, layout: str = "whitespace",
                      id_type: str = "string") -> DataFrame:
    """Blank-delimited transaction text without header.

    Fields are customer, ``yyyymmdd`` date, quantity and price.

    * ``layout="whitespace"`` splits on runs of blanks: every well-formed line
      is kept.
    * ``layout="positional"`` splits on single blanks and keeps fields 2, 3, 5
      and 8, as the reference does; with a blank-padded file the padding
      shifts fields for prices outside 10..99.99 or quantities of two digits,
      and those rows drop out as incomplete (§1.4-1).
    """
    raw = spark.read.text(path)
    if layout == "whitespace":
        parts = F.split(F.trim(F.col("value")), r"\s+")
        picks = [F.get(parts, i) for i in (0, 1, 2, 3)]
    elif layout == "positional":
        parts = F.split(F.col("value"), " ")
        picks = [F.get(parts, i) for i in (1, 2, 4, 7)]
    else:
        raise ValueError("layout must be 'whitespace' or 'positional'")
    cust, date, qty, price = (_blank_to_null(p) for p in picks)
    customer = cust.try_cast("bigint") if id_type in ("long", "bigint") else cust
    tx = raw.select(
        customer.alias("customer_id"),
        parse_ymd(date).alias("date"),
        qty.try_cast("double").alias("quantity"),
        price.try_cast("double").alias("price"),
    )
    return drop_incomplete(tx)


def transactions_from(df: DataFrame, customer_id: str, date: str, price: str,
                      quantity: str | Column | None = None,
                      drop_missing: bool = True) -> DataFrame:
    """Pick and rename the four transaction columns of any table."""
    date_type = df.schema[date].dataType
    if quantity is None:
        qty = F.lit(1.0)
    elif isinstance(quantity, str):
        qty = F.col(quantity).cast("double")
    else:
        qty = quantity.cast("double")
    tx = df.select(
        F.col(customer_id).alias("customer_id"),
        as_date(F.col(date), date_type).alias("date"),
        qty.alias("quantity"),
        F.col(price).cast("double").alias("price"),
    )
    return drop_incomplete(tx) if drop_missing else tx


# --- driver test tables -----------------------------------------------------

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def orders_transactions(spark: SparkSession, sf_dir: str, quantity: str = "one") -> DataFrame:
    """``orders`` as a transaction log (§7.2).

    ``quantity="lineitem"`` sums ``l_quantity`` per order: lineitem is
    aggregated per order first (partial aggregation before its shuffle) and
    then joined, so the join sees one row per order. The column is carried
    but never used downstream (§1.4-19), so the flows use ``"one"``.
    """
    orders = read_table(spark, sf_dir, "orders")
    if quantity == "one":
        return transactions_from(orders, "o_custkey", "o_orderdate", "o_totalprice")
    if quantity != "lineitem":
        raise ValueError("quantity must be 'one' or 'lineitem'")
    per_order = (read_table(spark, sf_dir, "lineitem")
                 .groupBy("l_orderkey")
                 .agg(F.sum("l_quantity").alias("o_quantity")))
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    return transactions_from(joined, "o_custkey", "o_orderdate", "o_totalprice",
                             quantity=F.coalesce(F.col("o_quantity"), F.lit(0.0)))


def event_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` rows with ``event_type = 'purchase'`` as transactions (§7.2)."""
    events = read_table(spark, sf_dir, "events").filter(F.col("event_type") == "purchase")
    return transactions_from(events, "user_id", "ts", "value")
