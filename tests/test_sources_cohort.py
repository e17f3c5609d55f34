"""S1-S3, F1, F4, N1, G1, G2, G8, O2 on hand-made rows (FIXTURES §1, §3)."""

from __future__ import annotations

import datetime as dt

from conftest import d, tx_frame

from clvspark.functions.dates import expand_partial_date, parse_period
from clvspark.operators import cohort as co
from clvspark.operators.timeseries import summarize_by_time
from clvspark.sources.transactions import drop_incomplete, read_transactions

RAW_LINES = [
    " 00001 19970101  1   11.77",
    " 00002 19970112  1   12.00",
    " 00002 19970112  5   77.00",
    " 00003 19970102  2    9.76",
    " 00004 19970102  2  100.50",
    " 00005 19970102 12   29.33",
    " 00006 19970230  1   20.00",
]


def _write(tmp_path):
    path = tmp_path / "tx.txt"
    path.write_text("\n".join(RAW_LINES) + "\n")
    return str(path)


def test_whitespace_layout_keeps_all_good_rows(spark, tmp_path):
    df = read_transactions(spark, _write(tmp_path), layout="whitespace")
    rows = sorted(df.collect(), key=lambda r: (r.customer_id, r.quantity))
    assert [r.customer_id for r in rows] == ["00001", "00002", "00002", "00003", "00004", "00005"]
    assert rows[0].date == d("1997-01-01")
    assert rows[-1].quantity == 12.0 and rows[-1].price == 29.33
    assert dict(df.dtypes) == {"customer_id": "string", "date": "date",
                               "quantity": "double", "price": "double"}


def test_positional_layout_loses_shifted_rows(spark, tmp_path):
    df = read_transactions(spark, _write(tmp_path), layout="positional")
    assert sorted(r.customer_id for r in df.collect()) == ["00001", "00002", "00002"]


def test_bad_date_is_null_then_dropped(spark, tmp_path):
    df = read_transactions(spark, _write(tmp_path), layout="whitespace")
    assert df.filter("customer_id = '00006'").count() == 0


def test_drop_incomplete_drops_nan_and_null(spark):
    df = spark.createDataFrame([(1, 1.0), (2, float("nan")), (None, 3.0), (4, None)],
                               "a long, b double")
    assert sorted(r.a for r in drop_incomplete(df).collect()) == [1]


def test_partial_dates_and_periods():
    assert expand_partial_date("1997-03", "end") == dt.date(1997, 3, 31)
    assert expand_partial_date("1996-02", "end") == dt.date(1996, 2, 29)
    assert expand_partial_date("1997", "start") == dt.date(1997, 1, 1)
    assert parse_period("90 days").n == 90 and parse_period("2 weeks").unit == "week"


def test_cohort_bounds_inclusive_and_keeps_history(spark):
    tx = tx_frame(spark, [(1, "1996-12-31", 10), (2, "1997-01-01", 10), (3, "1997-03-31", 10),
                          (4, "1997-04-01", 10), (2, "1998-05-05", 20)])
    ids = sorted(r.customer_id for r in co.cohort_ids(tx, "1997-01", "1997-03").collect())
    assert ids == [2, 3]
    hist = co.cohort(tx, "1997-01", "1997-03")
    assert hist.filter("customer_id = 2").count() == 2      # later purchase kept


def test_first_purchases_keep_ties(spark):
    tx = tx_frame(spark, [(1, "1997-01-02", 5), (1, "1997-01-02", 7), (1, "1997-02-01", 9),
                          (2, "1997-01-05", 3)])
    firsts = co.first_purchases(tx)
    assert firsts.filter("customer_id = 1").count() == 2
    rng = co.date_range(firsts).first()
    assert (rng.min_date, rng.max_date) == (d("1997-01-02"), d("1997-01-05"))


def test_month_gap_not_filled(spark):
    tx = tx_frame(spark, [(1, "1997-01-10", 5.25), (2, "1997-01-20", 4.75), (1, "1997-03-02", 1)])
    out = {r.date: r.total_price for r in summarize_by_time(tx, "date", "month").collect()}
    assert out == {d("1997-01-01"): 10.0, d("1997-03-01"): 1.0}


def test_week_starts_on_sunday(spark):
    tx = tx_frame(spark, [(1, "2024-01-03", 1)])                 # a Wednesday
    out = summarize_by_time(tx, "date", "week").first()
    assert out.date == d("2023-12-31")


def test_customer_histories_first_ten_ids(spark):
    tx = tx_frame(spark, [(i, "1997-01-01", i) for i in range(30, 0, -1)])
    ids = sorted({r.customer_id for r in co.customer_histories(tx, 10).collect()})
    assert ids == list(range(1, 11))


def test_hot_customer_is_salted_and_results_unchanged(spark):
    from pyspark.sql import functions as F

    from clvspark.operators.skew import hot_keys, row_counts, salted_join
    # customer 7 holds a third of all rows
    big = spark.range(30000).select(
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 997 + 100)
         .alias("customer_id"), F.col("id").alias("v"))
    small = spark.range(90, 400).select(F.col("id").alias("customer_id"),
                                        (F.col("id") % 2 == 0).alias("flag"))
    small = small.unionByName(spark.createDataFrame([(7, True)], "customer_id long, flag boolean"))
    hot = hot_keys(row_counts(big, "customer_id"), "customer_id", share=0.01, rows_per_task=1000)
    assert [(r.customer_id, r._salts) for r in hot.collect()] == [(7, 10)]
    for how in ("inner", "left_semi", "left_anti"):
        joined = salted_join(big, small, "customer_id", how, share=0.01, rows_per_task=1000)
        assert sorted(joined.collect()) == sorted(big.join(small, "customer_id", how).collect())
        assert joined.columns == big.join(small, "customer_id", how).columns
    # the hot customer's rows are spread over its salts
    spread = (big.join(F.broadcast(hot), "customer_id")
                 .select(F.pmod(F.xxhash64("customer_id", "v"), F.col("_salts")).alias("s"))
                 .groupBy("s").count().collect())
    assert len(spread) == 10 and max(r["count"] for r in spread) < 2 * 10000 / 10


def test_cohort_with_a_hot_customer(spark):
    rows = [(1, "1997-01-05", 1)] * 300 + [(2, "1997-02-01", 1), (3, "1996-05-01", 1),
                                           (3, "1997-02-01", 1)]
    tx = tx_frame(spark, rows)
    out = co.cohort(tx, "1997-01", "1997-03")
    assert out.count() == 301 and {r.customer_id for r in out.collect()} == {1, 2}
