"""The supervised 90-day spend flow: cohort -> splits -> RFM modelling tables.

The reference runs this as a chain of separate steps (cohort filter, two
filters per split, two aggregates and a join per side). Here the same
results come from one plan with few shuffles:

1. ``cohort_ids``: first purchase per customer (partial aggregation), filtered
   to the entry window; one row per cohort customer.
2. ``assignment``: the exact seeded train/test draw over those ids
   (:func:`clvspark.operators.sampling.hash_split_flags`), written as a table
   under the checkpoint folder: it is small (one row per customer) and every
   later step reads it.
3. ``tagged``: transactions joined to the assignment. The inner join is the
   cohort filter and the side tag at once; AQE broadcasts the assignment
   when its measured size allows, else both sides shuffle on
   ``customer_id``.
4. ``sides``: per side the last date, the cutoff and the train side's last
   training date, from the distinct ``(side, date)`` pairs (bounded by the
   calendar, not by the data); at most two rows, broadcast.
5. One conditional aggregation per customer gives features (training rows)
   and targets (assessment rows) together; there is no features-targets
   join. It runs on rows already reduced to one per customer and day, so a
   very active customer stays cheap even when the join is sort-merge and
   the aggregate reuses its partitioning.
"""

from __future__ import annotations

import datetime as _dt
from functools import cached_property

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clvspark.functions.dates import Period, parse_period
from clvspark.functions.money import DEFAULT_SCALE
from clvspark.operators.cohort import filter_by_time
from clvspark.operators.skew import hot_keys, salted_join
from clvspark.operators.features import FEATURES
from clvspark.operators.sampling import hash_split_flags
from clvspark.session import materialize

KEY = "customer_id"
TX_COLUMNS = (KEY, "date", "quantity", "price")


class Prepared:
    """Lazy views of one prepared flow.

    ``tables`` (one row per cohort customer) is written to the checkpoint
    folder the first time it is used: models, scores, metrics and dashboard
    tables all start from it.
    """

    def __init__(self, cohort_ids: DataFrame, assignment: DataFrame, tagged: DataFrame,
                 sides: DataFrame, tables: DataFrame):
        self.cohort_ids = cohort_ids      # customer_id
        self.assignment = assignment      # customer_id, is_train
        self.tagged = tagged              # transactions + is_train, in_assessment
        self.sides = sides                # is_train, max_date, cutoff, ref_date (<= 2 rows)
        self._tables_plan = tables        # modelling rows of both sides + is_train

    @cached_property
    def tables(self) -> DataFrame:
        return materialize(self._tables_plan)

    # --- views in the reference's vocabulary ---------------------------
    @property
    def cohort(self) -> DataFrame:
        return self.tagged.select(*TX_COLUMNS)

    @property
    def ref_date(self) -> Column:
        """Scalar: the train side's last training date."""
        return self.sides.filter(F.col("is_train")).select("ref_date").scalar()

    @property
    def train_ids(self) -> DataFrame:
        return self.assignment.filter(F.col("is_train")).select(KEY)

    def side(self, train: bool) -> DataFrame:
        return self.tagged.filter(F.col("is_train") == F.lit(train)).select(*TX_COLUMNS)

    def part(self, train: bool, assessment: bool) -> DataFrame:
        t = self.tagged.filter((F.col("is_train") == F.lit(train))
                               & (F.col("in_assessment") == F.lit(assessment)))
        return t.select(*TX_COLUMNS)

    def cv_plan(self, train: bool = True) -> DataFrame:
        """Split plan of one side."""
        t = self.tagged.filter(F.col("is_train") == F.lit(train))
        return t.select(
            F.lit("Slice1").alias("slice_id"),
            F.when(F.col("in_assessment"), F.lit("testing"))
             .otherwise(F.lit("training")).alias("split_key"),
            *TX_COLUMNS)

    @property
    def train_table(self) -> DataFrame:
        return self.tables.filter(F.col("is_train")).drop("is_train")

    @property
    def test_table(self) -> DataFrame:
        return self.tables.filter(~F.col("is_train")).drop("is_train")

    @property
    def all_table(self) -> DataFrame:
        """Train and test modelling rows."""
        return self.tables.drop("is_train")


def _money(c: Column, scale: int | None) -> Column:
    return c.cast(f"decimal(38,{scale})") if scale is not None else c.cast("double")


def prepare(tx: DataFrame, cohort_start: str | _dt.date, cohort_end: str | _dt.date,
            fraction: float = 0.8, seed: int = 123, assess: str | int | Period = "90 days",
            money_scale: int | None = DEFAULT_SCALE) -> Prepared:
    """Cohort, customer split, per-side time split and both modelling tables.

    Semantics are those of :func:`clvspark.operators.features.modelling_table`
    applied per side, with test recency measured from the *train* side's
    last training date (§1.4-4).

    Transactions are first reduced to one row per customer and day (count
    and exact spend; map-side partial aggregation before the shuffle). Every
    later join and aggregate works on those rows, so a customer holding a
    large share of all transactions contributes at most one row per
    calendar day to any task.
    """
    period = assess if isinstance(assess, Period) else parse_period(assess)
    # written once: ids, sides, tables and hot keys come from it, so the transactions are
    # read once for the tables, and once more only by the transaction-level views
    daily = materialize(tx.groupBy(KEY, "date").agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum(_money(F.col("price"), money_scale)).alias("_amount")))
    per_customer = daily.groupBy(KEY).agg(F.min("date").alias("first_date"),
                                          F.sum("_n").alias("_rows"))
    ids = filter_by_time(per_customer, "first_date", cohort_start, cohort_end).select(KEY)
    assignment = materialize(hash_split_flags(ids, KEY, fraction, seed, flag="is_train"))

    joined = daily.join(assignment, KEY)
    dates = joined.select("is_train", "date").distinct()
    per_side = (dates.groupBy("is_train").agg(F.max("date").alias("max_date"))
                     .withColumn("cutoff", period.subtract_from(F.col("max_date"))))
    train_part = F.when(F.col("is_train") & (F.col("date") <= F.col("cutoff")), F.col("date"))
    sides = (dates.join(F.broadcast(per_side), "is_train")          # <= 2 rows
                  .groupBy("is_train")
                  .agg(F.max("max_date").alias("max_date"), F.max("cutoff").alias("cutoff"),
                       F.max(train_part).alias("_ref"))
                  .withColumn("ref_date", F.max("_ref").over(Window.partitionBy(F.lit(1))))
                  .drop("_ref"))
    per_day = (joined.join(F.broadcast(sides), "is_train")           # <= 2 rows
                     .withColumn("in_assessment", F.col("date") > F.col("cutoff")))

    training = ~F.col("in_assessment")
    agg = per_day.groupBy(KEY, "is_train").agg(
        F.max(F.when(training, F.col("date"))).alias("_last"),
        F.max("ref_date").alias("_ref"),
        F.sum(F.when(training, F.col("_n"))).alias("frequency"),
        F.sum(F.when(training, F.col("_amount"))).cast("double").alias("price_sum"),
        F.sum(F.when(~training, F.col("_amount"))).cast("double").alias("_spend"),
        F.max(F.when(~training, F.lit(1))).alias("_flag"),
    )
    tables = agg.filter(F.col("frequency") > 0).select(
        KEY,
        F.datediff(F.col("_last"), F.col("_ref")).cast("double").alias("recency"),
        "frequency",
        "price_sum",
        (F.col("price_sum") / F.col("frequency").cast("double")).alias("price_mean"),
        F.coalesce(F.col("_spend"), F.lit(0.0)).alias("spend_90_total"),
        F.coalesce(F.col("_flag"), F.lit(0)).cast("double").alias("spend_90_flag"),
        "is_train",
    )
    assert tuple(tables.columns[1:5]) == FEATURES
    # transaction-level rows for the per-step views (cohort, splits, plan);
    # customers holding a large share of all rows are salted in the join
    hot = hot_keys(per_customer, KEY)
    tagged = (salted_join(tx, assignment, KEY, "inner", hot=hot)
                .join(F.broadcast(sides), "is_train")
                .withColumn("in_assessment", F.col("date") > F.col("cutoff"))
                .select(*TX_COLUMNS, "is_train", "in_assessment"))
    return Prepared(ids, assignment, tagged, sides, tables)
