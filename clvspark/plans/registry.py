"""Queries over the driver's test tables, one per operator (§7.2).

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame over the whole
tables. Column names equal those of the matching SQL in
:mod:`clvspark.plans.oracle`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clvspark.functions.dates import parse_ymd
from clvspark.operators import actions as ac
from clvspark.operators import cohort as co
from clvspark.operators import dashboard as db
from clvspark.operators import evaluate as ev
from clvspark.operators import features as fe
from clvspark.operators import models as mo
from clvspark.operators import newton_trees as nt
from clvspark.operators import smooth as sm
from clvspark.operators.clv import data as cd
from clvspark.operators.clv import models as cm
from clvspark.operators.timeseries import smooth_trend, summarize_by_time
from clvspark.plans.lifetime_value import prepare
from clvspark.session import materialize, scratch_path
from clvspark.sources import storage
from clvspark.sources import transactions as src

# Fixed parameters of the test-table queries (§7.2).
ORDERS_COHORT = ("1995-01", "1995-03")
ORDERS_ASSESS = "90 days"
EVENTS_COHORT = ("2024-01", "2024-01")
EVENTS_ASSESS = "7 days"
SPLIT_FRACTION = 0.8
SPLIT_SEED = 123
TOP = 15                 # rows of the top-k queries
SAMPLE_FRACTION = 0.05   # the dashboard slider's default
ORDERS_CLV_SPLIT = "2000-01-01"
EVENTS_CLV_SPLIT = "2024-01-20"


def orders_tx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return src.orders_transactions(spark, sf_dir)


def orders_prepared(spark: SparkSession, sf_dir: str):
    return prepare(orders_tx(spark, sf_dir), *ORDERS_COHORT, fraction=SPLIT_FRACTION,
                   seed=SPLIT_SEED, assess=ORDERS_ASSESS)


def events_prepared(spark: SparkSession, sf_dir: str):
    return prepare(src.event_transactions(spark, sf_dir), *EVENTS_COHORT,
                   fraction=SPLIT_FRACTION, seed=SPLIT_SEED, assess=EVENTS_ASSESS)


# --- S, F, G, N, O, T, U (priority 1) --------------------------------------

def q_transactions(spark, sf_dir):
    return src.orders_transactions(spark, sf_dir, quantity="lineitem")


def q_text_scan(spark, sf_dir):
    # Every order written by Spark as a blank-delimited text line (customer,
    # yyyymmdd date, quantity, price), then read back through the text source.
    o = src.read_table(spark, sf_dir, "orders")
    lines = o.select(F.concat_ws(
        "  ", F.format_string("%05d", F.col("o_custkey")),
        F.date_format(F.col("o_orderdate"), "yyyyMMdd"), F.lit("1"),
        F.col("o_totalprice").cast("string")).alias("value"))
    path = scratch_path(spark, "text")
    lines.write.mode("error").text(path)
    return src.read_transactions(spark, path, layout="whitespace")


def q_parse_dates(spark, sf_dir):
    # yyyymmdd numbers derived from every order; the day is pushed past the
    # month's end for part of them so impossible dates occur (-> NULL).
    o = src.read_table(spark, sf_dir, "orders")
    d = F.col("o_orderdate")
    raw = (F.year(d) * 10000 + F.month(d) * 100
           + F.dayofmonth(d) + F.when(F.dayofmonth(d) > 25, F.lit(5)).otherwise(F.lit(0)))
    return o.select("o_orderkey", raw.cast("bigint").alias("raw_date"),
                    parse_ymd(raw).alias("date"))


def q_drop_incomplete(spark, sf_dir):
    # orders without lineitems get a NULL quantity from the left join
    orders = src.read_table(spark, sf_dir, "orders")
    per_order = (src.read_table(spark, sf_dir, "lineitem").groupBy("l_orderkey")
                 .agg(F.sum("l_quantity").alias("o_quantity")))
    joined = orders.join(per_order, orders.o_orderkey == per_order.l_orderkey, "left")
    tx = src.transactions_from(joined, "o_custkey", "o_orderdate", "o_totalprice",
                               quantity="o_quantity", drop_missing=False)
    return src.drop_incomplete(tx)


def q_first_purchases(spark, sf_dir):
    return co.first_purchases(orders_tx(spark, sf_dir))


def q_date_range(spark, sf_dir):
    # the first dates alone: joining every row back to its first date would add nothing
    return co.date_range(co.first_purchase_dates(orders_tx(spark, sf_dir)), "first_date")


def q_filter_by_time(spark, sf_dir):
    return co.filter_by_time(orders_tx(spark, sf_dir), "date", *ORDERS_COHORT)


def q_cohort_ids(spark, sf_dir):
    return co.cohort_ids(orders_tx(spark, sf_dir), *ORDERS_COHORT)


def q_cohort_transactions(spark, sf_dir):
    return co.cohort(orders_tx(spark, sf_dir), *ORDERS_COHORT)


def q_monthly_totals(spark, sf_dir):
    return summarize_by_time(co.cohort(orders_tx(spark, sf_dir), *ORDERS_COHORT), "date", "month")


def q_smooth_trend(spark, sf_dir):
    monthly = summarize_by_time(co.cohort(orders_tx(spark, sf_dir), *ORDERS_COHORT), "date", "month")
    return smooth_trend(monthly, "date", "total_price", span=0.75, degree=2, digits=2)


def q_customer_histories(spark, sf_dir):
    return co.customer_histories(co.cohort(orders_tx(spark, sf_dir), *ORDERS_COHORT), 10)


def q_split_train_ids(spark, sf_dir):
    return orders_prepared(spark, sf_dir).train_ids


def q_split_test_transactions(spark, sf_dir):
    return orders_prepared(spark, sf_dir).side(train=False)


def q_time_split_train(spark, sf_dir):
    return orders_prepared(spark, sf_dir).part(train=True, assessment=False)


def q_time_split_assess(spark, sf_dir):
    return orders_prepared(spark, sf_dir).part(train=False, assessment=True)


def q_cv_plan(spark, sf_dir):
    return orders_prepared(spark, sf_dir).cv_plan(train=True)


def q_targets(spark, sf_dir):
    return fe.targets(orders_prepared(spark, sf_dir).part(train=True, assessment=True))


def q_rfm(spark, sf_dir):
    p = orders_prepared(spark, sf_dir)
    return fe.rfm(p.part(train=True, assessment=False), p.ref_date)


def q_train_table(spark, sf_dir):
    return orders_prepared(spark, sf_dir).train_table


def q_test_table(spark, sf_dir):
    return orders_prepared(spark, sf_dir).test_table


def q_all_customers(spark, sf_dir):
    return orders_prepared(spark, sf_dir).all_table


def q_event_rfm(spark, sf_dir):
    return events_prepared(spark, sf_dir).train_table


# --- scored customers ---------------------------------------------------------
# A boosted tree cannot be restated in SQL, so the metrics, action lists and
# dashboard tables are checked on a deterministic stand-in score (§2.2 note 1);
# the same functions take the model's predictions in `q_predictions`.

def standin_scores(table: DataFrame) -> DataFrame:
    """``pred_prob = frequency / (frequency + 10)``, ``pred_total = price_mean * pred_prob``."""
    freq = F.col("frequency").cast("double")
    prob = freq / (freq + F.lit(10.0))
    return table.select(
        (F.col("price_mean") * prob).alias("pred_total"), prob.alias("pred_prob"),
        "spend_90_total", "spend_90_flag", "customer_id", "recency", "frequency",
        "price_sum", "price_mean")


def standin_test(spark, sf_dir):
    return standin_scores(orders_prepared(spark, sf_dir).test_table)


def standin_all(spark, sf_dir):
    return standin_scores(orders_prepared(spark, sf_dir).all_table)


def dashboard_sample(spark, sf_dir):
    # the sample feeds several charts: write it once, read it back
    base = db.dashboard_base(standin_all(spark, sf_dir), with_text=False)
    return materialize(db.sample_fraction(base, SAMPLE_FRACTION, SPLIT_SEED))


def q_most_likely(spark, sf_dir):
    return ac.most_likely(standin_test(spark, sf_dir))


def q_recent_but_unlikely(spark, sf_dir):
    return ac.recent_but_unlikely(standin_test(spark, sf_dir))


def q_missed_opportunities(spark, sf_dir):
    return ac.missed_opportunities(standin_test(spark, sf_dir))


def q_spend_more(spark, sf_dir):
    return ac.spend_more_table(db.dashboard_base(standin_all(spark, sf_dir), with_text=False))


# the k first rows of each ranking: as sets they depend on the order

def q_most_likely_top(spark, sf_dir):
    return ac.most_likely(standin_test(spark, sf_dir), n=TOP)


def q_recent_but_unlikely_top(spark, sf_dir):
    # bounds at which the table has rows on both sides of each
    return ac.recent_but_unlikely(standin_all(spark, sf_dir), days=400, prob=0.6).limit(TOP)


def q_missed_opportunities_top(spark, sf_dir):
    return ac.missed_opportunities(standin_test(spark, sf_dir)).limit(TOP)


def q_spend_more_top(spark, sf_dir):
    return ac.spend_more_table(db.dashboard_base(standin_all(spark, sf_dir), with_text=False)).limit(TOP)


def q_prediction_round_trip(spark, sf_dir):
    # W1 then S4
    path = scratch_path(spark, "predictions")
    storage.write_predictions(standin_test(spark, sf_dir), path)
    return storage.read_predictions(spark, path)


def q_action_csv_round_trip(spark, sf_dir):
    # W4, read back with the schema that was written
    path = scratch_path(spark, "actions")
    table = q_spend_more(spark, sf_dir)
    storage.export_actions_csv(table, path)
    return spark.read.schema(table.schema).option("header", True).csv(path)


def q_text_scan_positional(spark, sf_dir):
    # the blank-padded layout: customer, date, quantity and price are fields 2, 3, 5 and 8
    o = src.read_table(spark, sf_dir, "orders")
    lines = o.select(F.concat(
        F.lit(" "), F.format_string("%05d", F.col("o_custkey")), F.lit(" "),
        F.date_format(F.col("o_orderdate"), "yyyyMMdd"), F.lit("  1   "),
        F.col("o_totalprice").cast("string")).alias("value"))
    path = scratch_path(spark, "text")
    lines.write.mode("error").text(path)
    return src.read_transactions(spark, path, layout="positional")


def q_mae(spark, sf_dir):
    return ev.mae(standin_test(spark, sf_dir))


def q_roc_auc(spark, sf_dir):
    return ev.roc_auc(standin_test(spark, sf_dir))


def q_roc_curve(spark, sf_dir):
    return ev.roc_curve(standin_test(spark, sf_dir))


def q_dashboard_base(spark, sf_dir):
    return db.dashboard_base(standin_all(spark, sf_dir), with_text=False)


def q_dashboard_text(spark, sf_dir):
    return db.dashboard_base(standin_all(spark, sf_dir), with_text=True)


def q_sample_fraction(spark, sf_dir):
    return dashboard_sample(spark, sf_dir)


def q_features_long(spark, sf_dir):
    return db.features_long(dashboard_sample(spark, sf_dir))


def q_scaled_features(spark, sf_dir):
    return db.scaled_features(dashboard_sample(spark, sf_dir))


def q_probability_by_frequency(spark, sf_dir):
    return db.probability_by_frequency(dashboard_sample(spark, sf_dir))


def q_feature_distribution(spark, sf_dir):
    return db.feature_distribution(db.scaled_features(dashboard_sample(spark, sf_dir)))


def q_feature_quantiles(spark, sf_dir):
    return db.feature_quantiles(db.scaled_features(dashboard_sample(spark, sf_dir)))


# the smoothed curve, the violin and the trend by vertices
SMOOTH_SEGMENTS = 5
SMOOTH_PENALTY = 2.0
DENSITY_POINTS = 128


def q_probability_smooth(spark, sf_dir):
    out = sm.probability_smooth(standin_all(spark, sf_dir), SMOOTH_SEGMENTS, SMOOTH_PENALTY)
    return out.select("frequency", "customers", F.round("prob_smooth", 6).alias("prob_smooth"))


def q_probability_smooth_gcv(spark, sf_dir):
    # the penalty is chosen from the data
    return sm.probability_smooth(dashboard_sample(spark, sf_dir))


def q_feature_density(spark, sf_dir):
    out = sm.density(db.scaled_features(dashboard_sample(spark, sf_dir)), "feature", "value_scaled", DENSITY_POINTS)
    return out.select("feature", F.round("at", 6).alias("at"), F.round("density", 6).alias("density"))


def q_smooth_trend_vertices(spark, sf_dir):
    monthly = summarize_by_time(co.cohort(orders_tx(spark, sf_dir), *ORDERS_COHORT), "date", "month")
    return sm.smooth_by_vertices(monthly, "date", "total_price", span=0.75, digits=1)


def q_features_text(spark, sf_dir):
    # The long table's tooltips with values rounded half to even
    return db.scaled_features(dashboard_sample(spark, sf_dir), with_text=True)


# --- models (rows-only checks) ----------------------------------------------

def q_predictions(spark, sf_dir):
    p = orders_prepared(spark, sf_dir)
    models = mo.fit_models(p.train_table)
    return mo.score(models, p.test_table)


def q_predictions_all(spark, sf_dir):
    p = orders_prepared(spark, sf_dir)
    models = mo.fit_models(p.train_table)
    return mo.score(models, p.all_table)


def q_importance(spark, sf_dir):
    p = orders_prepared(spark, sf_dir)
    models = mo.fit_models(p.train_table)
    return mo.importance(models.prob, spark).withColumn("model", F.lit("spend_prob")).unionByName(
        mo.importance(models.total, spark).withColumn("model", F.lit("spend_total")))


# Newton trees. A whole fit is iterative, but one shallow tree can be restated in SQL, and so can
# scoring by given trees; those queries end in `_fixed` or work on the one tree.
STUMP = dict(trees=1, depth=2, bins=16)
GAIN_UNIT = 1e6     # gains are sums of squares of money: printed in millions


def q_newton_predictions(spark, sf_dir):
    p = orders_prepared(spark, sf_dir)
    return nt.score_newton(nt.fit_newton_models(p.train_table), p.test_table)


def stump(spark, sf_dir):
    train = orders_prepared(spark, sf_dir).train_table
    return nt.fit_newton_trees(train, "spend_90_total", list(nt.FEATURES), **STUMP)


def q_newton_stump_fixed(spark, sf_dir):
    return nt.node_table(stump(spark, sf_dir), spark).select(
        "node", "feature", "threshold", F.round(F.col("gain") / GAIN_UNIT, 3).alias("gain"), "cover",
        F.round("weight", 5).alias("weight"))


def q_gain_importance(spark, sf_dir):
    # E4 of the fitted tree, through the importance sink
    path = scratch_path(spark, "importance")
    storage.write_importance(nt.gain_importance(nt.node_table(stump(spark, sf_dir), spark)), path)
    return spark.read.parquet(path).select("feature", F.round(F.col("gain") / GAIN_UNIT, 3).alias("gain"), "cover", "splits")


def _given(feature, threshold, left, right, missing_left=True):
    """A split for ``_tree``; ``left`` and ``right`` are leaf weights or splits."""
    return feature, threshold, missing_left, left, right


def _tree(split, at=0):
    if isinstance(split, float):
        return {at: nt.Node(weight=split)}
    feature, threshold, missing_left, left, right = split
    return {at: nt.Node(feature, threshold, missing_left, 1.0, 1.0)} | _tree(left, 2 * at + 1) | _tree(right, 2 * at + 2)


# Stand-in trees for checking the scoring: their thresholds divide the test tables.
FIXED_TREES = nt.NewtonModels(
    nt.TreeEnsemble("squared", 0.5, [
        _tree(_given("price_mean", 250000.0, _given("frequency", 11.0, 31000.5, 48000.25),
                     _given("recency", -200.0, 12500.0, 60125.75, missing_left=False))),
        _tree(_given("price_sum", 3000000.0, -1250.5, _given("price_mean", 275000.0, 2200.25, 9100.0)))]),
    nt.TreeEnsemble("logistic", 0.0, [
        _tree(_given("recency", -90.0, _given("recency", -400.0, -0.9, -0.25), _given("frequency", 12.0, 0.1, 0.55))),
        _tree(_given("frequency", 9.0, -0.2, _given("price_sum", 3500000.0, 0.05, 0.3))),
        _tree(0.0125)]))


def q_predictions_fixed(spark, sf_dir):
    return _rounded_scores(nt.score_newton(FIXED_TREES, orders_prepared(spark, sf_dir).test_table))


def _rounded_scores(scored):
    return scored.select(F.round("pred_total", 6).alias("pred_total"), F.round("pred_prob", 9).alias("pred_prob"), *scored.columns[2:])


def q_model_round_trip(spark, sf_dir):
    # Both models as node tables, written, read, rebuilt, and used on all customers
    loaded = []
    for model in (FIXED_TREES.total, FIXED_TREES.prob):
        path = scratch_path(spark, "model")
        nt.save_ensemble(model, path, spark)
        loaded.append(nt.load_ensemble(spark, path))
    return _rounded_scores(nt.score_newton(nt.NewtonModels(*loaded), orders_prepared(spark, sf_dir).all_table))


def q_feature_list(spark, sf_dir):
    # per model the columns left as features, unpivoted over the training rows
    train = orders_prepared(spark, sf_dir).train_table
    found = []
    for label, other in (("spend_90_total", "spend_90_flag"), ("spend_90_flag", "spend_90_total")):
        names = mo.feature_columns(train, label, (other, "customer_id"))
        long = train.select(*[F.col(c).cast("double").alias(c) for c in names]).unpivot([], names, "feature", "value")
        found.append(long.groupBy("feature").agg(F.count("value").alias("rows"), F.min("value").alias("least"),
                                                 F.max("value").alias("most")).withColumn("label", F.lit(label)))
    return found[0].unionByName(found[1])


# --- probabilistic CLV ------------------------------------------------------

def orders_clv(spark, sf_dir):
    tx = orders_tx(spark, sf_dir)
    return cd.clv_data(tx, ORDERS_CLV_SPLIT, customers=co.cohort_ids(tx, *ORDERS_COHORT))


def q_clv_statistics(spark, sf_dir):
    return orders_clv(spark, sf_dir).stats


def q_clv_summary(spark, sf_dir):
    return cd.clv_summary(orders_clv(spark, sf_dir))


def q_tracking_actual(spark, sf_dir):
    return cm.tracking(None, orders_clv(spark, sf_dir), actual_only=True)


def q_tracking_actual_weekly(spark, sf_dir):
    tx = orders_tx(spark, sf_dir)
    data = cd.clv_data(tx, ORDERS_CLV_SPLIT, unit="week", customers=co.cohort_ids(tx, *ORDERS_COHORT))
    return cm.tracking(None, data, actual_only=True)


def q_pnbd_coefficients(spark, sf_dir):
    return cm.fit_pnbd(orders_clv(spark, sf_dir)).summary(spark)


def q_pnbd_predictions(spark, sf_dir):
    data = orders_clv(spark, sf_dir)
    pnbd, gg = cm.fit_both(data)
    return cm.predict_pnbd(pnbd, data, gg)


def q_tracking_expected(spark, sf_dir):
    data = orders_clv(spark, sf_dir)
    return cm.tracking(cm.fit_pnbd(data), data).filter(F.col("variable") == "pnbd")


def q_fit_statistics(spark, sf_dir):
    # V4 for both models, with whether each fit can be trusted
    fits = zip(("pnbd", "gamma_gamma"), cm.fit_both(orders_clv(spark, sf_dir)))
    first, second = (fit.fit_statistics(spark).withColumn("model", F.lit(name)) for name, fit in fits)
    return first.unionByName(second)


def q_gg_coefficients(spark, sf_dir):
    return cm.fit_gamma_gamma(orders_clv(spark, sf_dir)).summary(spark)


def q_spending_predictions(spark, sf_dir):
    data = orders_clv(spark, sf_dir)
    return cm.predict_spending(cm.fit_gamma_gamma(data), data)


def q_spending_density(spark, sf_dir):
    data = orders_clv(spark, sf_dir)
    return cm.spending_density(cm.fit_gamma_gamma(data), data)


# Stand-in parameters for checking the scoring operators against SQL: the
# fitted values come from an iterative optimiser SQL cannot restate, so the
# scoring (quadrature, closed forms, log-gamma terms) is checked at fixed
# parameters on the real statistics. Pareto/NBD r, alpha, s, beta in days;
# Gamma/Gamma p, q, gamma.
FIXED_PNBD = (0.6, 70.0, 0.65, 84.0)
FIXED_GG = (6.0, 3.8, 15.0)
SCORE_DIGITS = {"p_alive": 9, "cet": 9, "dert": 7, "predicted_mean_spending": 6,
                "predicted_clv": 3}


DENSITY_UNIT = 1e6    # densities are printed per million of money


def _fixed_pnbd():
    return cm.fixed_model(cm.PNBD_PARAMS, FIXED_PNBD)


def _fixed_gg():
    return cm.fixed_model(cm.GG_PARAMS, FIXED_GG)


def q_pnbd_scores_fixed(spark, sf_dir):
    data = orders_clv(spark, sf_dir)
    out = cm.predict_pnbd(_fixed_pnbd(), data, _fixed_gg())
    return out.select(*[F.round(c, SCORE_DIGITS[c]).alias(c) if c in SCORE_DIGITS else c
                        for c in out.columns])


def q_pnbd_loglik_fixed(spark, sf_dir):
    out = cm.loglik_table(_fixed_pnbd(), orders_clv(spark, sf_dir).stats, "pnbd")
    return out.select(F.round("loglik", 4).alias("loglik"), "customers")


def q_gg_loglik_fixed(spark, sf_dir):
    out = cm.loglik_table(_fixed_gg(), cm.gg_input(orders_clv(spark, sf_dir)), "gg")
    return out.select(F.round("loglik", 4).alias("loglik"), "customers")


def q_pnbd_gradient_fixed(spark, sf_dir):
    out = cm.gradient_table(_fixed_pnbd(), orders_clv(spark, sf_dir).stats, "pnbd")
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


def q_pnbd_information_fixed(spark, sf_dir):
    out = cm.information_table(_fixed_pnbd(), orders_clv(spark, sf_dir).stats, "pnbd")
    return out.withColumn("value", F.round("value", 4))


def q_gg_gradient_fixed(spark, sf_dir):
    out = cm.gradient_table(_fixed_gg(), cm.gg_input(orders_clv(spark, sf_dir)), "gg")
    return out.select(*[F.round(c, 4).alias(c) for c in out.columns])


def q_spending_density_fixed(spark, sf_dir):
    out = cm.spending_density(_fixed_gg(), orders_clv(spark, sf_dir))
    return out.select("bin", "customers", *[F.round(c, 4).alias(c) for c in ("bin_start", "bin_end")],
                      *[F.round(F.col(c) * DENSITY_UNIT, 9).alias(c) for c in ("actual_density", "model_density")])


def q_spending_fixed(spark, sf_dir):
    out = cm.predict_spending(_fixed_gg(), orders_clv(spark, sf_dir))
    return out.select("customer_id", "actual_mean_spending",
                      F.round("predicted_mean_spending", 6).alias("predicted_mean_spending"))


def q_spending_fixed_repeat(spark, sf_dir):
    # the library default of the prediction call: spend of repeat purchases only
    model = cm.fixed_model(cm.GG_PARAMS, FIXED_GG)
    model.extra["remove_first"] = True
    out = cm.predict_spending(model, orders_clv(spark, sf_dir))
    return out.select("customer_id", F.round("actual_mean_spending", 6).alias("actual_mean_spending"),
                      F.round("predicted_mean_spending", 6).alias("predicted_mean_spending"))


def q_tracking_expected_fixed(spark, sf_dir):
    out = cm.tracking(_fixed_pnbd(), orders_clv(spark, sf_dir)).filter(F.col("variable") == "pnbd")
    return out.select("period_until", "variable", F.round("value", 9).alias("value"))


def q_event_clv_statistics(spark, sf_dir):
    tx = src.event_transactions(spark, sf_dir)
    return cd.clv_data(tx, EVENTS_CLV_SPLIT, customers=co.cohort_ids(tx, *EVENTS_COHORT)).stats


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "transactions": q_transactions,
    "text_scan": q_text_scan,
    "parse_dates": q_parse_dates,
    "drop_incomplete": q_drop_incomplete,
    "first_purchases": q_first_purchases,
    "date_range": q_date_range,
    "filter_by_time": q_filter_by_time,
    "cohort_ids": q_cohort_ids,
    "cohort_transactions": q_cohort_transactions,
    "monthly_totals": q_monthly_totals,
    "smooth_trend": q_smooth_trend,
    "customer_histories": q_customer_histories,
    "split_train_ids": q_split_train_ids,
    "split_test_transactions": q_split_test_transactions,
    "time_split_train": q_time_split_train,
    "time_split_assess": q_time_split_assess,
    "cv_plan": q_cv_plan,
    "targets": q_targets,
    "rfm": q_rfm,
    "train_table": q_train_table,
    "test_table": q_test_table,
    "all_customers": q_all_customers,
    "event_rfm": q_event_rfm,
    "most_likely": q_most_likely,
    "recent_but_unlikely": q_recent_but_unlikely,
    "missed_opportunities": q_missed_opportunities,
    "spend_more": q_spend_more,
    "most_likely_top": q_most_likely_top,
    "recent_but_unlikely_top": q_recent_but_unlikely_top,
    "missed_opportunities_top": q_missed_opportunities_top,
    "spend_more_top": q_spend_more_top,
    "prediction_round_trip": q_prediction_round_trip,
    "action_csv_round_trip": q_action_csv_round_trip,
    "text_scan_positional": q_text_scan_positional,
    "mae": q_mae,
    "roc_auc": q_roc_auc,
    "roc_curve": q_roc_curve,
    "dashboard_base": q_dashboard_base,
    "dashboard_text": q_dashboard_text,
    "sample_fraction": q_sample_fraction,
    "features_long": q_features_long,
    "scaled_features": q_scaled_features,
    "probability_by_frequency": q_probability_by_frequency,
    "feature_distribution": q_feature_distribution,
    "feature_quantiles": q_feature_quantiles,
    "probability_smooth": q_probability_smooth,
    "probability_smooth_gcv": q_probability_smooth_gcv,
    "feature_density": q_feature_density,
    "smooth_trend_vertices": q_smooth_trend_vertices,
    "features_text": q_features_text,
    "predictions": q_predictions,
    "predictions_all": q_predictions_all,
    "importance": q_importance,
    "newton_predictions": q_newton_predictions,
    "newton_stump_fixed": q_newton_stump_fixed,
    "gain_importance": q_gain_importance,
    "predictions_fixed": q_predictions_fixed,
    "model_round_trip": q_model_round_trip,
    "feature_list": q_feature_list,
    "clv_statistics": q_clv_statistics,
    "clv_summary": q_clv_summary,
    "tracking_actual": q_tracking_actual,
    "tracking_actual_weekly": q_tracking_actual_weekly,
    "event_clv_statistics": q_event_clv_statistics,
    "pnbd_coefficients": q_pnbd_coefficients,
    "pnbd_predictions": q_pnbd_predictions,
    "tracking_expected": q_tracking_expected,
    "fit_statistics": q_fit_statistics,
    "gg_coefficients": q_gg_coefficients,
    "spending_predictions": q_spending_predictions,
    "spending_density": q_spending_density,
    "pnbd_scores_fixed": q_pnbd_scores_fixed,
    "pnbd_loglik_fixed": q_pnbd_loglik_fixed,
    "pnbd_gradient_fixed": q_pnbd_gradient_fixed,
    "pnbd_information_fixed": q_pnbd_information_fixed,
    "gg_gradient_fixed": q_gg_gradient_fixed,
    "spending_density_fixed": q_spending_density_fixed,
    "gg_loglik_fixed": q_gg_loglik_fixed,
    "spending_fixed": q_spending_fixed,
    "spending_fixed_repeat": q_spending_fixed_repeat,
    "tracking_expected_fixed": q_tracking_expected_fixed,
}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flagship query of ``entry()``: test customers scored by both models."""
    return q_predictions(spark, sf_dir)
