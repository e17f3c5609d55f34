"""Command line: run a workflow and write its tables as parquet.

    spark-submit --py-files clvspark.zip -m clvspark spend \\
        --input /data/purchases.txt --cohort 1997-01 1997-03 --output /data/run1
    python -m clvspark clv --input /data/purchases.txt --cohort 1997-01 1997-03 \\
        --estimation-end 1998-01-01 --output /data/run1
    python -m clvspark dashboard --predictions /data/run1/predictions --output /data/run1

``--input`` is blank-delimited text (``--layout``) or, with ``--parquet``, a
table whose columns are named by ``--columns id date price``.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from clvspark.plans import analyses
from clvspark.session import ensure_checkpoint_dir, scratch_tables
from clvspark.sources import storage
from clvspark.sources.transactions import read_transactions, transactions_from


def _transactions(spark: SparkSession, args) -> DataFrame:
    if args.parquet:
        cid, date, price = args.columns
        return transactions_from(spark.read.parquet(args.input), cid, date, price)
    return read_transactions(spark, args.input, layout=args.layout)


def _write(tables: dict[str, DataFrame], output: str) -> None:
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{output.rstrip('/')}/{name}")


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="clvspark")
    sub = parser.add_subparsers(dest="command", required=True)
    for name in ("spend", "clv"):
        p = sub.add_parser(name)
        p.add_argument("--input", required=True)
        p.add_argument("--parquet", action="store_true")
        p.add_argument("--columns", nargs=3, default=("customer_id", "date", "price"))
        p.add_argument("--layout", default="whitespace", choices=("whitespace", "positional"))
        p.add_argument("--cohort", nargs=2, required=True, metavar=("START", "END"))
        p.add_argument("--output", required=True)
    sub.choices["spend"].add_argument("--fraction", type=float, default=0.8)
    sub.choices["spend"].add_argument("--seed", type=int, default=123)
    sub.choices["spend"].add_argument("--assess", default="90 days")
    sub.choices["clv"].add_argument("--estimation-end", required=True)
    sub.choices["clv"].add_argument("--unit", default="day", choices=("day", "week"))
    dash = sub.add_parser("dashboard")
    dash.add_argument("--predictions", required=True)
    dash.add_argument("--fraction", type=float, default=0.05)
    dash.add_argument("--output", required=True)
    args = parser.parse_args(argv)

    spark = SparkSession.builder.appName(f"clvspark-{args.command}").getOrCreate()
    ensure_checkpoint_dir(spark)
    with scratch_tables(spark):   # everything is written out below, so the scratch can go
        _run(spark, args)


def _run(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.command == "spend":
        run = analyses.spend_analysis(_transactions(spark, args), *args.cohort,
                                      fraction=args.fraction, seed=args.seed,
                                      assess=args.assess, output=args.output)
        _write({"test_predictions": run.test_predictions, "mae": run.mae,
                "roc_auc": run.roc_auc, "roc_curve": run.roc_curve,
                "most_likely": run.most_likely, "recent_but_unlikely": run.recent_but_unlikely,
                "missed_opportunities": run.missed_opportunities}, args.output)
    elif args.command == "clv":
        run = analyses.clv_analysis(_transactions(spark, args), *args.cohort,
                                    args.estimation_end, unit=args.unit)
        _write({"clv_statistics": run.data.stats, "clv_summary": run.summary,
                "pnbd_coefficients": run.pnbd.summary(spark),
                "pnbd_fit": run.pnbd.fit_statistics(spark),
                "gg_coefficients": run.gamma_gamma.summary(spark),
                "clv_predictions": run.predictions, "tracking": run.tracking,
                "spending": run.spending, "spending_density": run.spending_density},
               args.output)
    else:
        board = analyses.dashboard_tables(storage.read_predictions(spark, args.predictions),
                                          fraction=args.fraction)
        _write({"dashboard_base": board.base, "dashboard_sample": board.sample,
                "probability_by_frequency": board.probability_by_frequency,
                "features": board.features, "feature_distribution": board.feature_distribution,
                "feature_quantiles": board.feature_quantiles}, args.output)
        storage.export_actions_csv(board.actions, f"{args.output.rstrip('/')}/actions_csv")


if __name__ == "__main__":
    main()
