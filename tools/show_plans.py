"""Print the physical plans of the main flows (tree + scan details).

    python tools/show_plans.py [sf_dir] > docs/PLANS.md

Broadcasts that depend on measured sizes are switched off
(``autoBroadcastJoinThreshold=-1``) to show the plan a large input gets;
broadcasts of tables bounded by construction are explicit hints and stay.
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clvspark.operators import evaluate as ev  # noqa: E402
from clvspark.operators.cohort import cohort  # noqa: E402
from clvspark.operators.clv import data as cd  # noqa: E402
from clvspark.operators.sampling import hash_split_flags  # noqa: E402
from clvspark.operators.cohort import cohort_ids  # noqa: E402
from clvspark.plans import registry as reg  # noqa: E402
from clvspark.session import local_session  # noqa: E402


def tree_and_scans(df) -> str:
    text = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
    tree, _, details = text.partition("\n\n\n")
    scans = []
    for block in details.split("\n\n"):
        if block.lstrip().startswith("(") and "Scan parquet" in block.splitlines()[0]:
            keep = [ln for ln in block.splitlines()
                    if ln.startswith(("(", "PushedFilters", "ReadSchema", "DataFilters"))]
            scans.append("\n".join(keep))
    tree = re.sub(r"#\d+", "", tree)
    return tree.strip() + "\n\n" + "\n\n".join(scans)


def main() -> None:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session(8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tx = reg.orders_tx(spark, sf_dir)
    print("# Physical plans\n")
    print("Generated by `tools/show_plans.py` at", sf_dir, "with size-based broadcasts off.")
    print("These are the plans before execution: subtrees that occur twice (a union's")
    print("branches, a scalar's source) run once, through exchange reuse.\n")

    def show(title, df, note=""):
        print(f"## {title}\n\n{note}\n\n```\n{tree_and_scans(df)}\n```\n")

    show("cohort transactions (G8): aggregate, filter, salted semi join",
         cohort(tx, *reg.ORDERS_COHORT),
         "Three columns read, NOT NULL filters pushed to the scan; one partial aggregate gives "
         "first purchase and row count per customer; hot customers (bounded table, broadcast) "
         "give their rows a salt, and the semi join runs on (customer_id, salt) with a single "
         "scan of the transactions.")
    show("exact customer draw (F3): bucket counts broadcast by bucket id",
         hash_split_flags(cohort_ids(tx, *reg.ORDERS_COHORT), "customer_id", 0.8, 123,
                          flag="is_train"),
         "No global sort: the per-bucket counts (at most 65,536 rows) are broadcast and "
         "joined on the bucket id; only the boundary bucket is ordered (the second branch).")
    p = reg.orders_prepared(spark, sf_dir)
    show("modelling tables (T1, G3-G5, J1, F9, F11): one aggregate per customer and side",
         p._tables_plan,
         "Partial aggregate per (customer, day) before the first shuffle; the sort-merge join "
         "with the materialized split (a parquet scan) shuffles those reduced rows on "
         "customer_id, and the final per-customer aggregate reuses that partitioning (no "
         "exchange above the join). Side cutoffs: a broadcast of at most two rows.")
    show("ROC AUC (E2): bucketed prefix sums over the materialized test table",
         ev.roc_auc(reg.standin_scores(p.test_table)),
         "One row per distinct score; the window is partitioned by score bucket, the bucket "
         "offsets (one row per bucket) are broadcast. No window without a partition over "
         "the data.")
    data = cd.clv_data(cohort(tx, *reg.ORDERS_COHORT), reg.ORDERS_CLV_SPLIT, materialized=False)
    show("CLV statistics (V1): two partial aggregations", data.stats,
         "Same-day merge and per-customer statistics are both partial aggregations.")
    import numpy as np
    from clvspark.operators.clv import kernels
    from clvspark.operators.clv import models as cm
    show("one Pareto/NBD likelihood pass (V3): K parameter vectors per pass",
         cm.loglik_sums(data.stats, kernels.pnbd_loglik, ("x", "t_x", "T_cal"), np.ones((9, 4))),
         "Arrow batches into numpy (MapInPandas), one partial sum per vector and task, then a "
         "K-row aggregate: nothing per customer leaves the executors. (Shown over the full "
         "lineage; in a fit the input is the cached, row-spread working copy.)")
    spark.stop()


if __name__ == "__main__":
    main()
