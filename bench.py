"""Benchmark the headline queries; print one JSON line.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Each query is built and executed in full through Spark's ``noop`` sink
(every row computed, nothing collected). ``pnbd_pass`` is one distributed
Pareto/NBD likelihood pass (9 parameter vectors, the cost of one gradient
step); ``pnbd_fit`` the whole fit; ``clv_fits_and_scores`` both CLV fits
(run concurrently) and P(alive)/CET/DERT/CLV for every customer, from the
parquet files.
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np  # noqa: E402

from clvspark.operators.clv import kernels  # noqa: E402
from clvspark.operators.clv import models as cm  # noqa: E402
from clvspark.plans import registry as reg  # noqa: E402
from clvspark.session import local_session  # noqa: E402

HEADLINE = (
    "cohort_transactions", "monthly_totals", "split_train_ids", "train_table", "test_table",
    "event_rfm", "roc_auc", "roc_curve", "spend_more", "scaled_features", "clv_statistics",
    "clv_summary", "tracking_actual", "predictions",
)


def _run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cpus)
    # warm the JVM and the Python workers once
    _run(reg.QUERIES["cohort_ids"](spark, sf_dir))

    times: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.perf_counter()
        _run(reg.QUERIES[name](spark, sf_dir))
        times[name] = round(time.perf_counter() - t0, 3)

    data = reg.orders_clv(spark, sf_dir)
    points = np.exp(np.log(np.ones((9, 4))) + np.vstack([np.zeros(4), np.eye(4) * 1e-5,
                                                          -np.eye(4) * 1e-5]))
    t0 = time.perf_counter()
    cm.batched_loglik(data.stats, kernels.pnbd_loglik, ("x", "t_x", "T_cal"), points)
    times["pnbd_pass"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    cm.fit_pnbd(data)
    times["pnbd_fit"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    _run(reg.QUERIES["pnbd_predictions"](spark, sf_dir))
    times["clv_fits_and_scores"] = round(time.perf_counter() - t0, 3)

    m = re.search(r"sf([0-9.]+)$", sf_dir)
    print(json.dumps({
        "metric": "total_seconds_headline_queries",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(m.group(1)) if m else sf_dir,
        "cpus": cpus,
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
