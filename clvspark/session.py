"""Session helpers for tests, the bench and the CLI-style entry points.

Library functions never build a session; these helpers exist for callers
that own one (tests, ``bench.py``, ``__spark_entry__.py``).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings that matter for correctness of comparisons with SQL engines.
_FIXED = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
}

# Settings for runtime re-planning: AQE coalesces the (over-provisioned)
# shuffle partitions, converts small joins to broadcast from measured sizes
# and splits skewed join partitions.
_ADAPTIVE = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = 8, shuffle_partitions: int | None = None,
                  app_name: str = "clvspark") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("CLVSPARK_DRIVER_MEMORY", "8g"))
        .config("spark.sql.shuffle.partitions",
                str(shuffle_partitions or (cores if isinstance(cores, int) else 8)))
    )
    for key, value in {**_FIXED, **_ADAPTIVE}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used
    as is. Only a local-mode session without it (tests) gets a fresh
    scratch folder; a cluster session without one is an error, because a
    machine-local folder does not survive the loss of an executor.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if not re.match(r"local(\[|$)", sc.master):   # local-cluster has executors of its own
        raise RuntimeError(
            "spark.checkpoint.dir is not set; shared intermediate tables are "
            "written under it and need a shared folder")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="clvspark-ckpt-"))
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder name under the checkpoint folder (shared storage on a cluster)."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/{name}/{uuid.uuid4().hex}"
    for owned in _owners:
        owned.append(path)
    return path


_owners: list[list[str]] = []


@contextmanager
def scratch_tables(spark: SparkSession):
    """Removes the scratch tables made inside the block when it ends.

    For callers that write their results: what is still to be read from a
    scratch table has to be written inside the block.
    """
    owned: list[str] = []
    _owners.append(owned)
    try:
        yield owned
    finally:
        _owners.remove(owned)
        jvm = spark.sparkContext._jvm
        for path in owned:
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df, compression: str | None = None):
    """Write ``df`` as a parquet table under the checkpoint folder and read it back.

    Used for much-reused intermediate tables (the customer split, the
    modelling rows, CLV statistics): the lineage is cut, a lost executor
    re-reads the table instead of recomputing its inputs, the plan runs
    once (with AQE's partition coalescing), and the read-back is split by
    ``spark.sql.files.maxPartitionBytes``, so partitions follow the data's
    size, not a fixed count. ``compression`` is the Parquet codec, the
    session's if not given; whole texts take a third less with ``zstd``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "tables")
    df.write.mode("error").parquet(path, compression=compression)
    return spark.read.schema(df.schema).parquet(path)
