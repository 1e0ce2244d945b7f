"""Session settings and the shared scratch folder.

Operators never depend on session confs; ``build_session`` only pins the
settings our tests and the bench run with. Writes that cut lineage (snapshot
tables, stream sinks, checkpoints) go below the folder the cluster names in
``spark.checkpoint.dir``; a folder of our own is set only when it is unset.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Session settings recorded in the reference: 50 MB broadcast threshold and
# the Parquet rebase modes for files written by other engines.
BROADCAST_THRESHOLD_BYTES = 50 * 1024 * 1024

_REBASE_CONFS = {
    "spark.sql.legacy.parquet.nanosAsLong": "true",  # files with nanosecond timestamps read as longs
    "spark.sql.parquet.int96RebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.int96RebaseModeInWrite": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
}


def build_session(
    master: str = "local[*]",
    app_name: str = "strata",
    shuffle_partitions: int = 8,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = (
        SparkSession.builder.master(master)
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.autoBroadcastJoinThreshold", str(BROADCAST_THRESHOLD_BYTES))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("STRATA_DRIVER_MEMORY", "16g"))
    )
    for key, value in {**_REBASE_CONFS, **(extra or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    scratch_dir(spark)
    return spark


def _checkpoint_root(spark: SparkSession) -> str:
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        # Unset: only in tests and local runs. Take a fresh folder of our own.
        master = spark.sparkContext.master
        if not re.match(r"local(\[|$)", master):
            raise ValueError(f"spark.checkpoint.dir must name a shared folder on master {master}")
        root = tempfile.mkdtemp(prefix="strata-ckpt-")
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Make ``DataFrame.checkpoint()`` usable: the cluster's folder when set."""
    return _checkpoint_root(spark)


_RUNS: list[str] = []  # roots of the scratch runs that are open, the innermost last


def scratch_dir(spark: SparkSession, name: str | None = None) -> str:
    """A fresh folder below the shared checkpoint folder, one per use; inside a
    ``scratch_run``, below its folder."""
    root = _RUNS[-1] if _RUNS else f"{_checkpoint_root(spark)}/strata"
    return root if name is None else f"{root}/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def scratch_run(spark: SparkSession, name: str = "run") -> Iterator[str]:
    """One folder for all scratch tables written inside, removed at the end.

    DataFrames that operators return may still read scratch tables: write or
    collect the results inside. Runs may be nested.
    """
    root = f"{_checkpoint_root(spark)}/strata/{name}-{uuid.uuid4().hex[:12]}"
    _RUNS.append(root)
    try:
        yield root
    finally:
        _RUNS.remove(root)
        folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
        folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


_FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Inside, a query's shuffle files go when it ends, on all executors; otherwise
    they stay until the driver happens to collect its garbage, and the disk of a job
    is the sum of its steps. The session's setting is put back; streams that start
    inside keep it. A result that is read again is computed again."""
    before = spark.conf.get(_FREED)
    spark.conf.set(_FREED, "true")
    try:
        yield
    finally:
        spark.conf.set(_FREED, before)
