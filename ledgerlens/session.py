"""Session and checkpoint-directory helpers.

Operators never create their own session: they take the session of the
DataFrame they are given.  ``get_spark`` is for scripts and tests only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

ROWS_PER_TASK = 1_000_000   # of a table that a learner keeps in memory
LEAST_ROWS = 10_000         # fewer aren't worth a task of their own

# Spark removes an execution's shuffle files when the execution ends, not when a
# garbage collection on the driver happens to find its plan
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def get_spark(app: str = "ledgerlens", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Session with AQE on, UI off and UTC timestamps (tests, bench, CLI)."""
    master = master or os.environ.get("LEDGERLENS_MASTER", "local[8]")
    builder = (
        SparkSession.builder.master(master)
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERLENS_DRIVER_MEMORY", "8g"))
    )
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of this session.

    The cluster names a shared folder in ``spark.checkpoint.dir``; we use it.
    Only when it is unset *and* Spark runs in local mode (tests, bench) do we
    create our own scratch folder.  On a cluster an unset directory is an
    error: a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir()
    if sc.master == "local" or sc.master.startswith("local["):
        path = tempfile.mkdtemp(prefix="ledgerlens-ckpt-", dir="/tmp")
        sc.setCheckpointDir(path)
        return sc.getCheckpointDir()
    raise RuntimeError(
        "spark.checkpoint.dir is not set; point it at a shared folder "
        "(HDFS/S3/ABFS) so lineage cuts survive executor loss")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint into the session's checkpoint directory (eager: the
    plan runs once and its rows are written; the result reads only the files)."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


@contextmanager
def shuffles_end_here(spark: SparkSession) -> Iterator[None]:
    """Tables written inside leave no shuffle files behind (the written table takes their place)."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def write_stage(df: DataFrame, name: str = "stage") -> DataFrame:
    """Cut lineage by writing ``df`` as a parquet table under the session's
    checkpoint directory (a shared folder on a cluster) and reading it back.

    Unlike ``checkpoint()`` the re-read is columnar: later passes that need a
    few columns prune the rest and get filters pushed into the scan.  Use it
    for inputs read many times, projected to what is read; keep ``cut_lineage``
    where partition ids of the result must be stable (ranked order statistics).
    """
    spark = df.sparkSession
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/tables/{name}-{uuid.uuid4().hex}"
    with shuffles_end_here(spark):
        df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path)


def spread(df: DataFrame, key: Sequence[str], rows_per_task: int = ROWS_PER_TASK) -> DataFrame:
    """``df`` in partitions of about ``rows_per_task`` rows, dealt by a hash of ``key``; as it is if none holds more on average.

    A scan cuts files by their compressed bytes, so that a task may get many
    times the rows that a learner can hold in memory for it.
    """
    tasks = -(-df.count() // rows_per_task)
    return df.repartition(tasks, *key) if tasks > df.rdd.getNumPartitions() else df


def dealt(df: DataFrame, key: Sequence[str], rows: int) -> DataFrame:
    """``df`` of about ``rows`` rows in a partition for each core, dealt by a hash of ``key``; as it is beyond ``ROWS_PER_TASK`` rows a core.

    Shuffles and scans are cut by bytes: a well compressed table of a million
    rows may come in one partition, and so may all that is written from it.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    tasks = min(cores, rows // LEAST_ROWS)
    return df.repartition(tasks, *key) if tasks > 1 and rows <= cores * ROWS_PER_TASK else df
