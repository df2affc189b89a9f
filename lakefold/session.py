"""SparkSession helpers.

Library code never builds its own session: every operator takes the caller's
``SparkSession`` (or a DataFrame).  ``local_session`` is for tests, the bench
and the driver smoke check only.
"""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every job in this package relies on (set by the cluster owner in
# production; tests set them here).  UTC keeps ISO text and hashes stable.
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "lakefold") -> SparkSession:
    """A local session for tests and benchmarks (UI off, UTC, AQE on)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", os.environ.get("LAKEFOLD_DRIVER_MEMORY", "8g"))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    On a cluster the owner sets it to a shared file system and we use it as
    is; only when it is unset (local tests) do we fill in a fresh scratch
    folder.
    """
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001 - sessions without a local SparkContext
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a shared folder") from None
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder: scratch tables and stream "
                               "checkpoints must survive the loss of any machine")
        configured = tempfile.mkdtemp(prefix="lakefold-ckpt-")  # single-machine runs only
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def scratch_table(df: DataFrame, name: str, rows_a_file: int = 0) -> DataFrame:
    """``df`` written to a fresh folder of the shared checkpoint folder and
    read back: every later reading sees the same rows.  It may be held beside
    much else, so it is compressed well.  ``rows_a_file`` bounds its files (0: it does not)."""
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/lakefold/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("maxRecordsPerFile", rows_a_file).parquet(path, compression="zstd")
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_end_with_queries(spark: SparkSession) -> Iterator[None]:
    """Inside, the files that a query shuffled go when it ends, not when the
    driver next collects garbage: a job of several wide writes then holds the
    shuffle of one of them at a time.  Not for persisted frames, whose lost
    blocks would be made from these files."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def set_utc(spark: SparkSession) -> None:
    """Pin the session zone; hashes and ISO text depend on it."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
