"""SparkSession construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job of this library is written against.  AQE re-plans joins
# from runtime sizes, coalesces tiny shuffle partitions and splits skewed join
# partitions; the session time zone is pinned so clock features are stable.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "rankfold",
              shuffle_partitions: int | None = None,
              conf: dict[str, str] | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = dict(DEFAULT_CONF)
    if shuffle_partitions:
        settings["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    settings.update(conf or {})
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


# Rows of a table that one shuffle partition is to hold at most: a task's sort
# or hash table is bounded by it, whatever the size of the table.
PARTITION_ROWS = 500_000
PARTITION_BYTES = "16m"  # about as many rows, as shuffled: what AQE may merge them to
ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
SPLIT_BYTES = "16m"  # of a file, read by one task: its shuffle holds the rows unpacked
SPLIT = "spark.sql.files.maxPartitionBytes"
_rows: dict[tuple[str, str], int] = {}


def _bytes(size: str) -> int:
    """A size as Spark writes it (``64MB``, ``8m``, plain bytes) in bytes."""
    number, unit = re.fullmatch(r"(\d+)\s*([kmgtp]?)b?", size.strip().lower()).groups()
    return int(number) << 10 * " kmgtp".index(unit or " ")


def fit_partitions(spark: SparkSession, path: str) -> int:
    """Raise the session's shuffle partitions so that none holds more than
    about ``PARTITION_ROWS`` rows of the Parquet table at ``path``, and let AQE
    merge those that turn out small to ``PARTITION_BYTES`` at most, whether
    they were raised or not: merged up to Spark's own 64 MB, a task holds some
    5 million rows.  Files are read in splits of ``SPLIT_BYTES`` at most, as a
    scan's shuffle may hold all rows of its split.  More partitions, and smaller
    sizes, stay.  Rows are counted from the footers, once a session."""
    known = (spark.sparkContext.applicationId, path)
    if known not in _rows:
        _rows[known] = spark.read.parquet(path).count()
    now = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    wanted = max(now, -(-_rows[known] // PARTITION_ROWS))
    if wanted > now:
        spark.conf.set("spark.sql.shuffle.partitions", str(wanted))
    if _rows[known] > PARTITION_ROWS:
        for name, default, most in ((ADVISORY, "64m", PARTITION_BYTES), (SPLIT, "128m", SPLIT_BYTES)):
            if _bytes(spark.conf.get(name, None) or default) > _bytes(most):
                spark.conf.set(name, most)
    return wanted


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, configuring it if needed.

    On a cluster the folder must be the shared one named by
    ``spark.checkpoint.dir``; it is read from the session and never invented.
    Only a local-mode session (tests, the bench) without that setting gets a
    fresh folder under the system temp dir.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir")
    if configured:
        sc.setCheckpointDir(configured)
        return configured
    if not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: a shared (HDFS/S3/DBFS) folder is required "
            "for lineage cuts on a cluster")
    folder = tempfile.mkdtemp(prefix="rankfold-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(folder)
    return folder


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back.

    Columns lie packed, where a checkpoint keeps whole rows as they are in
    memory, and the shuffle files of the writing job go when it ends; they would
    stay on the executors' disks until the driver happens to collect its garbage."""
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/written/{name}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)
