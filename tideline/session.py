"""Session defaults and the shared folder for written intermediates."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# AQE does the run-time work that the library leaves to Spark: it coalesces small
# shuffle partitions, splits skewed join partitions and splits or merges the
# output of REBALANCE before a write.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.parquet.compression.codec": "zstd",
    # Recording the Python line of every column expression costs more than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "tideline", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    """A session with the defaults above; ``conf`` wins over them.

    Shuffle partitions are left to the cluster's own setting: with AQE it is an
    upper bound and should be a small multiple of the executor cores.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder: on a
    cluster, a folder of one machine is lost with it and unseen by the others.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    root = root or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
    root = tempfile.mkdtemp(prefix="tideline-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path, used by nobody else, in the application's part of the shared folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/tideline/{spark.sparkContext.applicationId}"


def drop_scratch(spark: SparkSession) -> None:
    """Delete the application's intermediates, when nothing that was computed from them is read any more."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(_own_folder(spark))
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)
