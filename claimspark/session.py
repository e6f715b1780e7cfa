"""Spark session defaults and the shared checkpoint location."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings that matter for the plans in this package.  Shuffle partitions is
# a starting point only: AQE coalesces small partitions and splits skewed
# ones at run time.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(
    master: str | None = None,
    app_name: str = "claimspark",
    shuffle_partitions: int | None = None,
    conf: dict[str, str] | None = None,
) -> SparkSession:
    """Return the active session, or build one with this package's defaults."""
    builder = SparkSession.builder.appName(app_name)
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
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint directory of the session.

    On a cluster this must be the shared folder named by
    ``spark.checkpoint.dir``.  Only a local-mode session (tests, bench) with
    no setting gets a private scratch folder.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set; point it at a shared folder "
            "(HDFS/S3/ABFS) so checkpoints survive executor loss"
        )
    path = configured or tempfile.mkdtemp(prefix="claimspark-ckpt-")
    sc.setCheckpointDir(path)
    return sc.getCheckpointDir() or path


def package_on_workers(spark: SparkSession) -> None:
    """Let Python workers find this package where the driver found it.

    Functions of a package reach a worker by name.  On a cluster the package
    is installed on every node or shipped with the job; this only helps
    sessions whose workers share the driver's files but not its import path.
    """
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def cluster_conf(input_bytes: int, cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Starting settings for a run over ``input_bytes`` on ``cores`` executor cores.

    Shuffle partitions start at one per ``target_partition_bytes`` of input
    (at least two waves of the cores) and AQE coalesces them toward the
    advisory size at run time, so no partition is sized by a constant that
    only fits small data.  Scan splits use the same target.  Skewed
    partitions above 5x the median (and 256 MB) are split by AQE's skew join.
    """
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
