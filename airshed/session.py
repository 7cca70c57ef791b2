"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

# Settings every job of the library relies on. AQE re-plans joins at run
# time (a side measured below the broadcast threshold, skew-join splitting
# for hot keys, partition coalescing); the time zone is
# pinned so DATE / TIMESTAMP arithmetic does not depend on the host.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def scale_conf(shuffle_bytes: int, executor_cores: int, target_partition_bytes: int = 256 << 20) -> dict[str, str]:
    """Settings for a cluster run, from the expected size of the largest shuffle.

    Shuffle partitions start at shuffle size / target size (at least two waves
    of tasks); AQE then coalesces small ones and splits skewed ones (a
    partition over 5x the median and over 512 MB is split, the other side
    replicated). Scan splits match the target size.
    """
    partitions = max(shuffle_bytes // target_partition_bytes, 2 * executor_cores, 1)
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(512 << 20),
    }


def build_session(master: str | None = None, app_name: str = "airshed",
                  shuffle_partitions: int | None = None,
                  extra: dict[str, str] | None = None) -> SparkSession:
    """Create (or reuse) a session with the library's settings.

    On a cluster pass ``master=None`` and let spark-submit decide; the
    shuffle partition count then stays whatever the cluster configured.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for k, v in BASE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder named by ``spark.checkpoint.dir``.

    A cluster names a folder every executor can reach; it is used as is, and
    a missing setting raises. Only a local master (driver and executors are one
    process) gets a scratch folder when the setting is absent.
    """
    sc = spark.sparkContext
    path = sc.getConf().get("spark.checkpoint.dir", None) or _LOCAL_DIRS.get(id(sc))
    if not path:
        if not sc.master.split("[")[0] == "local":
            raise ValueError("spark.checkpoint.dir is not set: a cluster has to name a folder that the driver "
                             "and all executors share")
        path = tempfile.mkdtemp(prefix="airshed-ckpt-")
        _LOCAL_DIRS[id(sc)] = path
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(path)
    return path


_LOCAL_DIRS: dict[int, str] = {}


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared checkpoint folder for written intermediate tables."""
    return os.path.join(checkpoint_dir(spark), name)
