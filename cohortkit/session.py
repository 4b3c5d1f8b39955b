"""Session defaults and the shared scratch location."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings every cohortkit job expects.  ANSI mode stays on (Spark 4 default);
# the library uses try_cast / try_to_date / try_divide where input is dirty.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.ui.enabled": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "cohortkit", extra: dict | None = None) -> SparkSession:
    """Return a session with the library defaults applied.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder the cluster names in ``spark.checkpoint.dir``.

    A private folder is set only for a local master without that setting (as
    in tests).  On a cluster the call fails instead: each executor would
    write to its own disk, and later reads would miss files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception as e:  # noqa: BLE001 - Spark Connect: the setting is all there is
        if not configured:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share") from e
        return configured
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        configured = tempfile.mkdtemp(prefix="cohortkit-ckpt-")
        atexit.register(shutil.rmtree, configured, ignore_errors=True)
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder for written tables."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{base}/cohortkit-{name}-{uuid.uuid4().hex}"


def cluster_conf(input_bytes: int, total_cores: int, split_bytes: int = 512 << 20) -> dict:
    """Partition sizing for a large cluster, to pass as ``get_session(extra=...)``.

    * scan splits of ``split_bytes`` (Parquet row groups permitting);
    * initial shuffle partitions sized for a shuffle as large as half the
      input, never fewer than three waves of cores; AQE coalesces small ones
      at run time and splits skewed ones (a partition 5x the median and above
      1 GiB).  Choose a larger ``split_bytes`` for fewer partitions;
    * static broadcast threshold 64 MiB, used only on Spark's size estimate;
      AQE re-checks with measured sizes.
    """
    splits = -(-input_bytes // split_bytes)
    shuffle = max(3 * total_cores, splits // 2)
    return {
        "spark.sql.files.maxPartitionBytes": str(split_bytes),
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(256 << 20),
        # coalesce to the advisory size (on a busy cluster, not to the default parallelism)
        "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(1 << 30),
        "spark.sql.autoBroadcastJoinThreshold": str(64 << 20),
        "spark.sql.adaptive.autoBroadcastJoinThreshold": str(64 << 20),
    }
