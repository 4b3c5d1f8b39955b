import pytest

from cohortkit import session
from cohortkit.session import cluster_conf


def test_cluster_conf_scales_with_input():
    small = cluster_conf(input_bytes=10 << 30, total_cores=800)
    big = cluster_conf(input_bytes=100 << 40, total_cores=8000)
    assert int(small["spark.sql.shuffle.partitions"]) == 3 * 800           # at least three waves of cores
    assert int(big["spark.sql.shuffle.partitions"]) == (100 << 40) // (512 << 20) // 2  # no cap
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert int(big["spark.sql.files.maxPartitionBytes"]) == 512 << 20


class _Cluster:
    """A session stand-in on a cluster master without a shared folder."""

    class conf:  # noqa: N801
        @staticmethod
        def get(key, default=None):
            return default

    class sparkContext:  # noqa: N801
        master = "spark://host:7077"

        @staticmethod
        def getCheckpointDir():
            return None


def test_scratch_needs_a_shared_folder_off_local_masters():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.scratch_path(_Cluster, "t")
