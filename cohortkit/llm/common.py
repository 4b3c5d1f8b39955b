"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import time
import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Seconds between two times that a task gives memory back.
PAUSE = 0.5
_given = [0.0]


def give_back() -> None:
    """Return freed memory of this worker process to the system; Arrow and glibc keep it otherwise, and Spark keeps the process."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)
    _given[0] = time.monotonic()


def lean(run: Callable) -> Callable:
    """A task on batches that gives freed memory back when it starts, every ``PAUSE`` seconds, and at its end."""

    @functools.wraps(run)
    def task(batches):
        give_back()
        try:
            for out in run(batches):
                yield out
                del out
                if time.monotonic() - _given[0] > PAUSE:
                    give_back()
        finally:
            give_back()

    return task


def lean_group(decide: Callable) -> Callable:
    """The same for a function on a group, after it has run."""

    @functools.wraps(decide)
    def task(pdf):
        out = decide(pdf)
        if time.monotonic() - _given[0] > PAUSE:
            give_back()
        return out

    return task


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A private folder is used only when the setting is absent and the master is
    local; on a cluster without the setting the call fails, because a
    machine-local folder would lose files.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="cohortkit-llm-"))
    return spark.sparkContext.getCheckpointDir().rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_dir(spark)}/llm-{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str, codec: str = "zstd") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back.

    This cuts the lineage: a lost executor costs only the tasks it was running.
    Task output is committed atomically, so a retried task leaves no duplicates.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` that no frame in use reads any more."""
    for t in tables:
        path = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.scratch_path)
        path.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_or_empty(col: str = "text") -> Column:
    return F.coalesce(F.col(col), F.lit(""))


def fresh(names: list[str], want: str) -> str:
    """``want``, extended by underscores until it clashes with none of ``names``."""
    taken = {n.lower() for n in names}
    while want.lower() in taken:
        want += "_"
    return want
