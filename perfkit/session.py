"""Session helpers: a configured SparkSession and the shared checkpoint folder."""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "perfkit") -> SparkSession:
    """Return the active session, or build one tuned for these workloads.

    On a cluster the submitter's configuration wins; the settings below are only
    applied when this call creates the session.
    """
    active = SparkSession.getActiveSession()
    if active is not None:
        return active
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true"))
    if master and master.startswith("local"):
        # Local mode runs executors inside the driver JVM: give it the memory.
        b = b.config("spark.driver.memory", os.environ.get("PERFKIT_DRIVER_MEMORY", "16g"))
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return b.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    Read from the session. Only when it is unset in local mode (tests, laptops) is a
    private scratch folder created and registered; on a cluster an unset value is an
    error, since a machine-local folder would not survive the loss of an executor.
    """
    d = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not d:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach "
                               "(HDFS, object store); a machine-local folder would not survive "
                               "executor loss")
        d = tempfile.mkdtemp(prefix="perfkit-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(d)
    return d


def worker_cache() -> dict:
    """A table that lives as long as the Python process. Functions travel to workers by value, and with
    them fresh copies of their modules' variables; what is to outlast a task is kept here."""
    return sys.modules.setdefault("perfkit_worker_cache", types.ModuleType("perfkit_worker_cache")).__dict__


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path for an intermediate table under the shared checkpoint folder."""
    return os.path.join(checkpoint_dir(spark), name)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def path_stamp(spark: SparkSession, path: str) -> str:
    """Size and time of change of a file or folder, in whatever store the path names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return f"{fs.getContentSummary(p).getLength()}:{fs.getFileStatus(p).getModificationTime()}"


def written(df: DataFrame, name: str) -> DataFrame:
    """Write to the shared folder and read back: computed once, survives lost executors, and readers
    prune columns and rows. Each call has a folder of its own."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


cloudpickle.register_pickle_by_value(sys.modules[__name__])
