"""Materialising intermediate results so that they survive the loss of executors."""

from __future__ import annotations

import atexit
import shutil
import tempfile

from pyspark.sql import DataFrame, SparkSession


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder.

    The setting ``spark.checkpoint.dir`` (a folder that all executors share) wins. Only a local session
    without it gets a temporary folder; a cluster without it is an error, as a folder on one machine
    would be lost with that machine.
    """
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        master = sc.master or ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        path = tempfile.mkdtemp(prefix="fieldloom-checkpoint-")
        atexit.register(shutil.rmtree, path, True)
    sc.setCheckpointDir(path)
    return path


def durable(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there, with the lineage cut."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def forget(spark: SparkSession) -> None:
    """Delete what this session has written to its checkpoint folder; results that still read from it are lost. For long sessions
    between runs; with ``spark.cleaner.referenceTracking.cleanCheckpoints`` Spark itself deletes what is no longer referenced."""
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        path = spark._jvm.org.apache.hadoop.fs.Path(current.get())
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
        spark.sparkContext._jsc.sc().setCheckpointDir(str(path.getParent()))
