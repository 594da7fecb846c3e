"""Written intermediate tables, in a folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def scratch_path(spark: SparkSession, name: str, root: str | None = None) -> str:
    """A fresh path that is removed when the session's JVM ends.

    It lies in a folder of this application under ``root``, which defaults to the session's
    ``spark.checkpoint.dir``, and without that setting to a folder in the session's warehouse.
    On a cluster a warehouse on a machine's own disk is refused: executors would not see each other's files.
    """
    root = root or spark.conf.get("spark.checkpoint.dir", None)
    fallback = not root
    root = root or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"
    folder = f"{root.rstrip('/')}/{spark.sparkContext.applicationId}"
    path, system = _file_system(spark, folder)
    if fallback and not may_hold_scratch(system.getScheme(), spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    system.mkdirs(path)
    system.deleteOnExit(path)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def may_hold_scratch(scheme: str, master: str) -> bool:
    """Whether all executors see a warehouse on this kind of file system."""
    return scheme != "file" or master.startswith("local")


def written(frame: DataFrame, path: str) -> DataFrame:
    """``frame`` written to ``path`` as Parquet and read again: computed once, without lineage."""
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Remove a written table that nothing reads any more."""
    jvm_path, system = _file_system(spark, path)
    system.delete(jvm_path, True)


def _file_system(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path, jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
