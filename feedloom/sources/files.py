"""Folders and files on any file system that Spark knows, and the folder for checkpoints."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def file_system(spark: SparkSession, path: str) -> tuple:
    """The Hadoop file system of ``path``, and the path for it."""
    jvm = spark._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all that is in it, if it exists."""
    system, found = file_system(spark, path)
    system.delete(found, True)


def file_names(spark: SparkSession, path: str) -> set[str]:
    """The names of the entries of a folder; none if it isn't there."""
    system, found = file_system(spark, path)
    return {entry.getPath().getName() for entry in system.listStatus(found)} if system.exists(found) else set()


def claim(spark: SparkSession, path: str) -> bool:
    """Create an empty file; false if it exists. One of several callers gets true, where the file
    system creates files atomically, as local ones and HDFS do."""
    system, found = file_system(spark, path)
    system.mkdirs(found.getParent())
    return system.createNewFile(found)


def is_local(spark: SparkSession) -> bool:
    """Whether the executors are this machine's."""
    return spark.sparkContext.master.split("[")[0] in ("local", "local-cluster")


def shared_folder(spark: SparkSession) -> str:
    """A folder that all executors reach: the one named in spark.checkpoint.dir, otherwise one in the
    warehouse. Without either on a shared file system a cluster's jobs are refused, as each executor
    would write to a disk of its own."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    if not is_local(spark) and file_system(spark, warehouse)[0].getScheme() == "file":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{warehouse}/_checkpoints"


def set_checkpoint_dir(spark: SparkSession) -> None:
    """Keep the cluster's checkpoint folder; only where none is set, use the shared one."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A new folder's name next to the checkpoints. Whoever writes there deletes it after use."""
    set_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"
