"""Folders for intermediate tables, change sets and stream checkpoints."""

from __future__ import annotations

import tempfile
from uuid import uuid4

from pyspark.sql import SparkSession

_local_roots: dict[str, str] = {}


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder; on a cluster an unset folder is an
    error, because a machine-local path would be lost with its machine.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="tallyflow-")
    return _local_roots[app]


def new_folder(spark: SparkSession, label: str) -> str:
    """Fresh path under the shared root; nothing is created until something is written there."""
    return f"{shared_root(spark)}/tallyflow/{label}-{uuid4().hex}"


def file_system(spark: SparkSession, path: str):
    """Hadoop file system and path objects for ``path`` (local, HDFS or object store alike)."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = file_system(spark, path)
    return fs.exists(hadoop_path) and fs.getFileStatus(hadoop_path).isDirectory()


def list_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the sub-folders of ``path``; empty when it does not exist."""
    fs, hadoop_path = file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def make_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.mkdirs(hadoop_path)


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = file_system(spark, path)
    fs.delete(hadoop_path, True)
