"""Spark session settings and the shared working folder."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings the operators count on; a cluster's own defaults stay for the rest.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "trafficlens", **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new path in the folder all executors share (``spark.checkpoint.dir``).

    Only a local session without that setting may fall back to a temporary
    folder of this machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="trafficlens-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


# Folders of staged frames, for :func:`drop_staged`.
_STAGED: list[str] = []


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For a derived fact that several branches of a report read: computed once,
    scanned with column pruning and filters, and safe against lost executors.
    """
    path = shared_folder(df.sparkSession, name)
    _STAGED.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def file_system(spark: SparkSession, path: str):
    """The Hadoop file system of a path, and the path as it wants it."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder on the file system that its path names."""
    files, place = file_system(spark, path)
    return files.delete(place, True)


def drop_staged(spark: SparkSession) -> None:
    """Remove the staged frames of this application, at the end of a job."""
    while _STAGED:
        delete_folder(spark, _STAGED.pop())
