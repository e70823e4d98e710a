"""Folders on whatever file system Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def delete(spark: SparkSession, path: str) -> bool:
    """Remove a folder or file with all it holds; False if there was none."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
