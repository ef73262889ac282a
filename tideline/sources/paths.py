"""Folders, by the file systems Spark knows."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below ``path``; none where it does not exist."""
    _, hadoop_path, fs = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory())


def remove_folder(spark: SparkSession, path: str) -> bool:
    _, hadoop_path, fs = _file_system(spark, path)
    return fs.delete(hadoop_path, True)
