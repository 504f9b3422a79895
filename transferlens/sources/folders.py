"""Folders of any file system that Spark reads, through its Hadoop client: metadata calls only."""

from __future__ import annotations

from pyspark.sql import SparkSession


def system_of(spark: SparkSession, path: str):
    """The file system of ``path`` and the path in it."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), folder


def exists(spark: SparkSession, path: str) -> bool:
    system, folder = system_of(spark, path)
    return system.exists(folder)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, sorted; none if it is missing."""
    system, folder = system_of(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(folder)) if system.exists(folder) else []


def delete(spark: SparkSession, path: str) -> None:
    system, folder = system_of(spark, path)
    system.delete(folder, True)


def move(spark: SparkSession, old: str, new: str) -> None:
    """Renames a folder; the parent of the new name is made."""
    system, folder = system_of(spark, old)
    to = system_of(spark, new)[1]
    system.mkdirs(to.getParent())
    if not system.rename(folder, to):
        raise OSError(f"could not rename {old} to {new}")


def touch(spark: SparkSession, path: str) -> None:
    """An empty file."""
    system, file = system_of(spark, path)
    system.create(file, True).close()
