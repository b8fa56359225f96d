"""Folders of tables, through the Hadoop file system of their path."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession

NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"  # fixed value: Spark's folder name for NULL


def _system(spark: SparkSession, path: str):
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


def exists(spark: SparkSession, path: str) -> bool:
    system, there = _system(spark, path)
    return system.exists(there)


def delete(spark: SparkSession, path: str) -> bool:
    system, there = _system(spark, path)
    return system.delete(there, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what the folder holds; empty for a folder that is not there."""
    system, there = _system(spark, path)
    return [status.getPath().getName() for status in system.listStatus(there)] if system.exists(there) else []


def matching(spark: SparkSession, path: str, pattern: str) -> Iterator[str]:
    """Folders below ``path`` that match a pattern of folder names, relative to it."""
    system, there = _system(spark, f"{path}/{pattern}")
    depth = pattern.count("/") + 1
    for status in system.globStatus(there) or []:
        if status.isDirectory():
            yield "/".join(status.getPath().toUri().getPath().split("/")[-depth:])


def partition_folder(spark: SparkSession, name: str, value: str | None) -> str:
    """Folder name that Spark gives a partition value."""
    text = NULL_FOLDER if value is None or value == "" else value
    return spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString(name, text)


def partition_values(spark: SparkSession, folder: str) -> list[str | None]:
    """The values, as text, that a partition's folder stands for."""
    unescape = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.unescapePathName
    texts = [part.split("=", 1)[1] for part in folder.split("/")]
    return [None if text == NULL_FOLDER else unescape(text) for text in texts]
