"""Files and folders, wherever Spark reads them."""

from __future__ import annotations

from py4j.java_gateway import JavaObject
from pyspark.sql import SparkSession


def hadoop_path(spark: SparkSession, path: str) -> tuple[JavaObject, JavaObject]:
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    fs, found = hadoop_path(spark, path)
    return fs.exists(found)


def is_folder(spark: SparkSession, path: str) -> bool:
    fs, found = hadoop_path(spark, path)
    return fs.exists(found) and fs.getFileStatus(found).isDirectory()


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a path."""
    fs, found = hadoop_path(spark, path)
    return fs.getContentSummary(found).getLength()


def listing(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """Name, bytes and time of change, in milliseconds, of what a folder holds; nothing if there is none."""
    fs, found = hadoop_path(spark, path)
    if not fs.exists(found):
        return []
    held = [(s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in fs.listStatus(found)]
    return sorted(held)


def drop(spark: SparkSession, path: str) -> None:
    """Delete a folder."""
    fs, found = hadoop_path(spark, path)
    fs.delete(found, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Give a folder another name. If there is a folder of that name, it may come to lie in it."""
    fs, found = hadoop_path(spark, path)
    fs.rename(found, hadoop_path(spark, to)[1])


def claim(spark: SparkSession, path: str) -> bool:
    """Make an empty file that only one caller can make."""
    fs, found = hadoop_path(spark, path)
    fs.mkdirs(found.getParent())
    return fs.createNewFile(found)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, found = hadoop_path(spark, path)
    stream = fs.create(found, True)
    stream.write(bytearray(text.encode()))
    stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    fs, found = hadoop_path(spark, path)
    stream = fs.open(found)
    try:
        return bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
