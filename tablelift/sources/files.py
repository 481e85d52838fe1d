"""Text files of any file system that Spark knows, by way of Hadoop's client on the driver."""

from __future__ import annotations

from py4j.java_gateway import is_instance_of
from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if is_instance_of(spark.sparkContext._gateway, system, "org.apache.hadoop.fs.ChecksumFileSystem"):
        system = system.getRawFileSystem()  # without checksum files beside each file
    return system, target


def _io(error: Exception) -> OSError:
    return OSError(str(error).split("\n", 1)[0] if not hasattr(error, "java_exception") else str(error.java_exception))


def read_text(spark: SparkSession, path: str) -> str:
    """A whole file as UTF-8; OSError if there is none."""
    try:
        system, target = _at(spark, path)
        stream = system.open(target)
        try:
            data = bytes(spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()
    except Py4JJavaError as e:
        raise _io(e) from e
    return data.decode()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    try:
        system, target = _at(spark, path)
        stream = system.create(target, True)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
    except Py4JJavaError as e:
        raise _io(e) from e


def save_below(spark: SparkSession, folder: str, name: str, text: str) -> None:
    """Write a file below a folder, whose slashes at the end do not count."""
    write_text(spark, folder.rstrip("/") + name, text)
