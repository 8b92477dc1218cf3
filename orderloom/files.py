"""Small files and folders beside the tables, wherever Hadoop's file systems keep them."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    """Hadoop's file system and path object of a path."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), place


def delete(spark: SparkSession, path: str) -> None:
    files, place = _at(spark, path)
    files.delete(place, True)


def exists(spark: SparkSession, path: str) -> bool:
    files, place = _at(spark, path)
    return files.exists(place)


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds, sorted; none if there is no such folder."""
    files, place = _at(spark, folder)
    if not files.exists(place):
        return []
    return sorted(status.getPath().getName() for status in files.listStatus(place))


def write_text(spark: SparkSession, path: str, text: str) -> None:
    files, place = _at(spark, path)
    _write(files.create(place, True), text)


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a file that must be new; false if another writer has it.

    Not every file system creates exclusively, so the content is read again.
    """
    files, place = _at(spark, path)
    try:
        _write(files.create(place, False), text)
    except Py4JJavaError:
        if files.exists(place):
            return False
        raise
    return read_text(spark, path) == text


def _write(stream, text: str) -> None:
    try:
        stream.write(text.encode("utf-8"))
    finally:
        stream.close()


def read_text(spark: SparkSession, path: str) -> str:
    files, place = _at(spark, path)
    stream = files.open(place)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def modified_ms(spark: SparkSession, path: str) -> int:
    files, place = _at(spark, path)
    return files.getFileStatus(place).getModificationTime()


def clock_ms(spark: SparkSession, folder: str) -> int:
    """The storage's own time, which all drivers share whatever their clocks say."""
    probe = f"{folder.rstrip('/')}/.clock-{uuid.uuid4().hex}"
    write_text(spark, probe, "")
    try:
        return modified_ms(spark, probe)
    finally:
        delete(spark, probe)
