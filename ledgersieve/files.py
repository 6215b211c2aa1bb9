"""Small files of the driver and listings, through the Hadoop file systems that Spark itself uses."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

from pyspark.errors.exceptions.captured import CapturedException
from pyspark.sql import SparkSession
from py4j.protocol import Py4JJavaError


class AlreadyThere(RuntimeError):
    """Another writer has made this file."""


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _filesystem(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the entries of one folder; none if it is not there."""
    filesystem, where = _filesystem(spark, folder), _path(spark, folder)
    if not filesystem.exists(where):
        return []
    return [status.getPath().getName() for status in filesystem.listStatus(where)]


def walked(spark: SparkSession, folder: str) -> Iterator[tuple[str, int, int]]:
    """Path, bytes and modification time (milliseconds) of all files below a folder, whatever their names are.

    The file system hands them out page by page, so none of it is held.
    """
    found = _filesystem(spark, folder).listFiles(_path(spark, folder), True)
    while found.hasNext():
        status = found.next()
        yield status.getPath().toString(), status.getLen(), status.getModificationTime()


def read_text(spark: SparkSession, path: str) -> str:
    stream = _filesystem(spark, path).open(_path(spark, path))
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> None:
    """Make a file that is seen whole or not at all; raises ``AlreadyThere`` if it exists.

    The text is written beside it and renamed without replacing, which one of several writers can do.
    """
    folder, _, name = path.rpartition("/")
    beside = f"{folder}/.{name}-{uuid.uuid4().hex}"
    stream = _filesystem(spark, path).create(_path(spark, beside))
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(_path(spark, path).toUri(), spark._jsc.hadoopConfiguration())
    options = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(_path(spark, beside), _path(spark, path), options)
    except (Py4JJavaError, CapturedException) as error:
        if "FileAlreadyExists" not in str(error):
            raise
        _filesystem(spark, path).delete(_path(spark, beside), False)
        raise AlreadyThere(path) from error


def move(spark: SparkSession, source: str, target: str) -> None:
    if not _filesystem(spark, source).rename(_path(spark, source), _path(spark, target)):
        raise OSError(f"cannot move {source} to {target}")


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder; nothing happens if it is not there."""
    _filesystem(spark, path).delete(_path(spark, path), True)


def make_folder(spark: SparkSession, path: str) -> None:
    _filesystem(spark, path).mkdirs(_path(spark, path))
