"""Files of whatever store Spark writes to, through Hadoop's interface."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def file_system(spark: SparkSession, folder: str):
    return _path(spark, folder).getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    return file_system(spark, path).exists(_path(spark, path))


def subfolders(spark: SparkSession, folder: str, prefix: str = "") -> list[str]:
    """Names of the folders in a folder; none if it is absent."""
    return [name for name, is_folder, _ in _listed(spark, folder) if is_folder and name.startswith(prefix)]


def file_names(spark: SparkSession, folder: str) -> list[str]:
    return [name for name, is_folder, _ in _listed(spark, folder) if not is_folder]


def changed_at(spark: SparkSession, folder: str) -> dict[str, int]:
    """When each file and folder in a folder was last changed, in milliseconds."""
    return {name: when for name, _, when in _listed(spark, folder)}


def set_changed_at(spark: SparkSession, path: str, when: int) -> None:
    """Set when a file was last changed, in milliseconds."""
    file_system(spark, path).setTimes(_path(spark, path), when, -1)


def _listed(spark: SparkSession, folder: str) -> list[tuple[str, bool, int]]:
    path, files = _path(spark, folder), file_system(spark, folder)
    if not files.exists(path):
        return []
    return [
        (status.getPath().getName(), status.isDirectory(), status.getModificationTime())
        for status in files.listStatus(path)
    ]


def remove(spark: SparkSession, path: str) -> None:
    file_system(spark, path).delete(_path(spark, path), True)


def read_text(spark: SparkSession, path: str) -> str:
    stream = file_system(spark, path).open(_path(spark, path))
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, or not at all: false if a file of that name is there.

    It is written beside its place and renamed, which must not replace a file: a store
    whose rename is atomic (a Hadoop file system) lets one of several writers win.
    """
    beside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
    stream = file_system(spark, path).create(_path(spark, beside), False)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    fs = spark._jvm.org.apache.hadoop.fs
    kinds = getattr(fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE
    context = fs.FileContext.getFileContext(
        _path(spark, path).toUri(), spark._jsc.hadoopConfiguration()
    )
    try:
        context.rename(_path(spark, beside), _path(spark, path), options)
    except Py4JJavaError as error:
        remove(spark, beside)
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)
