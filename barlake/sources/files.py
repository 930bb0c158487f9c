"""Small files and folders beside the tables, through Spark's own file systems."""

from __future__ import annotations

import time

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), hadoop_path


def _is(error: Py4JJavaError, *names: str) -> bool:
    return error.java_exception.getClass().getSimpleName() in names


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    return fs.exists(hadoop_path)


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _file_system(spark, path)
    fs.delete(hadoop_path, True)


def rename(spark: SparkSession, path: str, new: str) -> bool:
    fs, hadoop_path = _file_system(spark, path)
    try:
        return fs.rename(hadoop_path, spark._jvm.org.apache.hadoop.fs.Path(new))
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return False
        raise


def qualified(spark: SparkSession, path: str) -> str:
    """A path with its file system, in one spelling."""
    fs, hadoop_path = _file_system(spark, path)
    return fs.makeQualified(hadoop_path).toString()


def folder_of(spark: SparkSession, uri: str) -> str:
    """The qualified folder of a file that Spark names by its URI."""
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri)).getParent().toString()


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file or folder was last changed."""
    fs, hadoop_path = _file_system(spark, path)
    return time.time() - fs.getFileStatus(hadoop_path).getModificationTime() / 1000


def names_in(spark: SparkSession, path: str) -> list[str]:
    """Names of what is in a folder, sorted; none if it is not there."""
    fs, hadoop_path = _file_system(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(hadoop_path))


def create_file(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    """Write a small text file; without ``overwrite`` only if there is none, which is then False."""
    fs, hadoop_path = _file_system(spark, path)
    try:
        out = fs.create(hadoop_path, overwrite)
    except Py4JJavaError as error:
        if not overwrite and _is(error, "FileAlreadyExistsException"):
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def read_file(spark: SparkSession, path: str) -> str | None:
    """A small text file, None if it is not there."""
    fs, hadoop_path = _file_system(spark, path)
    try:
        stream = fs.open(hadoop_path)
    except Py4JJavaError as error:
        if _is(error, "FileNotFoundException"):
            return None
        raise
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
