"""Small files beside the tables, through the file system that the cluster shares."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def list_names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder; none if there is no such folder."""
    files, where = _at(spark, path)
    return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []


def read_text(spark: SparkSession, path: str) -> str:
    files, where = _at(spark, path)
    stream = files.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a file that readers see whole or not at all, in place of any by this name."""
    _written(spark, path, text, "OVERWRITE")


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """The same unless there is a file by this name; of several writers only one does."""
    try:
        _written(spark, path, text, "NONE")
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" in str(error.java_exception):
            return False
        raise
    return True


def _written(spark: SparkSession, path: str, text: str, mode: str) -> None:
    files, where = _at(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs
    hidden = hadoop.Path(where.getParent(), f"_{uuid.uuid4().hex}.writing")
    stream = files.create(hidden, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    rename = getattr(hadoop, "Options$Rename")
    modes = spark.sparkContext._gateway.new_array(rename, 1)
    modes[0] = getattr(rename, mode)
    try:
        context = hadoop.FileContext.getFileContext(files.getUri(), spark._jsc.hadoopConfiguration())
        context.rename(files.makeQualified(hidden), files.makeQualified(where), modes)
    finally:
        if files.exists(hidden):
            files.delete(hidden, False)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Moves a folder to a name that is free."""
    files, where = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    files.mkdirs(target.getParent())
    if files.exists(target) or not files.rename(where, target):
        raise OSError(f"{path} cannot be moved to {to}")


def delete(spark: SparkSession, path: str) -> None:
    files, where = _at(spark, path)
    files.delete(where, True)


def bytes_in(spark: SparkSession, path: str) -> int:
    files, where = _at(spark, path)
    return files.getContentSummary(where).getLength()
