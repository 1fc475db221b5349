"""Small file operations on whatever file system a path names, by Spark's own file system client."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    system, where = _at(spark, path)
    return system.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if there is no such folder."""
    system, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in system.listStatus(where)) if system.exists(where) else []


def delete(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)


def write_new_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file that must not exist yet; False if it does.

    The file appears under its name whole, by one rename.
    """
    system, where = _at(spark, path)
    folder, name = path.rsplit("/", 1)
    part = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/.{name}.{uuid.uuid4().hex}")
    out = system.create(part, False)
    out.write(bytearray(text.encode()))
    out.close()
    context = spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(where.toUri(), spark._jsc.hadoopConfiguration())
    # without the option to overwrite
    options = spark.sparkContext._gateway.new_array(getattr(spark._jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(context.makeQualified(part), context.makeQualified(where), options)
    except Py4JJavaError as error:
        system.delete(part, False)
        if "FileAlreadyExistsException" in error.java_exception.getClass().getName():
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()
