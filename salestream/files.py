"""Files beside tables, on whatever file system holds them."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def children(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it does not exist."""
    fs, where = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(where)] if fs.exists(where) else []


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def delete(spark: SparkSession, path: str) -> None:
    fs, where = _at(spark, path)
    fs.delete(where, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Replace a small file."""
    fs, where = _at(spark, path)
    out = fs.create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file whole, or not at all if there is one of that name; whether it was created.

    It is written under another name and renamed without overwriting, which of several writers lets one win wherever
    the file system renames atomically (HDFS and local ones do; an object store needs a committer that does).
    """
    jvm = spark._jvm
    folder, _, name = path.rpartition("/")
    draft = f"{folder}/.{name}-{uuid.uuid4().hex}"
    write_text(spark, draft, text)
    old, new = (jvm.org.apache.hadoop.fs.Path(p) for p in (draft, path))
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(old.toUri(), spark._jsc.hadoopConfiguration())
    no_overwrite = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(old, new, no_overwrite)
        return True
    except Py4JJavaError as error:
        delete(spark, draft)
        if "FileAlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise


def read_text(spark: SparkSession, path: str) -> str:
    """A small file, whole."""
    fs, where = _at(spark, path)
    stream = fs.open(where)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
