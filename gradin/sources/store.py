"""Files in a folder that all executors share: whether they are there, and files made only once."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _at(spark, path)
    return fs.exists(where)


def names(spark: SparkSession, path: str) -> list[str]:
    """The names in a folder, in order; none if there is no such folder."""
    fs, where = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(where)) if fs.exists(where) else []


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with this text; False if it is there already, whoever made it.

    Of several that make it at the same time one gets True. Distributed stores refuse a second
    file of one name themselves; for a mounted folder, where Hadoop looks first and writes
    then, the operating system is asked to.
    """
    fs, where = _at(spark, path)
    if fs.getScheme() == "file":
        fs.mkdirs(where.getParent())
        try:
            with open(where.toUri().getPath(), "x", encoding="utf-8") as out:
                out.write(text)
        except FileExistsError:
            return False
        return True
    try:
        out = fs.create(where, False)
    except Py4JJavaError:
        if fs.exists(where):
            return False
        raise
    out.write(bytearray(text, "utf-8"))
    out.close()
    return True


def remove(spark: SparkSession, path: str) -> bool:
    """Remove a folder with all in it; False if there is none."""
    fs, where = _at(spark, path)
    return fs.delete(where, True)
