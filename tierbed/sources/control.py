"""Small control files (manifests, pointers, leases) in whatever file system Spark reaches.

Spark replaces a directory by deleting and writing it. A control file must never be seen half
written or absent, nor be made by two writers, so these go to the file system itself: replacement is
a rename, and creation fails if the file is there.
"""

from __future__ import annotations

import os
from uuid import uuid4

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _place(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    place = jvm.org.apache.hadoop.fs.Path(path)
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    return jvm, place, place.getFileSystem(conf), conf


def _missing(error: Py4JJavaError) -> bool:
    return "FileNotFoundException" in error.java_exception.getClass().getName()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a file that must not be there; false if it is. Only one of several callers succeeds,
    as far as the file system creates files atomically; local ones, HDFS and its like do."""
    _, place, fs, _ = _place(spark, path)
    if fs.getScheme() == "file":
        local = place.toUri().getPath()
        os.makedirs(os.path.dirname(local), exist_ok=True)
        try:
            handle = os.open(local, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with open(handle, "w", encoding="utf-8") as file:
            file.write(text)
        return True
    try:
        out = fs.create(place, False)
    except Py4JJavaError as error:
        if "AlreadyExists" in error.java_exception.getClass().getName():
            return False
        raise
    out.write(bytearray(text.encode()))
    out.close()
    return True


def replace_text(spark: SparkSession, path: str, text: str) -> None:
    """Write a file so that readers see the old or the new text, and never none."""
    jvm, place, fs, conf = _place(spark, path)
    written = jvm.org.apache.hadoop.fs.Path(place.getParent(), f".{place.getName()}.{uuid4().hex}")
    out = fs.create(written, True)
    out.write(bytearray(text.encode()))
    out.close()
    options = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    overwrite = spark.sparkContext._gateway.new_array(options, 1)
    overwrite[0] = options.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), conf).rename(written, place, overwrite)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a file, or None where there is none."""
    jvm, place, fs, _ = _place(spark, path)
    try:
        stream = fs.open(place)
    except Py4JJavaError as error:
        if _missing(error):
            return None
        raise
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """Rename a file; false if it is not there. Of several callers only one succeeds."""
    jvm, place, fs, _ = _place(spark, path)
    try:
        return fs.rename(place, jvm.org.apache.hadoop.fs.Path(to))
    except Py4JJavaError as error:
        if _missing(error):
            return False
        raise


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what a directory holds, without hidden files."""
    _, place, fs, _ = _place(spark, path)
    try:
        found = [status.getPath().getName() for status in fs.listStatus(place)]
    except Py4JJavaError as error:
        if _missing(error):
            return []
        raise
    return sorted(name for name in found if name[0] not in "._")


def remove(spark: SparkSession, path: str) -> None:
    """Remove a file or a whole directory, if it is there."""
    _, place, fs, _ = _place(spark, path)
    fs.delete(place, True)
