"""The few file-system calls a Parquet store needs, on any Hadoop path."""

from __future__ import annotations

import os
import time
import uuid

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop = _open(spark, path)
    return fs.exists(hadoop)


def delete(spark: SparkSession, path: str) -> None:
    fs, hadoop = _open(spark, path)
    fs.delete(hadoop, True)


def move(spark: SparkSession, source: str, target: str) -> bool:
    """Move a file or folder; False if it is no longer there or its new place is taken."""
    fs, old = _open(spark, source)
    _, place = _open(spark, target)
    return fs.exists(old) and not fs.exists(place) and fs.rename(old, place)


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file that is not there yet, whole from its first moment; False if there is one.

    Of several that try, one succeeds: by a link on a local disk, else by a rename, which HDFS
    and stores with real renames refuse if the place is taken.
    """
    fs, place = _open(spark, path)
    fs.mkdirs(place.getParent())
    draft = f"{path.rsplit('/', 1)[0]}/.{uuid.uuid4().hex}"
    _, hadoop = _open(spark, draft)
    if fs.getScheme() == "file":
        local, target = hadoop.toUri().getPath(), place.toUri().getPath()
        with open(local, "w", encoding="utf-8") as file:
            file.write(text)
        try:
            os.link(local, target)
        except FileExistsError:
            return False
        finally:
            os.remove(local)
        return True
    stream = fs.create(hadoop, True)
    stream.write(bytearray(text.encode()))
    stream.close()
    made = not fs.exists(place) and fs.rename(hadoop, place)
    if not made:
        fs.delete(hadoop, False)
    return made


def read_text(spark: SparkSession, path: str) -> str | None:
    """A small file's text; None if there is no such file."""
    fs, hadoop = _open(spark, path)
    if not fs.exists(hadoop):
        return None
    stream = fs.open(hadoop)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def age(spark: SparkSession, path: str) -> float:
    """Seconds since a file was written; 0 if there is none."""
    fs, hadoop = _open(spark, path)
    if not fs.exists(hadoop):
        return 0.0
    return time.time() - fs.getFileStatus(hadoop).getModificationTime() / 1000


def touch(spark: SparkSession, path: str) -> None:
    """Create an empty file."""
    fs, hadoop = _open(spark, path)
    fs.create(hadoop, True).close()


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Names of the files and folders that match a glob pattern."""
    fs, hadoop = _open(spark, pattern)
    return sorted(str(s.getPath().getName()) for s in fs.globStatus(hadoop) or [])


def make_until_exit(spark: SparkSession, path: str) -> None:
    """Create a folder that the driver removes when it exits."""
    fs, hadoop = _open(spark, path)
    if not fs.exists(hadoop):
        fs.mkdirs(hadoop)
        fs.deleteOnExit(hadoop)


def folders(spark: SparkSession, pattern: str) -> list[str]:
    """Folders that match a glob pattern; empty if none do."""
    fs, hadoop = _open(spark, pattern)
    return [str(s.getPath().toString()) for s in fs.globStatus(hadoop) or [] if s.isDirectory()]
