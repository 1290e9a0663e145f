"""Publication of several tables as one: versioned folders and a single pointer.

A run writes all its tables to a new folder ``versiones/<name>`` and then puts
that name into the file ``actual``, by renaming a finished small file over it,
which file systems do as a whole. A reader goes through the pointer: it sees all
tables of one run or all of the one before, never some of each. What a broken
run has written is a folder that nothing points to.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import SparkSession

POINTER = "actual"
VERSIONS = "versiones"


def _path(spark: SparkSession, *parts: str):
    return spark._jvm.org.apache.hadoop.fs.Path("/".join(p.rstrip("/") for p in parts))


def _fs(spark: SparkSession, path):
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def new_version(out_dir: str) -> str:
    """A fresh version's name; names sort by time."""
    return f"{time.strftime('%Y%m%dT%H%M%S', time.gmtime())}-{uuid.uuid4().hex[:12]}"


def folder(out_dir: str, version: str) -> str:
    return f"{out_dir.rstrip('/')}/{VERSIONS}/{version}"


def publish(spark: SparkSession, out_dir: str, version: str) -> None:
    """Point to ``version``; it must have been written whole."""
    own = _path(spark, out_dir, f".{POINTER}-{version}")
    stream = _fs(spark, own).create(own, True)
    try:
        stream.write(bytearray(version.encode()))
    finally:
        stream.close()
    jvm = spark._jvm
    rename = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(rename, 1)
    options[0] = rename.OVERWRITE
    target = _path(spark, out_dir, POINTER)
    qualified = _fs(spark, target).makeQualified(target)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(qualified.toUri(), spark.sparkContext._jsc.hadoopConfiguration())
    files.rename(own, target, options)


def current(spark: SparkSession, out_dir: str) -> str | None:
    """The folder of the published version; None before the first."""
    at = _path(spark, out_dir, POINTER)
    fs = _fs(spark, at)
    if not fs.exists(at):
        return None
    stream = fs.open(at)
    try:
        name = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return folder(out_dir, name)
