"""Small file-system helpers through the session's own Hadoop configuration."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def read_small(spark: SparkSession, path: str) -> str | None:
    """Text of a one-line pointer file; None when it is absent."""
    if not exists(spark, path):
        return None
    rows = spark.read.text(path, wholetext=True).head(1)
    return rows[0][0].strip() if rows else None


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names of the files in a folder; none where it is absent."""
    fs, target = _fs(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(target)] if fs.exists(target) else []


def create_small(spark: SparkSession, path: str, text: str) -> bool:
    """Make a file with its whole text, unless one of that name is there: then nothing changes and the answer is no.

    The text is written beside the target and renamed without overwriting, which file systems made for clusters do in one step.
    """
    fs, target = _fs(spark, path)
    context = spark.sparkContext
    hadoop = context._jvm.org.apache.hadoop.fs
    beside = hadoop.Path(target.getParent(), f".{uuid.uuid4().hex}")
    stream = fs.create(beside, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    options = context._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
    try:
        hadoop.FileContext.getFileContext(target.toUri(), context._jsc.hadoopConfiguration()).rename(beside, target, options)
    except Py4JJavaError as error:
        if "FileAlreadyExistsException" not in str(error.java_exception):
            raise
        fs.delete(beside, False)
        return False
    return True


_LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"


def limit_listings(spark: SparkSession) -> None:
    """Folders are listed by a few tasks a core. Spark's default is a task for each of up to 10,000 folders, at every level of a tree."""
    spark.conf.set(_LISTING, str(4 * spark.sparkContext.defaultParallelism))


@contextmanager
def few_listings(spark: SparkSession) -> Iterator[None]:
    """``limit_listings`` for what is listed inside."""
    before = spark.conf.get(_LISTING)
    limit_listings(spark)
    try:
        yield
    finally:
        spark.conf.set(_LISTING, before)
