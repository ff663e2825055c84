"""Helpers that several operators share: reading tables, written intermediate tables, words."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
from collections.abc import Callable, Hashable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import reachable as reachable

#: A word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Rows in an Arrow batch of a job that asks for small ones.
BATCH = 1024


def small_batches(spark: SparkSession, rows: int = BATCH) -> None:
    """Lets at most so many rows go to Python at once, in this session from now on; a smaller setting stays.

    An executor holds each batch several times over beside its heap, and its worker again.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, rows)


_kept: dict[Hashable, object] = {}


def kept(key: Hashable, make: Callable[[], object]) -> object:
    """What ``make`` gives, kept by a worker process for its next tasks. It keeps one thing at a time."""
    if key not in _kept:
        forget()
        _kept[key] = make()
    return _kept[key]


def forget() -> None:
    """Drops what this worker process has kept: a process serves stage after stage, and what they leave must not add up."""
    _kept.clear()
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None) if os.name == "posix" else None:
        trim(0)  # else the C library holds on to most of what is freed


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """A fresh folder below spark.checkpoint.dir, which every executor can reach.

    Only a local session, which is one process, may leave the setting out; it gets a temporary folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="geolake-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/llm-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Written to the shared folder and read back: computed once, and still there when an executor is lost."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The same rows in smaller batches, so that what a task makes of one stays small."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def lower_ascii(text: Column) -> Column:
    """A-Z to a-z and nothing else."""
    return F.translate(text, UPPER, UPPER.lower())


def words(text: Column) -> Column:
    """The words of a text, in order; a null text has none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != "")


def unit_hash(*parts: Column) -> Column:
    """A number in (0, 1) that depends on the parts alone: 52 bits of their md5. Nulls count as the word null."""
    joined = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("null")) for p in parts])
    return (F.conv(F.substring(F.md5(joined), 1, 13), 16, 10).cast("bigint") + F.lit(0.5)) / F.lit(float(1 << 52))
