"""What the two learned scores share: the split into learning and held-out rows, bounded samples, labels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def held_out(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 4, is 2. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 4 == 2


def labelled(labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most ``most`` learning rows (doc_id, label), chosen by a hash of the id; a row for each id, the higher label of several."""
    rows = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id")))
    rows = rows.groupBy("doc_id").agg(F.max(label).alias("label"))
    return rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)


def with_texts(docs: DataFrame, sample: DataFrame) -> DataFrame:
    """The texts of a sample that ``labelled`` or a limit has bounded; only that is broadcast. Null texts are empty."""
    texts = docs.select(F.col("doc_id").alias("_id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(sample), F.col("_id") == F.col("doc_id")).drop("_id")
