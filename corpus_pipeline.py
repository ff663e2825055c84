"""The corpus pipeline: toxic documents go, one of each group of near copies stays, secrets are masked, sources are
mixed to their targets, and what is left is encoded and read back. Each stage's rows are written and reread."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geolake.llm import bpe, mixing, ngram_join, secrets, toxicity
from geolake.llm.shared import reachable, read, shared_dir, small_batches, stored


def prepared(spark: SparkSession) -> None:
    """Python workers find the package, and get rows in small batches: they live through all stages beside one heap."""
    reachable(spark)
    small_batches(spark)


def toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below the threshold; labels of held-out rows are not read."""
    prepared(spark)
    return toxicity.drop_toxic(docs, read(spark, sf_dir, "labels"))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group that the n-gram join links."""
    prepared(spark)
    groups = ngram_join.jaccard_groups(docs)
    kept = groups.filter(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    if docs.schema["doc_id"].nullable:
        return docs.join(kept.withColumnRenamed("doc_id", "_kept").hint("merge"), F.col("doc_id").eqNullSafe(F.col("_kept")), "left_semi")
    return docs.join(kept.hint("merge"), "doc_id", "left_semi")


def masked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with their secrets masked."""
    prepared(spark)
    return secrets.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mixing.repeat(docs, mixing.mix(docs))


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Tokens of each document, with digests of the ids and of the bytes they decode to."""
    prepared(spark)
    # In one stage each task would hold two Python workers, one that encodes and one that decodes.
    return bpe.digests(bpe.decode(stored(bpe.encode(docs), "ids")))


STAGES = [("toxicity", toxic), ("ngram_join", near_copies), ("secrets", masked), ("mixing", mixed), ("byte_bpe", encoded)]
#: A learned score and a tokenizer are no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, path = read(spark, sf_dir, "documents"), shared_dir(spark)
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{path}/{name}")
        docs = spark.read.parquet(f"{path}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
