"""Token counts through a digest cache.

A text is known by the digest of its normalised content, a tokenizer by the digest of its file. Counts
are stored under both; only contents without a stored count are encoded, once each, and then appended.

The normal form lower-cases A-Z and makes each run of white space one space. The tokenizer does the same, so counts
don't change; a text with combining marks (which join letters before the case is changed) or with ``<|`` (special
strings count as they are written) stands for itself.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import public_tokenizers
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .bpe import byte_characters
from .shared import lower_ascii, shared_dir, stored

CACHE = "tokenizer string, content binary, n_tokens bigint"
REMEMBERED, LONGEST = 600_000, 100
_SIMPLE = re.compile(rb"((?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,!?;:%&*#$|()\-]*)")


def normalised(text: Column) -> Column:
    plain = F.trim(F.regexp_replace(lower_ascii(text), r"[\x20\x09-\x0D]+", " "))
    return F.when(text.rlike(r"\p{M}|<\|"), text).otherwise(plain)


def content_digest(text: Column) -> Column:
    return F.unhex(F.sha2(normalised(F.coalesce(text, F.lit(""))), 256))


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


class PieceCounts(dict):
    """Tokens of a text's pieces between ASCII white space, which no token crosses."""

    def __init__(self, description: bytes, sentencepiece: bool):
        super().__init__()
        if sentencepiece:
            import sentencepiece as sp

            processor = sp.SentencePieceProcessor(model_proto=description)
            self.count = lambda data: len(processor.encode(data.decode("utf-8", "replace")))
            self.by_piece = False
            return
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use all cores
        self.tokenizer = Tokenizer.from_buffer(description)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.bytes = byte_characters()
        self.by_piece = True

    def library(self, data: bytes) -> int:
        return len(self.tokenizer.encode(data.decode("utf-8", "replace"), add_special_tokens=False))

    def __missing__(self, piece: bytes) -> int:
        simple = _SIMPLE.fullmatch(piece)
        if simple:  # letters and marks: what the library's normaliser and splitter make of them is known
            letters = simple[1].decode().lower().encode()
            parts = [p.decode() if p.isascii() else "".join(self.bytes[b] for b in p) for p in (letters, simple[2]) if p]
            n = sum(len(self.tokenizer.model.tokenize(p)) for p in parts)
        else:
            n = self.library(piece)
        if len(piece) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[piece] = n
        return n

    def of(self, data: bytes) -> int:
        return sum(map(self.__getitem__, data.split())) if self.by_piece else self.count(data)


_loaded: dict[str, PieceCounts] = {}


def encode_counts(texts: DataFrame, path: str, version: str) -> DataFrame:
    """(content, text as bytes) -> content, n_tokens."""
    with open(path, "rb") as f:
        description = f.read()
    sentencepiece = path.endswith(".model")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if version not in _loaded:
            _loaded.clear()
            _loaded[version] = PieceCounts(description, sentencepiece)
        counts = _loaded[version]
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                n = [counts.of(t) for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(n, type=pa.int64())], names=["content", "n_tokens"])

    return texts.mapInArrow(run, "content binary, n_tokens bigint")


def read_cache(spark, cache: str, version: str) -> DataFrame:
    try:
        table = spark.read.schema(CACHE).parquet(cache)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        table = spark.createDataFrame([], CACHE)
    return table.filter(F.col("tokenizer") == version).select("content", "n_tokens")


def count_tokens(docs: DataFrame, tokenizer: str | None = None, cache: str | None = None, limit: int = 2048) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit (n_tokens > limit) for each row of ``docs`` (doc_id, text).

    ``tokenizer``: a file of the tokenizers (.json) or sentencepiece (.model) library. ``cache``: a folder that all executors
    share; without one the counts of this call start empty. Other columns are ignored. Null text: empty, no tokens.
    Repeated rows and ids are counted each. An empty table gives no rows. Appending twice does no harm: counts of a content agree.
    """
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizers.path("word_bpe_49k.json")
    version = file_digest(tokenizer)
    cache = cache or f"{shared_dir(spark)}/token-counts"
    text = F.coalesce(F.col("text"), F.lit(""))
    content = F.unhex(F.sha2(text, 256)) if tokenizer.endswith(".model") else content_digest(text)
    keyed = stored(docs.select("doc_id", F.octet_length(text).cast("bigint").alias("n_bytes"), content.alias("content")), "digests")

    contents = keyed.groupBy("content").agg(F.min("doc_id").alias("sample"))
    known = read_cache(spark, cache, version).select("content").distinct()
    misses = stored(contents.join(known, "content", "left_anti"), "misses")
    # One document stands for each missing content. The misses grow with the input, so they are never broadcast.
    wanted = docs.select("doc_id", text.alias("text")).join(misses.hint("merge"), F.col("doc_id").eqNullSafe(F.col("sample")), "left_semi")
    fresh = encode_counts(wanted.select(content.alias("content"), text.cast("binary").alias("text")), tokenizer, version)
    fresh.groupBy("content").agg(F.max("n_tokens").alias("n_tokens")).select(
        F.lit(version).alias("tokenizer"), "content", "n_tokens").write.mode("append").parquet(cache)

    stored_counts = read_cache(spark, cache, version).groupBy("content").agg(F.max("n_tokens").alias("n_tokens"))
    counts = stored(contents.join(stored_counts, "content").select(F.col("content").alias("c_content"), "n_tokens"), "counts")
    return keyed.join(counts, F.col("content") == F.col("c_content")).select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
