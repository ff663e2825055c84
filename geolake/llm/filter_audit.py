"""How five document filters interact, read off a sparse document-term matrix.

Tasks count the words of their documents into CSR shards with a dictionary of their own, ordered by a hash. The shards'
dictionaries meet in buckets of that hash, where distinct words get their numbers, and each shard takes over the numbers of
its words, so a column is one word in all shards. Row sums
and numbers of nonzeros then decide the length and variety filters; characters and copies decide the others. A document is
from there on a set of failed filters, of which there are 32, so any order of the filters is a sum over 32 counts.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .coding import packed, unpacked
from .shared import stored

#: Filters in the order of their bits: length, variety, capitals, symbols, copies.
FILTERS = "ABCDE"
LEAST_WORDS, LEAST_VARIETY, MOST_CAPITALS = 200, 50, 3
#: Bytes of text in a shard (a longer document is a shard of its own); words of shards that meet in a bucket, about.
TEXT, LOAD = 1 << 23, 1 << 16

UPPER, SYMBOLS, CONTINUATION = bytes(range(65, 91)), b"#$%&*|", bytes(range(0x80, 0xC0))
SHARD = (
    "shard bigint, doc_id array<bigint>, part array<string>, digest array<binary>, failed array<int>, "
    "starts array<bigint>, columns binary, wide int, counts binary, counted int, n_words bigint, words binary, lengths binary, long int"
)
MATRIX = (
    "shard bigint, doc_id array<bigint>, part array<string>, digest array<binary>, failed array<int>, "
    "starts array<bigint>, columns binary, wide int, counts binary, counted int"
)


def characters_failed(text: bytes) -> int:
    """Bits of the capitals and the symbols filter."""
    points = len(text.translate(None, CONTINUATION))
    capitals = len(text) - len(text.translate(None, UPPER))
    symbols = len(text.translate(None, SYMBOLS)) < len(text)
    return 4 * (100 * capitals > MOST_CAPITALS * points) + 8 * symbols


def word_array(data: bytes, lengths: np.ndarray) -> pa.Array:
    """Words that lie end to end."""
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int64)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])


def word_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of words, end to end, and their lengths."""
    words = words.cast(pa.large_binary())
    offsets = np.frombuffer(words.buffers()[1], np.int64)[words.offset : words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, np.diff(offsets)


def word_hashes(data: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A 32-bit hash of each word. It only deals words into buckets, where they are told apart by their bytes."""
    if not len(lengths):
        return np.zeros(0, np.uint32)
    starts = np.cumsum(lengths) - lengths
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(lengths.max()), 0x9E3779B97F4A7C15, np.uint64))
        sums = np.add.reduceat((data.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(data)) - np.repeat(starts, lengths)], starts)
        mixed = (sums ^ (sums >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(32)).astype(np.uint32)


def _slices(batch: pa.RecordBatch, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch whose texts (column text) have about ``size`` bytes."""
    upto = np.cumsum(pc.binary_length(batch.column("text")).to_numpy(zero_copy_only=False).astype(np.int64) + 1)
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(upto, (upto[at - 1] if at else 0) + size, side="right")))
        yield batch.slice(at, end - at)
        at = end


def shards(docs: DataFrame, size: int = TEXT) -> DataFrame:
    """CSR shards whose columns are numbers in the shard's own dictionary ``words``, ordered by a hash and laid end to end.

    A word is a run of characters other than the six of ASCII white space. A null text is empty.
    """

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = {"doc_id": pa.int64(), "part": pa.string(), "digest": pa.binary(), "failed": pa.int32(), "starts": pa.int64()}
        plain = {"shard": pa.int64(), "wide": pa.int32(), "counted": pa.int32(), "n_words": pa.int64(), "long": pa.int32()}
        names = [f.split()[0] for f in SHARD.split(", ")]
        schema = pa.schema([(n, pa.list_(lists[n]) if n in lists else plain.get(n, pa.binary())) for n in names])
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for some in _slices(batch, size):
                texts = some.column("text").cast(pa.large_string())
                held = [t.as_buffer().to_pybytes() for t in texts]
                found = pc.ascii_split_whitespace(texts)
                whole = found.flatten()
                real = pc.binary_length(whole).to_numpy(zero_copy_only=False) > 0
                rows = np.repeat(np.arange(len(found)), pc.list_value_length(found).to_numpy(zero_copy_only=False))[real]
                coded = whole.filter(pa.array(real)).dictionary_encode()
                data, lengths = word_bytes(coded.dictionary)
                order = np.argsort(word_hashes(data, lengths), kind="stable")
                place = np.empty(len(order), np.int64)
                place[order] = np.arange(len(order))
                data, lengths = word_bytes(coded.dictionary.take(pa.array(order)))
                cells = (rows << 32) | place[coded.indices.to_numpy(zero_copy_only=False)]
                cells.sort()
                first = np.flatnonzero(np.diff(cells, prepend=-1))
                counts, cells = np.diff(np.append(first, len(cells))), cells[first]
                (columns, wide), (often, counted), (long, width) = packed(cells & 0xFFFFFFFF), packed(counts), packed(lengths)
                row = {
                    "shard": number, "doc_id": some.column("doc_id"), "part": some.column("part"),
                    "digest": [hashlib.blake2b(t, digest_size=16).digest() for t in held], "failed": [characters_failed(t) for t in held],
                    "starts": np.searchsorted(cells >> 32, np.arange(len(found) + 1)), "columns": columns, "wide": wide,
                    "counts": often, "counted": counted, "n_words": len(lengths), "words": data.tobytes(), "lengths": long, "long": width}
                del found, whole, coded, data, cells, counts, rows, place, held
                yield pa.RecordBatch.from_arrays([pa.array([row[f.name]], type=f.type) for f in schema], schema=schema)
                pa.default_memory_pool().release_unused()
                number += 1

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text")).mapInArrow(build, SHARD)


def numbered(own: DataFrame) -> DataFrame:
    """shard, bucket, ids, width: the numbers of a shard's words, in their order, from the dictionary of all shards.

    A bucket takes the words whose hash begins with its bits and numbers the distinct ones in their order, in steps of the number
    of buckets; so equal words get equal numbers, others different ones, and there are hardly more numbers than words.
    """
    total = own.agg(F.sum("n_words")).first()[0] or 0
    bits = min(31, max(6, math.ceil(math.log2(max(1, total) / LOAD))))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, words, lengths, width in zip(*(c.to_pylist() for c in batch.columns)):
                data, lengths = np.frombuffer(words, np.uint8), unpacked(lengths, width)
                if not len(lengths):
                    continue
                bucket = (word_hashes(data, lengths) >> np.uint32(32 - bits)).astype(np.int64)
                first = np.flatnonzero(np.diff(bucket, prepend=-1))
                cuts, ends = np.append(first, len(bucket)), np.append(0, np.cumsum(lengths))
                yield pa.RecordBatch.from_arrays([
                    pa.array(bucket[first]), pa.array(np.full(len(first), shard)),
                    pa.array([words[ends[a] : ends[z]] for a, z in zip(cuts, cuts[1:])], type=pa.binary()),
                    *(pa.array(x, type=t) for x, t in zip(zip(*(packed(lengths[a:z]) for a, z in zip(cuts, cuts[1:]))), (pa.binary(), pa.int32())))],
                    names=["bucket", "shard", "words", "lengths", "long"])

    def meet(table: pa.Table) -> pa.Table:
        lengths = [unpacked(x.as_py(), w.as_py()) for x, w in zip(table.column("lengths"), table.column("long"))]
        words = word_array(b"".join(table.column("words").to_pylist()), np.concatenate(lengths)).dictionary_encode()
        rank = np.empty(len(words.dictionary), np.int64)
        rank[pc.array_sort_indices(words.dictionary).to_numpy()] = np.arange(len(rank))
        ids = table.column("bucket")[0].as_py() + (1 << bits) * rank[words.indices.to_numpy()]
        told, width = zip(*(packed(x) for x in np.split(ids, np.cumsum([len(x) for x in lengths])[:-1])))
        return pa.table({"shard": table.column("shard"), "bucket": table.column("bucket"), "ids": pa.array(told, type=pa.binary()), "width": pa.array(width, type=pa.int32())})

    sent = own.select("shard", "words", "lengths", "long").mapInArrow(send, "bucket bigint, shard bigint, words binary, lengths binary, long int")
    return sent.groupBy("bucket").applyInArrow(meet, "shard bigint, bucket bigint, ids binary, width int")


def matrix(docs: DataFrame, size: int = TEXT) -> DataFrame:
    """The document-term matrix as CSR shards: ``starts``, ``columns`` (ids of the global dictionary, ascending in a row), ``counts``.

    Columns and counts are unsigned numbers of ``wide`` and ``counted`` bytes.
    """
    own = stored(shards(docs, size), "shards")
    ids = numbered(own).groupBy(F.col("shard").alias("_shard")).agg(F.sort_array(F.collect_list(F.struct("bucket", "ids", "width"))).alias("ids"))
    both = own.drop("words", "lengths", "long", "n_words").join(ids, F.col("shard") == F.col("_shard"), "left").drop("_shard")

    def renumber(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                told = row.column("ids")[0].as_py() or ()
                ids = np.concatenate([np.zeros(0, np.int64), *(unpacked(t["ids"], t["width"]) for t in told)])
                starts = row.column("starts")[0].values.to_numpy()
                columns = ids[unpacked(row.column("columns")[0].as_py(), row.column("wide")[0].as_py())]
                counts = unpacked(row.column("counts")[0].as_py(), row.column("counted")[0].as_py())
                rows = np.repeat(np.arange(len(starts) - 1), np.diff(starts))
                order = np.lexsort((columns, rows)) if len(columns) and columns.max() >> 32 else np.argsort((rows << 32) | columns)
                kept = [row.column(c) for c in ("shard", "doc_id", "part", "digest", "failed", "starts")]
                data = [pa.array([x], type=t) for v in (columns, counts) for x, t in zip(packed(v[order]), (pa.binary(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([*kept, *data], names=[f.split()[0] for f in MATRIX.split(", ")])

    return both.mapInArrow(renumber, MATRIX)


def row_flags(csr: DataFrame) -> DataFrame:
    """doc_id, part, digest, n_words, n_distinct, failed: row sums, nonzeros and the bits of filters A to D of each document."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                starts = row.column("starts")[0].values.to_numpy()
                counts = unpacked(row.column("counts")[0].as_py(), row.column("counted")[0].as_py())
                upto = np.concatenate([[0], np.cumsum(counts)])
                total, distinct = upto[starts[1:]] - upto[starts[:-1]], np.diff(starts)
                failed = row.column("failed")[0].values.to_numpy() + (total < LEAST_WORDS) + 2 * (100 * distinct < LEAST_VARIETY * total)
                lists = [row.column(c)[0].values for c in ("doc_id", "part", "digest")]
                yield pa.RecordBatch.from_arrays(
                    [*lists, pa.array(total.astype(np.int64)), pa.array(distinct.astype(np.int64)), pa.array(failed.astype(np.int32))],
                    names=["doc_id", "part", "digest", "n_words", "n_distinct", "failed"])

    return csr.mapInArrow(read, "doc_id bigint, part string, digest binary, n_words bigint, n_distinct bigint, failed int")


def failures(docs: DataFrame, size: int = TEXT) -> DataFrame:
    """doc_id, part, n_words, n_distinct, failed for each row of ``docs``: the bits of all five filters."""
    flags = stored(row_flags(matrix(docs, size)), "flags")
    copied = flags.groupBy("digest").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")).filter("copies > 1")
    copied = copied.select(F.col("digest").alias("_digest"), "least")
    copy = F.coalesce(F.col("doc_id") > F.col("least"), F.lit(False)).cast("int") * 16
    return flags.join(copied, F.col("digest") == F.col("_digest"), "left").select("doc_id", "part", "n_words", "n_distinct", (F.col("failed") + copy).alias("failed"))


def orders() -> list[dict]:
    """All orders of the filters, a row per step: the bits of the earlier filters and of the step's own."""
    bit = {f: 1 << k for k, f in enumerate(FILTERS)}
    return [
        {"filter_order": "".join(p), "step": k + 1, "before": sum(bit[f] for f in p[:k]), "own": bit[p[k]]}
        for p in itertools.permutations(FILTERS) for k in range(len(FILTERS))]


def audit(docs: DataFrame, labels: DataFrame, size: int = TEXT) -> DataFrame:
    """What each filter does at each step of each order, for each language (``part``; null: empty).

    ``docs``: doc_id, text, lang; ``labels``: doc_id, quality, toxic; other columns are ignored. Null text: empty, so it fails
    by length, and as a copy of any other empty text. A null doc_id has no smaller or larger one: it is no copy, makes none and has no label.
    Rows that repeat a doc_id count each and are no copies of each other. Of several labels of a doc_id any 1 counts. An empty table gives no rows.
    """
    marks = labels.filter("doc_id is not null").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("bad"))
    marked = failures(docs, size).join(marks, F.col("doc_id") == F.col("_id"), "left")
    sets = marked.groupBy("part", "failed").agg(
        F.count("*").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    sets = sets.groupBy("part").agg(F.collect_list(F.struct("failed", "n", "good", "bad")).alias("sets"))
    steps = F.from_json(F.lit(json.dumps(orders())), "array<struct<filter_order:string,step:int,before:int,own:int>>")
    told = sets.select("part", "sets", F.inline(steps))
    before, own = F.col("before"), F.col("own")

    def total(kept, value=lambda s: s["n"]) -> Column:
        return F.aggregate(F.filter("sets", kept), F.lit(0).cast("bigint"), lambda t, s: t + value(s))

    def fails(s: Column, bits: Column) -> Column:
        return s["failed"].bitwiseAND(bits) != 0

    removed = lambda s: fails(s, own) & ~fails(s, before)
    # Of a document that fails k filters each of them is first in one of k orders.
    return told.select(
        "part", "filter_order", "step",
        total(lambda s: ~fails(s, before.bitwiseOR(own))).alias("kept"),
        total(removed).alias("removed"),
        total(lambda s: fails(s, own) & fails(s, before)).alias("redundant"),
        total(lambda s: s["failed"] == own).alias("unique_fails"),
        total(removed, lambda s: s["good"]).alias("good_lost"),
        total(removed, lambda s: s["bad"]).alias("toxic_lost"),
        total(lambda s: fails(s, own), lambda s: s["n"] * F.floor(F.lit(120) / F.bit_count(s["failed"]))).alias("shapley"),
    )
