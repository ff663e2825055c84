"""Repeated passages by level-wise doubling.

A passage of ``window`` words repeats only if all shorter windows in it do. So short windows are looked up first, then those
twice as long, but only where the shorter ones repeat, until the wanted length is reached or no candidates survive. The hash
of a window is made of the hashes of its two halves. On each level a passage is represented by its least short window, by
hash: equal passages have the same one, and about one short window in ten needs to be looked up.

Documents are kept in blocks of coded words. A level sends the hashes of a block's windows, dealt into buckets by their
first bits, and gets a bit back for each; only the stretches that still may repeat go on to the next level.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .coding import Codes, packed, unpacked
from .shared import stored

WINDOW, FIRST = 35, 9
#: Words after which a block is closed (a longer document is a block of its own); hashes that a bucket holds about.
BLOCK, LOAD = 1 << 20, 1 << 18
BLOCKS = "block bigint, doc_id array<bigint>, starts array<bigint>, codes binary, wide int, words array<binary>"
#: Stretches of a block: where each begins in the block, their coded words end to end, hashes of the words that codes stand for.
WORK = "block bigint, at array<bigint>, starts array<bigint>, codes binary, wide int, hashes binary"


def levels(window: int, first: int = FIRST) -> list[int]:
    """Window lengths, each at most twice the one before: halves of ``window``, rounded up, down to about ``first``."""
    found = [window]
    while found[-1] > first:
        found.append((found[-1] + 1) // 2)
    return found[::-1]


def blocks(docs: DataFrame, size: int = BLOCK) -> DataFrame:
    """Documents (doc_id, text) as blocks of coded words; ``words`` is the block's own dictionary. Null text: no words."""
    schema = pa.schema([("block", pa.int64()), ("doc_id", pa.list_(pa.int64())), ("starts", pa.list_(pa.int64())),
                        ("codes", pa.binary()), ("wide", pa.int32()), ("words", pa.list_(pa.binary()))])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        codes, ids, texts, held = Codes(), [], [], 0

        def block() -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
            coded, wide = packed(np.concatenate(texts))
            return pa.RecordBatch.from_arrays([pa.array([v], type=f.type) for v, f in zip((number, ids, starts, coded, wide, list(codes)), schema)], schema=schema)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = text.as_py().split()
                ids.append(doc_id)
                texts.append(np.fromiter(map(codes.__getitem__, words), np.uint32, len(words)))
                held += len(words) + 1
                if held >= size:
                    yield block()
                    number += 1
                    codes, ids, texts, held = Codes(), [], [], 0
        if ids:
            yield block()

    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).cast("binary").alias("text")).mapInArrow(build, BLOCKS)


def _work(base: DataFrame) -> DataFrame:
    """The first stretches: whole documents."""

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, starts, codes, wide, words in zip(*batch.columns):
                hashes = np.array([xxhash.xxh3_64_intdigest(w) for w in words.as_py()], np.uint64)
                starts = starts.values.to_numpy()
                yield _row(block.as_py(), starts[:-1], starts, codes.as_py(), wide.as_py(), hashes.tobytes())

    return base.select("block", "starts", "codes", "wide", "words").mapInArrow(start, WORK)


def _row(block: int, at: np.ndarray, starts: np.ndarray, codes: bytes, wide: int, hashes: bytes) -> pa.RecordBatch:
    ints = pa.list_(pa.int64())
    return pa.RecordBatch.from_arrays(
        [pa.array([block]), pa.array([at], type=ints), pa.array([starts], type=ints), pa.array([codes], type=pa.binary()),
         pa.array([wide], type=pa.int32()), pa.array([hashes], type=pa.binary())], names=[f.split()[0] for f in WORK.split(", ")])


def window_hashes(words: np.ndarray, length: int) -> np.ndarray:
    """Hash of the window at each place, made of the hashes of two windows half as long, which may overlap by a word."""
    if length == 1:
        return words
    half = (length + 1) // 2
    halves = window_hashes(words, half)
    if len(halves) <= length - half:
        return halves[:0]
    left, right = halves[: len(halves) - (length - half)], halves[length - half :]
    mixed = left * np.uint64(0x9E3779B97F4A7C15) + (right ^ (right >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    mixed *= np.uint64(0x94D049BB133111EB)
    return mixed ^ (mixed >> np.uint64(31))


def _sliding(values: np.ndarray, length: int, best: np.ufunc) -> np.ndarray:
    """Least (or greatest) of ``length`` values from each place on."""
    span = 1
    while 2 * span <= length:
        values = best(values[:-span], values[span:])
        span *= 2
    return best(values[: len(values) - (length - span)], values[length - span :]) if span < length else values


class Stretches:
    """The passages of a row of WORK and the short windows that represent them on a level."""

    def __init__(self, starts: np.ndarray, codes: np.ndarray, hashes: np.ndarray, window: int, length: int, shift: int):
        self.starts, self.window, n = starts, window, len(codes)
        self.places = self.keys = np.zeros(0, np.int64)
        self.again = np.zeros(0, bool)
        if n < window:
            return
        short = window_hashes(hashes[codes], length) >> np.uint64(shift)
        short = np.maximum(short, np.uint64(1))  # zero stands for no window below
        reach = window - length + 1
        least = _sliding(short, reach, np.minimum)
        ends = np.repeat(starts[1:], np.diff(starts))
        whole = (ends - np.arange(n))[: n - window + 1] >= window
        self.places = np.flatnonzero(whole)
        if reach == 1:
            chosen = least[self.places]
        else:  # a short window is looked up where it is the least of some passage
            rim = np.zeros(reach - 1, np.uint64)
            greatest = _sliding(np.concatenate([rim, np.where(whole, least, np.uint64(0)), rim]), reach, np.maximum)
            chosen = short[greatest == short]
        self.keys, counts = np.unique(chosen, return_counts=True)
        self.again = counts > 1
        self.least = least[self.places]

    def surviving(self, elsewhere: np.ndarray) -> np.ndarray:
        """Places of passages whose short window occurs twice, here or in another block."""
        if not len(self.places):
            return self.places
        if not len(self.keys):
            return self.places[:0]
        at = np.minimum(np.searchsorted(self.keys, self.least), len(self.keys) - 1)
        return self.places[(self.again | elsewhere)[at] & (self.keys[at] == self.least)]

    def runs(self, places: np.ndarray) -> np.ndarray:
        """(from, to) of the words that passages at these places cover, cut at the ends of stretches."""
        n = int(self.starts[-1])
        edge = np.zeros(n + 1, np.int32)
        np.add.at(edge, places, 1)
        np.add.at(edge, places + self.window, -1)
        covered = np.cumsum(edge[:-1]) > 0
        first = np.zeros(n + 1, bool)
        first[self.starts] = True
        begins = covered & (first[:-1] | ~np.concatenate([[False], covered[:-1]]))
        stops = covered & (first[1:] | ~np.concatenate([covered[1:], [False]]))
        return np.stack([np.flatnonzero(begins), np.flatnonzero(stops) + 1], axis=1)


def _stretches(row: dict, window: int, length: int, shift: int) -> tuple[Stretches, np.ndarray]:
    codes = unpacked(row["codes"].as_py(), row["wide"].as_py())
    starts = row["starts"].values.to_numpy()
    return Stretches(starts, codes, np.frombuffer(row["hashes"].as_py(), np.uint64), window, length, shift), codes


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for values in zip(*batch.columns):
            yield dict(zip(batch.schema.names, values))


def _elsewhere(work: DataFrame, window: int, length: int, bits: int, width: int) -> DataFrame:
    """block, bits: for each hash a block sends, in ascending order, whether another block sends it too."""
    shift = 64 - bits - 8 * width if width < 8 else 0
    drop = 8 * width if width < 8 else 64 - bits
    kind = np.uint32 if width < 8 else np.uint64

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            keys = _stretches(row, window, length, shift)[0].keys.astype(np.uint64)
            if len(keys):
                bucket = (keys >> np.uint64(drop)).astype(np.int64)
                cuts = np.concatenate([[0], np.flatnonzero(np.diff(bucket)) + 1, [len(keys)]])
                values = [keys[a:b].astype(kind).tobytes() for a, b in zip(cuts, cuts[1:])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket[cuts[:-1]]), pa.array([row["block"].as_py()] * len(values)), pa.array(values, type=pa.binary())], names=["bucket", "block", "keys"])

    def meet(table: pa.Table) -> pa.Table:
        sent = [np.frombuffer(k.as_py(), kind) for k in table.column("keys")]
        _, at, counts = np.unique(np.concatenate(sent), return_inverse=True, return_counts=True)
        twice = np.split(counts[at] > 1, np.cumsum([len(s) for s in sent])[:-1])
        return pa.table({"block": table.column("block"), "bucket": table.column("bucket"), "n": pa.array([len(t) for t in twice], type=pa.int32()),
                         "bits": pa.array([np.packbits(t).tobytes() for t in twice], type=pa.binary())})

    sent = work.mapInArrow(send, "bucket bigint, block bigint, keys binary")
    met = sent.groupBy("bucket").applyInArrow(meet, "block bigint, bucket bigint, n int, bits binary")
    return met.groupBy(F.col("block").alias("_block")).agg(F.sort_array(F.collect_list(F.struct("bucket", "n", "bits"))).alias("told"))


def _narrow(work: DataFrame, told: DataFrame, window: int, length: int, shift: int) -> DataFrame:
    """The stretches whose passages survive a level."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            held, codes = _stretches(row, window, length, shift)
            answers = [np.unpackbits(np.frombuffer(t["bits"], np.uint8), count=t["n"]) for t in row["told"].as_py()]
            runs = held.runs(held.surviving(np.concatenate(answers).astype(bool)))
            if not len(runs):
                continue
            starts, at = held.starts, row["at"].values.to_numpy()
            within = np.searchsorted(starts, runs[:, 0], side="right") - 1
            lengths = runs[:, 1] - runs[:, 0]
            inside = np.repeat(runs[:, 0] - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
            used, codes = np.unique(codes[inside], return_inverse=True)
            coded, wide = packed(codes)
            hashes = np.frombuffer(row["hashes"].as_py(), np.uint64)[used]
            yield _row(row["block"].as_py(), at[within] + runs[:, 0] - starts[within], np.concatenate([[0], np.cumsum(lengths)]), coded, wide, hashes.tobytes())

    return work.join(told, F.col("block") == F.col("_block")).drop("_block").mapInArrow(cut, WORK)


def repeated(base: DataFrame, window: int = WINDOW, first: int = FIRST) -> DataFrame:
    """block, at, starts: stretches of blocks (see ``blocks``) that passages of ``window`` words cover which occur twice or more.

    Windows are told apart by hashes: of 64 bits on the last level, of fewer on the levels that only find candidates.
    """
    words = base.agg(F.sum(F.element_at("starts", -1))).first()[0] or 0
    bits = min(32, max(6, math.ceil(math.log2(max(1, words) / LOAD))))
    work = _work(base)
    chain = levels(window, first)
    for length in chain:
        last = length == chain[-1]
        told = _elsewhere(work, window, length, bits, 8 if last else 4)
        work = stored(_narrow(work, told, window, length, 0 if last else 64 - bits - 32), f"level-{length}")
        if work.isEmpty():
            break
    return work.select("block", "at", "starts")


def without_repeats(docs: DataFrame, window: int = WINDOW, first: int = FIRST, block: int = BLOCK) -> DataFrame:
    """doc_id, n_words, n_removed, text for each row of ``docs`` (doc_id, text): the words left, joined by one space.

    Each word goes that lies in a window of ``window`` words whose words also occur in this order elsewhere, in the same document or
    another; all copies go. Windows are judged on the input. Null and empty texts: no words, empty text. Repeated rows and
    ids are documents of their own, null ids stay null, other columns are ignored. An empty table gives no rows.
    """
    base = stored(blocks(docs, block), "blocks")
    spans = repeated(base, window, first).withColumnsRenamed({"block": "_block", "starts": "lengths"})

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in _rows(batches):
            codes, starts = unpacked(row["codes"].as_py(), row["wide"].as_py()), row["starts"].values.to_numpy()
            keep = np.ones(len(codes) + 1, bool)
            if row["at"].is_valid:
                at, lengths = row["at"].values.to_numpy(), np.diff(row["lengths"].values.to_numpy())
                for a, n in zip(at, lengths):
                    keep[a : a + n] = False
            left = np.concatenate([[0], np.cumsum(keep[:-1])])[starts]
            words, kept = row["words"].as_py(), codes[keep[:-1]]
            size = np.diff(starts)
            for k in range(0, len(size), 256):
                part = range(k, min(k + 256, len(size)))
                texts = [b" ".join(map(words.__getitem__, kept[left[i] : left[i + 1]].tolist())) for i in part]
                some = slice(k, k + 256)
                yield pa.RecordBatch.from_arrays(
                    [row["doc_id"].values[some], pa.array(size[some]), pa.array((size - np.diff(left))[some]), pa.array(texts, type=pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "text"])

    both = base.join(spans, F.col("block") == F.col("_block"), "left").drop("_block")
    return both.mapInArrow(clean, "doc_id bigint, n_words bigint, n_removed bigint, text string")
