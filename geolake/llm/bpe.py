"""Byte-level BPE encoding and decoding with the tokenizers library, over Arrow batches.

Rank files list byte strings. The library works on characters, so each byte stands for one character: the
printable ones for themselves, the others for the characters from 256 on. Every pair of
tokens that joins into a third is a merge, in the order of the third's rank; a piece that is a token needs none.

Text falls into units at spaces where no match of the split pattern can cross; a unit always gives
the same ids, so each task remembers them for the units it has met, up to a bound.
"""

from __future__ import annotations

import base64
import os
import re
from array import array
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import kept

#: Units that a task remembers before it starts over, and the longest one it remembers.
REMEMBERED, LONGEST = 600_000, 100
#: White space beyond ASCII, and the separators that some engines count as such.
_OTHER_SPACE = re.compile(rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1(?:\x9a\x80|\xa0\x8e)|\xe2\x80[\x80-\x8d\xa8\xa9\xaf]|\xe2\x81[\x9f\xa0]|\xe3\x80\x80|\xef\xbb\xbf")
#: The bytes that such a character begins with; a text without any need not be searched.
_OTHER_LEADS = bytes([0x1C, 0x1D, 0x1E, 0x1F, 0xC2, 0xE1, 0xE2, 0xE3, 0xEF])
#: A space inside a longer run of white space, where cutting at every space would cut a match.
_INNER_SPACE = re.compile(rb"[\x20\t-\r]\x20(?:[\x20\t-\r]|\Z)")
_UNIT = re.compile(rb"[\x20\t-\r]*[^\x20\t-\r]+|[\x20\t-\r]+")
#: Pieces that need no pattern: letters of ASCII and Latin-1 after at most one space, marks, and the same again on a next line.
_LETTERS, _MARKS = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+", rb"[.,!?;:%&*#$|()\-]*"
_SIMPLE = re.compile(rb"( ?" + _LETTERS + rb")(" + _MARKS + rb")(?:(\n)(" + _LETTERS + rb")(" + _MARKS + rb"))?")


def byte_characters() -> dict[int, str]:
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {b: chr(b) for b in printable} | {b: chr(256 + n) for n, b in enumerate(others)}


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def tokenizer_json(ranks: dict[bytes, int], pattern: str) -> str:
    """The library's own description of a tokenizer that encodes by ranks."""
    from tokenizers import Regex, Tokenizer, models, pre_tokenizers

    shown = byte_characters()
    text = {token: "".join(shown[b] for b in token) for token in ranks}
    merges = []
    for token in sorted(ranks, key=ranks.get):
        halves = [(token[:i], token[i:]) for i in range(1, len(token))]
        known = [h for h in halves if h[0] in ranks and h[1] in ranks]
        merges += [(text[a], text[b]) for a, b in sorted(known, key=lambda h: (ranks[h[0]], ranks[h[1]]))]
    tokenizer = Tokenizer(models.BPE({text[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
    tokenizer.pre_tokenizer = pre_tokenizers.Sequence([
        pre_tokenizers.Split(Regex(pattern), "isolated"), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
    return tokenizer.to_str()


def load(description: str):
    from tokenizers import Tokenizer

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks already use all cores
    return Tokenizer.from_str(description)


class UnitIds(dict):
    """Unit -> its ids as packed 32-bit numbers; what is missing is encoded and, within bounds, remembered."""

    def __init__(self, description: str):
        super().__init__()
        self.tokenizer = load(description)
        self.met: dict[bytes, bytes] = {}
        self.table = np.array([byte_characters()[b] for b in range(256)])

    def shown(self, piece: bytes) -> str:
        return piece.decode() if piece.isalpha() and piece.isascii() else "".join(self.table[list(piece)])

    def marks(self, piece: bytes) -> bytes:
        if piece not in self.met:
            self.met[piece] = array("i", [t.id for t in self.tokenizer.model.tokenize(self.shown(piece))]).tobytes() if len(piece) < 4 else self.whole(piece)
            if len(self.met) > 10_000:
                return self.met.pop(piece)
        return self.met[piece]

    def whole(self, data: bytes) -> bytes:
        return np.array(self.tokenizer.encode(data.decode("utf-8", "replace"), add_special_tokens=False).ids, dtype=np.int32).tobytes()

    def __missing__(self, unit: bytes) -> bytes:
        simple = _SIMPLE.fullmatch(unit)
        if simple is None:
            ids = self.whole(unit)
        elif simple[1] == unit:
            ids = array("i", [t.id for t in self.tokenizer.model.tokenize(self.shown(unit))]).tobytes()
        else:  # words recur with other marks behind them
            ids = b"".join([self.marks(piece) if k in (1, 2, 4) else self[piece] for k, piece in enumerate(simple.groups()) if piece])
        if len(unit) <= LONGEST:
            if len(self) >= REMEMBERED:
                self.clear()
            self[unit] = ids
        return ids

    def encode(self, data: bytes) -> bytes:
        if len(data.translate(None, _OTHER_LEADS)) < len(data) and _OTHER_SPACE.search(data):
            return self.whole(data)
        if _INNER_SPACE.search(data):
            units = _UNIT.findall(data)
        else:
            first, *rest = data.split(b" ")
            units = ([first] if first else []) + [b" " + r for r in rest]
        return b"".join(map(self.__getitem__, units))


def unit_ids(description: str) -> UnitIds:
    """One for each worker process, which serves many tasks."""
    return kept(("units", description), lambda: UnitIds(description))


def character_offsets(ids: np.ndarray, data: bytes, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and behind-last character of each token; tokens that share a split character both hold it."""
    ends = np.cumsum(lengths[ids])
    starts = ends - lengths[ids]
    opened = np.concatenate(([0], np.cumsum((np.frombuffer(data, dtype=np.uint8) & 0xC0) != 0x80)))
    return (opened[starts + 1] - 1).astype(np.int32), opened[ends].astype(np.int32)


def lists(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    values = np.concatenate(parts) if parts else np.empty(0, dtype=np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.astype(np.int32)))


def encode(docs: DataFrame, ranks_path: str | None = None, pattern: str = public_tokenizers.PATTERN, offsets: bool = False, rows: int = 256) -> DataFrame:
    """(doc_id, text) -> doc_id, ids; with ``offsets`` also starts and ends of each token in characters.

    Other columns are ignored. A null text is empty and an empty text has no ids; repeated rows are encoded each.
    Special strings are ordinary text. An empty table gives no rows. Texts are encoded whole, ``rows`` at a time.
    """
    ranks = read_ranks(ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    description = tokenizer_json(ranks, pattern)
    lengths = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, rank in ranks.items():
        lengths[rank] = len(token)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = unit_ids(description)
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                texts = part.column(1).to_pylist()
                ids = [np.frombuffer(units.encode(t), dtype=np.int32) for t in texts]
                columns = [part.column(0), lists(ids)]
                if offsets:
                    spans = [character_offsets(i, t, lengths) for i, t in zip(ids, texts)]
                    columns += [lists([s[0] for s in spans]), lists([s[1] for s in spans])]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "ids", "starts", "ends"][: len(columns)])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, ids array<int>" + ", starts array<int>, ends array<int>" * offsets
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")).mapInArrow(run, schema)


def decode(encoded: DataFrame, ranks_path: str | None = None, rows: int = 256) -> DataFrame:
    """Adds ``decoded``: the bytes of ``ids``, through the table of tokens; a character split between tokens
    is whole again once its bytes stand together. Null ids give null; other columns stay. Unknown ids are an error.
    """
    ranks = read_ranks(ranks_path or public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    shown = byte_characters()
    hidden = {c: b for b, c in shown.items()}
    vocabulary = [""] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        vocabulary[rank] = "".join(shown[b] for b in token)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.array([bytes(hidden[c] for c in token) or None for token in vocabulary], type=pa.binary())
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids = part.column("ids")
                tokens = table.take(ids.flatten())
                if tokens.null_count:
                    raise ValueError("an id without a token")
                # Tokens lie end to end, so the bytes of a row are a stretch of theirs.
                ends = np.concatenate(([0], np.cumsum(pc.binary_length(tokens).to_numpy(zero_copy_only=False), dtype=np.int64)))
                behind = np.concatenate(([0], np.cumsum(pc.fill_null(pc.list_value_length(ids), 0).to_numpy(zero_copy_only=False), dtype=np.int64)))
                offsets = pa.py_buffer(ends[behind].astype(np.int32))
                decoded = pa.BinaryArray.from_buffers(pa.binary(), len(ids), [None, offsets, tokens.buffers()[2] or pa.py_buffer(b"")])
                if ids.null_count:
                    decoded = pc.if_else(ids.is_valid(), decoded, pa.scalar(None, pa.binary()))
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names=[*part.schema.names, "decoded"])

    columns = [c for c in encoded.columns if c.lower() != "decoded"]
    rest = encoded.select(*[F.col(f"`{c}`") for c in columns])
    return rest.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema) + ", decoded binary")


def digests(decoded: DataFrame) -> DataFrame:
    ids = F.array_join(F.transform("ids", lambda i: i.cast("string")), ",")
    return decoded.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
