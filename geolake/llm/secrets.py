"""Secret scans: all rules in one pass over the bytes, by one minimised automaton.

The automaton finds the stretches, from idle to idle, in which some rule can end; the exact spans
(leftmost, longest runs, none overlapping within a kind) are then taken from those stretches alone. No match can cross
an idle state, so nothing outside them can matter.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .automata import Automaton
from .shared import forget


class Rule(NamedTuple):
    kind: str
    pattern: str  # what the automaton looks for
    exact: bytes  # the span, in bytes
    group: int  # the part whose length counts
    least: int


# The kinds of the contract in their order, then well-known public token formats.
BASE = (
    # A count in a pattern multiplies the states; behind a rare beginning the exact step can do the counting.
    Rule("assign", r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=\-]+""",
         rb"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", rb"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", rb"[0-9a-f]+", 0, 24),
)
ADDED = (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", rb"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    Rule("jwt", r"eyJ[A-Za-z0-9_\-]+\.eyJ[A-Za-z0-9_\-]+\.[A-Za-z0-9_\-]+", rb"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 1),
)
RULES = BASE + ADDED
#: Bytes of text that one scan holds, and the length of its lanes where the text can be cut.
SCANNED, LANE = 1 << 22, 512


class Scanner:
    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        self.exact = [re.compile(r.exact) for r in rules]
        self.automaton = Automaton([r.pattern for r in rules])
        moves = self.automaton.moves.reshape(self.automaton.states, self.automaton.width)
        # After these bytes every state is idle, so a lane may begin behind them.
        self.resets = (moves == 0).all(axis=0)[self.automaton.columns]

    def stretches(self, texts: list[bytes]) -> list[tuple[int, int, int]]:
        """(text, first byte, end) of each stretch in which a rule ends."""
        sizes = np.array([len(t) for t in texts], dtype=np.int64)
        ends = np.cumsum(sizes)
        begins = ends - sizes
        data = np.frombuffer(b"".join(texts), dtype=np.uint8)
        if not len(data):
            return []
        # Lanes begin with each text and, about every LANE bytes, behind a byte that resets.
        free = np.flatnonzero(self.resets[data]) + 1
        wanted = np.arange(LANE, len(data), LANE)
        near = np.searchsorted(free, wanted)
        cuts = free[near[near < len(free)]] if len(free) else free
        starts = np.unique(np.concatenate([begins[sizes > 0], cuts[cuts < len(data)]]))
        lengths = np.diff(np.append(starts, len(data)))
        states = self.automaton.scan(data, starts, lengths)
        hits = np.flatnonzero(self.automaton.accepts[states])
        if not len(hits):
            return []
        text = np.searchsorted(ends, hits, side="right")
        # Idle places, with one before the first byte and one behind the last.
        idle = np.concatenate(([-1], np.flatnonzero(states == 0), [len(data)]))
        after = np.searchsorted(idle, hits)
        first, last = idle[after - 1] + 1, idle[after]
        found = np.unique(np.column_stack([text, np.maximum(first, begins[text]) - begins[text], np.minimum(last, ends[text]) - begins[text]]), axis=0)
        return list(map(tuple, found.tolist()))

    def spans(self, texts: list[bytes]) -> list[list[tuple[int, int, int]]]:
        """For each text (start, end, rule), in characters, by start and rule."""
        found: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for text, first, last in self.stretches(texts):
            data = texts[text]
            for k, (rule, exact) in enumerate(zip(self.rules, self.exact)):
                found[text] += [(m.start(), m.end(), k) for m in exact.finditer(data, first, last) if len(m[rule.group]) >= rule.least]
        for text, spans in enumerate(found):
            if spans and not texts[text].isascii():
                opened = np.concatenate(([0], np.cumsum((np.frombuffer(texts[text], dtype=np.uint8) & 0xC0) != 0x80)))
                spans[:] = [(int(opened[a]), int(opened[b]), k) for a, b, k in spans]
            spans.sort(key=lambda s: (s[0], s[2]))
        return found


_scanners: dict[tuple[Rule, ...], Scanner] = {}


def scanner(rules: tuple[Rule, ...]) -> Scanner:
    if rules not in _scanners:
        _scanners[rules] = Scanner(rules)
    return _scanners[rules]


def portions(texts: list[bytes], most: int = SCANNED) -> Iterator[slice]:
    """Runs of texts of about ``most`` bytes; a longer text stands alone."""
    at = size = 0
    for k, text in enumerate(texts):
        if size and size + len(text) > most:
            yield slice(at, k)
            at, size = k, 0
        size += len(text)
    if at < len(texts):
        yield slice(at, len(texts))


SPANS = "array<struct<kind: string, start: int, end: int>>"


def with_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES, name: str = "spans") -> DataFrame:
    """Adds ``name``: kind, start and end (exclusive; code points) of each secret in ``text``, by start and rule.

    Whole texts are read; a null text has no spans. Other columns stay, but for one called ``name``. Repeated rows
    are scanned each; an empty table gives no rows.
    """
    kinds = [r.kind for r in rules]
    kept = docs.select(*[F.col(f"`{c}`") for c in docs.columns if c.lower() != name.lower()])
    scanned = kept.withColumn("_scanned", F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    own = scanner(rules)  # built once, sent along with the task

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).to_pylist()
            for part in portions(texts):
                spans = [[{"kind": kinds[k], "start": a, "end": b} for a, b, k in s] for s in own.spans(texts[part])]
                rows = batch.slice(part.start, part.stop - part.start)
                yield pa.RecordBatch.from_arrays([*rows.columns[:-1], pa.array(spans, type=kind)], names=[*batch.schema.names[:-1], name])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema)
    return scanned.mapInArrow(run, f"{schema}, `{name}` {SPANS}")


def _is(kind: str):
    return lambda found: found == kind


def report(docs: DataFrame) -> DataFrame:
    """doc_id, a count for each kind of the base rules, and the spans as text."""
    found = with_spans(docs.select("doc_id", "text")).drop("text")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE]))
    shown = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = [F.size(F.filter(F.transform("spans", lambda s: s["kind"]), _is(r.kind))).cast("bigint").alias(f"n_{r.kind}") for r in BASE]
    return found.select("doc_id", *counts, F.sha2(shown(base), 256).alias("base_sha256"), shown(F.col("spans")).alias("spans"))


def redact(docs: DataFrame, mask: str = "[secret]") -> DataFrame:
    """The same rows and columns, each secret in ``text`` replaced by ``mask`` (overlapping spans by one); n_chars, where
    there is such a column, counts the new text of a changed row. Null texts stay null."""
    found = with_spans(docs, name="_spans")
    start = lambda s: s["start"]
    state = F.struct(F.lit("").alias("text"), F.lit(0).alias("at"))

    def join(done, span):
        fresh = span["start"] >= done["at"]
        text = F.when(fresh, F.concat(done["text"], F.substring(F.col("text"), done["at"] + 1, start(span) - done["at"]), F.lit(mask))).otherwise(done["text"])
        return F.struct(text.alias("text"), F.greatest(done["at"], span["end"]).alias("at"))

    def finish(done):
        return F.concat(done["text"], F.substring(F.col("text"), done["at"] + 1, F.length("text")))

    changed = F.size("_spans") > 0
    text = F.when(changed, F.aggregate("_spans", state, join, finish)).otherwise(F.col("text"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    out = found.withColumn("_text", text).withColumn("text", F.col("_text"))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(changed, F.length("text")).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)
