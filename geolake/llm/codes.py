"""Vector codes: each vector's parts are replaced by the numbers of their nearest codebook entries (product quantisation).

Codebooks are fitted by Lloyd's rounds with adaptive distance bounds. Each part keeps, from one round to the next, the entry
it belongs to, its b next closest entries with lower bounds of their distances in ascending order, and one outer bound
for all others. When entries move the bounds shrink by as much, and a part whose entry is closer than a bound needs no look at
anything beyond that bound. Bounds are floats rounded down; whatever they leave open is decided with whole numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import stored

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Largest component, scaled, whose squared distances stay whole in 64 bits.
LARGEST = 1 << 26
#: Relative slack of float bounds, and the share of parts that the kept entries should decide.
SLACK, DECIDED = 1e-6, 0.98
STATE = "vec_id bigint, label int, vec array<bigint>, own binary, near binary, bounds binary, outer binary"


def cuts(dimension: int, parts: int) -> list[int]:
    """Where parts begin and end: equal ones, or where the dimension is no multiple, ones that differ by a component."""
    return [k * dimension // parts for k in range(parts + 1)]


def whole(vectors: DataFrame, scale: int = SCALE) -> DataFrame:
    """vec_id, label, vec: the sound rows with components floor(scale * x).

    Rows go whose vector is null, empty or holds null or non-finite components. Raises where a scaled component is LARGEST or more.
    """
    doubles = F.col("embedding").cast("array<double>")
    sound = F.coalesce(F.size("embedding") > 0, F.lit(False)) & F.coalesce(F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))
    scaled = F.transform(doubles, lambda x: F.floor(x * scale))
    fits = F.forall(doubles, lambda x: F.abs(x * scale) < LARGEST)
    checked = F.when(fits, scaled).otherwise(F.raise_error(F.lit(f"a component times {scale} is {LARGEST} or more")).cast("array<bigint>"))
    return vectors.filter(sound).select(F.col("vec_id").cast("bigint").alias("vec_id"), "label", checked.alias("vec"))


def first_entries(kept: DataFrame, entries: int) -> list[list[int]]:
    """The vectors of the smallest vec_ids, ascending (null last); equal ids by vector. Only ids are ranked first."""
    order = (F.col("vec_id").asc_nulls_last(), "vec")
    least = kept.select("vec_id").orderBy(order[0]).limit(entries).agg(F.max("vec_id").alias("last"), F.count("vec_id").alias("n")).first()
    some = kept if least["n"] < entries else kept.filter(F.col("vec_id") <= least["last"])
    return [r.vec for r in some.orderBy(*order).limit(entries).select("vec").collect()]


class Codebooks:
    """The entries of each part, as whole numbers, and the squared distances to them."""

    def __init__(self, entries: np.ndarray, edges: list[int]):
        self.entries, self.edges, self.parts = entries, edges, len(edges) - 1

    def distances(self, vecs: np.ndarray, part: int) -> np.ndarray:
        """Squared distances of the part of all vectors to all its entries."""
        a, b = self.edges[part], self.edges[part + 1]
        total = np.zeros((len(vecs), len(self.entries)), np.int64)
        for c in range(a, b):
            gap = vecs[:, c, None] - self.entries[None, :, c]
            total += gap * gap
        return total

    def some(self, vecs: np.ndarray, part: int, which: np.ndarray) -> np.ndarray:
        """Squared distances of the part of each vector to the entries named for it."""
        a, b = self.edges[part], self.edges[part + 1]
        gap = vecs[:, None, a:b] - self.entries[which, a:b]
        return (gap * gap).sum(axis=2)

    def moves(self, before: Codebooks) -> np.ndarray:
        """Upper bounds of how far each entry of each part has moved."""
        gap = self.entries - before.entries
        square = np.add.reduceat(gap * gap, self.edges[:-1], axis=1) if gap.shape[1] >= self.parts else np.zeros((len(gap), self.parts))
        return np.sqrt(square.astype(np.float64)) * (1 + SLACK)

    def digest(self) -> str:
        """Of all components, by part, entry and position in the part."""
        told = [str(x) for a, b in zip(self.edges, self.edges[1:]) for entry in self.entries[:, a:b] for x in entry]
        return hashlib.sha256(",".join(told).encode()).hexdigest()


def _below(squares: np.ndarray) -> np.ndarray:
    """Distances rounded down, as 32-bit floats."""
    return np.nextafter((np.sqrt(squares.astype(np.float64)) * (1 - SLACK)).astype(np.float32), np.float32(-np.inf))


def fresh(books: Codebooks, vecs: np.ndarray, part: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(own, near, bounds, outer) of a part by comparison with all entries: ties go to the lower number."""
    squares = books.distances(vecs, part)
    order = np.argsort(squares, axis=1, kind="stable")[:, : b + 2]
    near = _below(np.take_along_axis(squares, order, 1))
    outer = near[:, b + 1] if order.shape[1] > b + 1 else np.full(len(vecs), np.inf, np.float32)
    own, rest, bounds = order[:, 0], order[:, 1 : b + 1], near[:, 1 : b + 1]
    if rest.shape[1] < b:  # fewer entries than b + 1: no entry stands beyond the ones there are
        gap = ((0, 0), (0, b - rest.shape[1]))
        rest, bounds = np.pad(rest, gap), np.pad(bounds, gap, constant_values=np.inf)
    return own, rest, bounds, outer


def moved(near: np.ndarray, bounds: np.ndarray, outer: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bounds after entries have moved, put in ascending order from the outer one inwards."""
    bounds, outer = bounds - moves[near], outer - moves.max()
    if bounds.shape[1]:
        ordered = np.minimum.accumulate(np.concatenate([bounds, outer[:, None]], axis=1)[:, ::-1], axis=1)[:, ::-1]
        bounds = ordered[:, :-1]
    down = lambda x: np.nextafter(x.astype(np.float32), np.float32(-np.inf))
    return down(bounds), down(outer)


def again(books: Codebooks, vecs: np.ndarray, part: int, own: np.ndarray, near: np.ndarray, bounds: np.ndarray, outer: np.ndarray):
    """(own, near, bounds, outer, needed): a part reassigned. ``needed``: how many kept entries had to be looked at, b + 1 for all."""
    own, near, bounds, outer = own.copy(), near.copy(), bounds.copy(), outer.copy()
    b = near.shape[1]
    here = books.some(vecs, part, own[:, None])[:, 0]
    reach = np.sqrt(here.astype(np.float64)) * (1 + SLACK)
    # Entries from the first bound beyond the own distance on can neither be nearer nor tie.
    needed = b + 1 - (np.concatenate([bounds, outer[:, None]], axis=1) > reach[:, None]).sum(axis=1)
    for z in np.unique(needed):
        rows = np.flatnonzero(needed == z)
        if z == 0:
            continue
        if z > b:
            own[rows], near[rows], bounds[rows], outer[rows] = fresh(books, vecs[rows], part, b)
            continue
        which = np.concatenate([own[rows, None], near[rows, :z]], axis=1)
        squares = books.some(vecs[rows], part, which)
        order = np.lexsort((which, squares), axis=1)
        which, squares = np.take_along_axis(which, order, 1), np.take_along_axis(squares, order, 1)
        own[rows], near[rows, :z] = which[:, 0], which[:, 1:]
        limit = bounds[rows, z] if z < b else outer[rows]
        # An entry that turns out farther than the next bound keeps that bound, so that the order holds.
        bounds[rows, :z] = np.minimum(_below(squares[:, 1:]), limit[:, None])
    return own, near, bounds, outer, needed


def _matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _assigned(rows: DataFrame, books: Codebooks, before: Codebooks | None, b: int, kept: int) -> DataFrame:
    """STATE with each part's entry under ``books``; without ``before`` from nothing, else by the bounds kept for it. Keeps b entries."""
    parts, label = books.parts, rows.schema["label"].dataType.simpleString()
    moves = books.moves(before) if before else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part_of = batch.slice(at, 4096)
                vecs = _matrix(part_of.column(2))
                n = len(vecs)
                state = [np.zeros((n, parts), np.uint8), np.zeros((n, parts, b), np.uint8), np.zeros((n, parts, b), np.float32), np.zeros((n, parts), np.float32)]
                if before:
                    raw = [np.frombuffer(b"".join(part_of.column(k).to_pylist()), kind) for k, kind in ((3, np.uint8), (4, np.uint8), (5, np.float32), (6, np.float32))]
                    held = [raw[0].reshape(n, parts), raw[1].reshape(n, parts, kept), raw[2].reshape(n, parts, kept), raw[3].reshape(n, parts)]
                for p in range(parts):
                    if before:
                        near, outer = held[1][:, p], held[3][:, p]
                        bounds, outer = moved(near, held[2][:, p], outer, moves[:, p])
                        if kept > b:  # fewer entries are kept now: the first one dropped is the outer bound
                            near, bounds, outer = near[:, :b], bounds[:, :b], bounds[:, b]
                        told = again(books, vecs, p, held[0][:, p].astype(np.int64), near.astype(np.int64), bounds, outer)
                    else:
                        told = fresh(books, vecs, p, b)
                    for place, value in zip(state, told):
                        place[:, p] = value
                packed = [pa.array([row.tobytes() for row in s], type=pa.binary()) for s in state]
                yield pa.RecordBatch.from_arrays([part_of.column(0), part_of.column(1), part_of.column(2), *packed], names=[f.split()[0] for f in STATE.split(", ")])

    return rows.mapInArrow(run, STATE.replace("label int", f"label {label}"))


def _needed(state: DataFrame, books: Codebooks, after: Codebooks, b: int) -> list[int]:
    """How many parts need 0, 1, ... b of their kept entries, or all entries (b + 1), once the entries have moved to ``after``."""
    moves, parts = after.moves(books), books.parts

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(b + 2, np.int64)
        for batch in batches:
            vecs, n = _matrix(batch.column(0)), batch.num_rows
            own, near, bounds, outer = (np.frombuffer(b"".join(batch.column(k).to_pylist()), kind) for k, kind in ((1, np.uint8), (2, np.uint8), (3, np.float32), (4, np.float32)))
            for p in range(parts):
                low, out = moved(near.reshape(n, parts, b)[:, p], bounds.reshape(n, parts, b)[:, p], outer.reshape(n, parts)[:, p], moves[:, p])
                reach = np.sqrt(after.some(vecs, p, own.reshape(n, parts)[:, p].astype(np.int64)[:, None])[:, 0].astype(np.float64)) * (1 + SLACK)
                total += np.bincount(b + 1 - (np.concatenate([low, out[:, None]], axis=1) > reach[:, None]).sum(axis=1), minlength=b + 2)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(b + 2)), pa.array(total)], names=["needed", "n"])

    counts = state.select("vec", "own", "near", "bounds", "outer").mapInArrow(count, "needed bigint, n bigint").groupBy("needed").agg(F.sum("n").alias("n"))
    told = {r.needed: r.n for r in counts.collect()}
    return [told.get(z, 0) for z in range(b + 2)]


def _updated(state: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry replaced by its parts' floor(sum / count); unused entries stay. One row per task, entry and component is summed."""
    edges, shape = books.edges, books.entries.shape

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        for batch in batches:
            vecs = _matrix(batch.column(0))
            own = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(vecs), -1)
            for p, (a, z) in enumerate(zip(edges, edges[1:])):
                np.add.at(total[:, a:z], own[:, p], vecs[:, a:z])
                count[:, a:z] += np.bincount(own[:, p], minlength=shape[0])[:, None]
        entry, component = np.nonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (entry, component, total[entry, component], count[entry, component])], names=["entry", "component", "total", "n"])

    told = state.select("vec", "own").mapInArrow(sums, "entry bigint, component bigint, total bigint, n bigint")
    told = told.groupBy("entry", "component").agg(F.sum(F.col("total").cast("decimal(38,0)")).alias("total"), F.sum("n").alias("n"))
    entries = books.entries.copy()
    for r in told.collect():  # a row per entry and component at most
        entries[r.entry, r.component] = int(r.total) // r.n
    return Codebooks(entries, edges)


def adapted(needed: list[int], b: int, least: int) -> int:
    """The fewest entries (``least`` or more) that decide all but a small share of the parts that kept entries decide now."""
    decided, upto = sum(needed[: b + 1]), 0
    for z in range(b + 1):
        upto += needed[z]
        if upto >= DECIDED * decided:
            return min(b, max(z, least))
    return b


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks | None]:
    """(codes, codebooks). Codes: vec_id, label, own (an entry number per part, a byte each), error (squared, summed over parts).

    ``vectors``: vec_id, embedding, label; other columns are ignored. Rows without a sound vector go, see ``whole``. All kept vectors
    should have one dimension; those of another than the smallest vec_id's go too. Repeated rows and ids are coded each. At most 256 entries.
    Without any row there are no codebooks. Fewer vectors than entries make fewer entries.
    """
    kept = stored(whole(vectors, scale), "whole")
    first = first_entries(kept, entries)
    if not first:
        return kept.select("vec_id", "label", F.lit(b"").alias("own"), F.lit(0).cast("bigint").alias("error")), None
    dimension = len(first[0])
    kept = kept.filter(F.size("vec") == dimension)
    if any(len(v) != dimension for v in first):
        first = first_entries(kept, entries)
    books, edges = Codebooks(np.array(first, np.int64), cuts(dimension, parts)), cuts(dimension, parts)
    b = max(1, len(first) // 4)
    state = stored(_assigned(kept, books, None, b, b), "state")
    for _ in range(rounds):
        after = _updated(state, books)
        fewer = adapted(_needed(state, books, after, b), b, max(1, len(first) // 8))
        state = stored(_assigned(state, after, books, fewer, b), "state")
        books, b = after, fewer
    final = books

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = _matrix(batch.column(2))
            own = np.frombuffer(b"".join(batch.column(3).to_pylist()), np.uint8).reshape(len(vecs), -1).astype(np.int64)
            error = sum((final.some(vecs, p, own[:, p, None])[:, 0] for p in range(parts)), np.zeros(len(vecs), np.int64))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), batch.column(3), pa.array(error)], names=["vec_id", "label", "own", "error"])

    label = kept.schema["label"].dataType.simpleString()
    return state.select("vec_id", "label", "vec", "own").mapInArrow(errors, f"vec_id bigint, label {label}, own binary, error bigint"), final


def report(vectors: DataFrame, **options) -> DataFrame:
    """vec_id, code, error, label_error (of all vectors of a label, nulls together), codebooks_sha256 for each kept row; see ``compress``."""
    codes, books = compress(vectors, **options)
    codes = stored(codes, "codes")
    by_label = codes.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error"))
    told = codes.join(by_label, F.col("label").eqNullSafe(F.col("_label")))
    return told.select("vec_id", F.lower(F.hex("own")).alias("code"), "error", "label_error", F.lit(books.digest() if books else "").alias("codebooks_sha256"))
