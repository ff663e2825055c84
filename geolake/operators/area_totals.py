"""Totals of the points in areas: how many an area holds and the highest value among them, without a row for each pair.

The plane is cut into tiles of about equally many points. Of an area, tiles that it covers count with their totals; it is sent
to the tiles that its border crosses, and there all areas are answered together: the points of a tile are sorted by Y inside runs
of 2^k points along X, for each k, and an area's share is at most two runs of each k. So an area costs the tiles along its
border times a few logarithms, however many points it holds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from ..session import reachable

#: Points in a tile, and columns and rows at most of the grid that tiles are made of.
TILE, GRID = 1 << 17, 1024
#: Areas that a tile answers at once, and points of a tile that are gathered before equal places are folded.
ASKED, FOLD = 1 << 17, 1 << 20
#: Areas that look for their tiles at once.
SOUGHT = 2048
#: Reduce tasks at most, each for some tiles.
TASKS = 2048
BOUNDS = ("minx", "miny", "maxx", "maxy")
#: What stands for a null in the order of values; no double has this number.
NULL = np.iinfo(np.int64).min


def ordered(column: pa.Array) -> np.ndarray:
    """Doubles as whole numbers of Spark's order: NaN stands above infinity, a null below all."""
    values = column.to_numpy(zero_copy_only=False).astype(np.float64)
    values[np.isnan(values)] = np.nan  # one of all NaNs
    bits = values.view(np.int64)
    bits = np.where(bits < 0, bits ^ np.iinfo(np.int64).max, bits)
    if column.null_count:
        bits[column.is_null().to_numpy(zero_copy_only=False)] = NULL
    return bits


def doubles(numbers: np.ndarray) -> pa.Array:
    """The doubles and nulls that ``ordered`` gave numbers to."""
    bits = np.where(numbers < 0, numbers ^ np.iinfo(np.int64).max, numbers)
    return pa.array(bits.view(np.float64), mask=numbers == NULL)


def places(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [batch.column(name).to_numpy(zero_copy_only=False) for name in names]


def cell(values: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The column or row of a value: how many edges are not above it."""
    return np.searchsorted(edges, values, side="right")


class Tiles:
    """Tiles as leaves of a tree of boxes of grid cells, with the points and the highest value of each box.

    A box with more points than a tile should have is cut along its longer side, as long as it has several cells.
    """

    def __init__(self, xs: np.ndarray, ys: np.ndarray, n: np.ndarray, top: np.ndarray, most: int):
        self.xs, self.ys = xs, ys
        self.of = np.zeros(n.shape, np.int32)
        upto = np.zeros((n.shape[0] + 1, n.shape[1] + 1), np.int64)
        upto[1:, 1:] = n.cumsum(0).cumsum(1)
        boxes, children, held, highest, todo = [(0, n.shape[0], 0, n.shape[1])], [(0, 0)], [], [], [0]
        self.count = 0
        for at in todo:
            a, b, c, d = boxes[at]
            total = int(upto[b, d] - upto[a, d] - upto[b, c] + upto[a, c])
            held.append(total)
            highest.append(top[a:b, c:d].max())
            if total <= most or (b - a == 1 and d - c == 1):
                self.of[a:b, c:d] = at
                self.count += 1
                continue
            parts = -(-total // most)
            along = upto[a:b + 1, d] - upto[a:b + 1, c] if b - a >= d - c else upto[b, c:d + 1] - upto[a, c:d + 1]
            along = along - along[0]
            cut = int(np.abs(along[1:-1] - total * (parts // 2) / parts).argmin()) + 1
            children[at] = len(boxes), len(boxes) + 1
            boxes += [(a, a + cut, c, d), (a + cut, b, c, d)] if b - a >= d - c else [(a, b, c, c + cut), (a, b, c + cut, d)]
            children += [(0, 0), (0, 0)]
            todo += children[at]
        self.boxes, self.children = np.array(boxes).T, np.array(children)
        self.held, self.highest = np.array(held), np.array(highest)

    def at(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return self.of[cell(x, self.xs), cell(y, self.ys)]

    def walk(self, minx: np.ndarray, miny: np.ndarray, maxx: np.ndarray, maxy: np.ndarray) -> Iterator[tuple[bool, np.ndarray, np.ndarray]]:
        """From the root down: (True, areas, boxes that they cover) and (False, areas, tiles that they meet otherwise).

        A box is covered if it ends before the cells that hold the area's edges.
        """
        west, east, south, north = cell(minx, self.xs), cell(maxx, self.xs), cell(miny, self.ys), cell(maxy, self.ys)
        who, box = np.arange(len(minx)), np.zeros(len(minx), np.int64)
        while len(who):
            a, b, c, d = self.boxes[:, box]
            meets = (a <= east[who]) & (b > west[who]) & (c <= north[who]) & (d > south[who]) & (self.held[box] > 0)
            full = meets & (a > west[who]) & (b <= east[who]) & (c > south[who]) & (d <= north[who])
            leaf = self.children[box, 0] == 0
            yield True, who[full], box[full]
            partly = meets & ~full
            yield False, who[partly & leaf], box[partly & leaf]
            on = partly & ~leaf
            who, box = np.repeat(who[on], 2), self.children[box[on]].ravel()


class Gathered:
    """The points of a tile. Equal places are folded when there are many, so that a crowded place takes little memory."""

    def __init__(self, fold: int):
        self.fold, self.rows, self.parts = fold, 0, []

    def add(self, batch: pa.RecordBatch) -> None:
        x, y = places(batch, "a", "b")
        self.parts.append((x, y, ordered(batch.column("c")), np.ones(len(x), np.int64)))
        self.rows += len(x)
        if self.rows > self.fold:
            x, y, high, n = self.all()
            order = np.lexsort((y, x))
            x, y, high, n = x[order], y[order], high[order], n[order]
            firsts = np.flatnonzero(np.r_[True, (x[1:] != x[:-1]) | (y[1:] != y[:-1])])
            self.parts = [(x[firsts], y[firsts], np.maximum.reduceat(high, firsts), np.add.reduceat(n, firsts))]
            # As many places again may come before the next look, else each batch would be one.
            self.rows, self.fold = len(firsts), max(self.fold, 2 * len(firsts))

    def all(self) -> tuple[np.ndarray, ...]:
        return tuple(np.concatenate(v) for v in zip(*self.parts, strict=True))


def shares(points: tuple[np.ndarray, ...], minx: np.ndarray, miny: np.ndarray, maxx: np.ndarray, maxy: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How many of the points (X, Y, ordered value, how many) each area holds, closed, and the highest value among them."""
    order = np.argsort(points[1], kind="stable")
    x, y, high, n = (v[order] for v in points)
    along = np.argsort(x, kind="stable")
    rank, place = np.empty_like(along), np.arange(len(x))
    rank[along] = place
    left, right = np.searchsorted(x[along], minx, "left"), np.searchsorted(x[along], maxx, "right")
    low, up = np.searchsorted(y, miny, "left"), np.searchsorted(y, maxy, "right")
    left, right = np.where(low < up, left, 0), np.where(low < up, right, 0)
    found, top, k = np.zeros(len(minx), np.int64), np.full(len(minx), NULL), 0
    while (open_ := left < right).any():
        # Runs of 2^k points along X, inside by Y: the run on the left edge counts if it is an odd one, that on the right if it is even.
        keys = np.sort((rank >> k) * len(x) + place)
        inside = keys % len(x)
        upto = np.r_[0, np.cumsum(n[inside])]
        highest = np.empty((k + 1, len(x)), np.int64)  # of 2^j points from each
        highest[0] = high[inside]
        for j in range(k):
            highest[j + 1] = highest[j]
            np.maximum(highest[j, : -1 << j], highest[j, 1 << j :], out=highest[j + 1, : -1 << j])
        for who, run in ((w := np.flatnonzero(open_ & (left & 1 == 1)), left[w]), (w := np.flatnonzero(open_ & (right & 1 == 1)), right[w] - 1)):
            begin, end = np.searchsorted(keys, run * len(x) + low[who]), np.searchsorted(keys, run * len(x) + up[who])
            some = end > begin
            who, begin, end = who[some], begin[some], end[some]
            found[who] += upto[end] - upto[begin]
            j = np.frexp(end - begin)[1] - 1
            top[who] = np.maximum(top[who], np.maximum(highest[j, begin], highest[j, end - (1 << j)]))
        left, right, k = (left + 1) >> 1, right >> 1, k + 1
    return found, top


def _count(xs: np.ndarray, ys: np.ndarray) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros((len(xs) + 1) * (len(ys) + 1), np.int64)
        top = np.full(len(n), NULL)
        for batch in batches:
            x, y = places(batch, "a", "b")
            at = cell(x, xs) * (len(ys) + 1) + cell(y, ys)
            np.add.at(n, at, 1)
            np.maximum.at(top, at, ordered(batch.column("c")))
        seen = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(v) for v in (seen, n[seen], top[seen])], ["cell", "n", "top"])

    return run


def _dealt(tiles: Tiles) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Points with the key of their tile, an even one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key = pa.array(tiles.at(*places(batch, "a", "b")).astype(np.int64) * 2)
            yield pa.RecordBatch.from_arrays([key, *batch.columns], ["key", *batch.schema.names])

    return run


def _crossed(tiles: Tiles, sought: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Areas with the key of each tile that they meet and don't cover, an odd one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, sought) for b in batches for at in range(0, b.num_rows, sought)):
            for covers, who, tile in tiles.walk(*places(batch, "a", "b", "c", "d")):
                if not covers and len(who):
                    met = batch.take(pa.array(who))
                    yield pa.RecordBatch.from_arrays([pa.array(tile * 2 + 1), *met.columns], ["key", *met.schema.names])

    return run


def _covered(tiles: Tiles, value: str, sought: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Areas with the totals of the boxes that they cover."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, sought) for b in batches for at in range(0, b.num_rows, sought)):
            n, top = np.zeros(batch.num_rows, np.int64), np.full(batch.num_rows, NULL)
            for covers, who, box in tiles.walk(*places(batch, "a", "b", "c", "d")):
                if covers:
                    np.add.at(n, who, tiles.held[box])
                    np.maximum.at(top, who, tiles.highest[box])
            yield _told(batch.column("area_id"), n, top, value)

    return run


def _told(ids: pa.Array, n: np.ndarray, top: np.ndarray, value: str) -> pa.RecordBatch:
    some = np.flatnonzero(n)
    return pa.RecordBatch.from_arrays([ids.take(pa.array(some)), pa.array(n[some]), doubles(top[some])], ["area_id", "points", value])


def _answered(value: str, asked: int, fold: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows sorted by key: a tile's points come first, then its areas."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, points, areas = None, Gathered(fold), []

        def answers() -> Iterator[pa.RecordBatch]:
            if areas and points.rows:
                batch = pa.concat_batches(areas)
                yield _told(batch.column("area_id"), *shares(points.all(), *places(batch, "a", "b", "c", "d")), value)
            areas.clear()

        for batch in batches:
            keys = batch.column("key").to_numpy()
            edges = [0, *(np.flatnonzero(np.diff(keys)) + 1), len(keys)]
            for begin, end in zip(edges, edges[1:], strict=False):
                if begin == end:
                    continue
                rows, (own, asks) = batch.slice(begin, end - begin), divmod(int(keys[begin]), 2)
                if own != tile:
                    yield from answers()
                    tile, points = own, Gathered(fold)
                if not asks:
                    points.add(rows)
                    continue
                areas.append(rows)
                if sum(a.num_rows for a in areas) >= asked:
                    yield from answers()
        yield from answers()

    return run


def totals(points: DataFrame, areas: DataFrame, value: str) -> DataFrame:
    """area_id, points, ``value``: how many points an area holds, closed, and the highest value among them, in parts.

    A part stands for at least one point, parts of an area don't overlap, and an area without points has none. Values are
    doubles in Spark's order, so NaN is the highest; a null value counts as a point.
    """
    spark = points.sparkSession
    reachable(spark)
    placed = points.select(F.col("X").cast("double").alias("a"), F.col("Y").cast("double").alias("b"), F.col(value).cast("double").alias("c")).filter("a IS NOT NULL AND b IS NOT NULL")
    asking = areas.select(*(F.col(k).cast("double").alias(v) for k, v in zip(BOUNDS, "abcd", strict=True)), "area_id").filter("a <= c AND b <= d")
    # Edges only say how evenly points are dealt out.
    steps = [i / GRID for i in range(1, GRID)]
    spread = placed.agg(F.count("*").alias("n"), *(F.percentile_approx(F.when(~F.isnan(c), F.col(c)), steps).alias(c) for c in "ab")).first()
    side = min(-(-spread.n // TILE), GRID)
    some = [round(i * GRID / side) - 1 for i in range(1, side)]
    xs, ys = (np.unique(np.array([(spread[c] or [])[i] for i in some if spread[c]], np.float64)) for c in "ab")
    n, top = np.zeros((len(xs) + 1, len(ys) + 1), np.int64), np.full((len(xs) + 1, len(ys) + 1), NULL)
    if n.size > 1:
        counted = placed.mapInArrow(_count(xs, ys), "cell bigint, n bigint, top bigint").groupBy("cell").agg(F.sum("n").alias("n"), F.max("top").alias("top")).toArrow()
        at = counted["cell"].to_numpy()
        n.flat[at], top.flat[at] = counted["n"].to_numpy(), counted["top"].to_numpy()
    else:
        n[:] = spread.n
    tiles = Tiles(xs, ys, n, top, TILE)
    rows = StructType([StructField("key", LongType()), *asking.schema])
    parts = StructType([asking.schema["area_id"], StructField("points", LongType()), StructField(value, DoubleType())])
    dealt = placed.mapInArrow(_dealt(tiles), "key bigint, a double, b double, c double")
    both = dealt.withColumns({"d": F.lit(None).cast("double"), "area_id": F.lit(None).cast(asking.schema["area_id"].dataType)}).unionByName(
        asking.mapInArrow(_crossed(tiles, SOUGHT), rows))
    met = both.repartition(min(tiles.count, TASKS), F.shiftright("key", 1)).sortWithinPartitions("key").mapInArrow(_answered(value, ASKED, FOLD), parts)
    return met.unionByName(asking.mapInArrow(_covered(tiles, value, SOUGHT), parts)) if n.size > 1 else met
