"""Point-table operators: filters, statistics, hexagons, merging, thinning."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import crs, text
from ..session import written

STAT_DIMENSIONS = (
    "X", "Y", "Z", "Intensity", "ReturnNumber", "NumberOfReturns", "Classification",
)
ENUM_DIMENSIONS = ("Classification", "ReturnNumber", "NumberOfReturns")


def filter_range(points: DataFrame, limits: str) -> DataFrame:
    return points.filter(text.range_predicate(limits))


def crop(points: DataFrame, bbox: Sequence[float], bbox_crs: str = "native", epsg: int | None = None) -> DataFrame:
    """Closed box crop. ``bbox_crs`` is 'native', 'wgs84' or 'auto'.

    'auto' reads the box as native metres when any value exceeds 180. A geographic box is
    turned into the clouds' own zone once, on the driver, so the filter stays a pair of
    plain comparisons that Parquet can prune with.
    """
    box = text.literal_bbox(bbox)
    flat = (box[0], box[1], box[3], box[4]) if len(box) == 6 else tuple(box)
    if bbox_crs == "auto":
        bbox_crs = "native" if any(abs(v) > 180 for v in flat) else "wgs84"
    if bbox_crs == "native":
        return points.filter(F.col("X").between(flat[0], flat[2]) & F.col("Y").between(flat[1], flat[3]))
    codes = [epsg] if epsg else list(crs.ZONE_PARAMETERS)
    tests = []
    for code in codes:
        west, south, east, north = crs.literal_bbox_from_wgs84(flat, code)
        test = F.col("X").between(west, east) & F.col("Y").between(south, north)
        tests.append(test if epsg else (F.col("epsg") == code) & test)
    return points.filter(reduce(lambda a, b: a | b, tests))


def reproject_points(points: DataFrame, target_epsg: int) -> DataFrame:
    """X, Y into another supported system, through geographic coordinates."""
    same = F.col("epsg") == target_epsg
    kept = points.withColumns({"_x": F.col("X"), "_y": F.col("Y")})
    moved = crs.with_plane(crs.with_wgs84(kept, "X", "Y", F.col("epsg"), "_lon", "_lat"), "_lon", "_lat", target_epsg)
    return moved.withColumns({
        "X": F.when(same, F.col("_x")).otherwise(F.col("X")),
        "Y": F.when(same, F.col("_y")).otherwise(F.col("Y")),
        "epsg": F.lit(target_epsg),
    }).drop("_lon", "_lat", "_x", "_y")


def swap_axes(points: DataFrame) -> DataFrame:
    return points.withColumns({"X": F.col("Y"), "Y": F.col("X")})


def merge_points(
    tables: Sequence[DataFrame], source_epsg: int | None = None, target_epsg: int | None = None
) -> DataFrame:
    """Union of point tables whose optional columns may differ; then one CRS for all."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    if source_epsg is not None:
        merged = merged.withColumn("epsg", F.coalesce(F.col("epsg"), F.lit(source_epsg)))
    return merged if target_epsg is None else reproject_points(merged, target_epsg)


def dimension_stats(
    points: DataFrame, dims: Sequence[str] = STAT_DIMENSIONS, by: Sequence[str] = ()
) -> DataFrame:
    """Count, range, mean and sample deviation per dimension: one wide pass, then unpivot.

    The aggregate is partial per task, so the shuffle carries one row per task and group.
    """
    parts = []
    for d in dims:
        value = F.col(d).cast("double")
        parts.append(
            F.struct(
                F.lit(d).alias("name"),
                F.count(value).alias("count"),
                F.min(value).alias("minimum"),
                F.max(value).alias("maximum"),
                F.avg(value).alias("average"),
                F.stddev_samp(value).alias("stddev"),
                F.var_samp(value).alias("variance"),
            ).alias(d)
        )
    wide = points.groupBy(*by).agg(*parts)
    return wide.select(*by, F.inline(F.array(*(F.col(d) for d in dims))))


def statistics_array(points: DataFrame, by: Sequence[str], dims: Sequence[str] = STAT_DIMENSIONS) -> DataFrame:
    """The same as one array of records per group, the form processing metadata stores."""
    stats = dimension_stats(points, dims, by)
    record = F.struct("name", "average", "count", "maximum", "minimum", "stddev", "variance")
    return stats.groupBy(*by).agg(F.sort_array(F.collect_list(record)).alias("statistics"))


def enumerate_values(points: DataFrame, dims: Sequence[str] = ENUM_DIMENSIONS) -> DataFrame:
    """Occurrences of every value of the coded dimensions."""
    pairs = F.array(*(
        F.struct(F.lit(d).alias("dimension"), F.col(d).cast("int").alias("value")) for d in dims
    ))
    return (
        points.select(F.inline(pairs)).groupBy("dimension", "value").agg(F.count("*").alias("count"))
    )


def bbox3d(points: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    low = [F.min(d) for d in ("X", "Y", "Z")]
    high = [F.max(d) for d in ("X", "Y", "Z")]
    return points.groupBy(*by).agg(F.array(*low, *high).alias("bbox"), F.count("*").alias("point_count"))


def survey_summary(points: DataFrame, bbox: Sequence[float]) -> DataFrame:
    """Count, density and ranges inside a native box; Z deviation is the population one."""
    area = (bbox[2] - bbox[0]) * (bbox[3] - bbox[1])
    return crop(points, bbox).agg(
        F.count("*").alias("point_count"),
        F.try_divide(F.count("*"), F.lit(float(area))).alias("density"),
        *(f(d).alias(f"{n}_{d.lower()}") for d in ("X", "Y", "Z") for f, n in ((F.min, "min"), (F.max, "max"))),
        F.avg("Z").alias("mean_z"),
        F.stddev_pop("Z").alias("std_z"),
    )


# --- hexagons ---------------------------------------------------------------------------

# Axial steps to the six neighbours of a pointy-top hexagon, counter-clockwise
# from east; edge k faces neighbour k, so edge k+3 of that neighbour is the same line.
HEX_NEIGHBOURS = ((1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1))


def hex_cell(x: Column, y: Column, edge: float) -> tuple[Column, Column]:
    """Axial (q, r) of the hexagon that holds a point: round in cube coordinates."""
    qf = (x * (math.sqrt(3) / 3) - y / 3) / edge
    rf = (y * (2.0 / 3)) / edge
    sf = -qf - rf
    q, r, s = (F.floor(v + 0.5) for v in (qf, rf, sf))
    dq, dr, ds = F.abs(q - qf), F.abs(r - rf), F.abs(s - sf)
    fix_q = (dq > dr) & (dq > ds)
    fix_r = ~fix_q & (dr > ds)
    return F.when(fix_q, -r - s).otherwise(q), F.when(fix_r, -q - s).otherwise(r)


def hexbin(points: DataFrame, edge: float = 10.0, threshold: int = 1, by: Sequence[str] = ()) -> DataFrame:
    """Occupied hexagons with their point counts (at least ``threshold``)."""
    q, r = hex_cell(F.col("X"), F.col("Y"), edge)
    return (
        points.select(*by, q.alias("q"), r.alias("r"))
        .groupBy(*by, "q", "r")
        .agg(F.count("*").alias("count"))
        .filter(F.col("count") >= threshold)
    )


def hex_density(hexes: DataFrame, edge: float = 10.0, by: Sequence[str] = ()) -> DataFrame:
    """Occupied hexagons, points and points per square unit."""
    area = 1.5 * math.sqrt(3) * edge * edge
    return hexes.groupBy(*by).agg(
        F.count("*").alias("hexes"),
        F.sum("count").alias("points"),
        (F.sum("count") / (F.count("*") * area)).alias("density"),
    )


def hex_boundary(hexes: DataFrame, edge: float = 10.0, by: Sequence[str] = ()) -> DataFrame:
    """Outline segments: the hexagon edges that belong to exactly one occupied hexagon."""
    entries = []
    for k, (dq, dr) in enumerate(HEX_NEIGHBOURS):
        own = k < 3
        entries.append(F.struct(
            (F.col("q") if own else F.col("q") + dq).alias("eq"),
            (F.col("r") if own else F.col("r") + dr).alias("er"),
            F.lit(k % 3).alias("ek"),
            F.lit(k).alias("side"),
        ))
    exploded = hexes.select(*by, "q", "r", F.inline(F.array(*entries)))
    outer = exploded.groupBy(*by, "eq", "er", "ek").agg(
        F.count("*").alias("n"), F.min("q").alias("q"), F.min("r").alias("r"), F.min("side").alias("side")
    ).filter("n = 1")
    centre_x = (F.col("q") + F.col("r") / 2) * (math.sqrt(3) * edge)
    centre_y = F.col("r") * (1.5 * edge)

    def corner(turn: Column) -> tuple[Column, Column]:
        angle = F.radians(turn * 60)
        return centre_x + F.cos(angle) * edge, centre_y + F.sin(angle) * edge

    (x1, y1), (x2, y2) = corner(F.col("side") - 0.5), corner(F.col("side") + 0.5)
    return outer.select(*by, "q", "r", "side", x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


#: Corner of a hexagon before each side, against the clock, in steps of half a width and half an edge from its centre.
_CORNERS = ((1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1), (0, -2))


def hex_rings(hexes: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Closed rings around occupied hexagons: by, first_u, first_v, edges, area2, hole, corners.

    Corners are whole numbers: u in halves of a hexagon's width, v in halves of its edge. Each side that no occupied hexagon
    shares leads from a corner to the next with the occupied one on its left, and exactly one such side leaves a corner, so
    sides chain into rings: outer ones run against the clock, holes with it. Pointer jumping finds each ring's least
    corner and how far away it is, in as many rounds as the logarithm of the longest ring; ``corners`` begin and end there.
    """
    keys = list(by)
    sides = F.array(*(F.struct(
        (F.col("q") + dq).alias("nq"), (F.col("r") + dr).alias("nr"),
        *((base + step).alias(n) for n, base, step in (
            ("su", 2 * F.col("q") + F.col("r"), _CORNERS[k][0]), ("sv", 3 * F.col("r"), _CORNERS[k][1]),
            ("eu", 2 * F.col("q") + F.col("r"), _CORNERS[(k + 1) % 6][0]), ("ev", 3 * F.col("r"), _CORNERS[(k + 1) % 6][1]))),
        F.lit(k).alias("side"),
    ) for k, (dq, dr) in enumerate(HEX_NEIGHBOURS)))
    taken = hexes.select(*keys, F.col("q").alias("nq"), F.col("r").alias("nr"))
    outer = hexes.select(*keys, "r", F.inline(sides)).join(taken, [*keys, "nq", "nr"], "left_anti")
    edges = written(outer.select(*keys, "su", "sv", "eu", "ev", "side", "r"), "edges")
    # (u, v): the corner that 2^k steps lead to; best: the least corner on the way, and after how many steps it comes.
    state = edges.select(*keys, "su", "sv", F.col("eu").alias("u"), F.col("ev").alias("v"), F.struct(F.col("su").alias("u"), F.col("sv").alias("v"), F.lit(0).cast("bigint").alias("d")).alias("best"))
    reach, before = 1, None
    while True:
        ahead = state.select(*keys, F.col("su").alias("u"), F.col("sv").alias("v"), F.col("u").alias("_u"), F.col("v").alias("_v"), F.col("best").alias("_best"))
        further = F.struct(F.col("_best.u").alias("u"), F.col("_best.v").alias("v"), (F.col("_best.d") + reach).alias("d"))
        state = written(state.join(ahead, [*keys, "u", "v"]).select(
            *keys, "su", "sv", F.col("_u").alias("u"), F.col("_v").alias("v"), F.least("best", further).alias("best")), "jump")
        now = state.agg(F.sum(F.xxhash64("su", "sv", "best.u", "best.v").cast("decimal(38,0)"))).first()[0]
        if now == before:
            break
        before, reach = now, reach * 2
    ring = [F.col("best.u").alias("first_u"), F.col("best.v").alias("first_v")]
    placed = edges.join(state.select(*keys, "su", "sv", "best"), [*keys, "su", "sv"])
    # From the least corner on, the way to it grows shorter; at the corner itself it is none.
    order = F.when(F.col("best.d") == 0, F.lit(-(1 << 62))).otherwise(-F.col("best.d"))
    rings = placed.groupBy(*keys, *ring).agg(
        F.count("*").alias("edges"), F.sum(F.col("su") * F.col("ev") - F.col("eu") * F.col("sv")).alias("area2"),
        F.sort_array(F.collect_list(F.struct(order.alias("o"), F.col("su").alias("u"), F.col("sv").alias("v")))).alias("_c"),
        F.min(F.when(F.col("side") % 3 == 0, F.struct("su", "r", "side"))).alias("west"),
    )
    corners = F.transform(F.concat("_c", F.slice("_c", 1, 1)), lambda c: F.struct(c["u"].alias("u"), c["v"].alias("v")))
    return rings.select(*keys, "first_u", "first_v", "edges", "area2", (F.col("area2") < 0).alias("hole"), corners.alias("corners"), "west")


def hex_polygons(rings: DataFrame, edge: float = 10.0, by: Sequence[str] = ()) -> DataFrame:
    """Polygons with their holes: by, first_u, first_v, holes, area, wkt.

    The hexagon west of a hole's westernmost side belongs to the same piece as the hole. West of it in its row lies a side
    facing west, on the piece's outer ring or on another hole of it that begins further west; so following such sides leads
    from hole to hole to the outer ring.
    """
    keys = list(by)
    upright = rings.withColumn("_i", F.explode(F.sequence(F.lit(1), F.size("corners") - 1))).select(
        *keys, "first_u", "first_v", F.col("corners")[F.col("_i") - 1].alias("a"), F.col("corners")[F.col("_i")].alias("b"))
    upright = upright.filter(F.col("a.u") == F.col("b.u")).select(
        *keys, "first_u", "first_v", F.col("a.u").alias("u"), F.least("a.v", "b.v").alias("v"))
    here = F.struct("first_u", "first_v")
    west = F.lag(here).over(Window.partitionBy(*keys, "v").orderBy("u"))
    beside = upright.withColumn("_west", west)
    hole = rings.filter("hole").select(*keys, "first_u", "first_v", F.col("west.su").alias("u"), (F.col("west.r") * 3 - 1).alias("v"))
    links = beside.join(hole, [*keys, "first_u", "first_v", "u", "v"]).select(
        *keys, here.alias("ring"), F.col("_west").alias("to"))
    outer = rings.filter("NOT hole").select(*keys, here.alias("ring"))
    chain = written(links.unionByName(outer.withColumn("to", F.col("ring"))), "holes")
    while True:
        nexts = chain.select(*keys, F.col("ring").alias("to"), F.col("to").alias("_to"))
        longer = written(chain.join(nexts, [*keys, "to"]).select(*keys, "ring", F.col("_to").alias("to"), (F.col("_to") != F.col("to")).alias("moved")), "holes")
        chain = longer.drop("moved")
        if longer.filter("moved").isEmpty():
            break

    def number(v: Column) -> Column:
        return F.round(v, 6).cast("string")

    half = edge * math.sqrt(3) / 2
    text = F.concat(F.lit("("), F.array_join(F.transform("corners", lambda c: F.concat_ws(" ", number(c["u"] * half), number(c["v"] * (edge / 2)))), ", "), F.lit(")"))
    told = rings.select(*keys, here.alias("ring"), "hole", text.alias("text"), "area2").join(chain, [*keys, "ring"])
    parts = F.sort_array(F.collect_list(F.struct("hole", "ring", "text")))
    shapes = told.groupBy(*keys, "to").agg(
        F.count_if("hole").alias("holes"), (F.sum("area2") * (half * edge / 4)).alias("area"), parts.alias("_p"))
    wkt = F.concat(F.lit("POLYGON ("), F.array_join(F.col("_p.text"), ", "), F.lit(")"))
    return shapes.select(*keys, F.col("to.first_u").alias("first_u"), F.col("to.first_v").alias("first_v"), "holes", "area", wkt.alias("wkt"))


# --- first N, samples, thinning ---------------------------------------------------------


def head(points: DataFrame, n: int, order: Sequence[str] = ("X", "Y", "Z")) -> DataFrame:
    """First N points of a stated order; 0 keeps all."""
    return points if n == 0 else points.orderBy(*order).limit(n)


def points_to_json(
    points: DataFrame, bbox: Sequence[float], limit: int = 10000, order: Sequence[str] = ("X", "Y", "Z")
) -> DataFrame:
    """Points of a box as JSON records, at most ``limit`` of them (a service limit)."""
    inside = head(crop(points, bbox), limit, order)
    fields = [F.col("X").alias("x"), F.col("Y").alias("y"), F.col("Z").alias("z")]
    if "Intensity" in points.columns:
        fields.append(F.col("Intensity").alias("intensity"))
    if "Classification" in points.columns:
        fields.append(F.col("Classification").alias("classification"))
    return inside.select(F.to_json(F.struct(*fields)).alias("point"))


#: Copies of a row that one task numbers.
COPIES = 10000


def sample_points(points: DataFrame, n: int = 50000, seed: int = 0, name: Column | None = None) -> DataFrame:
    """Repeatable random sample without replacement of at most ``n`` points.

    Every point has a hash of its ``name`` (a text; by default all its columns), its number among equal rows and the seed, and
    the n smallest win; so equal rows are drawn one by one. They are counted first and numbered in runs, so no task holds
    all copies of a row. A histogram over the hash range finds a cut that keeps just over n points, so the final top-n
    never funnels n rows from every task into one.
    """
    columns = points.columns
    text = F.to_json(F.struct(*columns), {"ignoreNullFields": "false"}) if name is None else name
    counted = points.groupBy(*columns).agg(F.count("*").alias("_copies"))
    runs = counted.withColumn("_run", F.explode(F.sequence(F.lit(0), F.floor((F.col("_copies") - 1) / COPIES).cast("int"))))
    first = F.col("_run").cast("bigint") * COPIES + 1
    # Only where rows repeat very often are there several runs to spread.
    numbered = runs.hint("rebalance", *columns, "_run").withColumn("_k", F.explode(F.sequence(first, F.least(first + COPIES - 1, F.col("_copies")))))
    hashed = numbered.withColumn("_h", F.md5(F.concat_ws("|", text, F.col("_k").cast("string"), F.lit(str(seed)))))
    hashed = hashed.withColumn("_b", F.substring("_h", 1, 4))
    histogram = hashed.groupBy("_b").agg(F.count("*").alias("_n"))
    # at most 65,536 rows, whatever the table holds
    running = F.sum("_n").over(Window.orderBy("_b"))
    cut = (
        histogram.withColumn("_before", running - F.col("_n"))
        .filter(F.col("_before") < n)
        .agg(F.max("_b").alias("_cut"))
        .scalar()
    )
    return hashed.filter(F.col("_b") <= cut).orderBy("_h", *columns).limit(n).select(*columns)


def assign_lod(
    points: DataFrame, levels: int, base: float, priority: Column, identity: Sequence[str] | None = None
) -> DataFrame:
    """Level of detail per point: a voxel of a level keeps one point, the first by priority.

    Level 0 has voxels of ``base``, each further level halves them; what no voxel keeps
    belongs to level ``levels``. A point first in a coarse voxel is first in the finer one
    inside it, so each level only has to look at the winners of the next finer one, and
    every step is a partially aggregated minimum. Equal rows are folded into one row first;
    one of them takes part, the rest stay at the last level. ``copies`` in the result is the
    number of equal points at that level.
    """
    keys = list(identity or points.columns)
    single = points.groupBy(*keys).agg(F.count("*").alias("copies")).withColumn("_p", priority)
    record = F.struct("_p", *keys)
    winners = single.select(record.alias("_w"))
    ranked = None
    for level in range(levels - 1, -1, -1):
        side = base / 2**level
        voxel = [F.floor(F.col(f"_w.{d}") / side).alias(f"_v{d}") for d in ("X", "Y", "Z")]
        winners = winners.groupBy(*voxel).agg(F.min("_w").alias("_w")).select("_w")
        step = winners.select("_w", F.lit(level).alias("_level"))
        ranked = step if ranked is None else ranked.unionByName(step)
    best = ranked.groupBy("_w").agg(F.min("_level").alias("level"))
    best = best.select(*(F.col(f"_w.{k}").alias(k) for k in keys), "level")
    placed = _null_safe_left(single.drop("_p"), best, keys).withColumn(
        "level", F.coalesce("level", F.lit(levels))
    )
    last = F.lit(levels)
    one = F.when(F.col("level") == last, F.col("copies")).otherwise(F.lit(1).cast("bigint"))
    shares = F.array(
        F.struct(F.col("level").alias("level"), one.alias("copies")),
        F.struct(last.alias("level"), (F.col("copies") - one).alias("copies")),
    )
    return placed.select(*keys, F.inline(F.filter(shares, lambda s: s["copies"] > 0)))


def _null_safe_left(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.select(*(F.col(k).alias(f"_r_{k}") for k in keys), "level")
    match = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys))
    return left.join(renamed, match, "left").drop(*(f"_r_{k}" for k in keys))


def within_budget(leveled: DataFrame, budget: int) -> DataFrame:
    """Whole levels, coarse to fine, while their points fit the budget."""
    counts = leveled.groupBy("level").agg(F.sum("copies").alias("n"))
    # one row per level
    total = F.sum("n").over(Window.orderBy("level"))
    kept = counts.withColumn("total", total).filter(F.col("total") <= budget)
    return leveled.join(kept.select("level"), "level", "left_semi")


def query_points(points: DataFrame, items: DataFrame, bbox: Sequence[float]) -> DataFrame:
    """Crop only the clouds that a search returned: semi join on the source file."""
    hits = items.select(F.col("source_file"))
    return crop(points, bbox).join(hits, "source_file", "left_semi")
