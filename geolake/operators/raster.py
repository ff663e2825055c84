"""Raster tables: ``cells(raster_id, row, col, value)`` plus one header row per raster.

Row 0 is the north edge. A missing row or a NULL value is nodata.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import crs, text

# Raster products (title, description, aggregation source).
PRODUCTS = ("dem", "dsm", "dtm", "intensity", "density", "mean_non_noise")
NODATA = -9999.0
GROUND, NOISE = 2, 7
BLOCK = 512


def raster_header(points: DataFrame, resolution: float, by: str | None = None) -> DataFrame:
    """Grid of each raster: cell 0 is centred on the minimum point."""
    # the name of a single raster comes out of the aggregate, so that joins on it stay equi joins
    grouped = points.groupBy(F.col(by).alias("raster_id")) if by else points.groupBy()
    name = [] if by else [F.max(F.lit("raster")).alias("raster_id")]
    box = grouped.agg(
        *name,
        F.min("X").alias("minx"), F.min("Y").alias("miny"),
        F.max("X").alias("maxx"), F.max("Y").alias("maxy"),
    )
    size = [
        (F.floor((F.col(f"max{a}") - F.col(f"min{a}")) / resolution + 0.5) + 1).cast("int")
        for a in ("x", "y")
    ]
    return box.select(
        "raster_id", "minx", "miny",
        size[0].alias("width"), size[1].alias("height"),
        F.lit(float(resolution)).alias("resolution"),
    )


def header_bbox(header: DataFrame) -> DataFrame:
    """Outer edges of the grid: half a cell around the first and last cell centres."""
    half = F.col("resolution") / 2
    west, south = F.col("minx") - half, F.col("miny") - half
    return header.withColumn(
        "bbox",
        F.array(
            west, south,
            west + F.col("width") * F.col("resolution"),
            south + F.col("height") * F.col("resolution"),
        ),
    )


def cell_area(header: DataFrame) -> DataFrame:
    return header.withColumn("cell_area", F.col("resolution") * F.col("resolution"))


def _product(kind: str) -> tuple[Column, Column | None]:
    """What a product aggregates and which points it takes."""
    if kind in ("dem", "dsm"):
        return F.max("Z"), None
    if kind == "dtm":
        return F.avg("Z"), F.col("Classification") == GROUND
    if kind == "intensity":
        return F.avg("Intensity"), None
    if kind == "density":
        return F.count("*").cast("double"), None
    if kind == "mean_non_noise":
        return F.avg("Z"), F.col("Classification") != NOISE
    raise ValueError(f"unknown raster kind {kind!r}")


def _in_cells(
    points: DataFrame, grid: DataFrame, resolution: float, by: str | None, mode: str
) -> DataFrame:
    """Points once for every cell they count for, with ``raster_id``, ``row`` and ``col``."""
    if by is None:
        one = grid.select(F.struct("raster_id", "minx", "miny", "width", "height").alias("g")).scalar()
        located = points.withColumn("_g", one)
    else:
        joined = grid.select(
            F.col("raster_id").alias(by), F.struct("raster_id", "minx", "miny", "width", "height").alias("_g")
        )
        located = points.join(joined, by)
    fx = (F.col("X") - F.col("_g.minx")) / resolution
    fy = (F.col("Y") - F.col("_g.miny")) / resolution
    column, south_row = F.floor(fx + 0.5).cast("int"), F.floor(fy + 0.5).cast("int")
    if mode == "bin":
        located = located.withColumns({"col": column, "_srow": south_row})
    elif mode == "radius":
        # A point is within half a cell of its own centre, so centres two cells off are out of reach.
        located = located.withColumns({"_dx": fx - column, "_dy": fy - south_row, "_c": column, "_r": south_row})
        around = F.array(*(F.struct(
            F.lit(i).alias("i"), F.lit(j).alias("j"),
            ((i - F.col("_dx")) * (i - F.col("_dx")) + (j - F.col("_dy")) * (j - F.col("_dy"))).alias("d"),
        ) for i in (-1, 0, 1) for j in (-1, 0, 1)))
        located = located.select("*", F.inline(around)).filter(F.col("d") <= 2.0 + 1e-9)
        located = located.withColumns({"col": F.col("_c") + F.col("i"), "_srow": F.col("_r") + F.col("j")})
    else:
        raise ValueError("mode must be 'bin' or 'radius'")
    row = F.col("_g.height") - 1 - F.col("_srow")
    inside = (F.col("col") >= 0) & (F.col("col") < F.col("_g.width")) & (row >= 0) & (F.col("_srow") >= 0)
    return located.filter(inside).withColumns({"raster_id": F.col("_g.raster_id"), "row": row})


def rasterize(
    points: DataFrame,
    kind: str,
    resolution: float,
    by: str | None = None,
    mode: str = "bin",
    header: DataFrame | None = None,
) -> DataFrame:
    """Grid points into cells; an empty cell has no row.

    ``mode='bin'`` puts a point into the one cell whose centre is nearest; ``'radius'``
    lets it count for every cell centre within resolution * sqrt(2), the public default of
    common point gridding tools. Maximum, mean and count all combine partially, so a cell
    that holds a large share of the points costs one row per task in the shuffle.

    Without a ``header`` the grid is that of all points, whatever the product filters. One
    raster takes its origin from a scalar subquery; one raster per ``by`` value joins its
    header on the key and leaves the join strategy to runtime statistics.
    """
    aggregate, wanted = _product(kind)
    grid = raster_header(points, resolution, by) if header is None else header
    chosen = points if wanted is None else points.filter(wanted)
    return _in_cells(chosen, grid, resolution, by, mode).groupBy("raster_id", "row", "col").agg(aggregate.alias("value"))


def rasterize_products(
    points: DataFrame,
    kinds: Sequence[str],
    resolution: float,
    by: str | None = None,
    mode: str = "bin",
    header: DataFrame | None = None,
) -> DataFrame:
    """Several products of one grid, a column each, as ``rasterize`` makes them one by one.

    Points are placed in cells once for all of them. A product without any point in a cell is NULL there.
    """
    def value(kind: str) -> Column:
        _, wanted = _product(kind)
        chosen = F.lit(True) if wanted is None else wanted
        if kind == "density":
            return F.count_if(chosen).cast("double")
        if kind in ("dem", "dsm"):
            return F.max(F.when(chosen, F.col("Z")))
        return F.avg(F.when(chosen, F.col("Intensity" if kind == "intensity" else "Z")))

    grid = raster_header(points, resolution, by) if header is None else header
    placed = _in_cells(points, grid, resolution, by, mode)
    return placed.groupBy("raster_id", "row", "col").agg(*(value(k).alias(k) for k in kinds))


def mask_cells(
    cells: DataFrame, nodata: float | Column | None = NODATA, low: float | None = None, high: float | None = None
) -> DataFrame:
    """Nodata, NaN and values outside [low, high] become NULL."""
    value = F.col("value")
    bad = F.isnan(value)
    if nodata is not None:
        bad = bad | (value == nodata)
    if low is not None:
        bad = bad | (value < low)
    if high is not None:
        bad = bad | (value > high)
    return cells.withColumn("value", F.when(~bad, value))


def read_window(cells: DataFrame, header: DataFrame, bounds: Sequence[float]) -> DataFrame:
    """Cells whose centre lies in native bounds, per raster."""
    west, south, east, north = bounds
    res = F.col("resolution")
    span = header.select(
        F.col("raster_id"),
        F.ceil((west - F.col("minx")) / res).alias("_c0"),
        F.floor((east - F.col("minx")) / res).alias("_c1"),
        (F.col("height") - 1 - F.floor((north - F.col("miny")) / res)).alias("_r0"),
        (F.col("height") - 1 - F.ceil((south - F.col("miny")) / res)).alias("_r1"),
    )
    return (
        cells.join(span, "raster_id")
        .filter(F.col("col").between(F.col("_c0"), F.col("_c1")) & F.col("row").between(F.col("_r0"), F.col("_r1")))
        .drop("_c0", "_c1", "_r0", "_r1")
    )


def raster_stats(cells: DataFrame) -> DataFrame:
    """Valid cells only: count, range, mean, population deviation."""
    return mask_cells(cells).groupBy("raster_id").agg(
        F.count("value").alias("valid_count"),
        F.min("value").alias("minimum"),
        F.max("value").alias("maximum"),
        F.avg("value").alias("mean"),
        F.stddev_pop("value").alias("stddev"),
    )


def overviews(cells: DataFrame, levels: Sequence[int]) -> DataFrame:
    """Reduced-resolution levels by averaging 2^k x 2^k cells (nodata left out)."""
    def one(level: int) -> DataFrame:
        return (
            cells.groupBy(
                "raster_id",
                F.shiftright("row", level).alias("row"),
                F.shiftright("col", level).alias("col"),
            )
            .agg(F.avg("value").alias("value"))
            .withColumn("level", F.lit(level))
        )

    return reduce(lambda a, b: a.unionByName(b), (one(k) for k in levels))


def subsample(cells: DataFrame, header: DataFrame, max_dim: int = 512) -> DataFrame:
    """Every s-th row and column, s chosen per raster so that no side exceeds ``max_dim``."""
    stride = F.ceil(F.greatest("width", "height") / F.lit(max_dim)).cast("int")
    plan = header.select("raster_id", "width", "height", stride.alias("_s"))
    step = F.col("_s")
    return (
        cells.join(plan, "raster_id")
        .filter((F.col("row") % step == 0) & (F.col("col") % step == 0))
        .withColumns({"row": F.floor(F.col("row") / step).cast("int"), "col": F.floor(F.col("col") / step).cast("int")})
        .filter((F.col("row") < F.floor(F.col("height") / step)) & (F.col("col") < F.floor(F.col("width") / step)))
        .drop("width", "height", "_s")
    )


def mosaic(cells: DataFrame, header: DataFrame, rule: str = "last") -> DataFrame:
    """Many rasters of one resolution -> one. Overlaps: mean, or the greatest raster_id ('last')."""
    res = F.col("resolution")
    origin = header.agg(
        F.struct(
            F.min("minx").alias("minx"), F.min("miny").alias("miny"),
            F.max(F.col("miny") + (F.col("height") - 1) * res).alias("maxy"),
        ).alias("o")
    ).scalar()
    shift = header.withColumn("_o", origin).select(
        "raster_id",
        F.floor((F.col("minx") - F.col("_o.minx")) / res + 0.5).cast("int").alias("_dc"),
        F.floor(
            (F.col("_o.maxy") - (F.col("miny") + (F.col("height") - 1) * res)) / res + 0.5
        ).cast("int").alias("_dr"),
    )
    placed = cells.filter(F.col("value").isNotNull()).join(shift, "raster_id")
    value = F.avg("value") if rule == "mean" else F.max_by("value", "raster_id")
    return placed.groupBy(
        F.lit("mosaic").alias("raster_id"),
        (F.col("row") + F.col("_dr")).alias("row"), (F.col("col") + F.col("_dc")).alias("col"),
    ).agg(value.alias("value"))


def warp_header(header: DataFrame, src_epsg: int, dst_epsg: int, dst_res: float) -> DataFrame:
    """Target grid of a warp: four-corner box of the source, in the target system."""
    boxed = header_bbox(header)
    geographic = crs.bbox_to_wgs84(F.col("bbox"), src_epsg, corners=4)
    if dst_epsg in crs.GEOGRAPHIC:
        moved = boxed.withColumn("bbox", geographic)
    else:
        b = F.col("_b")
        corners = F.array(*(crs.plane(b[i], b[j], dst_epsg) for i, j in ((0, 1), (2, 1), (2, 3), (0, 3))))
        xs, ys = (F.transform("_p", lambda p, a=a: p[a]) for a in "xy")
        moved = boxed.withColumn("_b", geographic).withColumn("_p", corners).withColumn(
            "bbox", F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
        )
    b = F.col("bbox")
    return moved.select(
        "raster_id",
        (b[0] + dst_res / 2).alias("minx"), (b[1] + dst_res / 2).alias("miny"),
        F.ceil((b[2] - b[0]) / dst_res).cast("int").alias("width"),
        F.ceil((b[3] - b[1]) / dst_res).cast("int").alias("height"),
        F.lit(float(dst_res)).alias("resolution"),
    )


def grid_cells(header: DataFrame, block: int = BLOCK, partitions: int | None = None) -> DataFrame:
    """All (row, col) of every raster: blocks are spread first, then unrolled inside tasks."""
    def spans(side: str) -> Column:
        return F.sequence(F.lit(0), F.floor((F.col(side) - 1) / block).cast("int"))

    blocks = header.withColumn("_br", F.explode(spans("height"))).withColumn("_bc", F.explode(spans("width")))
    keys = ["raster_id", "_br", "_bc"]
    spread = blocks.repartition(partitions, *keys) if partitions else blocks.repartition(*keys)

    def cells_of(start: str, side: str) -> Column:
        low = F.col(start) * block
        return F.sequence(low, F.least(low + block, F.col(side)) - 1)

    return (
        spread.withColumn("row", F.explode(cells_of("_br", "height")))
        .withColumn("col", F.explode(cells_of("_bc", "width")))
        .drop("_br", "_bc")
    )


def warp(
    cells: DataFrame, header: DataFrame, src_epsg: int, dst_epsg: int, dst_res: float, block: int = BLOCK // 4
) -> DataFrame:
    """Bilinear resampling onto a grid in another system.

    Source cells go to square blocks with a rim of one cell, and each target cell goes once to the block of its upper left
    source cell; inside blocks every cell meets the three beside it, and hands the four to the target cells it holds. Nodata
    neighbours are left out and the other weights scaled up. Target cells without any valid neighbour have no row.
    """
    target = grid_cells(warp_header(header, src_epsg, dst_epsg, dst_res))
    placed = target.withColumns({
        "_x": F.col("minx") + F.col("col") * dst_res,
        "_y": F.col("miny") + (F.col("height") - 1 - F.col("row")) * dst_res,
    })
    geographic = crs.with_wgs84(placed, "_x", "_y", dst_epsg, "_lon", "_lat").select("raster_id", "row", "col", "_lon", "_lat")
    native = crs.with_plane(geographic, "_lon", "_lat", src_epsg, "_sx", "_sy")
    sx, sy = F.col("_sx"), F.col("_sy")
    size = header.select("raster_id", "width", "height")
    source = header.select(
        "raster_id", F.struct("minx", "miny", "width", "height", "resolution").alias("_s")
    )
    placed = native.join(source, "raster_id").withColumns({
        "_fx": (sx - F.col("_s.minx")) / F.col("_s.resolution"),
        "_fy": F.col("_s.height") - 1 - (sy - F.col("_s.miny")) / F.col("_s.resolution"),
    })
    c0, r0 = F.floor("_fx"), F.floor("_fy")
    seen = c0.between(-1, F.col("_s.width") - 1) & r0.between(-1, F.col("_s.height") - 1)
    keys = ["raster_id", "_br", "_bc"]
    probe = F.struct("row", "col", (F.col("_fx") - c0).alias("wx"), (F.col("_fy") - r0).alias("wy"))

    def block_of(at: Column) -> Column:
        return F.floor(F.greatest(at, F.lit(0)) / block).cast("int")

    probes = placed.filter(seen).select(
        "raster_id", block_of(r0).alias("_br"), block_of(c0).alias("_bc"), F.array(r0.cast("int")).alias("_rows"),
        F.array(c0.cast("int")).alias("_cols"), F.lit(None).cast("double").alias("value"), probe.alias("_probe"))
    none = F.lit(None).cast(probes.schema["_probe"].dataType)

    def copies(axis: str) -> Column:
        return F.array_distinct(F.array(block_of(F.col(axis) - 1), block_of(F.col(axis))))

    known = (
        cells.filter(F.col("value").isNotNull())
        .withColumn("_br", F.explode(copies("row"))).withColumn("_bc", F.explode(copies("col")))
        .select(*keys, F.array("row").alias("_rows"), F.array("col").alias("_cols"), F.col("value").cast("double").alias("value"), none.alias("_probe"))
    )

    def span(start: str, side: str) -> Column:
        return F.sequence(F.col(start) * block - 1, F.least((F.col(start) + 1) * block, F.col(side)))

    def blocks_of(side: str) -> Column:
        return F.sequence(F.lit(0), F.floor((F.col(side) - 1) / block).cast("int"))

    frame = (
        size.withColumn("_br", F.explode(blocks_of("height"))).withColumn("_bc", F.explode(blocks_of("width")))
        .select(*keys, span("_br", "height").alias("_rows"), span("_bc", "width").alias("_cols"), F.lit(None).cast("double").alias("value"), none.alias("_probe"))
    )
    dense = (
        known.unionByName(frame).unionByName(probes).repartition(*keys)
        .withColumn("_r", F.explode("_rows")).withColumn("_c", F.explode("_cols"))
        .groupBy(*keys, "_r", "_c").agg(F.max("value").alias("v"), F.collect_list("_probe").alias("_probes"))
    )
    along = Window.partitionBy(*keys, "_r").orderBy("_c")
    across = Window.partitionBy(*keys, "_c").orderBy("_r")
    pair = dense.withColumn("e", F.lead("v").over(along))
    quad = pair.withColumn("_below", F.lead(F.struct("v", "e")).over(across)).filter(F.size("_probes") > 0)
    told = quad.select("raster_id", F.inline("_probes"), "v", "e", F.col("_below.v").alias("s"), F.col("_below.e").alias("se"))
    wx, wy = F.col("wx"), F.col("wy")
    parts = (((1 - wx) * (1 - wy), "v"), (wx * (1 - wy), "e"), ((1 - wx) * wy, "s"), (wx * wy, "se"))
    weight = reduce(Column.__add__, (F.when(F.col(n).isNotNull(), w).otherwise(0.0) for w, n in parts))
    total = reduce(Column.__add__, (F.coalesce(w * F.col(n), F.lit(0.0)) for w, n in parts))
    return told.select("raster_id", "row", "col", F.when(weight > 0, total / weight).alias("value")).filter("value IS NOT NULL")


def crs_text(epsg: int) -> Column:
    return F.lit(f"EPSG:{epsg}")


def describe_rasters(
    cells: DataFrame, header: DataFrame, kind: str, epsg: int, source_file: Column, nodata: float = NODATA
) -> DataFrame:
    """Processing metadata of the rasters of one run."""
    valid = cells.groupBy("raster_id").agg(F.count("value").alias("valid_count"))
    name = text.bare_stem(source_file)
    return (
        header_bbox(header).join(valid, "raster_id", "left")
        .select(
            "raster_id",
            source_file.alias("source_file"),
            F.concat(name, F.lit(f"_{kind}.tif")).alias("output_file"),
            F.lit(kind).alias("dem_type"),
            crs_text(epsg).alias("crs"),
            "resolution", "width", "height", "bbox",
            F.lit(nodata).alias("nodata"),
            F.lit("float32").alias("data_type"),
            (F.coalesce("valid_count", F.lit(0)) > 0).alias("is_valid"),
        )
    )


