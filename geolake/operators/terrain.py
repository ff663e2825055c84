"""Neighbourhood operators on raster tables.

All of them read one prepared table, ``neighbourhood``: dense cells with their eight
neighbours. It costs one shuffle: cells go to square blocks, cells near a block border are
copied to the blocks beside it, and all windows then run inside blocks, whose size is
bounded whatever the size of the raster.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 256
# Amplification model, risk classes, sun position, flood levels, sectors.
CURVATURE_CLIP = 0.1
SLOPE_SCALE = 60.0
SLOPE_CLIP = 0.5
AMPLIFICATION_LIMIT = 1.5
RISK_BREAKS = (15, 30, 45)
RISK_NAMES = ("low", "medium", "high", "critical")
RISES = (1, 2, 3, 5, 10)
SECTORS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")
SUN_AZIMUTH, SUN_ALTITUDE, Z_FACTOR = 315.0, 45.0, 1.5
HECTARE = 10000.0


def to_blocks(cells: DataFrame, header: DataFrame, block: int, halo: int, dense: bool) -> DataFrame:
    """Cells in blocks: raster_id, _br, _bc, row, col, value, width, height, home.

    Border cells appear in up to three more blocks with ``home`` false. ``dense`` adds a
    NULL row for every cell that has none. One shuffle, hash partitioned by block.
    """
    keys = ["raster_id", "_br", "_bc"]
    size = header.select("raster_id", "width", "height")

    def blocks_of(axis: str, side: str) -> Column:
        low = F.greatest(F.floor((F.col(axis) - halo) / block), F.lit(0))
        high = F.least(F.floor((F.col(axis) + halo) / block), F.floor((F.col(side) - 1) / block))
        return F.sequence(low.cast("int"), high.cast("int"))

    placed = (
        cells.join(size, "raster_id")
        .withColumn("_br", F.explode(blocks_of("row", "height")))
        .withColumn("_bc", F.explode(blocks_of("col", "width")))
        .select(*keys, "width", "height", "row", "col", F.col("value").cast("double").alias("value"))
    )
    if dense:
        frame = (
            size.withColumn("_br", F.explode(F.sequence(F.lit(0), F.floor((F.col("height") - 1) / block).cast("int"))))
            .withColumn("_bc", F.explode(F.sequence(F.lit(0), F.floor((F.col("width") - 1) / block).cast("int"))))
            .select(
                *keys, "width", "height",
                F.lit(None).cast("int").alias("row"), F.lit(None).cast("int").alias("col"),
                F.lit(None).cast("double").alias("value"),
            )
        )
        placed = placed.unionByName(frame)
    spread = placed.repartition(*keys)
    if dense:
        def span(start: str, side: str) -> Column:
            low = F.greatest(F.col(start) * block - halo, F.lit(0))
            return F.sequence(low, F.least((F.col(start) + 1) * block + halo, F.col(side)) - 1)

        rows = F.when(F.col("row").isNotNull(), F.array("row")).otherwise(span("_br", "height"))
        spread = spread.withColumn("_blank", F.col("row").isNull()).withColumn("row", F.explode(rows))
        columns = F.when(~F.col("_blank"), F.array("col")).otherwise(span("_bc", "width"))
        spread = (
            spread.withColumn("col", F.explode(columns))
            .groupBy(*keys, "width", "height", "row", "col")
            .agg(F.max("value").alias("value"))
        )
    home = (F.floor(F.col("row") / block) == F.col("_br")) & (F.floor(F.col("col") / block) == F.col("_bc"))
    return spread.withColumn("home", home)


def neighbourhood(cells: DataFrame, header: DataFrame, block: int = BLOCK) -> DataFrame:
    """Dense cells with value and n, s, w, e, nw, ne, sw, se (NULL outside or nodata)."""
    blocks = to_blocks(cells, header, block, halo=1, dense=True)
    along = Window.partitionBy("raster_id", "_br", "_bc", "row").orderBy("col")
    across = Window.partitionBy("raster_id", "_br", "_bc", "col").orderBy("row")
    triple = blocks.withColumns({"_w": F.lag("value").over(along), "_e": F.lead("value").over(along)})
    line = F.struct(F.col("_w").alias("w"), F.col("value").alias("v"), F.col("_e").alias("e"))
    stacked = triple.withColumn("_line", line).withColumns(
        {"_up": F.lag("_line").over(across), "_down": F.lead("_line").over(across)}
    )
    return stacked.filter("home").select(
        "raster_id", "row", "col", "width", "height", "value",
        F.col("_w").alias("w"), F.col("_e").alias("e"),
        F.col("_up.w").alias("nw"), F.col("_up.v").alias("n"), F.col("_up.e").alias("ne"),
        F.col("_down.w").alias("sw"), F.col("_down.v").alias("s"), F.col("_down.e").alias("se"),
    )


def _difference(before: Column, here: Column, after: Column, first: Column, last: Column, res: float) -> Column:
    """Central difference inside, one-sided at the array edge."""
    return F.when(first, (after - here) / res).when(last, (here - before) / res).otherwise(
        (after - before) / (2 * res)
    )


def _edges() -> tuple[Column, Column, Column, Column]:
    row, column = F.col("row"), F.col("col")
    return row == 0, row == F.col("height") - 1, column == 0, column == F.col("width") - 1


def with_gradient(near: DataFrame, res: float) -> DataFrame:
    """dx along columns, dy along rows (southward)."""
    north, south, west, east = _edges()
    c = F.col
    return near.withColumns({
        "dx": _difference(c("w"), c("value"), c("e"), west, east, res),
        "dy": _difference(c("n"), c("value"), c("s"), north, south, res),
    })


def with_slope(near: DataFrame, res: float) -> DataFrame:
    base = near if "dx" in near.columns else with_gradient(near, res)
    steep = F.sqrt(F.col("dx") * F.col("dx") + F.col("dy") * F.col("dy"))
    return base.withColumn("slope", F.degrees(F.atan(steep)))


def with_aspect(near: DataFrame, res: float) -> DataFrame:
    """Degrees in [0, 360) from atan2(-dx, dy)."""
    base = near if "dx" in near.columns else with_gradient(near, res)
    angle = F.degrees(F.atan2(-F.col("dx"), F.col("dy")))
    return base.withColumn("aspect", F.when(angle < 0, angle + 360).otherwise(angle))


def with_curvature(near: DataFrame) -> DataFrame:
    """Five-point Laplacian with a mirrored array edge; not divided by the cell area."""
    north, south, west, east = _edges()
    c, v = F.col, F.col("value")
    total = (
        F.when(north, v).otherwise(c("n")) + F.when(south, v).otherwise(c("s"))
        + F.when(west, v).otherwise(c("w")) + F.when(east, v).otherwise(c("e"))
    )
    return near.withColumn("curvature", total - 4 * v)


def with_amplification(near: DataFrame, res: float) -> DataFrame:
    """Ridges and steep slopes amplify: two clipped linear terms multiplied."""
    base = with_curvature(with_slope(near, res))
    bend = F.least(F.greatest(F.col("curvature"), F.lit(-CURVATURE_CLIP)), F.lit(CURVATURE_CLIP))
    ridge = 1.0 + (bend + CURVATURE_CLIP) / (2 * CURVATURE_CLIP) * 0.5
    steep = 1.0 + F.least(F.greatest(F.col("slope") / SLOPE_SCALE, F.lit(0.0)), F.lit(SLOPE_CLIP))
    both = F.col("curvature").isNotNull() & F.col("slope").isNotNull()
    return base.withColumn("amplification", F.when(both, ridge * steep))


def with_hillshade(
    near: DataFrame, res: float, z: float = Z_FACTOR, az: float = SUN_AZIMUTH, alt: float = SUN_ALTITUDE
) -> DataFrame:
    """Horn 3x3 shading as a byte 1..255; NULL at nodata.

    At the array edge the missing line is extrapolated from the two beside it (along the
    edge, corners repeat their own column); a nodata neighbour takes the centre value.
    Light and edge rules are the public defaults of common tools, taken as assumptions.
    """
    north, south, west, east = _edges()
    v, names = F.col("value"), ("nw", "n", "ne", "w", "e", "sw", "s", "se")
    h = {k: F.col(f"_h{k}") for k in names}
    filled = near.withColumns({f"_h{k}": F.coalesce(F.col(k), v) for k in names})
    # sides: extrapolated along inner rows, repeated in the corners
    edge_row = north | south

    def side(edge: Column, lost: str, middle: Column, other: str) -> Column:
        return F.when(edge & edge_row, middle).when(edge, 2 * middle - h[other]).otherwise(h[lost])

    sides = filled.withColumns({
        "_hnw": side(west, "nw", h["n"], "ne"), "_hw": side(west, "w", v, "e"), "_hsw": side(west, "sw", h["s"], "se"),
        "_hne": side(east, "ne", h["n"], "nw"), "_he": side(east, "e", v, "w"), "_hse": side(east, "se", h["s"], "sw"),
    })
    # top and bottom lines: extrapolated from the two lines beside them
    full = sides.withColumns({
        "_hnw": F.when(north, 2 * h["w"] - h["sw"]).otherwise(h["nw"]), "_hn": F.when(north, 2 * v - h["s"]).otherwise(h["n"]),
        "_hne": F.when(north, 2 * h["e"] - h["se"]).otherwise(h["ne"]), "_hsw": F.when(south, 2 * h["w"] - h["nw"]).otherwise(h["sw"]),
        "_hs": F.when(south, 2 * v - h["n"]).otherwise(h["s"]), "_hse": F.when(south, 2 * h["e"] - h["ne"]).otherwise(h["se"]),
    })
    x = ((h["nw"] + 2 * h["w"] + h["sw"]) - (h["ne"] + 2 * h["e"] + h["se"])) / (8 * res)
    y = ((h["sw"] + 2 * h["s"] + h["se"]) - (h["nw"] + 2 * h["n"] + h["ne"])) / (8 * res)
    lit = full.withColumns({"_x": x, "_y": y})
    flat = F.col("_x") * F.col("_x") + F.col("_y") * F.col("_y")
    sun = F.radians(F.lit(alt))
    turn = F.atan2(F.col("_y"), F.col("_x")) - F.radians(F.lit(az))
    light = (F.sin(sun) - F.cos(sun) * z * F.sqrt(flat) * F.sin(turn)) / F.sqrt(1 + z * z * flat)
    byte = F.when(light <= 0, 1.0).otherwise(1 + 254 * light)
    return lit.withColumn("hillshade", F.when(v.isNotNull(), byte)).drop("_x", "_y", *(f"_h{k}" for k in names))


# --- summaries --------------------------------------------------------------------------


def slope_summary(slopes: DataFrame) -> DataFrame:
    return slopes.groupBy("raster_id").agg(
        F.min("slope").alias("min_slope"), F.max("slope").alias("max_slope"), F.avg("slope").alias("mean_slope")
    )


def slope_risk(slopes: DataFrame, cell_area: float, breaks: Sequence[float] = RISK_BREAKS,
               names: Sequence[str] = RISK_NAMES) -> DataFrame:
    """Area and share of valid cells per class; every class is present."""
    slope = F.col("slope")
    bounds = [None, *breaks, None]
    counts = []
    for name, low, high in zip(names, bounds, bounds[1:]):
        test = slope.isNotNull()
        test = test if low is None else test & (slope >= low)
        test = test if high is None else test & (slope < high)
        counts.append(F.struct(F.lit(name).alias("risk"), F.count_if(test).alias("cells")))
    totals = slopes.groupBy("raster_id").agg(
        F.array(*counts).alias("_c"), F.count("slope").alias("_all")
    )
    return totals.select("raster_id", "_all", F.inline("_c")).select(
        "raster_id", "risk", "cells",
        (F.col("cells") * cell_area / HECTARE).alias("hectares"),
        F.try_divide(F.col("cells") * 100.0, F.col("_all")).alias("percent"),
    )


def aspect_distribution(aspects: DataFrame) -> DataFrame:
    """Share per compass sector of all cells, nodata included."""
    sector = F.pmod(F.floor((F.col("aspect") + 22.5) / 45), F.lit(8))
    counts = F.array(*(
        F.struct(F.lit(name).alias("sector"), F.count_if(sector == i).alias("cells"))
        for i, name in enumerate(SECTORS)
    ))
    totals = aspects.groupBy("raster_id").agg(counts.alias("_c"), F.count("*").alias("_all"))
    return totals.select("raster_id", "_all", F.inline("_c")).select(
        "raster_id", "sector", "cells", (F.col("cells") * 100.0 / F.col("_all")).alias("percent")
    )


def amplification_summary(amplified: DataFrame, cell_area: float) -> DataFrame:
    a = F.col("amplification")
    return amplified.groupBy("raster_id").agg(
        F.min(a).alias("min_amplification"), F.max(a).alias("max_amplification"),
        F.avg(a).alias("mean_amplification"),
        (F.count_if(a > AMPLIFICATION_LIMIT) * cell_area / HECTARE).alias("high_hectares"),
    )


def flood(cells: DataFrame, cell_area: float, levels: Sequence[float] | None = None,
          rises: Sequence[float] = RISES) -> DataFrame:
    """Flooded area, volume and greatest depth per water level.

    Levels are absolute, or the raster's mean plus each rise. All levels are measured in
    one pass: the per-raster aggregate holds a few sums for each level.
    """
    valid = cells.filter(F.col("value").isNotNull())
    if levels is None:
        # One shuffle brings each raster's partial sums together; the mean itself is tiny and
        # joined back, as a broadcast only if its size at run time allows.
        mean = valid.groupBy("raster_id").agg(F.avg("value").alias("_base"))
        valid = valid.join(mean, "raster_id")
        steps = [(F.col("_base") + float(r), F.lit(float(r))) for r in rises]
    else:
        steps = [(F.lit(float(v)), F.lit(None).cast("double")) for v in levels]
    value = F.col("value")
    records = []
    for level, rise in steps:
        depth = F.when(value < level, level - value)
        records.append(F.struct(
            F.first(level).alias("level"), F.first(rise).alias("rise"),
            F.count(depth).alias("cells"),
            (F.count(depth) * cell_area).alias("area"),
            (F.coalesce(F.sum(depth), F.lit(0.0)) * cell_area).alias("volume"),
            F.coalesce(F.max(depth), F.lit(0.0)).alias("max_depth"),
        ))
    return valid.groupBy("raster_id").agg(F.array(*records).alias("_r")).select("raster_id", F.inline("_r"))


def flood_depth(cells: DataFrame, level: float | Column) -> DataFrame:
    """Depth map: max(0, level - value); nodata is 0."""
    depth = F.greatest(F.lit(0.0), level - F.col("value"))
    return cells.withColumn("depth", F.when(F.col("value").isNull(), 0.0).otherwise(depth))


def cut_fill(cells: DataFrame, target: float, cell_area: float) -> DataFrame:
    d = F.col("value") - target
    zero = F.lit(0.0)
    return cells.filter(F.col("value").isNotNull()).groupBy("raster_id").agg(
        (F.sum(F.greatest(d, zero)) * cell_area).alias("cut"),
        (F.sum(F.greatest(-d, zero)) * cell_area).alias("fill"),
    ).withColumn("net", F.col("cut") - F.col("fill"))


# --- ground -----------------------------------------------------------------------------


def _steps(radius: int, start: int = 0) -> list[int]:
    """Radii that lead from one to another: three windows of radius r, set apart, make one of up to 3r + 1."""
    found = []
    while start < radius:
        start = min(3 * start + 1, radius)
        found.append(start)
    return found


def _wider(fold, name: str, apart: int, line: list[str], order: str, start: Column, length: Column) -> Column:
    """Fold of a column's windows here and ``apart`` cells to both sides; at the ends of a line the last window there counts.

    Lines are dense, so cells are reached by their place in the line and the cost does not depend on the radius.
    """
    window = Window.partitionBy(*line).orderBy(order)
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place = F.col(order) - start
    before = F.when(place >= apart, F.lag(name, apart).over(window)).otherwise(F.first(name).over(whole))
    after = F.when(place + apart < length, F.lead(name, apart).over(window)).otherwise(F.last(name).over(whole))
    return fold(before, F.col(name), after)


def opened_surfaces(cells: DataFrame, header: DataFrame, radii: Sequence[int], block: int = BLOCK) -> DataFrame:
    """Morphological openings (minimum, then maximum) of square windows of cells, a column ``opened_<radius>`` for each radius.

    Nodata cells neither erode nor dilate. All radii share one blocking, whose halo is twice the greatest radius, so a block
    sees everything its own cells depend on. Wide windows are made of narrower ones, first along rows and then along columns.
    """
    radii, halo, infinity = sorted(set(radii)), 2 * max(radii), F.lit(float("inf"))
    block = max(block, 2 * halo)
    blocks = to_blocks(cells, header, block, halo, dense=True).withColumn("_h0", F.coalesce("value", infinity))
    keys = ["raster_id", "_br", "_bc"]

    def line(start: str, side: str) -> tuple[Column, Column]:
        low = F.greatest(F.col(start) * block - halo, F.lit(0))
        return low, F.least((F.col(start) + 1) * block + halo, F.col(side)) - low

    rows = [*keys, "row"], "col", *line("_bc", "width")
    columns = [*keys, "col"], "row", *line("_br", "height")

    def pass_over(df: DataFrame, fold, way: tuple, prefix: str, out: str) -> DataFrame:
        """One direction for all radii: step by step, each radius from its own column ``prefix + radius``."""
        plans = {r: _steps(r) for r in radii}
        for k in range(max(map(len, plans.values()))):
            made = {}
            for r, steps in plans.items():
                source = f"{prefix}{r}" if k == 0 else f"{out}{r}"
                if k < len(steps):
                    made[f"{out}{r}"] = _wider(fold, source, steps[k] - (steps[k - 1] if k else 0), *way)
            df = df.withColumns(made)
        return df.drop(*(f"{prefix}{r}" for r in radii))

    # Along rows a radius starts where the one before it ends.
    before = 0
    for r in radii:
        source = f"_h{before}"
        for step in _steps(r, before):
            blocks = blocks.withColumn("_w", _wider(F.least, source, step - before, *rows))
            blocks, before, source = blocks.withColumn(f"_h{r}", F.col("_w")).drop("_w"), step, f"_h{r}"
    low = pass_over(blocks, F.least, columns, "_h", "_low")
    turned = low.withColumns({f"_low{r}": F.when(F.col(f"_low{r}") == infinity, -infinity).otherwise(F.col(f"_low{r}")) for r in radii})
    high = pass_over(pass_over(turned, F.greatest, columns, "_low", "_up"), F.greatest, rows, "_up", "opened_")
    return high.filter("home AND value IS NOT NULL").select("raster_id", "row", "col", "value", *(f"opened_{r}" for r in radii))


def opened_surface(cells: DataFrame, header: DataFrame, radius: int, block: int = BLOCK) -> DataFrame:
    """The opening of one square window, as ``opened``."""
    return opened_surfaces(cells, header, [radius], block).withColumnRenamed(f"opened_{radius}", "opened")


def ground_radii(window: float, cell: float) -> list[int]:
    """Window radii in cells: doubling, up to half the window."""
    top, radii, radius = max(1, int(window / 2 / cell)), [], 1
    while radius < top:
        radii.append(radius)
        radius *= 2
    return [*radii, top]


def ground_limit(cells: DataFrame, header: DataFrame, cell: float, slope: float = 0.3, window: float = 16) -> DataFrame:
    """Highest elevation that still counts as ground, per cell of a lowest-point raster.

    A simplification of progressive morphological filtering: at every radius ground may
    rise above the opened surface by slope * radius * cell.
    """
    radii = ground_radii(window, cell)
    limits = [F.col(f"opened_{r}") + slope * r * cell for r in radii]
    opened = opened_surfaces(cells, header, radii)
    return opened.select("raster_id", "row", "col", (F.least(*limits) if len(limits) > 1 else limits[0]).alias("limit"))


def classify_ground(points: DataFrame, cell: float, slope: float = 0.3, window: float = 16) -> DataFrame:
    """Points with Classification set to 2 (ground) or 1, by opening the lowest-point grid."""
    from .raster import GROUND, raster_header

    header = raster_header(points, cell)
    one = header.select(F.struct("raster_id", "minx", "miny", "height").alias("g")).scalar()
    located = points.withColumn("_g", one).withColumns({
        "raster_id": F.col("_g.raster_id"),
        "col": F.floor((F.col("X") - F.col("_g.minx")) / cell + 0.5).cast("int"),
        "row": (F.col("_g.height") - 1 - F.floor((F.col("Y") - F.col("_g.miny")) / cell + 0.5)).cast("int"),
    }).drop("_g")
    lowest = located.groupBy("raster_id", "row", "col").agg(F.min("Z").alias("value"))
    limit = ground_limit(lowest, header, cell, slope, window)
    return (
        located.join(limit, ["raster_id", "row", "col"])
        .withColumn("Classification", F.when(F.col("Z") <= F.col("limit"), GROUND).otherwise(1).cast("smallint"))
        .drop("raster_id", "row", "col", "limit")
    )
