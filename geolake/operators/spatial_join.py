"""Joins by place: nearest neighbour, points in areas, interpolation along a line."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import morton
from ..functions.binding import let
from ..session import written

#: Places in a leaf of the nearest join; cuts before its first level.
LEAF, FIRST = 16, 4


def _finite(df: DataFrame) -> DataFrame:
    """Rows with a place: no null, NaN or infinite coordinate."""
    return df.filter(" AND ".join(f"abs({c}) < double('infinity')" for c in ("X", "Y")))


def _in_leaves(places: DataFrame, low: Sequence[float], extent: float, most: int) -> DataFrame:
    """Places with their curve number (_h, _l) and how many cuts (_cuts) leave at most ``most`` places of a task in their cell.

    Along the curve the places of a cell are neighbours: a cell holds more than ``most`` where a place and the one that many
    steps on share it. Tasks take runs of the curve of equal length, however crowded a part of the plane is.
    """
    high, lower = morton.halves(F.col("X"), F.col("Y"), low, extent)
    ordered = places.withColumns({"_h": high, "_l": lower}).repartitionByRange("_h", "_l", "X", "Y").withColumn("_run", F.spark_partition_id())
    along = Window.partitionBy("_run").orderBy("_h", "_l", "X", "Y")
    ahead = F.lead("_h", most).over(along), F.lead("_l", most).over(along)
    crowded = ordered.withColumns({"_ah": ahead[0], "_al": ahead[1]}).withColumn(
        "_shared", F.when(F.col("_ah").isNull(), -1).otherwise(morton.shared_cuts((F.col("_h"), F.col("_l")), (F.col("_ah"), F.col("_al")))))
    cuts = F.least(F.max("_shared").over(along.rowsBetween(-most, 0)) + 1, F.lit(morton.LEVELS))
    return written(crowded.withColumn("_cuts", cuts).drop("_run", "_ah", "_al", "_shared"), "places")


def _box(side: str) -> list[Column]:
    return [fold(f"{side}{e}{c}").alias(f"{side}{e}{c}") for c in "xy" for e, fold in (("a", F.min), ("z", F.max))]


def _leaves(places: DataFrame, side: str) -> DataFrame:
    """Leaves with the box around their places. These share the leaf's leading bits, and the least halves do too."""
    boxed = places.select("_h", "_l", "_cuts", *(F.col(c).alias(f"{side}{e}{c.lower()}") for c in ("X", "Y") for e in "az"))
    leaf = morton.cell(F.col("_h"), F.col("_l"), F.col("_cuts")).alias("_leaf")
    return written(boxed.groupBy(leaf, "_cuts").agg(F.min("_h").alias("_h"), F.min("_l").alias("_l"), *_box(side)), "leaves")


def _nodes(leaves: DataFrame, level: int, above: int, side: str) -> DataFrame:
    """Nodes after ``level`` cuts, or leaves that need fewer, with their box and the node after ``above`` cuts."""
    def at(cuts: int) -> Column:
        return morton.cell(F.col("_h"), F.col("_l"), F.least(F.col("_cuts"), F.lit(cuts)))

    return leaves.groupBy(at(level).alias(side), at(above).alias(f"_p{side}")).agg(*_box(side))


def _reach(closest: bool) -> Column:
    """Square of the least or greatest distance between places of two boxes; a place is its own box."""
    def along(c: str) -> Column:
        gap = [F.col(f"la{c}") - F.col(f"rz{c}"), F.col(f"ra{c}") - F.col(f"lz{c}")]
        return F.greatest(*gap, F.lit(0.0)) if closest else F.greatest(-gap[0], -gap[1])

    return along("x") * along("x") + along("y") * along("y")


def _promising(pairs: DataFrame, *key: str) -> DataFrame:
    """Pairs that may hold the nearest place: the least distance is within what another pair of the same left node guarantees."""
    scored = pairs.withColumns({"_lo": _reach(True), "_hi": _reach(False)})
    best = F.min("_hi").over(Window.partitionBy(*key))
    # Bounds and distances round apart in the last bits.
    return scored.withColumn("_best", best).filter(F.col("_lo") <= F.col("_best") * (1 + 1e-9))


def _within_reach(x: Column, y: Column, among: Column) -> Column:
    """The cells (_pr) of a list of boxes that may hold the place nearest to x, y, as ``_promising`` decides it."""
    def reach(box: Column) -> Column:
        def along(v: Column, c: str) -> tuple[Column, Column]:
            gap = v - box[f"rz{c}"], box[f"ra{c}"] - v
            return F.greatest(*gap, F.lit(0.0)), F.greatest(-gap[0], -gap[1])

        (near_x, far_x), (near_y, far_y) = along(x, "x"), along(y, "y")
        return F.struct(box["_pr"].alias("_pr"), (near_x * near_x + near_y * near_y).alias("lo"), (far_x * far_x + far_y * far_y).alias("hi"))

    def keep(v: Column) -> Column:
        return F.filter(v["b"], lambda b: b["lo"] <= v["best"] * (1 + 1e-9))

    kept = let(lambda v: let(keep, b=v["b"], best=F.array_min(F.transform(v["b"], lambda b: b["hi"]))), b=F.transform(among, reach))
    return F.transform(kept, lambda b: b["_pr"])


def nearest_join(
    left: DataFrame, right: DataFrame, payload: Sequence[str], suffix: str = "_near", most: int = LEAF
) -> DataFrame:
    """Exact nearest right point (2-D) of every left point; rows without a place, and all where the right side has none, get nulls.

    Both sides are folded to distinct places first: many returns at one place cost one row, and the lowest payload there (in the
    stated column order) is the tie rule. The plane is then cut where it is crowded, until a cell holds at most ``most`` places.
    From the root down, a left cell keeps the right cells that its certified distance allows, which is the least of all greatest
    distances to one; in the end each left place keeps a few leaves. No cell size is set, and no level compares whole groups.

    Ties in distance go to the smallest (X, Y, payload).
    """
    columns = list(left.columns)
    places = written(_finite(left).select("X", "Y").distinct(), "left")
    grounds = written(_finite(right).groupBy("X", "Y").agg(F.min(F.struct(*payload)).alias("p")), "right")
    span = places.select("X", "Y").unionByName(grounds.select("X", "Y")).agg(F.min("X"), F.min("Y"), F.max("X"), F.max("Y")).first()
    low_x, low_y, high_x, high_y = (v or 0.0 for v in span)
    frame = (low_x, low_y), max(high_x - low_x, high_y - low_y), most
    places, grounds = _in_leaves(places, *frame), _in_leaves(grounds, *frame)
    lefts, rights = _leaves(places, "l"), _leaves(grounds, "r")
    depth = lefts.select("_cuts").unionByName(rights.select("_cuts")).agg(F.max("_cuts")).first()[0] or 0
    # The first level holds 256 cells a side at most; all of them lie in the one root, and all meet.
    level = min(FIRST, depth)
    lowest, nearest = _nodes(lefts, level, 0, "l"), _nodes(rights, level, 0, "r")
    pairs = _promising(lowest.join(nearest, F.col("_pl") == F.col("_pr")), "l").select(F.col("l").alias("_pl"), F.col("r").alias("_pr"))
    for below in range(level + 1, depth + 1):
        met = pairs.join(_nodes(lefts, below, below - 1, "l"), "_pl").join(_nodes(rights, below, below - 1, "r"), "_pr")
        pairs = _promising(met, "l").select(F.col("l").alias("_pl"), F.col("r").alias("_pr"))
    leaf = morton.cell(F.col("_h"), F.col("_l"), F.col("_cuts"))
    own = places.select("X", "Y", leaf.alias("_pl"))
    # A left leaf's right leaves travel as one list, so that each of its places chooses among them where it stands.
    edges = [f"r{e}{c}" for c in "xy" for e in "az"]
    lists = pairs.join(rights.withColumnRenamed("_leaf", "_pr"), "_pr").groupBy("_pl").agg(F.collect_list(F.struct("_pr", *edges)).alias("_among"))
    asked = own.join(lists, "_pl").select("X", "Y", F.explode(_within_reach(F.col("X"), F.col("Y"), F.col("_among"))).alias("_pr"))
    known = grounds.select(F.col("X").alias("_gx"), F.col("Y").alias("_gy"), "p", leaf.alias("_pr"))
    dx, dy = F.col("X") - F.col("_gx"), F.col("Y") - F.col("_gy")
    found = asked.join(known, "_pr").groupBy("X", "Y").agg(F.min(F.struct((dx * dx + dy * dy).alias("d"), "_gx", "_gy", "p")).alias("_n"))
    return left.join(found, ["X", "Y"], "left").select(
        *columns,
        F.sqrt("_n.d").alias("distance"),
        *(F.col(f"_n.p.{c}").alias(f"{c}{suffix}") for c in payload),
    )


def points_in_areas(points: DataFrame, areas: DataFrame, base: float = 4.0, highest: str | None = None) -> DataFrame:
    """Points with every area (area_id, minx, miny, maxx, maxy) that holds them, closed.

    With ``highest``, a column of doubles of the points, the pairs come counted instead of listed: area_id, points, ``highest``
    stand for that many pairs of an area and the highest value among them. An area has several such rows, to be added up. Pairs
    grow with the product of both sides; these rows don't (``area_totals``).

    An area is filed at the grid level whose cells are about a quarter of its size, so it
    covers at most 5 x 5 cells however large it is, and those cells hold little but the
    area. A point asks for its cell at each level in use. Both sides meet by equality and
    an exact test follows. Both are sorted by cell: the planner takes the filed areas for no
    larger than their table, and would gather up to 25 rows of each in the driver to broadcast them.
    """
    if highest is not None:
        from .area_totals import totals  # works on Arrow batches, which listing does without

        return totals(points, areas, highest)
    size = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    rank = F.ceil(F.log2(F.greatest(size / (4 * base), F.lit(1.0)))).cast("int")
    side = F.lit(base) * F.pow(F.lit(2.0), F.col("_l"))
    filed = areas.withColumn("_l", rank).withColumn("_side", side)

    def span(a: str) -> Column:
        return F.sequence(F.floor(F.col(f"min{a}") / F.col("_side")), F.floor(F.col(f"max{a}") / F.col("_side")))

    filed = filed.withColumn("_cx", F.explode(span("x"))).withColumn("_cy", F.explode(span("y"))).drop("_side")
    in_use = areas.agg(F.sort_array(F.collect_set(rank))).scalar()
    asked = points.withColumn("_l", F.explode(in_use)).withColumns({
        "_cx": F.floor(F.col("X") / side), "_cy": F.floor(F.col("Y") / side),
    })
    return (
        asked.join(filed.hint("merge"), ["_l", "_cx", "_cy"])
        .filter(F.col("X").between(F.col("minx"), F.col("maxx")) & F.col("Y").between(F.col("miny"), F.col("maxy")))
        .drop("_l", "_cx", "_cy")
    )


#: Strips in a segment of the interpolation, as a power of two.
SEGMENT_BITS = 20


def _carried(strips: DataFrame, keys: list[str], bits: int = SEGMENT_BITS) -> DataFrame:
    """keys, _s, _before, _after: the last filled strip before and the first after each strip, whatever lies between.

    Two levels: inside segments of 2^bits strips, and over segments, of which as many make a run. So no window holds more than
    2^bits rows of a key, and strips within 2^(2 bits - 1) of zero, half a million millions by default, see each other.
    """
    def both(segment: Column, place: str, first: str, last: str) -> tuple[Column, Column]:
        order = Window.partitionBy(*keys, segment).orderBy(place)
        return (F.last(last, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, -1)),
                F.first(first, ignorenulls=True).over(order.rowsBetween(1, Window.unboundedFollowing)))

    # Strips count from far below zero, so that the runs of segments are one as long as there are fewer than 2^(2 bits) strips.
    shifted = F.shiftright(F.col("_s").cast("bigint") + (1 << (2 * bits - 1)), bits)
    inner = strips.withColumn("_g", shifted)
    before, after = both(F.col("_g"), "_s", "_first", "_last")
    inner = inner.withColumns({"_before": before, "_after": after})
    segments = strips.withColumn("_g", shifted).groupBy(*keys, "_g").agg(F.min("_first").alias("_gfirst"), F.max("_last").alias("_glast"))
    before, after = both(F.shiftright("_g", bits), "_g", "_gfirst", "_glast")
    outer = segments.select(*(F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)), F.col("_g").alias("_og"), before.alias("_gbefore"), after.alias("_gafter"))
    match = F.col("_g") == F.col("_og")
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return inner.join(outer, match).select(
        *keys, "_s", F.coalesce("_before", "_gbefore").alias("_before"), F.coalesce("_after", "_gafter").alias("_after"))


def interp_join(samples: DataFrame, series: DataFrame, by: Sequence[str], width: float, bits: int = SEGMENT_BITS) -> DataFrame:
    """Linear interpolation of series (x, y) at samples (x), clamped at both ends.

    Equal series positions are averaged first. Rows are cut into strips of ``width``, and
    windows run inside strips only; what a strip needs from outside is the nearest filled
    strip on either side, found by a scan over segments of strips.
    """
    keys = list(by)
    strip = F.floor(F.col("x") / width)
    known = series.groupBy(*keys, "x").agg(F.avg("y").alias("y")).withColumn("_s", strip)
    asked = samples.select(*keys, "x").distinct().withColumn("_s", strip)
    point = F.struct("x", "y")
    edges = known.groupBy(*keys, "_s").agg(F.min(point).alias("_first"), F.max(point).alias("_last"))
    strips = asked.select(*keys, "_s").distinct().join(edges, [*keys, "_s"], "full_outer")
    carried = _carried(strips, keys, bits)
    both = known.select(*keys, "_s", "x", point.alias("_p")).unionByName(
        asked.select(*keys, "_s", "x", F.lit(None).cast("struct<x:double,y:double>").alias("_p"))
    ).withColumn("_ask", F.col("_p").isNull())
    inside = Window.partitionBy(*keys, "_s").orderBy("x", "_ask")
    backward = F.last("_p", ignorenulls=True).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    # The next series point is found by the same running scan from the other end; one at the sample itself is found backward.
    down = Window.partitionBy(*keys, "_s").orderBy(F.desc("x"), F.desc("_ask"))
    forward = F.last("_p", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, -1))
    seen = both.withColumns({"_back": backward, "_next": forward}).filter("_ask")
    placed = seen.join(carried, [*keys, "_s"])
    low, high = F.coalesce("_back", "_before"), F.coalesce("_next", "_after")
    placed = placed.withColumns({"_lo": low, "_hi": high})
    x, lo, hi = F.col("x"), F.col("_lo"), F.col("_hi")
    between = lo["y"] + (x - lo["x"]) * F.try_divide(hi["y"] - lo["y"], hi["x"] - lo["x"])
    value = F.when(lo.isNull(), hi["y"]).when(hi.isNull() | (lo["x"] == x), lo["y"]).otherwise(between)
    return placed.select(*keys, "x", value.alias("y"))


#: Bits of a double that a round of the quantile looks at.
DIGIT = 16


def ordered_bits(value: Column) -> Column:
    """The 64 bits of a double as a whole number of the same order: -0.0 equals 0.0, and NaN stands above infinity."""
    bits = F.java_method(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), value + F.lit(0.0)).cast("bigint")
    return let(lambda b: F.when(b["b"] >= 0, b["b"]).otherwise(b["b"].bitwiseXOR(F.lit((1 << 63) - 1))), b=bits)


def exact_quantile(df: DataFrame, value: str, p: float) -> DataFrame:
    """Exact quantile with linear interpolation, as a one-row DataFrame ``quantile``; NULL without any value.

    Radix selection: a histogram of the first 16 bits of the values, in their order, tells which of them hold the two ranks the
    answer lies between; the next round looks at the next bits of these values alone. After at most four rounds of at
    most 65,536 partially counted rows each, the values are known, whatever their spread and however often they repeat.
    """
    spark = df.sparkSession
    values = df.filter(F.col(value).isNotNull()).select(F.col(value).cast("double").alias("v"))
    total = values.count()
    rank = p * max(total - 1, 0)
    found: dict[int, float] = {}
    #: Ranks still looked for among the values that share some leading bits, counted from the first of these.
    todo = [(values, {math.floor(rank): math.floor(rank), math.ceil(rank): math.ceil(rank)})] if total else []
    for shift in range(64 - DIGIT, -1, -DIGIT):
        later = []
        for rows, ranks in todo:
            digits = rows.groupBy(F.shiftright(ordered_bits(F.col("v")), shift).alias("d")).agg(
                F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
            # At most 65,536 rows, whatever the table holds.
            upto = digits.withColumn("upto", F.sum("n").over(Window.orderBy("d"))).withColumn("first", F.col("upto") - F.col("n"))
            holds = reduce(Column.__or__, (F.lit(k).between(F.col("first"), F.col("upto") - 1) for k in ranks.values()))
            for r in upto.filter(holds).collect():
                inside = {k: at - r["first"] for k, at in ranks.items() if r["first"] <= at < r["upto"]}
                if r["lo"] == r["hi"] or math.isnan(r["lo"]):
                    found |= {k: r["lo"] for k in inside}
                else:
                    later.append((values.filter(F.shiftright(ordered_bits(F.col("v")), shift) == r["d"]).filter(F.col("v").between(r["lo"], r["hi"])), inside))
        todo = later
    if not total:
        return spark.range(1).select(F.lit(None).cast("double").alias("quantile"))
    low, high = found[math.floor(rank)], found[math.ceil(rank)]
    part = rank - math.floor(rank)
    return spark.range(1).select(F.lit(low if part == 0 or low == high else low + (high - low) * part).alias("quantile"))
