"""Item search as one lazy, pushed-down plan."""

from __future__ import annotations

import math
from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import crs, geom, morton, text

# Page limits, systems that need no transformation, raster asset marks.
DEFAULT_LIMIT, MAX_LIMIT = 10, 100
UNPROJECTED = ("EPSG:4326", "CRS84")
COG_TYPE = "image/tiff; application=geotiff; profile=cloud-optimized"
DEM_ROLES = ("elevation", "visual")


def request_bbox(bbox: str | Sequence[float], bbox_crs: str | None = None, corners: int = 2):
    """Request box -> (west, south, east, north) in degrees, once, on the driver."""
    values = text.literal_bbox(bbox)
    code = 4326
    if bbox_crs and bbox_crs.upper() not in UNPROJECTED:
        try:
            code = int(bbox_crs.upper().rsplit("EPSG:", 1)[1])
        except (IndexError, ValueError):
            raise ValueError(f"unsupported CRS {bbox_crs!r}") from None
    return crs.literal_bbox_to_wgs84(values, code, corners)


def request_interval(value: str) -> tuple[datetime | None, datetime | None]:
    """Instant, closed range, or a range with an open end ('..' or empty)."""
    def one(part: str) -> datetime | None:
        if part in ("", ".."):
            return None
        parsed = datetime.fromisoformat(part)
        return parsed if parsed.tzinfo else parsed.replace(tzinfo=timezone.utc)

    if "/" not in value:
        instant = one(value)
        return instant, instant
    start, end = value.split("/", 1)
    return one(start), one(end)


def matches(
    items: DataFrame,
    collections: Sequence[str] | None = None,
    ids: Sequence[str] | None = None,
    bbox: str | Sequence[float] | None = None,
    bbox_crs: str | None = None,
    datetime: str | None = None,
    keep_unlocated: bool = True,
    corners: int = 2,
) -> Column:
    """The filter of a request: cheap, pushable comparisons first, the polygon test last."""
    test = F.lit(True)
    if collections:
        test = test & F.col("collection").isin(*collections)
    if ids:
        test = test & F.col("id").isin(*ids)
    if datetime:
        start, end = request_interval(datetime)
        if start:
            test = test & (F.col("datetime") >= F.lit(start))
        if end:
            test = test & (F.col("datetime") <= F.lit(end))
    if bbox:
        west, south, east, north = request_bbox(bbox, bbox_crs, corners)
        near = (
            (F.col("maxx") >= west) & (F.col("minx") <= east)
            & (F.col("maxy") >= south) & (F.col("miny") <= north)
        )
        if "geometry_wkt" in items.columns:
            shape = geom.from_wkt(F.col("geometry_wkt"))
            exact = geom.intersects_box(shape, west, south, east, north)
            near = near & (shape.isNull() | exact)
        if "home_level" in items.columns:
            near = _at_home(west, south, east, north) & near
        test = test & ((near | F.col("minx").isNull()) if keep_unlocated else near)
    return test


#: Side of the smallest home cell in degrees, and how many times it doubles up to the whole circle.
HOME_SIDE, HOME_LEVELS = 360 / 2**20, 20


def with_home(items: DataFrame) -> DataFrame:
    """Adds the cell where an item is at home: of the level whose cells are just as large as its box, the one with its lower left corner.

    An item then lies in its home and the cells above and right of it, so a request box looks at its own cells and one more.
    Items without a location have none.
    """
    size = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    level = F.least(F.greatest(F.ceil(F.log2(size / HOME_SIDE)), F.lit(0)), F.lit(HOME_LEVELS)).cast("int")
    side = F.lit(HOME_SIDE) * F.pow(F.lit(2.0), F.col("home_level"))
    leveled = items.withColumn("home_level", F.when(F.col("minx").isNotNull(), F.coalesce(level, F.lit(0))))
    return leveled.withColumns({f"home_{a}": F.floor(F.col(f"min{a}") / side) for a in "xy"})


def write_located(items: DataFrame, path: str, partitions: int | None = None) -> None:
    """Item index with homes, ordered by level and then along a Z curve, so that files and row groups cover compact areas."""
    homed = with_home(items)
    curve = morton.interleave(*(F.coalesce(F.col(f"home_{a}") + (1 << HOME_LEVELS), F.lit(0)) for a in "xy"))
    order = ["home_level", "_z", "id"]
    placed = homed.withColumn("_z", curve)
    spread = placed.repartitionByRange(partitions, *order) if partitions else placed.repartitionByRange(*order)
    spread.sortWithinPartitions(*order).drop("_z").write.mode("overwrite").parquet(path)


def _at_home(west: float, south: float, east: float, north: float) -> Column:
    """Items whose home lets them meet a box: plain comparisons that Parquet can prune with, before any geometry is read."""
    test = F.lit(False)
    for level in range(HOME_LEVELS + 1):
        side = HOME_SIDE * 2**level
        span = [(math.floor(low / side) - 1, math.floor(high / side)) for low, high in ((west, east), (south, north))]
        test = test | ((F.col("home_level") == level) & F.col("home_x").between(*span[0]) & F.col("home_y").between(*span[1]))
    return test


def ordering(sortby: Sequence[dict] | None = None) -> list[Column]:
    """Requested fields first, then the stable index order (datetime DESC nulls last, id)."""
    order = []
    for rule in sortby or ():
        name = rule["field"].removeprefix("properties.").replace(":", "_")
        down = rule.get("direction", "asc").lower() == "desc"
        order.append(F.desc_nulls_last(name) if down else F.asc_nulls_last(name))
    return [*order, F.desc_nulls_last("datetime"), F.asc("id"), F.asc("collection")]


def check_limit(limit: int) -> int:
    if not 1 <= limit <= MAX_LIMIT:
        raise ValueError(f"limit must be within 1..{MAX_LIMIT}")
    return limit


def search(items: DataFrame, limit: int = DEFAULT_LIMIT, sortby: Sequence[dict] | None = None, **request) -> DataFrame:
    """One page of hits in a total order."""
    check_limit(limit)
    return items.filter(matches(items, **request)).orderBy(*ordering(sortby)).limit(limit)


def search_counts(items: DataFrame, limit: int = DEFAULT_LIMIT, **request) -> DataFrame:
    """total (whole index), matched (after filters), returned (after the limit)."""
    check_limit(limit)
    hit = F.count_if(matches(items, **request))
    return items.agg(
        F.count("*").alias("total"), hit.alias("matched"),
        F.least(hit, F.lit(limit)).cast("bigint").alias("returned"),
    )


def get_item(items: DataFrame, collection: str, item_id: str) -> DataFrame:
    return items.filter((F.col("collection") == collection) & (F.col("id") == item_id))


def get_collection(collections: DataFrame, collection_id: str) -> DataFrame:
    return collections.filter(F.col("id") == collection_id)


def items_in_known_collections(items: DataFrame, collections: DataFrame) -> DataFrame:
    known = collections.select(F.col("id").alias("collection"))
    return items.join(known, "collection", "left_semi")


def is_dem_item(assets: Column) -> Column:
    """Some asset is a cloud-optimised raster with an elevation or visual role."""
    return F.exists(
        F.map_values(assets),
        lambda a: (a["type"] == COG_TYPE) & F.arrays_overlap(a["roles"], F.array(*(F.lit(r) for r in DEM_ROLES))),
    )
