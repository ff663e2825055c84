"""Plane <-> geographic coordinates as Column arithmetic.

Transverse Mercator by the public Krueger series (four terms) on GRS80. One piece of
code serves both literals on the driver (``math``) and columns on the executors
(``pyspark.sql.functions``), so a request box and a table row get the same numbers.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .binding import let

# GRS80 and the plane zones (public EPSG parameters, EPSG = 6668 + zone).
SEMI_MAJOR = 6378137.0
FLATTENING = 1 / 298.257222101
SCALE = 0.9999
ZONES = {
    1: (129.5, 33.0),
    2: (131.0, 33.0),
    3: (132 + 10 / 60, 36.0),
    4: (133.5, 33.0),
    5: (134 + 20 / 60, 36.0),
    6: (136.0, 36.0),
    7: (137 + 10 / 60, 36.0),
    8: (138.5, 36.0),
    9: (139 + 50 / 60, 36.0),
    10: (140 + 50 / 60, 40.0),
    11: (140.25, 44.0),
    12: (142.25, 44.0),
    13: (144.25, 44.0),
    14: (142.0, 26.0),
    15: (127.5, 26.0),
    16: (124.0, 26.0),
    17: (131.0, 26.0),
    18: (136.0, 20.0),
    19: (154.0, 26.0),
}
GEOGRAPHIC = (4326, 6668)
WORLD = (-180.0, -90.0, 180.0, 90.0)
MERCATOR_RADIUS = 6378137.0
METRES_PER_DEGREE_LON = 111320.0
METRES_PER_DEGREE_LAT = 110540.0

_N = FLATTENING / (2 - FLATTENING)
_E = 2 * math.sqrt(_N) / (1 + _N)
RADIUS = SCALE * SEMI_MAJOR / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64)
ALPHA = (
    _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16 + 41 * _N**4 / 180,
    13 * _N**2 / 48 - 3 * _N**3 / 5 + 557 * _N**4 / 1440,
    61 * _N**3 / 240 - 103 * _N**4 / 140,
    49561 * _N**4 / 161280,
)
BETA = (
    _N / 2 - 2 * _N**2 / 3 + 37 * _N**3 / 96 - _N**4 / 360,
    _N**2 / 48 + _N**3 / 15 - 437 * _N**4 / 1440,
    17 * _N**3 / 480 - 37 * _N**4 / 840,
    4397 * _N**4 / 161280,
)
DELTA = (
    2 * _N - 2 * _N**2 / 3 - 2 * _N**3 + 116 * _N**4 / 45,
    7 * _N**2 / 3 - 8 * _N**3 / 5 - 227 * _N**4 / 45,
    56 * _N**3 / 15 - 136 * _N**4 / 35,
    4279 * _N**4 / 630,
)


def _isometric(m, lat):
    s = m.sin(lat)
    return m.sinh(m.atanh(s) - _E * m.atanh(_E * s))


def _stretched(m, xi1, eta1):
    """Coordinates on the conformal sphere -> scaled plane coordinates."""
    xi, eta = xi1, eta1
    for j, a in enumerate(ALPHA, start=1):
        xi = xi + a * m.sin(2 * j * xi1) * m.cosh(2 * j * eta1)
        eta = eta + a * m.cos(2 * j * xi1) * m.sinh(2 * j * eta1)
    return xi, eta


def _conformal(m, lat, dlon):
    """Angles (radians) -> scaled plane coordinates (xi, eta)."""
    t = _isometric(m, lat)
    return _stretched(m, m.atan2(t, m.cos(dlon)), m.atanh(m.sin(dlon) / m.sqrt(1 + t * t)))


def _meridian_offset(lat0: float) -> float:
    return RADIUS * _conformal(math, math.radians(lat0), 0.0)[0]


ZONE_PARAMETERS = {
    6668 + zone: (lon0, _meridian_offset(lat0)) for zone, (lon0, lat0) in ZONES.items()
}


def _forward(m, lon, lat, lon0, offset):
    xi, eta = _conformal(m, m.radians(lat), m.radians(lon - lon0))
    return RADIUS * eta, RADIUS * xi - offset


def _unstretched(m, xi, eta):
    """Scaled plane coordinates -> those of the conformal sphere."""
    xi1, eta1 = xi, eta
    for j, b in enumerate(BETA, start=1):
        xi1 = xi1 - b * m.sin(2 * j * xi) * m.cosh(2 * j * eta)
        eta1 = eta1 - b * m.cos(2 * j * xi) * m.sinh(2 * j * eta)
    return xi1, eta1


def _latitude(m, chi):
    lat = chi
    for j, d in enumerate(DELTA, start=1):
        lat = lat + d * m.sin(2 * j * chi)
    return m.degrees(lat)


def _inverse(m, x, y, lon0, offset):
    xi1, eta1 = _unstretched(m, (y + offset) / RADIUS, x / RADIUS)
    chi = m.asin(m.sin(xi1) / m.cosh(eta1))
    return lon0 + m.degrees(m.atan2(m.sinh(eta1), m.cos(xi1))), _latitude(m, chi)


def _parameters(epsg: int | Column) -> tuple[Column, Column]:
    """Central meridian and meridian offset of a zone; NULL when it is not supported."""
    if isinstance(epsg, int):
        found = ZONE_PARAMETERS.get(epsg, (None, None))
        return tuple(F.lit(v).cast("double") for v in found)
    table = F.create_map(*(
        v for code, p in ZONE_PARAMETERS.items() for v in (F.lit(code), F.array(F.lit(p[0]), F.lit(p[1])))
    ))
    found = F.try_element_at(table, epsg.cast("int"))
    return found[0], found[1]


def _unchanged(epsg: int | Column) -> Column:
    return F.lit(epsg in GEOGRAPHIC) if isinstance(epsg, int) else F.coalesce(epsg.isin(*GEOGRAPHIC), F.lit(False))


def _pair(x: Column, y: Column) -> Column:
    return F.struct(x.alias("x"), y.alias("y"))


def geographic(x: Column, y: Column, epsg: int | Column) -> Column:
    """struct(x=lon, y=lat) of a place; NULL members for a code that is not supported."""
    lon0, offset = _parameters(epsg)

    def sphere(v: Column) -> Column:
        xi1, eta1 = _unstretched(F, v["xi"], v["eta"])
        return let(lambda w: place(v, w), xi1=xi1, eta1=eta1)

    def place(v: Column, w: Column) -> Column:
        chi = F.asin(F.sin(w["xi1"]) / F.cosh(w["eta1"]))
        lon = v["lon0"] + F.degrees(F.atan2(F.sinh(w["eta1"]), F.cos(w["xi1"])))
        lat = let(lambda c: _latitude(F, c["chi"]), chi=chi)
        return F.when(v["keep"], _pair(v["x"], v["y"])).otherwise(_pair(lon, lat))

    x, y = x.cast("double"), y.cast("double")
    return let(
        sphere, keep=_unchanged(epsg), x=x, y=y, lon0=lon0, xi=(y + offset) / RADIUS, eta=x / RADIUS
    )


def plane(lon: Column, lat: Column, epsg: int | Column) -> Column:
    """struct(x=easting, y=northing) of a place; NULL members for an unsupported code."""
    lon0, offset = _parameters(epsg)

    def spread(v: Column) -> Column:
        return let(lambda w: stretch(v, w), xi1=F.atan2(v["t"], F.cos(v["d"])),
                   eta1=F.atanh(F.sin(v["d"]) / F.sqrt(1 + v["t"] * v["t"])))

    def stretch(v: Column, w: Column) -> Column:
        xi, eta = _stretched(F, w["xi1"], w["eta1"])
        return F.when(v["keep"], _pair(v["x"], v["y"])).otherwise(_pair(RADIUS * eta, RADIUS * xi - v["m"]))

    lon, lat = lon.cast("double"), lat.cast("double")
    return let(spread, keep=_unchanged(epsg), x=lon, y=lat, m=offset, t=_isometric(F, F.radians(lat)),
               d=F.radians(lon - lon0))


def to_wgs84(x: Column, y: Column, epsg: int | Column) -> tuple[Column, Column]:
    """(easting, northing) -> (lon, lat); NULL for a code that is not supported."""
    place = geographic(x, y, epsg)
    return place["x"], place["y"]


def from_wgs84(lon: Column, lat: Column, epsg: int | Column) -> tuple[Column, Column]:
    """(lon, lat) -> (easting, northing); NULL for a code that is not supported."""
    place = plane(lon, lat, epsg)
    return place["x"], place["y"]


def with_wgs84(df: DataFrame, x: str, y: str, epsg: int | Column, lon: str = "lon", lat: str = "lat") -> DataFrame:
    """Adds lon and lat to a point-sized table.

    Every intermediate value is a column of its own, so the whole chain stays plain
    arithmetic in generated code instead of one huge expression.
    """
    lon0, offset = _parameters(epsg)
    c = F.col
    step = df.withColumns({"_l0": lon0, "_xi": (c(y) + offset) / RADIUS, "_eta": c(x) / RADIUS})
    xi1, eta1 = _unstretched(F, c("_xi"), c("_eta"))
    step = step.withColumns({"_xi1": xi1, "_eta1": eta1})
    step = step.withColumn("_chi", F.asin(F.sin("_xi1") / F.cosh("_eta1")))
    keep = _unchanged(epsg)
    found_lon = c("_l0") + F.degrees(F.atan2(F.sinh("_eta1"), F.cos("_xi1")))
    return step.withColumns({
        lon: F.when(keep, c(x)).otherwise(found_lon), lat: F.when(keep, c(y)).otherwise(_latitude(F, c("_chi"))),
    }).drop("_l0", "_xi", "_eta", "_xi1", "_eta1", "_chi")


def with_plane(df: DataFrame, lon: str, lat: str, epsg: int | Column, x: str = "X", y: str = "Y") -> DataFrame:
    """Adds plane coordinates to a point-sized table, in the same staged way."""
    lon0, offset = _parameters(epsg)
    c = F.col
    step = df.withColumns({"_t": _isometric(F, F.radians(lat)), "_d": F.radians(c(lon) - lon0), "_m": offset})
    step = step.withColumns({
        "_xi1": F.atan2(c("_t"), F.cos("_d")), "_eta1": F.atanh(F.sin("_d") / F.sqrt(1 + c("_t") * c("_t"))),
    })
    xi, eta = _stretched(F, c("_xi1"), c("_eta1"))
    keep = _unchanged(epsg)
    made = step.withColumns({
        "_px": F.when(keep, c(lon)).otherwise(RADIUS * eta), "_py": F.when(keep, c(lat)).otherwise(RADIUS * xi - c("_m")),
    })
    return made.withColumns({x: c("_px"), y: c("_py")}).drop("_t", "_d", "_m", "_xi1", "_eta1", "_px", "_py")


def _corner_pairs(corners: int):
    if corners == 2:
        return ((0, 1), (2, 3))
    if corners == 4:
        return ((0, 1), (2, 1), (2, 3), (0, 3))
    raise ValueError("corners must be 2 or 4")


def plane_box(bbox: Column) -> tuple[Column, Column, Column, Column]:
    """minx, miny, maxx, maxy of a 4- or 6-value box column."""
    six = F.size(bbox) >= 6
    return (
        F.try_element_at(bbox, F.lit(1)),
        F.try_element_at(bbox, F.lit(2)),
        F.try_element_at(bbox, F.when(six, 4).otherwise(3)),
        F.try_element_at(bbox, F.when(six, 5).otherwise(4)),
    )


def bbox_to_wgs84(bbox: Column, epsg: int | Column, corners: int = 4) -> Column:
    """Box column -> [minlon, minlat, maxlon, maxlat]; a 6-value box keeps its Z values.

    NULL when the code is not supported or the box has neither 4 nor 6 values.
    """
    def moved(v: Column) -> Column:
        box = v["box"]
        flat = plane_box(box)
        corner = F.array(*(_pair(flat[i], flat[j]) for i, j in _corner_pairs(corners)))
        places = F.transform(corner, lambda c: geographic(c["x"], c["y"], v["epsg"] if column else epsg))
        return let(lambda w: rebuilt(box, w), xs=F.transform(places, lambda p: p["x"]), ys=F.transform(places, lambda p: p["y"]))

    def rebuilt(box: Column, w: Column) -> Column:
        low_x, low_y, high_x, high_y = F.array_min(w["xs"]), F.array_min(w["ys"]), F.array_max(w["xs"]), F.array_max(w["ys"])
        known = ~F.exists(w["xs"], lambda v: v.isNull()) & ~F.exists(w["ys"], lambda v: v.isNull())
        deep = F.array(low_x, low_y, F.try_element_at(box, F.lit(3)), high_x, high_y, F.try_element_at(box, F.lit(6)))
        return F.when(known & (F.size(box) == 4), F.array(low_x, low_y, high_x, high_y)).when(known & (F.size(box) == 6), deep)

    column = isinstance(epsg, Column)
    return let(moved, box=bbox, **({"epsg": epsg} if column else {}))


def literal_bbox_to_wgs84(
    bbox: Sequence[float], epsg: int, corners: int = 2
) -> tuple[float, float, float, float]:
    """The same for a request box on the driver (always four plane values)."""
    if len(bbox) not in (4, 6):
        raise ValueError("a bbox has 4 or 6 values")
    flat = (bbox[0], bbox[1], bbox[3], bbox[4]) if len(bbox) == 6 else tuple(bbox)
    if epsg in GEOGRAPHIC:
        return flat
    if epsg not in ZONE_PARAMETERS:
        raise ValueError(f"unsupported EPSG code {epsg}")
    places = [
        _inverse(math, flat[i], flat[j], *ZONE_PARAMETERS[epsg]) for i, j in _corner_pairs(corners)
    ]
    lons, lats = zip(*places)
    return min(lons), min(lats), max(lons), max(lats)


def literal_bbox_from_wgs84(
    bbox: Sequence[float], epsg: int, corners: int = 4
) -> tuple[float, float, float, float]:
    """Geographic request box -> box in a plane zone, on the driver."""
    if epsg in GEOGRAPHIC:
        return tuple(bbox)
    places = [
        _forward(math, bbox[i], bbox[j], *ZONE_PARAMETERS[epsg]) for i, j in _corner_pairs(corners)
    ]
    xs, ys = zip(*places)
    return min(xs), min(ys), max(xs), max(ys)


def is_native(bbox: Column) -> Column:
    """True when any of the values cannot be degrees (absolute value over 180)."""
    return F.exists(bbox, lambda v: F.abs(v) > 180)


def detect_crs(bbox: Column) -> Column:
    return F.when(is_native(bbox), F.lit("native")).otherwise(F.lit("wgs84"))


def extent_m(bbox: Column) -> Column:
    """Longer side in metres; degrees are converted with fixed metres per degree."""
    west, south, east, north = plane_box(bbox)
    degrees = (F.abs(west) <= 180) & (F.abs(east) <= 180)
    middle = F.radians((south + north) / 2)
    wide = (east - west) * METRES_PER_DEGREE_LON * F.cos(middle)
    high = (north - south) * METRES_PER_DEGREE_LAT
    return F.when(degrees, F.greatest(wide, high)).otherwise(
        F.greatest(east - west, north - south)
    )


def to_mercator(lon: Column, lat: Column) -> tuple[Column, Column]:
    return (
        F.radians(lon) * MERCATOR_RADIUS,
        F.log(F.tan(math.pi / 4 + F.radians(lat) / 2)) * MERCATOR_RADIUS,
    )


def from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return (
        F.degrees(x / MERCATOR_RADIUS),
        F.degrees(F.atan(F.sinh(y / MERCATOR_RADIUS))),
    )


def tile_of(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    """Column and row of the web map tile that holds a location."""
    count = float(2**zoom)
    rad = F.radians(lat)
    x = F.floor((lon + 180) / 360 * count)
    y = F.floor((1 - F.log(F.tan(rad) + 1 / F.cos(rad)) / math.pi) / 2 * count)
    last = F.lit(2**zoom - 1)
    zero = F.lit(0)
    return F.least(F.greatest(x, zero), last), F.least(F.greatest(y, zero), last)
