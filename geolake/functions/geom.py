"""Geometries as ``struct<type, polygons>`` columns.

``polygons`` is polygons > rings > vertices > ordinates, so a Polygon, a MultiPolygon and a
Point (one ring of one vertex) share one shape and one set of predicates.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import crs
from .binding import let

_VERTICES = "array<array<double>>"


def _geometry(kind: Column, polygons: Column) -> Column:
    return let(
        lambda v: F.when(v["p"].isNotNull(), F.struct(v["k"].alias("type"), v["p"].alias("polygons"))), k=kind, p=polygons
    )


def _first_vertex(polygons: Column) -> Column:
    first = F.try_element_at(F.try_element_at(polygons, F.lit(1)), F.lit(1))
    return F.try_element_at(first, F.lit(1))


def bbox_ring(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Closed ring of a box, counter-clockwise from the lower left corner."""
    return F.array(
        F.array(minx, miny), F.array(maxx, miny), F.array(maxx, maxy),
        F.array(minx, maxy), F.array(minx, miny),
    )


def bbox_polygon(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    ring = F.when(minx.isNotNull() & maxy.isNotNull(), bbox_ring(minx, miny, maxx, maxy))
    return _geometry(F.lit("Polygon"), F.when(ring.isNotNull(), F.array(F.array(ring))))


def from_geojson(text: Column) -> Column:
    """Geometry object as JSON text -> geometry; NULL for other kinds and for broken text."""
    def read(v: Column) -> Column:
        kind, raw = v["kind"], v["raw"]
        point = F.from_json(raw, "array<double>")
        polygon = F.from_json(raw, f"array<{_VERTICES}>")
        multi = F.from_json(raw, f"array<array<{_VERTICES}>>")
        polygons = (
            F.when(kind == "Point", F.array(F.array(F.array(point))))
            .when(kind == "Polygon", F.array(polygon))
            .when(kind == "MultiPolygon", multi)
        )
        # a list that could not be read comes back as NULL vertices or rings; named once, it is read once
        return let(lambda r: F.when(_first_vertex(r["p"]).isNotNull(), _geometry(kind, r["p"])), p=polygons)

    return let(read, kind=F.get_json_object(text, "$.type"), raw=F.get_json_object(text, "$.coordinates"))


def to_geojson(geometry: Column) -> Column:
    def write(v: Column) -> Column:
        g = v["g"]
        kind, polygons = g["type"], g["polygons"]
        coordinates = (
            F.when(kind == "Point", F.to_json(_first_vertex(polygons)))
            .when(kind == "Polygon", F.to_json(F.try_element_at(polygons, F.lit(1))))
            .otherwise(F.to_json(polygons))
        )
        return F.when(
            g.isNotNull(), F.concat(F.lit('{"type":"'), kind, F.lit('","coordinates":'), coordinates, F.lit("}"))
        )

    return let(write, g=geometry)


def _vertex_text(vertex: Column) -> Column:
    return F.array_join(F.transform(vertex, lambda v: v.cast("string")), " ")


def _rings_text(polygon: Column) -> Column:
    rings = F.transform(
        polygon,
        lambda ring: F.concat(
            F.lit("("), F.array_join(F.transform(ring, _vertex_text), ", "), F.lit(")")
        ),
    )
    return F.concat(F.lit("("), F.array_join(rings, ", "), F.lit(")"))


def to_wkt(geometry: Column) -> Column:
    def write(v: Column) -> Column:
        kind, polygons = v["g"]["type"], v["g"]["polygons"]
        many = F.array_join(F.transform(polygons, _rings_text), ", ")
        return (
            F.when(kind == "Point", F.concat(F.lit("POINT ("), _vertex_text(_first_vertex(polygons)), F.lit(")")))
            .when(kind == "Polygon", F.concat(F.lit("POLYGON "), _rings_text(F.try_element_at(polygons, F.lit(1)))))
            .when(kind == "MultiPolygon", F.concat(F.lit("MULTIPOLYGON ("), many, F.lit(")")))
        )

    return let(write, g=geometry)


def from_wkt(text: Column) -> Column:
    """WKT of a point, polygon or multipolygon -> geometry; NULL for anything else.

    The bracketed list is rewritten as a JSON array and read with ``from_json``.
    """
    number = r"[-+0-9.eE]+"
    body = F.regexp_extract(text, r"(\(.*\))\s*$", 1)
    commas = F.regexp_replace(body, rf"({number})\s+(?={number})", "$1;")
    vertices = F.regexp_replace(commas, rf"({number}(?:;{number})*)", "[$1]")

    def read(v: Column) -> Column:
        head, json = v["head"], v["json"]
        point = F.try_element_at(F.from_json(json, _VERTICES), F.lit(1))
        polygons = (
            F.when(head == "POINT", F.array(F.array(F.array(point))))
            .when(head == "POLYGON", F.array(F.from_json(json, f"array<{_VERTICES}>")))
            .when(head == "MULTIPOLYGON", F.from_json(json, f"array<array<{_VERTICES}>>"))
        )
        kind = F.when(head == "POINT", "Point").when(head == "POLYGON", "Polygon").otherwise("MultiPolygon")
        return _geometry(kind, polygons)

    head = F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
    return let(read, head=head, json=F.translate(vertices, "();", "[],"))


def to_wgs84(geometry: Column, epsg: int | Column) -> Column:
    """Every vertex reprojected; further ordinates (Z) pass through."""
    column = isinstance(epsg, Column)

    def moved(v: Column) -> Column:
        def move(vertex: Column) -> Column:
            place = crs.geographic(vertex[0], vertex[1], v["epsg"] if column else epsg)
            rest = F.slice(vertex, F.lit(3), F.greatest(F.size(vertex) - 2, F.lit(0)))
            return let(lambda w: F.concat(F.array(w["p"]["x"], w["p"]["y"]), rest), p=place)

        polygons = F.transform(v["g"]["polygons"], lambda polygon: F.transform(polygon, lambda ring: F.transform(ring, move)))
        return _geometry(v["g"]["type"], polygons)

    return let(moved, g=geometry, **({"epsg": epsg} if column else {}))


def bounds(geometry: Column) -> Column:
    """[minx, miny, maxx, maxy] over all vertices."""
    def box(v: Column) -> Column:
        xs, ys = F.transform(v["v"], lambda p: p[0]), F.transform(v["v"], lambda p: p[1])
        return F.when(
            F.size(v["v"]) > 0, F.array(F.array_min(xs), F.array_min(ys), F.array_max(xs), F.array_max(ys))
        )

    return let(box, v=F.flatten(F.flatten(geometry["polygons"])))


def intersects_box(geometry: Column, minx, miny, maxx, maxy) -> Column:
    """Closed intersection of a geometry with a box: touching counts.

    Either an edge meets the box (separating axes: x, y and the edge normal), or no edge
    does and the box lies wholly in one face, decided by the parity of one corner.
    """
    west, south, east, north = (
        v if isinstance(v, Column) else F.lit(float(v)) for v in (minx, miny, maxx, maxy)
    )

    def edges(ring: Column) -> Column:
        last = F.size(ring) - 1
        return F.transform(
            F.sequence(F.lit(0), F.greatest(last - 1, F.lit(0))),
            lambda i: F.struct(
                ring[i][0].alias("x1"), ring[i][1].alias("y1"),
                ring[F.least(i + 1, last)][0].alias("x2"),
                ring[F.least(i + 1, last)][1].alias("y2"),
            ),
        )

    rings = F.flatten(geometry["polygons"])
    all_edges = F.flatten(F.transform(F.filter(rings, lambda r: F.size(r) > 0), edges))

    def side(e: Column, x: Column, y: Column) -> Column:
        return (e["x2"] - e["x1"]) * (y - e["y1"]) - (e["y2"] - e["y1"]) * (x - e["x1"])

    def meets(e: Column) -> Column:
        sides = [side(e, x, y) for x in (west, east) for y in (south, north)]
        return (
            (F.least(e["x1"], e["x2"]) <= east) & (F.greatest(e["x1"], e["x2"]) >= west)
            & (F.least(e["y1"], e["y2"]) <= north) & (F.greatest(e["y1"], e["y2"]) >= south)
            & (F.least(*sides) <= 0) & (F.greatest(*sides) >= 0)
        )

    def crossed(e: Column) -> Column:
        spans = (e["y1"] > south) != (e["y2"] > south)
        at = e["x1"] + (e["x2"] - e["x1"]) * F.try_divide(south - e["y1"], e["y2"] - e["y1"])
        return spans & (west < at)

    def decide(v: Column) -> Column:
        return F.exists(v["e"], meets) | (F.size(F.filter(v["e"], crossed)) % 2 == 1)

    return let(decide, e=all_edges)
