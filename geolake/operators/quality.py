"""Checks on documents, items, rasters and points. Findings are rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import crs, geom, text
from ..session import cut_lineage, written

# Fields and values of the point-cloud extension.
REQUIRED = ("pc:count", "pc:type")
RECOMMENDED = ("pc:encoding", "pc:schemas", "pc:density", "pc:statistics")
CLOUD_TYPES = ("lidar", "eopc", "radar", "sonar", "other")
ERROR, WARNING = "error", "warning"


def _issue(when: Column, check: str, severity: str, kind: str, field: str | None, breaks: bool) -> Column:
    return F.when(when, F.struct(
        F.lit(check).alias("check"), F.lit(severity).alias("severity"), F.lit(kind).alias("kind"),
        F.lit(field).cast("string").alias("field"), F.lit(breaks).alias("invalidates"),
    ))


def _issues(df: DataFrame, keys: Sequence, found: Sequence[Column]) -> DataFrame:
    """Failed checks of a row, unrolled; one narrow pass, no shuffle."""
    return df.select(*keys, F.inline(F.filter(F.array(*found), lambda i: i.isNotNull())))


def edges_of(docs: DataFrame) -> DataFrame:
    """Links of every document: src, rel, dst (relative links resolved to paths)."""
    links = F.from_json(F.get_json_object("doc", "$.links"), schemas.LINKS)
    return docs.select("path", F.explode(links).alias("l")).select(
        F.col("path").alias("src"), F.col("l.rel").alias("rel"),
        text.resolve_href(F.col("path"), F.col("l.href")).alias("dst"),
    )


def walk_catalog(edges: DataFrame, roots: DataFrame, follow: Sequence[str] = ("child", "item")) -> DataFrame:
    """Everything reachable from the roots: path, depth, kind; each node at its least depth.

    One equi join per tree level and an anti join against what was seen, so cycles end.
    Lineage is cut by a reliable checkpoint at each level; levels are few, nodes may be many.
    """
    step = edges.filter(F.col("rel").isin(*follow)).select("src", "rel", "dst")
    frontier = cut_lineage(roots.select(F.col("path"), F.lit(0).alias("depth"), F.lit("root").alias("kind")).distinct())
    seen, depth = frontier, 0
    while True:
        depth += 1
        found = (
            frontier.join(step, F.col("path") == F.col("src"))
            .groupBy("dst").agg(F.min("rel").alias("kind"))
            .select(F.col("dst").alias("path"), F.lit(depth).alias("depth"), "kind")
        )
        frontier = cut_lineage(found.join(seen, "path", "left_anti"))
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)


def link_integrity(docs: DataFrame, edges: DataFrame, follow: Sequence[str] = ("child", "item")) -> DataFrame:
    """Documents no link leads to ('unreachable') and links to nothing ('dangling')."""
    used = edges.filter(F.col("rel").isin(*follow))
    lost = docs.filter(F.col("type") != "Catalog").select("path").join(
        used.select(F.col("dst").alias("path")), "path", "left_anti"
    )
    broken = used.select(F.col("dst").alias("path")).distinct().join(docs.select("path"), "path", "left_anti")
    return lost.withColumn("problem", F.lit("unreachable")).unionByName(broken.withColumn("problem", F.lit("dangling")))


def _other_shape(geometry: Column) -> Column:
    """A well-formed geometry of a kind that index rows do not hold: lines, several points, collections."""
    places = F.get_json_object(geometry, "$.coordinates")

    def vertices(line: Column, least: int) -> Column:
        return (F.size(line) >= least) & F.forall(line, lambda v: (F.size(v) >= 2) & F.forall(v, lambda x: x.isNotNull()))

    line = F.from_json(places, "array<array<double>>")
    lines = F.from_json(places, "array<array<array<double>>>")
    sound = (
        F.when(F.get_json_object(geometry, "$.type") == "LineString", vertices(line, 2))
        .when(F.get_json_object(geometry, "$.type") == "MultiPoint", vertices(line, 0))
        .when(F.get_json_object(geometry, "$.type") == "MultiLineString", F.forall(lines, lambda v: vertices(v, 2)))
        .when(F.get_json_object(geometry, "$.type") == "GeometryCollection", F.get_json_object(geometry, "$.geometries").startswith("["))
    )
    return F.coalesce(sound, F.lit(False))


def validate_structure(docs: DataFrame) -> DataFrame:
    """Declared rules per document kind -> one row per broken rule."""
    d = docs.withColumn("_i", F.from_json("doc", schemas.ITEM)).withColumn("_c", F.from_json("doc", schemas.COLLECTION))
    item, group, root = (F.col("type") == k for k in ("Feature", "Collection", "Catalog"))
    known = item | group | root
    box = F.from_json("_i.bbox", "array<double>")
    shape = geom.from_geojson(F.col("_i.geometry"))
    when = F.col("_i.properties.datetime")
    span = F.from_json("_c.extent.spatial.bbox", "array<array<double>>")
    said = F.get_json_object("doc", "$.geometry").isNotNull()
    rules = [
        ("unreadable", F.col("type").isNull(), None),
        ("unknown_type", F.col("type").isNotNull() & ~known, "type"),
        ("missing_id", known & F.col("_i.id").isNull(), "id"),
        ("missing_version", known & F.col("_i.stac_version").isNull(), "stac_version"),
        ("missing_links", known & F.col("_i.links").isNull(), "links"),
        ("bad_bbox", item & F.col("_i.bbox").isNotNull() & ~F.coalesce(F.size(box).isin(4, 6), F.lit(False)), "bbox"),
        ("missing_bbox", item & said & F.col("_i.bbox").isNull(), "bbox"),
        ("bad_geometry", item & said & shape.isNull() & ~_other_shape(F.col("_i.geometry")), "geometry"),
        ("missing_datetime", item & when.isNull(), "datetime"),
        ("bad_datetime", item & when.isNotNull() & F.try_to_timestamp(when).isNull(), "datetime"),
        ("missing_assets", item & F.col("_i.assets").isNull(), "assets"),
        ("missing_license", group & F.col("_c.license").isNull(), "license"),
        ("missing_description", (group | root) & F.col("_c.description").isNull(), "description"),
        ("bad_extent", group & ~F.coalesce(F.size(F.try_element_at(span, F.lit(1))).isin(4, 6), F.lit(False)), "extent"),
    ]
    found = [_issue(F.coalesce(test, F.lit(False)), "structure", ERROR, kind, field, True) for kind, test, field in rules]
    return _issues(d, ["path", F.col("_i.id").alias("id")], found)


def structure_counts(docs: DataFrame) -> DataFrame:
    return docs.agg(*(
        F.count_if(F.col("type") == k).alias(n)
        for k, n in (("Catalog", "catalogs"), ("Collection", "collections"), ("Feature", "items"))
    ))


def validate_pointcloud(docs: DataFrame) -> DataFrame:
    """Point-cloud fields of Feature documents.

    A count that is no integer is an error that leaves the item valid, as the checks this
    follows treat it.
    """
    raw, keys, count, kind = (F.col(c) for c in ("_raw", "_keys", "_count", "_kind"))

    def lacks(name: str) -> Column:
        return ~F.coalesce(F.array_contains(keys, name), F.lit(False))

    quoted = raw.rlike(r'"pc:count"\s*:\s*"')
    assets = F.from_json(F.get_json_object("doc", "$.assets"), schemas.ASSETS)
    found = [_issue(lacks(n), "pointcloud", ERROR, "missing_required", n, True) for n in REQUIRED]
    found += [_issue(lacks(n), "pointcloud", WARNING, "missing_recommended", n, False) for n in RECOMMENDED]
    found += [
        _issue(count.isNotNull() & (quoted | ~count.rlike(r"^-?[0-9]+$")), "pointcloud", ERROR, "invalid_type", "pc:count", False),
        _issue(kind.isNotNull() & (kind != "") & ~kind.isin(*CLOUD_TYPES), "pointcloud", WARNING, "non_standard_value", "pc:type", False),
        _issue(~F.coalesce(F.map_contains_key(assets, "data"), F.lit(False)), "pointcloud", WARNING, "missing_data_asset", None, False),
    ]
    def prop(name: str) -> Column:
        return F.get_json_object("doc", f"$.properties['{name}']")

    # Each part is read from the document once, however many checks look at it.
    features = docs.filter(F.col("type") == "Feature").withColumns({
        "_raw": F.get_json_object("doc", "$.properties"), "_count": prop("pc:count"), "_kind": prop("pc:type")}).withColumn("_keys", F.json_object_keys("_raw"))
    return _issues(features, ["path", F.get_json_object("doc", "$.id").alias("id")], found)


def validation_report(issues: DataFrame, checks: Sequence[str] = ("structure", "pointcloud")) -> DataFrame:
    """Per check: validity, errors, warnings; and 'overall' as their conjunction.

    Checks without findings are valid rows, so the report always has every check.
    """
    spark = issues.sparkSession
    names = spark.createDataFrame([(c,) for c in checks], "check string")
    # A row for each check, used twice below.
    counted = written(issues.groupBy("check").agg(
        F.count_if(F.col("severity") == ERROR).alias("errors"),
        F.count_if(F.col("severity") == WARNING).alias("warnings"),
        F.bool_or("invalidates").alias("broken"),
    ), "issues")
    rows = names.join(counted, "check", "left").select(
        "check",
        (~F.coalesce("broken", F.lit(False))).alias("valid"),
        F.coalesce("errors", F.lit(0)).cast("bigint").alias("errors"),
        F.coalesce("warnings", F.lit(0)).cast("bigint").alias("warnings"),
    )
    return rows.unionByName(rows.agg(
        F.lit("overall").alias("check"), F.bool_and("valid").alias("valid"),
        F.sum("errors").alias("errors"), F.sum("warnings").alias("warnings"),
    ))


def write_report(report: DataFrame, path: str) -> None:
    report.write.mode("overwrite").json(path)


def duplicate_documents(docs: DataFrame) -> DataFrame:
    """(type, collection, id) held by more than one document."""
    d = F.from_json("doc", "id string, collection string")
    return (
        docs.withColumn("_d", d)
        .groupBy("type", F.col("_d.collection").alias("collection"), F.col("_d.id").alias("id"))
        .agg(F.count("*").alias("copies"), F.min("path").alias("first_path"))
        .filter(F.col("copies") > 1)
    )


def missing_assets(items: DataFrame, inventory: DataFrame, base_url: str) -> DataFrame:
    """Absolute asset links whose key is not in the inventory; relative links are skipped."""
    base = base_url.rstrip("/") + "/"
    listed = items.select(F.col("id"), F.explode(F.map_entries("assets")).alias("a")).select(
        "id", F.col("a.key").alias("asset"), F.col("a.value.href").alias("href")
    ).filter(text.has_scheme(F.col("href")))
    keyed = listed.withColumn("key", F.replace(F.col("href"), F.lit(base), F.lit("")))
    return keyed.join(inventory.select("key"), "key", "left_anti")


def lineage(derived: DataFrame, sources: DataFrame, reference: str = "source_pointcloud") -> DataFrame:
    """Derived items with the item they came from (by the stem of the source file name)."""
    parents = sources.select(F.col("id").alias("source_id"), *(F.col(c).alias(f"source_{c}") for c in ("minx", "miny", "maxx", "maxy")))
    stem = F.coalesce(F.nullif(text.bare_stem(F.col(reference)), F.lit("")), F.lit(""))
    return derived.withColumn("_stem", stem).join(parents, F.col("_stem") == F.col("source_id"), "left").drop("_stem")


def _overlap(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return (a[0] <= b[2]) & (a[2] >= b[0]) & (a[1] <= b[3]) & (a[3] >= b[1])


def check_locations(items: DataFrame, regions: dict[str, Sequence[float]], corners: int = 4) -> DataFrame:
    """Is every item inside the region expected of its collection?

    'ok', 'swapped' (it would be with its native axes exchanged), 'elsewhere', or 'unknown'
    (no box, code or region). Regions are a literal map of boxes in degrees.
    """
    table = F.create_map(*(
        v for name, box in regions.items() for v in (F.lit(name), F.array(*(F.lit(float(x)) for x in box)))
    ))
    placed = items.withColumn("_r", F.try_element_at(table, F.col("collection")))
    box = list(crs.plane_box(F.col("proj_bbox")))
    turned = F.array(box[1], box[0], box[3], box[2])
    straight = crs.bbox_to_wgs84(F.array(*box), F.col("proj_epsg"), corners)
    swapped = crs.bbox_to_wgs84(turned, F.col("proj_epsg"), corners)
    placed = placed.withColumns({"_a": straight, "_b": swapped})
    r = [F.col("_r")[i] for i in range(4)]
    ok = _overlap([F.col("_a")[i] for i in range(4)], r)
    flipped = _overlap([F.col("_b")[i] for i in range(4)], r)
    status = F.when(ok.isNull(), "unknown").when(ok, "ok").when(flipped, "swapped").otherwise("elsewhere")
    return placed.withColumn("location", status).drop("_r", "_a", "_b")


def check_derived(derived: DataFrame, sources: DataFrame, reference: str = "source_pointcloud") -> DataFrame:
    """Derived items that do not overlap the item they came from."""
    pairs = lineage(derived, sources, reference).filter(F.col("source_id").isNotNull())
    names = ("minx", "miny", "maxx", "maxy")
    return pairs.filter(~_overlap([F.col(n) for n in names], [F.col(f"source_{n}") for n in names]))


def validate_raster(header: DataFrame, cells: DataFrame, tolerance: float = 1e-6) -> DataFrame:
    """Grid consistency per raster: cell count, duplicates, out-of-grid cells, box."""
    counted = cells.groupBy("raster_id", "row", "col").agg(F.count("*").alias("n")).groupBy("raster_id").agg(
        F.count("*").alias("cells"), F.count_if(F.col("n") > 1).alias("duplicated"),
        F.min("row").alias("row0"), F.max("row").alias("row1"), F.min("col").alias("col0"), F.max("col").alias("col1"),
    )
    joined = header.join(counted, "raster_id", "left")
    b = F.col("bbox")
    inside = (F.col("row0") >= 0) & (F.col("row1") < F.col("height")) & (F.col("col0") >= 0) & (F.col("col1") < F.col("width"))
    sized = (
        (F.abs((b[2] - b[0]) - F.col("width") * F.col("resolution")) <= tolerance)
        & (F.abs((b[3] - b[1]) - F.col("height") * F.col("resolution")) <= tolerance)
    )
    return joined.select(
        "raster_id",
        F.coalesce("cells", F.lit(0)).alias("cells"),
        (F.col("width").cast("bigint") * F.col("height")).alias("expected"),
        (F.coalesce("duplicated", F.lit(0)) == 0).alias("unique"),
        F.coalesce(inside, F.lit(False)).alias("inside"),
        sized.alias("sized"),
        (F.coalesce("cells", F.lit(0)) == F.col("width").cast("bigint") * F.col("height")).alias("complete"),
    )


# Plausible ranges of native coordinates and elevations (metres).
PLAUSIBLE = {"X": (-1e6, 1e6), "Y": (-1e6, 1e6), "Z": (-500.0, 9000.0)}


def check_points(points: DataFrame, by: Sequence[str] = ("source_file",)) -> DataFrame:
    """Per file: points present, all coordinates finite and plausible."""
    finite = reduce(lambda a, b: a & b, (
        F.col(d).isNotNull() & ~F.isnan(d) & (F.abs(d) < float("inf")) for d in PLAUSIBLE
    ))
    likely = reduce(lambda a, b: a & b, (F.col(d).between(*r) for d, r in PLAUSIBLE.items()))
    counted = points.groupBy(*by).agg(
        F.count("*").alias("points"), F.count_if(~finite).alias("not_finite"),
        F.count_if(finite & ~likely).alias("implausible"),
    )
    valid = (F.col("points") > 0) & (F.col("not_finite") == 0) & (F.col("implausible") == 0)
    return counted.withColumn("valid", valid)
