"""Queries over the item view, scalar geography and catalog building."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from ..functions import crs, geom, text
from ..operators import catalog_build as build
from ..operators import points as pts
from ..operators import quality, search, sync
from ..session import scratch_dir
from .registry import query, rounded
from .views import ITEMS, META, POINTS, items, meta, points, table

TIME = "strftime(datetime, '%Y-%m-%d %H:%M:%S.%f') AS datetime"
ORDER = "ORDER BY v.datetime DESC NULLS LAST, id, collection"
HIT = f"SELECT id, collection, strftime(v.datetime, '%Y-%m-%d %H:%M:%S.%f') AS datetime, pc_count FROM v_items v"
NATIVE_BOX = (19600.0, -70000.0, 28000.0, -60000.0)
BOX = "138.7,35.35,138.75,35.42"
RANGE = "2024-01-05T00:00:00Z/2024-01-20T23:59:59Z"


def _hits(df):
    return df.select("id", "collection", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("datetime"), "pc_count")


def _in_box(west, south, east, north):
    return f"(minx IS NULL OR (maxx >= {west!r}::DOUBLE AND minx <= {east!r}::DOUBLE AND maxy >= {south!r}::DOUBLE AND miny <= {north!r}::DOUBLE))"


_BOX_SQL = _in_box(138.7, 35.35, 138.75, 35.42)
_RANGE_SQL = "v.datetime >= TIMESTAMP '2024-01-05 00:00:00' AND v.datetime <= TIMESTAMP '2024-01-20 23:59:59'"


@query("search_collections", f"WITH {ITEMS} {HIT} WHERE collection IN ('click', 'error') {ORDER} LIMIT 100")
def search_collections(spark, sf_dir):
    return _hits(search.search(items(spark, sf_dir), limit=100, collections=["click", "error"]))


@query("search_ids", f"WITH {ITEMS} {HIT} WHERE id IN ('item-1', 'item-97', 'item-200', 'none') {ORDER} LIMIT 10")
def search_ids(spark, sf_dir):
    return _hits(search.search(items(spark, sf_dir), ids=["item-1", "item-97", "item-200", "none"]))


@query("search_bbox", f"WITH {ITEMS} {HIT} WHERE {_BOX_SQL} {ORDER} LIMIT 100")
def search_bbox(spark, sf_dir):
    return _hits(search.search(items(spark, sf_dir), limit=100, bbox=BOX))


@query("search_bbox_native", f"WITH {ITEMS} {HIT} WHERE {_in_box(*crs.literal_bbox_to_wgs84(NATIVE_BOX, 6676, 2))} {ORDER} LIMIT 100")
def search_bbox_native(spark, sf_dir):
    return _hits(search.search(items(spark, sf_dir), limit=100, bbox=NATIVE_BOX, bbox_crs="EPSG:6676"))


@query("search_datetime", f"WITH {ITEMS} {HIT} WHERE {_RANGE_SQL} {ORDER} LIMIT 100")
def search_datetime(spark, sf_dir):
    return _hits(search.search(items(spark, sf_dir), limit=100, datetime=RANGE))


@query("search_open_ranges", f"""WITH {ITEMS} SELECT
  count(*) FILTER (WHERE datetime >= TIMESTAMP '2024-01-15 00:00:00') AS open_end,
  count(*) FILTER (WHERE datetime <= TIMESTAMP '2024-01-15 00:00:00') AS open_start,
  count(*) FILTER (WHERE datetime >= TIMESTAMP '2024-01-05 00:00:00' AND datetime <= TIMESTAMP '2024-01-20 23:59:59') AS closed FROM v_items""")
def search_open_ranges(spark, sf_dir):
    found = items(spark, sf_dir)
    parts = {"open_end": "2024-01-15T00:00:00Z/..", "open_start": "/2024-01-15T00:00:00Z", "closed": RANGE}
    return found.agg(*(F.count_if(search.matches(found, datetime=v)).alias(k) for k, v in parts.items()))


@query("search_combined", f"""WITH {ITEMS} {HIT} WHERE collection IN ('click', 'view', 'purchase') AND {_BOX_SQL} AND {_RANGE_SQL} {ORDER} LIMIT 25""")
def search_combined(spark, sf_dir):
    return _hits(search.search(
        items(spark, sf_dir), limit=25, collections=["click", "view", "purchase"], bbox=BOX, datetime=RANGE
    ))


@query("search_counts", f"""WITH {ITEMS} SELECT count(*) AS total, count(*) FILTER (WHERE {_BOX_SQL} AND {_RANGE_SQL}) AS matched,
  least(count(*) FILTER (WHERE {_BOX_SQL} AND {_RANGE_SQL}), 10) AS returned FROM v_items v""")
def search_counts(spark, sf_dir):
    return search.search_counts(items(spark, sf_dir), bbox=BOX, datetime=RANGE)


@query("search_sortby", f"WITH {ITEMS} {HIT} WHERE collection IN ('view') ORDER BY pc_count DESC NULLS LAST, title ASC NULLS LAST, v.datetime DESC NULLS LAST, id, collection LIMIT 50")
def search_sortby(spark, sf_dir):
    rules = [{"field": "pc:count", "direction": "desc"}, {"field": "title", "direction": "asc"}]
    return _hits(search.search(items(spark, sf_dir), limit=50, sortby=rules, collections=["view"]))


@query("item_lookup", f"WITH {ITEMS} {HIT} JOIN (SELECT max(event_id) AS m FROM events) ON v.event_id = m")
def item_lookup(spark, sf_dir):
    found = items(spark, sf_dir)
    last = table(spark, sf_dir, "events").agg(F.max_by("event_type", "event_id").alias("c"), F.max("event_id").alias("e"))
    key = last.select(F.struct("c", F.concat(F.lit("item-"), F.col("e").cast("string")).alias("i")).alias("k")).scalar()
    return _hits(search.get_item(found.withColumn("_k", key), F.col("_k.c"), F.col("_k.i")))


def _collections(spark, sf_dir):
    found = items(spark, sf_dir)
    return found.groupBy(F.col("collection").alias("id")).agg(
                F.array(F.min("minx"), F.min("miny"), F.max("maxx"), F.max("maxy")).alias("bbox"),
        F.date_format(F.min("datetime"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("start_datetime"),
        F.lit(None).cast("string").alias("end_datetime"), F.count("*").alias("items"),
    ).withColumns({
        "title": F.concat(F.lit("Events: "), F.col("id")), "description": F.lit("Recorded events"),
        "license": F.lit("proprietary"),
    })


@query("known_collections", f"""WITH {ITEMS} SELECT collection, count(*) AS items FROM v_items
WHERE collection IN (SELECT event_type FROM events GROUP BY 1 HAVING max(value) > 50 AND event_type <> 'error') GROUP BY 1""")
def known_collections(spark, sf_dir):
    found = items(spark, sf_dir)
    known = found.groupBy(F.col("collection").alias("id")).agg(F.max("score").alias("s")).filter("s > 50 AND id <> 'error'")
    return search.items_in_known_collections(found, known).groupBy("collection").agg(F.count("*").alias("items"))


# --- scalar geography -------------------------------------------------------------------


def inverse_sql(x: str, y: str, source: str, zone: str, extra: str, prefix: str) -> str:
    """CTEs that end in {prefix}geo(lon, lat, extra) for plane columns of a source."""
    lon0 = "CASE " + " ".join(f"WHEN {zone} = {k} THEN {v[0]!r}::DOUBLE" for k, v in crs.ZONE_PARAMETERS.items()) + " END"
    m0 = "CASE " + " ".join(f"WHEN {zone} = {k} THEN {v[1]!r}::DOUBLE" for k, v in crs.ZONE_PARAMETERS.items()) + " END"
    r = f"{crs.RADIUS!r}::DOUBLE"
    xi = "xi" + "".join(f" - {b!r}::DOUBLE * sin({2*j}*xi) * cosh({2*j}*eta)" for j, b in enumerate(crs.BETA, 1))
    eta = "eta" + "".join(f" - {b!r}::DOUBLE * cos({2*j}*xi) * sinh({2*j}*eta)" for j, b in enumerate(crs.BETA, 1))
    lat = "chi" + "".join(f" + {d!r}::DOUBLE * sin({2*j}*chi)" for j, d in enumerate(crs.DELTA, 1))
    p = prefix
    return f"""{p}a AS (SELECT {extra}, {lon0} AS lon0, ({y} + {m0}) / {r} AS xi, {x} / {r} AS eta FROM {source}),
{p}b AS (SELECT *, {xi} AS xi1, {eta} AS eta1 FROM {p}a),
{p}c AS (SELECT *, asin(sin(xi1) / cosh(eta1)) AS chi FROM {p}b),
{p}geo AS (SELECT {extra}, lon0 + degrees(atan2(sinh(eta1), cos(xi1))) AS lon, degrees({lat}) AS lat FROM {p}c)"""


def forward_sql(lon: str, lat: str, source: str, epsg: int, extra: str, prefix: str) -> str:
    """CTEs that end in {prefix}plane(x, y, extra) for one zone."""
    lon0, m0 = crs.ZONE_PARAMETERS[epsg]
    e, r = f"{crs._E!r}::DOUBLE", f"{crs.RADIUS!r}::DOUBLE"
    xi = "xi1" + "".join(f" + {a!r}::DOUBLE * sin({2*j}*xi1) * cosh({2*j}*eta1)" for j, a in enumerate(crs.ALPHA, 1))
    eta = "eta1" + "".join(f" + {a!r}::DOUBLE * cos({2*j}*xi1) * sinh({2*j}*eta1)" for j, a in enumerate(crs.ALPHA, 1))
    p = prefix
    return f"""{p}a AS (SELECT {extra}, sinh(atanh(sin(radians({lat}))) - {e} * atanh({e} * sin(radians({lat})))) AS t,
  radians({lon} - {lon0!r}::DOUBLE) AS dl FROM {source}),
{p}b AS (SELECT *, atan2(t, cos(dl)) AS xi1, atanh(sin(dl) / sqrt(1 + t*t)) AS eta1 FROM {p}a),
{p}plane AS (SELECT {extra}, {r} * ({eta}) AS x, {r} * ({xi}) - {m0!r}::DOUBLE AS y FROM {p}b)"""


@query("to_wgs84", f"""WITH {POINTS}, z AS (SELECT X, Y, 6669 + Intensity // 100 % 19 AS zone FROM v_points),
{inverse_sql('X', 'Y', 'z', 'zone', 'X, Y, zone', 'i')}
SELECT round(X,6) AS x, round(Y,6) AS y, CAST(zone AS INTEGER) AS zone, round(lon,8) AS lon, round(lat,8) AS lat FROM igeo""")
def to_wgs84(spark, sf_dir):
    zoned = points(spark, sf_dir).withColumn("zone", F.lit(6669) + F.floor(F.col("Intensity") / 100).cast("int") % 19)
    return crs.with_wgs84(zoned, "X", "Y", F.col("zone")).select(
        F.round("X", 6).alias("x"), F.round("Y", 6).alias("y"), "zone", F.round("lon", 8).alias("lon"), F.round("lat", 8).alias("lat")
    )


@query("from_wgs84", f"""WITH {ITEMS}, {forward_sql('minx', 'miny', 'v_items', 6676, 'id', 'f')}
SELECT id, round(x,4) AS x, round(y,4) AS y FROM fplane""")
def from_wgs84(spark, sf_dir):
    x, y = crs.from_wgs84(F.col("minx"), F.col("miny"), 6676)
    return items(spark, sf_dir).select("id", F.round(x, 4).alias("x"), F.round(y, 4).alias("y"))


@query("reproject_points", f"""WITH {POINTS}, p AS (SELECT X, Y, source_file, epsg FROM v_points),
{inverse_sql('X', 'Y', 'p', 'epsg', 'source_file', 'i')}, {forward_sql('lon', 'lat', 'igeo', 6677, 'source_file', 'f')}
SELECT source_file, count(*) AS points, round(min(x),4) AS min_x, round(max(x),4) AS max_x, round(min(y),4) AS min_y, round(max(y),4) AS max_y
FROM fplane GROUP BY source_file""")
def reproject_points(spark, sf_dir):
    moved = pts.reproject_points(points(spark, sf_dir), 6677)
    return moved.groupBy("source_file").agg(
        F.count("*").alias("points"), *(F.round(f(c), 4).alias(f"{n}_{c.lower()}") for c in "XY" for f, n in ((F.min, "min"), (F.max, "max")))
    )


def _bbox_sql(corners):
    pairs = {2: (("x0", "y0"), ("x1", "y1")), 4: (("x0", "y0"), ("x1", "y0"), ("x1", "y1"), ("x0", "y1"))}[corners]
    union = " UNION ALL ".join(f"SELECT source_file, code, {x} AS px, {y} AS py FROM v_meta" for x, y in pairs)
    return f"""WITH {META}, corners AS ({union}), {inverse_sql('px', 'py', 'corners', 'code', 'source_file', 'i')}
SELECT source_file, round(min(lon),8) AS minx, round(min(lat),8) AS miny, round(max(lon),8) AS maxx, round(max(lat),8) AS maxy
FROM igeo GROUP BY source_file"""


def _bbox_query(spark, sf_dir, corners):
    box = crs.bbox_to_wgs84(F.col("bbox"), text.epsg_of(F.col("source_crs")), corners)
    moved = meta(spark, sf_dir).select("source_file", box.alias("b"))
    return moved.select("source_file", *(
        F.round(F.col("b")[i], 8).alias(n) for i, n in ((0, "minx"), (1, "miny"), (3, "maxx"), (4, "maxy"))
    ))


@query("bbox_reproject2", _bbox_sql(2))
def bbox_reproject2(spark, sf_dir):
    return _bbox_query(spark, sf_dir, 2)


@query("bbox_reproject4", _bbox_sql(4))
def bbox_reproject4(spark, sf_dir):
    return _bbox_query(spark, sf_dir, 4)


@query("epsg_parse", f"""WITH {META} SELECT source_file, code AS from_prefix, code AS from_wkt2, code AS from_wkt1, CAST(NULL AS INTEGER) AS from_nothing FROM v_meta""")
def epsg_parse(spark, sf_dir):
    code = F.regexp_extract("source_crs", r"(\d+)", 1)
    wkt1 = F.concat(F.lit('PROJCS["z",GEOGCS["g",AUTHORITY["EPSG","6668"]],AUTHORITY["EPSG","'), code, F.lit('"]]'))
    return meta(spark, sf_dir).select(
        "source_file", text.epsg_of(F.col("source_crs")).alias("from_prefix"), text.epsg_of(F.col("crs")).alias("from_wkt2"),
        text.epsg_of(wkt1).alias("from_wkt1"), text.epsg_of(F.replace("crs", F.lit("EPSG"), F.lit("none"))).alias("from_nothing"),
    )


@query("bbox_parse", f"""WITH {META} SELECT source_file, round(x0,4) AS a, round(y1,4) AS b, CAST(6 AS INTEGER) AS parts, TRUE AS short_is_null FROM v_meta""")
def bbox_parse(spark, sf_dir):
    words = F.array_join(F.transform("bbox", lambda v: v.cast("string")), ", ")
    parsed = meta(spark, sf_dir).select(
        "source_file", text.parse_bbox(words).alias("p"), text.parse_bbox(F.concat(F.lit("1,x,"), words)).alias("bad"),
    )
    return parsed.select(
        "source_file", F.round(F.col("p")[0], 4).alias("a"), F.round(F.col("p")[4], 4).alias("b"),
        F.size("p").alias("parts"), F.col("bad").isNull().alias("short_is_null"),
    )


@query("crs_detect", f"""WITH {META}, {ITEMS} SELECT 'meta' AS source, 'native' AS crs, count(*) AS n FROM v_meta
UNION ALL SELECT 'items', 'wgs84', count(*) FROM v_items WHERE minx IS NOT NULL""")
def crs_detect(spark, sf_dir):
    native = meta(spark, sf_dir).select(F.lit("meta").alias("source"), crs.detect_crs(F.col("bbox")).alias("crs"))
    box = F.array("minx", "miny", "maxx", "maxy")
    degrees = items(spark, sf_dir).filter("minx IS NOT NULL").select(F.lit("items").alias("source"), crs.detect_crs(box).alias("crs"))
    return native.unionByName(degrees).groupBy("source", "crs").agg(F.count("*").alias("n"))


@query("extent_metres", f"""WITH {ITEMS} SELECT id, round(greatest((maxx - minx) * 111320 * cos(radians((miny + maxy) / 2)), (maxy - miny) * 110540), 6) AS metres
FROM v_items WHERE minx IS NOT NULL""")
def extent_metres(spark, sf_dir):
    box = F.array("minx", "miny", "maxx", "maxy")
    return items(spark, sf_dir).filter("minx IS NOT NULL").select("id", F.round(crs.extent_m(box), 6).alias("metres"))


@query("web_mercator_tile", f"""WITH {ITEMS} SELECT id, round(radians(minx) * 6378137, 4) AS mx, round(ln(tan(pi() / 4 + radians(miny) / 2)) * 6378137, 4) AS my,
  CAST(floor((minx + 180) / 360 * 16384) AS BIGINT) AS tx,
  CAST(floor((1 - ln(tan(radians(miny)) + 1 / cos(radians(miny))) / pi()) / 2 * 16384) AS BIGINT) AS ty,
  round(minx, 8) AS lon, round(miny, 8) AS lat FROM v_items WHERE minx IS NOT NULL""")
def web_mercator_tile(spark, sf_dir):
    x, y = crs.to_mercator(F.col("minx"), F.col("miny"))
    tx, ty = crs.tile_of(F.col("minx"), F.col("miny"), 14)
    lon, lat = crs.from_mercator(x, y)
    return items(spark, sf_dir).filter("minx IS NOT NULL").select(
        "id", F.round(x, 4).alias("mx"), F.round(y, 4).alias("my"), tx.alias("tx"), ty.alias("ty"),
        F.round(lon, 8).alias("lon"), F.round(lat, 8).alias("lat"),
    )


# A diamond around the item's box centre against a fixed box: |dx| + |dy| decides.
@query("polygon_box", f"""WITH {ITEMS}, c AS (SELECT id, (minx + maxx) / 2 AS cx, (miny + maxy) / 2 AS cy FROM v_items WHERE minx IS NOT NULL)
SELECT id, greatest(greatest(138.7::DOUBLE - cx, cx - 138.75::DOUBLE), 0::DOUBLE) + greatest(greatest(35.35::DOUBLE - cy, cy - 35.42::DOUBLE), 0::DOUBLE) <= 0.01::DOUBLE AS hit FROM c""")
def polygon_box(spark, sf_dir):
    cx, cy, r = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2, F.lit(0.01)
    ring = F.array(F.array(cx + r, cy), F.array(cx, cy + r), F.array(cx - r, cy), F.array(cx, cy - r), F.array(cx + r, cy))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(ring)).alias("polygons"))
    return items(spark, sf_dir).filter("minx IS NOT NULL").select(
        "id", geom.intersects_box(shape, 138.7, 35.35, 138.75, 35.42).alias("hit")
    )


@query("search_polygon", f"""WITH {ITEMS}, c AS (SELECT id, (minx + maxx) / 2 AS cx, (miny + maxy) / 2 AS cy FROM v_items)
SELECT id, cx IS NULL AS unlocated FROM c WHERE cx IS NULL OR
  greatest(greatest(138.7::DOUBLE - cx, cx - 138.75::DOUBLE), 0::DOUBLE) + greatest(greatest(35.35::DOUBLE - cy, cy - 35.42::DOUBLE), 0::DOUBLE) <= 0.01::DOUBLE""")
def search_polygon(spark, sf_dir):
    """Diamonds as WKT in a located index; a box request meets them by their shape."""
    cx, cy, r = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2, F.lit(0.01)
    ring = F.array(F.array(cx + r, cy), F.array(cx, cy + r), F.array(cx - r, cy), F.array(cx, cy - r), F.array(cx + r, cy))
    shape = F.struct(F.lit("Polygon").alias("type"), F.array(F.array(ring)).alias("polygons"))
    shaped = items(spark, sf_dir).withColumn("geometry_wkt", F.when(cx.isNotNull(), geom.to_wkt(shape)))
    boxed = shaped.withColumns({"minx": cx - r, "maxx": cx + r, "miny": cy - r, "maxy": cy + r})
    path = scratch_dir(spark, "located")
    search.write_located(boxed, path)
    index = spark.read.parquet(path)
    hits = index.filter(search.matches(index, bbox=(138.7, 35.35, 138.75, 35.42)))
    return hits.select("id", F.col("minx").isNull().alias("unlocated"))


@query("wkt_roundtrip", f"""WITH {ITEMS} SELECT id, round(minx,8) AS minx, round(miny,8) AS miny, round(maxx,8) AS maxx, round(maxy,8) AS maxy,
  'MULTIPOLYGON' AS head, CAST(2 AS INTEGER) AS parts FROM v_items WHERE minx IS NOT NULL""")
def wkt_roundtrip(spark, sf_dir):
    cols = [F.col(c) for c in ("minx", "miny", "maxx", "maxy")]
    box = geom.bbox_ring(*cols)
    shape = F.struct(F.lit("MultiPolygon").alias("type"), F.array(F.array(box), F.array(box, box)).alias("polygons"))
    wkt = geom.to_wkt(shape)
    back = geom.from_geojson(geom.to_geojson(geom.from_wkt(F.col("w"))))
    read = items(spark, sf_dir).filter("minx IS NOT NULL").select("id", wkt.alias("w")).select("id", "w", back.alias("g"))
    e = F.col("e")
    return read.withColumn("e", geom.bounds(F.col("g"))).select(
        "id", *(F.round(e[i], 8).alias(n) for i, n in enumerate(("minx", "miny", "maxx", "maxy"))),
        F.substring_index("w", " ", 1).alias("head"), F.size("g.polygons").alias("parts"),
    )


@query("geometry_reproject", f"""WITH {META}, corners AS (
  SELECT source_file, code, x0 AS px, y0 AS py FROM v_meta UNION ALL SELECT source_file, code, x1, y0 FROM v_meta
  UNION ALL SELECT source_file, code, x1, y1 FROM v_meta UNION ALL SELECT source_file, code, x0, y1 FROM v_meta),
{inverse_sql('px', 'py', 'corners', 'code', 'source_file', 'i')}
SELECT source_file, round(min(lon),8) AS west, round(max(lat),8) AS north, CAST(5 AS INTEGER) AS vertices FROM igeo GROUP BY source_file""")
def geometry_reproject(spark, sf_dir):
    b = F.col("bbox")
    shape = geom.to_wgs84(geom.bbox_polygon(b[0], b[1], b[3], b[4]), text.epsg_of(F.col("source_crs")))
    moved = meta(spark, sf_dir).select("source_file", shape.alias("g"))
    e = geom.bounds(F.col("g"))
    return moved.select(
        "source_file", F.round(e[0], 8).alias("west"), F.round(e[3], 8).alias("north"),
        F.size(F.col("g.polygons")[0][0]).alias("vertices"),
    )


# --- catalog building -------------------------------------------------------------------

NOW = "2025-01-01 00:00:00"
BASE = "https://example.org/lake"


@query("run_summary", f"""WITH {META} SELECT dem_type, count(*) AS total_files, count(*) FILTER (WHERE error IS NULL) AS successful,
  count(error) AS failed, CAST(coalesce(sum(point_count) FILTER (WHERE error IS NULL), 0) AS BIGINT) AS total_points,
  CAST(coalesce(sum(file_size_bytes) FILTER (WHERE error IS NULL), 0) AS BIGINT) AS total_size_bytes,
  round(coalesce(sum(file_size_bytes) FILTER (WHERE error IS NULL), 0) / 1048576::DOUBLE, 2) AS total_size_mb,
  round(coalesce(sum(processing_time_seconds) FILTER (WHERE error IS NULL), 0), 4) AS total_seconds FROM v_meta GROUP BY dem_type""")
def run_summary(spark, sf_dir):
    return rounded(build.run_summary(meta(spark, sf_dir), ["dem_type"]), 4)


@query("split_results", f"WITH {META} SELECT count(*) FILTER (WHERE error IS NULL) AS ok, count(error) AS failed FROM v_meta")
def split_results(spark, sf_dir):
    good, bad = build.split_results(meta(spark, sf_dir))
    return good.agg(F.count("*").alias("ok")).withColumn("failed", bad.agg(F.count("*").alias("n")).scalar())


_EXTENT = f"""corners AS (SELECT source_file, code, x0 AS px, y0 AS py FROM v_meta WHERE error IS NULL UNION ALL SELECT source_file, code, x1, y1 FROM v_meta WHERE error IS NULL),
{inverse_sql('px', 'py', 'corners', 'code', 'source_file', 'i')}"""


@query("collection_extent", f"""WITH {META}, {_EXTENT}
SELECT round(min(lon),8) AS minx, round(min(lat),8) AS miny, round(max(lon),8) AS maxx, round(max(lat),8) AS maxy FROM igeo""")
def collection_extent(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    return rounded(build.collection_extent(good, now=NOW).drop("start_datetime", "end_datetime"), 8)


@query("summaries", f"""WITH {META} SELECT min(point_count) AS min_count, max(point_count) AS max_count,
  string_agg(DISTINCT CAST(code AS VARCHAR), ',' ORDER BY CAST(code AS VARCHAR)) AS epsg_codes, string_agg(DISTINCT dem_type, ',' ORDER BY dem_type) AS dem_types,
  string_agg(DISTINCT CAST(resolution AS VARCHAR), ',' ORDER BY CAST(resolution AS VARCHAR)) AS resolutions FROM v_meta WHERE error IS NULL""")
def summaries(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    s = build.summaries(good)
    return s.select("min_count", "max_count", *(
        F.array_join(F.transform(c, lambda v: v.cast("string")), ",").alias(c) for c in ("epsg_codes", "dem_types", "resolutions")
    ))


@query("collection_epsg", f"WITH {META} SELECT min_by(code, source_file) AS epsg FROM v_meta WHERE error IS NULL")
def collection_epsg(spark, sf_dir):
    return build.collection_epsg(build.split_results(meta(spark, sf_dir))[0])


def _geo(i):
    return f"""WITH {META}, corners AS (SELECT source_file, code, x0 AS px, y0 AS py FROM v_meta WHERE error IS NULL UNION ALL SELECT source_file, code, x1, y1 FROM v_meta WHERE error IS NULL),
{inverse_sql('px', 'py', 'corners', 'code', 'source_file', 'i')}, boxes AS (
  SELECT source_file, min(lon) AS minx, min(lat) AS miny, max(lon) AS maxx, max(lat) AS maxy FROM igeo GROUP BY source_file)"""


@query("items_from_metadata", f"""{_geo(2)}
SELECT replace(source_file, '.las', '') AS id, 'clouds' AS collection, replace(source_file, '.las', '') AS title,
  'COPC point cloud from ' || source_file AS description, code AS proj_epsg, point_count AS pc_count, 'lidar' AS pc_type,
  round(minx,8) AS minx, round(miny,8) AS miny, round(maxx,8) AS maxx, round(maxy,8) AS maxy, TRUE AS crs_ok,
  '{BASE}/data/' || output_file AS data_href, file_size_bytes AS data_size,
  '{BASE}/data/' || replace(output_file, '.copc.laz', '.metadata.json') AS metadata_href, round(x0,4) AS native_minx
FROM v_meta JOIN boxes USING (source_file) WHERE error IS NULL""")
def items_from_metadata(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    made = build.items_from_metadata(good, BASE + "/", "clouds", NOW)
    return made.select(
        "id", "collection", "title", "description", "proj_epsg", "pc_count", "pc_type",
        *(F.round(c, 8).alias(c) for c in ("minx", "miny", "maxx", "maxy")), "crs_ok",
        F.col("assets")["data"]["href"].alias("data_href"), F.col("assets")["data"]["file:size"].alias("data_size"),
        F.col("assets")["metadata"]["href"].alias("metadata_href"), F.round(F.col("proj_bbox")[0], 4).alias("native_minx"),
    )


@query("merged_item", f"""WITH {META}, m AS (SELECT min(x0) AS x0, min(y0) AS y0, max(x1) AS x1, max(y1) AS y1, CAST(sum(point_count) AS BIGINT) AS n, count(*) AS files, 6676 AS code FROM v_meta WHERE error IS NULL AND code = 6676),
corners AS (SELECT code, x0 AS px, y0 AS py FROM m UNION ALL SELECT code, x1, y1 FROM m), {inverse_sql('px', 'py', 'corners', 'code', 'code', 'i')}
SELECT 'unified-pointcloud' AS id, 'Merged COPC point cloud containing ' || format('{{:,}}', n) || ' points' AS description, n AS pc_count, files AS source_file_count,
  (SELECT round(min(lon),8) FROM igeo) AS minx, (SELECT round(max(lat),8) FROM igeo) AS maxy, '{BASE}/data/unified.metadata.json' AS metadata_href FROM m""")
def merged_item(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    merged = build.merge_metadata(good.filter(build.metadata_epsg() == 6676), "unified.copc.laz", "EPSG:6676")
    made = build.merged_item(merged, BASE, "unified", NOW)
    return made.select(
        "id", "description", "pc_count", "source_file_count", F.round("minx", 8).alias("minx"), F.round("maxy", 8).alias("maxy"),
        F.col("assets")["metadata"]["href"].alias("metadata_href"),
    )


_TITLES = " ".join(f"WHEN '{k}' THEN '{v[0]}'" for k, v in build.PRODUCT_TEXT.items())
_ABOUTS = " ".join(f"WHEN '{k}' THEN '{v[1]}'" for k, v in build.PRODUCT_TEXT.items())


@query("raster_items", f"""WITH {META}, s AS (SELECT *, replace(source_file, '.las', '') || '_' || dem_type AS item, CASE dem_type {_TITLES} END AS t, CASE dem_type {_ABOUTS} END AS a FROM v_meta WHERE error IS NULL)
SELECT item AS id, item || ' - ' || t AS title, a || '. Derived from ' || source_file AS description, dem_type, resolution, code AS proj_epsg,
  CASE WHEN dem_type IN ('dem', 'dsm', 'dtm') THEN 'meter' END AS unit, CAST(-9999 AS DOUBLE) AS nodata,
  '{BASE}/rasters/' || item || '.tif' AS href, '../pointcloud/' || replace(source_file, '.las', '') || '.json' AS derived_from FROM s""")
def raster_items(spark, sf_dir):
    made = build.raster_items(_raster_meta(spark, sf_dir), BASE, "rasters", NOW)
    return made.select(
        "id", "title", "description", "dem_type", "resolution", "proj_epsg", F.col("raster_bands")[0]["unit"].alias("unit"),
        F.col("raster_bands")[0]["nodata"].alias("nodata"), F.col("assets")["data"]["href"].alias("href"),
        F.col("links")[0]["href"].alias("derived_from"),
    )


def _raster_meta(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    name = F.concat(text.bare_stem(F.col("source_file")), F.lit("_"), F.col("dem_type"), F.lit(".tif"))
    b = F.col("bbox")
    return good.withColumns({"output_file": name, "bbox": F.array(b[0], b[1], b[3], b[4])})


@query("lineage", f"""WITH {META} SELECT replace(source_file, '.las', '') || '_' || dem_type AS id,
  CASE WHEN code = 6676 THEN replace(source_file, '.las', '') END AS source_id FROM v_meta WHERE error IS NULL""")
def lineage(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    clouds = build.items_from_metadata(good.filter(build.metadata_epsg() == 6676), BASE, "clouds", NOW)
    rasters = build.raster_items(_raster_meta(spark, sf_dir), BASE, "rasters", NOW)
    return quality.lineage(rasters, clouds).select("id", "source_id")


@query("check_derived", f"""WITH {META} SELECT replace(source_file, '.las', '') || '_' || dem_type AS id FROM v_meta
WHERE error IS NULL AND o_custkey % 3 = 0""")
def check_derived(spark, sf_dir):
    # every third raster is built from tiles with exchanged axes
    good, _ = build.split_results(meta(spark, sf_dir))
    clouds = build.items_from_metadata(good, BASE, "clouds", NOW)
    b = F.col("bbox")
    turned = F.when(F.col("resolution") == 0.5, F.array(b[1], b[0], b[3], b[2])).otherwise(b)
    rasters = build.raster_items(_raster_meta(spark, sf_dir).withColumn("bbox", turned), BASE, "rasters", NOW)
    return quality.check_derived(rasters, clouds).select("id")


@query("check_locations", f"""WITH {META} SELECT CASE WHEN o_custkey % 3 = 0 THEN 'swapped' ELSE 'ok' END AS location, count(*) AS n FROM v_meta
WHERE error IS NULL GROUP BY 1""")
def check_locations(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    b = F.col("bbox")
    turned = F.when(F.col("resolution") == 0.5, F.array(b[1], b[0], b[2], b[4], b[3], b[5])).otherwise(b)
    clouds = build.items_from_metadata(good.withColumn("bbox", turned), BASE, "clouds", NOW)
    checked = quality.check_locations(clouds, {"clouds": (138.4, 35.5, 140.6, 36.0)})
    return checked.groupBy("location").agg(F.count("*").alias("n"))


@query("missing_assets", f"""WITH {META}, kept AS (SELECT 'data/t' || CAST(p_partkey AS VARCHAR) || '.copc.laz' AS key FROM part)
SELECT replace(source_file, '.las', '') AS id, 'data' AS asset, 'data/' || output_file AS key FROM v_meta WHERE error IS NULL AND 'data/' || output_file NOT IN (SELECT key FROM kept)
UNION ALL SELECT replace(source_file, '.las', ''), 'metadata', 'data/' || replace(output_file, '.copc.laz', '.metadata.json') FROM v_meta WHERE error IS NULL""")
def missing_assets(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    clouds = build.items_from_metadata(good, BASE, "clouds", NOW)
    kept = table(spark, sf_dir, "part").select(
        F.concat(F.lit("data/t"), F.col("p_partkey").cast("string"), F.lit(".copc.laz")).alias("key")
    )
    return quality.missing_assets(clouds, kept, BASE).select("id", "asset", "key")


# Every seventh part lies elsewhere remotely, so keys of both sides are without a partner.
_INVENTORIES = """l AS (SELECT 'data/' || CAST(p_partkey AS VARCHAR) AS key, p_size AS size, 10 AS modified FROM part),
r AS (SELECT 'data/' || CAST(CASE WHEN l_partkey % 7 = 0 THEN -l_partkey ELSE l_partkey END AS VARCHAR) AS key,
  CAST(max(l_quantity) AS INTEGER) AS size, CAST(max(l_linenumber) AS INTEGER) * 2 AS modified FROM lineitem GROUP BY 1)"""


@query("inventory_diff", f"""WITH {_INVENTORIES} SELECT key, CASE WHEN r.size IS NULL THEN 'new' WHEN l.size IS NULL THEN 'deleted' ELSE 'changed' END AS action
FROM l FULL OUTER JOIN r USING (key) WHERE r.size IS NULL OR l.size IS NULL OR l.size <> r.size OR l.modified > r.modified""")
def inventory_diff(spark, sf_dir):
    def key(name):
        return F.concat(F.lit("data/"), name.cast("string")).alias("key")

    local = table(spark, sf_dir, "part").select(key(F.col("p_partkey")), F.col("p_size").alias("size"), F.lit(10).alias("modified"))
    place = F.when(F.col("l_partkey") % 7 == 0, -F.col("l_partkey")).otherwise(F.col("l_partkey"))
    remote = table(spark, sf_dir, "lineitem").groupBy(key(place)).agg(
        F.max("l_quantity").cast("int").alias("size"), (F.max("l_linenumber") * 2).alias("modified"))
    return sync.inventory_diff(local, remote)


@query("sync_plan", f"""WITH {META}, t AS (SELECT 'copc-t' || CAST(p_partkey AS VARCHAR) AS name, min(p_size) AS id FROM part GROUP BY 1)
SELECT 'copc-' || replace(source_file, '.las', '') AS name, CASE WHEN id IS NULL THEN 'create' ELSE 'update' END AS action, id AS target_id
FROM v_meta LEFT JOIN t ON t.name = 'copc-' || replace(source_file, '.las', '') WHERE error IS NULL""")
def sync_plan(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    source = sync.to_portal_resources(build.items_from_metadata(good, BASE, "clouds", NOW))
    target = table(spark, sf_dir, "part").select(
        F.concat(F.lit("copc-t"), F.col("p_partkey").cast("string")).alias("name"), F.col("p_size").alias("id"))
    return sync.sync_plan(target, source).select("name", "action", "target_id")


@query("portal_records", f"""WITH {META} SELECT 'stac-clouds' AS package_name, 'copc-' || replace(source_file, '.las', '') AS name,
 'COPC point cloud from ' || source_file AS description, '{BASE}/data/' || output_file AS url, 'COPC' AS format, point_count AS pc_count, CAST(code AS VARCHAR) AS proj_epsg
FROM v_meta WHERE error IS NULL""")
def portal_records(spark, sf_dir):
    good, _ = build.split_results(meta(spark, sf_dir))
    made = sync.to_portal_resources(build.items_from_metadata(good, BASE, "clouds", NOW))
    return made.select("package_name", "name", "description", "url", "format", "pc_count", "proj_epsg")


@query("portal_packages", """SELECT 'stac-' || event_type AS name, 'Events: ' || event_type AS title, 'Recorded events' AS notes, 'proprietary' AS license_id FROM events GROUP BY event_type""")
def portal_packages(spark, sf_dir):
    return sync.to_portal_packages(_collections(spark, sf_dir))


@query("map_dimensions", f"""WITH {META} SELECT dem_type AS name, CASE dem_type WHEN 'dem' THEN 'signed' WHEN 'dsm' THEN 'unsigned' ELSE 'floating' END AS type,
 CAST(CASE WHEN error IS NULL THEN 2 ELSE 4 END AS INTEGER) AS size, count(*) AS n FROM v_meta GROUP BY 1, 2, 3""")
def map_dimensions(spark, sf_dir):
    kind = F.when(F.col("dem_type") == "dem", "Int16").when(F.col("dem_type") == "dsm", "UINT64").when(F.col("dem_type") == "dtm", "Double").otherwise("strange")
    dim = F.struct(F.col("dem_type").alias("name"), F.when(F.col("error").isNull(), 2).alias("size"), kind.alias("type"))
    out = meta(spark, sf_dir).select(F.inline(build.map_dimensions(F.array(dim))))
    return out.groupBy("name", "type", "size").agg(F.count("*").alias("n"))


@query("map_statistics", f"WITH {POINTS} " + " UNION ALL ".join(
    f"SELECT source_file, '{d}' AS name, count(*) AS \"count\", round(CAST(min({d}) AS DOUBLE),6) AS minimum, round(CAST(max({d}) AS DOUBLE),6) AS maximum FROM v_points GROUP BY 1" for d in ("X", "Z", "Classification")))
def map_statistics(spark, sf_dir):
    stats = pts.statistics_array(points(spark, sf_dir), ["source_file"], ("X", "Z", "Classification"))
    mapped = stats.select("source_file", F.inline(build.map_statistics(F.col("statistics"))))
    return rounded(mapped.select("source_file", "name", "count", "minimum", "maximum"))


@query("pick_stage", f"WITH {META} SELECT source_file, point_count AS count, 'filters.stats' AS stage FROM v_meta")
def pick_stage(spark, sf_dir):
    def entry(name):
        return F.struct(F.lit(name).alias("stage"), F.col("point_count").alias("count"))

    stages = F.create_map(F.lit("filters.hexbin"), entry("filters.hexbin"), F.lit("filters.stats_1"), entry("filters.stats"), F.lit("writers"), entry("w"))
    picked = build.pick_stage(stages, build.STAGES["stats"])
    return meta(spark, sf_dir).select("source_file", picked["count"].alias("count"), picked["stage"].alias("stage"))


@query("check_points", f"""WITH {POINTS} SELECT source_file, count(*) AS points, CAST(0 AS BIGINT) AS not_finite, count(*) FILTER (WHERE Z * 12 > 9000) AS implausible,
 count(*) FILTER (WHERE Z * 12 > 9000) = 0 AS valid FROM v_points GROUP BY source_file""")
def check_points(spark, sf_dir):
    return quality.check_points(points(spark, sf_dir).withColumn("Z", F.col("Z") * 12))
