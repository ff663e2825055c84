"""Queries over the point view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import crs
from ..operators import heights, points as pts, spatial_join
from .registry import query, rounded
from .views import POINTS, points, table

SURVEY_BOX = (51250.0, -49150.0, 51350.0, -49050.0)
CROP_BOX = (51260.0, -49160.0, 51420.0, -49020.0)

_STATS = "\nUNION ALL\n".join(
    f"""SELECT '{d}' AS name, count({d}) AS "count", CAST(min({d}) AS DOUBLE) AS minimum, CAST(max({d}) AS DOUBLE) AS maximum,
       round(avg(CAST({d} AS DOUBLE)), 4) AS average, round(stddev_samp(CAST({d} AS DOUBLE)), 4) AS stddev,
       round(var_samp(CAST({d} AS DOUBLE)), 2) AS variance, source_file FROM v_points GROUP BY source_file"""
    for d in pts.STAT_DIMENSIONS
)


@query("dim_stats", f"WITH {POINTS} SELECT name, \"count\", round(minimum, 6) AS minimum, round(maximum, 6) AS maximum, average, stddev, variance, source_file FROM ({_STATS})")
def dim_stats(spark, sf_dir):
    stats = pts.dimension_stats(points(spark, sf_dir), by=["source_file"])
    return stats.select(
        "name", "count", F.round("minimum", 6).alias("minimum"), F.round("maximum", 6).alias("maximum"),
        F.round("average", 4).alias("average"), F.round("stddev", 4).alias("stddev"),
        F.round("variance", 2).alias("variance"), "source_file",
    )


@query("enumerate_values", f"""WITH {POINTS}
SELECT dimension, value, count(*) AS "count" FROM (
  SELECT 'Classification' AS dimension, Classification AS value FROM v_points
  UNION ALL SELECT 'ReturnNumber', ReturnNumber FROM v_points
  UNION ALL SELECT 'NumberOfReturns', NumberOfReturns FROM v_points) GROUP BY 1, 2""")
def enumerate_values(spark, sf_dir):
    return pts.enumerate_values(points(spark, sf_dir))


@query("bbox3d_by_file", f"""WITH {POINTS}
SELECT source_file, round(min(X),6) AS minx, round(min(Y),6) AS miny, round(min(Z),6) AS minz,
       round(max(X),6) AS maxx, round(max(Y),6) AS maxy, round(max(Z),6) AS maxz, count(*) AS point_count
FROM v_points GROUP BY source_file""")
def bbox3d_by_file(spark, sf_dir):
    b = F.col("bbox")
    names = ("minx", "miny", "minz", "maxx", "maxy", "maxz")
    return pts.bbox3d(points(spark, sf_dir), ["source_file"]).select(
        "source_file", *(F.round(b[i], 6).alias(n) for i, n in enumerate(names)), "point_count"
    )


@query("survey_summary", f"""WITH {POINTS}
SELECT count(*) AS point_count, round(count(*) / CAST(10000 AS DOUBLE), 6) AS density,
       round(min(X),6) AS min_x, round(max(X),6) AS max_x, round(min(Y),6) AS min_y, round(max(Y),6) AS max_y,
       round(min(Z),6) AS min_z, round(max(Z),6) AS max_z, round(avg(Z),4) AS mean_z, round(stddev_pop(Z),4) AS std_z
FROM v_points WHERE X BETWEEN {SURVEY_BOX[0]} AND {SURVEY_BOX[2]} AND Y BETWEEN {SURVEY_BOX[1]} AND {SURVEY_BOX[3]}""")
def survey_summary(spark, sf_dir):
    out = rounded(pts.survey_summary(points(spark, sf_dir), SURVEY_BOX))
    return out.withColumns({"mean_z": F.round("mean_z", 4), "std_z": F.round("std_z", 4)})


_POINT_COLUMNS = "round(X,6) AS \"X\", round(Y,6) AS \"Y\", round(Z,6) AS \"Z\", Intensity, source_file"


def _shown(df):
    return df.select(
        F.round("X", 6).alias("X"), F.round("Y", 6).alias("Y"), F.round("Z", 6).alias("Z"), "Intensity", "source_file"
    )


@query("crop_range", f"""WITH {POINTS}
SELECT {_POINT_COLUMNS} FROM v_points
WHERE X BETWEEN {CROP_BOX[0]} AND {CROP_BOX[2]} AND Y BETWEEN {CROP_BOX[1]} AND {CROP_BOX[3]}
  AND (Classification BETWEEN 2 AND 2 OR Classification BETWEEN 6 AND 6) AND Z <= 700 AND NOT (Classification BETWEEN 7 AND 7)""")
def crop_range(spark, sf_dir):
    inside = pts.crop(points(spark, sf_dir), CROP_BOX)
    kept = pts.filter_range(inside, "Classification[2:2], Classification[6:6], Z[:700]")
    return _shown(pts.filter_range(kept, "Classification![7:7]"))


@query("crop_auto_crs", f"""WITH {POINTS}
SELECT {_POINT_COLUMNS} FROM v_points
WHERE X BETWEEN {CROP_BOX[0]} AND {CROP_BOX[2]} AND Y BETWEEN {CROP_BOX[1]} AND {CROP_BOX[3]}""")
def crop_auto_crs(spark, sf_dir):
    return _shown(pts.crop(points(spark, sf_dir), CROP_BOX, bbox_crs="auto"))


# Part sizes and brands give the areas: one box per part, all over the survey ground.
_AREA_X, _AREA_Y = "51200 + (p_partkey * 37 % 380)", "-49200 + (p_partkey * 53 % 280)"


@query("points_in_areas", f"""WITH {POINTS}, areas AS (
  SELECT p_partkey AS area_id, CAST({_AREA_X} AS DOUBLE) AS minx, CAST({_AREA_Y} AS DOUBLE) AS miny,
         CAST({_AREA_X} + p_size AS DOUBLE) AS maxx, CAST({_AREA_Y} + p_size / 2 AS DOUBLE) AS maxy FROM part)
SELECT area_id, count(*) AS points, round(max(Z),6) AS max_z FROM v_points
JOIN areas ON X BETWEEN minx AND maxx AND Y BETWEEN miny AND maxy GROUP BY area_id""")
def points_in_areas(spark, sf_dir):
    x, y = F.expr(_AREA_X).cast("double"), F.expr(_AREA_Y).cast("double")
    areas = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("area_id"), x.alias("minx"), y.alias("miny"),
        (x + F.col("p_size")).alias("maxx"), (y + F.col("p_size") / 2).alias("maxy"),
    )
    inside = spatial_join.points_in_areas(points(spark, sf_dir), areas, highest="Z")
    return inside.groupBy("area_id").agg(F.sum("points").alias("points"), F.round(F.max("Z"), 6).alias("max_z"))


@query("query_points", f"""WITH {POINTS}, files AS (
  SELECT source_file FROM v_points GROUP BY source_file HAVING max(Z) > 753.5)
SELECT source_file, count(*) AS points, round(avg(Z),4) AS mean_z FROM v_points
WHERE X BETWEEN {CROP_BOX[0]} AND {CROP_BOX[2]} AND Y BETWEEN {CROP_BOX[1]} AND {CROP_BOX[3]}
  AND source_file IN (SELECT source_file FROM files) GROUP BY source_file""")
def query_points(spark, sf_dir):
    cloud = points(spark, sf_dir)
    found = cloud.groupBy("source_file").agg(F.max("Z").alias("top")).filter("top > 753.5")
    return pts.query_points(cloud, found, CROP_BOX).groupBy("source_file").agg(
        F.count("*").alias("points"), F.round(F.avg("Z"), 4).alias("mean_z")
    )


@query("merge_points", f"""WITH {POINTS}
SELECT Classification, count(*) AS points, count(gps_time) AS timed, round(min(X),6) AS min_x, round(max(Y),6) AS max_y,
       max(epsg) AS epsg FROM v_points GROUP BY Classification""")
def merge_points(spark, sf_dir):
    cloud = points(spark, sf_dir)
    parts = [
        cloud.filter("Classification = 2"), cloud.filter("Classification = 6").withColumn("epsg", F.lit(None).cast("int")),
        cloud.filter("Classification = 7").select(*reversed(cloud.columns)),
    ]
    return pts.merge_points(parts, source_epsg=6676).groupBy("Classification").agg(
        F.count("*").alias("points"), F.count("gps_time").alias("timed"),
        F.round(F.min("X"), 6).alias("min_x"), F.round(F.max("Y"), 6).alias("max_y"), F.max("epsg").alias("epsg"),
    )


_HEX = """hexf AS (SELECT (X * (sqrt(CAST(3 AS DOUBLE)) / 3) - Y / 3) / 10 AS qf, (Y * (CAST(2 AS DOUBLE) / 3)) / 10 AS rf FROM v_points),
hexr AS (SELECT qf, rf, -qf - rf AS sf, floor(qf + 0.5) AS q, floor(rf + 0.5) AS r, floor(-qf - rf + 0.5) AS s FROM hexf),
hexd AS (SELECT *, abs(q - qf) AS dq, abs(r - rf) AS dr, abs(s - sf) AS ds FROM hexr),
hexes AS (SELECT CAST(CASE WHEN dq > dr AND dq > ds THEN -r - s ELSE q END AS BIGINT) AS q,
  CAST(CASE WHEN NOT (dq > dr AND dq > ds) AND dr > ds THEN -q - s ELSE r END AS BIGINT) AS r, count(*) AS "count"
  FROM hexd GROUP BY 1, 2)"""


@query("hexbin", f'WITH {POINTS}, {_HEX} SELECT q, r, "count" FROM hexes')
def hexbin(spark, sf_dir):
    return pts.hexbin(points(spark, sf_dir))


@query("hex_density", f"""WITH {POINTS}, {_HEX}
SELECT count(*) AS hexes, CAST(sum("count") AS BIGINT) AS points,
       round(sum("count") / (count(*) * (CAST(1.5 AS DOUBLE) * sqrt(CAST(3 AS DOUBLE)) * 100)), 6) AS density FROM hexes""")
def hex_density(spark, sf_dir):
    return rounded(pts.hex_density(pts.hexbin(points(spark, sf_dir))))


@query("hex_boundary", f"""WITH {POINTS}, {_HEX}, steps AS (
  SELECT * FROM (VALUES (0,1,0),(1,0,1),(2,-1,1),(3,-1,0),(4,0,-1),(5,1,-1)) AS t(side, dq, dr))
SELECT a.q AS q, a.r AS r, CAST(side AS INTEGER) AS side FROM hexes a JOIN steps ON TRUE
LEFT JOIN hexes b ON b.q = a.q + dq AND b.r = a.r + dr WHERE b.q IS NULL""")
def hex_boundary(spark, sf_dir):
    return pts.hex_boundary(pts.hexbin(points(spark, sf_dir))).select("q", "r", "side")


_RINGS = f"""{_HEX}, turn AS (
  SELECT * FROM (VALUES (0,1,0,1,-1,1,1),(1,0,1,1,1,0,2),(2,-1,1,0,2,-1,1),(3,-1,0,-1,1,-1,-1),(4,0,-1,-1,-1,0,-2),(5,1,-1,0,-2,1,-1)) AS t(side, dq, dr, u0, v0, u1, v1)),
edge AS (SELECT 2*a.q + a.r + u0 AS su, 3*a.r + v0 AS sv, 2*a.q + a.r + u1 AS eu, 3*a.r + v1 AS ev FROM hexes a JOIN turn ON TRUE
  LEFT JOIN hexes b ON b.q = a.q + dq AND b.r = a.r + dr WHERE b.q IS NULL),
walk AS (
  SELECT su AS ru, sv AS rv, eu, ev, [(su, sv), (eu, ev)] AS way, su * ev - eu * sv AS area FROM edge
  UNION ALL
  SELECT ru, rv, e.eu, e.ev, list_append(way, (e.eu, e.ev)), area + e.su * e.ev - e.eu * e.sv FROM walk JOIN edge e ON walk.eu = e.su AND walk.ev = e.sv
  WHERE (walk.eu, walk.ev) > (ru, rv)),
ring AS (SELECT ru, rv, way, area FROM walk WHERE eu = ru AND ev = rv)"""


@query("hex_rings", f"""WITH RECURSIVE {POINTS}, {_RINGS}
SELECT ru AS first_u, rv AS first_v, CAST(len(way) - 1 AS BIGINT) AS edges, area < 0 AS hole,
  array_to_string(list_transform(way, lambda p: p[1] || ' ' || p[2]), ',') AS corners FROM ring""")
def hex_rings(spark, sf_dir):
    rings = pts.hex_rings(pts.hexbin(points(spark, sf_dir)))
    corners = F.array_join(F.transform("corners", lambda p: F.concat_ws(" ", p["u"], p["v"])), ",")
    return rings.select("first_u", "first_v", "edges", "hole", corners.alias("corners"))


@query("hex_outline", f"""WITH RECURSIVE {POINTS}, {_RINGS}
SELECT count(*) FILTER (WHERE area > 0) AS polygons, count(*) FILTER (WHERE area < 0) AS holes, count(*) AS all_rings,
  round((SELECT count(*) FROM hexes) * 150 * sqrt(CAST(3 AS DOUBLE)), 4) AS area FROM ring""")
def hex_outline(spark, sf_dir):
    """Polygons with their holes; the area that their corners enclose is that of the occupied hexagons."""
    shapes = pts.hex_polygons(pts.hex_rings(pts.hexbin(points(spark, sf_dir))))
    closed = F.regexp_count("wkt", F.lit(r"\(\d|\(-"))
    return shapes.agg(
        F.count("*").alias("polygons"), F.sum("holes").alias("holes"), F.sum(closed).alias("all_rings"), F.round(F.sum("area"), 4).alias("area"))


@query("axis_swap", f"""WITH {POINTS}
SELECT source_file, round(min(Y),6) AS min_x, round(max(X),6) AS max_y FROM v_points GROUP BY source_file""")
def axis_swap(spark, sf_dir):
    return pts.swap_axes(points(spark, sf_dir)).groupBy("source_file").agg(
        F.round(F.min("X"), 6).alias("min_x"), F.round(F.max("Y"), 6).alias("max_y")
    )


_LOD = """single AS (
  SELECT X, Y, Z, Intensity, Classification, count(*) AS copies, CAST(floor(Z * 1000) AS BIGINT) * 7919 % 104729 AS p
  FROM v_points GROUP BY 1, 2, 3, 4, 5),
r AS (SELECT *,
  row_number() OVER (PARTITION BY floor(X/64), floor(Y/64), floor(Z/64) ORDER BY p, X, Y, Z, Intensity, Classification) AS r0,
  row_number() OVER (PARTITION BY floor(X/32), floor(Y/32), floor(Z/32) ORDER BY p, X, Y, Z, Intensity, Classification) AS r1,
  row_number() OVER (PARTITION BY floor(X/16), floor(Y/16), floor(Z/16) ORDER BY p, X, Y, Z, Intensity, Classification) AS r2,
  row_number() OVER (PARTITION BY floor(X/8), floor(Y/8), floor(Z/8) ORDER BY p, X, Y, Z, Intensity, Classification) AS r3 FROM single),
placed AS (SELECT *, CASE WHEN r0 = 1 THEN 0 WHEN r1 = 1 THEN 1 WHEN r2 = 1 THEN 2 WHEN r3 = 1 THEN 3 ELSE 4 END AS level FROM r),
shares AS (SELECT level, CASE WHEN level < 4 THEN 1 ELSE copies END AS n, Z FROM placed
  UNION ALL SELECT 4, copies - 1, Z FROM placed WHERE level < 4 AND copies > 1)"""
_BUDGET = 2000


def _leveled(spark, sf_dir):
    priority = F.floor(F.col("Z") * 1000).cast("bigint") * 7919 % 104729
    return pts.assign_lod(points(spark, sf_dir), 4, 64.0, priority, ["X", "Y", "Z", "Intensity", "Classification"])


@query("lod", f"""WITH {POINTS}, {_LOD}
SELECT CAST(level AS INTEGER) AS level, CAST(sum(n) AS BIGINT) AS points, round(max(Z),6) AS max_z FROM shares GROUP BY level""")
def lod(spark, sf_dir):
    return _leveled(spark, sf_dir).groupBy("level").agg(F.sum("copies").alias("points"), F.round(F.max("Z"), 6).alias("max_z"))


@query("lod_budget", f"""WITH {POINTS}, {_LOD}, sizes AS (SELECT level, sum(n) AS n FROM shares GROUP BY level),
upto AS (SELECT level, sum(n) OVER (ORDER BY level) AS total FROM sizes)
SELECT CAST(level AS INTEGER) AS level, CAST(sum(n) AS BIGINT) AS points FROM shares WHERE level IN (SELECT level FROM upto WHERE total <= {_BUDGET}) GROUP BY level""")
def lod_budget(spark, sf_dir):
    kept = pts.within_budget(_leveled(spark, sf_dir), _BUDGET)
    return kept.groupBy("level").agg(F.sum("copies").alias("points"))


@query("points_json", f"""WITH {POINTS}, top AS (
  SELECT X, Y, Z, Intensity, Classification FROM v_points
  WHERE X BETWEEN {CROP_BOX[0]} AND {CROP_BOX[2]} AND Y BETWEEN {CROP_BOX[1]} AND {CROP_BOX[3]}
  ORDER BY X, Y, Z, Intensity, Classification LIMIT 10000)
SELECT round(X,6) AS x, round(Y,6) AS y, round(Z,6) AS z, Intensity AS intensity, Classification AS classification FROM top""")
def points_json(spark, sf_dir):
    order = ["X", "Y", "Z", "Intensity", "Classification"]
    text = pts.points_to_json(points(spark, sf_dir), CROP_BOX, order=order)
    record = F.from_json("point", "x double, y double, z double, intensity int, classification int")
    return rounded(text.select(record.alias("p")).select("p.*"))


_SAMPLE = 20000


@query("sample_points", f"""WITH {POINTS}, marked AS (
  SELECT *, md5(concat_ws('|', CAST(floor(X * 1000) AS BIGINT), CAST(floor(Y * 1000) AS BIGINT), CAST(floor(Z * 1000) AS BIGINT), source_file,
    row_number() OVER (PARTITION BY X, Y, Z, Intensity, Classification, source_file), '7')) AS h FROM v_points)
SELECT {_POINT_COLUMNS}, count(*) AS points FROM (SELECT * FROM marked ORDER BY h LIMIT {_SAMPLE}) GROUP BY ALL""")
def sample_points(spark, sf_dir):
    cloud = points(spark, sf_dir).select("X", "Y", "Z", "Intensity", "Classification", "source_file")
    name = F.concat_ws("|", *(F.floor(F.col(c) * 1000).cast("string") for c in "XYZ"), "source_file")
    sample = pts.sample_points(cloud, _SAMPLE, 7, name)
    return _shown(sample).groupBy("X", "Y", "Z", "Intensity", "source_file").agg(F.count("*").alias("points"))


@query("relative_height", f"""WITH {POINTS}, ground AS (SELECT quantile_cont(Z, 0.05) AS g FROM v_points)
SELECT count(*) AS points, round(max(g),6) AS ground, round(max(Z - g),6) AS max_height,
       count(*) FILTER (WHERE Z - g > 10) AS elevated FROM v_points, ground""")
def relative_height(spark, sf_dir):
    return heights.relative_height(points(spark, sf_dir)).agg(
        F.count("*").alias("points"), F.round(F.max("ground"), 6).alias("ground"),
        F.round(F.max("height"), 6).alias("max_height"), F.count_if(F.col("height") > 10).alias("elevated"),
    )


_BINS = "\nUNION ALL\n".join(
    f"SELECT CAST({a} AS DOUBLE) AS low, CAST({b} AS DOUBLE) AS high, count(*) FILTER (WHERE h >= {a} AND h < {b}) AS points, "
    f"round(count(*) FILTER (WHERE h >= {a} AND h < {b}) * CAST(100 AS DOUBLE) / count(*), 6) AS percent FROM heights"
    for a, b in zip(heights.HEIGHT_BINS, heights.HEIGHT_BINS[1:])
)


@query("height_histogram", f"""WITH {POINTS}, heights AS (
  SELECT Z - (SELECT quantile_cont(Z, 0.05) FROM v_points) AS h FROM v_points) {_BINS}""")
def height_histogram(spark, sf_dir):
    return rounded(heights.height_histogram(heights.relative_height(points(spark, sf_dir))))


# The SQL side meets 3 x 3 cells of 40 m; every ground point within 40 m is seen, and the
# greatest distance it finds (returned in both results) is far below that.
_NEAREST = """a AS (
  SELECT X, Y, Z, floor(X/40) AS cx, floor(Y/40) AS cy FROM v_points WHERE Classification = 6),
g AS (SELECT X AS gx, Y AS gy, min(Z) AS gz, floor(X/40) AS cx, floor(Y/40) AS cy FROM v_points WHERE Classification = 2 GROUP BY 1, 2, 4, 5),
o AS (SELECT * FROM (VALUES (-1), (0), (1)) t(i)), probes AS (
  SELECT a.X, a.Y, a.cx + i.i AS cx, a.cy + j.i AS cy FROM (SELECT DISTINCT X, Y, cx, cy FROM a) a, o i, o j),
best AS (SELECT X, Y, min(((X-gx)*(X-gx) + (Y-gy)*(Y-gy), gx, gy, gz)) AS n FROM probes JOIN g USING (cx, cy) GROUP BY X, Y),
h AS (SELECT a.Z - n[4] AS height, sqrt(n[1]) AS distance FROM a JOIN best USING (X, Y))"""


@query("nearest_ground", f"""WITH {POINTS}, {_NEAREST}
SELECT count(*) AS points, round(min(height),6) AS min_height, round(max(height),6) AS max_height,
       round(avg(height),4) AS mean_height, count(*) FILTER (WHERE height > 10) AS tall, round(max(distance),6) AS max_distance FROM h""")
def nearest_ground(spark, sf_dir):
    h = heights.building_heights(points(spark, sf_dir))
    return h.agg(
        F.count("*").alias("points"), F.round(F.min("height"), 6).alias("min_height"),
        F.round(F.max("height"), 6).alias("max_height"), F.round(F.avg("height"), 4).alias("mean_height"),
        F.count_if(F.col("height") > 10).alias("tall"), F.round(F.max("distance"), 6).alias("max_distance"),
    )


@query("building_summary", f"""WITH {POINTS}, {_NEAREST}
SELECT count(*) AS points, round(min(height),6) AS min_height, round(max(height),6) AS max_height,
       round(avg(height),4) AS mean_height, count(*) FILTER (WHERE height > 10) AS tall FROM h""")
def building_summary(spark, sf_dir):
    told = rounded(heights.building_height_summary(heights.building_heights(points(spark, sf_dir))))
    return told.withColumn("mean_height", F.round("mean_height", 4))


@query("cross_section", f"""WITH {POINTS}, series AS (
  SELECT X AS x, avg(Z) AS y FROM v_points WHERE Y BETWEEN -49052 AND -49048 AND X BETWEEN 51200 AND 51600 AND Classification = 2 GROUP BY X),
samples AS (SELECT CAST(51200 + i * 10 AS DOUBLE) AS x, i FROM range(0, 40) t(i)),
near AS (SELECT s.i, s.x, (SELECT max((p.x, p.y)) FROM series p WHERE p.x <= s.x) AS lo,
         (SELECT min((p.x, p.y)) FROM series p WHERE p.x > s.x) AS hi FROM samples s)
SELECT CAST(i * 10 AS DOUBLE) AS distance, x, round(CASE WHEN lo IS NULL THEN hi[2] WHEN hi IS NULL OR lo[1] = x THEN lo[2]
  ELSE lo[2] + (x - lo[1]) * ((hi[2] - lo[2]) / (hi[1] - lo[1])) END, 4) AS z FROM near""")
def cross_section(spark, sf_dir):
    return rounded(heights.cross_section(points(spark, sf_dir), (51200, -49050), (51600, -49050)), 4)


