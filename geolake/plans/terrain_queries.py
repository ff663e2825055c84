"""Queries over rasters gridded from the point view."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import color
from ..operators import raster, terrain
from .registry import NUDGE, query, rounded
from .views import POINTS, cells, cells_sql, grid_sql, header, header_sql, points, raster_sql

RES = 2.0
AREA = RES * RES
CELLS, GRID = cells_sql(RES), grid_sql(RES)

_PRODUCT_SQL = {
    "dem": ("max(Z)", "TRUE"),
    "dsm": ("max(Z)", "TRUE"),
    "dtm": ("avg(Z)", "Classification = 2"),
    "intensity": ("avg(Intensity)", "TRUE"),
    "density": ("CAST(count(*) AS DOUBLE)", "TRUE"),
    "mean_non_noise": ("avg(Z)", "Classification <> 7"),
}


def _register_product(kind: str) -> None:
    aggregate, where = _PRODUCT_SQL[kind]
    sql = f"""WITH {POINTS}, {header_sql(RES)}, {raster_sql(RES, aggregate, where)}
SELECT "row", col, round(value + {NUDGE}, 6) AS value FROM cells"""

    @query(f"raster_{kind}", sql)
    def run(spark, sf_dir):
        return rounded(cells(spark, sf_dir, RES, kind).select("row", "col", "value"), 6, NUDGE)


for _kind in raster.PRODUCTS:
    _register_product(_kind)


@query("raster_radius", f"""WITH {POINTS}, {header_sql(RES)}, near AS (
  SELECT floor((X-minx)/2::DOUBLE + 0.5) + i AS col, floor((Y-miny)/2::DOUBLE + 0.5) + j AS srow, Z, width, height,
    i - ((X-minx)/2::DOUBLE - floor((X-minx)/2::DOUBLE + 0.5)) AS dx, j - ((Y-miny)/2::DOUBLE - floor((Y-miny)/2::DOUBLE + 0.5)) AS dy
  FROM v_points, hdr, (SELECT unnest(range(-2,3)) AS i), (SELECT unnest(range(-2,3)) AS j))
SELECT CAST(height - 1 - srow AS BIGINT) AS "row", CAST(col AS BIGINT) AS col, count(*) AS points, round(max(Z),6) AS max_z FROM near
WHERE dx*dx + dy*dy <= 2.0::DOUBLE + 1e-9 AND col >= 0 AND col < width AND srow >= 0 AND srow < height GROUP BY 1, 2""")
def raster_radius(spark, sf_dir):
    both = raster.rasterize_products(points(spark, sf_dir), ("dem", "density"), RES, mode="radius")
    return both.select("row", "col", F.col("density").cast("bigint").alias("points"), F.round("dem", 6).alias("max_z"))


@query("raster_by_file", f"""WITH {POINTS}, hdr AS (
  SELECT source_file, min(X) AS minx, min(Y) AS miny, CAST(floor((max(Y)-min(Y))/10::DOUBLE + 0.5) AS BIGINT) + 1 AS height
  FROM v_points GROUP BY source_file)
SELECT source_file AS raster_id, height - 1 - CAST(floor((Y-miny)/10::DOUBLE + 0.5) AS BIGINT) AS "row",
       CAST(floor((X-minx)/10::DOUBLE + 0.5) AS BIGINT) AS col, round(max(Z),6) AS value
FROM v_points JOIN hdr USING (source_file) GROUP BY 1, 2, 3""")
def raster_by_file(spark, sf_dir):
    return rounded(raster.rasterize(points(spark, sf_dir), "dem", 10.0, by="source_file"))


@query("raster_stats", f"""WITH {CELLS}
SELECT count(value) AS valid_count, round(min(value),6) AS minimum, round(max(value),6) AS maximum,
       round(avg(value),4) AS mean, round(stddev_pop(value),4) AS stddev FROM cells""")
def raster_stats(spark, sf_dir):
    out = raster.raster_stats(cells(spark, sf_dir, RES)).drop("raster_id")
    return rounded(out).withColumns({"mean": F.round("mean", 4), "stddev": F.round("stddev", 4)})


_LEVELS = "(VALUES (1), (2), (3), (5), (10)) AS r(rise)"


@query("flood", f"""WITH {CELLS}, base AS (SELECT avg(value) AS b FROM cells), levels AS (
  SELECT rise, b + rise AS level FROM base, {_LEVELS})
SELECT round(level + {NUDGE},4) AS level, CAST(rise AS DOUBLE) AS rise, count(*) FILTER (WHERE value < level) AS cells,
       CAST(count(*) FILTER (WHERE value < level) * 4 AS DOUBLE) AS area,
       round(sum(CASE WHEN value < level THEN level - value ELSE 0 END) * 4 + {NUDGE}, 2) AS volume,
       round(max(CASE WHEN value < level THEN level - value ELSE 0 END) + {NUDGE}, 4) AS max_depth
FROM cells, levels GROUP BY level, rise""")
def flood(spark, sf_dir):
    out = terrain.flood(cells(spark, sf_dir, RES), AREA)
    return out.select(
        "rise", "cells", "area", F.round(F.col("level") + NUDGE, 4).alias("level"),
        F.round(F.col("volume") + NUDGE, 2).alias("volume"), F.round(F.col("max_depth") + NUDGE, 4).alias("max_depth"),
    )


@query("flood_absolute", f"""WITH {CELLS}
SELECT CAST(level AS DOUBLE) AS level, count(*) FILTER (WHERE value < level) AS cells,
       round(sum(CASE WHEN value < level THEN level - value ELSE 0 END) * 4 + {NUDGE}, 2) AS volume
FROM cells, (VALUES (600), (640), (680), (720), (760)) AS l(level) GROUP BY level""")
def flood_absolute(spark, sf_dir):
    out = terrain.flood(cells(spark, sf_dir, RES), AREA, levels=(600, 640, 680, 720, 760))
    return out.select("level", "cells", F.round(F.col("volume") + NUDGE, 2).alias("volume"))


@query("flood_depth", f"""WITH {GRID}
SELECT "row", col, round(CASE WHEN value IS NULL THEN 0 ELSE greatest(0::DOUBLE, 700::DOUBLE - value) END, 6) AS depth FROM dense""")
def flood_depth(spark, sf_dir):
    near = terrain.neighbourhood(cells(spark, sf_dir, RES), header(spark, sf_dir, RES))
    return rounded(terrain.flood_depth(near, 700.0).select("row", "col", "depth"))


@query("cut_fill", f"""WITH {CELLS}
SELECT round(sum(greatest(value - 700::DOUBLE, 0::DOUBLE)) * 4 + {NUDGE}, 2) AS cut,
       round(sum(greatest(700::DOUBLE - value, 0::DOUBLE)) * 4 + {NUDGE}, 2) AS fill,
       round(sum(greatest(value - 700::DOUBLE, 0::DOUBLE)) * 4 - sum(greatest(700::DOUBLE - value, 0::DOUBLE)) * 4 + {NUDGE}, 2) AS net FROM cells""")
def cut_fill(spark, sf_dir):
    return rounded(terrain.cut_fill(cells(spark, sf_dir, RES), 700.0, AREA).drop("raster_id"), 2, NUDGE)


_DX = "CASE WHEN col = 0 THEN (e - value)/2::DOUBLE WHEN col = width - 1 THEN (value - w)/2::DOUBLE ELSE (e - w)/4::DOUBLE END"
_DY = "CASE WHEN \"row\" = 0 THEN (s - value)/2::DOUBLE WHEN \"row\" = height - 1 THEN (value - n)/2::DOUBLE ELSE (s - n)/4::DOUBLE END"
_SLOPES = f"""{GRID}, grad AS (SELECT *, {_DX} AS dx, {_DY} AS dy FROM g),
slopes AS (SELECT *, degrees(atan(sqrt(dx*dx + dy*dy))) AS slope FROM grad)"""


def _near(spark, sf_dir):
    return terrain.neighbourhood(cells(spark, sf_dir, RES), header(spark, sf_dir, RES))


@query("gradient", f'WITH {_SLOPES} SELECT "row", col, round(dx,6) AS dx, round(dy,6) AS dy FROM slopes')
def gradient(spark, sf_dir):
    return rounded(terrain.with_gradient(_near(spark, sf_dir), RES).select("row", "col", "dx", "dy"))


@query("slope", f'WITH {_SLOPES} SELECT "row", col, round(slope,4) AS slope FROM slopes')
def slope(spark, sf_dir):
    return rounded(terrain.with_slope(_near(spark, sf_dir), RES).select("row", "col", "slope"), 4)


@query("slope_summary", f"""WITH {_SLOPES}
SELECT round(min(slope),4) AS min_slope, round(max(slope),4) AS max_slope, round(avg(slope),4) AS mean_slope FROM slopes""")
def slope_summary(spark, sf_dir):
    return rounded(terrain.slope_summary(terrain.with_slope(_near(spark, sf_dir), RES)).drop("raster_id"), 4)


def _risk_sql(classes):
    return f"WITH {_SLOPES} " + " UNION ALL ".join(
        f"SELECT '{name}' AS risk, count(*) FILTER (WHERE {test}) AS cells, round(count(*) FILTER (WHERE {test}) * 4 / 10000::DOUBLE, 6) AS hectares, "
        f"round(count(*) FILTER (WHERE {test}) * 100::DOUBLE / count(slope), 6) AS percent FROM slopes"
        for name, test in classes
    )


@query("slope_risk", _risk_sql((
    ("low", "slope < 15"), ("medium", "slope >= 15 AND slope < 30"),
    ("high", "slope >= 30 AND slope < 45"), ("critical", "slope >= 45"),
)))
def slope_risk(spark, sf_dir):
    return rounded(terrain.slope_risk(terrain.with_slope(_near(spark, sf_dir), RES), AREA).drop("raster_id"))


@query("slope_risk_three", _risk_sql((
    ("low", "slope < 15"), ("medium", "slope >= 15 AND slope < 30"), ("high", "slope >= 30"),
)))
def slope_risk_three(spark, sf_dir):
    slopes = terrain.with_slope(_near(spark, sf_dir), RES)
    return rounded(terrain.slope_risk(slopes, AREA, (15, 30), ("low", "medium", "high")).drop("raster_id"))


_ASPECT = f"""{_SLOPES}, raw AS (SELECT *, degrees(atan2(-dx, dy)) AS a FROM slopes),
aspects AS (SELECT *, CASE WHEN a < 0 THEN a + 360 ELSE a END AS aspect FROM raw)"""


@query("aspect", f'WITH {_ASPECT} SELECT "row", col, round(aspect,4) AS aspect FROM aspects')
def aspect(spark, sf_dir):
    return rounded(terrain.with_aspect(_near(spark, sf_dir), RES).select("row", "col", "aspect"), 4)


@query("aspect_sectors", f"WITH {_ASPECT} " + " UNION ALL ".join(
    f"SELECT '{name}' AS sector, count(*) FILTER (WHERE {test}) AS cells, round(count(*) FILTER (WHERE {test}) * 100::DOUBLE / count(*), 6) AS percent FROM aspects"
    for name, test in [("N", "aspect >= 337.5 OR aspect < 22.5")]
    + [(n, f"aspect >= {i*45-22.5} AND aspect < {i*45+22.5}") for i, n in enumerate(terrain.SECTORS) if i]
))
def aspect_sectors(spark, sf_dir):
    aspects = terrain.with_aspect(_near(spark, sf_dir), RES)
    return rounded(terrain.aspect_distribution(aspects).drop("raster_id"))


_CURVE = f"""{_SLOPES}, curves AS (SELECT *,
  CASE WHEN "row" = 0 THEN value ELSE n END + CASE WHEN "row" = height - 1 THEN value ELSE s END
  + CASE WHEN col = 0 THEN value ELSE w END + CASE WHEN col = width - 1 THEN value ELSE e END - 4 * value AS curvature FROM slopes),
amp AS (SELECT *, CASE WHEN curvature IS NOT NULL AND slope IS NOT NULL THEN
  (1::DOUBLE + (least(greatest(curvature, -0.1::DOUBLE), 0.1::DOUBLE) + 0.1::DOUBLE) / 0.2::DOUBLE * 0.5::DOUBLE)
  * (1::DOUBLE + least(greatest(slope / 60::DOUBLE, 0::DOUBLE), 0.5::DOUBLE)) END AS amplification FROM curves)"""


@query("curvature", f'WITH {_CURVE} SELECT "row", col, round(curvature,6) AS curvature FROM curves')
def curvature(spark, sf_dir):
    return rounded(terrain.with_curvature(_near(spark, sf_dir)).select("row", "col", "curvature"))


@query("amplification", f"""WITH {_CURVE}
SELECT round(min(amplification),4) AS min_amplification, round(max(amplification),4) AS max_amplification,
       round(avg(amplification),4) AS mean_amplification,
       round(count(*) FILTER (WHERE amplification > 1.5::DOUBLE) * 4 / 10000::DOUBLE, 6) AS high_hectares FROM amp""")
def amplification(spark, sf_dir):
    amplified = terrain.with_amplification(_near(spark, sf_dir), RES)
    return rounded(terrain.amplification_summary(amplified, AREA).drop("raster_id"), 4)


# The SQL side pads the grid by one cell on every side, then takes plain 3 x 3 windows.
_SHADE = f"""{CELLS}, dense AS (
  SELECT r.i AS "row", c.i AS col, value AS v, width, height
  FROM hdr, LATERAL (SELECT unnest(range(0, height)) AS i) r, LATERAL (SELECT unnest(range(0, width)) AS i) c
  LEFT JOIN cells ON cells."row" = r.i AND cells.col = c.i),
m AS (SELECT a."row", a.col, a.width, a.height, a.v,
  coalesce(nw.v, a.v) AS nw, coalesce(n.v, a.v) AS n, coalesce(ne.v, a.v) AS ne, coalesce(w.v, a.v) AS w, coalesce(e.v, a.v) AS e,
  coalesce(sw.v, a.v) AS sw, coalesce(s.v, a.v) AS s, coalesce(se.v, a.v) AS se FROM dense a
  LEFT JOIN dense nw ON nw."row" = a."row"-1 AND nw.col = a.col-1 LEFT JOIN dense n ON n."row" = a."row"-1 AND n.col = a.col
  LEFT JOIN dense ne ON ne."row" = a."row"-1 AND ne.col = a.col+1 LEFT JOIN dense w ON w."row" = a."row" AND w.col = a.col-1
  LEFT JOIN dense e ON e."row" = a."row" AND e.col = a.col+1 LEFT JOIN dense sw ON sw."row" = a."row"+1 AND sw.col = a.col-1
  LEFT JOIN dense s ON s."row" = a."row"+1 AND s.col = a.col LEFT JOIN dense se ON se."row" = a."row"+1 AND se.col = a.col+1),
sides AS (SELECT "row", col, width, height, v, n, s,
  CASE WHEN col > 0 THEN nw WHEN "row" IN (0, height - 1) THEN n ELSE 2*n - ne END AS nw,
  CASE WHEN col > 0 THEN w WHEN "row" IN (0, height - 1) THEN v ELSE 2*v - e END AS w,
  CASE WHEN col > 0 THEN sw WHEN "row" IN (0, height - 1) THEN s ELSE 2*s - se END AS sw,
  CASE WHEN col < width - 1 THEN ne WHEN "row" IN (0, height - 1) THEN n ELSE 2*n - nw END AS ne,
  CASE WHEN col < width - 1 THEN e WHEN "row" IN (0, height - 1) THEN v ELSE 2*v - w END AS e,
  CASE WHEN col < width - 1 THEN se WHEN "row" IN (0, height - 1) THEN s ELSE 2*s - sw END AS se FROM m WHERE v IS NOT NULL),
full_grid AS (SELECT "row", col, w, e,
  CASE WHEN "row" > 0 THEN nw ELSE 2*w - sw END AS nw, CASE WHEN "row" > 0 THEN n ELSE 2*v - s END AS n,
  CASE WHEN "row" > 0 THEN ne ELSE 2*e - se END AS ne, CASE WHEN "row" < height - 1 THEN sw ELSE 2*w - nw END AS sw,
  CASE WHEN "row" < height - 1 THEN s ELSE 2*v - n END AS s, CASE WHEN "row" < height - 1 THEN se ELSE 2*e - ne END AS se FROM sides),
x AS (SELECT *, ((nw + 2*w + sw) - (ne + 2*e + se)) / 16::DOUBLE AS gx, ((sw + 2*s + se) - (nw + 2*n + ne)) / 16::DOUBLE AS gy FROM full_grid),
light AS (SELECT *, (sin(radians(45)) - cos(radians(45)) * 1.5::DOUBLE * sqrt(gx*gx + gy*gy) * sin(atan2(gy, gx) - radians(315)))
  / sqrt(1 + 2.25::DOUBLE * (gx*gx + gy*gy)) AS c FROM x)"""


@query("hillshade", f"""WITH {_SHADE}
SELECT "row", col, round(CASE WHEN c <= 0 THEN 1 ELSE 1 + 254 * c END, 4) AS hillshade FROM light""")
def hillshade(spark, sf_dir):
    shaded = terrain.with_hillshade(_near(spark, sf_dir), RES)
    return rounded(shaded.filter("value IS NOT NULL").select("row", "col", "hillshade"), 4)


@query("overview", f"WITH {CELLS} " + " UNION ALL ".join(
    f'SELECT {k} AS level, "row" // {2**k} AS "row", col // {2**k} AS col, round(avg(value) + {NUDGE}, 6) AS value FROM cells GROUP BY 2, 3'
    for k in (1, 2, 3)
))
def overview(spark, sf_dir):
    return rounded(raster.overviews(cells(spark, sf_dir, RES), (1, 2, 3)).drop("raster_id"), 6, NUDGE)


@query("subsample", f"""WITH {CELLS}, plan AS (SELECT width, height, CAST(ceil(greatest(width, height) / 64::DOUBLE) AS BIGINT) AS s FROM hdr)
SELECT "row" // s AS "row", col // s AS col, round(value,6) AS value FROM cells, plan
WHERE "row" % s = 0 AND col % s = 0 AND "row" // s < height // s AND col // s < width // s""")
def subsample(spark, sf_dir):
    small = raster.subsample(cells(spark, sf_dir, RES), header(spark, sf_dir, RES), 64)
    return rounded(small.select("row", "col", "value"))


def _mosaic_sql(rule):
    return f"""WITH {POINTS}, h AS (
  SELECT source_file, min(X) AS minx, min(Y) AS miny, CAST(floor((max(Y)-min(Y))/10::DOUBLE + 0.5) AS BIGINT) + 1 AS height
  FROM v_points GROUP BY source_file),
c AS (SELECT source_file, height - 1 - CAST(floor((Y-miny)/10::DOUBLE + 0.5) AS BIGINT) AS r,
       CAST(floor((X-minx)/10::DOUBLE + 0.5) AS BIGINT) AS c, max(Z) AS value
FROM v_points JOIN h USING (source_file) GROUP BY 1, 2, 3),
o AS (SELECT min(minx) AS ox, max(miny + (height - 1) * 10::DOUBLE) AS oy FROM h)
SELECT r + CAST(floor((oy - (miny + (height - 1) * 10::DOUBLE)) / 10::DOUBLE + 0.5) AS BIGINT) AS "row",
       c + CAST(floor((minx - ox) / 10::DOUBLE + 0.5) AS BIGINT) AS col, round({rule} + {NUDGE}, 6) AS value
FROM c JOIN h USING (source_file), o GROUP BY 1, 2"""


def _mosaic(spark, sf_dir, rule):
    cloud = points(spark, sf_dir)
    tiles = raster.rasterize(cloud, "dem", 10.0, by="source_file")
    return rounded(raster.mosaic(tiles, raster.raster_header(cloud, 10.0, "source_file"), rule).drop("raster_id"), 6, NUDGE)


@query("mosaic", _mosaic_sql("max_by(value, source_file)"))
def mosaic(spark, sf_dir):
    return _mosaic(spark, sf_dir, "last")


@query("mosaic_mean", _mosaic_sql("avg(value)"))
def mosaic_mean(spark, sf_dir):
    return _mosaic(spark, sf_dir, "mean")


def _channel_sql(stops, i):
    text = str(float(stops[-1][i]))
    for a, b in reversed(list(zip(stops, stops[1:]))):
        text = f"CASE WHEN t <= {b[0]}::DOUBLE THEN {float(a[i])} + (t - {a[0]}::DOUBLE) / ({b[0]}::DOUBLE - {a[0]}::DOUBLE) * {float(b[i] - a[i])} ELSE {text} END"
    return f"CAST(floor({text} + 0.5) AS INTEGER)"


_RAMP = f"""{CELLS}, scaled AS (
  SELECT "row", col, (value - lo) / (hi - lo) AS t FROM cells, (SELECT min(value) AS lo, max(value) AS hi FROM cells)),
rgb AS (SELECT "row", col, {', '.join(f"{_channel_sql(color.COLOR_MAPS['terrain'], i)} AS {n}" for i, n in ((1, 'r'), (2, 'g'), (3, 'b')))}, 255 AS a FROM scaled)"""


def _colored(spark, sf_dir, dem):
    span = dem.agg(F.struct(F.min("value").alias("lo"), F.max("value").alias("hi")).alias("s")).scalar()
    shown = dem.withColumn("_s", span)
    return shown.withColumn("c", color.color_ramp(F.col("value"), F.col("_s.lo"), F.col("_s.hi")))


@query("color_ramp", f'WITH {_RAMP} SELECT "row", col, r, g, b, a FROM rgb')
def color_ramp(spark, sf_dir):
    return _colored(spark, sf_dir, cells(spark, sf_dir, RES)).select("row", "col", "c.*")


@query("relief_color", f"""WITH {CELLS}, scaled AS (SELECT "row", col, least(greatest(value * 5, 2486::DOUBLE), 3757::DOUBLE) AS t FROM cells)
SELECT "row", col, {', '.join(f"{_channel_sql(color.RELIEF_STOPS, i)} AS {n}" for i, n in ((1, 'r'), (2, 'g'), (3, 'b')))}, 255 AS a FROM scaled""")
def relief_color(spark, sf_dir):
    dem = cells(spark, sf_dir, RES)
    return dem.select("row", "col", color.relief_color(F.col("value") * 5).alias("c")).select("row", "col", "c.*")


@query("blend", f"""WITH {_RAMP}, shade AS (SELECT "row", col, "row" * 7 % 256 AS s FROM rgb)
SELECT "row", col, {', '.join(f"CAST(trunc(least(greatest({n} * (0.3::DOUBLE + s / 255::DOUBLE * 0.7::DOUBLE), 0::DOUBLE), 255::DOUBLE)) AS INTEGER) AS {n}" for n in 'rgb')}
FROM rgb JOIN shade USING ("row", col)""")
def blend(spark, sf_dir):
    shown = _colored(spark, sf_dir, cells(spark, sf_dir, RES)).withColumn("_h", F.col("row") * 7 % 256)
    return shown.select("row", "col", *(color.blend(F.col(f"c.{n}"), F.col("_h")).alias(n) for n in "rgb"))


@query("mask_window", f"""WITH {CELLS}
SELECT "row", col, round(CASE WHEN value BETWEEN 600 AND 740 THEN value END, 6) AS value FROM cells, hdr
WHERE minx + col * 2::DOUBLE BETWEEN 51250 AND 51450 AND miny + (height - 1 - "row") * 2::DOUBLE BETWEEN -49150 AND -49000""")
def mask_window(spark, sf_dir):
    window = raster.read_window(cells(spark, sf_dir, RES), header(spark, sf_dir, RES), (51250, -49150, 51450, -49000))
    return rounded(raster.mask_cells(window, low=600, high=740).select("row", "col", "value"))


def _opening_sql(radius):
    side = f"BETWEEN {radius} PRECEDING AND {radius} FOLLOWING"
    return f"""o{radius}a AS (SELECT "row", col, value, min(value) OVER (PARTITION BY "row" ORDER BY col ROWS {side}) AS t FROM dense),
o{radius}b AS (SELECT "row", col, value, min(t) OVER (PARTITION BY col ORDER BY "row" ROWS {side}) AS t FROM o{radius}a),
o{radius}c AS (SELECT "row", col, value, max(t) OVER (PARTITION BY "row" ORDER BY col ROWS {side}) AS t FROM o{radius}b),
o{radius} AS (SELECT "row", col, value, max(t) OVER (PARTITION BY col ORDER BY "row" ROWS {side}) + 0.3::DOUBLE * {radius} * 2 AS lim FROM o{radius}c)"""


@query("ground_opening", f"""WITH {cells_sql(RES).replace('max(Z)', 'min(Z)')}, dense AS (
  SELECT r.i AS "row", c.i AS col, value
  FROM hdr, LATERAL (SELECT unnest(range(0, height)) AS i) r, LATERAL (SELECT unnest(range(0, width)) AS i) c
  LEFT JOIN cells ON cells."row" = r.i AND cells.col = c.i),
{', '.join(_opening_sql(r) for r in terrain.ground_radii(16, RES))},
lim AS (SELECT "row", col, min(lim) AS lim FROM ({' UNION ALL '.join(f'SELECT "row", col, lim FROM o{r} WHERE value IS NOT NULL' for r in terrain.ground_radii(16, RES))}) GROUP BY 1, 2)
SELECT CASE WHEN Z <= lim THEN 2 ELSE 1 END AS Classification, count(*) AS points, round(max(Z),6) AS max_z
FROM (SELECT Z, height - 1 - CAST(floor((Y-miny)/2::DOUBLE + 0.5) AS BIGINT) AS "row", CAST(floor((X-minx)/2::DOUBLE + 0.5) AS BIGINT) AS col FROM v_points, hdr)
JOIN lim USING ("row", col) GROUP BY 1""")
def ground_opening(spark, sf_dir):
    ground = terrain.classify_ground(points(spark, sf_dir), RES)
    return ground.groupBy("Classification").agg(F.count("*").alias("points"), F.round(F.max("Z"), 6).alias("max_z"))
