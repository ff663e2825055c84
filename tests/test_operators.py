"""Operators on small frames: golden values, brute force, properties, plans."""

import datetime
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from geolake.functions import color, crs, geom, text
from geolake.operators import catalog_build, heights, points, quality, raster, search, spatial_join, sync, terrain
from geolake.session import scratch_dir
from geolake.sources import documents, tables
from geolake.streaming import index

# Native box, zone 8 -> geographic box by the two-corner rule.
GOLDEN = [
    ((51200, -49200, 544.01, 51599.99, -48900.01, 767.22), (139.06475563623098, 35.55520960098564, 139.06918660065733, 35.55789280298778)),
    ((51600, -49500, 599.89, 51999.99, -49200.01, 756.13), (139.06914848246728, 35.552484815885485, 139.07357943982055, 35.555167857690265)),
    ((52800, -50100, 823.49, 53199.99, -49800.01, 1017.45), (139.0823447817422, 35.54701354613348, 139.08677586825084, 35.549696104100825)),
    ((19600.0, -70667.82, 2485.91, 22399.99, -68400.01, 3756.64), (138.71568239130661, 35.36282776994987, 138.7465559797546, 35.383211111989574)),
    ((51200.0, -50100.0, 523.163, 53199.99, -48900.001, 1077.42), (139.0646987483503, 35.54709747423191, 139.08683498636069, 35.55780827696616)),
]


def cells_of(spark, grid, raster_id="r"):
    rows = [(raster_id, i, j, float(v)) for i, line in enumerate(grid) for j, v in enumerate(line) if not math.isnan(v)]
    return spark.createDataFrame(rows, "raster_id string, row int, col int, value double")


def header_of(spark, grid, raster_id="r"):
    h, w = grid.shape
    return spark.createDataFrame([(raster_id, 0.0, 0.0, w, h, 1.0)], "raster_id string, minx double, miny double, width int, height int, resolution double")


def back(df, name, shape):
    out = np.full(shape, np.nan)
    for r in df.select("row", "col", name).collect():
        if r[2] is not None:
            out[r[0], r[1]] = r[2]
    return out


def hilly(h=11, w=13, holes=((4, 5), (0, 3), (10, 12))):
    rng = np.random.default_rng(1)
    grid = rng.normal(100, 5, (h, w))
    for i, j in holes:
        grid[i, j] = np.nan
    return grid


@pytest.mark.parametrize("native,degrees", GOLDEN)
def test_golden_boxes(spark, native, degrees):
    assert crs.literal_bbox_to_wgs84(native, 6676, 2) == pytest.approx(degrees, abs=1e-9)
    df = spark.createDataFrame([(list(map(float, native)), 6676)], "bbox array<double>, epsg int")
    got = df.select(crs.bbox_to_wgs84(F.col("bbox"), F.col("epsg"), 2).alias("b")).first().b
    assert (got[0], got[1], got[3], got[4]) == pytest.approx(degrees, abs=1e-9)
    assert (got[2], got[5]) == (native[2], native[5])


def test_unknown_code_gives_null(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0], 9999), ([1.0, 2.0, 3.0, 4.0], None), ([1.0, 2.0, 3.0, 4.0], 4326)], "b array<double>, e int")
    got = [r[0] for r in df.select(crs.bbox_to_wgs84(F.col("b"), F.col("e"))).collect()]
    assert got == [None, None, [1.0, 2.0, 3.0, 4.0]]


@pytest.mark.parametrize("epsg", [6669, 6676, 6677, 6681, 6687])
def test_round_trip(spark, epsg):
    df = spark.createDataFrame([(x, y) for x in (-30000.0, 0.0, 45000.0) for y in (-60000.0, 10.0, 80000.0)], "a double, b double")
    there = crs.with_plane(crs.with_wgs84(df, "a", "b", epsg), "lon", "lat", epsg, "x", "y")
    for r in there.collect():
        assert (r.x, r.y) == pytest.approx((r.a, r.b), abs=1e-5)
    one = df.select(crs.geographic(F.col("a"), F.col("b"), epsg).alias("g"), "a", "b")
    for r, s in zip(one.collect(), there.collect()):
        assert (r.g.x, r.g.y) == pytest.approx((s.lon, s.lat), abs=1e-12)


def test_place(spark):
    west, south, _, _ = crs.literal_bbox_to_wgs84((19600, -68700, 19600, -68700), 6676)
    assert (west, south) == pytest.approx((138.715730, 35.380566), abs=2e-6)


def test_text(spark):
    rows = [("EPSG:6676",), ('PROJCRS["x",ID["EPSG",6668],ID["EPSG",6677]]',), ('A[AUTHORITY["EPSG","1"]],AUTHORITY["EPSG","6676"]',), ("none",), (None,)]
    df = spark.createDataFrame(rows, "t string")
    assert [r[0] for r in df.select(text.epsg_of(F.col("t"))).collect()] == [6676, 6677, 6676, None, None]
    with pytest.raises(ValueError):
        text.literal_bbox("1,2,3")
    links = spark.createDataFrame([("a/b/c.json", "../x.json"), ("a/b/c.json", "./d/e.json"), ("c.json", "../../x.json"), ("a/b.json", "https://h/x")], "p string, h string")
    assert [r[0] for r in links.select(text.resolve_href(F.col("p"), F.col("h"))).collect()] == ["a/x.json", "a/b/d/e.json", "x.json", "https://h/x"]
    names = spark.createDataFrame([("d/x.copc.laz",), ("x.las",), ("x",)], "n string")
    assert [tuple(r) for r in names.select(text.stem(F.col("n")), text.bare_stem(F.col("n"))).collect()] == [("x.copc", "x"), ("x", "x"), ("x", "x")]


def test_polygon_box(spark):
    cases = [
        ("POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0))", True),  # contains the box
        ("POLYGON ((1.2 1.2, 1.4 1.2, 1.4 1.4, 1.2 1.2))", True),  # inside it
        ("POLYGON ((2 1, 3 1, 3 2, 2 2, 2 1))", True),  # touches
        ("POLYGON ((2.5 -1, 5 1, 5 -1, 2.5 -1))", False),
        ("POLYGON ((0 0, 9 0, 9 9, 0 9, 0 0), (0.5 0.5, 5 0.5, 5 5, 0.5 5, 0.5 0.5))", False),  # in a hole
        ("POLYGON ((3 0, 0 3, 4 4, 3 0))", True),  # cut by a corner
        ("POLYGON ((3.1 1, 1 3.1, 4 4, 3.1 1))", False),  # boxes overlap, shapes do not
        ("MULTIPOLYGON (((8 8, 9 8, 9 9, 8 8)), ((1.5 1.5, 3 1.5, 3 3, 1.5 1.5)))", True),
        ("POINT (1 2)", True), ("POINT (0.9 2)", False),
    ]
    df = spark.createDataFrame([(w,) for w, _ in cases], "w string")
    shape = geom.from_wkt(F.col("w"))
    got = df.select(geom.intersects_box(shape, 1, 1, 2, 2), geom.to_wkt(geom.from_geojson(geom.to_geojson(shape)))).collect()
    assert [r[0] for r in got] == [t for _, t in cases]
    floats = lambda w: [float(v) for v in w.replace("(", " ").replace(")", " ").replace(",", " ").split()[1:]]
    assert all(floats(r[1]) == floats(w) for r, (w, _) in zip(got, cases))
    bad = spark.createDataFrame([("LINESTRING (0 0, 1 1)",), ("nonsense",), (None,)], "w string")
    assert [r[0] for r in bad.select(geom.from_wkt(F.col("w"))).collect()] == [None] * 3


@pytest.mark.parametrize("block", [4, 256])
def test_terrain_matches_numpy(spark, block):
    grid = hilly()
    near = terrain.neighbourhood(cells_of(spark, grid), header_of(spark, grid), block)
    dy, dx = np.gradient(grid, 2.0)
    shown = terrain.with_aspect(terrain.with_slope(near, 2.0), 2.0)
    np.testing.assert_allclose(back(shown, "dx", grid.shape), dx)
    np.testing.assert_allclose(back(shown, "dy", grid.shape), dy)
    np.testing.assert_allclose(back(shown, "slope", grid.shape), np.degrees(np.arctan(np.hypot(dx, dy))))
    a = np.degrees(np.arctan2(-dx, dy))
    np.testing.assert_allclose(back(shown, "aspect", grid.shape), np.where(a < 0, a + 360, a))
    p = np.pad(grid, 1, mode="edge")
    laplace = p[:-2, 1:-1] + p[2:, 1:-1] + p[1:-1, :-2] + p[1:-1, 2:] - 4 * grid
    np.testing.assert_allclose(back(terrain.with_curvature(near), "curvature", grid.shape), laplace)
    assert near.count() == grid.size


def test_hillshade(spark):
    flat = np.full((5, 6), 10.0)
    near = terrain.neighbourhood(cells_of(spark, flat), header_of(spark, flat), 3)
    np.testing.assert_allclose(back(terrain.with_hillshade(near, 1.0), "hillshade", flat.shape), 1 + 254 * math.sin(math.radians(45)))
    # a plane has one shade everywhere, edges included, when they are extrapolated
    i, j = np.mgrid[0:6, 0:7]
    tilted = 3.0 * i + 2.0 * j
    near = terrain.neighbourhood(cells_of(spark, tilted), header_of(spark, tilted))
    shade = back(terrain.with_hillshade(near, 1.0), "hillshade", tilted.shape)
    np.testing.assert_allclose(shade[1:-1, 1:-1], shade[2, 2])
    np.testing.assert_allclose(shade[1:-1, 0], shade[2, 2])
    np.testing.assert_allclose(shade[0, 1:-1], shade[2, 2])


@pytest.mark.parametrize("radius", [1, 2])
def test_opening(spark, radius):
    grid = hilly(12, 9, ((4, 5), (0, 3), (11, 8)))
    got = back(terrain.opened_surface(cells_of(spark, grid), header_of(spark, grid), radius, block=5), "opened", grid.shape)

    def fold(a, f):
        out = np.full(a.shape, np.nan)
        for i in range(a.shape[0]):
            for j in range(a.shape[1]):
                w = a[max(0, i - radius):i + radius + 1, max(0, j - radius):j + radius + 1]
                out[i, j] = f(w)
        return out

    want = fold(fold(grid, np.nanmin), np.nanmax)
    np.testing.assert_allclose(got[~np.isnan(grid)], want[~np.isnan(grid)])


def test_flood_and_cut_fill(spark):
    grid = hilly()
    cells = cells_of(spark, grid)
    rows = sorted(terrain.flood(cells, 4.0).collect(), key=lambda r: r.level)
    mean = np.nanmean(grid)
    assert [r.rise for r in rows] == [1, 2, 3, 5, 10]
    for r in rows:
        depth = np.where(grid < mean + r.rise, mean + r.rise - grid, 0)
        assert r.volume == pytest.approx(np.nansum(depth) * 4)
        assert r.max_depth == pytest.approx(np.nanmax(depth))
    assert [r.volume for r in rows] == sorted(r.volume for r in rows)
    dry = terrain.flood(cells, 4.0, levels=[0]).first()
    assert (dry.area, dry.volume, dry.max_depth) == (0, 0, 0)
    c = terrain.cut_fill(cells, 100.0, 1.0).first()
    assert c.cut - c.fill == pytest.approx(np.nansum(grid - 100)) == pytest.approx(c.net)


def cloud(spark, rows):
    return spark.createDataFrame(rows, "X double, Y double, Z double, Classification int")


@pytest.mark.parametrize("most", [1, 16])
def test_nearest_against_brute_force(spark, most):
    rng = random.Random(3)
    # a crowded cluster with equal places, far singles, and an empty middle
    ground = [(round(rng.gauss(50, 0.2), 1), round(rng.gauss(-20, 0.2), 1), rng.random(), 2) for _ in range(300)]
    ground += [(rng.uniform(-200, 200), rng.uniform(-200, 200), rng.random(), 2) for _ in range(12)]
    building = [(rng.uniform(-150, 150), rng.uniform(-150, 150), 5.0, 6) for _ in range(120)] + [(ground[0][0], ground[0][1], 9.0, 6)] * 3
    # a leaf far from everything, one place beyond what any cell size would suit, and rows without a place
    ground += [(1e9, 1e9, 0.5, 2), (50.0 + 1e-9, -20.0, 0.1, 2)]
    odd = [(float("nan"), 1.0, 2.0, 6), (None, 1.0, 2.0, 6)]
    left, right = cloud(spark, building + odd), cloud(spark, ground + [(float("inf"), 0.0, 0.0, 2)]).select("X", "Y", "Z")
    near = spatial_join.nearest_join(left, right, ["Z"], most=most).withColumn("height", F.col("Z") - F.col("Z_near")).collect()
    assert sum(r.distance is None for r in near) == 2
    got = [r for r in near if r.distance is not None]
    assert len(got) == len(building)
    for r in got:
        best = min(((r.X - x) ** 2 + (r.Y - y) ** 2, x, y, z) for x, y, z, _ in ground)
        assert r.distance == pytest.approx(math.sqrt(best[0]), abs=1e-9)
        assert r.height == pytest.approx(r.Z - best[3])


def test_nearest_without_ground(spark):
    (row,) = heights.building_heights(cloud(spark, [(0.0, 0.0, 1.0, 6)])).collect()
    assert row.distance is None and row.height is None


def test_points_in_areas(spark):
    rng = random.Random(5)
    pts = [(rng.uniform(-50, 50), rng.uniform(-50, 50), 0.0, 2) for _ in range(300)] + [(0.0, 0.0, 0.0, 2)] * 50
    areas = [(i, x, y, x + s, y + s) for i in range(40) for x, y, s in [(rng.uniform(-60, 50), rng.uniform(-60, 50), rng.choice([0.0, 1.0, 9.0, 70.0]))]]
    areas.append((99, -1000.0, -1000.0, 1000.0, 1000.0))
    df = spark.createDataFrame(areas, "area_id int, minx double, miny double, maxx double, maxy double")
    got = {r.area_id: r.n for r in spatial_join.points_in_areas(cloud(spark, pts), df).groupBy("area_id").agg(F.count("*").alias("n")).collect()}
    want = {a: n for a, x0, y0, x1, y1 in areas if (n := sum(x0 <= x <= x1 and y0 <= y <= y1 for x, y, _, _ in pts))}
    assert got == want


def test_interpolation_matches_numpy(spark):
    rng = random.Random(7)
    xs = sorted(rng.uniform(20, 80) for _ in range(40)) + [50.0]
    series = [(x, rng.random()) for x in sorted(xs)]
    samples = [float(v) for v in range(0, 101, 5)] + [series[3][0]]
    got = spatial_join.interp_join(
        spark.createDataFrame([(s,) for s in samples], "x double"), spark.createDataFrame(series, "x double, y double"), [], 7.0
    ).collect()
    want = np.interp(samples, *zip(*series))
    assert {round(r.x, 9): round(r.y, 9) for r in got} == {round(s, 9): round(float(w), 9) for s, w in zip(samples, want)}


@pytest.mark.parametrize("values", [[5.0], [1.0, 2.0], [3.0] * 50 + [9.0], list(np.random.default_rng(2).normal(0, 1, 997)), [0.0] * 10 + [1e9] + [1e-9] * 5, [-0.0, 0.0, -1e-300, 1e300, -5.5] * 7])
def test_quantile_matches_numpy(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for p in (0.0, 0.05, 0.5, 0.99, 1.0):
        assert spatial_join.exact_quantile(df, "v", p).first()[0] == pytest.approx(np.percentile(values, p * 100))


def test_quantile_edges(spark):
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "v double")
    value = lambda values, p: spatial_join.exact_quantile(frame(values), "v", p).first()[0]
    assert value([], 0.5) is None and value([None, 3.0, None], 0.5) == 3.0
    assert value([1.0, 2.0, float("nan")], 0.5) == 2.0 and math.isnan(value([1.0, float("nan")], 1.0))
    assert value([float("-inf"), 1.0, float("inf")], 0.5) == 1.0


def test_interpolation_over_many_strips(spark):
    # every strip is asked for, few are filled; segments of 2^11 strips make both levels count
    series = spark.createDataFrame([(0, 5.0, 1.0), (0, 700000.5, 8.0), (1, 400000.25, 3.0)], "k int, x double, y double")
    samples = spark.range(1000000).select((F.col("id") % 2).cast("int").alias("k"), (F.col("id") + 0.5).alias("x"))
    got = spatial_join.interp_join(samples, series, ["k"], 1.0, bits=11)
    want = F.when(F.col("k") == 1, 3.0).when(F.col("x") <= 5, 1.0).when(F.col("x") >= 700000.5, 8.0).otherwise(1 + (F.col("x") - 5) / 699995.5 * 7)
    row = got.agg(F.count("*").alias("n"), F.max(F.abs(F.col("y") - want)).alias("off"), F.count_if(F.col("y").isNull()).alias("none")).first()
    assert row.n == 1000000 and row.none == 0 and row.off < 1e-9
    assert "SinglePartition" not in plan(got)


def brute_rings(cells):
    """Rings of a set of hexagons by walking their free sides, and the number of pieces by flood fill."""
    corner = ((1, -1), (1, 1), (0, 2), (-1, 1), (-1, -1), (0, -2))
    steps = ((1, 0), (0, 1), (-1, 1), (-1, 0), (0, -1), (1, -1))
    follow = {}
    for q, r in cells:
        for k, (dq, dr) in enumerate(steps):
            if (q + dq, r + dr) not in cells:
                u, v = 2 * q + r, 3 * r
                follow[u + corner[k][0], v + corner[k][1]] = (u + corner[(k + 1) % 6][0], v + corner[(k + 1) % 6][1])
    rings, left = [], set(follow)
    while left:
        ring = [min(left)]
        while follow[ring[-1]] != ring[0]:
            ring.append(follow[ring[-1]])
        left -= set(ring)
        rings.append([*ring, ring[0]])
    pieces, todo = 0, set(cells)
    while todo:
        pieces, front = pieces + 1, [todo.pop()]
        while front:
            q, r = front.pop()
            for dq, dr in steps:
                if (q + dq, r + dr) in todo:
                    todo.discard((q + dq, r + dr))
                    front.append((q + dq, r + dr))
    return rings, pieces


@pytest.mark.parametrize("seed", [1, 2])
def test_hexagon_rings(spark, seed):
    rng = random.Random(seed)
    cells = {(q, r) for q in range(-9, 10) for r in range(-9, 10) if rng.random() < 0.62} | {(40, 1)}
    hexes = spark.createDataFrame([("a", q, r, 1) for q, r in cells] + [("b", 0, 0, 1)], "f string, q long, r long, count long")
    found = points.hex_rings(hexes, ["f"]).cache()
    rings, pieces = brute_rings(cells)
    got = sorted([(c.u, c.v) for c in x.corners] for x in found.filter("f = 'a'").collect())
    assert got == sorted([tuple(c) for c in ring] for ring in rings)
    shapes = points.hex_polygons(found, 2.0, ["f"]).collect()
    assert sum(x.f == "a" for x in shapes) == pieces and sum(x.holes for x in shapes) == len(rings) - pieces
    assert sum(x.area for x in shapes) == pytest.approx((len(cells) + 1) * 1.5 * math.sqrt(3) * 4)
    # each polygon by itself: the shoelace sum over its rings, holes running the other way
    for x in shapes:
        total = 0.0
        for ring in re.findall(r"\(([^()]+)\)", x.wkt):
            xy = [tuple(map(float, p.split())) for p in ring.split(", ")]
            assert xy[0] == xy[-1]
            total += sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(xy, xy[1:])) / 2
        assert x.wkt.count("(") == x.holes + 2 and total == pytest.approx(x.area, rel=1e-5)


def test_hexagons(spark):
    rng = random.Random(11)
    pts = cloud(spark, [(rng.uniform(-80, 80), rng.uniform(-80, 80), 0.0, 2) for _ in range(2000)])
    hexes = points.hexbin(pts, 10.0)
    assert hexes.agg(F.sum("count")).first()[0] == 2000
    lone = spark.createDataFrame([(3, -2, 7)], "q long, r long, count long")
    edge = points.hex_boundary(lone, 10.0).collect()
    assert len(edge) == 6
    ends = sorted((round(e.x1, 6), round(e.y1, 6)) for e in edge)
    assert ends == sorted((round(e.x2, 6), round(e.y2, 6)) for e in edge)
    assert all(math.hypot(e.x1 - e.x2, e.y1 - e.y2) == pytest.approx(10) for e in edge)


def test_lod_and_sample(spark):
    rng = random.Random(13)
    rows = [(rng.uniform(0, 32), rng.uniform(0, 32), rng.uniform(0, 32), 2) for _ in range(400)] + [(1.0, 1.0, 1.0, 2)] * 200
    pts = cloud(spark, rows)
    leveled = points.assign_lod(pts, 3, 16.0, F.xxhash64("X", "Y", "Z")).cache()
    assert leveled.agg(F.sum("copies")).first()[0] == 600
    for level in range(3):
        side = 16.0 / 2**level
        voxels = leveled.filter(F.col("level") == level).groupBy(*(F.floor(F.col(d) / side) for d in "XYZ")).agg(F.sum("copies").alias("n"))
        assert voxels.agg(F.max("n")).first()[0] == 1
    assert leveled.filter("level = 0").count() == 8
    assert points.within_budget(leveled, 70).agg(F.max("level")).first()[0] == 1
    sample = points.sample_points(pts, 100, 4)
    assert sample.count() == 100
    assert sorted(map(tuple, sample.collect())) == sorted(map(tuple, points.sample_points(pts.repartition(7), 100, 4).collect()))
    assert points.sample_points(pts, 10000).count() == 600


def test_rasterize_counts_every_point(spark):
    rng = random.Random(17)
    pts = cloud(spark, [(rng.uniform(0, 40), rng.uniform(0, 30), 1.0, 2) for _ in range(500)])
    assert raster.rasterize(pts, "density", 3.0).agg(F.sum("value")).first()[0] == 500
    wide = spark.createDataFrame([(51200.0, -49200.0, 1.0, 2), (51599.99, -48900.01, 1.0, 2)], "X double, Y double, Z double, Classification int")
    h = raster.raster_header(wide, 1.0).first()
    assert (h.width, h.height) == (401, 301)


def test_range_text(spark):
    pts = cloud(spark, [(0.0, 0.0, float(z), c) for z in (1, 5, 9) for c in (2, 6, 7)])
    assert points.filter_range(pts, "Classification[2:2],Classification[6:6],Z[5:]").count() == 4
    assert points.filter_range(pts, "Classification![7:7]").count() == 6
    with pytest.raises(ValueError):
        points.filter_range(pts, "Classification 2")


def test_colors(spark):
    df = spark.createDataFrame([(0.0,), (50.0,), (100.0,), (None,), (float("nan"),)], "v double")
    got = [tuple(r[0]) for r in df.select(color.color_ramp(F.col("v"), F.lit(0.0), F.lit(100.0), "grayscale")).collect()]
    assert got == [(0, 0, 0, 255), (128, 128, 128, 255), (255, 255, 255, 255), (0, 0, 0, 0), (0, 0, 0, 0)]


def test_search_requests(spark):
    assert search.request_interval("../2024-01-01T00:00:00Z")[0] is None
    assert search.request_interval("2024-01-01")[0] == datetime.datetime(2024, 1, 1, tzinfo=datetime.timezone.utc)
    assert search.request_bbox("1,2,0,3,4,9") == (1, 2, 3, 4)
    for bad in (0, 101):
        with pytest.raises(ValueError):
            search.check_limit(bad)
    with pytest.raises(ValueError):
        search.request_bbox("1,2,3,4", "EPSG:9999")
    rows = [("a", None, 0.0, 0.0, 2.0, 2.0, "POLYGON ((0 0, 2 0, 0 2, 0 0))"), ("b", None, None, None, None, None, None), ("c", None, 5.0, 5.0, 6.0, 6.0, None)]
    items = spark.createDataFrame(rows, "id string, datetime timestamp, minx double, miny double, maxx double, maxy double, geometry_wkt string").withColumn("collection", F.lit("x"))
    hit = lambda **k: sorted(r.id for r in search.search(items, **k).collect())
    assert hit(bbox="1.5,1.5,3,3") == ["b"]  # the triangle misses, its box does not
    assert hit(bbox="0.5,0.5,3,3") == ["a", "b"]
    assert hit(bbox="5,5,5,5", keep_unlocated=False) == ["c"]
    assert hit(datetime="2024-01-01T00:00:00Z/..") == []


def test_location_status(spark):
    b = [51200.0, -49200.0, 0.0, 51599.99, -48900.01, 9.0]
    turned = [b[1], b[0], 0.0, b[4], b[3], 9.0]
    df = spark.createDataFrame([("c", b, 6676), ("c", turned, 6676), ("c", b, 6669), ("c", b, None), ("d", b, 6676)], "collection string, proj_bbox array<double>, proj_epsg int")
    got = [r.location for r in quality.check_locations(df, {"c": (139.0, 35.5, 139.1, 35.6)}).collect()]
    assert got == ["ok", "swapped", "elsewhere", "unknown", "unknown"]


def test_metadata_to_items(spark):
    rows = [("d/08.copc.laz", list(map(float, GOLDEN[0][0])), None, "EPSG:6676", 5, None), ("x.las", None, 9999, None, 7, None)]
    meta = spark.createDataFrame(rows, "source_file string, bbox array<double>, epsg int, source_crs string, point_count bigint, output_file string").withColumn("file_size_bytes", F.lit(1))
    a, b = catalog_build.items_from_metadata(meta, "https://h/", "c", "2025-01-01 00:00:00").collect()
    assert (a.id, a.proj_epsg, a.crs_ok) == ("08.copc", 6676, True)
    assert a.bbox == pytest.approx(GOLDEN[0][1], abs=1e-9)
    assert a.assets["metadata"].href == "https://h/data/08.metadata.json"
    assert (b.id, b.crs_ok, b.bbox) == ("x", False, None)
    empty = catalog_build.collection_extent(meta.limit(0)).first()
    assert (empty.minx, empty.miny, empty.maxx, empty.maxy) == crs.WORLD


def test_inventory_and_sync(spark):
    make = lambda rows: spark.createDataFrame(rows, "key string, size int, modified int")
    got = {r.key: r.action for r in sync.inventory_diff(make([("a", 1, 1), ("b", 1, 1), ("c", 1, 5), ("e", 1, 1)]), make([("b", 2, 1), ("c", 1, 1), ("d", 1, 1), ("e", 1, 2)])).collect()}
    assert got == {"a": "new", "b": "changed", "c": "changed", "d": "deleted"}


def test_catalog_walk_ends_on_cycles(spark):
    edges = spark.createDataFrame([("r", "child", "a"), ("a", "child", "b"), ("b", "child", "r"), ("a", "item", "i"), ("b", "item", "i")], "src string, rel string, dst string")
    got = {r.path: r.depth for r in quality.walk_catalog(edges, spark.createDataFrame([("r",)], "path string")).collect()}
    assert got == {"r": 0, "a": 1, "b": 2, "i": 2}


def test_index_log(spark):
    t = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    doc = lambda v: '{"type":"Feature","id":"%s"}' % v
    frame = lambda rows: spark.createDataFrame(rows, index.CHANGES)
    root = scratch_dir(spark, "log")
    assert index.current_documents(spark, root).count() == 0
    first = frame([("a", "ObjectCreated:Put", t(1), doc("a1")), ("b", "ObjectCreated:Put", t(1), doc("b1"))])
    index.append_changes(first, 0, root)
    index.append_changes(first, 0, root)  # a replayed batch
    index.append_changes(frame([("a", "ObjectRemoved:Delete", t(3), None), ("b", "ObjectCreated:Put", t(5), doc("b2"))]), 1, root)
    index.append_changes(frame([("a", "ObjectCreated:Put", t(2), doc("late")), ("c", "ObjectCreated:Put", t(2), doc("c1"))]), 2, root)
    live = lambda: sorted((r.path, r.doc) for r in index.current_documents(spark, root).collect())
    assert live() == [("b", doc("b2")), ("c", doc("c1"))]
    index.compact(spark, root)
    assert live() == [("b", doc("b2")), ("c", doc("c1"))]
    index.append_changes(frame([("b", "ObjectRemoved:Delete", t(9), None)]), 3, root)
    assert live() == [("c", doc("c1"))]


def test_bad_documents(spark):
    rows = [("a/x/x.json", '{"type":"Feature","id":"x","geometry":null,"properties":{"datetime":"soon"}}'), ("a/y/y.json", '{"type":"Feature", oops'),
            ("a/z.json", "[1]"), ("a/collection.json", '{"type":"Collection","id":"A"}'), ("a/w/w.json", '{"type":"Feature","id":"w","bbox":[1,2,0,3,4,9]}')]
    docs = spark.createDataFrame(rows, "path string, doc string").withColumn("type", documents.document_type(F.col("doc")))
    assert sorted(r.path for r in documents.rejects(docs).collect()) == ["a/y/y.json", "a/z.json"]
    found = documents.infer_collection(documents.flatten_items(docs), documents.flatten_collections(docs))
    got = {r.id: r for r in found.collect()}
    assert got["x"].collection == "A" and got["x"].datetime is None and got["x"].minx is None
    assert (got["w"].minx, got["w"].miny, got["w"].maxx, got["w"].maxy) == (1, 2, 3, 4)
    assert got["w"].title == "w"


# --- plans ------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_python_and_no_cartesian(spark):
    pts = cloud(spark, [(float(i), float(i), 1.0, 2 + 4 * (i % 2)) for i in range(50)])
    areas = spark.createDataFrame([(1, 0.0, 0.0, 5.0, 5.0)], "area_id int, minx double, miny double, maxx double, maxy double")
    for df in (heights.building_heights(pts), spatial_join.points_in_areas(pts, areas), terrain.classify_ground(pts, 2.0), points.hexbin(pts)):
        shown = plan(df)
        for node in ("CartesianProduct", "NestedLoop", "PythonUDF", "ArrowEval", "BatchEvalPython"):
            assert node not in shown


def test_bounded_read_pushes_down(spark):
    path = scratch_dir(spark, "plan")
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    tables.write_clustered(cloud(spark, [(float(i % 97), float(i % 89), 1.0, 2) for i in range(500)]), path, partitions=4)
    shown = plan(tables.read_points(spark, path, bbox=(10, 10, 20, 20)).select("Z"))
    assert "GreaterThanOrEqual(X,10.0)" in shown and "LessThanOrEqual(Y,20.0)" in shown
    assert "Intensity" not in shown.split("ReadSchema")[1]


def test_neighbourhood_shuffles_cells_once(spark):
    path = scratch_dir(spark, "cells")
    grid = hilly()
    cells_of(spark, grid).write.parquet(path)
    near = terrain.neighbourhood(spark.read.parquet(path), header_of(spark, grid))
    near.collect()
    assert plan(near).split("Initial Plan")[0].count("Exchange hashpartitioning(raster_id") <= 2


def test_items_of_two_collections_share_an_id(spark):
    item = '{"type":"Feature","id":"t1","properties":{}}'
    rows = [(f"{c}/t1/t1.json", item) for c in "ab"] + [("a/t1/t1 (conflicted copy).json", item)]
    rows += [(f"{c}/collection.json", '{"type":"Collection","id":"%s"}' % c) for c in "ab"]
    rows += [(f"n/{k}/{k}.json", '{"type":"Feature","properties":{}}') for k in "xy"]
    docs = spark.createDataFrame(rows, "path string, doc string").withColumn("type", documents.document_type(F.col("doc")))
    kept = documents.keep_one(docs).select("path").collect()
    assert {"a/t1/t1.json", "b/t1/t1.json", "n/x/x.json", "n/y/y.json"} <= {r.path for r in kept}


def test_large_page_is_whole(spark):
    from geolake.operators import render

    page = spark.range(250).select(F.col("id").cast("string").alias("id"), F.format_string('{"id":"%d"}', F.col("id")).alias("feature"))
    row = render.feature_collection(page, spark.range(250).agg(F.count("*").alias("matched")), "http://x").first()
    assert row.returned == 250 and row.document.count('"id"') == 250


def test_two_writers_lose_nothing(spark, tmp_path, monkeypatch):
    from geolake.sources import files

    change = lambda key: spark.createDataFrame([(key, "ObjectCreated:Put", None, "{}")], index.CHANGES)
    root, plain = f"{tmp_path}/shared", files.create_small
    index.append_changes(change("first"), 0, root, "one")
    met = []

    def slow(session, path, text):
        """The other writer commits between this one's look and its own commit."""
        if not met:
            met.append(path)
            index.append_changes(change("other"), 0, root, "two")
        return plain(session, path, text)

    monkeypatch.setattr(files, "create_small", slow)
    index.append_changes(change("mine"), 1, root, "one")
    monkeypatch.undo()
    live = lambda: sorted(r.path for r in index.current_documents(spark, root).collect())
    assert live() == ["first", "mine", "other"] and len(files.names(spark, f"{root}/commits")) == 3
    index.append_changes(change("replayed"), 1, root, "one")
    assert live() == ["first", "mine", "other"]
    # a batch that comes while the index is compacted stays
    met.clear()
    monkeypatch.setattr(files, "create_small", lambda *a: (met.append(1) or index.append_changes(change("late"), 2, root, "one") if not met else None, plain(*a))[1])
    assert index.compact(spark, root)
    monkeypatch.undo()
    assert live() == ["first", "late", "mine", "other"]


def test_removed_keys_stay_removed(spark, tmp_path):
    t = lambda m: datetime.datetime(2024, 1, 1, 0, m)
    frame = lambda rows: spark.createDataFrame(rows, index.CHANGES)
    root = f"{tmp_path}/removed"
    index.append_changes(frame([("a", "ObjectCreated:Put", t(1), "{}"), ("a", "ObjectRemoved:Delete", t(5), None)]), 0, root)
    index.compact(spark, root)
    index.append_changes(frame([("a", "ObjectCreated:Put", t(3), "{}")]), 1, root)
    assert index.current_documents(spark, root).count() == 0


def test_latest_of_a_key_with_very_many_events(spark):
    rows = spark.range(100000).select(
        F.when(F.col("id") % 1000 == 0, F.concat(F.lit("k"), F.col("id").cast("string"))).otherwise("hot").alias("key"), F.lit("ObjectCreated:Put").alias("event"),
        F.timestamp_seconds(F.col("id")).alias("event_time"), F.col("id").cast("string").alias("doc"))
    last = index.latest(rows)
    assert {r.doc for r in last.filter("key = 'hot'").collect()} == {"99999"} and last.count() == 101
    assert plan(last).split("Initial Plan")[0].count("Exchange") == 1


def test_clustered_table_opens_few_files(spark, tmp_path):
    path = f"{tmp_path}/zoned"
    rng = random.Random(4)
    rows = [(rng.uniform(0, 100), rng.uniform(0, 100), 1.0, 2) for _ in range(4000)] + [(1e12, -1e12, 1.0, 2), (None, 1.0, 1.0, 2)]
    cloud(spark, rows).write.parquet(f"{tmp_path}/plain")
    tables.write_clustered(spark.read.parquet(f"{tmp_path}/plain").filter("X < 1e6 OR X IS NULL"), path, partitions=16)
    box = (10, 10, 20, 20)
    part = tables.read_points(spark, path, bbox=box)
    assert len(part.inputFiles()) <= 6 < len(tables.read_points(spark, path).inputFiles())
    assert part.count() == sum(x is not None and 10 <= x <= 20 and 10 <= y <= 20 for x, y, _, _ in rows)
    assert tables.read_points(spark, path, bbox=(500, 500, 600, 600)).count() == 0
    # no clamp: very distant places keep their order
    far = f"{tmp_path}/far"
    tables.write_clustered(cloud(spark, rows), far, partitions=4)
    assert tables.read_points(spark, far, bbox=(9e11, -2e12, 2e12, 0)).count() == 1 and tables.read_points(spark, far).count() == 4002


def test_raster_store_has_a_row_per_block(spark, tmp_path):
    grid = np.arange(40 * 30, dtype=float).reshape(40, 30)
    grid[3, 4] = np.nan
    path = f"{tmp_path}/blocks"
    tables.write_raster(cells_of(spark, grid), header_of(spark, grid), path, block=8)
    assert spark.read.parquet(f"{path}/blocks").count() == 5 * 4
    cells, _ = tables.read_raster(spark, path)
    whole = {(r.row, r.col): r.value for r in cells.filter("value IS NOT NULL").collect()}
    assert whole == {(i, j): grid[i, j] for i in range(40) for j in range(30) if not np.isnan(grid[i, j])}
    window = tables.block_window(cells, (9, 12), (3, 20), block=8)
    assert window.count() == 4 * 18 and "GreaterThanOrEqual(block_row,1)" in plan(window)


def test_products_share_a_grid(spark):
    rng = random.Random(6)
    rows = [(rng.uniform(0, 9), rng.uniform(0, 9), rng.random(), rng.choice([2, 6, 7])) for _ in range(300)]
    pts = cloud(spark, rows).withColumn("Intensity", F.lit(5))
    for mode in ("bin", "radius"):
        both = {(r.row, r.col): r for r in raster.rasterize_products(pts, raster.PRODUCTS, 1.0, mode=mode).collect()}
        for kind in raster.PRODUCTS:
            one = {(r.row, r.col): r.value for r in raster.rasterize(pts, kind, 1.0, mode=mode).collect()}
            assert {k: v for k, r in both.items() if (v := r[kind]) is not None} == pytest.approx(one)


def test_sample_draws_equal_rows_one_by_one(spark):
    pts = cloud(spark, [(1.0, 1.0, 1.0, 2)] * 25000 + [(float(i), 0.0, 0.0, 2) for i in range(5000)])
    some = points.sample_points(pts, 3000, seed=2)
    equal = some.filter("X = 1 AND Y = 1").count()
    assert some.count() == 3000 and 2350 < equal < 2650
    assert sorted(map(tuple, some.collect())) == sorted(map(tuple, points.sample_points(pts.repartition(3), 3000, seed=2).collect()))
    assert points.sample_points(pts, 10**6).count() == 30000


def test_copies_with_and_without_a_collection_are_one_item(spark):
    item = '{"type":"Feature","id":"t1","properties":{}}'
    rows = [("a/t1/t1.json", item), ("a/t1/t1 (conflicted copy).json", item[:-1] + ',"collection":"c"}'), ("a/collection.json", '{"type":"Collection","id":"c"}')]
    docs = spark.createDataFrame(rows, "path string, doc string").withColumn("type", documents.document_type(F.col("doc")))
    found, _, _ = documents.build_index(docs)
    assert [(r.id, r.collection, r.source_key) for r in found.collect()] == [("t1", "c", "a/t1/t1.json")]


def test_lines_are_valid_geometry(spark):
    def kinds(geometry):
        doc = '{"type":"Feature","stac_version":"1.0.0","id":"x","bbox":[0,0,1,1],"geometry":%s,"properties":{"datetime":"2024-01-01"},"links":[],"assets":{}}' % geometry
        docs = spark.createDataFrame([("a/x/x.json", doc)], "path string, doc string").withColumn("type", documents.document_type(F.col("doc")))
        return {r.kind for r in quality.validate_structure(docs).collect()}

    assert kinds('{"type":"LineString","coordinates":[[0,0],[1,1]]}') == set()
    assert kinds('{"type":"MultiLineString","coordinates":[[[0,0],[1,1]],[[2,2],[3,3]]]}') == set()
    assert kinds('{"type":"LineString","coordinates":[[0,0]]}') == {"bad_geometry"}
    assert kinds('{"type":"Blob","coordinates":[]}') == {"bad_geometry"}


def test_located_index_is_pruned(spark, tmp_path):
    rows = [(f"i{k}", "c", None, x, y, x + 0.001, y + 0.001) for k in range(900) for x, y in [(130 + k % 30 * 0.3, 30 + k // 30 * 0.3)]]
    rows += [("wide", "c", None, 100.0, 0.0, 170.0, 60.0), ("none", "c", None, None, None, None, None), ("spot", "c", None, 133.0, 33.0, 133.0, 33.0)]
    frame = spark.createDataFrame(rows, "id string, collection string, datetime timestamp, minx double, miny double, maxx double, maxy double")
    search.write_located(frame, f"{tmp_path}/items", partitions=8)
    located = spark.read.parquet(f"{tmp_path}/items")
    box = (132.95, 32.95, 133.3005, 33.05)
    spark.conf.set("spark.sql.maxMetadataStringLength", "100000")
    hit = located.filter(search.matches(located, bbox=box, keep_unlocated=False))
    plainly = frame.filter(search.matches(frame, bbox=box, keep_unlocated=False))
    ids = lambda df: sorted(r.id for r in df.select("id").collect())
    assert ids(hit) == ids(plainly) and {"wide", "spot"} <= set(ids(hit)) and "home_x" in plan(hit).split("PushedFilters")[1]


def test_batches_of_two_sources(spark, tmp_path):
    change = lambda key: spark.createDataFrame([(key, "ObjectCreated:Put", None, "{}")], index.CHANGES)
    root = f"{tmp_path}/two"
    for source in ("one", "two", "one"):
        index.append_changes(change(source), 0, root, source)
    assert sorted(r.path for r in index.current_documents(spark, root).collect()) == ["one", "two"]
