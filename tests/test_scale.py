"""Plans and layouts that have to hold on large tables."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from geolake.functions import geom
from geolake.operators import area_totals, quality, render, spatial_join
from geolake.plans import catalog
from geolake.sources import documents
from geolake.streaming import index as live


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_areas_are_not_gathered_in_the_driver(spark, tmp_path):
    points = spark.createDataFrame([(1.0, 1.0), (5.0, 5.0), (None, 1.0)], "X double, Y double")
    areas = spark.createDataFrame([(1, 0.0, 0.0, 2.0, 2.0), (2, 0.0, 0.0, 40.0, 40.0)], "area_id long, minx double, miny double, maxx double, maxy double")
    areas.write.parquet(f"{tmp_path}/areas")  # of known, small size
    found = spatial_join.points_in_areas(points, spark.read.parquet(f"{tmp_path}/areas"))
    assert "Broadcast" not in plan(found)
    assert sorted((r.area_id, r.X) for r in found.collect()) == [(1, 1.0), (2, 1.0), (2, 5.0)]


def test_pairs_of_points_and_areas_are_counted_without_a_row_each(spark, tmp_path):
    sold = [(k, k % 7, k % 5, k % 4 + 1, float(k % 50), 1000.0 + k, 0.01 * (k % 11), 0.01 * (k % 9), "ANR"[k % 3], None) for k in range(300)] + [
        (None, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", None), (3, 1, 1, 1, 1.0, None, 0.0, 0.0, "A", None), (4, 1, 1, 1, 1.0, 2e6, 0.0, None, "A", None)]
    lines = spark.createDataFrame(sold, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, "
                                        "l_discount double, l_tax double, l_returnflag string, l_shipdate timestamp")
    parts = [(k, 1 + k % 50) for k in range(400)] + [(7, 50), (8, None), (None, 3)]
    lines.write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame(parts, "p_partkey long, p_size int").write.parquet(f"{tmp_path}/part.parquet")
    found = catalog.QUERIES["points_in_areas"](spark, str(tmp_path))
    assert "Join" not in plan(found)
    cloud = [(51200.0 + (o * 7 + p * 13) % 2000 * 0.2 + d, -49200.0 + (o * 3 + s * 11) % 1500 * 0.2 + t, e and 544.0 + e / 500.0)
             for o, p, s, _, _, e, d, t, *_ in sold if o is not None and t is not None]
    want = {}
    for key, size in parts:
        if key is not None and size is not None:
            x0, y0 = 51200.0 + key * 37 % 380, -49200.0 + key * 53 % 280
            want.setdefault(key, []).extend(z for x, y, z in cloud if x0 <= x <= x0 + size and y0 <= y <= y0 + size / 2)
    want = {k: (len(v), max((round(z, 6) for z in v if z is not None), default=None)) for k, v in want.items() if v}
    assert {r.area_id: (r.points, r.max_z) for r in found.collect()} == want


@pytest.mark.parametrize("tile, grid, asked, fold", [(8, 16, 7, 20), (30, 2, 1000, 10), (3, 64, 1, 1000), (10**6, 8, 50, 50)])
def test_counted_pairs_are_all_pairs(spark, monkeypatch, tile, grid, asked, fold):
    for name, value in (("TILE", tile), ("GRID", grid), ("ASKED", asked), ("FOLD", fold), ("SOUGHT", 5), ("TASKS", 3)):
        monkeypatch.setattr(area_totals, name, value)
    rng = random.Random(tile)
    nan, inf = math.nan, math.inf
    z = lambda: rng.choice([None, nan, inf, -inf, -0.5, 3.5, rng.uniform(-9, 9), rng.uniform(-9, 9), rng.uniform(-9, 9)])
    points = [(rng.uniform(-50, 50), rng.uniform(-50, 50), z()) for _ in range(150)] + [(rng.gauss(20, 0.01), float(rng.randint(0, 3)), z()) for _ in range(60)]
    points += [(0.0, 0.0, z()) for _ in range(70)] + [(float(i), float(i), None) for i in range(20)]
    points += [(None, 1.0, 99.0), (1.0, None, 99.0), (nan, 0.0, 7.0), (nan, 0.0, 8.0), (inf, 1.0, 1.0), (0.0, -inf, 2.0)]
    areas = [(i % 70, x, y, x + s, y + s / 2) for i in range(80) for x, y, s in [(rng.uniform(-60, 50), rng.uniform(-60, 50), rng.choice([0.0, 1.0, 9.0, 70.0]))]]
    areas += [(100, -1e3, -1e3, 1e3, 1e3), (100, -inf, -inf, nan, nan), (101, -inf, -inf, inf, inf), (102, 0.0, 0.0, 0.0, 0.0), (None, -5.0, -5.0, 30.0, 5.0), (None, 19.9, 0.0, 20.1, 2.0),
              (103, 9.0, 0.0, -9.0, 9.0), (104, None, 0.0, 9.0, 9.0), (105, 0.0, 0.0, 9.0, None), (106, 19.0, 0.5, 21.0, 0.6), (107, points[0][0], points[0][1], nan, points[0][1])]
    found = spatial_join.points_in_areas(
        spark.createDataFrame(points, "X double, Y double, Z double"), spark.createDataFrame(areas, "area_id int, minx double, miny double, maxx double, maxy double"), highest="Z")
    got = found.groupBy("area_id").agg(F.sum("points").alias("n"), F.max("Z").alias("top")).collect()

    def upto(a, b):
        """a <= b where NaN stands above all, as in Spark."""
        return math.isnan(b) or a <= b

    want = {}
    for area, *box in areas:
        if None not in box:
            want.setdefault(area, []).extend(v for x, y, v in points if None not in (x, y) and upto(box[0], x) and upto(x, box[2]) and upto(box[1], y) and upto(y, box[3]))
    highest = lambda v: nan if any(map(math.isnan, v)) else max(v, default=None)
    assert {r.area_id: (r.n, str(r.top)) for r in got} == {k: (len(v), str(highest([z for z in v if z is not None]))) for k, v in want.items() if v}


def tasks(spark, work):
    """Tasks of the jobs that ``work`` runs."""
    spark.sparkContext.setJobGroup("counted", "counted")
    try:
        done = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("counted") for s in tracker.getJobInfo(j).stageIds}
    return done, [i.numTasks for i in map(tracker.getStageInfo, stages) if i]


def test_files_are_written_by_many_tasks_and_listed_by_few(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(render, "FILES", 50)
    items = spark.range(300).selectExpr("'c' AS collection", "concat('i', id) AS id", "concat('{\"type\":\"Feature\",\"id\":\"i', id, '\"}') AS json").coalesce(1)
    root = f"{tmp_path}/tree"
    _, wrote = tasks(spark, lambda: render.write_documents(items, root))
    assert max(wrote) == 7
    before = spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")
    read, listed = tasks(spark, lambda: documents.read_documents(spark, root, glob="*.txt"))
    assert 1 < max(listed) <= 4 * spark.sparkContext.defaultParallelism < 300
    assert spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism") == before
    assert read.count() == read.select("path").distinct().count() == read.filter("type = 'Feature'").count() == 300


DOC = '{"type":"Feature","id":"a","collection":"c","properties":{"pc:count":1,"pc:type":"lidar"}}'


def stored_docs(spark, path):
    spark.createDataFrame([("c/a/a.json", DOC)], "path string, doc string").write.parquet(path)
    return spark.read.parquet(path).withColumn("type", documents.document_type(F.col("doc")))


def test_a_geometry_is_read_once(spark):
    text = spark.createDataFrame([('{"type":"Point","coordinates":[1,2]}',)], "t string")
    read = text.select(geom.from_geojson(F.col("t")).alias("g"))
    logical = read._jdf.queryExecution().analyzed().toString()
    assert logical.count("from_json(") == 3  # one for each kind
    assert read.first().g.polygons == [[[[1.0, 2.0]]]]


def test_an_index_is_built_from_documents_typed_once(spark, tmp_path):
    docs = stored_docs(spark, f"{tmp_path}/raw")
    items, collections, catalogs = documents.build_index(docs)
    for made in (items, collections, catalogs):
        assert f"{tmp_path}/raw" not in " ".join(made.inputFiles())
    assert [(r.id, r.collection) for r in items.collect()] == [("a", "c")]


def test_a_report_goes_through_its_issues_once(spark, tmp_path):
    report = quality.validation_report(quality.validate_pointcloud(stored_docs(spark, f"{tmp_path}/raw")), ("pointcloud",))
    assert f"{tmp_path}/raw" not in " ".join(report.inputFiles())
    assert {(r.check, r.errors, r.warnings) for r in report.collect()} == {("pointcloud", 0, 5), ("overall", 0, 5)}


def test_places_choose_their_leaves_without_a_shuffle_of_all_choices(spark):
    rng = np.random.default_rng(5)
    left, right = (spark.createDataFrame(rng.random((n, 3)).tolist(), "X double, Y double, Z double") for n in (60, 80))
    near = spatial_join.nearest_join(left, right, ["Z"], most=2)
    assert "windowspecdefinition(lax" not in plan(near)
    grounds = [(r.X, r.Y, r.Z) for r in right.collect()]
    for r in near.collect():
        assert r.Z_near == min(((r.X - x) ** 2 + (r.Y - y) ** 2, z) for x, y, z in grounds)[1]


def test_a_stream_lists_by_few_tasks(spark, tmp_path):
    items = spark.range(100).selectExpr("'c' AS collection", "concat('i', id) AS id", "'{}' AS json")
    render.write_documents(items, f"{tmp_path}/tree")
    seen = live.stream_documents(spark, f"{tmp_path}/tree", glob="*.txt", ending=".txt")
    assert int(spark.conf.get("spark.sql.sources.parallelPartitionDiscovery.parallelism")) == 4 * spark.sparkContext.defaultParallelism
    live.upsert_index(seen, f"{tmp_path}/index", f"{tmp_path}/check").awaitTermination()
    assert live.current_changes(spark, f"{tmp_path}/index").count() == 100
