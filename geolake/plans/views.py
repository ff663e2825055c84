"""Domain views over the given tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import raster

MAP_ORIGIN = (138.6, 35.3)
TERRAIN_RESOLUTION = 2.0


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = F.col
    return table(spark, sf_dir, "lineitem").select(
        (F.lit(51200.0) + ((c("l_orderkey") * 7 + c("l_partkey") * 13) % 2000) * F.lit(0.2) + c("l_discount")).alias("X"),
        (F.lit(-49200.0) + ((c("l_orderkey") * 3 + c("l_suppkey") * 11) % 1500) * F.lit(0.2) + c("l_tax")).alias("Y"),
        (F.lit(544.0) + c("l_extendedprice") / F.lit(500.0)).alias("Z"),
        (c("l_quantity") * 100).cast("int").alias("Intensity"),
        c("l_linenumber").cast("smallint").alias("ReturnNumber"),
        F.lit(7).cast("smallint").alias("NumberOfReturns"),
        F.when(c("l_returnflag") == "A", 2).when(c("l_returnflag") == "N", 6).otherwise(7).cast("smallint").alias("Classification"),
        c("l_shipdate").alias("gps_time"),
        F.concat(F.lit("tile_"), (c("l_orderkey") % 20).cast("string")).alias("source_file"),
        F.lit(6676).alias("epsg"),
    )


POINTS = """v_points AS (
  SELECT CAST(51200 AS DOUBLE) + ((l_orderkey*7 + l_partkey*13) % 2000) * CAST(0.2 AS DOUBLE) + l_discount AS X,
         CAST(-49200 AS DOUBLE) + ((l_orderkey*3 + l_suppkey*11) % 1500) * CAST(0.2 AS DOUBLE) + l_tax AS Y,
         CAST(544 AS DOUBLE) + l_extendedprice / CAST(500 AS DOUBLE) AS Z,
         CAST(l_quantity * 100 AS INTEGER) AS Intensity,
         l_linenumber AS ReturnNumber,
         7 AS NumberOfReturns,
         CASE l_returnflag WHEN 'A' THEN 2 WHEN 'N' THEN 6 ELSE 7 END AS Classification,
         l_shipdate AS gps_time,
         'tile_' || CAST(l_orderkey % 20 AS VARCHAR) AS source_file,
         6676 AS epsg
  FROM lineitem)"""


def header_sql(res: float) -> str:
    """CTE hdr: grid of all points."""
    return f"""hdr AS (
  SELECT minx, miny, CAST(floor((maxx-minx)/{res}::DOUBLE + 0.5) AS BIGINT) + 1 AS width,
         CAST(floor((maxy-miny)/{res}::DOUBLE + 0.5) AS BIGINT) + 1 AS height
  FROM (SELECT min(X) AS minx, min(Y) AS miny, max(X) AS maxx, max(Y) AS maxy FROM v_points))"""


def raster_sql(res: float, aggregate: str, where: str = "TRUE", name: str = "cells") -> str:
    """CTE of one gridded product over hdr."""
    return f"""{name} AS (
  SELECT height - 1 - CAST(floor((Y-miny)/{res}::DOUBLE + 0.5) AS BIGINT) AS "row",
         CAST(floor((X-minx)/{res}::DOUBLE + 0.5) AS BIGINT) AS col, {aggregate} AS value
  FROM v_points, hdr WHERE {where} GROUP BY 1, 2)"""


def cells_sql(res: float = TERRAIN_RESOLUTION) -> str:
    return f"{POINTS}, {header_sql(res)}, {raster_sql(res, 'max(Z)')}"


def grid_sql(res: float = TERRAIN_RESOLUTION) -> str:
    """CTE g: dense cells with their eight neighbours, over cells."""
    return f"""{cells_sql(res)}, dense AS (
  SELECT r.i AS "row", c.i AS col, value, width, height
  FROM hdr, LATERAL (SELECT unnest(range(0, height)) AS i) r, LATERAL (SELECT unnest(range(0, width)) AS i) c
  LEFT JOIN cells ON cells."row" = r.i AND cells.col = c.i), g AS (
  SELECT "row", col, width, height, value,
         lag(value) OVER h AS w, lead(value) OVER h AS e, lag(value) OVER v AS n, lead(value) OVER v AS s
  FROM dense WINDOW h AS (PARTITION BY "row" ORDER BY col), v AS (PARTITION BY col ORDER BY "row"))"""


def cells(spark: SparkSession, sf_dir: str, res: float = TERRAIN_RESOLUTION, kind: str = "dem") -> DataFrame:
    return raster.rasterize(points(spark, sf_dir), kind, res)


def header(spark: SparkSession, sf_dir: str, res: float = TERRAIN_RESOLUTION) -> DataFrame:
    return raster.raster_header(points(spark, sf_dir), res)


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One item per event; event times carry no zone and are read as UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    c = F.col
    located = (c("event_id") % 97) != 0
    west = F.when(located, F.lit(138.6) + (c("user_id") % 40) * F.lit(0.005))
    south = F.when(located, F.lit(35.3) + (c("event_id") % 40) * F.lit(0.005))
    return table(spark, sf_dir, "events").select(
        F.concat(F.lit("item-"), c("event_id").cast("string")).alias("id"),
        c("event_type").alias("collection"),
        F.concat(F.lit("Item "), c("event_id").cast("string")).alias("title"),
        c("ts").cast("timestamp").alias("datetime"),
        west.alias("minx"), south.alias("miny"),
        (west + F.lit(0.004)).alias("maxx"), (south + F.lit(0.003)).alias("maxy"),
        (F.get_json_object("props", "$.k").cast("bigint") * 1000).alias("pc_count"),
        F.when(c("event_id") % 2 == 0, 6676).otherwise(6677).alias("proj_epsg"),
        c("value").alias("score"),
    )


ITEMS = """v_items AS (
  SELECT 'item-' || CAST(event_id AS VARCHAR) AS id, event_type AS collection,
         'Item ' || CAST(event_id AS VARCHAR) AS title, ts AS datetime,
         minx, miny, minx + CAST(0.004 AS DOUBLE) AS maxx, miny + CAST(0.003 AS DOUBLE) AS maxy,
         CAST(json_extract_string(props, '$.k') AS BIGINT) * 1000 AS pc_count,
         CASE WHEN event_id % 2 = 0 THEN 6676 ELSE 6677 END AS proj_epsg, value AS score, event_id
  FROM (SELECT *, CASE WHEN event_id % 97 <> 0 THEN CAST(138.6 AS DOUBLE) + (user_id % 40) * CAST(0.005 AS DOUBLE) END AS minx,
               CASE WHEN event_id % 97 <> 0 THEN CAST(35.3 AS DOUBLE) + (event_id % 40) * CAST(0.005 AS DOUBLE) END AS miny
        FROM events))"""


def meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Processing metadata: one row per order, failures included."""
    c = F.col
    code = F.when(c("o_orderstatus") == "O", 6676).otherwise(6677)
    x = F.lit(10000.0) + (c("o_orderkey") % 100) * F.lit(400.0)
    y = F.lit(-50000.0) + (c("o_custkey") % 100) * F.lit(300.0)
    points_ = c("o_totalprice").cast("bigint")
    return table(spark, sf_dir, "orders").select(
        F.concat(F.lit("t"), c("o_orderkey").cast("string"), F.lit(".las")).alias("source_file"),
        F.concat(F.lit("t"), c("o_orderkey").cast("string"), F.lit(".copc.laz")).alias("output_file"),
        points_.alias("point_count"),
        (points_ * 9).alias("file_size_bytes"),
        F.when(c("o_orderstatus") == "F", F.lit("failed")).alias("error"),
        F.when(c("o_orderstatus") != "P", code).alias("epsg"),
        F.concat(F.lit("EPSG:"), code.cast("string")).alias("source_crs"),
        F.concat(
            F.lit('PROJCRS["zone",BASEGEOGCRS["JGD2011",ID["EPSG",6668]],ID["EPSG",'), code.cast("string"), F.lit("]]"),
        ).alias("crs"),
        F.array(x, y, F.lit(0.0), x + F.lit(399.0), y + F.lit(299.0), c("o_totalprice") / 1000).alias("bbox"),
        F.element_at(F.array(*(F.lit(k) for k in ("dem", "dsm", "dtm", "intensity", "density"))), (c("o_custkey") % 5 + 1).cast("int")).alias("dem_type"),
        F.element_at(F.array(F.lit(0.5), F.lit(1.0), F.lit(2.0)), (c("o_custkey") % 3 + 1).cast("int")).alias("resolution"),
        ((c("o_custkey") % 1000) / F.lit(10.0)).alias("processing_time_seconds"),
    )


META = """v_meta AS (
  SELECT 't' || CAST(o_orderkey AS VARCHAR) || '.las' AS source_file,
         't' || CAST(o_orderkey AS VARCHAR) || '.copc.laz' AS output_file, o_orderkey, o_custkey,
         CAST(trunc(o_totalprice) AS BIGINT) AS point_count, CAST(trunc(o_totalprice) AS BIGINT) * 9 AS file_size_bytes,
         CASE WHEN o_orderstatus = 'F' THEN 'failed' END AS error,
         CASE WHEN o_orderstatus = 'O' THEN 6676 WHEN o_orderstatus = 'F' THEN 6677 END AS epsg,
         CASE WHEN o_orderstatus = 'O' THEN 6676 ELSE 6677 END AS code,
         CAST(10000 AS DOUBLE) + (o_orderkey % 100) * CAST(400 AS DOUBLE) AS x0,
         CAST(-50000 AS DOUBLE) + (o_custkey % 100) * CAST(300 AS DOUBLE) AS y0,
         CAST(10000 AS DOUBLE) + (o_orderkey % 100) * CAST(400 AS DOUBLE) + CAST(399 AS DOUBLE) AS x1,
         CAST(-50000 AS DOUBLE) + (o_custkey % 100) * CAST(300 AS DOUBLE) + CAST(299 AS DOUBLE) AS y1,
         o_totalprice / 1000 AS z1,
         ['dem','dsm','dtm','intensity','density'][CAST(o_custkey % 5 + 1 AS INTEGER)] AS dem_type,
         [CAST(0.5 AS DOUBLE), CAST(1 AS DOUBLE), CAST(2 AS DOUBLE)][CAST(o_custkey % 3 + 1 AS INTEGER)] AS resolution,
         (o_custkey % 1000) / CAST(10 AS DOUBLE) AS processing_time_seconds
  FROM orders)"""
