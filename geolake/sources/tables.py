"""Point and raster tables on storage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import morton
from ..operators.points import crop
from . import files

BLOCK = 512
COMPRESSIONS = ("zstd", "snappy", "gzip", "lz4", "none")
#: Folder of a clustered table's zone map; Spark's readers pass over names that begin like this.
ZONES = "_zones"


def read_points(
    spark: SparkSession, path: str, override_epsg: int | None = None,
    bbox: Sequence[float] | None = None, schema: str = schemas.POINTS,
) -> DataFrame:
    """Point table; ``override_epsg`` fills in a missing CRS, ``bbox`` reads only that region.

    A clustered table (``write_clustered``) has a zone map, which names the files that can hold points of the box, and no other is
    opened or even listed. In these, and in a table without one, the box is a pair of comparisons on X and Y, which Parquet
    checks against the range of every row group.
    """
    paths = [path]
    if bbox is not None and files.exists(spark, f"{path}/{ZONES}"):
        west, south, east, north = bbox
        zones = spark.read.parquet(f"{path}/{ZONES}")
        met = zones.filter((F.col("minx") <= east) & (F.col("maxx") >= west) & (F.col("miny") <= north) & (F.col("maxy") >= south))
        paths = [f"{path}/{r.file}" for r in met.select("file").collect()]
    points = spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)
    if bbox is not None:
        points = crop(points, bbox)
    if override_epsg is not None:
        points = points.withColumn("epsg", F.coalesce("epsg", F.lit(override_epsg)))
    return points


def write_points(points: DataFrame, path: str, epsg: int | None = None) -> None:
    """Point table with its CRS tag."""
    tagged = points if epsg is None else points.withColumn("epsg", F.lit(epsg))
    tagged.write.mode("overwrite").parquet(path)


def write_clustered(points: DataFrame, path: str, partitions: int | None = None) -> None:
    """Point table in spatial order, and its zone map: the box and number of points of each file.

    Rows are range partitioned and sorted along a Z curve through the box of all points, which tells places apart as far as
    doubles do. X, Y and Z follow, so one crowded place can span partitions. Points without a place come first.
    """
    spark = points.sparkSession
    box = points.filter("abs(X) < double('infinity') AND abs(Y) < double('infinity')").agg(F.min("X"), F.min("Y"), F.max("X"), F.max("Y")).first()
    low_x, low_y, high_x, high_y = (v or 0.0 for v in box)
    high, low = morton.halves(F.col("X"), F.col("Y"), (low_x, low_y), max(high_x - low_x, high_y - low_y))
    keyed = points.withColumns({"_h": high, "_l": low})
    keys = [F.col(c) for c in ("_h", "_l", "X", "Y", "Z")]
    spread = keyed.repartitionByRange(partitions, *keys) if partitions else keyed.repartitionByRange(*keys)
    spread.sortWithinPartitions(*keys).drop("_h", "_l").write.mode("overwrite").parquet(path)
    zones = spark.read.schema("X double, Y double").parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        *(fold(c).alias(f"{n}{c.lower()}") for c in ("X", "Y") for n, fold in (("min", F.min), ("max", F.max))), F.count("*").alias("points"))
    zones.write.mode("overwrite").parquet(f"{path}/{ZONES}")


def write_raster(cells: DataFrame, header: DataFrame, path: str, compression: str = "zstd", block: int = BLOCK) -> None:
    """Cells in square blocks, a row each, and the headers beside them.

    A block holds the places of its cells, row by row, and their values. Blocks are ordered along a Z curve, so files follow the size of
    the raster and a file covers a compact part of it.
    """
    if compression not in COMPRESSIONS:
        raise ValueError(f"compression must be one of {COMPRESSIONS}")
    at = F.pmod("row", F.lit(block)) * block + F.pmod("col", F.lit(block))
    blocked = cells.groupBy(
        "raster_id", F.floor(F.col("row") / block).cast("int").alias("block_row"), F.floor(F.col("col") / block).cast("int").alias("block_col")
    ).agg(F.sort_array(F.collect_list(F.struct(at.cast("int").alias("at"), F.col("value").cast("double").alias("value")))).alias("_v"))
    rows = blocked.select(
        "raster_id", "block_row", "block_col", F.lit(block).alias("block"), F.col("_v.at").alias("places"), F.col("_v.value").alias("values"))
    order = ["raster_id", "_z"]
    near = rows.withColumn("_z", morton.interleave(F.col("block_row"), F.col("block_col")))
    near.repartitionByRange(*order).sortWithinPartitions(*order).drop("_z").write.mode("overwrite").option("compression", compression).parquet(f"{path}/blocks")
    header.write.mode("overwrite").parquet(f"{path}/header")


def read_raster(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Cells and headers. Block columns stay, so a window filter on them skips the blocks outside."""
    schema = "raster_id string, block_row int, block_col int, block int, places array<int>, values array<double>"
    blocks = spark.read.schema(schema).parquet(f"{path}/blocks")
    cells = blocks.select("raster_id", "block_row", "block_col", "block", F.inline(F.arrays_zip("places", "values"))).select(
        (F.col("block_row") * F.col("block") + F.floor(F.col("places") / F.col("block"))).cast("int").alias("row"),
        (F.col("block_col") * F.col("block") + F.col("places") % F.col("block")).cast("int").alias("col"),
        F.col("values").alias("value"), "raster_id", "block_row", "block_col")
    return cells, spark.read.parquet(f"{path}/header")


def block_window(cells: DataFrame, rows: tuple[int, int], cols: tuple[int, int], block: int = BLOCK) -> DataFrame:
    """Cells of a row and column range, reading only the blocks it touches."""
    return cells.filter(
        F.col("block_row").between(rows[0] // block, rows[1] // block)
        & F.col("block_col").between(cols[0] // block, cols[1] // block)
        & F.col("row").between(*rows) & F.col("col").between(*cols)
    )
