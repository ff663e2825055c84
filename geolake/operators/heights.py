"""Heights above ground and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import points as pts
from .spatial_join import exact_quantile, interp_join, nearest_join

# Height bins (metres), ground percentile, tall limit, class codes.
HEIGHT_BINS = (0, 2, 5, 10, 20, 50, 100)
GROUND_PERCENTILE = 0.05
TALL = 10.0
GROUND, BUILDING = 2, 6


def relative_height(points: DataFrame, p: float = GROUND_PERCENTILE) -> DataFrame:
    """Z above the exact p-quantile of all Z, the approximate ground."""
    ground = exact_quantile(points, "Z", p).scalar()
    return points.withColumn("ground", ground).withColumn("height", F.col("Z") - F.col("ground"))


def height_histogram(heights: DataFrame, bins: Sequence[float] = HEIGHT_BINS) -> DataFrame:
    """Points per half-open bin and their share of all points; every bin is present."""
    h = F.col("height")
    records = [
        F.struct(
            F.lit(float(low)).alias("low"), F.lit(float(high)).alias("high"),
            F.count_if((h >= low) & (h < high)).alias("points"),
        )
        for low, high in zip(bins, bins[1:])
    ]
    totals = heights.agg(F.array(*records).alias("_r"), F.count("*").alias("_all"))
    return totals.select("_all", F.inline("_r")).select(
        "low", "high", "points", F.try_divide(F.col("points") * 100.0, F.col("_all")).alias("percent")
    )


def elevated(heights: DataFrame, limit: float = TALL) -> DataFrame:
    return heights.agg(
        F.count_if(F.col("height") > limit).alias("elevated"),
        F.count("*").alias("points"),
        F.try_divide(F.count_if(F.col("height") > limit) * 100.0, F.count("*")).alias("percent"),
        F.max("height").alias("max_height"),
    )


def building_heights(points: DataFrame) -> DataFrame:
    """Height of every building point over its nearest ground point."""
    ground = points.filter(F.col("Classification") == GROUND).select("X", "Y", "Z")
    building = points.filter(F.col("Classification") == BUILDING)
    near = nearest_join(building, ground, ["Z"])
    return near.withColumn("height", F.col("Z") - F.col("Z_near"))


def building_height_summary(heights: DataFrame, limit: float = TALL) -> DataFrame:
    return heights.agg(
        F.count("*").alias("points"),
        F.min("height").alias("min_height"),
        F.max("height").alias("max_height"),
        F.avg("height").alias("mean_height"),
        F.count_if(F.col("height") > limit).alias("tall"),
    )


def cross_section(
    points: DataFrame, start: Sequence[float], end: Sequence[float], buffer: float = 2.0, step: float = 10.0,
    limits: str = "Classification[2:2]",
) -> DataFrame:
    """Elevation every ``step`` metres along X of a strip of ground points."""
    low, high = min(start[0], end[0]), max(start[0], end[0])
    strip = pts.filter_range(pts.crop(points, (low, start[1] - buffer, high, start[1] + buffer)), limits)
    spark = points.sparkSession
    count = max(0, -int(-(high - low) // step))
    samples = spark.range(count).select((F.lit(float(low)) + F.col("id") * float(step)).alias("x"))
    series = strip.select(F.col("X").alias("x"), F.col("Z").alias("y"))
    line = interp_join(samples, series, [], width=step)
    return line.select((F.col("x") - float(low)).alias("distance"), "x", F.col("y").alias("z"))
