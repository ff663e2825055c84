"""Plans for keeping two stores in step."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Portal naming and field values.
PACKAGE_PREFIX, RESOURCE_PREFIX = "stac-", "copc-"
FORMAT, MIME = "COPC", "application/vnd.laszip+copc"
LICENSE_DEFAULT = "notspecified"


def inventory_diff(local: DataFrame, remote: DataFrame) -> DataFrame:
    """key -> 'new', 'changed' or 'deleted'; unchanged keys are left out."""
    l = local.select("key", F.struct("size", "modified").alias("l"))
    r = remote.select("key", F.struct("size", "modified").alias("r"))
    both = l.join(r, "key", "full_outer")
    changed = (F.col("l.size") != F.col("r.size")) | (F.col("l.modified") > F.col("r.modified"))
    action = F.when(F.col("r").isNull(), "new").when(F.col("l").isNull(), "deleted").when(changed, "changed")
    return both.select("key", action.alias("action")).filter(F.col("action").isNotNull())


def sync_plan(target: DataFrame, source: DataFrame, key: str = "name") -> DataFrame:
    """Source rows with 'create' or 'update', and the target's own id for updates."""
    known = target.groupBy(key).agg(F.min("id").alias("target_id"))
    return source.join(known, key, "left").withColumn(
        "action", F.when(F.col("target_id").isNull(), "create").otherwise("update")
    )


def to_portal_packages(collections: DataFrame) -> DataFrame:
    """Collections -> portal data sets."""
    return collections.select(
        F.concat(F.lit(PACKAGE_PREFIX), F.col("id")).alias("name"),
        F.coalesce("title", "id").alias("title"),
        F.coalesce("description", F.lit("")).alias("notes"),
        F.coalesce("license", F.lit(LICENSE_DEFAULT)).alias("license_id"),
    )


def to_portal_resources(items: DataFrame) -> DataFrame:
    """Items with a data asset -> portal resources."""
    data = F.try_element_at("assets", F.lit("data"))
    return items.filter(data.isNotNull()).select(
        F.concat(F.lit(PACKAGE_PREFIX), F.col("collection")).alias("package_name"),
        F.concat(F.lit(RESOURCE_PREFIX), F.col("id")).alias("name"),
        F.coalesce("description", F.concat(F.lit("COPC data for "), F.col("id"))).alias("description"),
        data["href"].alias("url"), F.lit(FORMAT).alias("format"), F.lit(MIME).alias("mimetype"),
        F.coalesce("pc_count", F.lit(0)).alias("pc_count"),
        F.coalesce("pc_type", F.lit("")).alias("pc_type"),
        F.coalesce(F.col("proj_epsg").cast("string"), F.lit("")).alias("proj_epsg"),
    )
