"""Catalog documents: scan, split, flatten, index tables."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas
from ..functions import geom, text
from ..session import written
from . import files

# Document kinds, index defaults, key rules.
KINDS = ("Catalog", "Collection", "Feature")
DEFAULT_VERSION = "1.0.0"
DEFAULT_LICENSE = "proprietary"
CATALOG_DEFAULTS = {
    "catalog_id": "stac-catalog",
    "catalog_title": "STAC Catalog",
    "catalog_description": "",
    "stac_version": "1.1.0",
    "index_version": "1.0.0",
}
SKIPPED_PREFIXES = ("index/", "data/")
SKIPPED_SUFFIXES = ("-en.json",)
CONFLICT_MARK = "conflicted copy"


def document_type(doc: Column) -> Column:
    """``type`` of a whole, well-formed JSON object; NULL for anything else."""
    return F.when(F.try_parse_json(doc).isNotNull(), F.get_json_object(doc, "$.type"))


def relative_key(path: Column, root: str) -> Column:
    bare = re.sub(r"^[a-z0-9]+:/+", "/", root).rstrip("/")
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    return F.regexp_replace(decoded, f"^.*?{re.escape(bare)}/", "")


def scan_schema(raw: DataFrame, root: str) -> DataFrame:
    """path, doc, type of whole-text rows (batch or stream)."""
    return raw.select(
        relative_key(F.col("_metadata.file_path"), root).alias("path"),
        F.col("value").alias("doc"),
        document_type(F.col("value")).alias("type"),
    )


def whole_texts(spark: SparkSession, root: str, glob: str) -> DataFrame:
    """The files below a folder, a row each."""
    with files.few_listings(spark):
        return spark.read.format("text").option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(root)


def read_documents(spark: SparkSession, root: str, glob: str = "*.json") -> DataFrame:
    """Every document below a folder, one row each; unreadable ones have a NULL type."""
    return scan_schema(whole_texts(spark, root, glob), root)


def rejects(docs: DataFrame) -> DataFrame:
    return docs.filter(F.col("type").isNull() | ~F.col("type").isin(*KINDS))


def read_bundles(spark: SparkSession, root: str) -> DataFrame:
    """path, doc, type of the documents that ``render.write_bundles`` wrote; a filter on ``collection`` reads its files alone."""
    lines = spark.read.schema("path string, doc string, collection string").json(root)
    return lines.withColumn("type", document_type(F.col("doc")))


def list_objects(
    listing: DataFrame, key: str = "path", prefixes=SKIPPED_PREFIXES, suffixes=SKIPPED_SUFFIXES, ending: str = ".json"
) -> DataFrame:
    """Keep indexable keys, before anything is parsed."""
    keep = F.col(key).endswith(ending)
    for prefix in prefixes:
        keep = keep & ~F.col(key).startswith(prefix)
    for suffix in suffixes:
        keep = keep & ~F.col(key).endswith(suffix)
    return listing.filter(keep)


def drop_translations(docs: DataFrame, key: str = "path") -> DataFrame:
    return docs.filter(~F.col(key).endswith(SKIPPED_SUFFIXES[0]))


def split_documents(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Catalogs, collections, features."""
    return tuple(docs.filter(F.col("type") == kind) for kind in KINDS)


def parse_time(value: Column) -> Column:
    """ISO text -> timestamp in UTC; NULL when it is not a time."""
    zoned = value.rlike(r"(Z|[+-]\d\d:?\d\d)$") & value.contains("T")
    whole = F.when(zoned, value).when(
        value.rlike(r"^\d{4}-\d\d-\d\d$"), F.concat(value, F.lit("T00:00:00Z"))
    ).otherwise(F.concat(value, F.lit("Z")))
    return F.try_to_timestamp(whole)


def flatten_items(docs: DataFrame) -> DataFrame:
    """Feature documents -> index rows. Geometry from ``geometry``, else from ``bbox``."""
    parsed = docs.filter(F.col("type") == "Feature").withColumn("d", F.from_json("doc", schemas.ITEM))
    p = F.col("d.properties")
    box = F.from_json("d.bbox", "array<double>")
    flat = parsed.select(
        "d", "doc", "path", F.when(F.size(box).isin(4, 6), box).alias("bbox"),
        geom.from_geojson(F.col("d.geometry")).alias("g"),
    )
    b, six = F.col("bbox"), F.size("bbox") == 6
    given = [
        F.try_element_at(b, F.lit(1)), F.try_element_at(b, F.lit(2)),
        F.try_element_at(b, F.when(six, 4).otherwise(3)), F.try_element_at(b, F.when(six, 5).otherwise(4)),
    ]
    shaped = flat.withColumn("g", F.coalesce("g", geom.bbox_polygon(*given))).withColumn("_e", geom.bounds(F.col("g")))
    bounds = [F.coalesce(F.try_element_at("_e", F.lit(i + 1)), given[i]) for i in range(4)]
    p = F.col("d.properties")
    return shaped.select(
        F.col("d.id").alias("id"),
        F.col("d.collection").alias("collection"),
        F.coalesce(p["title"], F.col("d.id")).alias("title"),
        F.coalesce("d.stac_version", F.lit(DEFAULT_VERSION)).alias("stac_version"),
        parse_time(p["datetime"]).alias("datetime"),
        "bbox",
        *(v.alias(n) for v, n in zip(bounds, ("minx", "miny", "maxx", "maxy"))),
        geom.to_wkt(F.col("g")).alias("geometry_wkt"),
        p["pc:count"].try_cast("bigint").alias("pc_count"),
        p["pc:type"].alias("pc_type"),
        p["pc:encoding"].alias("pc_encoding"),
        p["proj:epsg"].try_cast("int").alias("proj_epsg"),
        F.from_json(p["proj:bbox"], "array<double>").alias("proj_bbox"),
        F.from_json("d.stac_extensions", "array<string>").alias("stac_extensions"),
        F.from_json("d.assets", schemas.ASSETS).alias("assets"),
        F.from_json("d.links", schemas.LINKS).alias("links"),
        F.col("doc").alias("item_json"),
        F.col("path").alias("source_key"),
    )


def flatten_collections(docs: DataFrame) -> DataFrame:
    """Collection documents -> index rows; the first box and the first interval count."""
    parsed = docs.filter(F.col("type") == "Collection").withColumn("d", F.from_json("doc", schemas.COLLECTION))
    box = F.try_element_at(F.from_json("d.extent.spatial.bbox", "array<array<double>>"), F.lit(1))
    interval = F.try_element_at(F.from_json("d.extent.temporal.interval", "array<array<string>>"), F.lit(1))
    parsed = parsed.withColumns({"bbox": F.when(F.size(box) >= 4, box), "_t": interval})
    b, six = F.col("bbox"), F.size("bbox") == 6
    ring = geom.bbox_polygon(
        F.try_element_at(b, F.lit(1)), F.try_element_at(b, F.lit(2)),
        F.try_element_at(b, F.when(six, 4).otherwise(3)), F.try_element_at(b, F.when(six, 5).otherwise(4)),
    )
    return parsed.select(
        F.col("d.id").alias("id"),
        F.coalesce("d.stac_version", F.lit(DEFAULT_VERSION)).alias("stac_version"),
        F.coalesce("d.title", "d.id").alias("title"),
        F.coalesce("d.description", F.lit("")).alias("description"),
        F.coalesce("d.license", F.lit(DEFAULT_LICENSE)).alias("license"),
        "bbox",
        geom.to_wkt(ring).alias("geometry_wkt"),
        F.try_element_at("_t", F.lit(1)).alias("start_datetime"),
        F.try_element_at("_t", F.lit(2)).alias("end_datetime"),
        F.from_json("d.stac_extensions", "array<string>").alias("stac_extensions"),
        F.col("d.summaries").alias("summaries"),
        F.col("d.providers").alias("providers"),
        F.col("d.links").alias("links"),
        F.col("doc").alias("collection_json"),
        F.col("path").alias("source_key"),
    )


def infer_collection(items: DataFrame, collections: DataFrame) -> DataFrame:
    """Items without a collection take that of ``../../collection.json``, if there is one."""
    folder = F.concat(text.parent(text.parent(F.col("source_key"))), F.lit("/collection.json"))
    known = collections.select(
        F.concat(F.lit("/"), F.col("source_key")).alias("_key"), F.col("id").alias("_found")
    )
    # only rows that need it go through the join
    lacking = items.filter(F.col("collection").isNull()).withColumn(
        "_key", F.when(F.startswith(folder, F.lit("/")), folder).otherwise(F.concat(F.lit("/"), folder))
    )
    found = lacking.join(known, "_key", "left").withColumn("collection", F.col("_found"))
    return items.filter(F.col("collection").isNotNull()).unionByName(found.select(*items.columns))


def keep_one(docs: DataFrame, collections: DataFrame | None = None) -> DataFrame:
    """One document per (type, collection, id): originals before conflict copies, then by path.

    An item that names no collection goes by the one that ``infer_collection`` would find for it among ``collections``, so a copy that
    names it and one that leaves it out are one item; without one it goes by its folder's parent. Documents without an id are
    all kept.

    The winner is a partially aggregated minimum of short keys; the documents themselves are
    only touched by the semi join, so many copies of one document do not meet in one task.
    """
    d = F.from_json("doc", "id string, collection string")
    folder = F.when(F.col("type") == "Feature", F.concat(F.lit("/"), text.parent(text.parent(F.col("path")))))
    rank = F.struct(F.col("path").contains(CONFLICT_MARK).alias("copy"), F.length("path").alias("n"), F.col("path").alias("path"))
    keyed = docs.select("type", d["id"].alias("_id"), d["collection"].alias("_named"), folder.alias("_folder"), rank.alias("_rank"))
    if collections is not None:
        key = F.when(F.col("_named").isNull(), F.regexp_replace(F.concat("_folder", F.lit("/collection.json")), "^/+", "/"))
        known = collections.select(F.regexp_replace(F.concat(F.lit("/"), "source_key"), "^/+", "/").alias("_key"), F.col("id").alias("_found"))
        keyed = keyed.withColumn("_key", key).join(known, "_key", "left").withColumn("_named", F.coalesce("_named", "_found"))
    unnamed = F.when(F.col("_id").isNull(), F.col("_rank.path"))
    best = keyed.groupBy("type", F.coalesce("_named", "_folder"), "_id", unnamed).agg(F.min("_rank").alias("_b"))
    return docs.join(best.select(F.col("_b.path").alias("path")), "path", "left_semi")


def catalog_metadata(catalogs: DataFrame, items: DataFrame, collections: DataFrame, now: str) -> DataFrame:
    """One row: root catalog fields (with defaults), counts and index time.

    The root is the catalog document with the shortest path.
    """
    fields = F.from_json("doc", "id string, title string, description string, stac_version string")
    root = catalogs.agg(F.min_by(fields, F.struct(F.length("path"), F.col("path"))).alias("r"))
    counts = {
        "items_count": items.agg(F.count("*").alias("n")).scalar(),
        "collections_count": collections.agg(F.count("*").alias("n")).scalar(),
    }
    d = CATALOG_DEFAULTS
    return root.select(
        F.coalesce("r.id", F.lit(d["catalog_id"])).alias("catalog_id"),
        F.coalesce("r.title", F.lit(d["catalog_title"])).alias("catalog_title"),
        F.coalesce("r.description", F.lit(d["catalog_description"])).alias("catalog_description"),
        F.coalesce("r.stac_version", F.lit(d["stac_version"])).alias("stac_version"),
        F.lit(now).alias("indexed_at"),
        *(v.alias(k) for k, v in counts.items()),
        F.lit(d["index_version"]).alias("index_version"),
    )


# --- index tables -----------------------------------------------------------------------


def write_items(items: DataFrame, path: str) -> None:
    """Sorted datetime DESC (nulls last), then id: range partitioned, so readers can prune."""
    items.orderBy(F.desc_nulls_last("datetime"), F.asc("id")).write.mode("overwrite").parquet(path)


def write_collections(collections: DataFrame, path: str) -> None:
    collections.write.mode("overwrite").parquet(path)


def write_catalog_metadata(metadata: DataFrame, path: str) -> None:
    metadata.write.mode("overwrite").json(path)


def read_index(spark: SparkSession, path: str, schema: str = schemas.ITEMS) -> DataFrame:
    """Index table with a fixed schema; an empty one when nothing was written yet."""
    if not files.exists(spark, path):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def read_catalog_metadata(spark: SparkSession, path: str) -> DataFrame:
    d = CATALOG_DEFAULTS
    if not files.exists(spark, path):
        return spark.range(1).select(*(F.lit(v).alias(k) for k, v in d.items()))
    raw = spark.read.schema(schemas.CATALOG).json(path, multiLine=False)
    return raw.withColumns({k: F.coalesce(k, F.lit(v)) for k, v in d.items()})


def build_index(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Scanned documents -> items, collections and catalogs, one per entity: collections first, as items may take theirs from them.

    What is indexable is written with its type first, since every part goes through it several times.
    """
    catalogs, groups, features = split_documents(written(list_objects(docs).select("path", "doc", "type"), "indexable"))
    collections = flatten_collections(keep_one(groups))
    return infer_collection(flatten_items(keep_one(features, collections)), collections), collections, keep_one(catalogs)


def union_catalogs(*tables: DataFrame) -> DataFrame:
    """Items of several catalogs; one row per (collection, id), the first table's first.

    Duplicates are dropped by a partially aggregated minimum, not by a window.
    """
    tagged = [t.withColumn("_t", F.lit(i)) for i, t in enumerate(tables)]
    merged = tagged[0]
    for t in tagged[1:]:
        merged = merged.unionByName(t, allowMissingColumns=True)
    rest = [c for c in merged.columns if c not in ("collection", "id", "_t")]
    best = merged.groupBy("collection", "id").agg(F.min_by(F.struct(*rest), "_t").alias("_v"))
    return best.select("collection", "id", *(F.col("_v")[c].alias(c) for c in rest))


# --- other metadata files ---------------------------------------------------------------


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Virtual point cloud manifest -> one row per member cloud: one document, or a member per line (``write_manifest``)."""
    if files.exists(spark, f"{path}/_members"):
        return spark.read.schema("assets struct<data:struct<href:string>>").json(f"{path}/_members").select(F.col("assets.data.href").alias("href"))
    doc = spark.read.schema(schemas.MANIFEST).json(path, multiLine=True)
    return doc.select(F.explode("features").alias("f")).select(F.col("f.assets.data.href").alias("href"))


def write_manifest(members: DataFrame, path: str) -> None:
    """A manifest of clouds (href) with a line for each, so that no task holds all of them."""
    feature = F.struct(F.lit("Feature").alias("type"), F.struct(F.struct("href").alias("data")).alias("assets"))
    members.select(feature.alias("f")).select("f.*").write.mode("overwrite").json(f"{path}/_members")


def read_processing_metadata(
    spark: SparkSession, root: str, glob: str = "*.metadata.json", multi_line: bool = True
) -> DataFrame:
    """One row per conversion record, failures included (``error`` is set).

    ``multi_line`` reads one record per file; without it a file holds one record per line.
    """
    return (
        spark.read.schema(schemas.PROCESSING).option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).json(root, multiLine=multi_line)
    )


def read_raster_metadata(
    spark: SparkSession, root: str, glob: str = "*.metadata.json", multi_line: bool = True
) -> DataFrame:
    """Raster records: those with a product type and without an error.

    Overlapping name patterns cannot read a file twice: one glob covers them all, and a
    record repeated in several files counts once by its output file.
    """
    raw = (
        spark.read.schema(schemas.RASTER).option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob).json(root, multiLine=multi_line)
    )
    return raw.filter(F.col("dem_type").isNotNull() & F.col("error").isNull()).dropDuplicates(["output_file"])


def discover_inputs(listing: DataFrame, prefer: str = ".copc.", key: str = "path") -> DataFrame:
    """Cloud files by extension in any case, once each; converted ones only, if any exist."""
    clouds = listing.filter(F.col(key).rlike(r"(?i)\.la[sz]$")).select(key).distinct()
    flag = F.lower(key).contains(prefer)
    some = clouds.agg(F.coalesce(F.max(flag), F.lit(False)).alias("f")).scalar()
    return clouds.withColumn("_some", some).filter(~F.col("_some") | flag).drop("_some").orderBy(key)
