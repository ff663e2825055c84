"""Processing metadata -> items, collection fields and run summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import crs, geom, text

# Media types, extension schemas, texts of the raster products, the dimension
# type vocabulary, the stage names in pipeline metadata.
POINT_CLOUD_TYPE = "application/vnd.laszip+copc"
COG_TYPE = "image/tiff; application=geotiff; profile=cloud-optimized"
PRODUCT_TEXT = {
    "dem": ("Digital Elevation Model", "Surface elevation model using maximum Z values from point cloud"),
    "dsm": ("Digital Surface Model", "Surface model including buildings and vegetation (first return maximum)"),
    "dtm": ("Digital Terrain Model", "Bare earth terrain model derived from ground-classified points"),
    "intensity": ("Intensity Raster", "LiDAR return intensity values rasterized to grid"),
    "density": ("Point Density", "Point count per grid cell from source point cloud"),
}
ELEVATION_PRODUCTS = ("dem", "dsm", "dtm")
DIMENSION_TYPES = {
    "floating": "floating", "signed": "signed", "unsigned": "unsigned", "double": "floating", "float": "floating",
    "int8": "signed", "int16": "signed", "int32": "signed", "int64": "signed",
    "uint8": "unsigned", "uint16": "unsigned", "uint32": "unsigned", "uint64": "unsigned",
}
STAGES = {"readers": ("readers.las", "readers"), "stats": ("filters.stats", "stats"),
          "hexbin": ("filters.hexbin", "hexbin"), "info": ("filters.info", "info")}
NO_BOX = (0.0, 0.0, 0.0, 0.0, 0.0, 0.0)
GEOGRAPHIC_DEFAULT = 4326


def _lookup(key: Column, table: dict) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(v) for pair in table.items() for v in pair)), key)


def metadata_epsg() -> Column:
    """EPSG of a record: its number, else the code in its source CRS text."""
    return F.coalesce(F.col("epsg"), text.epsg_of(F.col("source_crs")))


def split_results(meta: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Successful and failed records."""
    return meta.filter(F.col("error").isNull()), meta.filter(F.col("error").isNotNull())


def map_dimensions(dims: Column) -> Column:
    return F.transform(dims, lambda d: F.struct(
        F.coalesce(d["name"], F.lit("Unknown")).alias("name"),
        F.coalesce(d["size"], F.lit(4)).alias("size"),
        F.coalesce(_lookup(F.lower(d["type"]), DIMENSION_TYPES), F.lit("floating")).alias("type"),
    ))


def map_statistics(stats: Column) -> Column:
    names = ("average", "count", "maximum", "minimum", "stddev", "variance")
    return F.transform(stats, lambda s: F.struct(
        F.coalesce(s["name"], F.lit("Unknown")).alias("name"), *(s[n].alias(n) for n in names)
    ))


def pick_stage(stages: Column, names: Sequence[str]) -> Column:
    """Value of the first map entry whose key contains one of the names."""
    def named(entry: Column) -> Column:
        test = F.lit(False)
        for n in names:
            test = test | F.contains(entry["key"], F.lit(n))
        return test

    return F.try_element_at(F.filter(F.map_entries(stages), named), F.lit(1))["value"]


def _asset(href: Column, title: str, description, kind: str, role: str, size: Column) -> Column:
    return F.struct(
        href.alias("href"), F.lit(kind).alias("type"),
        (title if isinstance(title, Column) else F.lit(title)).alias("title"),
        (description if isinstance(description, Column) else F.lit(description)).alias("description"),
        F.array(F.lit(role)).alias("roles"), size.cast("bigint").alias("file:size"),
    )


def _cloud_assets(base: str, output: Column, title: str, about: str, record: str) -> Column:
    base = base.rstrip("/")
    none = F.lit(None).cast("bigint")
    data = _asset(F.concat(F.lit(f"{base}/data/"), output), title, about, POINT_CLOUD_TYPE, "data",
                  F.coalesce("file_size_bytes", F.lit(0)))
    meta = _asset(F.concat(F.lit(f"{base}/data/"), text.bare_stem(output), F.lit(".metadata.json")),
                  "Processing Metadata", record, "application/json", "metadata", none)
    return F.create_map(F.lit("data"), data, F.lit("metadata"), meta)


def _located(meta: DataFrame, epsg: Column, corners: int) -> DataFrame:
    native = F.coalesce("bbox", F.array(*(F.lit(v) for v in NO_BOX)))
    box = crs.bbox_to_wgs84(native, F.col("_epsg"), corners)
    moved = meta.withColumn("_epsg", epsg).withColumns({"_native": native, "_box": box})
    b, six = F.col("_box"), F.size("_box") == 6
    flat = F.array(b[0], b[1], F.when(six, F.try_element_at(b, F.lit(4))).otherwise(b[2]),
                   F.when(six, F.try_element_at(b, F.lit(5))).otherwise(b[3]))
    return moved.withColumns({"crs_ok": b.isNotNull(), "_box": F.when(b.isNotNull(), flat)})


def _frame(id_: Column, collection: str, now: str) -> list[Column]:
    b = F.col("_box")
    return [
        id_.alias("id"), F.lit(collection).alias("collection"), F.to_timestamp(F.lit(now)).alias("datetime"),
        b.alias("bbox"), *(b[i].alias(n) for i, n in enumerate(("minx", "miny", "maxx", "maxy"))), "crs_ok",
        F.col("_epsg").alias("proj_epsg"),
    ]


def items_from_metadata(meta: DataFrame, base_url: str, collection: str, now: str, corners: int = 2) -> DataFrame:
    """One item per converted cloud."""
    source = F.coalesce("source_file", F.lit("unknown"))
    item = text.stem(source)
    located = _located(meta, F.coalesce(metadata_epsg(), F.lit(GEOGRAPHIC_DEFAULT)), corners)
    b = F.col("_box")
    box_shape = geom.bbox_polygon(b[0], b[1], b[2], b[3])
    shape = box_shape
    if "geometry" in meta.columns:
        given = geom.from_geojson(F.col("geometry"))
        shape = F.coalesce(
            F.when(F.col("_epsg") == GEOGRAPHIC_DEFAULT, given).otherwise(geom.to_wgs84(given, F.col("_epsg"))), box_shape
        )
    output = F.coalesce("output_file", F.concat(item, F.lit(".copc.laz")))
    extra = []
    if "schema" in meta.columns:
        extra.append(map_dimensions(F.col("schema")).alias("pc_schemas"))
    if "statistics" in meta.columns:
        extra.append(map_statistics(F.col("statistics")).alias("pc_statistics"))
    if "density" in meta.columns:
        extra.append(F.col("density").alias("pc_density"))
    return located.select(
        *_frame(item, collection, now),
        item.alias("title"),
        F.concat(F.lit("COPC point cloud from "), source).alias("description"),
        geom.to_wkt(shape).alias("geometry_wkt"),
        F.coalesce("point_count", F.lit(0)).alias("pc_count"),
        F.lit("lidar").alias("pc_type"), F.lit(POINT_CLOUD_TYPE).alias("pc_encoding"),
        F.col("_native").alias("proj_bbox"),
        _cloud_assets(base_url, output, "COPC Point Cloud Data", "Cloud Optimized Point Cloud (COPC) format",
                      "PDAL processing metadata and statistics").alias("assets"),
        *extra,
    )


def merge_metadata(meta: DataFrame, output_file: str, target_crs: str) -> DataFrame:
    """Records of single clouds -> the record of their merged cloud.

    Names of members are kept as a count, not a list: a merge may have any number of them.
    """
    b = F.col("bbox")
    low = [F.min(b[i]) for i in (0, 1, 2)]
    high = [F.max(b[i]) for i in (3, 4, 5)]
    return meta.agg(
        F.sum("point_count").alias("point_count"), F.sum("file_size_bytes").alias("file_size_bytes"),
        F.array(*low, *high).alias("bbox"), F.count("*").alias("source_file_count"),
    ).withColumns({
        "output_file": F.lit(output_file), "source_crs": F.lit(target_crs), "epsg": F.lit(None).cast("int"),
    })


def merged_item(meta: DataFrame, base_url: str, collection: str, now: str,
                item_id: str = "unified-pointcloud", corners: int = 2) -> DataFrame:
    """Item of a merged cloud."""
    located = _located(meta, F.coalesce(metadata_epsg(), F.lit(GEOGRAPHIC_DEFAULT)), corners)
    b, count = F.col("_box"), F.coalesce("point_count", F.lit(0))
    members = F.col("source_file_count") if "source_file_count" in meta.columns else F.size("source_files")
    return located.select(
        *_frame(F.lit(item_id), collection, now),
        F.lit("Unified Point Cloud").alias("title"),
        F.concat(F.lit("Merged COPC point cloud containing "), F.format_number(count, 0), F.lit(" points")).alias("description"),
        geom.to_wkt(geom.bbox_polygon(b[0], b[1], b[2], b[3])).alias("geometry_wkt"),
        count.alias("pc_count"), F.lit("lidar").alias("pc_type"), F.lit(POINT_CLOUD_TYPE).alias("pc_encoding"),
        F.col("_native").alias("proj_bbox"), members.cast("bigint").alias("source_file_count"),
        _cloud_assets(base_url, F.coalesce("output_file", F.lit("unified.copc.laz")), "Unified COPC Point Cloud",
                      "Cloud Optimized Point Cloud (COPC) - single unified file for on-demand access",
                      "Merge processing metadata and statistics").alias("assets"),
    )


def raster_items(meta: DataFrame, base_url: str, collection: str, now: str, corners: int = 4) -> DataFrame:
    """One item per raster, linked to the cloud it was derived from."""
    output = F.coalesce("output_file", F.lit("unknown.tif"))
    source = F.coalesce("source_file", F.lit("unknown"))
    kind = F.coalesce("dem_type", F.lit("dem"))
    title = F.coalesce(_lookup(kind, {k: v[0] for k, v in PRODUCT_TEXT.items()}), F.lit(PRODUCT_TEXT["dem"][0]))
    about = F.coalesce(_lookup(kind, {k: v[1] for k, v in PRODUCT_TEXT.items()}), F.lit(PRODUCT_TEXT["dem"][1]))
    resolution = F.coalesce("resolution", F.lit(1.0))
    located = _located(meta, F.coalesce(text.epsg_of(F.col("crs")), F.lit(GEOGRAPHIC_DEFAULT)), corners)
    b = F.col("_box")
    have = set(meta.columns)
    nodata = F.coalesce("nodata", F.lit(-9999.0)) if "nodata" in have else F.lit(-9999.0)
    kind_of_data = F.coalesce("data_type", F.lit("float32")) if "data_type" in have else F.lit("float32")
    band = F.struct(
        nodata.alias("nodata"), kind_of_data.alias("data_type"),
        F.when(kind.isin(*ELEVATION_PRODUCTS), F.lit("meter")).alias("unit"), resolution.alias("spatial_resolution"),
    )
    shape = F.array("height", "width") if {"height", "width"} <= have else F.array(F.lit(0), F.lit(0))
    href = F.concat(F.lit(f"{base_url.rstrip('/')}/{collection}/"), output)
    origin = F.struct(
        F.lit("derived_from").alias("rel"),
        F.concat(F.lit("../pointcloud/"), text.bare_stem(source), F.lit(".json")).alias("href"),
        F.lit("application/geo+json").alias("type"),
        F.concat(F.lit("Source point cloud: "), source).alias("title"), F.lit(None).cast("string").alias("hreflang"),
    )
    item = text.stem(output)
    return located.select(
        *_frame(item, collection, now),
        F.concat(item, F.lit(" - "), title).alias("title"),
        F.concat(about, F.lit(". Derived from "), source).alias("description"),
        geom.to_wkt(geom.bbox_polygon(b[0], b[1], b[2], b[3])).alias("geometry_wkt"),
        kind.alias("dem_type"), resolution.alias("resolution"), source.alias("source_pointcloud"),
        shape.alias("proj_shape"), F.array(band).alias("raster_bands"),
        F.create_map(F.lit("PDAL"), F.lit("writers.gdal"), F.lit("GDAL"), F.lit("COG driver")).alias("processing_software"),
        F.create_map(F.lit("data"), _asset(href, title, about, COG_TYPE, "data", F.coalesce("file_size_bytes", F.lit(0)))).alias("assets"),
        F.array(origin).alias("links"),
    )


def collection_extent(meta: DataFrame, epsg: Column | None = None, now: str | None = None, corners: int = 2) -> DataFrame:
    """Union of the geographic boxes, each from its own system; the world when there is none."""
    code = F.coalesce(metadata_epsg() if epsg is None else epsg, F.lit(GEOGRAPHIC_DEFAULT))
    located = _located(meta, code, corners)
    b = F.col("_box")
    values = [F.min(b[0]), F.min(b[1]), F.max(b[2]), F.max(b[3])]
    return located.agg(
        *(F.coalesce(v, F.lit(w)).alias(n) for v, w, n in zip(values, crs.WORLD, ("minx", "miny", "maxx", "maxy")))
    ).withColumns({"start_datetime": F.lit(now), "end_datetime": F.lit(None).cast("string")})


def summaries(meta: DataFrame) -> DataFrame:
    """Range of point counts and the distinct codes, product types and resolutions in use."""
    aggregates = [
        F.min(F.coalesce("point_count", F.lit(0))).alias("min_count"),
        F.max(F.coalesce("point_count", F.lit(0))).alias("max_count"),
        F.sort_array(F.collect_set(metadata_epsg())).alias("epsg_codes"),
    ]
    if "dem_type" in meta.columns:
        aggregates += [
            F.sort_array(F.collect_set(F.coalesce("dem_type", F.lit("dem")))).alias("dem_types"),
            F.sort_array(F.collect_set(F.coalesce("resolution", F.lit(1.0)))).alias("resolutions"),
        ]
    return meta.agg(*aggregates)


def collection_epsg(meta: DataFrame, order: str = "source_file") -> DataFrame:
    """First known code in file order."""
    return meta.agg(F.min_by(metadata_epsg(), F.when(metadata_epsg().isNotNull(), F.col(order))).alias("epsg"))


def run_summary(meta: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Files, outcomes, points, bytes and time of a run."""
    ok = F.col("error").isNull()

    def total(name: str, kind: str) -> Column:
        if name not in meta.columns:
            return F.lit(0).cast(kind)
        return F.coalesce(F.sum(F.when(ok, F.col(name))), F.lit(0)).cast(kind)

    size = total("file_size_bytes", "bigint")
    return meta.groupBy(*by).agg(
        F.count("*").alias("total_files"), F.count_if(ok).alias("successful"), F.count_if(~ok).alias("failed"),
        total("point_count", "bigint").alias("total_points"), size.alias("total_size_bytes"),
        F.round(size / F.lit(1048576.0), 2).alias("total_size_mb"),
        total("processing_time_seconds", "double").alias("total_seconds"),
    )


def write_run_summary(meta: DataFrame, path: str, by: Sequence[str] = ()) -> None:
    """The summary as one JSON line per group; the records stay a table of their own."""
    run_summary(meta, by).write.mode("overwrite").json(path)
