"""Explicit schemas. Documents are read with these, never inferred, so a new key in one
file cannot change the shape of a table; scalars whose type may be wrong arrive as text."""

from __future__ import annotations

LINKS = "array<struct<rel:string,href:string,type:string,title:string,hreflang:string>>"
ASSETS = (
    "map<string,struct<href:string,type:string,title:string,description:string,"
    "roles:array<string>,`file:size`:bigint>>"
)
ITEM = (
    "type string, stac_version string, id string, collection string, bbox string, geometry string, "
    "properties struct<title:string,description:string,datetime:string,`pc:count`:string,`pc:type`:string,"
    "`pc:encoding`:string,`pc:density`:string,`pc:schemas`:string,`pc:statistics`:string,"
    "`proj:epsg`:string,`proj:bbox`:string>, "
    "assets string, links string, stac_extensions string"
)
COLLECTION = (
    "type string, stac_version string, id string, title string, description string, license string, "
    "extent struct<spatial:struct<bbox:string>,temporal:struct<interval:string>>, "
    "stac_extensions string, summaries string, providers string, links string"
)
ITEMS = (
    "id string, collection string, title string, stac_version string, datetime timestamp, "
    "bbox array<double>, minx double, miny double, maxx double, maxy double, "
    "geometry_wkt string, pc_count bigint, pc_type string, pc_encoding string, proj_epsg int, "
    f"proj_bbox array<double>, stac_extensions array<string>, assets {ASSETS}, links {LINKS}, "
    "item_json string, source_key string"
)
COLLECTIONS = (
    "id string, stac_version string, title string, description string, license string, "
    "bbox array<double>, geometry_wkt string, start_datetime string, end_datetime string, "
    "stac_extensions array<string>, summaries string, providers string, links string, "
    "collection_json string, source_key string"
)
CATALOG = (
    "catalog_id string, catalog_title string, catalog_description string, stac_version string, "
    "indexed_at string, items_count bigint, collections_count bigint, index_version string"
)
STATISTICS = (
    "array<struct<name:string,average:double,count:bigint,maximum:double,minimum:double,"
    "stddev:double,variance:double>>"
)
DIMENSIONS = "array<struct<name:string,size:int,type:string>>"
PROCESSING = (
    "source_file string, output_file string, point_count bigint, bbox array<double>, "
    f"statistics {STATISTICS}, schema {DIMENSIONS}, density double, geometry string, crs string, "
    "epsg int, source_crs string, target_crs string, source_files array<string>, "
    "file_size_bytes bigint, processing_time string, error string"
)
RASTER = (
    "source_file string, output_file string, dem_type string, resolution double, width int, height int, "
    "bbox array<double>, crs string, nodata double, data_type string, file_size_bytes bigint, "
    "is_valid boolean, processing_time_seconds double, error string"
)
POINTS = (
    "X double, Y double, Z double, Intensity int, ReturnNumber smallint, NumberOfReturns smallint, "
    "Classification smallint, source_file string, epsg int"
)
MANIFEST = "features array<struct<type:string,assets:struct<data:struct<href:string>>>>"
