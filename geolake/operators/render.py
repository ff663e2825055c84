"""Index rows back to documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import geom

# Media types of links.
JSON, GEOJSON = "application/json", "application/geo+json"
STAC_VERSION = "1.0.0"
#: Items that a task writes as files of their own.
FILES = 500


def iso_time(value: Column) -> Column:
    """Timestamp -> ISO text in UTC."""
    utc = F.convert_timezone(F.current_timezone(), F.lit("UTC"), value.cast("timestamp_ntz"))
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def _have(df: DataFrame, name: str, kind: str = "string") -> Column:
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def _graft(json: Column, key: str, value: Column) -> Column:
    """Put ready JSON text under a key at the front of a JSON object text."""
    return F.concat(F.lit("{"), F.lit(f'"{key}":'), F.coalesce(value, F.lit("null")), F.lit(","), F.substring(json, 2, 2**31 - 1))


def items_to_geojson(items: DataFrame) -> DataFrame:
    """Adds ``feature``: the stored document if there is one, else rebuilt from columns."""
    parts = {
        "pc:count": _have(items, "pc_count", "bigint"),
        "pc:type": _have(items, "pc_type"),
        "pc:encoding": _have(items, "pc_encoding"),
        "proj:epsg": _have(items, "proj_epsg", "int"),
        "proj:bbox": _have(items, "proj_bbox", "array<double>"),
    }
    properties = F.struct(
        iso_time(F.col("datetime")).alias("datetime"), _have(items, "title").alias("title"),
        *(v.alias(k) for k, v in parts.items()),
    )
    box = F.array("minx", "miny", "maxx", "maxy")
    given = F.col("bbox") if "bbox" in items.columns else F.when(F.col("minx").isNotNull(), box)
    body = F.to_json(F.struct(
        F.lit("Feature").alias("type"),
        F.coalesce(_have(items, "stac_version"), F.lit(STAC_VERSION)).alias("stac_version"),
        "id", "collection", given.alias("bbox"), properties.alias("properties"),
        *([F.col("assets")] if "assets" in items.columns else []),
        *([F.col("links")] if "links" in items.columns else []),
    ))
    shape = geom.bbox_polygon(*(F.col(c) for c in ("minx", "miny", "maxx", "maxy")))
    if "geometry_wkt" in items.columns:
        shape = F.coalesce(geom.from_wkt(F.col("geometry_wkt")), shape)
    rebuilt = _graft(body, "geometry", geom.to_geojson(shape))
    return items.withColumn("feature", F.coalesce(_have(items, "item_json"), rebuilt))


def collections_to_json(collections: DataFrame) -> DataFrame:
    """Adds ``document`` in the same way for collections."""
    box = F.when(F.col("bbox").isNotNull(), F.array("bbox")).otherwise(F.array().cast("array<array<double>>"))
    interval = F.array(F.array(_have(collections, "start_datetime"), _have(collections, "end_datetime")))
    body = F.to_json(F.struct(
        F.lit("Collection").alias("type"),
        F.coalesce(_have(collections, "stac_version"), F.lit(STAC_VERSION)).alias("stac_version"),
        "id", _have(collections, "title").alias("title"),
        F.coalesce(_have(collections, "description"), F.lit("")).alias("description"),
        F.coalesce(_have(collections, "license"), F.lit("proprietary")).alias("license"),
        F.struct(
            F.struct(box.alias("bbox")).alias("spatial"), F.struct(interval.alias("interval")).alias("temporal")
        ).alias("extent"),
        F.coalesce(_have(collections, "stac_extensions", "array<string>"), F.array().cast("array<string>")).alias("stac_extensions"),
    ))
    for key in ("summaries", "providers", "links"):
        if key in collections.columns:
            body = F.when(F.col(key).isNotNull(), _graft(body, key, F.col(key))).otherwise(body)
    return collections.withColumn("document", F.coalesce(_have(collections, "collection_json"), body))


def _link(rel: str, kind: str, *parts) -> Column:
    href = F.concat(*(p if isinstance(p, Column) else F.lit(p) for p in parts))
    return F.struct(F.lit(rel).alias("rel"), href.alias("href"), F.lit(kind).alias("type"))


def with_links(df: DataFrame, base_url: str, kind: str) -> DataFrame:
    """Navigation links of a service: ``kind`` is 'collection', 'item' or 'hit'."""
    base = base_url.rstrip("/")
    if kind == "collection":
        home = (f"{base}/collections/", F.col("id"))
        links = [
            _link("self", JSON, *home), _link("parent", JSON, f"{base}/"), _link("root", JSON, f"{base}/"),
            _link("items", GEOJSON, *home, "/items"),
        ]
    elif kind in ("item", "hit"):
        home = (f"{base}/collections/", F.coalesce("collection", F.lit("unknown")))
        links = [_link("self", GEOJSON, *home, "/items/", F.col("id"))]
        if kind == "item":
            links.append(_link("parent", JSON, *home))
        links += [_link("collection", JSON, *home), _link("root", JSON, f"{base}/")]
    else:
        raise ValueError("kind must be 'collection', 'item' or 'hit'")
    return df.withColumn("links", F.array(*links))


def feature_collection(page: DataFrame, counts: DataFrame, base_url: str, order: Column | None = None) -> DataFrame:
    """One document for one page of ``feature`` texts; the page is whole, its size is up to the search."""
    base = base_url.rstrip("/")
    rank = F.struct(order if order is not None else F.col("id"), F.col("feature"))
    joined = page.agg(F.sort_array(F.collect_list(rank)).alias("r"), F.count("*").alias("returned"))
    features = F.array_join(F.transform("r", lambda x: x["feature"]), ",")
    links = F.to_json(F.array(_link("self", GEOJSON, f"{base}/search"), _link("root", JSON, f"{base}/")))
    matched = counts.select("matched").scalar()
    return joined.withColumn("matched", matched).select(
        "matched", "returned",
        F.concat(
            F.lit('{"type":"FeatureCollection","features":['), features, F.lit('],"numberMatched":'),
            F.col("matched").cast("string"), F.lit(',"numberReturned":'), F.col("returned").cast("string"),
            F.lit(',"links":'), links, F.lit("}"),
        ).alias("document"),
    )


def render_documents(items: DataFrame) -> DataFrame:
    """One JSON document per item with its place in the tree: collection/item/item.json."""
    shown = items if "feature" in items.columns else items_to_geojson(items)
    path = F.concat_ws("/", "collection", "id", F.concat("id", F.lit(".json")))
    return shown.select("collection", "id", path.alias("rel_path"), F.col("feature").alias("json"))


def write_files(texts: DataFrame, root: str, *keys: str) -> None:
    """A file for each ``value`` below folders named by ``keys``; sorting keeps one file open per task.

    The work goes by the number of files, not by their few bytes: a task makes some ``FILES`` of them and moves them into place itself,
    where the default has the driver move all files one by one.
    """
    spread = texts.repartition(1 + texts.count() // FILES, *keys)
    spread.write.mode("overwrite").option("mapreduce.fileoutputcommitter.algorithm.version", "2").partitionBy(*keys).text(root)


def write_documents(documents: DataFrame, root: str) -> None:
    """One file per item below collection=.../id=..."""
    write_files(documents.select("collection", "id", F.col("json").alias("value")), root, "collection", "id")


def write_bundles(documents: DataFrame, root: str) -> None:
    """The same documents as lines of their collection's files, each with its place in the tree: as many files as their size asks for."""
    lines = documents.select("collection", F.col("rel_path").alias("path"), F.col("json").alias("doc"))
    lines.repartitionByRange("collection", "path").sortWithinPartitions("collection", "path").write.mode("overwrite").partitionBy("collection").json(root)
