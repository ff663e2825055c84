"""Queries over documents made from the item view, files, and the streaming index."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import geom
from ..operators import quality, raster, render, search
from ..operators.points import crop
from ..session import scratch_dir
from ..sources import documents, tables
from ..streaming import index as live
from .registry import NUDGE, query, rounded
from .search_queries import BASE, NOW, _collections, _hits, _raster_meta
from .search_queries import forward_sql, inverse_sql
from .terrain_queries import CELLS, RES
from .views import ITEMS, META, POINTS, cells, header, header_sql, items, meta, points, raster_sql, table


def _item_docs(spark, sf_dir):
    """One document per item with the irregularities real trees have, plus bad neighbours.

    By event number: no box at all, box only, geometry only, six-value box, no collection,
    broken time, no title, count as text or fraction; conflict copies, translations and
    malformed files beside some.
    """
    i = items(spark, sf_dir).withColumn("n", F.expr("cast(substring(id, 6) as bigint)"))
    n = F.col("n")
    located = F.col("minx").isNotNull()
    west, south, east, north = (F.col(c).cast("string") for c in ("minx", "miny", "maxx", "maxy"))

    def member(name, value):
        """A JSON member text, or nothing where the value is NULL."""
        return F.coalesce(F.concat(F.lit(f',"{name}":'), value), F.lit(""))

    def quoted(value):
        return F.concat(F.lit('"'), value, F.lit('"'))

    def listed(*values):
        return F.concat(F.lit("["), F.concat_ws(",", *values), F.lit("]"))

    box = F.when(located & (n % 5 != 2), F.when(n % 5 == 3, listed(west, south, F.lit("0.0"), east, north, F.lit("99.0")))
                 .otherwise(listed(west, south, east, north)))
    ring = listed(listed(west, south), listed(east, south), listed(east, north), listed(west, north), listed(west, south))
    shape = F.when(located & (n % 5 != 1), F.concat(F.lit('{"type":"Polygon","coordinates":['), ring, F.lit("]}")))
    when = F.when(n % 13 == 0, F.lit("not a time")).otherwise(render.iso_time(F.col("datetime")))
    count = F.when(n % 23 == 0, F.lit("12.5")).when(n % 29 != 0, F.col("pc_count").cast("string"))
    properties = F.concat(
        F.lit('{"pc:type":"'), F.when(n % 37 == 5, "laser").otherwise("lidar"), F.lit('"'), member("pc:count", count), member("title", F.when(n % 7 != 0, quoted(F.col("title")))),
        member("datetime", quoted(when)), member("proj:epsg", F.col("proj_epsg").cast("string")), F.lit("}"),
    )
    assets = F.concat(
        F.lit('{"'), F.when(n % 31 == 0, "thumb").otherwise("data"), F.lit('":{"href":"https://example.org/data/'), F.col("id"),
        F.lit('","type":"'), F.when(n % 2 == 0, search.COG_TYPE).otherwise("image/png"),
        F.lit('","roles":["'), F.when(n % 3 == 0, "elevation").otherwise("data"), F.lit('"]}}'),
    )
    body = F.concat(
        F.lit('{"type":"Feature","stac_version":"1.0.0"'), member("id", quoted(F.col("id"))),
        member("collection", F.when(n % 11 != 0, quoted(F.col("collection")))), member("bbox", box), member("geometry", shape),
        member("properties", properties), member("assets", assets),
        F.lit(',"links":[{"rel":"root","href":"../../catalog.json"}]}'),
    )
    rows = i.select(n.alias("n"), F.concat_ws("/", "collection", "id", "id").alias("p"), body.alias("doc"))
    n, p, doc = F.col("n"), F.col("p"), F.col("doc")

    def variant(keep, path, text):
        return F.struct(keep.alias("keep"), path.alias("path"), text.alias("doc"))

    variants = F.array(
        variant(F.lit(True), F.concat(p, F.lit(".json")), doc),
        variant(n % 17 == 0, F.concat(p, F.lit("-en.json")), doc),
        variant(n % 19 == 0, F.concat(p, F.lit(" (conflicted copy 1).json")), doc),
        variant(n % 37 == 0, F.concat(p, F.lit("-bad.json")), F.substring(doc, 1, 60)),
        variant(n % 41 == 0, F.concat(p, F.lit("-none.json")), F.lit('{"id": "x"}')),
        variant(n % 43 == 0, F.concat(F.lit("index/"), p, F.lit(".json")), doc),
    )
    return rows.select(F.inline(F.filter(variants, lambda v: v["keep"]))).drop("keep")


def stored(spark, name, docs):
    """A document table as it lies on storage."""
    path = scratch_dir(spark, name)
    docs.write.parquet(path)
    return spark.read.schema("path string, doc string").parquet(path).withColumn("type", documents.document_type(F.col("doc")))


def item_docs(spark, sf_dir):
    return stored(spark, "itemdocs", _item_docs(spark, sf_dir))


def collection_docs(spark, sf_dir):
    return stored(spark, "collectiondocs", _collection_docs(spark, sf_dir))


def all_docs(spark, sf_dir):
    return item_docs(spark, sf_dir).unionByName(collection_docs(spark, sf_dir))


def _collection_docs(spark, sf_dir):
    c = _collections(spark, sf_dir)
    body = F.to_json(F.struct(
        F.lit("Collection").alias("type"), F.lit("1.0.0").alias("stac_version"), "id", "title", "description",
        F.struct(
            F.struct(F.array("bbox").alias("bbox")).alias("spatial"),
            F.struct(F.array(F.array("start_datetime", "end_datetime")).alias("interval")).alias("temporal"),
        ).alias("extent"),
        F.array().cast("array<string>").alias("links"),
    ))
    made = c.select(F.concat("id", F.lit("/collection.json")).alias("path"), body.alias("doc"))
    root = spark.range(1).select(
        F.lit("catalog.json").alias("path"),
        F.lit('{"type":"Catalog","stac_version":"1.0.0","id":"root","title":"Events","description":"All","links":[]}').alias("doc"),
    )
    return made.unionByName(root)


_COUNT = "count(*) FILTER (WHERE event_id % {} = 0)"


@query("split_documents", f"""SELECT count(*) + {_COUNT.format(17)} + {_COUNT.format(19)} + {_COUNT.format(43)} AS features,
  count(DISTINCT event_type) AS collections, CAST(1 AS BIGINT) AS catalogs, {_COUNT.format(37)} + {_COUNT.format(41)} AS rejected FROM events""")
def split_documents(spark, sf_dir):
    docs = all_docs(spark, sf_dir)
    catalogs, collections, features = documents.split_documents(docs)
    parts = {"features": features, "collections": collections, "catalogs": catalogs, "rejected": documents.rejects(docs)}
    counted = None
    for name, df in parts.items():
        step = df.agg(F.lit(name).alias("k"), F.count("*").alias("n"))
        counted = step if counted is None else counted.unionByName(step)
    return counted.groupBy().pivot("k", list(parts)).agg(F.first("n"))


_FLAT = """SELECT id, collection, title, datetime,
  round(minx,8) AS minx, round(miny,8) AS miny, round(maxx,8) AS maxx, round(maxy,8) AS maxy, pc_count, proj_epsg FROM ({})"""
_DOC = """SELECT event_id, id, collection AS c, CASE WHEN event_id % 11 <> 0 THEN collection END AS collection, CASE WHEN event_id % 7 <> 0 THEN title ELSE id END AS title,
  CASE WHEN event_id % 13 <> 0 THEN strftime(datetime, '%Y-%m-%d %H:%M:%S.%f') END AS datetime, minx, miny, maxx, maxy,
  CASE WHEN event_id % 23 <> 0 AND event_id % 29 <> 0 THEN pc_count END AS pc_count, proj_epsg FROM v_items"""


def _flat(df):
    return df.select(
        "id", "collection", "title", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("datetime"),
        *(F.round(c, 8).alias(c) for c in ("minx", "miny", "maxx", "maxy")), "pc_count", "proj_epsg",
    )


@query("flatten_items", f"""WITH {ITEMS}, d AS ({_DOC}), a AS (SELECT * FROM d UNION ALL SELECT * FROM d WHERE event_id % 19 = 0) {_FLAT.format('SELECT * FROM a')}""")
def flatten_items(spark, sf_dir):
    docs = documents.list_objects(item_docs(spark, sf_dir))
    return _flat(documents.flatten_items(docs))


@query("build_index", f"""WITH {ITEMS}, d AS ({_DOC}) {_FLAT.format('SELECT * REPLACE (c AS collection) FROM d')}""")
def build_index(spark, sf_dir):
    found, _, _ = documents.build_index(all_docs(spark, sf_dir))
    return _flat(found)


@query("infer_collection", f"""WITH {ITEMS} SELECT collection, count(*) AS items FROM (SELECT collection FROM v_items UNION ALL SELECT collection FROM v_items WHERE event_id % 19 = 0) GROUP BY 1""")
def infer_collection(spark, sf_dir):
    docs = documents.list_objects(all_docs(spark, sf_dir))
    found = documents.infer_collection(documents.flatten_items(docs), documents.flatten_collections(docs))
    return found.groupBy("collection").agg(F.count("*").alias("items"))


@query("drop_translations", f"SELECT count(*) + {_COUNT.format(19)} + {_COUNT.format(37)} + {_COUNT.format(41)} + {_COUNT.format(43)} AS documents FROM events")
def drop_translations(spark, sf_dir):
    return documents.drop_translations(item_docs(spark, sf_dir)).agg(F.count("*").alias("documents"))


@query("duplicates", f"""WITH {ITEMS} SELECT id, CASE WHEN event_id % 11 <> 0 THEN collection END AS collection,
  1 + CAST(event_id % 17 = 0 AS INTEGER) + CAST(event_id % 19 = 0 AS INTEGER) + CAST(event_id % 43 = 0 AS INTEGER) AS copies FROM v_items
  WHERE event_id % 17 = 0 OR event_id % 19 = 0 OR event_id % 43 = 0""")
def duplicates(spark, sf_dir):
    docs = item_docs(spark, sf_dir).filter(F.col("type") == "Feature")
    return quality.duplicate_documents(docs).select("id", "collection", "copies")


_COLLECTION_SQL = f"""SELECT collection AS id, 'Events: ' || collection AS title, 'Recorded events' AS description, 'proprietary' AS license,
  round(min(minx),8) AS minx, round(max(maxy),8) AS maxy, strftime(min(datetime), '%Y-%m-%dT%H:%M:%SZ') AS start_datetime FROM v_items GROUP BY 1"""


def _shown(df):
    return df.select("id", "title", "description", "license", F.round(F.col("bbox")[0], 8).alias("minx"),
                     F.round(F.col("bbox")[3], 8).alias("maxy"), "start_datetime")


@query("flatten_collections", f"WITH {ITEMS} {_COLLECTION_SQL}")
def flatten_collections(spark, sf_dir):
    return _shown(documents.flatten_collections(collection_docs(spark, sf_dir)))


@query("write_collections", f"WITH {ITEMS} {_COLLECTION_SQL}")
def write_collections(spark, sf_dir):
    path = scratch_dir(spark, "collections")
    documents.write_collections(documents.flatten_collections(collection_docs(spark, sf_dir)), path)
    from .. import schemas

    return _shown(documents.read_index(spark, path, schemas.COLLECTIONS))


@query("read_index", f"""WITH {ITEMS}, d AS ({_DOC}) {_FLAT.format('SELECT * REPLACE (c AS collection) FROM d')}""")
def read_index(spark, sf_dir):
    path = scratch_dir(spark, "items")
    empty = documents.read_index(spark, path)
    found, _, _ = documents.build_index(all_docs(spark, sf_dir))
    documents.write_items(found.select(*empty.columns), path)
    return _flat(documents.read_index(spark, path))


@query("catalog_metadata", f"""SELECT 'root' AS catalog_id, 'Events' AS catalog_title, 'All' AS catalog_description, '1.0.0' AS stac_version,
 '{NOW}' AS indexed_at, count(*) AS items_count, count(DISTINCT event_type) AS collections_count, '1.0.0' AS index_version FROM events""")
def catalog_metadata(spark, sf_dir):
    path = scratch_dir(spark, "catalog")
    found, collections, catalogs = documents.build_index(all_docs(spark, sf_dir))
    documents.write_catalog_metadata(documents.catalog_metadata(catalogs, found, collections, NOW), path)
    return documents.read_catalog_metadata(spark, path)


@query("index_health", "SELECT count(*) AS items, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS newest, count(DISTINCT event_type) AS collections FROM events")
def index_health(spark, sf_dir):
    health = live.index_health(items(spark, sf_dir), _collections(spark, sf_dir))
    return health.withColumn("newest", F.date_format("newest", "yyyy-MM-dd HH:mm:ss.SSSSSS"))


@query("dem_assets", "SELECT event_id % 6 = 0 AS is_dem, count(*) AS items FROM events GROUP BY 1")
def dem_assets(spark, sf_dir):
    docs = documents.list_objects(item_docs(spark, sf_dir)).filter("type IS NOT NULL")
    found = documents.flatten_items(documents.keep_one(docs))
    return found.groupBy(search.is_dem_item(F.col("assets")).alias("is_dem")).agg(F.count("*").alias("items"))


@query("union_catalogs", f"""WITH {ITEMS} SELECT collection, id, CASE WHEN score > 50 THEN title ELSE 'second' END AS title FROM v_items
 WHERE score > 50 OR collection <> 'error'""")
def union_catalogs(spark, sf_dir):
    found = items(spark, sf_dir).select("collection", "id", "title", "score")
    second = found.filter("collection <> 'error'").withColumn("title", F.lit("second"))
    return documents.union_catalogs(found.filter("score > 50"), second).select("collection", "id", "title")


# --- rendering --------------------------------------------------------------------------


@query("items_geojson", f"""WITH {ITEMS} SELECT id, collection, strftime(datetime, '%Y-%m-%dT%H:%M:%S.%fZ') AS datetime, pc_count, round(minx,8) AS west,
 'https://example.org/collections/' || collection || '/items/' || id AS self_href, CAST(4 AS INTEGER) AS links FROM v_items""")
def items_geojson(spark, sf_dir):
    shown = render.with_links(items(spark, sf_dir), "https://example.org/", "item")
    doc = render.items_to_geojson(shown).select("feature")
    parsed = F.from_json("feature", "id string, collection string, bbox array<double>, geometry string, "
                         "properties struct<datetime:string,`pc:count`:bigint>, links array<struct<rel:string,href:string>>")
    p = doc.select(parsed.alias("p"))
    west = geom.bounds(geom.from_geojson(F.col("p.geometry")))[0]
    return p.select(
        F.col("p.id").alias("id"), F.col("p.collection").alias("collection"), F.col("p.properties.datetime").alias("datetime"),
        F.col("p.properties")["pc:count"].alias("pc_count"), F.round(west, 8).alias("west"),
        F.col("p.links")[0]["href"].alias("self_href"), F.size("p.links").alias("links"),
    )


@query("stored_json", f"""WITH {ITEMS}, d AS ({_DOC}), all_of AS (
  SELECT *, event_id % 2 = 0 AS kept FROM d)
SELECT id, title, CASE WHEN kept THEN 'root' END AS link, CASE WHEN NOT kept THEN pc_count END AS rebuilt_count FROM all_of""")
def stored_json(spark, sf_dir):
    """Items that still have their document give it back, the others are rebuilt from columns."""
    docs = item_docs(spark, sf_dir).filter(F.col("path").rlike(r"item-(\d+)/item-\1\.json$") & ~F.col("path").startswith("index/"))
    kept = F.expr("cast(substring(id, 6) as bigint) % 2 = 0")
    found = documents.flatten_items(docs).withColumn("item_json", F.when(kept, F.col("item_json")))
    said = F.from_json("feature", "id string, properties struct<title:string,`pc:count`:string>, links array<struct<rel:string>>")
    shown = render.items_to_geojson(found.drop("links")).select("id", "title", said.alias("p"), kept.alias("kept"))
    count = F.when(~F.col("kept"), F.col("p.properties")["pc:count"].cast("bigint"))
    return shown.select("id", "title", F.try_element_at("p.links", F.lit(1))["rel"].alias("link"), count.alias("rebuilt_count"))


@query("collections_json", f"""WITH {ITEMS} SELECT collection AS id, 'Events: ' || collection AS title, round(min(minx),8) AS west,
 strftime(min(datetime), '%Y-%m-%dT%H:%M:%SZ') AS start_datetime, 'https://example.org/collections/' || collection || '/items' AS items_href FROM v_items GROUP BY 1""")
def collections_json(spark, sf_dir):
    shown = render.collections_to_json(render.with_links(_collections(spark, sf_dir), BASE_URL, "collection").withColumn("links", F.to_json("links")))
    parsed = F.from_json("document", "id string, title string, extent struct<spatial:struct<bbox:array<array<double>>>,temporal:struct<interval:array<array<string>>>>, links array<struct<rel:string,href:string>>")
    return shown.select(parsed.alias("p")).select(
        F.col("p.id").alias("id"), F.col("p.title").alias("title"), F.round(F.col("p.extent.spatial.bbox")[0][0], 8).alias("west"),
        F.col("p.extent.temporal.interval")[0][0].alias("start_datetime"), F.col("p.links")[3]["href"].alias("items_href"),
    )


BASE_URL = "https://example.org"


@query("feature_collection", f"""WITH {ITEMS}, m AS (SELECT * FROM v_items WHERE collection = 'view'), page AS (SELECT id FROM m ORDER BY datetime DESC NULLS LAST, id LIMIT 50)
SELECT (SELECT count(*) FROM m) AS matched, count(*) AS returned, CAST(count(*) AS INTEGER) AS features, min(id) AS first_id FROM page""")
def feature_collection(spark, sf_dir):
    found = items(spark, sf_dir)
    page = render.items_to_geojson(render.with_links(search.search(found, limit=50, collections=["view"]), BASE_URL, "hit"))
    doc = render.feature_collection(page, search.search_counts(found, limit=50, collections=["view"]), BASE_URL)
    features = F.from_json(F.get_json_object("document", "$.features"), "array<struct<id:string>>")
    return doc.select("matched", "returned", F.size(features).alias("features"), F.array_min(F.transform(features, lambda f: f["id"])).alias("first_id"))


@query("render_documents", """SELECT 's-' || CAST(s_suppkey AS VARCHAR) AS id, 'n-' || CAST(s_nationkey AS VARCHAR) AS collection,
 'n-' || CAST(s_nationkey AS VARCHAR) || '/s-' || CAST(s_suppkey AS VARCHAR) || '/s-' || CAST(s_suppkey AS VARCHAR) || '.json' AS rel_path FROM supplier""")
def render_documents(spark, sf_dir):
    root = scratch_dir(spark, "tree")
    documents_ = render.render_documents(_supplier_items(spark, sf_dir))
    render.write_documents(documents_, root)
    read = documents.read_documents(spark, root, glob="*.txt")
    flat = documents.flatten_items(read).select("id", "collection")
    return flat.join(documents_.select("id", "rel_path"), "id")


def _supplier_items(spark, sf_dir):
    x = F.lit(138.0) + (F.col("s_suppkey") % 50) / F.lit(50.0)
    y = F.lit(35.0) + (F.col("s_nationkey") % 25) / F.lit(25.0)
    return table(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s-"), F.col("s_suppkey").cast("string")).alias("id"),
        F.concat(F.lit("n-"), F.col("s_nationkey").cast("string")).alias("collection"),
        F.col("s_name").alias("title"), F.to_timestamp(F.lit(NOW)).alias("datetime"),
        x.alias("minx"), y.alias("miny"), (x + 0.01).alias("maxx"), (y + 0.01).alias("maxy"),
    )


# --- tree -------------------------------------------------------------------------------


def tree_docs(spark, sf_dir):
    return stored(spark, "treedocs", _tree_docs(spark, sf_dir))


def _tree_docs(spark, sf_dir):
    """region -> nation -> supplier as catalog, collection and item documents with links."""
    def links(children, base):
        return F.transform(children, lambda c: F.struct(
            F.lit(base).alias("rel"), F.concat(F.lit("./"), c, F.lit("/"), c, F.lit(".json")).alias("href")))

    def node(kind, key, links_):
        return F.to_json(F.struct(
            F.lit(kind).alias("type"), F.lit("1.0.0").alias("stac_version"), key.alias("id"), F.lit("d").alias("description"), links_.alias("links")))

    text = lambda p, c: F.concat(F.lit(p), F.col(c).cast("string"))
    region, nation, supplier = (table(spark, sf_dir, t) for t in ("region", "nation", "supplier"))
    r = region.select("r_regionkey", text("r-", "r_regionkey").alias("id"))
    n = nation.select("n_nationkey", F.col("n_regionkey").alias("r_regionkey"), text("n-", "n_nationkey").alias("id"))
    s = supplier.select(F.col("s_nationkey").alias("n_nationkey"), text("s-", "s_suppkey").alias("id"))
    item_lists = s.groupBy("n_nationkey").agg(F.sort_array(F.collect_list("id")).alias("kids"))
    none = F.array().cast("array<string>")
    n = n.join(item_lists, "n_nationkey", "left").withColumn("kids", F.coalesce("kids", none))
    nation_lists = n.filter("n_nationkey % 7 <> 3").groupBy("r_regionkey").agg(F.sort_array(F.collect_list("id")).alias("kids"))
    r = r.join(nation_lists, "r_regionkey", "left").withColumn("kids", F.coalesce("kids", none))
    top = r.agg(F.sort_array(F.collect_list("id")).alias("kids"))
    n_path = F.concat_ws("/", F.concat(F.lit("r-"), F.col("r_regionkey").cast("string")), "id")
    s_in = s.join(n.select("n_nationkey", n_path.alias("folder")), "n_nationkey")
    empty = F.array().cast("array<struct<rel:string,href:string>>")
    docs = top.select(F.lit("catalog.json").alias("path"), node("Catalog", F.lit("root"), links(F.col("kids"), "child")).alias("doc"))
    docs = docs.unionByName(r.select(F.concat_ws("/", "id", F.concat("id", F.lit(".json"))).alias("path"), node("Catalog", F.col("id"), links(F.col("kids"), "child")).alias("doc")))
    docs = docs.unionByName(n.select(F.concat(n_path, F.lit("/"), F.col("id"), F.lit(".json")).alias("path"), node("Collection", F.col("id"), F.concat(links(F.col("kids"), "item"), links(F.array(F.lit("gone")), "item"))).alias("doc")))
    docs = docs.unionByName(s_in.select(F.concat_ws("/", "folder", "id", F.concat("id", F.lit(".json"))).alias("path"), node("Feature", F.col("id"), empty).alias("doc")))
    return docs


_TREE = """n AS (SELECT n_nationkey, 'r-' || n_regionkey || '/n-' || n_nationkey AS folder, n_nationkey % 7 <> 3 AS linked FROM nation),
s AS (SELECT folder || '/s-' || s_suppkey || '/s-' || s_suppkey || '.json' AS path, linked FROM supplier JOIN n ON n_nationkey = s_nationkey)"""


@query("tree_walk", f"""WITH {_TREE} SELECT 'catalog.json' AS path, 0 AS depth, 'root' AS kind
UNION ALL SELECT 'r-' || r_regionkey || '/r-' || r_regionkey || '.json', 1, 'child' FROM region
UNION ALL SELECT folder || '/n-' || n_nationkey || '.json', 2, 'child' FROM n WHERE linked
UNION ALL SELECT folder || '/gone/gone.json', 3, 'item' FROM n WHERE linked
UNION ALL SELECT path, 3, 'item' FROM s WHERE linked""")
def tree_walk(spark, sf_dir):
    docs = tree_docs(spark, sf_dir)
    return quality.walk_catalog(quality.edges_of(docs), docs.filter("path = 'catalog.json'"))


@query("link_integrity", f"""WITH {_TREE} SELECT folder || '/gone/gone.json' AS path, 'dangling' AS problem FROM n
UNION ALL SELECT folder || '/n-' || n_nationkey || '.json', 'unreachable' FROM n WHERE NOT linked""")
def link_integrity(spark, sf_dir):
    docs = tree_docs(spark, sf_dir)
    return quality.link_integrity(docs, quality.edges_of(docs))


# --- checks -----------------------------------------------------------------------------


@query("validate_structure", f"""WITH {ITEMS}, d AS (SELECT event_id, minx FROM v_items UNION ALL SELECT event_id, minx FROM v_items WHERE event_id % 17 = 0
  UNION ALL SELECT event_id, minx FROM v_items WHERE event_id % 19 = 0 UNION ALL SELECT event_id, minx FROM v_items WHERE event_id % 43 = 0)
SELECT 'bad_datetime' AS kind, count(*) AS n FROM d WHERE event_id % 13 = 0
UNION ALL SELECT 'missing_bbox', count(*) FROM d WHERE event_id % 5 = 2 AND minx IS NOT NULL
UNION ALL SELECT 'unreadable', {_COUNT.format(37)} + {_COUNT.format(41)} FROM v_items
UNION ALL SELECT 'missing_license', count(DISTINCT collection) FROM v_items""")
def validate_structure(spark, sf_dir):
    return quality.validate_structure(all_docs(spark, sf_dir)).groupBy("kind").agg(F.count("*").alias("n"))


_PC = "e AS (SELECT event_id FROM events UNION ALL SELECT event_id FROM events WHERE event_id % 17 = 0 UNION ALL SELECT event_id FROM events WHERE event_id % 19 = 0 UNION ALL SELECT event_id FROM events WHERE event_id % 43 = 0)"
_PC_SQL = " UNION ALL ".join((
    "SELECT 'error' AS severity, 'missing_required' AS kind, 'pc:count' AS field, count(*) AS n FROM e WHERE event_id % 29 = 0 AND event_id % 23 <> 0",
    "SELECT 'error', 'invalid_type', 'pc:count', count(*) FROM e WHERE event_id % 23 = 0",
    *(f"SELECT 'warning', 'missing_recommended', '{f}', count(*) FROM e" for f in quality.RECOMMENDED),
    "SELECT 'warning', 'missing_data_asset', NULL, count(*) FROM e WHERE event_id % 31 = 0",
    "SELECT 'warning', 'non_standard_value', 'pc:type', count(*) FROM e WHERE event_id % 37 = 5",
))


@query("validate_pointcloud", f"WITH {_PC} {_PC_SQL}")
def validate_pointcloud(spark, sf_dir):
    issues = quality.validate_pointcloud(item_docs(spark, sf_dir))
    return issues.groupBy("severity", "kind", "field").agg(F.count("*").alias("n"))


_REPORT_SQL = f"""WITH {_PC}, i AS ({_PC_SQL}), r AS (
  SELECT 'pointcloud' AS "check", FALSE AS valid, CAST(sum(n) FILTER (WHERE severity = 'error') AS BIGINT) AS errors, CAST(sum(n) FILTER (WHERE severity = 'warning') AS BIGINT) AS warnings FROM i
  UNION ALL SELECT 'locations', TRUE, 0, 0)
SELECT * FROM r UNION ALL SELECT 'overall', FALSE, CAST(sum(errors) AS BIGINT), CAST(sum(warnings) AS BIGINT) FROM r"""


@query("validation_report", _REPORT_SQL)
def validation_report(spark, sf_dir):
    return quality.validation_report(quality.validate_pointcloud(item_docs(spark, sf_dir)), ("pointcloud", "locations"))


@query("report_roundtrip", _REPORT_SQL)
def report_roundtrip(spark, sf_dir):
    path = scratch_dir(spark, "report")
    quality.write_report(validation_report(spark, sf_dir), path)
    return spark.read.schema("check string, valid boolean, errors bigint, warnings bigint").json(path)


@query("validate_raster", f"""WITH {CELLS} SELECT count(*) AS cells, max(width) * max(height) AS expected, TRUE AS "unique", TRUE AS inside, TRUE AS sized,
 count(*) = max(width) * max(height) AS complete FROM cells, hdr""")
def validate_raster(spark, sf_dir):
    grid = raster.header_bbox(header(spark, sf_dir, RES))
    return quality.validate_raster(grid, cells(spark, sf_dir, RES)).drop("raster_id")


# --- files ------------------------------------------------------------------------------


@query("read_documents", """SELECT 'Catalog' AS type, count(*) + 1 AS n FROM region UNION ALL SELECT 'Collection', count(*) FROM nation
UNION ALL SELECT 'Feature', count(*) FROM supplier UNION ALL SELECT NULL, count(*) FROM region""")
def read_documents(spark, sf_dir):
    docs = tree_docs(spark, sf_dir)
    bad = docs.filter("path LIKE 'r-_/r-_.json'").select(F.concat("path", F.lit(".bad")).alias("path"), F.substring("doc", 1, 25).alias("doc"))
    root = scratch_dir(spark, "docs")
    render.write_files(docs.select("path", "doc").unionByName(bad).select(F.col("doc").alias("value"), F.md5("path").alias("k")), root, "k")
    return documents.read_documents(spark, root, glob="*.txt").groupBy("type").agg(F.count("*").alias("n"))


@query("read_processing_metadata", f"""WITH {META} SELECT count(*) FILTER (WHERE error IS NULL) AS ok, count(error) AS failed, CAST(sum(point_count) AS BIGINT) AS points, round(max(z1) + {NUDGE},4) AS top FROM v_meta""")
def read_processing_metadata(spark, sf_dir):
    root = scratch_dir(spark, "meta")
    meta(spark, sf_dir).write.json(root)
    read = documents.read_processing_metadata(spark, root, glob="*.json", multi_line=False)
    return read.agg(
        F.count_if(F.col("error").isNull()).alias("ok"), F.count("error").alias("failed"),
        F.sum("point_count").alias("points"), F.round(F.max(F.col("bbox")[5]) + NUDGE, 4).alias("top"),
    )


@query("read_raster_metadata", f"""WITH {META} SELECT dem_type, count(*) AS n FROM v_meta WHERE error IS NULL GROUP BY 1""")
def read_raster_metadata(spark, sf_dir):
    root = scratch_dir(spark, "rastermeta")
    _raster_meta(spark, sf_dir).unionByName(meta(spark, sf_dir).drop("dem_type"), allowMissingColumns=True).write.json(root)
    read = documents.read_raster_metadata(spark, root, glob="*.json", multi_line=False)
    return read.groupBy("dem_type").agg(F.count("*").alias("n"))


@query("run_summary_file", f"""WITH {META} SELECT count(*) AS total_files, count(error) AS failed, CAST(sum(point_count) FILTER (WHERE error IS NULL) AS BIGINT) AS total_points FROM v_meta""")
def run_summary_file(spark, sf_dir):
    from ..operators.catalog_build import write_run_summary

    path = scratch_dir(spark, "summary")
    write_run_summary(meta(spark, sf_dir), path)
    return spark.read.schema("total_files bigint, failed bigint, total_points bigint").json(path)


@query("points_override_epsg", f"""WITH {POINTS} SELECT CASE WHEN Classification = 7 THEN 6677 ELSE 6676 END AS epsg, count(*) AS points, round(max(Z),6) AS max_z FROM v_points GROUP BY 1""")
def points_override_epsg(spark, sf_dir):
    path = scratch_dir(spark, "points")
    cloud = points(spark, sf_dir).withColumn("epsg", F.when(F.col("Classification") != 7, F.col("epsg")))
    tables.write_points(cloud.drop("gps_time"), path)
    return tables.read_points(spark, path, override_epsg=6677).groupBy("epsg").agg(
        F.count("*").alias("points"), F.round(F.max("Z"), 6).alias("max_z"))


@query("bounded_read", f"""WITH {POINTS} SELECT source_file, count(*) AS points, round(min(X),6) AS min_x, round(max(Y),6) AS max_y FROM v_points
WHERE X BETWEEN 51300 AND 51340 AND Y BETWEEN -49100 AND -49060 GROUP BY 1""")
def bounded_read(spark, sf_dir):
    path = scratch_dir(spark, "clustered")
    tables.write_clustered(points(spark, sf_dir).drop("gps_time"), path)
    return tables.read_points(spark, path, bbox=(51300, -49100, 51340, -49060)).groupBy("source_file").agg(
        F.count("*").alias("points"), F.round(F.min("X"), 6).alias("min_x"), F.round(F.max("Y"), 6).alias("max_y"))


@query("raster_window", f"""WITH {CELLS} SELECT "row", col, round(value,6) AS value, CAST(4 AS DOUBLE) AS area FROM cells WHERE "row" BETWEEN 40 AND 90 AND col BETWEEN 50 AND 140""")
def raster_window(spark, sf_dir):
    path = scratch_dir(spark, "raster")
    tables.write_raster(cells(spark, sf_dir, RES), header(spark, sf_dir, RES), path, block=64)
    stored, grid = tables.read_raster(spark, path)
    area = raster.cell_area(grid).select("cell_area").scalar()
    window = tables.block_window(stored, (40, 90), (50, 140), block=64)
    return window.select("row", "col", F.round("value", 6).alias("value")).withColumn("area", area)


@query("manifest", f"WITH {POINTS} SELECT DISTINCT 'https://example.org/data/' || source_file || '.copc.laz' AS href FROM v_points")
def manifest(spark, sf_dir):
    path = scratch_dir(spark, "manifest")
    hrefs = points(spark, sf_dir).select("source_file").distinct().select(
        F.concat(F.lit("https://example.org/data/"), "source_file", F.lit(".copc.laz")).alias("href"))
    documents.write_manifest(hrefs, path)
    return documents.read_manifest(spark, path)


@query("discover_inputs", """SELECT DISTINCT 'in/' || CAST(p_partkey AS VARCHAR) || '.copc.LAZ' AS path FROM part WHERE p_size % 5 = 0""")
def discover_inputs(spark, sf_dir):
    key = F.concat(F.lit("in/"), F.col("p_partkey").cast("string"))
    ending = F.when(F.col("p_size") % 5 == 0, ".copc.LAZ").when(F.col("p_size") % 5 == 1, ".las").otherwise(".txt")
    part = table(spark, sf_dir, "part").select(F.concat(key, ending).alias("path"))
    return documents.discover_inputs(part.unionByName(part))


# --- the live index ---------------------------------------------------------------------

_EVENTS = f"""ev AS (SELECT user_id, ts, value, event_type, event_id FROM events),
last AS (SELECT user_id, max((ts, event_type = 'error', event_id)) AS m FROM ev GROUP BY user_id)"""


def _changes(spark, sf_dir):
    """Each user's document is written by every event and removed by 'error' events."""
    e = table(spark, sf_dir, "events")
    doc = F.to_json(F.struct(F.lit("Feature").alias("type"), F.concat(F.lit("u-"), F.col("user_id").cast("string")).alias("id"),
                             F.struct(F.col("event_id").cast("string").alias("title")).alias("properties")))
    return e.select(
        F.concat(F.lit("u/"), F.col("user_id").cast("string"), F.lit(".json")).alias("key"),
        F.when(F.col("event_type") == "error", "ObjectRemoved:Delete").otherwise("ObjectCreated:Put").alias("event"),
        F.col("ts").cast("timestamp").alias("event_time"), doc.alias("doc"),
    )


_LIVE = f"""WITH {_EVENTS} SELECT 'u-' || CAST(user_id AS VARCHAR) AS id, CAST(m[3] AS VARCHAR) AS title FROM last WHERE NOT m[2]"""


@query("apply_events", _LIVE)
def apply_events(spark, sf_dir):
    changes = _changes(spark, sf_dir)
    old = changes.select("key").distinct().withColumn("doc", F.lit('{"type":"Feature","id":"old"}'))
    # every event is delivered twice
    now = live.apply_events(old, changes.unionByName(changes))
    docs = now.select(F.col("key").alias("path"), "doc", documents.document_type(F.col("doc")).alias("type"))
    return documents.flatten_items(docs).select("id", "title")


@query("upsert_index", _LIVE)
def upsert_index(spark, sf_dir):
    """The same changes through the stream, several batches, with a compaction in between."""
    source, index, check = (scratch_dir(spark, n) for n in ("changes", "index", "check"))
    _changes(spark, sf_dir).repartition(4).write.parquet(source)

    def feed():
        stream = spark.readStream.schema(live.CHANGES).option("maxFilesPerTrigger", 2).parquet(source)
        live.upsert_index(stream, index, check).awaitTermination()

    feed()
    live.compact(spark, index)
    _changes(spark, sf_dir).filter("event LIKE 'ObjectRemoved%'").coalesce(1).write.mode("append").parquet(source)
    feed()
    return documents.flatten_items(live.current_documents(spark, index)).select("id", "title")


_SUPPLIERS = "SELECT 's-' || CAST(s_suppkey AS VARCHAR) AS id, s_name AS title FROM supplier"


def _files(spark, sf_dir):
    root = scratch_dir(spark, "files")
    render.write_documents(render.render_documents(_supplier_items(spark, sf_dir)), root)
    return root


@query("document_bundles", _SUPPLIERS)
def document_bundles(spark, sf_dir):
    root = scratch_dir(spark, "bundles")
    render.write_bundles(render.render_documents(_supplier_items(spark, sf_dir)), root)
    return documents.flatten_items(documents.read_bundles(spark, root)).select("id", "title")


@query("stream_ingest", _SUPPLIERS)
def stream_ingest(spark, sf_dir):
    root, index, check = _files(spark, sf_dir), scratch_dir(spark, "index"), scratch_dir(spark, "check")
    stream = live.stream_documents(spark, root, glob="*.txt", ending=".txt")
    live.upsert_index(stream, index, check).awaitTermination()
    return documents.flatten_items(live.current_documents(spark, index)).select("id", "title")


@query("full_reindex", _SUPPLIERS)
def full_reindex(spark, sf_dir):
    root, index = _files(spark, sf_dir), scratch_dir(spark, "index")
    live.append_changes(_changes(spark, sf_dir), 0, index)
    live.reindex(spark, root, index, glob="*.txt", ending=".txt")
    return documents.flatten_items(live.current_documents(spark, index)).select("id", "title")


_WARP_RES = 0.0001


@query("warp", f"""WITH {CELLS}, src AS (
  SELECT minx - 1 AS x0, miny - 1 AS y0, minx - 1 + width * 2::DOUBLE AS x1, miny - 1 + height * 2::DOUBLE AS y1, 6676 AS code, minx, miny, width, height FROM hdr),
cn AS (SELECT x0 AS px, y0 AS py, code FROM src UNION ALL SELECT x1, y0, code FROM src UNION ALL SELECT x1, y1, code FROM src UNION ALL SELECT x0, y1, code FROM src),
{inverse_sql('px', 'py', 'cn', 'code', 'code', 'w')},
box AS (SELECT min(lon) + {_WARP_RES / 2}::DOUBLE AS ox, min(lat) + {_WARP_RES / 2}::DOUBLE AS oy, CAST(ceil((max(lon) - min(lon)) / {_WARP_RES}::DOUBLE) AS BIGINT) AS w,
  CAST(ceil((max(lat) - min(lat)) / {_WARP_RES}::DOUBLE) AS BIGINT) AS h FROM wgeo),
target AS (
  SELECT r.i AS trow, c.i AS tcol, ox + c.i * {_WARP_RES}::DOUBLE AS tlon, oy + (h - 1 - r.i) * {_WARP_RES}::DOUBLE AS tlat
  FROM box, LATERAL (SELECT unnest(range(0, h)) AS i) r, LATERAL (SELECT unnest(range(0, w)) AS i) c),
{forward_sql('tlon', 'tlat', 'target', 6676, 'trow, tcol', 't')},
spot AS (SELECT trow, tcol, (x - minx) / 2::DOUBLE AS fx, height - 1 - (y - miny) / 2::DOUBLE AS fy FROM tplane, hdr),
corner AS (
  SELECT trow, tcol, CAST(floor(fy) AS BIGINT) + j AS r, CAST(floor(fx) AS BIGINT) + i AS c,
    (CASE WHEN i = 1 THEN fx - floor(fx) ELSE 1 - (fx - floor(fx)) END) * (CASE WHEN j = 1 THEN fy - floor(fy) ELSE 1 - (fy - floor(fy)) END) AS wt
  FROM spot, (SELECT unnest([0, 1]) AS i), (SELECT unnest([0, 1]) AS j))
SELECT trow AS "row", tcol AS col, round(sum(wt * value) / sum(wt), 4) AS value
FROM corner JOIN cells ON cells."row" = corner.r AND cells.col = corner.c WHERE wt > 0 GROUP BY 1, 2""")
def warp(spark, sf_dir):
    dem, grid = cells(spark, sf_dir, RES), header(spark, sf_dir, RES)
    return raster.warp(dem, grid, 6676, 4326, _WARP_RES).select("row", "col", F.round("value", 4).alias("value"))


_DEGREES = (139.0662, 35.5560, 139.0682, 35.5585)


@query("crop_degrees", f"""WITH {POINTS}, corner AS (
  SELECT unnest([{_DEGREES[0]}::DOUBLE, {_DEGREES[2]}::DOUBLE, {_DEGREES[2]}::DOUBLE, {_DEGREES[0]}::DOUBLE]) AS clon,
    unnest([{_DEGREES[1]}::DOUBLE, {_DEGREES[1]}::DOUBLE, {_DEGREES[3]}::DOUBLE, {_DEGREES[3]}::DOUBLE]) AS clat),
{forward_sql('clon', 'clat', 'corner', 6676, 'clon', 'd')},
box AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1 FROM dplane)
SELECT source_file, count(*) AS points, round(min(X),6) AS min_x, round(max(Y),6) AS max_y FROM v_points, box
WHERE X BETWEEN x0 AND x1 AND Y BETWEEN y0 AND y1 GROUP BY source_file""")
def crop_degrees(spark, sf_dir):
    inside = crop(points(spark, sf_dir), _DEGREES, bbox_crs="auto")
    return inside.groupBy("source_file").agg(
        F.count("*").alias("points"), F.round(F.min("X"), 6).alias("min_x"), F.round(F.max("Y"), 6).alias("max_y"))
