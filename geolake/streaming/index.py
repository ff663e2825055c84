"""A change log of documents that readers see as one current index.

Layout below one folder: ``log-*`` folders hold the changes of a batch each, ``base-*`` a
compacted state, and ``commits/N`` the N-th list of what is visible. Whoever wants to change
the list writes its own folder first and then makes the next commit, if nobody else has;
otherwise it looks at the new list and tries again, so several writers can work on one index
and none loses a batch. A batch costs what it brings, not what the index holds; readers take
the last commit, so they never see half a batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import documents, files

CREATED, REMOVED = "ObjectCreated", "ObjectRemoved"
CHANGES = "key string, event string, event_time timestamp, doc string"


def stream_documents(spark: SparkSession, root: str, glob: str = "*.json", per_batch: int | None = None,
                     ending: str = ".json") -> DataFrame:
    """Indexable documents as they appear below a folder, as change rows."""
    reader = (
        spark.readStream.format("text").option("wholetext", True).option("recursiveFileLookup", True)
        .option("pathGlobFilter", glob)
    )
    if per_batch:
        reader = reader.option("maxFilesPerTrigger", per_batch)
    files.limit_listings(spark)  # and left so: the stream lists by the session's settings whenever it looks for files
    raw = reader.load(root)
    rows = raw.select(
        documents.relative_key(F.col("_metadata.file_path"), root).alias("key"),
        F.lit(CREATED).alias("event"),
        F.col("_metadata.file_modification_time").alias("event_time"),
        F.col("value").alias("doc"),
    )
    return documents.list_objects(rows, "key", ending=ending)


def latest(changes: DataFrame) -> DataFrame:
    """The last change per key by event time; a removal wins over a creation at one instant.

    Each task keeps the winner among its own rows of a key before anything moves, so a key with
    very many events costs one document per task.
    """
    removed = F.startswith(F.col("event"), F.lit(REMOVED))
    stamp = F.struct(F.col("event_time").alias("t"), removed.alias("r"), F.xxhash64("doc").alias("h"))
    best = changes.groupBy("key").agg(F.max_by(F.struct("event", "event_time", "doc"), stamp).alias("_b"))
    return best.select("key", "_b.event", "_b.event_time", "_b.doc")


def apply_events(index: DataFrame, events: DataFrame) -> DataFrame:
    """Index rows after a log of events: removed keys go, created ones replace.

    Repeated and late deliveries change nothing, since only the last event of a key counts.
    """
    last = latest(events)
    made = last.filter(F.startswith(F.col("event"), F.lit(CREATED)))
    kept = index.join(last.select("key"), "key", "left_anti")
    return kept.select("key", "doc").unionByName(made.select("key", "doc"))


def _last_commit(spark: SparkSession, index_dir: str) -> tuple[int, dict]:
    """Number and content of the last commit: base folder, log folders in order, last batch of each source."""
    found = [int(n) for n in files.names(spark, f"{index_dir}/commits") if n.isdigit()]
    if not found:
        return -1, {"base": None, "logs": [], "seen": {}}
    return max(found), json.loads(files.read_small(spark, f"{index_dir}/commits/{max(found):012d}"))


def _commit(spark: SparkSession, index_dir: str, change: Callable[[dict], dict | None]) -> bool:
    """Make the list that ``change`` makes of the last one the next commit; again if another writer was faster.

    ``change`` answers None where nothing is to be done any more.
    """
    while True:
        number, state = _last_commit(spark, index_dir)
        wanted = change(state)
        if wanted is None:
            return False
        if files.create_small(spark, f"{index_dir}/commits/{number + 1:012d}", json.dumps(wanted)):
            return True


def append_changes(changes: DataFrame, batch: int, index_dir: str, source: str | None = None) -> None:
    """Make one batch of changes visible.

    Batches are numbered within their ``source``, and one that is not beyond the last of its source is left out, as a replay.
    Without a source nothing is left out; a change that comes twice changes nothing.
    """
    spark = changes.sparkSession
    name = f"log-{uuid.uuid4().hex}"

    def replayed(state: dict) -> bool:
        return source is not None and batch <= state["seen"].get(source, -1)

    def add(state: dict) -> dict | None:
        if replayed(state):
            return None
        seen = state["seen"] if source is None else {**state["seen"], source: batch}
        return {**state, "logs": [*state["logs"], name], "seen": seen}

    if replayed(_last_commit(spark, index_dir)[1]):
        return
    changes.select("key", "event", "event_time", "doc").write.parquet(f"{index_dir}/{name}")
    _commit(spark, index_dir, add)


def upsert_index(stream: DataFrame, index_dir: str, checkpoint: str):
    """Start a query that feeds the log with everything available, then stops.

    A checkpoint names its query; a new one counts its batches anew. Several queries can write to one index.
    """

    def append(df: DataFrame, batch: int) -> None:
        named = files.read_small(df.sparkSession, f"{checkpoint}/metadata")
        append_changes(df, batch, index_dir, json.loads(named)["id"])

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _changes_of(spark: SparkSession, index_dir: str, state: dict) -> DataFrame:
    folders = [f"{index_dir}/{n}" for n in (state["base"], *state["logs"]) if n]
    return spark.read.schema(CHANGES).parquet(*folders) if folders else spark.createDataFrame([], CHANGES)


def current_changes(spark: SparkSession, index_dir: str) -> DataFrame:
    return _changes_of(spark, index_dir, _last_commit(spark, index_dir)[1])


def current_documents(spark: SparkSession, index_dir: str) -> DataFrame:
    """path, doc, type of every live document."""
    live = latest(current_changes(spark, index_dir)).filter(F.startswith(F.col("event"), F.lit(CREATED)))
    return live.select(
        F.col("key").alias("path"), "doc", documents.document_type(F.col("doc")).alias("type")
    )


def _new_base(spark: SparkSession, index_dir: str, rows: DataFrame, state: dict) -> bool:
    """``rows`` in place of what ``state`` lists; batches that came since stay. Given up if the base has changed since."""
    name = f"base-{uuid.uuid4().hex}"
    rows.select("key", "event", "event_time", "doc").write.parquet(f"{index_dir}/{name}")

    def swap(now: dict) -> dict | None:
        if now["base"] != state["base"]:
            return None
        return {**now, "base": name, "logs": [n for n in now["logs"] if n not in set(state["logs"])]}

    return _commit(spark, index_dir, swap)


def compact(spark: SparkSession, index_dir: str) -> bool:
    """Fold base and log into a new base. Removed keys stay as short rows, so that late events do not bring them back."""
    _, state = _last_commit(spark, index_dir)
    return _new_base(spark, index_dir, latest(_changes_of(spark, index_dir, state)), state)


def reindex(spark: SparkSession, root: str, index_dir: str, glob: str = "*.json", ending: str = ".json") -> bool:
    """Full rebuild from the files: the batch path of the same index."""
    _, state = _last_commit(spark, index_dir)
    raw = documents.whole_texts(spark, root, glob)
    rows = documents.list_objects(raw.select(
        documents.relative_key(F.col("_metadata.file_path"), root).alias("key"), F.lit(CREATED).alias("event"),
        F.col("_metadata.file_modification_time").alias("event_time"), F.col("value").alias("doc"),
    ), "key", ending=ending)
    return _new_base(spark, index_dir, rows, state)


def index_health(items: DataFrame, collections: DataFrame, time: Column | None = None) -> DataFrame:
    """Rows per index and the newest time in the item index."""
    newest = F.max("datetime") if time is None else F.max(time)
    return items.agg(F.count("*").alias("items"), newest.alias("newest")).withColumn(
        "collections", collections.agg(F.count("*").alias("n")).scalar()
    )
