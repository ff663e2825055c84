"""Near-duplicate embeddings by NN-descent.

Equal vectors of a label are one node. A first graph links neighbours along a few random directions; then each round every
node introduces its neighbours (and those that name it) to each other, and all keep the best they have met. Links are
the pairs at or above the threshold, checked in double precision. Where a list is full of links it is saturated: it
grows to the node's whole component, which is compared in blocks that give counts and not pairs. An
audit holds a fixed sample of vectors against all rows; too low a recall means longer lists and more rounds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import stored

THRESHOLD = 0.98
NEIGHBOURS, DIRECTIONS, ROUNDS = 10, 4, 4
#: Nodes of a component that meet in one block; vectors that the audit holds against all rows; the recall it asks for.
BLOCK, AUDITED, RECALL = 512, 256, 0.97
#: Float sums of the descent are this far off at most; pairs are checked again in doubles.
SLACK = 1e-4


def _matrix(column: pa.Array, kind=np.float64) -> np.ndarray:
    """Rows of equal length as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), -1)


def classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows, nodes): each row of vectors (vec_id, embedding, label) with its node or null; a unit vector for each node.

    The group of a node is its label and dimension; only vectors of one group are compared.
    """
    doubles = F.col("embedding").cast("array<double>")
    sound = F.col("embedding").isNotNull() & F.col("label").isNotNull() & F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    sound = F.coalesce(sound, F.lit(False)) & F.exists(doubles, lambda x: x != 0)
    # -0.0 and 0.0 are one number.
    vec = F.when(F.coalesce(sound, F.lit(False)), F.transform(doubles, lambda x: x + F.lit(0.0)))
    rows = vectors.select("vec_id", F.concat_ws(":", F.col("label"), F.size("embedding")).alias("group"), vec.alias("vec"))
    rows = rows.withColumn("node", F.when(F.col("vec").isNotNull(), F.xxhash64("group", "vec")))
    rows = stored(rows, "rows")
    # The largest component first, so that squares neither overflow nor vanish.
    most = F.array_max(F.transform("vec", lambda x: F.abs(x)))
    nodes = rows.filter("node is not null").groupBy("node", "group", "vec").agg(F.min("vec_id").alias("least_id"), F.count("*").alias("rows"))
    nodes = nodes.withColumn("most", most).withColumn("vec", F.transform("vec", lambda x: x / F.col("most")))
    length = F.sqrt(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x))
    nodes = nodes.withColumn("length", length).withColumn("vec", F.transform("vec", lambda x: x / F.col("length")))
    return rows.select("vec_id", "node"), stored(nodes.select("node", "group", "least_id", "rows", "vec"), "nodes")


def _along(nodes: DataFrame, direction: int, reach: int) -> DataFrame:
    """(a, b, sim): each node and the next ones along a random direction, within its group.

    Ranges of (group, place) are dealt out, so a large group is many tasks; what a border cuts off other directions find.
    """
    noise = lambda x, i: x * (F.pmod(F.xxhash64(i, F.lit(direction)), F.lit(2001)) - 1000)
    place = F.aggregate(F.transform("vec", noise), F.lit(0.0), lambda s, x: s + x)
    placed = nodes.select("node", "group", F.col("vec").cast("array<float>").alias("vec"), place.alias("place"))

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, str, np.ndarray]] = []
        for batch in batches:
            found = []
            for node, group, vec in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                own = vec.values.to_numpy()
                found += [(node, n, float(v @ own)) for n, g, v in held if g == group]
                held = [*held[-(reach - 1) :], (node, group, own)]
            yield pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], type=t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))], names=["a", "b", "sim"])

    return placed.repartitionByRange("group", "place").sortWithinPartitions("group", "place").select("node", "group", "vec").mapInArrow(link, "a bigint, b bigint, sim double")


def _both(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b", "sim").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"), "sim"))


def _best(edges: DataFrame, k: int) -> DataFrame:
    """The k most alike neighbours of each node."""
    rank = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("sim"), "b"))
    once = edges.groupBy("a", "b").agg(F.max("sim").alias("sim"))
    return once.withColumn("rank", rank).filter(F.col("rank") <= k).drop("rank")


def _introduce(graph: DataFrame, nodes: DataFrame, k: int) -> DataFrame:
    """Neighbours of neighbours: at each node its list and as many of those that name it meet; each keeps its k best there."""
    naming = graph.select(F.col("b").alias("a"), F.col("a").alias("b"))
    some = F.row_number().over(Window.partitionBy("a").orderBy(F.xxhash64("a", "b")))
    naming = naming.withColumn("rank", some).filter(F.col("rank") <= k).drop("rank")
    meeting = graph.select("a", "b").unionByName(naming).distinct()
    vectors = nodes.select(F.col("node").alias("b"), F.col("vec").cast("array<float>").alias("vec"))
    rooms = meeting.join(vectors.hint("merge"), "b").groupBy("a").agg(F.collect_list("b").alias("who"), F.collect_list("vec").alias("vecs"))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, sims = [], [], []
            for who, vecs in zip(batch.column(0), batch.column(1)):
                if len(who) < 2:
                    continue
                ids = who.values.to_numpy()
                m = _matrix(vecs.values, np.float32)
                sim = m @ m.T
                np.fill_diagonal(sim, -2)
                top = np.argsort(-sim, axis=1)[:, : min(k, len(ids) - 1)]
                a.append(np.repeat(ids, top.shape[1]))
                b.append(ids[top.ravel()])
                sims.append(np.take_along_axis(sim, top, 1).ravel())
            if a:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a)), pa.array(np.concatenate(b)), pa.array(np.concatenate(sims).astype(np.float64))], names=["a", "b", "sim"])

    return rooms.select("who", "vecs").mapInArrow(meet, "a bigint, b bigint, sim double")


def descend(nodes: DataFrame, k: int, directions: int, rounds: int) -> DataFrame:
    """(a, b, sim): about the k nearest neighbours of each node within its group."""
    first = _along(nodes, 0, k)
    for d in range(1, directions):
        first = first.unionByName(_along(nodes, d, k))
    graph = stored(_best(_both(first), k), "graph")
    total = graph.agg(F.sum("sim")).first()[0] or 0.0
    for _ in range(rounds):
        graph = stored(_best(_introduce(graph, nodes, k).unionByName(graph), k), "graph")
        now = graph.agg(F.sum("sim")).first()[0] or 0.0
        if now - total <= 1e-3 * abs(now):
            break
        total = now
    return graph


def _links(graph: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose cosine in doubles reaches the threshold."""
    pairs = graph.filter(F.col("sim") >= threshold - SLACK).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    left = nodes.select(F.col("node").alias("a"), F.col("vec").alias("u"))
    right = nodes.select(F.col("node").alias("b"), F.col("vec").alias("v"))
    cosine = F.aggregate(F.zip_with("u", "v", lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)
    return pairs.join(left, "a").join(right, "b").filter(cosine >= threshold).select("a", "b")


def _counted(rooted: DataFrame, nodes: DataFrame, threshold: float) -> DataFrame:
    """node, links: rows linked to each node of a component. Blocks of a component meet in pairs; only counts leave them."""
    sizes = stored(rooted.groupBy("root").agg(F.ceil(F.count("*") / BLOCK).alias("blocks")), "sizes")
    members = rooted.join(sizes, "root").join(nodes.select("node", "rows", "vec"), "node")
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    dealt = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1)))
    dealt = dealt.select("root", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "rows", "vec")

    def count(key: tuple, table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        block, nodes_, rows = (table.column(c).to_numpy() for c in ("own", "node", "rows"))
        vec = _matrix(table.column("vec").combine_chunks())
        links = (vec @ vec.T >= threshold) if i == j else (vec @ vec.T >= threshold) & (block[:, None] != block[None, :])
        np.fill_diagonal(links, False)
        return pa.table({"node": pa.array(nodes_), "links": pa.array((links @ rows).astype(np.int64))})

    return dealt.groupBy("root", "i", "j").applyInArrow(count, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("links"))


def recall(nodes: DataFrame, counted: DataFrame, threshold: float, audited: int = AUDITED) -> float:
    """Share of the links of a fixed number of nodes (by hash) that were found; each is held against all nodes of its group."""
    sample = nodes.orderBy(F.xxhash64("node", F.lit("audit")), "node").limit(audited).select("node", "group", "vec").collect()
    if not sample:
        return 1.0
    ids, groups = np.array([r.node for r in sample]), np.array([r.group for r in sample])
    held = {g: (ids[groups == g], np.array([r.vec for r in sample if r.group == g])) for g in set(groups)}

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            group, node, rows = (np.array(batch.column(k).to_pylist()) for k in range(3))
            for g in set(group):
                if g in held:
                    at = np.flatnonzero(group == g)
                    who, vec = held[g]
                    hits = (vec @ _matrix(batch.column(3).take(pa.array(at))).T >= threshold) & (who[:, None] != node[at][None, :])
                    yield pa.RecordBatch.from_arrays([pa.array(who), pa.array((hits @ rows[at]).astype(np.int64))], names=["node", "links"])

    true = nodes.select("group", "node", "rows", "vec").mapInArrow(look, "node bigint, links bigint").groupBy("node").agg(F.sum("links").alias("true"))
    both = true.join(counted, "node", "left").agg(F.sum("true"), F.sum(F.least(F.coalesce("links", F.lit(0)), F.col("true")))).first()
    return both[1] / both[0] if both[0] else 1.0


def near_duplicates(vectors: DataFrame, threshold: float = THRESHOLD, k: int = NEIGHBOURS, least_recall: float = RECALL) -> DataFrame:
    """vec_id, n_links, component_id, kept for each row of ``vectors`` (vec_id, embedding, label; other columns are ignored).

    Vectors link within a label (and dimension) at a cosine of at least ``threshold``. Null label; null, empty or zero vector; null
    or non-finite component: no links, a component of its own. Repeated rows and copies link with each other; of several rows with
    one vec_id each is counted. An empty table gives no rows.
    """
    rows, nodes = classes(vectors)
    for attempt in range(3):
        graph = descend(nodes, k << attempt, DIRECTIONS + 2 * attempt, ROUNDS + attempt)
        links = stored(_links(graph, nodes, threshold), "links")
        rooted = stored(components(links), "rooted")
        counted = stored(_counted(rooted, nodes, threshold), "counted")
        if recall(nodes, counted, threshold) >= least_recall:
            break
    ids = nodes.select("node", "least_id", "rows")
    least = rooted.join(ids.select("node", "least_id"), "node").groupBy("root").agg(F.min("least_id").alias("component_id"))
    found = rooted.join(least, "root").join(counted, "node").select("node", "component_id", "links")
    told = ids.join(found, "node", "left").select(
        F.col("node").alias("t_node"), (F.col("rows") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("component_id", "least_id").alias("component_id"))
    out = rows.join(stored(told, "told"), F.col("node") == F.col("t_node"), "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
