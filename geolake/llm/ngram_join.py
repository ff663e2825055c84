"""N-gram Jaccard join through prefix trees.

1. Words are counted in a sketch of fixed size over all texts; the global order of shingles goes by the count of their
   rarest word, ties by hash.
2. Texts with equal sets are one node. A set's front (by that order) is long enough that two sets that link share
   a shingle in their fronts. Shingles that stand in one front only can't join anything and go.
3. A node's home is the first of its shared front shingles. A node visits the homes that its front leads to, each pair in
   one direction, so texts that share much meet once and not once for each shingle. A shingle leads to no home whose nodes
   hold it too late in their order to reach the overlap that a link needs.
4. Parities meet first: a bit for each of about as many cells as a set has shingles, which tells if an odd number of them
   falls into the cell. Two sets differ in at least as many shingles as their parities differ in bits, so only nodes whose
   parities leave a link possible send their whole sets. At each home a prefix tree holds the sets of the nodes at home, common shingles first. Every visitor walks it: overlaps
   are counted once for all sets below an edge, and a branch ends when the shingles left can't make the overlap that a link
   needs, or when all below it is already joined to the visitor.
5. Large homes are dealt out in parts, their visitors in chunks. All visit the first part; a large group of near copies
   is then joined already, and only nodes outside it meet the other parts.
6. The links found make the components.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .components import components
from .shared import forget, lower_ascii, slices, stored, words

SHINGLE, PERCENT = 3, 90
#: Counters of the word sketch (one byte each once combined), the blocks they travel in, nodes at home in one tree.
CELLS, BLOCK, HOME = 1 << 22, 1 << 12, 256
#: Visitors of one tree in one group.
CHUNK = 1024
#: Words that a task counts at once.
SLICE = 1 << 18
#: Shingles of an edge that are compared before the bounds are looked at again.
STEP = 64


def word_hashes(docs: DataFrame, *columns) -> DataFrame:
    return docs.select(*columns, F.transform(words(lower_ascii(F.col("text"))), lambda w: F.xxhash64(w)).alias("_words"))


def word_levels(hashed: DataFrame, cells: int = CELLS) -> np.ndarray:
    """How common words are: for each cell of the sketch 4 x log2 of its count, at most 80. All texts count.

    Tasks add up their own cells and send them in blocks, capped at 255 for a task; the result has ``cells`` bytes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        total = np.zeros(cells, dtype=np.uint32)
        for batch in batches:
            values = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            for at in range(0, len(values), SLICE):
                np.add.at(total, values[at : at + SLICE] & (cells - 1), np.uint32(1))
        capped = np.minimum(total, 255, out=total).astype(np.uint8).reshape(-1, BLOCK)
        used = np.flatnonzero(capped.any(axis=1))
        yield pa.RecordBatch.from_arrays([pa.array(used, type=pa.int32()), pa.array([capped[k].tobytes() for k in used], type=pa.binary())], names=["block", "counts"])

    def add(key: tuple, table: pa.Table) -> pa.Table:
        total = np.zeros(BLOCK, dtype=np.int64)
        for counts in table.column("counts"):
            total += np.frombuffer(counts.as_py(), dtype=np.uint8)
        levels = np.minimum(4 * np.log2(np.maximum(total, 1)), 80).astype(np.uint8)
        return pa.table({"block": pa.array([key[0].as_py()], type=pa.int32()), "levels": pa.array([levels.tobytes()], type=pa.binary())})

    blocks = hashed.select("_words").mapInArrow(count, "block int, counts binary").groupBy("block").applyInArrow(add, "block int, levels binary")
    found = np.zeros((cells // BLOCK, BLOCK), dtype=np.uint8)
    for block, levels in blocks.collect():
        found[block] = np.frombuffer(levels, dtype=np.uint8)
    return found.ravel()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def shingle_set(hashes: np.ndarray, levels: np.ndarray, n: int) -> np.ndarray:
    """The distinct shingles of a text in the global order: 7 bits of level, 56 bits of hash below them."""
    if not len(hashes):
        return np.empty(0, dtype=np.int64)
    size = min(n, len(hashes))
    span = len(hashes) - size + 1
    # A shingle is at most as common as its rarest word.
    level, mixed = np.full(span, 127, dtype=np.uint8), np.full(span, size, dtype=np.uint64)
    own = levels[hashes & (len(levels) - 1)]
    raw = hashes.view(np.uint64)
    for k in range(size):
        level = np.minimum(level, own[k : k + span])
        mixed = _mixed(mixed * np.uint64(3) + raw[k : k + span])
    return np.unique(((level.astype(np.uint64) << np.uint64(56)) | (mixed >> np.uint64(8))).view(np.int64))


def set_name(own: np.ndarray) -> int:
    """64 bits of the sum of mixed shingles and of their number."""
    total = _mixed(own.view(np.uint64)).sum(keepdims=True) + np.uint64(len(own))
    return int(_mixed(total).view(np.int64)[0])


def needed(size: int, percent: int) -> int:
    """Least overlap of a set of that size with any set it links to."""
    return -(-percent * size // 100)


def _sets(batch: pa.RecordBatch, levels: np.ndarray, n: int) -> Iterator[np.ndarray]:
    column = batch.column(batch.num_columns - 1)
    offsets = column.offsets.to_numpy()  # a slice keeps all values, its offsets tell which are its own
    values = column.values.to_numpy(zero_copy_only=False)
    for k in range(len(column)):
        yield shingle_set(values[offsets[k] : offsets[k + 1]], levels, n)


def _longs(parts: list[np.ndarray]) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(p) for p in parts]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(parts) if parts else np.empty(0, np.int64)))


def parities(own: np.ndarray) -> bytes:
    """For each cell, the least power of two of them that isn't below the set's size (64 at least), the parity of its shingles."""
    width = max(64, 1 << (len(own) - 1).bit_length())
    return np.packbits((np.bincount(own & (width - 1), minlength=width) & 1).astype(np.uint8)).tobytes()


def folded(bits: np.ndarray, width: int) -> np.ndarray:
    """Parities in fewer cells."""
    while bits.shape[-1] > width:
        half = bits.shape[-1] // 2
        bits = bits[..., :half] ^ bits[..., half:]
    return bits


def may_link(sizes: np.ndarray, bits: list[bytes], at_home: np.ndarray, known: np.ndarray, percent: int) -> np.ndarray:
    """Which sets may link with one at home, or are at home and may link with another, as far as parities tell.

    Sets of one ``known`` component need no link.
    """
    marked, own = np.zeros(len(sizes), dtype=bool), [np.frombuffer(b, dtype=np.uint64) for b in bits]
    widths = np.array([len(b) for b in own])
    homes = {int(w): np.flatnonzero(at_home & (widths == w)) for w in np.unique(widths[at_home])}
    held = {(w, w): np.stack([own[k] for k in home]) for w, home in homes.items()}
    for k, mine in enumerate(own):
        for w, home in homes.items():
            close = (100 * np.minimum(sizes[home], sizes[k]) >= percent * np.maximum(sizes[home], sizes[k])) & (known[home] != known[k])
            if not close.any():
                continue
            width = min(w, len(mine))
            if (w, width) not in held:
                held[w, width] = folded(held[w, w], width)
            differ = np.bitwise_count(held[w, width] ^ folded(mine, width)).sum(axis=1, dtype=np.int64)
            hit = close & ((100 + percent) * differ <= (100 - percent) * (sizes[home] + sizes[k]))
            marked[k] |= hit.any()
            marked[home[hit]] = True
    return marked


class Tree:
    """A prefix tree of ordered sets; an edge holds the run of shingles that all sets below it share."""

    __slots__ = ("edge", "parts", "starts", "children", "ends", "members", "least", "most")

    def __init__(self, sets: list[np.ndarray], members: list[int], depth: int = 0):
        # The sets come sorted, so first and last tell what all have in common.
        first, last = sets[0], sets[-1]
        limit = min(len(first), len(last))
        differ = np.flatnonzero(first[depth:limit] != last[depth:limit])
        stop = depth + int(differ[0]) if len(differ) else limit
        self.edge = first[depth:stop]
        self.starts = list(range(0, len(self.edge), STEP))
        self.parts = [frozenset(self.edge[k : k + STEP].tolist()) for k in self.starts]
        self.members = members
        sizes = [len(s) for s in sets]
        self.least, self.most = min(sizes), max(sizes)
        self.ends = [m for m, s in zip(members, sizes) if s == stop]
        rest = [(s, m) for s, m in zip(sets, members) if len(s) > stop]
        self.children = []
        at = 0
        while at < len(rest):
            upto = at
            while upto < len(rest) and rest[upto][0][stop] == rest[at][0][stop]:
                upto += 1
            self.children.append(Tree([s for s, _ in rest[at:upto]], [m for _, m in rest[at:upto]], stop))
            at = upto


class Forest:
    def __init__(self, n: int):
        self.above = list(range(n))

    def root(self, k: int) -> int:
        while self.above[k] != k:
            self.above[k] = self.above[self.above[k]]
            k = self.above[k]
        return k

    def join(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.above[max(a, b)] = min(a, b)


def walk(tree: Tree, visitor: int, probe: np.ndarray, forest: Forest, percent: int) -> None:
    """Joins the visitor to every set of the tree it links to, unless both are joined already. Sets are in falling order."""
    own, size, falling = frozenset(probe.tolist()), len(probe), -probe
    stack = [(tree, 0, 0)]
    while stack:
        node, overlap, depth = stack.pop()
        if 100 * node.most < percent * size or 100 * size < percent * node.least:
            continue
        root = forest.root(visitor)
        if all(forest.root(m) == root for m in node.members):
            continue
        # With a set of n shingles, a link takes percent * (size + n) / (100 + percent) in common.
        least = -(-percent * (size + node.least) // (100 + percent))
        for start, part in zip(node.starts, node.parts):
            left = size - int(np.searchsorted(falling, -node.edge[start]))
            if overlap + min(left, node.most - depth - start) < least:
                break
            overlap += len(own & part)
        else:
            depth += len(node.edge)
            for m in node.ends:
                if 100 * overlap >= percent * (size + depth - overlap):
                    forest.join(visitor, m)
            stack += [(child, overlap, depth) for child in node.children]


def join_at_home(sets: list[np.ndarray], at_home: list[bool], percent: int, known: list[int] | None = None) -> list[tuple[int, int]]:
    """(member, least joined position) of the sets that a walk through the tree of those at home joins.

    Sets of one ``known`` component are joined from the start.
    """
    home = sorted((k for k in range(len(sets)) if at_home[k]), key=lambda k: sets[k].tolist(), reverse=True)
    if not home:
        return []
    tree, forest = Tree([sets[k] for k in home], home), Forest(len(sets))
    first: dict[int, int] = {}
    for k, component in enumerate(known or []):
        forest.join(k, first.setdefault(component, k))
    # Large sets first, copies of one text stand near each other in size.
    for k in sorted(range(len(sets)), key=lambda k: -len(sets[k])):
        walk(tree, k, sets[k], forest, percent)
    return [(k, forest.root(k)) for k in range(len(sets)) if forest.root(k) != k]


def jaccard_groups(docs: DataFrame, n: int = SHINGLE, percent: int = PERCENT, cells: int = CELLS, home: int = HOME) -> DataFrame:
    """One row for each row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id.

    A-Z is lower-cased; a text of fewer than n words is one shingle, one without words (or null) has none and links with
    nothing. Sets link when 100 x intersection >= percent x union; component_id is the least doc_id reachable. Rows with
    equal sets are one node whatever their number, so copies cost no pairs. Other columns are ignored; rows with
    one doc_id are documents of their own; a null doc_id never names a component but its own. No rows give no rows.
    """
    spark = docs.sparkSession
    levels = spark.sparkContext.broadcast(word_levels(word_hashes(docs), cells))

    def fronts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in slices(batches):
            nodes, sizes, found, bits = [], [], [], []
            for own in _sets(batch, levels.value, n):
                nodes.append(set_name(own) if len(own) else None)
                sizes.append(len(own))
                found.append(own[: len(own) - needed(len(own), percent) + 1] if len(own) else own)
                bits.append(parities(own) if len(own) else None)
            columns = [batch.column(0), pa.array(nodes, type=pa.int64()), pa.array(sizes, type=pa.int64()), _longs(found), pa.array(bits, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "node", "size", "front", "bits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    every = stored(word_hashes(docs, "doc_id").mapInArrow(fronts, f"doc_id {kind}, node bigint, size bigint, front array<bigint>, bits binary"), "fronts")
    named = every.filter("node is not null")
    classes = named.groupBy("node").agg(F.min("doc_id").alias("least_id"), F.first("size").alias("size"), F.count("*").alias("rows"), F.first("front").alias("front"), F.first("bits").alias("bits"))
    classes = stored(classes, "classes")

    per_shingle = F.count("*").over(Window.partitionBy("shingle"))
    shared = classes.select("node", "size", F.posexplode("front").alias("before", "shingle")).withColumn("n", per_shingle).filter("n > 1").drop("n")
    shared = stored(shared, "shared")
    homes = stored(shared.groupBy("node").agg(F.min("shingle").alias("home")), "homes")
    placed = shared.join(homes, "node")
    # Of the first shingle that two sets share: neither set has more in common than it holds from there on.
    room = F.col("size") * 100 - F.col("before") * (100 + percent)
    there = placed.groupBy("shingle", "home").agg(F.min("size").alias("low"), F.max(room).alias("room"))
    there = there.select(F.col("shingle").alias("t_shingle"), F.col("home").alias("t_home"), "low", "room")
    near = (F.col("room") >= F.col("size") * percent) & (room >= F.col("low") * percent)
    visits = placed.join(there, (F.col("shingle") == F.col("t_shingle")) & ((F.col("t_home") == F.col("home")) | (F.col("t_home") < F.col("home")) & near))
    visits = visits.groupBy("node", F.col("t_home").alias("place")).agg(F.first("home").alias("home"))
    visits = stored(visits.select("node", "place", (F.col("place") == F.col("home")).alias("at_home")), "visits")

    # Homes that hold and see one node are done. The first part of each home meets every visitor.
    crowd = visits.groupBy("place").agg(F.count_if("at_home").alias("held"), F.count("*").alias("seen")).filter("seen > 1")
    crowd = stored(crowd.select("place", F.ceil(F.col("held") / home).alias("parts"), F.ceil(F.col("seen") / CHUNK).alias("chunks")), "crowd")
    placed_part = F.when(F.col("at_home"), F.pmod(F.xxhash64("node"), F.col("parts")))
    around = stored(visits.join(crowd, "place").withColumn("own", placed_part).drop("at_home"), "around")
    opening = around.select("node", "place", F.when(F.col("own") == 0, F.lit(0)).cast("bigint").alias("own"), F.lit(1).cast("bigint").alias("parts"), "chunks", F.lit(True).alias("asks"))
    dealt = stored(_deal(opening), "dealt")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            # A doc_id that several rows share brings more than one text for a node; the text whose set it names stays.
            found = [(node, own) for node, own in zip(batch.column(0).to_pylist(), _sets(batch, levels.value, n)) if set_name(own) == node]
            yield pa.RecordBatch.from_arrays([pa.array([node for node, _ in found], type=pa.int64()), _longs([own for _, own in found])], names=["node", "shingles"])

    def sets_of(nodes: DataFrame) -> DataFrame:
        asked = nodes.distinct().join(classes.select("node", "least_id"), "node")
        # One document of a class gives its set; rows that share its doc_id fall out by the name of their own set.
        sample = every.select("doc_id", "node").join(asked, "node").filter("doc_id <=> least_id").select("node", "least_id").distinct()
        texts = docs.select("doc_id", "text").join(sample.hint("merge"), F.col("doc_id").eqNullSafe(F.col("least_id")))
        return stored(word_hashes(texts, "node").mapInArrow(whole, "node bigint, shingles array<bigint>").dropDuplicates(["node"]), "sets")

    members = ["node", "place", "known", "part", "at_home", "chunk"]

    def screen(table: pa.Table) -> pa.Table:
        size, at_home, known = (table.column(c).to_numpy() for c in ("size", "at_home", "known"))
        return table.select(members).filter(pa.array(may_link(size, table.column("bits").to_pylist(), at_home, known, percent)))

    def possible(rows: DataFrame) -> DataFrame:
        """The members of groups (place, part, chunk) that may link with another one."""
        brought = rows.select(*members).join(classes.select("node", "size", "bits"), "node")
        return stored(brought.groupBy("place", "part", "chunk").applyInArrow(screen, rows.select(*members).schema), "possible")

    def meet(key: tuple, table: pa.Table) -> pa.Table:
        nodes, known = table.column("node").to_numpy(), table.column("known").to_pylist()
        held = [s.values.to_numpy()[::-1] for s in table.column("shingles")]
        pairs = [(a, b) for a, b in join_at_home(held, table.column("at_home").to_pylist(), percent, known) if known[a] != known[b]]
        return pa.table({"a": pa.array([int(nodes[a]) for a, _ in pairs], type=pa.int64()), "b": pa.array([int(nodes[b]) for _, b in pairs], type=pa.int64())})

    def met(rows: DataFrame, sets: DataFrame, name: str) -> DataFrame:
        return stored(rows.join(sets, "node").groupBy("place", "part", "chunk").applyInArrow(meet, "a bigint, b bigint"), name)

    facing = possible(dealt.withColumn("known", F.col("node")))
    # Texts are read for both rounds at once: what other parts of a home may need is known by now.
    sets = sets_of(facing.select("node").unionByName(around.filter("parts > 1").select("node")))
    rooted = stored(components(met(facing, sets, "links")), "rooted")
    rest = _rest(around.filter("parts > 1"), rooted, home)
    if not rest.isEmpty():
        later = met(possible(rest), sets, "later")
        rooted = stored(components(later.unionByName(rooted.select(F.col("node").alias("a"), F.col("root").alias("b")))), "joined")
    ids = classes.select("node", "least_id")
    least = rooted.join(ids, "node").groupBy("root").agg(F.min("least_id").alias("component_id"))
    linked = rooted.join(least, "root").select("node", "component_id")
    several = classes.filter("rows > 1").select("node", F.col("least_id"))
    groups = several.join(linked, "node", "full").select(F.col("node").alias("g_node"), F.coalesce("component_id", "least_id").alias("component_id"))
    groups = stored(groups, "groups")
    out = every.select("doc_id", "node", F.col("size").alias("n_shingles")).join(groups, F.col("node") == F.col("g_node"), "left")
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def _deal(rows: DataFrame) -> DataFrame:
    """Rows (node, place, own: the part that holds it or null, parts, chunks, asks) as members of groups (place, part, chunk).

    Who asks visits every part in its own chunk; who is held stands in each chunk of its part.
    """
    kept = [c for c in rows.columns if c not in ("own", "parts", "chunks", "asks")]
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    chunk = F.pmod(F.xxhash64("node", F.lit("chunk")), F.col("chunks"))
    held = rows.filter("own is not null").select(*kept, F.col("own").alias("part"), F.lit(True).alias("at_home"), upto("chunks").alias("chunk"))
    asking = rows.filter("asks").select(*kept, "own", chunk.alias("chunk"), upto("parts").alias("part")).filter("own is null or own <> part")
    return held.unionByName(asking.select(*kept, "part", F.lit(False).alias("at_home"), "chunk"))


def _rest(around: DataFrame, rooted: DataFrame, home: int) -> DataFrame:
    """What is left to compare at homes of several parts once all have met the first one.

    The largest component at a home needs no comparison within: its other parts meet the nodes outside it,
    and nodes outside it that are at home meet everyone.
    """
    roots = rooted.select(F.col("node").alias("r_node"), "root")
    known = around.join(roots, F.col("node") == F.col("r_node"), "left").withColumn("known", F.coalesce("root", "node")).drop("r_node", "root")
    known = stored(known, "known")
    sizes = known.filter("own is not null").groupBy("place", "known").agg(F.count("*").alias("n"))
    main = sizes.groupBy(F.col("place").alias("m_place")).agg(F.max_by("known", F.struct("n", "known")).alias("main"))
    inside = known.join(main, F.col("place") == F.col("m_place")).withColumn("inside", F.col("known") == F.col("main")).drop("m_place", "main")
    strays = inside.groupBy(F.col("place").alias("s_place")).agg(
        F.count_if(~F.col("inside") & (F.col("own") > 0)).alias("loose"), F.count_if(~F.col("inside")).alias("outside"),
        F.count_if(F.col("inside") & (F.col("own") > 0)).alias("tied"))
    counted = stored(inside.join(strays, F.col("place") == F.col("s_place")).drop("s_place"), "counted")

    loose = counted.filter("loose > 0").withColumn("parts", F.ceil(F.col("loose") / home))
    loose = loose.withColumn("own", F.when(~F.col("inside") & (F.col("own") > 0), F.pmod(F.xxhash64("node"), F.col("parts"))))
    tied = counted.filter("outside > 0 and tied > 0").filter("own > 0 or not inside")
    tied = tied.withColumns({"own": F.when(F.col("inside"), F.col("own") - 1), "parts": F.col("parts") - 1, "chunks": F.ceil(F.col("outside") / CHUNK)})
    columns = ["node", "place", "known", "own", "parts", "chunks"]
    first = _deal(loose.select(*columns, F.lit(True).alias("asks")))
    second = _deal(tied.select(*columns, (~F.col("inside")).alias("asks")))
    # The two kinds of groups have numbers of their own.
    return stored(first.unionByName(second.withColumn("part", -1 - F.col("part"))), "rest")
