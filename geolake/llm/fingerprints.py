"""Document fingerprints: threshold-scaled sketches of word shingles.

A sketch keeps every shingle hash below a fixed fraction of the hash range. Which hashes stay doesn't depend
on the document's length, so sketches merge by union, and the share of a short text that a long one contains
can be estimated as well as the likeness of equals. Everything is array expressions: no Python, no explode.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import lower_ascii, stored, words

SHINGLE = 5
#: One hash in so many stays.
SCALE = 8
_LOWEST = -(1 << 63)


def shingle_hashes(text: Column, n: int = SHINGLE) -> Column:
    """Hashes of the runs of n words, A-Z lower-cased; fewer words are one shingle, no words none."""
    hashed = F.transform(words(lower_ascii(text)), lambda w: F.xxhash64(w))

    def runs(h: Column) -> Column:
        starts = F.sequence(F.lit(1), F.size(h) - n + 1)
        return F.transform(starts, lambda i: F.xxhash64(*[F.get(h, i + (k - 1)) for k in range(n)]))

    def some(h: Column) -> Column:
        return F.when(F.size(h) >= n, runs(h)).when(F.size(h) > 0, F.array(F.xxhash64(h))).otherwise(F.array().cast("array<bigint>"))

    # A value used twice is bound once as the only element of an array.
    return F.element_at(F.transform(F.array(hashed), some), 1)


def sketch(text: Column, n: int = SHINGLE, scale: int = SCALE) -> Column:
    """Sorted distinct hashes below 2^64 / scale, counted from 0.

    Where none is below, the smallest hash stands in, so that a short text is still told from another;
    it lies above the fraction and gives way when sketches merge. No words: an empty array.
    """
    bound = (1 << 64) // scale + _LOWEST

    def keep(h: Column) -> Column:
        low = F.array_sort(F.array_distinct(F.filter(h, lambda x: x < F.lit(bound))))
        kept = F.when(F.size(low) > 0, low).when(F.size(h) > 0, F.array(F.array_min(h))).otherwise(low)
        return F.transform(kept, lambda x: x.bitwiseXOR(F.lit(_LOWEST)))

    return F.element_at(F.transform(F.array(shingle_hashes(text, n)), keep), 1)


def fingerprint(sketched: Column) -> Column:
    """The sketch as text: hexadecimal hashes with commas between."""
    return F.array_join(F.transform(sketched, lambda x: F.lower(F.hex(x))), ",")


def merge(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of both texts together (each shingle that lies within one of them)."""
    # A stand-in lies above the fraction; as a signed number it may be negative.
    def real(x: Column) -> Column:
        return (x >= 0) & (x < F.lit((1 << 64) // scale))

    both = F.array_union(a, b)
    low = F.array_sort(F.filter(both, real))
    rank = F.transform(both, lambda x: x.bitwiseXOR(F.lit(_LOWEST)))
    least = F.transform(F.array(F.array_min(rank)), lambda x: x.bitwiseXOR(F.lit(_LOWEST)))
    return F.when(F.size(low) > 0, low).when(F.size(both) > 0, least).otherwise(both)


def jaccard(a: Column, b: Column) -> Column:
    """Shared hashes over all hashes; two texts without words are alike, one without is like no other."""
    shared = F.size(F.array_intersect(a, b))
    every = F.size(a) + F.size(b) - shared
    return F.when(every > 0, shared / every).otherwise(F.lit(1.0))


def contained(a: Column, b: Column) -> Column:
    """Share of a that b has; a text without words is in every text."""
    return F.when(F.size(a) > 0, F.size(F.array_intersect(a, b)) / F.size(a)).otherwise(F.lit(1.0))


def with_next(docs: DataFrame) -> DataFrame:
    """For each row of docs (id, digest, third, no_id; no nulls) its key and that of the next one, ids descending.

    Rows with one id go by the digest of their text; equal rows follow each other. After the last comes the first.
    Ranges of ids are dealt out and written once, so the order is found range by range; only the first key
    of each range meets the others, a few thousand rows whatever the input.
    """
    keys = docs.groupBy("id", "digest").agg(F.count("*").alias("n"), F.max("third").alias("third"), F.max("no_id").alias("no_id"))
    order = [F.col("id").desc(), F.col("digest")]
    keys = stored(keys.repartitionByRange(*order).withColumn("part", F.spark_partition_id()), "keys")
    key = F.struct("id", "digest")
    in_part = Window.partitionBy("part").orderBy(*order)
    rank = F.struct(F.bitwise_not("id"), "digest")  # flips the order of ids
    heads = keys.groupBy(F.col("part").alias("h_part")).agg(F.min_by(key, rank).alias("head"))
    heads = heads.withColumn("first", F.min_by("head", "h_part").over(Window.partitionBy(F.lit(0))))
    heads = heads.select("h_part", F.coalesce(F.lead("head").over(Window.orderBy("h_part")), F.col("first")).alias("after"))
    linked = keys.withColumn("next", F.lead(key).over(in_part)).join(heads, F.col("part") == F.col("h_part"))
    linked = linked.withColumn("next", F.coalesce("next", "after"))
    own = F.struct(key.alias("next"), (F.col("n") - 1).alias("rows"))
    last = F.struct(F.col("next"), F.lit(1).cast("bigint").alias("rows"))
    hops = linked.select("id", "digest", "third", "no_id", F.explode(F.filter(F.array(own, last), lambda x: x["rows"] > 0)).alias("hop"))
    return hops.select("id", "digest", "third", "no_id", F.col("hop.next.id").alias("next_id"), F.col("hop.next.digest").alias("next_digest"), F.col("hop.rows").alias("rows"))


def edited_pairs(docs: DataFrame, scale: int = SCALE) -> DataFrame:
    """Each text against its edited form, whose last third comes from the next document, and against that document.

    One row for each row of ``docs`` (doc_id, text; other columns are ignored): doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next (Jaccard estimates), part_in_edited, part_in_next (containment).
    A null text is empty. Repeated rows and ids: see ``with_next``. An empty table gives no rows.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    # Keys without nulls, so that both joins are plain equalities and share one shuffle of the texts. No id: the lowest one.
    doc_id = F.col("doc_id").cast("bigint")
    keyed = docs.select(
        F.coalesce(doc_id, F.lit(_LOWEST)).alias("id"), F.xxhash64(text, doc_id.isNull()).alias("digest"), doc_id.isNull().alias("no_id"), text.alias("text"))
    third = F.floor(F.length("text") / 3).cast("int").alias("third")
    hops = with_next(keyed.select("id", "digest", third, "no_id"))
    # One row for each distinct (id, text): repeated rows are counted in the hops.
    nth = F.row_number().over(Window.partitionBy("id", "digest").orderBy("id"))
    # Both joins read the same columns of it, so one shuffle serves both.
    texts = keyed.drop("no_id").withColumn("sketch", sketch(F.col("text"), scale=scale)).withColumn("nth", nth).filter("nth = 1").drop("nth")
    after = texts.select(F.col("id").alias("a_id"), F.col("digest").alias("a_digest"), F.col("text").alias("a_text"), F.col("sketch").alias("a_sketch"))
    heads = hops.join(after, (F.col("next_id") == F.col("a_id")) & (F.col("next_digest") == F.col("a_digest"))).select(
        F.col("id").alias("h_id"), F.col("digest").alias("h_digest"), "rows", "third", "no_id",
        F.substring("a_text", F.lit(1), F.col("third")).alias("head"), "a_sketch")
    joined = texts.join(heads, (F.col("id") == F.col("h_id")) & (F.col("digest") == F.col("h_digest")))
    n = F.length("text")
    edited = F.concat(F.substring("text", F.lit(1), n - F.col("third")), F.col("head"))
    joined = joined.select(F.when(~F.col("no_id"), F.col("id")).alias("doc_id"), "rows", n.cast("bigint").alias("n_chars"), edited.alias("edited"), "sketch", "a_sketch")
    joined = joined.withColumn("e_sketch", sketch(F.col("edited"), scale=scale))
    out = joined.select(
        "doc_id", "n_chars", F.sha2(F.col("edited"), 256).alias("edited_sha256"),
        fingerprint(F.col("sketch")).alias("fingerprint"), fingerprint(F.col("e_sketch")).alias("edited_fingerprint"),
        jaccard(F.col("sketch"), F.col("e_sketch")).alias("near_edited"), jaccard(F.col("sketch"), F.col("a_sketch")).alias("near_next"),
        contained(F.col("sketch"), F.col("e_sketch")).alias("part_in_edited"), contained(F.col("sketch"), F.col("a_sketch")).alias("part_in_next"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("rows"))).alias("_row"),
    )
    return out.drop("_row")
