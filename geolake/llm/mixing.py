"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words. A document's expected number of copies is its share of that
target; the whole copies in it are certain, and the fraction left is an inclusion probability p. Documents
are ranked by (u / (1 - u)) / (p / (1 - p)), random odds over inclusion odds, and each source takes the
front of its ranking until the words left over are reached: a fixed-size sample with unequal probabilities.
One closing document, the one that best fills the words still open, follows where it brings the source nearer.

Only narrow rows move. Sizes are summed per source with partial aggregation; the end of the front is found
in two histograms of 4096 bins each, so a source with a third of all rows is never sorted in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .shared import WORD, stored, unit_hash

BINS = 4096
#: Preferences are rounded to powers of 2 ** (1 / 4) within 2 ** -8 .. 2 ** 8, 65 levels at most.
LEVELS_PER_OCTAVE, OCTAVES = 4, 8


def capped_shares(rows: DataFrame, by: list[str], total: Column, weight: Column, cap: Column, order: list[Column]) -> DataFrame:
    """Shares of a total in proportion to weights, none above its cap, the excess dealt out again by weight.

    Sorted by cap over weight, the rows held at their cap come first. The rate of the others is what
    the capped ones leave over, for each unit of the other weights. Sums are of whole numbers where
    the inputs are, so every run gives the same result. Adds the column ``share``.
    """
    ratio = F.when(weight > 0, cap / weight).otherwise(F.lit(0.0))
    front = Window.partitionBy(*by).orderBy(ratio, *order)
    whole = Window.partitionBy(*by)
    before = front.rowsBetween(Window.unboundedPreceding, -1)
    open_weight = F.sum(weight).over(whole) - F.coalesce(F.sum(weight).over(before), F.lit(0))
    rate = (total - F.coalesce(F.sum(cap).over(before), F.lit(0))) / open_weight
    ranked = rows.withColumns({"_ratio": ratio, "_rate": F.when(open_weight > 0, rate), "_at": F.row_number().over(front)})
    held = F.col("_ratio") > F.col("_rate")
    ranked = ranked.withColumn("_rate", F.min_by(F.when(held, F.col("_rate")), F.when(held, F.col("_at"))).over(whole))
    share = F.coalesce(F.least(cap.cast("double"), F.col("_rate") * weight), cap.cast("double"))
    return ranked.withColumn("share", share).drop("_ratio", "_rate", "_at")


def mix(
    docs: DataFrame,
    weights: tuple[int, ...] = (1, 2, 3),
    max_copies: int = 3,
    budget: float = 1.0,
    seed: str = "mix",
    preference: Column | None = None,
) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text, source; other columns are ignored).

    ``weights`` go to the sources by code point, null last, in turn; they share ``budget`` times all words.
    ``preference`` (positive, default equal) makes documents of one source more or less likely.
    Returns doc_id, source, size (words), source_size, target (words, of the source), copies, taken (size x copies).

    A null or empty text has size 0; the null source is a source. Equal rows tie and are taken in any order,
    which gives the same rows. Rows with one doc_id and other texts are documents of their own. An empty table
    gives no rows. Reruns agree: the random numbers are hashes of ``seed`` and doc_id.
    """
    level = F.lit(0)
    if preference is not None:
        level = F.coalesce(F.round(F.log2(F.greatest(preference.cast("double"), F.lit(2.0**-OCTAVES))) * LEVELS_PER_OCTAVE), F.lit(0.0))
        level = F.least(level, F.lit(float(OCTAVES * LEVELS_PER_OCTAVE))).cast("int")
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = stored(docs.select(
        "doc_id", "source", level.alias("level"), F.regexp_count(text, F.lit(WORD)).cast("bigint").alias("size"),
        F.xxhash64(text).alias("digest"), unit_hash(F.lit(seed), F.col("doc_id")).alias("u"),
    ), "rows")
    plan = stored(_plan(rows, weights, max_copies, budget), "plan")
    ranked = rows.join(plan, rows.source.eqNullSafe(plan.p_source) & (rows.level == plan.p_level)).drop("p_source", "p_level")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("p") / (1 - F.col("p")))
    ranked = ranked.withColumn("q", F.when(F.col("p") > 0, odds))
    place = F.coalesce(F.col("q") / (1 + F.col("q")), F.lit(1.0)) * BINS
    first = F.least(F.floor(place), F.lit(BINS - 1))
    ranked = ranked.withColumns({"bin": first, "sub": F.least(F.floor((place - first) * BINS), F.lit(BINS - 1))})
    ranked = ranked.withColumn("_k", F.xxhash64(F.coalesce(F.col("source"), F.lit("")), F.col("source").isNull()))

    cut = stored(_cut(ranked, ["_k"], "bin"), "cut")
    inside = _with_cut(ranked, cut, "bin").filter("bin = c_bin").withColumn("rest", F.col("rest") - F.col("c_before"))
    sub = stored(_cut(inside.drop("c_bin", "c_before"), ["_k", "bin"], "sub"), "sub")
    sub = sub.withColumnsRenamed({"c_before": "s_before"}).drop("bin")

    state = _with_cut(_with_cut(ranked, cut, "bin"), sub, "sub")
    at_cut = (F.col("bin") == F.col("c_bin")) & (F.col("sub") == F.col("c_sub"))
    below = (F.col("bin") < F.col("c_bin")) | ((F.col("bin") == F.col("c_bin")) & (F.col("sub") < F.col("c_sub")))
    sure = state.filter(~F.coalesce(at_cut, F.lit(False))).withColumn("chosen", F.coalesce(below, F.lit(False)))
    order = Window.partitionBy("_k").orderBy(F.col("q").asc_nulls_last(), F.col("doc_id").asc_nulls_last(), "size", "digest").rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("c_before") + F.col("s_before") + F.coalesce(F.sum("size").over(order), F.lit(0))
    close = state.filter(at_cut).withColumn("chosen", before + F.col("size") / 2 < F.col("rest"))
    drawn = sure.unionByName(close).withColumn("chosen", F.col("chosen") & F.col("q").isNotNull())
    sampled = stored(drawn.select(
        "doc_id", "source", "size", "source_size", "target", "whole", "rest", "q", "digest", "_k", "chosen"), "sampled")

    left = F.first("rest") - F.sum(F.when(F.col("chosen"), F.col("size")).otherwise(F.lit(0)))
    gap = stored(sampled.groupBy("_k").agg(left.alias("gap")), "gap")
    spare = (
        sampled.filter(~F.col("chosen") & F.col("q").isNotNull() & (F.col("size") > 0))
        .groupBy("_k", "q", "doc_id", "size", "digest").agg((F.count("*") * F.col("size")).alias("adds"))
        .join(gap, "_k").filter("adds < 2 * gap")
        .groupBy("_k").agg(F.min(F.struct(F.abs(F.col("adds") - F.col("gap")).alias("off"), "q", F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)).alias("doc_id"), "size", "digest")).alias("closing"))
    )
    spare = stored(spare, "closing")
    closing = F.col("closing")
    closes = (
        (F.col("q") == closing["q"]) & (F.coalesce(F.col("doc_id"), F.lit(2**63 - 1)) == closing["doc_id"])
        & (F.col("size") == closing["size"]) & (F.col("digest") == closing["digest"]) & ~F.col("chosen")
    )
    copies = (F.col("whole") + (F.col("chosen") | F.coalesce(closes, F.lit(False))).cast("bigint")).alias("copies")
    return (
        sampled.join(spare, "_k", "left")
        .select("doc_id", "source", "size", "source_size", "target", copies, "digest")
        .withColumn("taken", F.col("size") * F.col("copies"))
    )


def _plan(rows: DataFrame, weights: tuple[int, ...], max_copies: int, budget: float) -> DataFrame:
    """A row for each source and level of preference: target, whole copies, probability p, words the sample fills."""
    groups = rows.groupBy("source", "level").agg(F.sum("size").alias("level_size"))
    sources = groups.groupBy("source").agg(F.sum("level_size").alias("source_size"))
    # One row per source from here on.
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, weights)), place % len(weights) + 1)
    every = Window.partitionBy(F.lit(0))
    total = F.sum("source_size").over(every)
    total = total if budget == 1 else total * F.lit(budget)
    sources = sources.withColumns({"weight": weight, "total": total})
    sources = capped_shares(sources, [], F.col("total"), F.col("weight"), F.col("source_size") * max_copies, [F.col("source").asc_nulls_last()])
    sources = sources.select(F.col("source").alias("t_source"), "source_size", F.col("share").alias("target"))
    levels = groups.join(sources, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    liking = F.col("level_size") * F.pow(F.lit(2.0), F.col("level") / LEVELS_PER_OCTAVE)
    levels = capped_shares(levels, ["source"], F.col("target"), liking, F.col("level_size") * max_copies, [F.col("level")])
    times = F.when(F.col("level_size") > 0, F.col("share") / F.col("level_size")).otherwise(F.lit(0.0))
    # The last bit of a division must not turn three whole copies into two and a draw.
    whole = F.floor(times + F.lit(1e-12))
    p = F.when(times - whole > 1e-12, times - whole).otherwise(F.lit(0.0))
    rest = F.when(F.col("p") > 0, F.col("share") - F.col("whole") * F.col("level_size")).otherwise(F.lit(0.0))
    levels = levels.withColumns({"whole": whole, "p": p}).withColumn("rest", rest)
    of_source = Window.partitionBy("source")
    return levels.select(
        F.col("source").alias("p_source"), F.col("level").alias("p_level"), "source_size", "target", "whole", "p",
        F.sum("rest").over(of_source).alias("rest"),
    )


def _cut(rows: DataFrame, by: list[str], bin_: str) -> DataFrame:
    """The bin in which the words of a group reach ``rest``, and the words in the bins before it."""
    sums = rows.groupBy(*by, bin_).agg(F.sum("size").alias("_words"), F.first("rest").alias("_rest"))
    upto = F.sum("_words").over(Window.partitionBy(*by).orderBy(bin_))
    sums = sums.withColumn("_upto", upto).filter("_upto >= _rest")
    found = sums.groupBy(*by).agg(F.min(F.struct(bin_, (F.col("_upto") - F.col("_words")).alias("before"))).alias("_cut"))
    return found.select(*by, F.col(f"_cut.{bin_}").alias(f"c_{bin_}"), F.col("_cut.before").alias("c_before"))


def _with_cut(rows: DataFrame, cut: DataFrame, bin_: str) -> DataFrame:
    """A source without a cut takes all its documents that may be drawn."""
    joined = rows.join(cut, "_k", "left")
    return joined.withColumn(f"c_{bin_}", F.coalesce(F.col(f"c_{bin_}"), F.lit(BINS)))


def repeat(docs: DataFrame, mixed: DataFrame) -> DataFrame:
    """The documents, each as often as the mix takes it. ``mixed`` is what ``mix(docs)`` gave."""
    columns = docs.columns
    take = mixed.groupBy(F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), F.col("source").alias("_source")).agg(
        F.sum("copies").alias("_copies"), F.count("*").alias("_rows"))
    keyed = docs.withColumn("_digest_here", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_digest_here") == F.col("_digest")) & F.col("source").eqNullSafe(F.col("_source"))
    # Equal rows share their copies: the first ones get one more where they don't divide.
    nth = F.row_number().over(Window.partitionBy("_id", "_digest", "_source").orderBy("_digest"))
    joined = keyed.join(take, same)
    single = joined.filter("_rows = 1").withColumn("_times", F.col("_copies"))
    several = joined.filter("_rows > 1").withColumn("_nth", nth).withColumn(
        "_times", F.floor(F.col("_copies") / F.col("_rows")) + (F.col("_nth") <= F.col("_copies") % F.col("_rows")).cast("bigint")).drop("_nth")
    every = single.unionByName(several).filter("_times > 0")
    return every.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_times")))).select(*columns)
