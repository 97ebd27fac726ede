"""Mixing sources to target weights by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from massloom.llm.common import WORD, kept

#: Points of the schedule are integers below 2**31; the step is 2**31 over the golden ratio, made odd.
CIRCLE, STEP = 1 << 31, 1327217885
BLOCK = 64  # words
BINS = 1 << 12


def sized(docs: DataFrame, doc_id: str, source: str, text: str) -> DataFrame:
    """(doc_id, source, size, order): words of each row, and the place key of the shuffle."""
    size = F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")
    order = F.md5(F.concat(F.coalesce(F.col(doc_id).cast("string"), F.lit("")), F.lit("/"), F.coalesce(F.col(source).cast("string"), F.lit(""))))
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(source).cast("string").alias("source"), size.alias("size"), order.alias("order"))


def source_targets(rows: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """One row per source: (source, source_size, target, low, high).

    Sources by code point, null last, take the weights in turn. ``share`` times all words is dealt
    out by weight; a source stops at ``most`` times its size and the excess goes to the others by
    weight until none is above: with ``t`` words per weight, a target is min(t * weight, limit), and
    t follows from the sources in the order of limit / weight. [low, high) is the source's arc of
    the schedule's circle. The windows run over one row per source, not over documents.
    """
    each = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    listed = F.array(*[F.lit(float(w)) for w in weights])
    each = each.withColumn("weight", listed[((F.row_number().over(by_name) - 1) % len(weights)).cast("int")])
    limit = F.col("source_size") * most
    each = each.withColumns({"limit": limit, "ratio": limit / F.col("weight")})
    tight_first = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    up = tight_first.rowsBetween(Window.unboundedPreceding, -1)
    down = tight_first.rowsBetween(0, Window.unboundedFollowing)
    everyone = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    each = each.withColumn("all", F.sum("source_size").over(everyone) * share)
    each = each.withColumn("t", (F.col("all") - F.coalesce(F.sum("limit").over(up), F.lit(0.0))) / F.sum("weight").over(down))
    # the first source whose limit is not reached fixes t; if all are at their limits, t is without bound
    each = each.withColumn("t", F.min_by("t", F.when(F.col("ratio") >= F.col("t"), F.col("ratio"))).over(everyone))
    each = each.withColumn("target", F.least(F.col("limit"), F.coalesce(F.col("t") * F.col("weight"), F.col("limit"))))
    upto = F.sum("target").over(by_name.rowsBetween(Window.unboundedPreceding, 0))
    total = F.sum("target").over(everyone)
    high = F.when(total > 0, F.floor(upto / total * CIRCLE)).otherwise(F.lit(0)).cast("long")
    each = each.withColumn("high", high)
    low = F.coalesce(F.lag("high").over(by_name), F.lit(0)).cast("long")
    return each.withColumn("low", low).select("source", "source_size", "target", "low", "high")


def schedule(targets: DataFrame, block: int) -> DataFrame:
    """(slot, source, rank, words): which source fills each slot, and the slot's rank within it.

    Slot i lies at i * STEP on the circle, that is at the i-th golden-ratio point; the source whose
    arc holds the point fills it. Points find arcs by an equi join on ``BINS`` parts of the circle.
    A slot's rank is the number of earlier slots of its source; it counts from parts of the slot
    range, so that a source with most slots isn't sorted in one task. A source gets slots up to
    its target, the last cut short; if the points gave it too few, the rest follows at the end.
    """
    spark = targets.sparkSession
    total = targets.agg(F.sum("target")).first()[0] or 0.0
    n = int(-(-total // block))
    width = CIRCLE // BINS
    point = (F.col("id") % CIRCLE * STEP % CIRCLE).alias("point")
    points = spark.range(n).select(F.col("id").alias("slot"), point).withColumn("bin", F.floor(F.col("point") / width).cast("int"))
    arcs = targets.where("high > low").select(
        "source", "low", "high", F.explode(F.sequence(F.floor(F.col("low") / width).cast("int"), F.floor((F.col("high") - 1) / width).cast("int"))).alias("bin"))
    dealt = points.join(arcs, "bin").where("point >= low and point < high")
    dealt = kept(dealt.select("slot", F.floor(F.col("slot") / 65536).alias("part"), "source"), "slots")
    counts = dealt.groupBy("source", "part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    same = F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))
    inside = F.row_number().over(Window.partitionBy("source", "part").orderBy("slot"))
    ranked = dealt.withColumn("inside", inside).join(counts, same).select("slot", "source", (F.col("before") + F.col("inside") - 1).alias("rank"))
    need = targets.select(F.col("source").alias("s"), F.floor("target").alias("words"))
    got = dealt.groupBy(F.col("source").alias("g")).agg(F.count("*").alias("got"))
    blocks = F.ceil(F.col("words") / block)
    short = need.join(got, F.col("s").eqNullSafe(F.col("g")), "left").withColumn("got", F.coalesce("got", F.lit(0)))
    tail = short.where(F.col("got") < blocks).select(
        F.lit(None).cast("long").alias("slot"), F.col("s").alias("source"), F.explode(F.sequence("got", blocks - 1)).alias("rank"))
    every = ranked.unionByName(tail)
    return every.join(need, F.col("source").eqNullSafe(F.col("s"))).where(F.col("rank") * block < F.col("words")).select(
        "slot", "source", "rank", F.least(F.lit(block), F.col("words") - F.col("rank") * block).alias("words"))


def blocks_of(rows: DataFrame, targets: DataFrame, block: int, passes: int) -> DataFrame:
    """(uid, doc_id, source, rank, start, end): the pieces of each row's words, block by block.

    A source's rows stand in the order of a hash, repeated ``passes`` times, and are cut every
    ``block`` words. Running sums go by (source, part of the hash range), so a hot source is split
    over as many parts as the corpus needs to hold some 20,000 rows each.
    """
    n = rows.count()
    parts = 1
    while parts * 20_000 < n and parts < 1 << 24:
        parts *= 16
    digits = len(f"{parts - 1:x}") if parts > 1 else 0
    rows = rows.where("size > 0").withColumn("part", F.left("order", F.lit(digits)))
    sums = rows.groupBy("source", "part").agg(F.sum("size").alias("n"))
    earlier = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("part").alias("p"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    within = Window.partitionBy("source", "part").orderBy("order", "uid").rowsBetween(Window.unboundedPreceding, 0)
    placed = rows.withColumn("upto", F.sum("size").over(within))
    placed = placed.join(sums, F.col("source").eqNullSafe(F.col("s")) & (F.col("part") == F.col("p"))).drop("s")
    sizes = targets.select(F.col("source").alias("s"), "source_size", F.floor("target").alias("words"))
    placed = placed.join(sizes, F.col("source").eqNullSafe(F.col("s")))
    each = placed.withColumn("pass", F.explode(F.sequence(F.lit(0), F.lit(passes - 1))))
    end = F.col("before") + F.col("upto") + F.col("pass") * F.col("source_size")
    each = each.select("uid", "doc_id", "source", "words", (end - F.col("size")).alias("from"), end.alias("to")).where("from < words")
    first, last = F.floor(F.col("from") / block), F.floor((F.col("to") - 1) / block)
    cut = each.withColumn("rank", F.explode(F.sequence(first, last)))
    return cut.select(
        "uid", "doc_id", "source", "rank",
        F.greatest(F.lit(0), F.col("from") - F.col("rank") * block).alias("start"),
        F.least(F.lit(block), F.col("to") - F.col("rank") * block).alias("end"))


def mixture(
    docs: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0, block: int = BLOCK,
    doc_id: str = "doc_id", source: str = "source", text: str = "text",
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, targets, pieces): pieces are (slot, uid, doc_id, source, rank, words), the words that
    the slot's block takes from a row.

    Null text has no words. A null source is a source of its own, after all others. Repeated rows
    are rows of their own. A source without words gets nothing; with no words at all the mix is
    empty. The mix depends on ids and sources only, so reruns agree.
    """
    from massloom.llm.common import with_row_id

    rows = kept(with_row_id(sized(docs, doc_id, source, text)), "sized")
    targets = kept(source_targets(rows, weights, share, most), "targets")
    slots = schedule(targets, block).withColumnsRenamed({"source": "s", "rank": "r", "words": "open"})
    pieces = blocks_of(rows, targets, block, passes=int(-(-most // 1)))
    # (source, rank) is one slot and a few rows, whatever the source's size
    dealt = pieces.join(slots, F.col("source").eqNullSafe(F.col("s")) & (F.col("rank") == F.col("r")))
    words = F.least("end", "open") - F.col("start")
    return rows, targets, dealt.where(F.col("start") < F.col("open")).select("slot", "uid", "doc_id", "source", "rank", words.alias("words"))


def mix_digest(docs: DataFrame, **options) -> DataFrame:
    """(doc_id, size, source_size, target, taken) of every row."""
    rows, targets, pieces = mixture(docs, **options)
    taken = pieces.groupBy("uid").agg(F.sum("words").alias("taken"))
    targets = targets.select(F.col("source").alias("s"), F.col("source_size"), F.col("target"))
    return rows.join(targets, F.col("source").eqNullSafe(F.col("s"))).join(taken, "uid", "left").select(
        "doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).cast("long").alias("taken"))
