"""Mixing sources to target weights with hash-threshold histograms; DataFrame functions only.

Every document has a fixed hash. A source takes the documents below a threshold of it, and the threshold is found by
histograms: words summed by source and by the leading bits of the hash show in which bucket the budget runs out; only
that bucket is divided by the next bits, until it holds a single document. Taking is then a filter; nothing is sorted,
and a rerun takes the same documents. A document that no longer fits is passed over, and the search goes on above it
among documents that fit the rest, ``passes`` times, so that one long document cannot leave a source far from its
target; the last pass takes the nearer side.

A source with a target of at least its size is taken whole once, and the threshold applies to the second copy.

Defined cases: NULL text has size 0; NULL source is a source of its own, last in order; a source without words has
target 0; an empty table gives no rows. Rows equal in id and text share a hash and are taken together. Other columns are
kept by ``mix`` and not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.llm.common import WORD, join_lookup, null_safe_key
from plumbline.session import durable

WEIGHTS, SHARE, MOST = (5, 2, 1), 1.5, 2.0
HASH_BITS, LEVEL_BITS, PASSES = 63, 12, 3
TOP = (1 << HASH_BITS) - 1


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(doc_id: Column, text: Column) -> Column:
    """The hash that decides about a document, 0 to 2 ** 63 - 1."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, text), 1)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(skey, source, source_size) with ``target``: the budget by weight, none above ``most`` times its size.

    What a capped source leaves is reshared by weight. In order of size over weight, the first source that its share
    does not fill fixes the rate for all after it; those before it are at their caps. One short row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source").cast("binary"))
    given = F.element_at(F.array(*[F.lit(float(w)) for w in weights]),
                         ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    by_fill = Window.orderBy(F.col("cap") / F.col("weight"), "skey")
    everything = Window.partitionBy()
    ranked = (sizes.withColumn("weight", given).withColumn("cap", F.col("source_size") * F.lit(float(most)))
              .withColumn("before", F.sum("cap").over(by_fill.rowsBetween(Window.unboundedPreceding, -1)))
              .withColumn("left", F.sum("weight").over(by_fill.rowsBetween(0, Window.unboundedFollowing)))
              .withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(share)))
              .withColumn("rate", (F.col("budget") - F.coalesce("before", F.lit(0.0))) / F.col("left"))
              .withColumn("free", F.col("rate") * F.col("weight") <= F.col("cap")))
    return (ranked.withColumn("level", F.min(F.when(F.col("free"), F.struct(F.col("cap") / F.col("weight"), "skey",
                                                                           "rate"))).over(everything)["rate"])
            .withColumn("target", F.when(F.col("level").isNull(), F.col("cap"))
                        .otherwise(F.least("cap", F.col("level") * F.col("weight"))))
            .select("skey", "source", "source_size", "target"))


def thresholds(narrow: DataFrame, goals: DataFrame, sources: int, passes: int = PASSES) -> DataFrame:
    """Per skey the hash ranges to take: array of (low, high, longest), bounds inclusive, for documents up to a size.

    ``narrow`` has (skey, size, h); ``goals`` has (skey, rest), the words still to take by threshold.
    """
    state = goals.select(
        "skey", F.col("rest").cast("double"), F.lit(0).cast("long").alias("low"), F.lit(TOP).alias("longest"),
        F.expr("cast(array() as array<struct<low: bigint, high: bigint, longest: bigint>>)").alias("ranges"))
    for turn in range(passes):
        bucket = durable(state.withColumn("live", F.col("rest") > 0).withColumn("fits", F.lit(False))
                         .withColumn("at", F.lit(0).cast("long")).withColumn("excess", F.lit(0.0)))
        shift = HASH_BITS
        while shift > 0 and bucket.where("live").take(1):
            width, shift = shift, max(0, shift - LEVEL_BITS)
            bucket = durable(_refine(narrow, bucket, sources, width, shift))
            if not bucket.where("live and docs > 1").take(1):
                break
        state = _close(bucket, shift, last=turn == passes - 1)
    return state.select("skey", "ranges")


def _refine(narrow: DataFrame, bucket: DataFrame, sources: int, width: int, shift: int) -> DataFrame:
    """One level: words per cell of the boundary bucket [at, at + 2 ** width - 1], and the cell where they exceed rest."""
    cells = (join_lookup(narrow, bucket.where("live").select("skey", "low", "longest", "at"), ["skey"], sources, "inner")
             .where((F.col("h") >= F.col("low")) & (F.col("size") <= F.col("longest"))
                    & F.col("h").between(F.col("at"), F.col("at") + F.lit((1 << width) - 1)))
             .groupBy("skey", F.shiftright("h", shift).alias("cell"))
             .agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("docs")))
    running = Window.partitionBy("skey").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    edge = (join_lookup(cells.withColumn("before", F.coalesce(F.sum("words").over(running), F.lit(0))),
                        bucket.select("skey", "rest"), ["skey"], sources, "inner")
            .where(F.col("before") + F.col("words") > F.col("rest"))
            .groupBy("skey").agg(F.min(F.struct("cell", "before", "words", "docs")).alias("edge")))
    found = F.col("live") & F.col("edge").isNotNull()
    return bucket.drop("docs").join(edge, "skey", "left").select(
        "skey", "low", "longest", "ranges", F.coalesce("edge.docs", F.lit(0)).alias("docs"),
        F.when(found, F.shiftleft(F.col("edge.cell"), shift)).otherwise(F.col("at")).alias("at"),
        F.when(found, F.col("rest") - F.col("edge.before")).otherwise(F.col("rest")).alias("rest"),
        F.when(found, F.col("edge.before") + F.col("edge.words") - F.col("rest")).otherwise(F.col("excess")).alias("excess"),
        # nothing runs over: all of the range is taken
        (F.col("fits") | (F.col("live") & F.col("edge").isNull())).alias("fits"), found.alias("live"))


def _close(bucket: DataFrame, shift: int, last: bool) -> DataFrame:
    """End of a pass: add its range, and go on above the boundary document with what is left."""
    high = F.col("at") + F.lit((1 << shift) - 1)
    nearer = F.lit(last) & (F.col("excess") < F.col("rest"))
    until = F.when(F.col("fits"), F.lit(TOP)).when(F.col("live"), F.when(nearer, high).otherwise(F.col("at") - 1))
    return bucket.select(
        "skey", F.when(F.col("live"), F.col("rest")).otherwise(F.lit(0.0)).alias("rest"),
        F.when(F.col("live"), high + 1).otherwise(F.col("low")).alias("low"),
        F.floor("rest").cast("long").alias("longest"),
        F.when(until.isNull(), F.col("ranges")).otherwise(F.concat("ranges", F.array(
            F.struct(F.col("low").alias("low"), until.alias("high"), F.col("longest").alias("longest"))))).alias("ranges"))


def plan(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE,
         most: float = MOST) -> tuple[DataFrame, DataFrame, int]:
    """Short rows of all documents (doc_id, skey, size, h), and per source what to take; the number of sources."""
    narrow = durable(docs.select("doc_id", null_safe_key(F.col("source")).alias("skey"), "source",
                                 words(F.col("text")).alias("size"), draw(F.col("doc_id"), F.col("text")).alias("h")))
    totals = narrow.groupBy("skey").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"))
    goals = durable(targets(totals, weights, share, most))
    sources = goals.count()
    whole = F.floor(F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)).cast("int")
    goals = goals.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size"))
    ranges = thresholds(narrow, goals.select("skey", "rest"), sources)
    return narrow, durable(goals.join(ranges, "skey").select("skey", "source_size", "target", "whole", "ranges")), sources


def copies(size: Column, h: Column) -> Column:
    """How often a document is taken, given its source's row of ``plan``."""
    hit = F.exists("ranges", lambda r: h.between(r["low"], r["high"]) & (size <= r["longest"]))
    return F.col("whole") + F.when(hit, 1).otherwise(0)


def mixed(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """(doc_id, source, size, source_size, target, copies, taken) for every document."""
    narrow, goals, sources = plan(docs, weights, share, most)
    return (join_lookup(narrow, goals, ["skey"], sources, "inner")
            .withColumn("copies", copies(F.col("size"), F.col("h")))
            .select("doc_id", "source", "size", "source_size", "target", "copies",
                    (F.col("size") * F.col("copies")).alias("taken")))


def mix(docs: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """The documents of the mix, in their own columns; one taken twice is there twice."""
    _, goals, sources = plan(docs, weights, share, most)
    goals = goals.select(F.col("skey").alias("__skey__"), "whole", "ranges")
    marked = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__row__"),
                         null_safe_key(F.col("source")).alias("__skey__"), words(F.col("text")).alias("__size__"),
                         draw(F.col("doc_id"), F.col("text")).alias("__h__"))
    times = copies(F.col("__size__"), F.col("__h__"))
    return (join_lookup(marked, goals, ["__skey__"], sources, "inner").withColumn("__n__", times).where("__n__ > 0")
            .withColumn("__n__", F.explode(F.array_repeat(F.lit(1), F.col("__n__")))).select("__row__.*"))
