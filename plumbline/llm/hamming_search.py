"""Exact top-k search in Hamming space by incremental multi-index hashing.

Codes are cut into m segments of 16 bits. The index is a table with one row per distinct code and segment, dealt by
(segment, value); it is written once, whatever the number of queries. A search asks for all values at distance 0 from the
query's, in every segment, then at distance 1, and so on. After distance a, every code within m * a + m - 1 bits has been
met: one that has not would differ by a + 1 bits in each segment. A query leaves when its k-th verified distance is no
more than that, so its result is exact, ties included (smaller id first); only unfinished queries ask at the next
distance.

A code that comes up in several segments is verified where it is met first, so each pair is compared once. The values
that occur, at most 65,536 a segment, are a directory: a value that does not occur is never asked for across the
network, and a value that many codes share is dealt in chunks of about ``chunk_rows`` codes, each of them asked for, so no
task holds a hot value. Equal codes share one entry with their k smallest ids, so a code that a third of all rows have
costs nothing extra. Each task sends at most k rows of a query on.

Defined cases: a row with NULL vector or id is neither found nor searched for; NULL elements give bit 0, missing ones
too; a repeated row is found as often as it occurs; an id with several vectors is searched for by each, and of all that
they find the k nearest are its result; fewer than k rows give all of them; no rows, an empty result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plumbline.session import durable

SEGMENT = 16
VALUES = 1 << SEGMENT
PER_WORD = 64 // SEGMENT
CHUNK_ROWS = 1 << 14
BROADCAST_SEGMENTS = 32  # the directory of 32 segments has at most two million short rows


def sign_code(vector: Column, words: int) -> Column:
    """The signs of a vector (bit 1: above zero) as an array of ``words`` longs."""
    return F.array(*[F.aggregate(
        F.transform(F.slice(vector, 64 * i + 1, 64), lambda x, at: F.when(x > 0, F.call_function(
            "shiftleft", F.lit(1).cast("long"), at)).otherwise(F.lit(0).cast("long"))),
        F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b)) for i in range(words)])


def segment_value(code: Column, s: Column) -> Column:
    """The value of segment ``s`` of a code, 0 to 65,535."""
    word = F.element_at(code, F.floor(s / PER_WORD).cast("int") + 1)
    return F.call_function("shiftright", word, s % PER_WORD * SEGMENT).bitwiseAND(F.lit(VALUES - 1)).cast("int")


@dataclass(frozen=True)
class Index:
    table: DataFrame  # (s, v, chunk, code, ids): every code once for each of its segments
    directory: DataFrame  # (s, v, chunks): the values that occur
    segments: int
    rows: int  # that can be found, at most k of a code


def build(vectors: DataFrame, k: int, words: int, chunk_rows: int = CHUNK_ROWS) -> Index:
    """The index of rows (id, code)."""
    segments = PER_WORD * words
    by_id = Window.partitionBy("code").orderBy("id")
    entries = durable(vectors.withColumn("at", F.row_number().over(by_id)).where(F.col("at") <= k)
                      .groupBy("code").agg(F.sort_array(F.collect_list("id")).alias("ids")))  # k at most
    parts = (entries.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(segments - 1))))
             .withColumn("v", segment_value(F.col("code"), F.col("s"))))
    directory = durable(parts.groupBy("s", "v").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(chunk_rows)).cast("int").alias("chunks")))
    index = Index(parts, directory, segments, entries.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0])
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Stored in the order and partitions of the searches' join, which then neither shuffles nor sorts it again.
    dealt = (_listed(parts, index).select("s", "v", F.pmod(F.xxhash64("code"), F.col("chunks")).cast("int").alias("chunk"),
                                          "code", "ids")
             .repartition(partitions, "s", "v", "chunk").sortWithinPartitions("s", "v", "chunk"))
    return Index(_placed(dealt), directory, segments, index.rows)


def _placed(df: DataFrame) -> DataFrame:
    """The frame stored so that joins know its partitions and order. An adaptive plan does not pass them to what is
    stored, so this one is not adaptive."""
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        return durable(df)
    finally:
        conf.set(name, before)


def _listed(rows: DataFrame, index: Index) -> DataFrame:
    """The rows (s, v, ...) whose value occurs, with ``chunks``."""
    small = index.segments <= BROADCAST_SEGMENTS
    return rows.join(F.broadcast(index.directory) if small else index.directory, ["s", "v"])


def meet(asking: DataFrame, index: Index, radius: int) -> DataFrame:
    """(query_id, q, distance, id) of what the queries (query_id, q, kth) meet at this distance for the first time; no
    farther than ``kth``, where that is known."""
    flips = ", ".join(str(v) for v in range(VALUES) if v.bit_count() == radius)
    asked = (asking.withColumn("s", F.explode(F.sequence(F.lit(0), F.lit(index.segments - 1))))
             .withColumn("v", F.explode(F.expr(f"array({flips})")))
             .withColumn("v", F.col("v").bitwiseXOR(segment_value(F.col("q"), F.col("s")))))
    dealt = _listed(asked, index).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).drop("chunks")
    words = index.segments // PER_WORD
    differing = [F.col("q")[w].bitwiseXOR(F.col("code")[w]).alias(f"x{w}") for w in range(words)]
    bits = [F.bit_count(F.shiftright(f"x{s // PER_WORD}", s % PER_WORD * SEGMENT).bitwiseAND(F.lit(VALUES - 1)))
            for s in range(index.segments)]
    first = F.least(*[n * index.segments + s for s, n in enumerate(bits)])  # nearest segment, then its number
    distance = sum((F.bit_count(f"x{w}") for w in range(words)), F.lit(0)).cast("int")
    return (dealt.join(index.table, ["s", "v", "chunk"]).select("query_id", "q", "kth", "s", "ids", *differing)
            .where(first == radius * index.segments + F.col("s"))
            .select("query_id", "q", "kth", distance.alias("distance"), "ids")
            .where(F.coalesce(F.col("distance") <= F.col("kth"), F.lit(True)))
            .select("query_id", "q", "distance", F.explode("ids").alias("id")))


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """(query_id, rank, id, distance): for every row (id, vector) of ``queries`` the k nearest rows of ``vectors``."""
    longest = vectors.agg(F.coalesce(F.max(F.size("vector")), F.lit(0))).first()[0]
    words = max(1, -(-longest // 64))

    def coded(df: DataFrame) -> DataFrame:
        return df.where("id is not null and vector is not null").select(
            F.col("id").cast("long").alias("id"), sign_code(F.col("vector"), words).alias("code"))

    index = build(coded(vectors), k, words, chunk_rows)
    wanted = min(k, index.rows)
    # Equal queries are searched for once. A query asks for thousands of values, so they are spread by number, not size.
    partitions = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    asking = durable(coded(queries).distinct().select(
        F.col("id").alias("query_id"), F.col("code").alias("q"), F.lit(None).cast("int").alias("kth"))
        .repartition(partitions, "query_id", "q"))
    one, nearest = ["query_id", "q"], Window.partitionBy("query_id", "q").orderBy("distance", "id")
    best, done = None, []
    for radius in range(SEGMENT + 1):
        met = meet(asking if wanted else asking.where("false"), index, radius)
        met = met if best is None else best.unionByName(met)
        best = durable(met.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k).drop("rank"))
        covered = index.segments * (radius + 1) - 1
        kth = best.groupBy(*one).agg(F.when(F.count(F.lit(1)) >= wanted, F.max("distance")).alias("kth"))
        asking = durable(asking.drop("kth").join(kth, one, "left").repartition(partitions, *one))
        settled = F.coalesce(F.col("kth") <= covered, F.lit(not wanted))
        done.append(best.join(asking.where(settled), one, "left_semi"))
        asking = asking.where(~settled)
        best = best.join(asking, one, "left_semi")
        if not asking.take(1):
            break
    found = done[0]
    for more in done[1:]:
        found = found.unionByName(more)
    by_rank = Window.partitionBy("query_id").orderBy("distance", "id")
    return (found.withColumn("rank", F.row_number().over(by_rank)).where(F.col("rank") <= k)
            .select("query_id", "rank", "id", "distance"))
