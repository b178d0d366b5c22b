"""SimHash near-duplicates by covering locality-sensitive hashing.

For radius r, every bit position i gets a non-zero vector m(i) of r + 1 bits, and every non-zero v of r + 1 bits gives
one mask: the positions with an odd <m(i), v>. The vectors of any r differing positions span at most r dimensions, so
some v is orthogonal to all of them; its mask skips all differing positions. Hence every pair within the radius shares
the masked fingerprint in at least one of the 2 ** (r + 1) - 1 tables: nothing is missed, and the Hamming distance of
what meets in a bucket is checked exactly.

Work is done on distinct fingerprints, so exact copies cost nothing beyond one grouping. Of a bucket only a spanning
forest of its links is kept, never all pairs. A bucket above ``BUCKET`` fingerprints is dealt out in pairs of chunks,
which together compare everything. Links then go through distributed large-star/small-star rounds, each checkpointed.

Defined cases: NULL text counts as empty; a text without words has fingerprint 0 and links like any other; repeated
rows and ids each keep their row; NULL ids never become the smallest id unless a component has no other (then NULL).
Empty input gives an empty result. Other columns of the input are not read; temporary columns clash with none of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.llm.common import join_lookup, null_safe_key, small_batches
from plumbline.session import durable

SHINGLE_WORDS, MAX_BITS = 4, 4
SEED = 42  # fixed value of the contract
BUCKET = 4096  # fingerprints that one task compares with each other
BLOCK = 1 << 15  # shingles hashed before their bits are added up


def simhash(text: str | None, size: int = SHINGLE_WORDS) -> int:
    """The unsigned 64-bit fingerprint of a text."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) < size:
        begin, end = [0], [len(joined)]
    else:
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths + 1) - 1
        begin, end = (ends - lengths)[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    ones, digest = np.zeros(64, np.int64), xxhash.xxh64_intdigest
    for at in range(0, len(begin), BLOCK):
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(begin[at:at + BLOCK], end[at:at + BLOCK])], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(begin), bitorder="little")
    return int(bits.view("<u8")[0])


def fingerprinter(size: int = SHINGLE_WORDS):
    """Column function text -> fingerprint as a signed long."""
    @F.pandas_udf("long")
    def fingerprint(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series(np.array([simhash(t, size) for t in texts], "<u8").view("<i8"))
    return fingerprint


def masks(radius: int, width: int = 64) -> list[int]:
    """The covering masks, as signed longs."""
    side = (1 << (radius + 1)) - 1
    found = []
    for v in range(1, side + 1):
        mask = sum(1 << i for i in range(width) if ((i % side + 1) & v).bit_count() & 1)
        found.append(mask - (1 << width) if mask >> (width - 1) else mask)
    return found


def forest(values: np.ndarray, radius: int) -> tuple[list[int], list[int]]:
    """A spanning forest of the links among distinct values: both ends of each edge."""
    left, rest = values.view(np.uint64), np.arange(1, len(values))
    a, b, todo = [], [], [0]
    while True:
        while todo and len(rest):
            at = todo.pop()
            near = np.bitwise_count(left[rest] ^ left[at]) <= radius
            if near.any():
                found = rest[near]
                a += [int(values[at])] * len(found)
                b += values[found].tolist()
                todo += found.tolist()
                rest = rest[~near]
        if len(rest) < 2:
            return a, b
        todo, rest = [int(rest[0])], rest[1:]


def _edges(radius: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            a, b = [], []
            for group in batch["members"]:
                x, y = forest(np.unique(np.asarray(group, "<i8")), radius)
                a += x
                b += y
            yield pd.DataFrame({"a": np.array(a, "<i8"), "b": np.array(b, "<i8")})
    return run


def link_forest(values: DataFrame, radius: int, bucket: int = BUCKET) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column ``fp``) within the radius, enough to connect all that link."""
    tables = F.array(*[F.struct(F.lit(i).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key"))
                       for i, m in enumerate(masks(radius))])
    keys = values.select("fp", F.explode(tables).alias("k")).select("fp", "k.t", "k.key")
    # Counted first (map-side combined), so that no bucket is gathered before its size is known.
    full = durable(keys.groupBy("t", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
    shared = keys.join(full, ["t", "key"])
    small = shared.where(F.col("n") <= bucket).withColumn("i", F.lit(0)).withColumn("j", F.lit(0))
    chunks = F.ceil(F.col("n") / F.lit(bucket // 2)).cast("int")
    dealt = (shared.where(F.col("n") > bucket).withColumn("c", F.pmod(F.xxhash64("fp"), chunks).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), chunks - 1))).where("other <> c")
             .withColumn("i", F.least("c", "other")).withColumn("j", F.greatest("c", "other")))
    groups = (small.unionByName(dealt.select(small.columns)).groupBy("t", "key", "i", "j")
              .agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1))  # about `bucket` at most
    return groups.select("members").mapInPandas(_edges(radius), "a long, b long").distinct()


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable, for every node of the edges; large-star and small-star in turn."""
    def star(pairs: DataFrame) -> DataFrame:
        """(u, v) with u > v for every edge."""
        return pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()

    current = durable(star(edges.select(F.col("a").alias("u"), F.col("b").alias("v"))))
    before = None
    for _ in range(rounds):
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = durable(both.groupBy("u").agg(F.least("u", F.min("v")).alias("m")))
        large = durable(star(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))))
        least = durable(large.groupBy("u").agg(F.min("v").alias("m")))
        hooked = large.join(least, "u")
        current = durable(star(hooked.select("v", F.col("m").alias("u")).unionByName(
            least.select(F.col("u").alias("v"), F.col("m").alias("u")))))
        now = tuple(current.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v") % 1_000_003)).first())
        if now == before:
            break
        before = now
    else:
        raise RuntimeError("the components did not settle")
    # Settled: every node points at its root.
    return current.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """(doc_id, fp, component_id) for every row of documents (doc_id, text)."""
    small_batches(docs.sparkSession)
    prints = durable(docs.select("doc_id", fingerprinter(size)(F.col("text")).alias("fp")))
    return with_components(prints, radius)


def with_components(prints: DataFrame, radius: int = MAX_BITS) -> DataFrame:
    """The rows (doc_id, fp, ...) with ``component_id``, the smallest doc_id within reach, and ``root``, a fingerprint
    that names the component."""
    values = durable(prints.groupBy("fp").agg(F.min("doc_id").alias("least")))
    roots = components(link_forest(values.select("fp"), radius))
    # Stored, so that the joins below have two plain sides and adaptive execution can split a giant component or a hot
    # fingerprint. Only components of several fingerprints are looked up; any other has its own smallest id.
    placed = durable(values.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")))
    named = durable(placed.groupBy("root").agg(F.min("least").alias("smallest"), F.count(F.lit(1)).alias("n"))
                    .where("n > 1").drop("n"))
    lookup = durable(join_lookup(placed, named, ["root"], named.count()).select(
        "fp", "root", F.coalesce("smallest", "least").alias("component_id")))
    return prints.join(lookup, "fp")


def keep_one(docs: DataFrame, size: int = SHINGLE_WORDS, radius: int = MAX_BITS) -> DataFrame:
    """One document of each component, the one with its smallest id, in the columns of the input.

    Components are told apart by their root, so one id with two unlinked texts is in two of them and stays in both.
    A component without any id keeps the row with the smallest text hash. Of rows equal in id the same rule holds; of
    rows equal in id and text, the one with the smallest hash of all its columns stays.
    """
    small_batches(docs.sparkSession)
    mark = F.xxhash64("text").alias("__mark__")
    prints = durable(docs.select("doc_id", mark, fingerprinter(size)(F.col("text")).alias("fp")))
    first = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("__mark__"))).alias("m")
    chosen = durable(with_components(prints, radius).groupBy("root").agg(first)
                     .select(null_safe_key(F.col("m.doc_id")).alias("__id__"), F.col("m.__mark__").alias("__mark__")))
    rows = docs.select(null_safe_key(F.col("doc_id")).alias("__id__"), mark, F.struct("*").alias("__row__"),
                       F.xxhash64("*").alias("__all__"))
    return (rows.join(chosen, ["__id__", "__mark__"], "left_semi").groupBy("__id__", "__mark__")
            .agg(F.min_by("__row__", "__all__").alias("__row__")).select("__row__.*"))
