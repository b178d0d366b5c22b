"""Foreign-key lookups that never shuffle whole fact rows unless they must.

A dimension is broadcast only after its keys were counted. Integer keys beyond the bound are broadcast as bitmaps, if
those fit: a block of 4,096 keys is 64 words of 64 bits, so a dense key takes little more than a bit. Beyond that the fact
is first reduced to its distinct keys (map-side combined, so a hot key costs one row per task), and only those meet the
dimension.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import durable

# Largest key set that may be broadcast. A key costs about 16 bytes in the hash table on top of its own bytes.
BROADCAST_BYTES = 64 * 1024 * 1024
KEY_OVERHEAD = 16


@dataclass(frozen=True)
class ForeignKey:
    column: str
    table: str
    key: str
    rule_id: str | None = None
    severity: str = "critical"
    source: str = "fact_sales"

    @property
    def name(self) -> str:
        return f"{self.source} -> {self.table}"

    @property
    def flag(self) -> str:
        """Name of the column that marks rows without a match; one table may be referenced by several columns."""
        return f"missing_{self.column}_{self.table}"


def key_set(dim: DataFrame, key: str) -> DataFrame:
    """Distinct non-null keys; a duplicated dimension key must not multiply fact rows."""
    return dim.select(F.col(key).alias("ref_key")).where(F.col("ref_key").isNotNull()).distinct()


def key_bytes(key: str) -> Column:
    return (F.count(F.lit(1)) * KEY_OVERHEAD
            + F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0))).cast("bigint")


def small_enough(tables: Mapping[str, tuple[DataFrame, str]], limit: int = BROADCAST_BYTES, more: int = 0) -> set[str]:
    """Names of the (table, key) pairs whose measured key bytes, and ``more`` bytes a row, fit a broadcast. One small job
    for all of them."""
    if not tables:
        return set()
    sizes = [df.agg((key_bytes(key) + F.count(F.lit(1)) * more).alias("bytes")).select(F.lit(name).alias("name"), "bytes")
             for name, (df, key) in tables.items()]
    return {row["name"] for row in reduce(DataFrame.unionAll, sizes).collect() if row["bytes"] <= limit}


# --- bitmaps of integer keys ---------------------------------------------------------------------------------------

BLOCK_BITS, WORD_BITS = 12, 6  # keys of a block, and of a word
BLOCK_BYTES = (8 << (BLOCK_BITS - WORD_BITS)) + 64
INTEGERS = ("tinyint", "smallint", "int", "bigint")


def is_integer(df: DataFrame, column: str) -> bool:
    return df.schema[column].dataType.simpleString() in INTEGERS


def word_of(key: Column) -> Column:
    return F.shiftright(key.cast("bigint"), WORD_BITS)


def bit_of(key: Column) -> Column:
    """The word's bit of an integer key."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), key.cast("bigint").bitwiseAND(F.lit(63)).cast("int"))


def key_words(df: DataFrame, key: str) -> DataFrame:
    """(word, bits): which of the 64 keys of each word occur. Combined on the map side; NULL is no key."""
    return (df.where(F.col(key).isNotNull()).groupBy(word_of(F.col(key)).alias("word"))
            .agg(F.bit_or(bit_of(F.col(key))).alias("bits")))


def merged_words(words: DataFrame) -> DataFrame:
    """Words of several loads as those of all of them, without reading the keys again."""
    return words.groupBy("word").agg(F.bit_or("bits").alias("bits"))


def key_blocks(words: DataFrame) -> DataFrame:
    """(block, words): the words of 4,096 neighbouring keys as one array."""
    per_block = 1 << (BLOCK_BITS - WORD_BITS)
    found = F.map_from_entries(F.collect_list(F.struct(F.col("word").bitwiseAND(F.lit(per_block - 1)), F.col("bits"))))
    return (words.groupBy(F.shiftright("word", BLOCK_BITS - WORD_BITS).alias("block")).agg(found.alias("found"))
            .select("block", F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(per_block - 1).cast("bigint")),
                                         lambda i: F.coalesce(F.col("found")[i], F.lit(0).cast("bigint"))).alias("words")))


def has_bit(bits: Column, key: Column) -> Column:
    return bits.bitwiseAND(bit_of(key)) != 0


# --- lookups -------------------------------------------------------------------------------------------------------

@dataclass(frozen=True)
class Lookup:
    """What is broadcast for a foreign key: its dimension's keys, or their bitmaps."""

    table: DataFrame
    bitmaps: bool


def lookups(keys: list[ForeignKey], dims: Mapping[str, DataFrame], limit: int = BROADCAST_BYTES) -> dict[str, Lookup]:
    """By flag, for the foreign keys whose dimension may be broadcast: as keys, else as bitmaps. Every (table, key) is
    measured once, whatever the number of columns that refer to it."""
    pairs = {f"{k.table}.{k.key}": (dims[k.table], k.key) for k in keys}
    small = small_enough(pairs, limit)
    dense: dict[str, DataFrame] = {}
    for name, (df, key) in pairs.items():
        if name not in small and is_integer(df, key):
            words = durable(key_words(df, key))
            blocks = words.agg(F.count_distinct(F.shiftright("word", BLOCK_BITS - WORD_BITS))).first()[0]
            if blocks * BLOCK_BYTES <= limit:
                dense[name] = words
    found = {}
    for k in keys:
        name = f"{k.table}.{k.key}"
        if name in small:
            found[k.flag] = Lookup(key_set(dims[k.table], k.key), False)
        elif name in dense and (k.source not in dims or is_integer(dims[k.source], k.column)):
            found[k.flag] = Lookup(key_blocks(dense[name]), True)
    return found


def mark(fact: DataFrame, fk: ForeignKey, lookup: Lookup) -> DataFrame:
    """Add the key's flag: true where the column is NULL or not among the keys of the (broadcast) lookup."""
    if not lookup.bitmaps:
        return mark_missing(fact, fk.column, lookup.table, fk.flag)
    key, block, words = F.col(fk.column).cast("bigint"), f"{fk.flag}_block", f"{fk.flag}_words"
    known = lookup.table.select(F.col("block").alias(block), F.col("words").alias(words))
    at = word_of(key).bitwiseAND(F.lit((1 << (BLOCK_BITS - WORD_BITS)) - 1)).cast("int")
    return (fact.join(F.broadcast(known), F.shiftright(key, BLOCK_BITS) == F.col(block), "left")
            .withColumn(fk.flag, ~F.coalesce(has_bit(F.get(words, at), key), F.lit(False))).drop(block, words))


def mark_missing(fact: DataFrame, column: str, keys: DataFrame, flag: str) -> DataFrame:
    """Add ``flag``: true where the column is NULL or not among the (broadcast, already measured) keys."""
    known = keys.select(F.col("ref_key").alias(f"{flag}_key"))
    return (fact.join(F.broadcast(known), F.col(column) == F.col(f"{flag}_key"), "left")
            .withColumn(flag, F.col(f"{flag}_key").isNull()).drop(f"{flag}_key"))


def missing_keys(fact: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Distinct fact keys, with their row counts, that the dimension lacks. NULL counts as missing."""
    used = fact.groupBy(F.col(column).alias("used_key")).agg(F.count(F.lit(1)).alias("rows"))
    return used.join(key_set(dim, key), F.col("used_key") == F.col("ref_key"), "left_anti")


def orphan_count(fact: DataFrame, fk: ForeignKey, dim: DataFrame) -> DataFrame:
    """One row (n, orphans); shuffles one row per distinct key and task, never whole fact rows."""
    used = fact.groupBy(F.col(fk.column).alias("used_key")).agg(F.count(F.lit(1)).alias("rows"))
    return (used.join(key_set(dim, fk.key), F.col("used_key") == F.col("ref_key"), "left")
            .agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("n"),
                 F.coalesce(F.sum(F.when(F.col("ref_key").isNull(), F.col("rows"))), F.lit(0)).alias("orphans")))


def with_orphan_flags(fact: DataFrame, keys: list[ForeignKey], dims: Mapping[str, DataFrame],
                      limit: int = BROADCAST_BYTES) -> tuple[DataFrame, dict[str, Column]]:
    """The fact with one boolean per foreign key, and those columns by ``ForeignKey.flag``.

    Small dimension: broadcast its keys, or their bitmaps. Large dimension: find the missing keys first and broadcast those, if they are
    few. Only a large dimension with a large set of missing keys leads to a shuffled join, whose hot keys adaptive
    execution splits on the fact side.
    """
    near = lookups(keys, dims, limit)
    flags: dict[str, Column] = {}
    for fk in keys:
        flag, dim = fk.flag, dims[fk.table]
        if flag in near:
            fact = mark(fact, fk, near[flag])
        else:
            lost = durable(missing_keys(fact, fk.column, dim, fk.key).select(F.col("used_key").alias("ref_key"))
                           .where(F.col("ref_key").isNotNull()))
            if small_enough({"lost": (lost, "ref_key")}, limit):
                fact = mark_missing(fact, fk.column, lost, flag).withColumn(
                    flag, F.col(fk.column).isNull() | ~F.col(flag))
            else:
                # Stored first: adaptive execution splits hot keys only between two plain shuffles, and an
                # aggregate on the other side would hide its one.
                known = durable(key_set(dim, fk.key).select(F.col("ref_key").alias(f"{flag}_key")))
                fact = (fact.join(known, F.col(fk.column) == F.col(f"{flag}_key"), "left")
                        .withColumn(flag, F.col(f"{flag}_key").isNull()).drop(f"{flag}_key"))
        flags[flag] = F.col(flag)
    return fact, flags
