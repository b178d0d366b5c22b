"""Uniqueness of a new load against all earlier ones, without reading all of them.

What is kept of each load are its keys with their row counts, and words of 64 bits that tell which slots they fill. An
integer key is its own slot, so its bit says exactly whether the key was there before; other keys and compound ones have a
hash for a slot. Both tables lie in folders by part of the key space; neighbouring integers share a part, so a load of
new surrogate keys touches one or two. Checking a load reads the words of the parts it touches; only keys whose bit is
set meet the stored keys, in their parts only. A hot key is one row per load.

The verdict over all loads follows from the last one's: a key with n rows before and m in the load changes the number of
rows (or groups) that break the check by what n + m gives less what n gave.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.functions import keys as K
from plumbline.operators.checks import Check
from plumbline.operators.validate import quoted
from plumbline.session import durable

SLOTS = 1 << 31  # of hashed keys; a set bit then is a suspect, not yet a clash
PART_SHIFT = 20  # integer keys of a part, before parts repeat


@dataclass(frozen=True)
class KeyHistory:
    """The keys of ``check`` (unique, compound_unique or duplicate_key) under ``path``, by load."""

    spark: SparkSession
    path: str
    check: Check
    schema: str  # of the key columns, as DDL
    parts: int = 256

    # --- layout ---

    def _slot(self, df: DataFrame) -> Column:
        columns = self.check.columns
        if len(columns) == 1 and K.is_integer(df, columns[0]):
            return F.col(quoted(columns[0])).cast("bigint")
        return F.pmod(F.xxhash64(*[F.col(quoted(c)) for c in columns]), F.lit(SLOTS))

    def _part(self, slot: Column) -> Column:
        return F.pmod(F.shiftright(slot, PART_SHIFT), F.lit(self.parts)).cast("int")

    def _counted(self, load: DataFrame) -> DataFrame:
        """(key columns, slot, part, n) of a load: one row per key that the check looks at."""
        named = load.select(*[F.col(quoted(c)) for c in self.check.columns])
        known = [F.col(quoted(c)).isNotNull() for c in self.check.columns]
        if self.check.kind == "unique":
            named = named.where(reduce(Column.__and__, known))
        elif self.check.kind == "compound_unique":
            named = named.where(reduce(Column.__or__, known))
        groups = named.groupBy(*map(quoted, self.check.columns)).agg(F.count(F.lit(1)).alias("n"))
        # A NULL key (of duplicate_key) has slot 0.
        slotted = groups.withColumn("slot", F.coalesce(self._slot(groups), F.lit(0).cast("bigint")))
        return slotted.withColumn("part", self._part(F.col("slot")))

    def _read(self, name: str, schema: str, day, parts: list[int]) -> DataFrame:
        """A stored table without one day, its folders chosen by part."""
        try:
            stored = self.spark.read.schema(f"{schema}, load_date date, part int").option("basePath", f"{self.path}/{name}"
                                                                                        ).parquet(f"{self.path}/{name}/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            stored = self.spark.createDataFrame([], f"{schema}, load_date date, part int")
        return stored.where((F.col("load_date") != F.lit(str(day)).cast("date")) & F.col("part").isin(parts or [-1]))

    def _parts_of(self, df: DataFrame) -> list[int]:
        return [r["part"] for r in df.select("part").distinct().collect()]  # at most ``parts`` numbers

    # --- checking ---

    def suspects(self, counted: DataFrame, day) -> DataFrame:
        """Keys of a load whose bit is set by another one."""
        seen = K.merged_words(self._read("seen", "word bigint, bits bigint", day, self._parts_of(counted)))
        return (counted.withColumn("word", K.word_of(F.col("slot"))).join(seen, "word")
                .where(K.has_bit(F.col("bits"), F.col("slot"))).drop("word", "bits"))

    def stored_keys(self, suspects: DataFrame, day) -> DataFrame:
        """The stored rows that suspects may meet: those of their parts."""
        return self._read("keys", f"{self.schema}, n bigint", day, self._parts_of(suspects))

    def clashes(self, load: DataFrame, day: dt.date | str) -> DataFrame:
        """(key columns, n, n_before) for the keys of a load that occur in other loads or repeatedly in it."""
        counted = durable(self._counted(load))
        return self._with_history(counted, day).where((F.col("n") > 1) | (F.col("n_before") > 0)).select(
            *map(quoted, self.check.columns), "n", "n_before")

    def _with_history(self, counted: DataFrame, day) -> DataFrame:
        suspects = durable(self.suspects(counted, day))
        columns = list(self.check.columns)
        earlier = (self.stored_keys(suspects, day).groupBy(*map(quoted, columns)).agg(F.sum("n").alias("n_before"))
                   .select(*[F.col(quoted(c)).alias(f"__{i}") for i, c in enumerate(columns)], "n_before"))
        same = lambda left: reduce(Column.__and__, [left[quoted(c)].eqNullSafe(F.col(f"__{i}")) for i, c in enumerate(columns)])
        known = suspects.join(earlier, same(suspects)).select(
            *[F.col(quoted(c)).alias(f"__{i}") for i, c in enumerate(columns)], "n_before")
        return counted.join(known, same(counted), "left").select(
            *map(quoted, columns), "n", F.coalesce("n_before", F.lit(0)).alias("n_before"))

    # --- keeping ---

    def add(self, load: DataFrame, day: dt.date | str) -> DataFrame:
        """Check a load and keep its keys; one row: rows or groups judged and broken, of the load and of all loads so far.

        Loads are added in order of their day. The last one may be added again, which replaces it.
        """
        counted = durable(self._counted(load))
        before = self.totals()
        later = before.where(F.col("load_date") > F.lit(str(day)).cast("date"))
        if later.take(1):
            raise ValueError(f"a load after {day} is kept already")
        groups = self.check.kind == "duplicate_key"
        n, old = F.col("n"), F.col("n_before")
        judged = (old == 0).cast("long") if groups else n
        fault = (lambda x: (x > 1).cast("long")) if groups else (lambda x: F.when(x > 1, x).otherwise(0))
        delta = self._with_history(counted, day).agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("load_rows"), F.count(F.lit(1)).alias("load_keys"),
            F.count_if(old > 0).alias("keys_seen_before"), F.coalesce(F.sum(judged), F.lit(0)).alias("evaluated"),
            F.coalesce(F.sum(fault(n + old) - fault(old)), F.lit(0)).alias("unexpected"))
        past = before.where(F.col("load_date") < F.lit(str(day)).cast("date")).agg(
            F.coalesce(F.max_by("evaluated_count", "load_date"), F.lit(0)).alias("e"),
            F.coalesce(F.max_by("unexpected_count", "load_date"), F.lit(0)).alias("u"))
        row = durable(delta.crossJoin(past).select(  # one row each
            "load_rows", "load_keys", "keys_seen_before", (F.col("evaluated") + F.col("e")).alias("evaluated_count"),
            (F.col("unexpected") + F.col("u")).alias("unexpected_count")))
        own = f"load_date={day}"
        # A word lies in one part, for its keys share all but their last bits.
        words = counted.groupBy(K.word_of(F.col("slot")).alias("word"), "part").agg(F.bit_or(K.bit_of(F.col("slot"))).alias("bits"))
        (counted.select(*map(quoted, self.check.columns), "n", "part").repartition("part").write.mode("overwrite")
         .partitionBy("part").parquet(f"{self.path}/keys/{own}"))
        words.repartition("part").write.mode("overwrite").partitionBy("part").parquet(f"{self.path}/seen/{own}")
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/totals/{own}")
        return row.select(F.lit(str(day)).cast("date").alias("load_date"), "*")

    def totals(self) -> DataFrame:
        """One row per load: what ``add`` gave."""
        fields = "load_rows bigint, load_keys bigint, keys_seen_before bigint, evaluated_count bigint, unexpected_count bigint"
        schema = f"{fields}, load_date date"
        try:
            stored = self.spark.read.schema(schema).option("basePath", f"{self.path}/totals").parquet(f"{self.path}/totals/*")
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)
        return stored


def history_of(spark: SparkSession, path: str, check: Check, table: DataFrame, parts: int = 256) -> KeyHistory:
    """A history for the keys of a check on tables of this shape."""
    if check.kind not in ("unique", "compound_unique", "duplicate_key"):
        raise ValueError(f"{check.kind} has no key history")
    schema = ", ".join(f"{quoted(c)} {table.schema[c].dataType.simpleString()}" for c in check.columns)
    return KeyHistory(spark, path, replace(check), schema, parts)
