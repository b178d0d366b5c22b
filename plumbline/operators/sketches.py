"""Distinct counts of any span of periods without reading its rows again, from mergeable states.

The state of a period is the register table of a HyperLogLog sketch: the low bits of a key's hash choose a register, which
keeps the largest number of leading zeros of the other bits, plus one. States merge by the maximum of each register, and the
merged state is exactly that of all rows together. All key sets of a table share one scan; the shuffle carries at most
2 ** ``precision`` short rows per period, key set and task, so a hot key costs nothing extra.

The relative standard error is 1.04 / sqrt(2 ** precision), 1.6 % by default; counts well below the number of registers
are nearly exact (linear counting).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.operators.validate import quoted

PRECISION = 12


def fast_hash(columns: Sequence[Column]) -> tuple[Column, int]:
    """A 64-bit hash and its number of bits."""
    return F.xxhash64(*columns), 64


def portable_hash(columns: Sequence[Column]) -> tuple[Column, int]:
    """A hash that other engines compute as well, at a higher price: 60 bits of the MD5 of the values as text."""
    text = F.concat_ws("|", *[c.cast("string") for c in columns])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint"), 60


def period_states(df: DataFrame, period: Column, keys: Mapping[str, Sequence[str]], precision: int = PRECISION,
                  hashed: Callable[[Sequence[Column]], tuple[Column, int]] = fast_hash) -> DataFrame:
    """(period, key_set, register, rank, rows) of the named key sets; rows with a NULL in a set are not counted in it.

    ``rows`` is the number of rows of the register, so that a state also tells how many rows were counted.
    """
    cells = []
    for name, columns in keys.items():
        values = [F.col(quoted(c)) for c in columns]
        h, bits = hashed(values)
        rest = F.shiftrightunsigned(h, precision)
        rank = F.when(rest == 0, bits - precision + 1).otherwise(F.lit(bits - precision + 1) - F.length(F.bin(rest)))
        known = F.lit(True)
        for v in values:
            known = known & v.isNotNull()
        cells.append(F.when(known, F.struct(F.lit(name).alias("key_set"),
                                            h.bitwiseAND(F.lit((1 << precision) - 1)).cast("int").alias("register"),
                                            rank.cast("int").alias("rank"))))
    return (df.select(period.alias("period"), F.explode(F.array_compact(F.array(*cells))).alias("c"))
            .groupBy("period", "c.key_set", "c.register").agg(F.max("c.rank").alias("rank"), F.count(F.lit(1)).alias("rows")))


def merged(states: DataFrame) -> DataFrame:
    """One state of several periods: (key_set, register, rank, rows)."""
    return states.groupBy("key_set", "register").agg(F.max("rank").alias("rank"), F.sum("rows").alias("rows"))


def estimates(state: DataFrame, precision: int = PRECISION) -> DataFrame:
    """(key_set, rows, distinct_estimate, uniqueness_pct) of a merged state."""
    m = 1 << precision
    summed = state.groupBy("key_set").agg(F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("filled"),
                                          F.sum(F.pow(F.lit(2.0), -F.col("rank"))).alias("inverse"))
    empty = F.lit(m) - F.col("filled")
    raw = F.lit(0.7213 / (1 + 1.079 / m) * m * m) / (empty + F.col("inverse"))
    few = F.lit(float(m)) * F.ln(F.lit(float(m)) / F.nullif(empty.cast("double"), F.lit(0.0)))
    number = F.when((raw <= 2.5 * m) & (empty > 0), few).otherwise(raw)
    counted = F.least(F.round(number).cast("bigint"), F.col("rows"))
    return summed.select("key_set", "rows", counted.alias("distinct_estimate"),
                         F.round(counted * 100.0 / F.col("rows"), 2).alias("uniqueness_pct"))


def distinct_between(states: DataFrame, first, last, precision: int = PRECISION) -> DataFrame:
    """Estimates over the stored periods from ``first`` to ``last``, both included; only states are read."""
    return estimates(merged(states.where(F.col("period").between(first, last))), precision)
