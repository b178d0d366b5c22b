"""Frequent values of wide columns: all that hold at least a share of the rows, with exact counts.

A distribution of a column with millions of values shuffles all of them to report a few. Here each task keeps a summary of a
fixed number of items per column (a frequent-items sketch), summaries are merged in two steps, and what they name is counted
exactly in a second scan. For M counters a summary misses a value by at most 3.5 / M of the rows, merged or not, and names
every value with more than twice that. M is chosen as 8 / ``share`` or more, so no value of the share is missed; the recount
removes those that have less. Both scans take all columns together, and only the counted columns are read.

Nothing grows with the number of values: a task sends M short items per column, and at most M candidates per column come to
the driver. Values longer than 64 characters are summarised by their MD5, so an item is short however long its text.

Defined cases: NULL is a value like any other, also in the share; an empty table gives no rows; ties are all returned. Values
are reported as text.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import predicates as P
from plumbline.operators.validate import quoted

TEXT = 64  # characters of a value that are kept as they are
MERGERS = 64  # tasks of the first merge


def item(column: Column) -> Column:
    """A short text that stands for a value: NULL, a short text, or the digest of a long one."""
    text = column.cast("string")
    return (F.when(text.isNull(), "n").when(F.length(text) <= TEXT, F.concat(F.lit("v"), text))
            .otherwise(F.concat(F.lit("h"), F.md5(text.cast("binary")))))


def counters(share: float) -> int:
    """A power of two of at least 8 / ``share``."""
    if not 0.0001 <= share <= 1:
        raise ValueError("a share between 0.0001 and 1 is needed")
    return 1 << max(4, (int(8 / share) - 1).bit_length())


def candidates(df: DataFrame, columns: Sequence[str], share: float) -> tuple[int, dict[str, list[str]]]:
    """Number of rows, and the items of each column that may hold the share: none that does is missing.

    A summary's count of an item is never below the true one, so items below the share by it are left out at once.
    """
    m = counters(share)
    held = int(m * 0.75)  # a table of m counters holds three quarters of it
    items = df.select(*[item(F.col(quoted(c))).alias(f"i{n}") for n, c in enumerate(columns)],
                      F.pmod(F.spark_partition_id(), F.lit(MERGERS)).alias("merger"))
    summed = items.groupBy("merger").agg(F.count(F.lit(1)).alias("rows"), *[
        F.expr(f"approx_top_k_accumulate(i{n}, {held})").alias(f"s{n}") for n in range(len(columns))])
    whole = summed.agg(F.sum("rows").alias("rows"), *[
        F.expr(f"approx_top_k_estimate(approx_top_k_combine(s{n}, {held}), {held})").alias(f"c{n}")
        for n in range(len(columns))]).first()
    rows = whole["rows"] or 0
    return rows, {c: [r["item"] for r in whole[f"c{n}"] or [] if r["count"] >= share * rows] for n, c in enumerate(columns)}


def heavy_values(df: DataFrame, columns: Sequence[str], share: float = 0.01) -> DataFrame:
    """(column_name, value, row_count, pct) of every value in at least ``share`` of the rows."""
    if df.isEmpty():
        return df.sparkSession.createDataFrame([], "column_name string, value string, row_count bigint, pct decimal(5,2)")
    rows, named = candidates(df, columns, share)
    n = F.lit(rows).cast("bigint")
    cells = [F.when(item(F.col(quoted(c))).isin(named[c]) if named[c] else F.lit(False),
                    F.struct(F.lit(c).alias("column_name"), item(F.col(quoted(c))).alias("item"),
                             F.col(quoted(c)).cast("string").alias("value"))) for c in columns]
    counts = (df.select(F.explode(F.array_compact(F.array(*cells))).alias("c"))
              .groupBy("c.column_name", "c.item").agg(F.count(F.lit(1)).alias("row_count"), F.max("c.value").alias("value")))
    return counts.where(F.col("row_count") >= F.lit(share) * n).select(
        "column_name", "value", "row_count", P.percent(F.col("row_count"), n).alias("pct"))
