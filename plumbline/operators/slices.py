"""Where failures come from: a search for the combinations of values that fail more often than the rest.

A slice is one value for each of some dimensions (a store, a day, a category, another broken rule). Its support is the
number of failing rows in it, which can only fall when a condition is added, so a slice is looked at only if all slices
with one condition less have enough. The least support is a share of all failures: at most 1 / ``share`` slices of the same
dimensions can reach it, whatever the number of rows or values. So the driver holds at most that many keys per set of
dimensions.

Two scans of the table. The first counts the values of failing rows, so a dimension may have any number of values. The
second folds the table to one row per combination of the values with support, others taken together; rows meet on the map
side, so a value that holds a third of all rows is no heavier than another. All levels then work on that folded table.

``g2`` is the likelihood ratio of the slice against all other rows, ``gain`` the least one against the rest of a slice with
one condition less: a condition that adds nothing has a gain near 0. Slices that fail no more often than the whole, and
those whose gain is below ``least_gain``, are left out. 10.83 is the 0.1 % point of chi squared with one degree.

Defined cases: no rows or no failures give no slices; NULL is a value of its own, told from the text of the same spelling;
a NULL verdict is no failure; dimensions of one value give no slices of their own.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.session import durable

NULL = "\N{SYMBOL FOR NULL}"  # stands for NULL among the values
MARK = "\N{SYMBOL FOR UNIT SEPARATOR}"  # parts conditions in a key


def g_squared(rows: Column, failures: Column, all_rows: Column, all_failures: Column) -> Column:
    """Twice the log likelihood ratio of a slice's failure rate against that of the other rows of a whole."""
    def cell(seen: Column, row_total: Column, column_total: Column) -> Column:
        s = seen.cast("double")
        expected = row_total.cast("double") * column_total.cast("double") / all_rows.cast("double")
        return F.when(seen > 0, s * F.ln(s / expected)).otherwise(0.0)

    others, passed = all_rows - rows, all_rows - all_failures
    return 2 * (cell(failures, rows, all_failures) + cell(rows - failures, rows, passed)
                + cell(all_failures - failures, others, all_failures)
                + cell(others - (all_failures - failures), others, passed))


def _values(df: DataFrame, failed: Column, dimensions: Mapping[str, Column]) -> DataFrame:
    texts = [F.coalesce(c.cast("string"), F.lit(NULL)).alias(f"d{i}") for i, c in enumerate(dimensions.values())]
    return df.select(F.coalesce(failed, F.lit(False)).alias("failed"), *texts)


def _frequent(values: DataFrame, names: list[str], share: float, least: int) -> tuple[int, int, list[list[str]]]:
    """Number of rows and failures, and the values of each dimension with support: one scan."""
    whole = F.struct(F.lit(-1).alias("i"), F.lit("").alias("value"))
    items = F.array(whole, *[F.when(F.col("failed"), F.struct(F.lit(i).alias("i"), F.col(f"d{i}").alias("value")))
                             for i in range(len(names))])
    counts = durable(values.select("failed", F.explode(F.array_compact(items)).alias("c")).groupBy("c.i", "c.value").agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("failed").alias("failures")))
    total = counts.where("i = -1").first()
    if total is None or not total["failures"]:
        return (total["rows"] if total else 0), 0, [[] for _ in names]
    kept: list[list[str]] = [[] for _ in names]
    enough = (F.col("failures") >= least) & (F.col("failures") >= F.lit(share) * total["failures"])
    for r in counts.where((F.col("i") >= 0) & enough).collect():  # at most 1 / share values of a dimension
        kept[r["i"]].append(r["value"])
    return total["rows"], total["failures"], kept


def _level(folded: DataFrame, size: int, count: int, below: list[str] | None) -> DataFrame:
    """(key, parents, rows, failures) of the slices with ``size`` conditions whose parents are all among ``below``."""
    sets = F.array(*[F.array(*[F.lit(i) for i in s]) for s in combinations(range(count), size)])
    rows = (folded.select("rows", "failures", "codes", F.explode(sets).alias("set"))
            .withColumn("parts", F.transform("set", lambda i: F.get("codes", i)))
            .where(~F.exists("parts", lambda p: p.isNull())))
    key = F.array_join("parts", MARK)
    if size > 1:
        parents = F.transform(F.sequence(F.lit(0), F.lit(size - 1)),
                              lambda j: F.array_join(F.filter("parts", lambda _, i: i != j), MARK))
        rows = rows.withColumn("parents", parents).where(F.forall("parents", lambda p: p.isin(below)))
    else:
        rows = rows.withColumn("parents", F.array(F.lit("")))
    return rows.groupBy(key.alias("key"), "parents", "parts").agg(
        F.sum("rows").alias("rows"), F.sum("failures").alias("failures"))


def slices(df: DataFrame, failed: Column, dimensions: Mapping[str, Column], depth: int = 3, share: float = 0.01,
           least: int = 5, least_gain: float = 10.83) -> DataFrame:
    """(conditions, depth, rows, failures, failure_pct, share_pct, g2, gain): every slice with support that stands out.

    ``conditions`` is a list of ``name=value`` in the order of the dimensions. ``share_pct`` is its part of all failures.
    """
    spark, names = df.sparkSession, list(dimensions)
    empty = spark.createDataFrame([], "conditions array<string>, depth int, rows bigint, failures bigint, "
                                      "failure_pct double, share_pct double, g2 double, gain double")
    values = _values(df, failed, dimensions)
    n, f, kept = _frequent(values, names, share, least)
    if not f:
        return empty
    codes = [F.when(F.col(f"d{i}").isin(vs) if vs else F.lit(False),
                    F.concat(F.lit(f"{names[i]}="), F.col(f"d{i}"))).alias(f"d{i}") for i, vs in enumerate(kept)]
    folded = durable(values.select("failed", *codes).groupBy(*[f"d{i}" for i in range(len(names))]).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if("failed").alias("failures")).select(
        F.array(*[F.col(f"d{i}") for i in range(len(names))]).alias("codes"), "rows", "failures"))
    above = spark.createDataFrame([("", n, f)], "parent string, parent_rows bigint, parent_failures bigint")
    found, below = [], None
    for size in range(1, min(depth, len(names)) + 1):
        level = durable(_level(folded, size, len(names), below).where(
            (F.col("failures") >= least) & (F.col("failures") >= F.lit(share) * f)))
        gains = (level.select("key", "rows", "failures", F.explode("parents").alias("parent")).join(above, "parent")
                 .groupBy("key").agg(F.min(F.when(
                     F.col("failures") * F.col("parent_rows") > F.col("parent_failures") * F.col("rows"),
                     g_squared(F.col("rows"), F.col("failures"), F.col("parent_rows"), F.col("parent_failures"))
                 ).otherwise(0.0)).alias("gain")))
        found.append(level.join(gains, "key").withColumn("depth", F.lit(size)))
        above = level.select(F.col("key").alias("parent"), F.col("rows").alias("parent_rows"),
                             F.col("failures").alias("parent_failures"))
        below = [r["key"] for r in level.select("key").collect()]  # at most 1 / share per set of dimensions
        if not below:
            break
    all_rows, all_failures = F.lit(n).cast("bigint"), F.lit(f).cast("bigint")
    listed = reduce(DataFrame.unionByName, found)
    return (listed.where((F.col("gain") >= least_gain) & (F.col("failures") * all_rows > F.col("rows") * all_failures))
            .select(F.col("parts").alias("conditions"), "depth", "rows", "failures",
                    F.round(F.col("failures") * 100.0 / F.col("rows"), 2).alias("failure_pct"),
                    F.round(F.col("failures") * 100.0 / all_failures, 2).alias("share_pct"),
                    F.round(g_squared(F.col("rows"), F.col("failures"), all_rows, all_failures), 4).alias("g2"),
                    F.round("gain", 4).alias("gain")))
