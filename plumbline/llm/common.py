"""What several operators here share: reading tables, word rules, train/held-out split, joins with small tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from plumbline.session import new_table_path

# A word is a run of anything but ASCII white space; ``bytes.split()`` splits at the same characters.
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

# Rows that a table of short rows may have to be broadcast; counted before use.
BROADCAST_ROWS = 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(key: Column, modulus: int) -> Column:
    """crc32 of the key as text, modulo ``modulus``. A NULL key counts as the empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % modulus


def null_safe_key(col: Column) -> Column:
    """A text that is never NULL and differs for NULL and for every value, so that plain equi-joins work."""
    return F.coalesce(F.concat(F.lit("="), col.cast("string")), F.lit(""))


def join_lookup(df: DataFrame, lookup: DataFrame, on: list[str], rows: int, how: str = "left") -> DataFrame:
    """Join with a table of ``rows`` counted rows: broadcast below the bound, else shuffled (skew left to AQE)."""
    return df.join(F.broadcast(lookup) if rows <= BROADCAST_ROWS else lookup, on, how)


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """From now on the Python tasks of this session get their rows in Arrow batches of about BATCH_BYTES.

    A batch exists several times, outside the JVM's heap and in the worker, and both keep what they once took. Spark's
    own bound is 64 MB; results do not depend on it.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


# For rows of a megabyte: a page or row group is closed by its bytes, not after a hundred rows at the earliest.
LARGE_ROWS = {"parquet.page.size.row.check.min": 1, "parquet.block.size.row.check.min": 1, "parquet.block.size": 2 * BATCH_BYTES}


def stored(df: DataFrame, name: str, **options: str | int) -> DataFrame:
    """The frame, written to the shared folder once (with these options of the writer) and read from there."""
    path = new_table_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.parquet(path)


ROW_BITS = 33  # of monotonically_increasing_id: the partition's number is above them


def ranked(df: DataFrame, *order: str) -> DataFrame:
    """The rows with ``at``, their position (from 0) in this order, NULL first; rows equal in it are in any order.

    One sort by range; equal rows are dealt over tasks as well. A task's number of rows before it comes in as one short
    row per task.
    """
    tie, place = "__tie__", "__place__"
    rows = stored(df.withColumn(tie, F.monotonically_increasing_id()).repartitionByRange(*order, tie)
                  .sortWithinPartitions(*order, tie).drop(tie).withColumn(place, F.monotonically_increasing_id()), "ranked")
    task = F.shiftright(place, ROW_BITS)
    earlier = Window.orderBy("__task__").rowsBetween(Window.unboundedPreceding, -1)  # one row per task
    sizes = rows.groupBy(task.alias("__task__")).agg(F.count(F.lit(1)).alias("__n__"))
    before = sizes.select("__task__", F.coalesce(F.sum("__n__").over(earlier), F.lit(0)).alias("__before__"))
    return (rows.withColumn("__task__", task).join(F.broadcast(before), "__task__")
            .withColumn("at", F.col("__before__") + F.col(place).bitwiseAND(F.lit((1 << ROW_BITS) - 1)))
            .drop("__task__", "__before__", place))
