"""Repairs: a table in, a repaired table out. Rows are kept whole; what leaves one table arrives in another."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import keys as K
from plumbline.functions import predicates as P
from plumbline.functions.keys import ForeignKey
from plumbline.operators.checks import Check, Suite
from plumbline.operators.validate import ROW_PREDICATES, foreign_key, is_row_local, quoted, validate, violation
from plumbline.session import durable

# Sentinels and replacements used by the repairs.
OPT_OUT_EMAIL = "optout@example.com"
EMAIL_SENTINELS = ("n/a", "N/A", "na", "NA", "")
LATEST_BYTES = 64  # of a row of latest versions, beside its key


def fill_null(df: DataFrame, column: str, value) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(value)))


def clear_values(df: DataFrame, column: str, values: Iterable[str] = EMAIL_SENTINELS) -> DataFrame:
    """Sentinel values become NULL. Run before ``fill_null``, since it raises the NULL rate."""
    return df.withColumn(column, F.when(F.col(column).isin(list(values)), None).otherwise(F.col(column)))


def recode(df: DataFrame, column: str, old: str, new: str) -> DataFrame:
    return df.withColumn(column, F.when(F.col(column) == old, new).otherwise(F.col(column)))


def expire_duplicates(customers: DataFrame, as_of: dt.date | str, business_key: str = "customer_id") -> DataFrame:
    """Keep the latest current row per business key and close the others on the day before ``as_of``.

    Every business key with a current row before has exactly one after. The latest row is a maximum, combined on the map
    side, and not a window: a key with very many rows never sits in one task. Only keys with several current rows are
    joined back. A row is never closed before it began. Rows equal in date and key are told apart by a hash of all their
    columns; of rows equal in everything one stays current and the others are closed. Rows without business key stay as
    they are.
    """
    columns = [F.col(quoted(c)) for c in customers.columns]
    rank = F.struct(F.col("effective_date"), F.col("customer_key"), F.xxhash64(*columns).alias("tie"))
    current = (customers.where(F.col("is_current") & F.col(business_key).isNotNull())
               .groupBy(F.col(business_key).alias("ref_key"), rank.alias("latest")).agg(F.count(F.lit(1)).alias("equal")))
    latest = durable(current.groupBy("ref_key").agg(
        F.sum("equal").alias("n"), F.max("latest").alias("__latest__"), F.max_by("equal", "latest").alias("__equal__"))
        .where("n > 1").drop("n"))
    # Beside its key, a broadcast row holds the date, the key and the hash of the latest row, and a count.
    lookup = F.broadcast(latest) if K.small_enough({"latest": (latest, "ref_key")}, more=LATEST_BYTES) else latest
    closed = F.greatest(F.col("effective_date"), F.date_sub(P.as_date(as_of), 1))

    def close(rows: DataFrame, superseded: Column) -> DataFrame:
        return (rows.withColumn("__superseded__", superseded)
                .withColumns({"expiry_date": F.when(F.col("__superseded__"), closed).otherwise(F.col("expiry_date")),
                              "is_current": F.col("is_current") & ~F.col("__superseded__")})
                .select(*columns))

    joined = customers.join(lookup, F.col(business_key) == F.col("ref_key"), "left").withColumn("__rank__", rank)
    older = F.coalesce(F.col("is_current") & (F.col("__rank__") < F.col("__latest__")), F.lit(False))
    if not latest.where("__equal__ > 1").take(1):
        return close(joined, older)
    # Copies of one row: grouped by their hash, numbered, and all but the first closed.
    copy = F.coalesce(F.col("is_current") & (F.col("__equal__") > 1) & (F.col("__rank__") == F.col("__latest__")),
                      F.lit(False))
    copies = (joined.where(copy).groupBy(F.col("ref_key"), F.col("__rank__.tie").alias("__tie__"))
              .agg(F.count(F.lit(1)).cast("int").alias("__n__"), F.first(F.struct(*columns)).alias("__row__"))
              .select("__row__.*", F.explode(F.sequence(F.lit(1), F.col("__n__"))).alias("__copy__")))
    return close(joined.where(~copy), older).unionByName(close(copies, F.col("__copy__") > 1))


def backfill_price(products: DataFrame, reference: DataFrame) -> DataFrame:
    """Take the standard price where the list price is not positive.

    The reference is reduced to one price per product, so a repeated reference row cannot multiply products. One left
    join: products are read once, and those with a price match nothing.
    """
    price = reference.groupBy(F.col("product_id").alias("_id")).agg(F.max("standard_price").alias("_price"))
    data_type = products.schema["list_price"].dataType
    joined = products.join(price, (F.col("product_id") == F.col("_id")) & (F.col("list_price") <= 0), "left")
    return joined.withColumn("list_price", F.coalesce("_price", "list_price").cast(data_type)).select(*products.columns)


def split(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """(kept, moved): a row moves only where the condition is true; NULL stays."""
    hit = F.coalesce(condition, F.lit(False))
    return df.where(~hit), df.where(hit)


def split_orphans(fact: DataFrame, key: ForeignKey, tables: Mapping[str, DataFrame]) -> tuple[DataFrame, DataFrame]:
    """(clean, orphans) for one foreign key."""
    flagged, flags = K.with_orphan_flags(fact, [key], tables)
    clean, orphans = split(flagged, flags[key.flag])
    return clean.select(*fact.columns), orphans.select(*fact.columns)


def write_split(df: DataFrame, condition: Column, path: str) -> tuple[DataFrame, DataFrame]:
    """(kept, moved) written in one pass over the input, one folder each, and read back from there."""
    spark = df.sparkSession
    df.withColumn("moved", F.coalesce(condition, F.lit(False))).write.mode("overwrite").partitionBy("moved").parquet(path)
    stored = spark.read.schema(df.withColumn("moved", F.lit(False)).schema).parquet(path)
    return stored.where(~F.col("moved")).drop("moved"), stored.where("moved").drop("moved")


def route_orphans(fact: DataFrame, key: ForeignKey, tables: Mapping[str, DataFrame],
                  path: str) -> tuple[DataFrame, DataFrame]:
    """``split_orphans`` for large facts: the fact is read once and both sides are stored."""
    flagged, flags = K.with_orphan_flags(fact, [key], tables)
    condition = flags[key.flag]
    clean, orphans = write_split(flagged.select(*fact.columns, condition.alias("orphan")), F.col("orphan"), path)
    return clean.drop("orphan"), orphans.drop("orphan")


def split_returns(fact: DataFrame) -> tuple[DataFrame, DataFrame]:
    return split(fact, F.col("quantity") < 1)


def stamped(rows: DataFrame, as_of: str) -> DataFrame:
    """Rows as a quarantine table stores them."""
    return rows.withColumn("quarantined_at", F.lit(as_of).cast("timestamp"))


def email_status(customers: DataFrame) -> DataFrame:
    """active: a well-formed address; optout: the opt-out address; unknown: everything else."""
    email = F.col("email")
    status = (F.when(email == OPT_OUT_EMAIL, "optout").when(email.rlike(P.anchored(P.EMAIL)), "active")
              .otherwise("unknown"))
    return customers.withColumn("email_status", status)


def transaction_type(fact: DataFrame) -> DataFrame:
    """SALE, RETURN or EXCHANGE by the sign of the quantity; unknown quantities count as sales."""
    quantity = F.coalesce(F.col("quantity"), F.lit(1))
    return fact.withColumn("transaction_type",
                           F.when(quantity > 0, "SALE").when(quantity < 0, "RETURN").otherwise("EXCHANGE"))


def route_by_type(fact: DataFrame, path: str) -> None:
    """One folder per transaction type, written in one pass."""
    transaction_type(fact).write.mode("overwrite").partitionBy("transaction_type").parquet(path)


# --- promotion gate ------------------------------------------------------------------------------------------------

# Failed checks of these kinds are critical on a fact table, as are all of severity critical.
CRITICAL_KINDS = ("references", "revenue_identity", "profit_identity")


def is_critical(check: Check) -> bool:
    return check.kind in CRITICAL_KINDS or check.severity == "critical"


def _critical_result() -> Column:
    """``is_critical`` of the check of a result row."""
    return F.col("check_type").isin(*CRITICAL_KINDS) | F.coalesce(F.col("severity") == "critical", F.lit(False))


def by_rows(check: Check) -> bool:
    """Whether single rows can be told to break the check."""
    return is_row_local(check) or check.kind == "references"


def gate(results: DataFrame) -> DataFrame:
    """table_name, failed, critical_failed, decision.

    A failed dimension blocks the load. A fact with critical failures has those rows quarantined; critical failures that
    no single row shows (of key checks, row counts or custom SQL) block it, and so does any check that was not run.
    Other failures only raise an alert.
    """
    failed = F.col("status") != "PASS"
    critical = failed & _critical_result()
    whole = critical & ~F.col("check_type").isin(*ROW_PREDICATES, "references")
    stop = F.col("table_name").startswith("dim_") | (F.col("not_run") > 0) | (F.col("critical_whole") > 0)
    decision = (F.when(F.col("failed") == 0, "promote").when(stop, "block")
                .when(F.col("critical_failed") > 0, "quarantine").otherwise("promote_with_alert"))
    return (results.groupBy("table_name")
            .agg(F.count_if(failed).alias("failed"), F.count_if(critical).alias("critical_failed"),
                 F.count_if(F.col("status") == "NOT_RUN").alias("not_run"), F.count_if(whole).alias("critical_whole"))
            .withColumn("decision", decision).drop("not_run", "critical_whole"))


def load_decision(gated: DataFrame) -> DataFrame:
    """One row for the whole load: any blocked dimension stops the facts."""
    return gated.agg(F.when(F.max(F.col("decision") == "block"), "block")
                     .when(F.max(F.col("decision") == "quarantine"), "quarantine")
                     .when(F.max(F.col("decision") == "promote_with_alert"), "promote_with_alert")
                     .otherwise("promote").alias("decision"))


def tag_violations(df: DataFrame, checks: Iterable[Check], refs: Mapping[str, DataFrame], as_of=None) -> DataFrame:
    """The table with ``violations``: names of the row checks and foreign keys each row breaks, from one scan."""
    checks = [c for c in checks if by_rows(c)]
    foreign = [foreign_key(c) for c in checks if c.kind == "references"]
    flagged, flags = K.with_orphan_flags(df, foreign, refs)
    names = []
    for check in checks:
        broken = flags[foreign_key(check).flag] if check.kind == "references" else violation(check, df, as_of)
        names.append(F.when(broken, f"{check.kind}:{check.column_name}"))
    return flagged.withColumn("violations", F.array_compact(F.array(*names))).select(*df.columns, "violations")


def quarantine_critical(fact: DataFrame, suite: Suite, refs: Mapping[str, DataFrame], path: str | None = None,
                        as_of=None) -> tuple[DataFrame, DataFrame]:
    """(promoted, quarantined): rows that break a critical check are set aside with the reasons.

    Given a path, both sides are written there in one pass over the fact and read back; without it, each side scans the
    fact when it is used.
    """
    tagged = tag_violations(fact, [c for c in suite.checks if is_critical(c)], refs, as_of)
    broken = F.size("violations") > 0
    promoted, quarantined = split(tagged, broken) if path is None else write_split(tagged, broken, path)
    return promoted.drop("violations"), quarantined


def recheck(df: DataFrame, suite: Suite, refs: Mapping[str, DataFrame], issues: Iterable[str], **options) -> DataFrame:
    """Run the checks of some issues again, after a repair."""
    return validate(df, suite.subset(issues=issues), refs, **options)


def rows_changed(before: DataFrame, after: DataFrame, key: str, columns: Iterable[str]) -> DataFrame:
    """Audit of a repair: changed rows per column.

    One short row (key, a hash of each value, sign) enters the shuffle per table row. Rows that are equal on both sides
    cancel out on the way; of the rest, values per key and column that are there more often after the repair count. No
    rows are paired, so a repeated or hot key costs nothing extra.
    """
    columns = list(columns)

    def hashed(df: DataFrame, sign: int) -> DataFrame:
        return df.select(key, *[F.xxhash64(F.col(c).cast("string")).alias(c) for c in columns], F.lit(sign).alias("sign"))

    differing = (hashed(after, 1).unionAll(hashed(before, -1)).groupBy(key, *columns).agg(F.sum("sign").alias("sign"))
                 .where("sign <> 0"))
    surplus = (differing.unpivot([key, "sign"], columns, "column_name", "value").groupBy("column_name", key, "value")
               .agg(F.sum("sign").alias("surplus")))
    counted = surplus.groupBy("column_name").agg(F.sum(F.greatest("surplus", F.lit(0))).alias("rows_changed"))
    names = df_of_names(before, columns)
    return names.join(counted, "column_name", "left").select(
        "column_name", F.coalesce("rows_changed", F.lit(0)).cast("bigint").alias("rows_changed"))


def df_of_names(df: DataFrame, names: list[str]) -> DataFrame:
    return df.sparkSession.createDataFrame([(n,) for n in names], "column_name string")


def repair_customers(customers: DataFrame, as_of) -> DataFrame:
    """All repairs of the customer dimension, in the order in which they do not undo each other."""
    repaired = recode(customers, "customer_segment", "Platnium", "Premium")
    repaired = clear_values(repaired, "email")
    repaired = fill_null(repaired, "email", OPT_OUT_EMAIL)
    return expire_duplicates(repaired, as_of)


def conserved(whole: DataFrame, parts: Iterable[DataFrame]) -> DataFrame:
    """rows_in and rows_out of a split; they must be equal."""
    out = reduce(DataFrame.unionAll, [p.agg(F.count(F.lit(1)).alias("n")) for p in parts])
    return whole.agg(F.count(F.lit(1)).alias("rows_in")).withColumn(
        "rows_out", out.agg(F.sum("n").alias("n")).scalar())
