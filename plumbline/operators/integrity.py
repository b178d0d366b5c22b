"""Referential integrity of the fact against its dimensions."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import keys as K
from plumbline.functions import predicates as P
from plumbline.functions.keys import ForeignKey

# The foreign keys of the star with their rule ids.
RELATIONSHIPS = (
    ForeignKey("date_key", "dim_date", "date_key", "R-009"),
    ForeignKey("customer_key", "dim_customer", "customer_key", "R-008"),
    ForeignKey("product_key", "dim_product", "product_key", "R-010"),
    ForeignKey("store_key", "dim_store", "store_key", "R-011"),
)


def orphan_report(tables: Mapping[str, DataFrame], keys=RELATIONSHIPS,
                  broadcast_bytes: int = K.BROADCAST_BYTES) -> DataFrame:
    """check_name, rule_id, orphan_count, status for every foreign key.

    Keys of dimensions that fit a broadcast, as they are or as bitmaps, are looked up in one scan of each referring table; the others are counted per distinct
    key first.
    """
    keys = list(keys)
    small = K.lookups(keys, tables, broadcast_bytes)
    names = [k.name for k in keys]
    label = {k: k.name if names.count(k.name) == 1 else f"{k.source}.{k.column} -> {k.table}" for k in keys}
    parts = []
    for source in dict.fromkeys(k.source for k in keys):
        near = [k for k in keys if k.source == source and k.flag in small]
        flagged = tables[source]
        for k in near:
            flagged = K.mark(flagged, k, small[k.flag])
        if near:
            wide = flagged.agg(*[F.count(F.when(F.col(k.flag), 1)).alias(k.flag) for k in near])
            named = F.create_map(*[F.lit(v) for k in near for v in (k.flag, label[k])])
            parts.append(wide.unpivot([], wide.columns, "flag", "orphan_count").select(
                named[F.col("flag")].alias("check_name"), "orphan_count"))
    parts += [K.orphan_count(tables[k.source], k, tables[k.table]).select(
        F.lit(label[k]).alias("check_name"), F.col("orphans").alias("orphan_count"))
        for k in keys if k.flag not in small]
    rule = F.create_map(*[F.lit(v) for k in keys for v in (label[k], k.rule_id or "")])
    return reduce(DataFrame.unionByName, parts).select(
        "check_name", rule[F.col("check_name")].alias("rule_id"), F.col("orphan_count").cast("bigint"),
        F.when(F.col("orphan_count") == 0, "PASS").otherwise("FAIL").alias("status"))


def scorecard(tables: Mapping[str, DataFrame], keys=RELATIONSHIPS) -> DataFrame:
    """One row: orphans per dimension, broken revenue, and two clean shares.

    ``clean_pct`` subtracts every violation, so a row with two of them counts twice; ``distinct_clean_pct`` counts
    rows without any violation.
    """
    flagged, flags = K.with_orphan_flags(tables["fact_sales"], list(keys), tables)
    broken = F.coalesce(P.revenue_gap() > F.lit(P.CENT), F.lit(False))
    dirty = reduce(Column.__or__, [*flags.values(), broken])
    names = {k.flag: f"orphan_{k.table.removeprefix('dim_')}" for k in keys}
    counted = flagged.agg(F.count(F.lit(1)).alias("fact_rows"),
                          *[F.count_if(flag).alias(names[c]) for c, flag in flags.items()],
                          F.count_if(broken).alias("revenue_broken"), F.count_if(~dirty).alias("clean_rows"))
    violations = reduce(Column.__add__, [F.col(n) for n in (*names.values(), "revenue_broken")])
    return counted.select(
        "fact_rows", *names.values(), "revenue_broken",
        P.percent(F.col("fact_rows") - violations, F.col("fact_rows")).alias("clean_pct"),
        P.percent(F.col("clean_rows"), F.col("fact_rows")).alias("distinct_clean_pct"))
