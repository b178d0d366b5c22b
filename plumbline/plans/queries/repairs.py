"""R: repairs of the defective warehouse, quarantine, and the promotion gate."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import repair
from plumbline.operators.defects import inject
from plumbline.operators.integrity import RELATIONSHIPS
from plumbline.operators.validate import validate_all
from plumbline.plans.queries import AS_OF
from plumbline.plans.suites import consolidated
from plumbline.session import new_table_path
from plumbline.sources.star import product, star

CUSTOMER = next(k for k in RELATIONSHIPS if k.table == "dim_customer")


def mirror(spark, sf_dir):
    return inject(star(spark, sf_dir), AS_OF)


def customers(change, *columns):
    def query(spark, sf_dir):
        return change(mirror(spark, sf_dir)["dim_customer"]).select("customer_key", *columns)
    return query


def price_reference(spark, sf_dir) -> DataFrame:
    """erp_product_master: a standard price per product, and a second, lower entry for the same products."""
    base = product(spark, sf_dir).select("product_id", (F.col("cost_price") * 2).alias("standard_price"))
    return base.unionByName(base.withColumn("standard_price", F.col("standard_price") - 1))


def backfill(spark, sf_dir):
    repaired = repair.backfill_price(mirror(spark, sf_dir)["dim_product"], price_reference(spark, sf_dir))
    return repaired.select("product_key", "product_id", "list_price", "cost_price")


def totals(df: DataFrame) -> DataFrame:
    return df.groupBy("store_key").agg(F.count(F.lit(1)).alias("rows"), F.sum("net_revenue").alias("net_revenue"))


def split_by_key(side: int):
    def query(spark, sf_dir):
        w = mirror(spark, sf_dir)
        part = repair.split_orphans(w["fact_sales"], CUSTOMER, w)[side]
        return totals(part) if side == 0 else repair.stamped(part, f"{AS_OF} 06:30:00").withColumn(
            "quarantined_at", F.to_date("quarantined_at"))
    return query


def conserved(spark, sf_dir):
    w = mirror(spark, sf_dir)
    clean, orphans = repair.split_orphans(w["fact_sales"], CUSTOMER, w)
    return repair.conserved(w["fact_sales"], repair.split_returns(clean) + (orphans,))


def routed(spark, sf_dir):
    """Both sides of the orphan split, written in one pass."""
    w = mirror(spark, sf_dir)
    sides = repair.route_orphans(w["fact_sales"], CUSTOMER, w, new_table_path(spark, "fact_split"))
    return reduce(DataFrame.unionAll, [
        totals(df).select(F.lit(name).alias("side"), "store_key", "rows", "net_revenue")
        for name, df in zip(("clean", "orphan"), sides)])


def returns(side: int):
    return lambda spark, sf_dir: totals(repair.split_returns(mirror(spark, sf_dir)["fact_sales"])[side])


def by_type(spark, sf_dir):
    """Routed into one folder per type, then read back."""
    path = new_table_path(spark, "fact_by_type")
    repair.route_by_type(mirror(spark, sf_dir)["fact_sales"], path)
    return spark.read.parquet(path).groupBy("transaction_type").agg(
        F.count(F.lit(1)).alias("rows"), F.sum("net_revenue").alias("net_revenue"))


def gated(spark, sf_dir):
    return repair.gate(validate_all(mirror(spark, sf_dir), consolidated(), as_of=AS_OF))


def quarantined(spark, sf_dir):
    w = mirror(spark, sf_dir)
    _, rejected = repair.quarantine_critical(w["fact_sales"], consolidated()["fact_sales"], w)
    return rejected.select("sales_key", "order_id", "customer_key", "quantity", "violations")


def promoted(spark, sf_dir):
    w = mirror(spark, sf_dir)
    return totals(repair.quarantine_critical(w["fact_sales"], consolidated()["fact_sales"], w)[0])


def repaired(spark, sf_dir):
    w = mirror(spark, sf_dir)
    clean, _ = repair.split_orphans(w["fact_sales"], CUSTOMER, w)
    return w.replaced(dim_customer=repair.repair_customers(w["dim_customer"], AS_OF),
                      dim_product=repair.backfill_price(w["dim_product"], price_reference(spark, sf_dir)),
                      fact_sales=repair.split_returns(clean)[0])


def rechecked(spark, sf_dir):
    """The checks of all issues, run again on the repaired warehouse."""
    w, suites = repaired(spark, sf_dir), consolidated()
    issues = [f"DQ-00{n}" for n in range(1, 9)]
    return reduce(DataFrame.unionByName, [
        repair.recheck(w[t], suites[t], w, issues, as_of=AS_OF) for t in ("dim_customer", "dim_product", "fact_sales")
    ]).select("table_name", "check_no", "check_type", "issue_id", "unexpected_count", "status")


def audit(spark, sf_dir):
    before = mirror(spark, sf_dir)["dim_customer"]
    return repair.rows_changed(before, repair.repair_customers(before, AS_OF), "customer_key",
                               ["email", "customer_segment", "expiry_date", "is_current"])


QUERIES = {
    "R1_fill_null": customers(lambda t: repair.fill_null(t, "email", repair.OPT_OUT_EMAIL), "email"),
    "R2_expire_duplicates": customers(lambda t: repair.expire_duplicates(t, AS_OF), "customer_id", "effective_date",
                                      "expiry_date", "is_current"),
    "R3_sentinel_to_null": customers(lambda t: repair.clear_values(t, "email", ["n/a"]), "email"),
    "R4_sentinel_list": customers(lambda t: repair.clear_values(t, "email"), "email"),
    "R5_recode": customers(lambda t: repair.recode(t, "customer_segment", "Platnium", "Premium"), "customer_segment"),
    "R6_backfill_price": backfill,
    "R7_clean_fact": split_by_key(0),
    "R7_quarantined_orphans": split_by_key(1),
    "R7_routed_in_one_pass": routed,
    "R7_rows_conserved": conserved,
    "R8_sales_kept": returns(0),
    "R8_returns_moved": returns(1),
    "R9_email_status": customers(lambda t: repair.email_status(
        repair.fill_null(t, "email", repair.OPT_OUT_EMAIL)), "email_status"),
    "R10_transaction_type": by_type,
    "R11_gate": gated,
    "R11_load_decision": lambda spark, sf_dir: repair.load_decision(gated(spark, sf_dir)),
    "R11_quarantined_rows": quarantined,
    "R11_promoted_rows": promoted,
    "R12_recheck": rechecked,
    "R12_rows_changed": audit,
}
