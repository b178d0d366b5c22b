"""D and I: defect injection, detection audit, and the drill-down into failures."""

from __future__ import annotations

from pyspark.sql import functions as F

from plumbline.functions import predicates as P
from plumbline.operators import defects, investigate
from plumbline.operators.slices import slices
from plumbline.operators.validate import validate_all
from plumbline.plans.queries import AS_OF
from plumbline.plans.suites import consolidated
from plumbline.session import new_table_path
from plumbline.sources.star import star


def mirror(spark, sf_dir):
    return defects.inject(star(spark, sf_dir), AS_OF)


def changed(table: str, change):
    """The whole table after one defect."""
    return lambda spark, sf_dir: change(star(spark, sf_dir)[table])


def on_mirror(table: str, build):
    return lambda spark, sf_dir: build(mirror(spark, sf_dir)[table])


def failure_slices(spark, sf_dir):
    """Where rows with a broken revenue identity come from, other broken rules among the dimensions."""
    w = mirror(spark, sf_dir)
    # judged before the joins, which may shuffle: verdicts are shorter than amounts
    judged = w["fact_sales"].select("store_key", "product_key", F.expr("date_key div 10000").alias("year"),
                                    F.col("order_line_num").alias("line"), (F.col("quantity") < 1).alias("below"),
                                    (F.col("gross_profit") < 0).alias("loss"),
                                    (P.revenue_gap() > F.lit(P.CENT)).alias("broken"))
    facts = (judged.join(w["dim_store"].select("store_key", "region"), "store_key", "left")
             .join(w["dim_product"].select("product_key", "brand"), "product_key", "left")
             .drop("store_key", "product_key"))
    path = new_table_path(spark, "judged_sales")  # scanned twice; each scan would join anew
    facts.write.parquet(path)
    dimensions = {"year": F.col("year"), "line": F.col("line"), "region": F.col("region"), "brand": F.col("brand"),
                  "quantity below 1": F.col("below"), "loss": F.col("loss")}
    return slices(spark.read.schema(facts.schema).parquet(path), F.col("broken"), dimensions)


def results(spark, sf_dir):
    return validate_all(mirror(spark, sf_dir), consolidated(), as_of=AS_OF)


def quantities(sales):
    return sales.groupBy("quantity").agg(F.count(F.lit(1)).alias("rows"), F.min("sales_key").alias("min_sales_key"),
                                         F.sum("net_revenue").alias("net_revenue"))


def by_class(sales):
    """The whole fact after the orphan rows came in: generated rows and all others."""
    return sales.groupBy((F.col("customer_key") == 999999).alias("generated")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("sales_key").alias("keys"),
        F.max("order_id").alias("max_order_id"), F.sum("quantity").alias("quantity"),
        F.sum("net_revenue").alias("net_revenue"), F.sum("gross_profit").alias("gross_profit"))


QUERIES = {
    "D1_null_email": changed("dim_customer", defects.null_email),
    "D2_duplicate_current": changed("dim_customer", lambda t: defects.duplicate_current(t, AS_OF)),
    "D3_sentinel_email": changed("dim_customer", defects.sentinel_email),
    "D4_segment_typo": changed("dim_customer", defects.segment_typo),
    "D5_zero_price": changed("dim_product", defects.zero_price),
    "D6_cost_over_price": changed("dim_product", defects.cost_over_price),
    "D7_orphan_rows": changed("fact_sales", lambda t: by_class(defects.orphan_rows(t))),
    "D8_negative_quantity": changed("fact_sales", lambda t: quantities(defects.negative_quantity(t))),
    **{f"D9_verify_{d.name}": (lambda n: lambda spark, sf_dir: defects.verify(mirror(spark, sf_dir), n))(d.name)
       for d in defects.DEFECTS},
    "D10_affected_rows": lambda spark, sf_dir: defects.affected_rows(mirror(spark, sf_dir)).orderBy("defect"),
    "D11_detection": lambda spark, sf_dir: defects.detection(results(spark, sf_dir)),
    "D11_detection_rate": lambda spark, sf_dir: defects.detection_rate(results(spark, sf_dir)),
    "D12_predicted_outcome": lambda spark, sf_dir: defects.outcome(results(spark, sf_dir)).select(
        "table_name", "check_no", "predicted", "status", "outcome"),
    "I1_top_duplicates": on_mirror("fact_sales", lambda t: investigate.top_duplicates(t, ["order_id", "order_line_num"])),
    "I2_top_revenue_breaks": on_mirror("fact_sales", investigate.top_revenue_breaks),
    "I3_top_profit_breaks": on_mirror("fact_sales", investigate.top_profit_breaks),
    "I4_below_minimum": on_mirror("fact_sales", investigate.below_minimum),
    "I5_lowest_tax": on_mirror("fact_sales", investigate.lowest),
    "I6_margin_deficit": on_mirror("dim_product", investigate.margin_deficit),
    "I7_unpriced": on_mirror("dim_product", investigate.unpriced),
    "I8_failure_slices": failure_slices,
    "I8_root_cause": on_mirror("fact_sales", investigate.root_cause),
}
