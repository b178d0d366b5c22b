"""P: profiles and referential integrity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import integrity, profile, sketches
from plumbline.operators.heavy_values import heavy_values
from plumbline.operators.profile_states import ProfileStore, snapshot_versions, table_profile
from plumbline.plans.queries import AS_OF
from plumbline.plans.queries.tables import two_states, year
from plumbline.session import new_table_path
from plumbline.sources.schemas import columns
from plumbline.sources.snapshots import Snapshots, period_text
from plumbline.sources.star import sales, star

SALES_ORDER = ("sales_key", "product_key", "store_key", "quantity", "unit_price", "discount_amount", "tax_amount")


def on(table: str, build):
    return lambda spark, sf_dir: build(star(spark, sf_dir)[table])


def probes(spark, sf_dir):
    w = star(spark, sf_dir)
    wanted = [("bad_price_count", "dim_product", "list_price <= 0"),
              ("cost_exceeds_price", "dim_product", "cost_price >= list_price"),
              ("null_email_count", "dim_customer", "email IS NULL"),
              ("negative_qty_count", "fact_sales", "quantity < 1")]
    parts = [profile.probe(w[t], "hits", rule).select(F.lit(name).alias("probe"), "hits") for name, t, rule in wanted]
    customer = [k for k in integrity.RELATIONSHIPS if k.table == "dim_customer"]
    orphans = integrity.orphan_report(w, customer).select(F.lit("orphan_count").alias("probe"),
                                                         F.col("orphan_count").alias("hits"))
    return reduce(DataFrame.unionByName, [*parts, orphans])


SKETCHED = {"order_id": ["order_id"], "customer_key": ["customer_key"], "order_line": ["order_id", "order_line_num"]}
SPANS = (("all", 0, 9999), ("1995", 1995, 1995), ("1996 on", 1996, 9999))


def sketched_distinct(spark, sf_dir):
    """Distinct keys of the fact over three spans of years, merged from the stored states of each year."""
    path = new_table_path(spark, "sketches")
    sketches.period_states(sales(spark, sf_dir), F.year("load_date"), SKETCHED, hashed=sketches.portable_hash).write.parquet(path)
    states = spark.read.parquet(path)
    return reduce(DataFrame.unionAll, [sketches.distinct_between(states, first, last).select(F.lit(name).alias("span"), "*")
                                       for name, first, last in SPANS])


def stored_states(spark, sf_dir) -> ProfileStore:
    """States of the fact by year, brought up to date after each of two snapshots from the years that changed."""
    before, after = two_states(spark, sf_dir)
    copies = Snapshots(spark, new_table_path(spark, "snapshots"))
    cells = {"order_line_num": F.col("order_line_num"), "quantity": F.col("quantity"), "key_length": F.length("order_id")}
    store = ProfileStore(spark, new_table_path(spark, "profile_states"),
                         table_profile(before.select(*columns("fact_sales")), "fact_sales", cells=cells))
    for state in (before, after):
        copies.take(state, year())
        store.refresh(snapshot_versions(copies), lambda years: copies.read(periods=years), period_text(year()))
    return store


def profile_from_states(spark, sf_dir):
    """The whole profile after the second load, and how many years were read for it."""
    store = stored_states(spark, sf_dir)
    actions = dict(store.index().groupBy("action").count().collect())
    return store.whole().withColumns({f"years_{a.lower()}": F.lit(actions.get(a, 0)) for a in ("READ", "KEPT", "REMOVED")})


def histograms_from_states(spark, sf_dir):
    store = stored_states(spark, sf_dir)
    return reduce(DataFrame.unionAll, [store.histogram(c).select(F.lit(c).alias("column_name"), "value", "row_count")
                                       for c in store.profile.cells])


QUERIES = {
    "P4_profile_from_states": profile_from_states,
    "P13_histograms_from_states": histograms_from_states,
    "P3_distinct_sketches": sketched_distinct,
    "P1_peek_dim_customer": on("dim_customer", lambda t: profile.peek(t, "customer_key")),
    "P1_peek_dim_product": on("dim_product", lambda t: profile.peek(t, "product_key")),
    "P1_peek_dim_store": on("dim_store", lambda t: profile.peek(t, "store_key")),
    "P1_peek_dim_date": on("dim_date", lambda t: profile.peek(t, "date_key")),
    "P1_peek_fact_sales": on("fact_sales", lambda t: profile.peek(t, *SALES_ORDER)),
    "P2_scd2_shape": on("dim_customer", profile.scd2_shape),
    "P3_distinct_composite_key": on("fact_sales", profile.composite_distinct),
    "P4_null_counts_dim_customer": on("dim_customer", profile.null_counts),
    "P4_null_counts_dim_product": on("dim_product", profile.null_counts),
    "P4_null_counts_dim_store": on("dim_store", profile.null_counts),
    "P4_null_counts_fact_sales": on("fact_sales", profile.null_counts),
    **{f"P4_whole_profile_{t}": on(t, (lambda name: lambda df: profile.whole_profile(df, name, AS_OF))(t))
       for t in ("dim_customer", "dim_product", "dim_store", "fact_sales")},
    "P5_null_rates": on("dim_customer", lambda t: profile.null_rates(t, ["email", "customer_segment"])),
    "P6_heavy_values": on("fact_sales", lambda t: heavy_values(
        t, ["customer_key", "order_id", "date_key", "quantity", "discount_amount", "unit_price"], 0.0045)),
    "P6_distribution_pct": on("dim_customer", lambda t: profile.by_size(
        profile.distribution(t, "customer_segment", pct=True))),
    "P7_distribution_category": on("dim_product", lambda t: profile.by_size(profile.distribution(t, "category"))),
    "P7_distribution_store_type": on("dim_store", lambda t: profile.by_size(profile.distribution(t, "store_type"))),
    "P7_distribution_region": on("dim_store", lambda t: profile.by_size(profile.distribution(t, "region"))),
    "P8_email_classes": on("dim_customer", profile.email_classes),
    "P9_date_sanity": on("dim_customer", lambda t: profile.date_sanity(t, AS_OF)),
    "P10_uniqueness_dim_product": on("dim_product", lambda t: profile.uniqueness(t, "product_key", "product_id")),
    "P10_uniqueness_dim_store": on("dim_store", lambda t: profile.uniqueness(t, "store_key", "store_id")),
    "P11_price_validity": on("dim_product", profile.price_validity),
    "P12_opening_dates": on("dim_store", lambda t: profile.opening_dates(t, AS_OF)),
    "P13_length_histogram": on("dim_store", lambda t: profile.by_size(
        profile.distribution(t, F.length("city"), "city_length"))),
    "P13_state_length": on("dim_store", lambda t: profile.by_size(
        profile.distribution(t, F.length("state"), "state_length"))),
    "P14_calendar_coverage": on("dim_date", profile.calendar_coverage),
    "P15_calendar_domains": on("dim_date", profile.calendar_domains),
    "P16_date_key_format": on("dim_date", profile.date_key_format),
    "P17_duplicate_sample": on("fact_sales", lambda t: profile.duplicate_sample(t, ["order_id", "order_line_num"])),
    "P18_measure_validity": on("fact_sales", profile.measure_validity),
    "P19_arithmetic": on("fact_sales", profile.arithmetic),
    "P20_orphan_report": lambda spark, sf_dir: integrity.orphan_report(star(spark, sf_dir)),
    # a bound below the keys of the larger dimensions, but not below their bitmaps
    "P20_orphan_report_bitmaps": lambda spark, sf_dir: integrity.orphan_report(star(spark, sf_dir), broadcast_bytes=20_000),
    "P20_orphan_report_large_dimensions": lambda spark, sf_dir: integrity.orphan_report(
        star(spark, sf_dir), broadcast_bytes=0),
    "P21_scorecard": lambda spark, sf_dir: integrity.scorecard(star(spark, sf_dir)),
    "P22_probes": probes,
    "P23_missing_days": on("dim_date", profile.missing_days),
}
