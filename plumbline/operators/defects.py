"""Reproducible defects: each takes tables and returns new ones, so the source is never changed.

The detection audit compares what was injected with what the checks report.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions import keys as K
from plumbline.functions import predicates as P
from plumbline.sources.registry import Warehouse


@dataclass(frozen=True)
class Defect:
    name: str
    table: str
    dimension: str
    issue_id: str
    expected: int


# The eight defects with the rows each one is meant to touch.
DEFECTS = (
    Defect("D1", "dim_customer", "Completeness", "DQ-001", 300),
    Defect("D2", "dim_customer", "Uniqueness", "DQ-002", 10),
    Defect("D3", "dim_customer", "Validity", "DQ-003", 200),
    Defect("D4", "dim_customer", "Validity", "DQ-004", 50),
    Defect("D5", "dim_product", "Validity", "DQ-005", 15),
    Defect("D6", "dim_product", "Accuracy", "DQ-006", 10),
    Defect("D7", "fact_sales", "Consistency", "DQ-007", 50),
    Defect("D8", "fact_sales", "Validity", "DQ-008", 100),
)
# Key ranges and replacement values of the defects.
NULL_EMAIL_KEYS = (1, 300)
DUPLICATE_KEYS = (1001, 1010)
DUPLICATE_OFFSET = 100_000
SENTINEL_KEYS = (2001, 2200)
SENTINEL = "n/a"
TYPO_KEYS = (3001, 3050)
TYPO = "Platnium"
ZERO_PRICE_KEYS = (101, 115)
INVERTED_KEYS = (201, 210)
INVERSION = 50
ORPHAN_KEY = 999_999
ORPHAN_ROWS = 50
ORPHAN_BASE = 900_000_000_000
RETURN_ROWS = 100


def _set(df: DataFrame, column: str, value, condition: Column) -> DataFrame:
    data_type = df.schema[column].dataType
    value = value if isinstance(value, Column) else F.lit(value)
    return df.withColumn(column, F.when(condition, value.cast(data_type)).otherwise(F.col(column)))


def null_email(customers: DataFrame, keys=NULL_EMAIL_KEYS) -> DataFrame:
    return _set(customers, "email", None, F.col("customer_key").between(*keys))


def duplicate_current(customers: DataFrame, as_of: dt.date, keys=DUPLICATE_KEYS) -> DataFrame:
    """Second current rows under new surrogate keys."""
    copies = customers.where(F.col("customer_key").between(*keys)).withColumns({
        "customer_key": F.col("customer_key") + DUPLICATE_OFFSET,
        "customer_name": F.concat("customer_name", F.lit(" [DUP]")),
        "effective_date": P.as_date(as_of),
        "expiry_date": F.lit(P.OPEN_END),
        "is_current": F.lit(True)})
    return customers.unionByName(copies)


def sentinel_email(customers: DataFrame, keys=SENTINEL_KEYS) -> DataFrame:
    return _set(customers, "email", SENTINEL, F.col("customer_key").between(*keys))


def segment_typo(customers: DataFrame, keys=TYPO_KEYS) -> DataFrame:
    return _set(customers, "customer_segment", TYPO, F.col("customer_key").between(*keys))


def zero_price(products: DataFrame, keys=ZERO_PRICE_KEYS) -> DataFrame:
    return _set(products, "list_price", 0, F.col("product_key").between(*keys))


def cost_over_price(products: DataFrame, keys=INVERTED_KEYS) -> DataFrame:
    return _set(products, "cost_price", F.col("list_price") + INVERSION, F.col("product_key").between(*keys))


def orphan_rows(sales: DataFrame, rows: int = ORPHAN_ROWS) -> DataFrame:
    """Generated sales of a customer that does not exist."""
    # The constants of a generated row.
    constants = {"date_key": 20240615, "customer_key": ORPHAN_KEY, "product_key": 500, "store_key": 50,
                 "order_line_num": 1, "quantity": 2, "unit_price": "100.00", "unit_cost": "60.00",
                 "discount_amount": "5.00", "net_revenue": "195.00", "gross_profit": "75.00", "tax_amount": "15.60"}
    number = F.col("id")
    generated = sales.sparkSession.range(1, rows + 1)
    built = {"sales_key": number + F.lit(ORPHAN_BASE),
             "order_id": F.concat(F.lit("ORD-ORPHAN-"), F.lpad(number.cast("string"), 4, "0"))}
    fields = []
    for field in sales.schema.fields:
        value = built.get(field.name, F.lit(constants.get(field.name)))
        fields.append(value.cast(field.dataType).alias(field.name))
    return sales.unionByName(generated.select(*fields))


def negative_quantity(sales: DataFrame, rows: int = RETURN_ROWS) -> DataFrame:
    """Quantity -1 on the rows with the smallest keys: a top-k gives the cut-off, no full sort and no join."""
    smallest = sales.select("sales_key").orderBy(F.asc_nulls_last("sales_key")).limit(rows)
    return _set(sales, "quantity", -1, F.col("sales_key") <= smallest.agg(F.max("sales_key")).scalar())


def inject(tables: Mapping[str, DataFrame], as_of: dt.date) -> Warehouse:
    """The warehouse with all eight defects."""
    return Warehouse(tables).replaced(
        dim_customer=lambda: segment_typo(sentinel_email(duplicate_current(null_email(tables["dim_customer"]),
                                                                           as_of))),
        dim_product=lambda: cost_over_price(zero_price(tables["dim_product"])),
        fact_sales=lambda: negative_quantity(orphan_rows(tables["fact_sales"])))


# --- audit ---------------------------------------------------------------------------------------------------------

def _customer_hits(customers: DataFrame) -> DataFrame:
    row_hits = customers.agg(F.count_if(F.col("email").isNull()).alias("D1"),
                             F.count_if(F.col("email") == SENTINEL).alias("D3"),
                             F.count_if(F.col("customer_segment") == TYPO).alias("D4"))
    twice = (customers.groupBy("customer_id").agg(F.count_if("is_current").alias("n"))
             .agg(F.count_if(F.col("n") > 1).alias("rows")))
    return _long(row_hits).unionByName(twice.select(F.lit("D2").alias("defect"), "rows"))


def _product_hits(products: DataFrame) -> DataFrame:
    return _long(products.agg(F.count_if(F.col("list_price") == 0).alias("D5"),
                              F.count_if(F.col("cost_price") > F.col("list_price")).alias("D6")))


def _sales_hits(sales: DataFrame, customers: DataFrame) -> DataFrame:
    fk = K.ForeignKey("customer_key", "dim_customer", "customer_key")
    orphans = K.orphan_count(sales, fk, customers).select(F.lit("D7").alias("defect"), F.col("orphans").alias("rows"))
    return orphans.unionByName(_long(sales.agg(F.count_if(F.col("quantity") == -1).alias("D8"))))


def _long(one_row: DataFrame) -> DataFrame:
    """A one-row aggregate as (defect, rows)."""
    return one_row.unpivot([], one_row.columns, "defect", "rows")


def affected_rows(tables: Mapping[str, DataFrame]) -> DataFrame:
    """defect, dimension, rows, expected: what is in the tables against what was meant to be injected."""
    hits = reduce(DataFrame.unionByName, [
        _customer_hits(tables["dim_customer"]), _product_hits(tables["dim_product"]),
        _sales_hits(tables["fact_sales"], tables["dim_customer"])])
    return _with_catalogue(hits).select("defect", "dimension", F.col("rows").cast("bigint").alias("rows"), "expected")


def verify(tables: Mapping[str, DataFrame], defect: str) -> DataFrame:
    """The verification row of one defect: defect, dimension, affected_rows."""
    table = next(d.table for d in DEFECTS if d.name == defect)
    hits = {"dim_customer": lambda: _customer_hits(tables["dim_customer"]),
            "dim_product": lambda: _product_hits(tables["dim_product"]),
            "fact_sales": lambda: _sales_hits(tables["fact_sales"], tables["dim_customer"])}[table]()
    return (_with_catalogue(hits.where(F.col("defect") == defect))
            .select("defect", "dimension", F.col("rows").cast("bigint").alias("affected_rows")))


def _with_catalogue(hits: DataFrame) -> DataFrame:
    dimension = F.create_map(*[F.lit(v) for d in DEFECTS for v in (d.name, d.dimension)])
    expected = F.create_map(*[F.lit(v) for d in DEFECTS for v in (d.name, d.expected)])
    return hits.withColumns({"dimension": dimension[F.col("defect")],
                             "expected": expected[F.col("defect")].cast("bigint")})


def detection(results: DataFrame) -> DataFrame:
    """Per defect: how many checks of its issue failed, and whether it was caught."""
    issue = F.create_map(*[F.lit(v) for d in DEFECTS for v in (d.issue_id, d.name)])
    failed = F.col("status") == "FAIL"
    return (results.where(F.col("issue_id").isNotNull())
            .groupBy(issue[F.col("issue_id")].alias("defect"), "issue_id", "table_name")
            .agg(F.count(F.lit(1)).alias("checks"), F.count_if(failed).alias("failed_checks"))
            .withColumn("caught", F.col("failed_checks") > 0))


def detection_rate(results: DataFrame) -> DataFrame:
    """One row: defects, caught, detection_rate."""
    return detection(results).groupBy("defect").agg(F.max("caught").alias("caught")).agg(
        F.count(F.lit(1)).alias("defects"), F.count_if("caught").alias("caught"),
        P.percent(F.count_if("caught"), F.count(F.lit(1))).alias("detection_rate"))


def outcome(results: DataFrame) -> DataFrame:
    """Predicted against observed result of every check."""
    failed = F.col("status") == "FAIL"
    foreseen = F.coalesce(F.col("predicted") == "FAIL", F.lit(False))
    return results.withColumn(
        "outcome", F.when(failed == foreseen, "MATCH").when(failed, "UNPREDICTED_FAIL").otherwise("MISSED"))
