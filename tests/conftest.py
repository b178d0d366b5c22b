import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from plumbline.session import local_session  # noqa: E402
from plumbline.sources.registry import Warehouse  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def clean_star(spark, sales: int = 500_000) -> Warehouse:
    """A star without any defect, in the documented sizes."""
    customers = spark.range(1, 10_001).selectExpr(
        "id as customer_key", "concat('CUS', lpad(cast(id as string), 6, '0')) as customer_id",
        "concat('Customer ', id) as customer_name", "concat('c', id, '@example.com') as email", "'Springfield' as city",
        "'IL' as state", "cast(10000 + id as int) as zip_code",
        "element_at(array('Standard', 'Budget', 'Premium'), cast(id % 3 + 1 as int)) as customer_segment",
        "date '2020-01-01' as effective_date", "date '9999-12-31' as expiry_date", "true as is_current")
    products = spark.range(1, 1_001).selectExpr(
        "id as product_key", "concat('PROD', lpad(cast(id as string), 6, '0')) as product_id",
        "concat('Product ', id) as product_name", "'Garden' as category", "'Tools' as subcategory", "'Acme' as brand",
        "cast(10 + id % 400 as decimal(12,2)) as list_price", "cast(5 + id % 200 as decimal(12,2)) as cost_price",
        "true as is_active").withColumn("cost_price", _least_cost())
    stores = spark.range(1, 201).selectExpr(
        "id as store_key", "concat('STR', lpad(cast(id as string), 4, '0')) as store_id",
        "concat('Store ', id) as store_name", "'Springfield' as city", "'IL' as state",
        "element_at(array('West', 'South', 'Northeast', 'Midwest'), cast(id % 4 + 1 as int)) as region",
        "element_at(array('Standard', 'Express', 'Flagship'), cast(id % 3 + 1 as int)) as store_type",
        "date '2010-06-01' as opening_date")
    days = spark.range(0, 366).selectExpr("date_add(date '2024-01-01', cast(id as int)) as full_date").selectExpr(
        "cast(date_format(full_date, 'yyyyMMdd') as int) as date_key", "full_date", "year(full_date) as year_number",
        "quarter(full_date) as quarter_number", "month(full_date) as month_number",
        "date_format(full_date, 'MMMM') as month_name", "weekday(full_date) + 1 as day_of_week",
        "date_format(full_date, 'EEEE') as day_name", "weekday(full_date) >= 5 as is_weekend",
        "false as is_holiday")
    fact = spark.range(1, sales + 1).selectExpr(
        "id as sales_key", "date_format(date_add(date '2024-01-01', cast(id % 366 as int)), 'yyyyMMdd') as d",
        "id % 10000 + 1 as customer_key", "id % 1000 + 1 as product_key", "id % 200 + 1 as store_key",
        "concat('ORD-', lpad(cast(id div 4 as string), 8, '0')) as order_id", "cast(id % 4 + 1 as int) as order_line_num",
        "cast(id % 5 + 1 as int) as quantity", "cast(20 + id % 50 as decimal(12,2)) as unit_price",
        "cast(10 + id % 10 as decimal(12,2)) as unit_cost", "cast(1 as decimal(12,2)) as discount_amount").selectExpr(
        "sales_key", "cast(d as int) as date_key", "customer_key", "product_key", "store_key", "order_id",
        "order_line_num", "quantity", "unit_price", "unit_cost", "discount_amount",
        "cast(quantity * unit_price - discount_amount as decimal(14,2)) as net_revenue",
        "cast(quantity * (unit_price - unit_cost) - discount_amount as decimal(14,2)) as gross_profit",
        "cast(1.5 as decimal(12,2)) as tax_amount")
    return Warehouse({"dim_customer": customers, "dim_product": products, "dim_store": stores, "dim_date": days,
                      "fact_sales": fact})


def _least_cost():
    from pyspark.sql import functions as F

    return F.least(F.col("cost_price"), F.col("list_price") - 1).cast("decimal(12,2)")


@pytest.fixture(scope="session")
def star(spark):
    return clean_star(spark)


@pytest.fixture(scope="session")
def mirror_results(spark, star):
    """Results of the full suites on the star with all defects, computed once."""
    from plumbline.operators.defects import inject
    from plumbline.operators.validate import validate_all
    from plumbline.plans.suites import consolidated

    results = validate_all(inject(star, "2026-04-29"), consolidated(), as_of="2026-04-29")
    return spark.createDataFrame(results.collect(), results.schema)


@pytest.fixture(scope="session")
def small_star(spark):
    return clean_star(spark, 5_000)
