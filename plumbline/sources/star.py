"""The retail star derived from the supplied order tables, with deliberate defects (see FIXTURES.md §3).

Money is derived from whole cents, never by casting a binary double to a decimal, so every engine gets the same value.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import new_table_path
from plumbline.sources.registry import Warehouse
from plumbline.sources.schemas import columns


# Schemas of the supplied tables. Declaring them saves a footer-reading job per table.
SOURCES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
                "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, "
                "l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
}


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.schema(SOURCES[table]).parquet(os.path.join(sf_dir, f"{table}.parquet"))


def _money(cents: str) -> str:
    return _cents(f"floor({cents})", 12)


def _cents(cents: str, precision: int) -> str:
    """Whole cents as a decimal amount."""
    return f"cast(cast({cents} as decimal({precision},0)) * cast(0.01 as decimal(3,2)) as decimal({precision},2))"


def _id(prefix: str, key: str, width: int) -> str:
    return f"concat('{prefix}', lpad(cast({key} as string), {width}, '0'))"


def customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (read(spark, sf_dir, "customer")
            .join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
            .selectExpr(
                "c_custkey as customer_key",
                _id("CUS", "c_custkey", 6) + " as customer_id",
                "c_name as customer_name",
                "case when c_custkey % 100 < 3 then null when c_custkey % 100 < 5 then 'n/a' "
                "else concat('c', cast(c_custkey as string), '@example.com') end as email",
                "n_name as city",
                "substr(n_name, 1, 2) as state",
                "cast(10000 + c_custkey % 90000 as int) as zip_code",
                "case when c_custkey % 200 = 7 then 'Platnium' "
                "when c_mktsegment in ('BUILDING', 'HOUSEHOLD') then 'Standard' "
                "when c_mktsegment = 'MACHINERY' then 'Premium' else 'Budget' end as customer_segment",
                "date '2020-01-01' as effective_date",
                "date '9999-12-31' as expiry_date",
                "true as is_current"))


def product(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "part").selectExpr(
        "p_partkey as product_key",
        _id("PROD", "p_partkey", 6) + " as product_id",
        "p_name as product_name",
        "p_type as category",
        "p_name as subcategory",
        "p_brand as brand",
        f"case when p_partkey % 100 = 1 then cast(0 as decimal(12,2)) "
        f"else {_money('p_retailprice * 100')} end as list_price",
        f"cast({_money('p_retailprice * 50')} + case when p_partkey % 100 = 2 then 5000 else 0 end "
        f"as decimal(12,2)) as cost_price",
        "p_size <= 45 as is_active")


def store(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = read(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    regions = read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (read(spark, sf_dir, "supplier")
            .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
            .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
            .selectExpr(
                "s_suppkey as store_key",
                _id("STR", "s_suppkey", 4) + " as store_id",
                "s_name as store_name",
                "n_name as city",
                "substr(n_name, 1, 2) as state",
                "r_name as region",
                "case when s_suppkey % 10 < 6 then 'Standard' when s_suppkey % 10 < 9 then 'Express' "
                "else 'Flagship' end as store_type",
                "case when s_suppkey % 50 = 9 then date '2099-01-01' else date '2010-06-01' end as opening_date"))


DAY_KEY = "cast(year({0}) * 10000 + month({0}) * 100 + day({0}) as int)"


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = read(spark, sf_dir, "orders").selectExpr("cast(o_orderdate as date) as full_date").distinct()
    return days.selectExpr(
        DAY_KEY.format("full_date") + " as date_key",
        "full_date",
        "year(full_date) as year_number",
        "quarter(full_date) as quarter_number",
        "month(full_date) as month_number",
        "date_format(full_date, 'MMMM') as month_name",
        "weekday(full_date) + 1 as day_of_week",
        "date_format(full_date, 'EEEE') as day_name",
        "weekday(full_date) >= 5 as is_weekend",
        "month(full_date) = 12 and day(full_date) = 25 as is_holiday")


def sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fact_sales plus ``load_date`` as a 15th column for the daily series.

    All arithmetic is done in whole cents; each measure becomes a decimal once, at the end. It is done after the join: the
    lines are shuffled as they are stored, in fewer and more uniform columns than their amounts.
    """
    orders = read(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    lines = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
                                                   "l_extendedprice", "l_discount", "l_tax")
    return (lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
            .selectExpr(
                "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "o_custkey", "o_orderdate",
                "cast(l_quantity as int) as sold",
                "floor(l_extendedprice * 100 / l_quantity) as price", "floor(l_extendedprice * 50 / l_quantity) as cost",
                "floor(l_extendedprice * 100 * l_discount) as discount", "floor(l_extendedprice * 100 * l_tax) as tax")
            .selectExpr(
                "l_orderkey * 10 + l_linenumber as sales_key",
                DAY_KEY.format("o_orderdate") + " as date_key",
                "case when l_orderkey % 1000 = 3 then 999999999 else o_custkey end as customer_key",
                "l_partkey as product_key",
                "l_suppkey as store_key",
                _id("ORD-", "l_orderkey", 8) + " as order_id",
                "l_linenumber as order_line_num",
                "cast(case when l_orderkey % 500 = 4 then -1 else l_quantity end as int) as quantity",
                _cents("price", 12) + " as unit_price",
                _cents("cost", 12) + " as unit_cost",
                _cents("discount", 12) + " as discount_amount",
                _cents("sold * price - discount", 14) + " as net_revenue",
                _cents("sold * (price - cost) - discount", 14) + " as gross_profit",
                _cents("tax", 12) + " as tax_amount",
                "cast(o_orderdate as date) as load_date"))


def stored_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``sales`` built once and stored, for queries that scan it several times: each scan would join the lines anew."""
    built, path = sales(spark, sf_dir), new_table_path(spark, "fact_sales")
    built.write.parquet(path)
    return spark.read.schema(built.schema).parquet(path)


def stored_star(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star with a stored fact."""
    return star(spark, sf_dir).replaced(
        fact_sales=lambda: stored_sales(spark, sf_dir).select(*columns("fact_sales")))


def dated_star(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The star with ``load_date`` on the fact, for daily series."""
    return star(spark, sf_dir).replaced(fact_sales=lambda: sales(spark, sf_dir))


def star(spark: SparkSession, sf_dir: str) -> Warehouse:
    return Warehouse({
        "dim_customer": lambda: customer(spark, sf_dir),
        "dim_product": lambda: product(spark, sf_dir),
        "dim_store": lambda: store(spark, sf_dir),
        "dim_date": lambda: calendar(spark, sf_dir),
        "fact_sales": lambda: sales(spark, sf_dir).select(*columns("fact_sales")),
    })
