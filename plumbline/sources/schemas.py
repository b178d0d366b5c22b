"""Declared schemas of the warehouse and of the monitoring tables. Nothing is inferred."""

from pyspark.sql import types as T

# Table schemas in declared column order.
TABLES: dict[str, str] = {
    "dim_customer": "customer_key bigint, customer_id string, customer_name string, email string, city string, "
                    "state string, zip_code int, customer_segment string, effective_date date, expiry_date date, "
                    "is_current boolean",
    "dim_product": "product_key bigint, product_id string, product_name string, category string, "
                   "subcategory string, brand string, list_price decimal(12,2), cost_price decimal(12,2), "
                   "is_active boolean",
    "dim_store": "store_key bigint, store_id string, store_name string, city string, state string, region string, "
                 "store_type string, opening_date date",
    "dim_date": "date_key int, full_date date, year_number int, quarter_number int, month_number int, "
                "month_name string, day_of_week int, day_name string, is_weekend boolean, is_holiday boolean",
    "fact_sales": "sales_key bigint, date_key int, customer_key bigint, product_key bigint, store_key bigint, "
                  "order_id string, order_line_num int, quantity int, unit_price decimal(12,2), "
                  "unit_cost decimal(12,2), discount_amount decimal(12,2), net_revenue decimal(14,2), "
                  "gross_profit decimal(14,2), tax_amount decimal(12,2)",
    "validation_runs": "run_id bigint, run_timestamp timestamp, table_name string, dimension string, "
                       "metric_name string, metric_value decimal(8,4), pass_count bigint, fail_count bigint, "
                       "total_count bigint, status string, issue_ids array<string>, load_date date",
    "active_issues": "issue_id string, severity string, resolved_date date",
    "referential_integrity_checks": "check_name string, orphan_count bigint, check_timestamp timestamp",
    "etl_load_log": "table_name string, load_timestamp timestamp, load_date date",
    "erp_product_master": "product_id string, standard_price decimal(12,2)",
}

WAREHOUSE = ("dim_customer", "dim_product", "dim_store", "dim_date", "fact_sales")


def schema(table: str) -> T.StructType:
    return T.StructType.fromDDL(TABLES[table])


def columns(table: str) -> list[str]:
    return [field.split()[0] for field in TABLES[table].split(", ")]
