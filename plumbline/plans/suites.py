"""The two suites of the retail star as data: ``consolidated`` (125 checks) and ``modular`` (114 checks)."""

from __future__ import annotations

from plumbline.functions.predicates import EMAIL
from plumbline.operators import checks as C
from plumbline.operators.checks import Suite
from plumbline.sources.schemas import columns

# Approved value lists.
SEGMENTS = ["Standard", "Budget", "Premium"]
STORE_TYPES = ["Standard", "Express", "Flagship"]
REGIONS = ["West", "South", "Northeast", "Midwest"]
DAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
MONTHS = ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October",
          "November", "December"]
BOOLEANS = [True, False]

# Issues the suites are expected to raise on the injected defects.
NULL_EMAIL = dict(issue_id="DQ-001", predicted="FAIL")
TWO_CURRENT = dict(issue_id="DQ-002", predicted="FAIL")
BAD_EMAIL = dict(issue_id="DQ-003", predicted="FAIL")
BAD_SEGMENT = dict(issue_id="DQ-004", predicted="FAIL")
ZERO_PRICE = dict(issue_id="DQ-005", predicted="FAIL")
COST_OVER_PRICE = dict(issue_id="DQ-006", predicted="FAIL")
ORPHAN = dict(issue_id="DQ-007", predicted="FAIL")
NEGATIVE_QUANTITY = dict(issue_id="DQ-008", predicted="FAIL")


def required(*names: str, dimension: str = "Completeness") -> list[C.Check]:
    return [C.not_null(n, dimension=dimension) for n in names]


def _sales_keys() -> list[C.Check]:
    return [C.references("customer_key", "dim_customer", "customer_key", **ORPHAN),
            C.references("product_key", "dim_product", "product_key"),
            C.references("store_key", "dim_store", "store_key"),
            C.references("date_key", "dim_date", "date_key")]


def _sales_measures() -> list[C.Check]:
    return [C.between("quantity", 1, 10_000, **NEGATIVE_QUANTITY),
            C.between("unit_price", 0.01, 100_000), C.between("unit_cost", 0, 100_000),
            C.between("discount_amount", 0, 50_000), C.between("net_revenue", -10_000, 10_000_000),
            C.between("gross_profit", -10_000, 10_000_000), C.between("tax_amount", 0, 100_000)]


def _table(name: str, low: int, high: int, *checks) -> Suite:
    flat = [C.row_count(low, high), C.column_order(*columns(name))]
    for check in checks:
        flat.extend(check if isinstance(check, list) else [check])
    return Suite(f"{name}_suite", name, tuple(flat))


# Bounds, tolerances and order of the checks.
def consolidated() -> dict[str, Suite]:
    return {s.table: s for s in (
        _table("dim_customer", 9_000, 11_000,
               required("customer_key", "customer_id", "customer_name", "effective_date", "expiry_date",
                        "is_current", "customer_segment"),
               C.not_null("email", 0.99, **NULL_EMAIL),
               C.unique("customer_key"),
               C.compound_unique("customer_id", "effective_date"),
               C.one_current_row("customer_id", **TWO_CURRENT),
               C.distinct_ratio("customer_id", 0.9995, 1.0, **TWO_CURRENT),
               C.duplicate_key("customer_key"),
               C.matches("email", EMAIL, 0.99, **BAD_EMAIL),
               C.in_set("customer_segment", SEGMENTS, **BAD_SEGMENT),
               C.id_format("customer_id", "CUS"),
               C.length_between("customer_id", 5, 15),
               C.length_between("customer_name", 3, 50),
               C.length_between("email", 5, 100, 0.95),
               C.between("zip_code", 10_000, 99_999),
               C.length_between("state", 2, 2),
               C.between("effective_date", "2020-01-01", "2030-12-31"),
               C.between("customer_key", 1, 200_000),
               C.length_between("customer_segment", 5, 20),
               C.distinct_in_set("is_current", BOOLEANS),
               C.between("expiry_date", "2020-01-01", "9999-12-31"),
               C.length_between("city", 2, 50),
               C.date_order("effective_date", "expiry_date"),
               C.open_row_sentinel("is_current", "expiry_date")),
        _table("dim_product", 800, 1_200,
               required("product_key", "product_id", "product_name", "is_active", "list_price"),
               C.unique("product_key"), C.unique("product_id"),
               C.between("list_price", 0.01, 100_000, **ZERO_PRICE),
               C.between("cost_price", 0, 100_000),
               C.between("product_key", 1, 50_000),
               C.length_between("product_id", 4, 20),
               C.length_between("product_name", 3, 100),
               C.distinct_in_set("is_active", BOOLEANS),
               required("category", dimension="Validity"), C.length_between("category", 2, 50),
               required("brand", dimension="Validity"), C.length_between("brand", 2, 50),
               C.id_format("product_id", "PROD"),
               required("subcategory", dimension="Validity"), C.length_between("subcategory", 2, 50),
               C.margin("cost_price", "list_price", guarded=True, **COST_OVER_PRICE)),
        _table("dim_store", 150, 300,
               required("store_key", "store_id", "store_name", "opening_date", "region"),
               C.unique("store_key"), C.unique("store_id"),
               C.in_set("store_type", STORE_TYPES), C.in_set("region", REGIONS),
               C.between("opening_date", "2000-01-01", "2099-12-31"),
               C.not_future("opening_date"),
               C.between("store_key", 1, 10_000),
               C.length_between("store_id", 4, 15), C.length_between("store_name", 3, 80),
               C.length_between("city", 2, 50), C.length_between("state", 2, 2),
               C.id_format("store_id", "STR"),
               required("city", "state", "store_type", dimension="Validity"),
               C.length_between("region", 4, 20)),
        _table("dim_date", 300, 400,
               required("date_key", "full_date", "month_name", "day_name", "is_weekend"),
               C.unique("date_key"), C.unique("full_date"),
               C.between("year_number", 2020, 2030), C.between("quarter_number", 1, 4),
               C.between("month_number", 1, 12), C.between("day_of_week", 1, 7),
               C.in_set("day_name", DAYS), C.in_set("month_name", MONTHS),
               C.distinct_in_set("is_weekend", BOOLEANS), C.distinct_in_set("is_holiday", BOOLEANS),
               C.between("date_key", 20200101, 20301231),
               C.between("full_date", "2020-01-01", "2030-12-31"),
               required("year_number", "quarter_number", dimension="Validity"),
               C.month_matches("full_date", "month_number")),
        _table("fact_sales", 450_000, 550_000,
               required("sales_key", "date_key", "customer_key", "product_key", "store_key", "net_revenue"),
               C.unique("sales_key"), C.duplicate_key("order_id", "order_line_num"),
               _sales_measures(),
               C.length_between("order_id", 5, 20), C.between("order_line_num", 1, 100),
               required("quantity", dimension="Validity"),
               _sales_keys(),
               C.revenue_identity(), C.profit_identity()),
    )}


# The per-table suites differ in bounds and in which checks they hold.
def modular() -> dict[str, Suite]:
    return {s.table: s for s in (
        _table("dim_customer", 9_000, 11_000,
               required("customer_key", "customer_id", "customer_name", "effective_date", "expiry_date",
                        "is_current", "customer_segment"),
               C.not_null("email", 0.99, **NULL_EMAIL),
               C.unique("customer_key"),
               C.one_current_row("customer_id", **TWO_CURRENT),
               C.matches("email", EMAIL, 0.99, **BAD_EMAIL),
               C.in_set("customer_segment", SEGMENTS, **BAD_SEGMENT),
               C.length_between("customer_id", 5, 15),
               C.length_between("customer_name", 3, 50),
               C.length_between("email", 5, 100, 0.95),
               C.between("zip_code", 10_000, 99_999),
               C.length_between("state", 2, 2),
               C.between("effective_date", "2020-01-01", "2030-12-31"),
               C.date_order("effective_date", "expiry_date"),
               C.open_row_sentinel("is_current", "expiry_date"),
               C.distinct_in_set("is_current", BOOLEANS),
               C.between("customer_key", 1, 200_000),
               C.length_between("customer_segment", 5, 20),
               C.id_format("customer_id", "CUS"),
               C.distinct_ratio("customer_id", 0.9995, 1.0, **TWO_CURRENT),
               C.duplicate_key("customer_key")),
        _table("dim_product", 800, 1_200,
               required("product_key", "product_id", "product_name", "is_active", "list_price"),
               C.unique("product_key"), C.unique("product_id"),
               C.between("list_price", 0.01, 10_000, **ZERO_PRICE),
               C.between("cost_price", 0, 10_000),
               C.between("product_key", 1, 100_000),
               C.distinct_in_set("is_active", BOOLEANS),
               C.id_format("product_id", "PRD"),
               C.length_between("product_id", 5, 20), C.length_between("product_name", 3, 100),
               C.length_between("category", 3, 50, 0.99), C.length_between("brand", 2, 50, 0.99),
               C.length_between("subcategory", 3, 50, 0.99),
               C.between("list_price", 0, 1_000, 0.999),
               C.margin("cost_price", "list_price", guarded=False, **COST_OVER_PRICE)),
        _table("dim_store", 150, 300,
               required("store_key", "store_id", "store_name", "opening_date", "state"),
               C.unique("store_key"), C.unique("store_id"),
               C.between("store_key", 1, 10_000),
               C.in_set("store_type", STORE_TYPES), C.in_set("region", REGIONS),
               C.length_between("state", 2, 2), C.id_format("store_id", "STR"),
               C.length_between("store_id", 5, 15), C.length_between("store_name", 3, 100),
               C.length_between("city", 2, 50),
               C.not_future("opening_date"),
               C.between("opening_date", "1990-01-01", "2030-12-31"),
               C.dominance("store_type", 0.70)),
        _table("dim_date", 300, 400,
               required("date_key", "full_date", "year_number", "month_number", "quarter_number"),
               C.unique("date_key"), C.unique("full_date"),
               C.between("date_key", 19000101, 21001231), C.between("month_number", 1, 12),
               C.between("quarter_number", 1, 4), C.between("day_of_week", 1, 7),
               C.between("year_number", 2020, 2030),
               C.in_set("month_name", MONTHS), C.in_set("day_name", DAYS),
               C.length_between("month_name", 3, 9), C.length_between("day_name", 6, 9),
               C.year_matches("full_date", "year_number"),
               C.boolean_share("is_weekend", 0.25, 0.32)),
        _table("fact_sales", 450_000, 550_000,
               required("sales_key", "date_key", "customer_key", "product_key", "store_key", "net_revenue"),
               C.unique("sales_key"), C.duplicate_key("order_id", "order_line_num"),
               _sales_measures(),
               _sales_keys(),
               C.revenue_identity(), C.profit_identity(),
               C.length_between("order_id", 5, 20), C.between("order_line_num", 1, 100)),
    )}
