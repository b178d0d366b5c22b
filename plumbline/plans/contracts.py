"""The contracts of the retail star as data."""

from __future__ import annotations

from plumbline.functions.predicates import EMAIL
from plumbline.operators.contracts import Contract, Field
from plumbline.plans.suites import BOOLEANS, DAYS, MONTHS, REGIONS, SEGMENTS, STORE_TYPES


def _field(name: str, kind: str, *constraints: dict, required: bool = True, key: str | None = None,
           pii: bool = False, references: str | None = None) -> Field:
    listed = ([{"type": "not_null"}] if required else []) + ([{"type": "unique"}] if key else [])
    if references:
        listed.append({"type": "referential_integrity", "references": references})
    return Field(name, kind, required, key is not None, key == "primary", references, "PII" if pii else None,
                 tuple(listed) + constraints)


def _span(low, high) -> dict:
    return {"type": "range", "minimum": low, "maximum": high}


def _size(low=None, high=None) -> dict:
    return {"type": "length", **{k: v for k, v in (("minimum", low), ("maximum", high)) if v is not None}}


def _like(regex: str) -> dict:
    return {"type": "pattern", "regex": regex}


def _one_of(values) -> dict:
    return {"type": "enum", "values": list(values)}


def _rule(rule: str, dimension: str, severity: str) -> dict:
    return {"id": rule, "dimension": dimension, "severity": severity}


def _name(table: str) -> str:
    return f"urn:datacontract:retail:{table}"


HORIZON = _span("2020-01-01", "2030-12-31")

# Types, constraints, service levels and rules of the contracts.
CUSTOMER = Contract(
    _name("dim_customer"), "dim_customer", fields=(
        _field("customer_key", "bigint", _span(1, 200_000), key="primary"),
        _field("customer_id", "varchar(15)", _like("^CUS[0-9]+$"), _size(5, 15)),
        _field("customer_name", "varchar(50)", _size(3, 50), pii=True),
        _field("email", "varchar(100)", {"type": "not_null", "mostly": 0.99}, {**_like(EMAIL), "mostly": 0.99},
               _size(high=100), required=False, pii=True),
        _field("city", "varchar(50)", _size(2, 50)),
        _field("state", "char(2)", _size(2, 2)),
        _field("zip_code", "integer", _span(10_000, 99_999)),
        _field("customer_segment", "varchar(20)", _one_of(SEGMENTS)),
        _field("effective_date", "date", HORIZON),
        _field("expiry_date", "date", _span("2020-01-01", "9999-12-31")),
        _field("is_current", "boolean", _one_of(BOOLEANS))),
    servicelevels={"availability": {"percentage": "99.9%"}, "freshness": {"threshold": "24h"},
                   "completeness": {"percentage": "100%"}, "accuracy": {"percentage": "99%"},
                   "uniqueness": {"percentage": "100%", "one_current_row": {"key": "customer_id", "flag": "is_current"}}},
    rules=(_rule("R-001", "Completeness", "critical"), _rule("R-002", "Completeness", "high"),
           _rule("R-003", "Validity", "high"), _rule("R-004", "Validity", "high"),
           _rule("R-005", "Uniqueness", "critical")))

PRODUCT = Contract(
    _name("dim_product"), "dim_product", fields=(
        _field("product_key", "bigint", _span(1, 50_000), key="primary"),
        _field("product_id", "varchar(20)", _like("^PROD[0-9]+$"), key="business"),
        _field("product_name", "varchar(100)", _size(3, 100)),
        _field("category", "varchar(50)"), _field("subcategory", "varchar(50)"), _field("brand", "varchar(50)"),
        _field("list_price", "decimal(12,2)", _span(0.01, 100_000)),
        _field("cost_price", "decimal(12,2)", _span(0, 100_000),
               {"type": "cross_field", "rule": "cost_price < list_price", "severity": "high"}, required=False),
        _field("is_active", "boolean", _one_of(BOOLEANS))),
    servicelevels={"freshness": {"threshold": "7d"}, "completeness": {"percentage": "100%"},
                   "accuracy": {"percentage": "99%", "rules": ["NOT is_active OR list_price > 0"]}},
    rules=(_rule("R-006", "Validity", "high"), _rule("R-007", "Accuracy", "medium")))

STORE = Contract(
    _name("dim_store"), "dim_store", fields=(
        _field("store_key", "bigint", key="primary"),
        _field("store_id", "varchar(15)", _like("^STR[0-9]+$"), key="business"),
        _field("store_name", "varchar(80)"), _field("city", "varchar(50)"),
        _field("state", "char(2)", _size(2, 2)),
        _field("region", "varchar(20)", _one_of(REGIONS)),
        _field("store_type", "varchar(20)", _one_of(STORE_TYPES)),
        _field("opening_date", "date", _span("2000-01-01", "today"))),
    servicelevels={"freshness": {"threshold": "30d"}, "completeness": {"percentage": "100%"}})

DATE = Contract(
    _name("dim_date"), "dim_date", fields=(
        _field("date_key", "integer", _span(20200101, 20301231), key="primary"),
        _field("full_date", "date", HORIZON, key="business"),
        _field("year_number", "smallint", _span(2020, 2030)),
        _field("quarter_number", "smallint", _span(1, 4)),
        _field("month_number", "smallint", _span(1, 12),
               {"type": "consistency", "rule": "EXTRACT(MONTH FROM full_date) = month_number"}),
        _field("month_name", "varchar(10)", _one_of(MONTHS)),
        _field("day_of_week", "smallint", _span(1, 7)),
        _field("day_name", "varchar(10)", _one_of(DAYS)),
        _field("is_weekend", "boolean"), _field("is_holiday", "boolean")),
    servicelevels={"freshness": {"threshold": "365d"},
                   "completeness": {"percentage": "100%", "no_gaps_in": "full_date"}})

SALES = Contract(
    _name("fact_sales"), "fact_sales", fields=(
        _field("sales_key", "bigint", key="primary"),
        _field("date_key", "integer", references="dim_date.date_key"),
        _field("customer_key", "bigint", references="dim_customer.customer_key"),
        _field("product_key", "bigint", references="dim_product.product_key"),
        _field("store_key", "bigint", references="dim_store.store_key"),
        _field("order_id", "varchar(20)", _size(5, 20)),
        _field("order_line_num", "smallint", _span(1, 100),
               {"type": "compound_unique", "columns": ["order_id", "order_line_num"]}),
        _field("quantity", "integer", _span(1, 10_000)),
        _field("unit_price", "decimal(12,2)", _span(0.01, 100_000)),
        _field("unit_cost", "decimal(12,2)", _span(0, 100_000), required=False),
        _field("discount_amount", "decimal(12,2)", _span(0, 50_000), required=False),
        _field("net_revenue", "decimal(14,2)", _span(-10_000, 10_000_000),
               {"type": "formula", "tolerance": 0.01,
                "rule": "ABS(net_revenue - (quantity * unit_price - discount_amount)) <= 0.01"}),
        _field("gross_profit", "decimal(14,2)", _span(-10_000, 10_000_000),
               {"type": "formula", "tolerance": 0.01,
                "rule": "ABS(gross_profit - (net_revenue - quantity * unit_cost)) <= 0.01"}, required=False),
        _field("tax_amount", "decimal(12,2)", _span(0, 100_000), required=False)),
    servicelevels={"availability": {"percentage": "99.5%"}, "freshness": {"threshold": "24h"},
                   "completeness": {"percentage": "99.9%", "no_orphans": True}, "accuracy": {"percentage": "99.5%"},
                   "consistency": {"percentage": "100%"},
                   "volume": {"minimum_daily_rows": 50_000, "maximum_daily_rows": 500_000, "minimum_share_of_average": 0.5}},
    rules=(_rule("R-008", "Consistency", "critical"), _rule("R-009", "Consistency", "critical"),
           _rule("R-010", "Consistency", "critical"), _rule("R-011", "Consistency", "critical"),
           _rule("R-012", "Validity", "high"), _rule("R-013", "Accuracy", "high"),
           _rule("R-014", "Accuracy", "high")),
    anomaly_detection={
        "volume": {"type": "statistical_threshold", "metric": "daily_row_count",
                   "baseline": "7_day_rolling_average", "alert_if": "row_count < baseline * 0.5", "severity": "high"},
        "freshness": {"type": "time_threshold", "metric": "max_load_timestamp", "severity": "critical",
                      "alert_if": "NOW() - max_load_timestamp > INTERVAL '24 hours'"},
        "revenue_spike": {"type": "statistical_threshold", "metric": "daily_total_revenue",
                          "baseline": "30_day_rolling_average",
                          "alert_if": "daily_total_revenue > baseline * 3.0", "severity": "high"}})


def _relation(column: str, table: str, rule: str) -> dict:
    return {"source_table": "fact_sales", "source_column": column, "target_table": table, "target_column": column,
            "cardinality": "many-to-one", "severity": "critical", "rule_id": rule}


INTEGRITY = Contract(
    _name("referential_integrity_policy"), None,
    relationships=(_relation("date_key", "dim_date", "R-009"), _relation("customer_key", "dim_customer", "R-008"),
                   _relation("product_key", "dim_product", "R-010"), _relation("store_key", "dim_store", "R-011")),
    servicelevels={"referential_integrity": {"percentage": "100%"}})

TABLES = (CUSTOMER, PRODUCT, STORE, DATE, SALES)
ALL = TABLES + (INTEGRITY,)
