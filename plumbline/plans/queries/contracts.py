"""T: data contracts, compiled and measured."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame

from plumbline.operators import contracts
from plumbline.operators.checks import Suite
from plumbline.operators.defects import inject
from plumbline.operators.validate import sample_unexpected, validate_all
from plumbline.plans.contracts import ALL, CUSTOMER, INTEGRITY, SALES, TABLES
from plumbline.plans.queries import AS_OF
from plumbline.plans.queries.checks import BRIEF, by_kind, run, stored_warehouse
from plumbline.sources.events import load_log
from plumbline.sources.star import dated_star, sales, star

SUITES: dict[str, Suite] = {c.table: contracts.compile_suite(c) for c in TABLES}
NOW = "2024-02-02 12:00:00"


def constraint(*kinds: str):
    return run(by_kind(SUITES, *kinds))


RULE_COLUMNS = {"T9c_cross_field": ("cost_price",), "T10c_consistency": ("month_number",),
                "T11c_formula": ("net_revenue", "gross_profit")}


def rules(*columns: str) -> dict[str, Suite]:
    """Row rules on some columns, table by table."""
    suites: dict[str, Suite] = {}
    for t, s in SUITES.items():
        chosen = s.subset(numbers=[c.no for c in s.checks if c.kind == "row_rule" and c.column_name in columns])
        if chosen.checks:
            suites[t] = chosen
    return suites


def types(spark, sf_dir):
    w = stored_warehouse(spark, sf_dir)
    return reduce(DataFrame.unionByName, [contracts.type_report(w[c.table], c, w.stored[c.table]) for c in TABLES])


def service_levels(spark, sf_dir):
    return contracts.service_levels(dated_star(spark, sf_dir), ALL, load_log(spark, sf_dir), NOW)


def anomaly_rules(spark, sf_dir):
    return contracts.anomaly_rules(SALES, sales(spark, sf_dir), load_log(spark, sf_dir), NOW)


def pii(spark, sf_dir):
    return contracts.pii_report(star(spark, sf_dir), TABLES)


def sample_without_pii(spark, sf_dir):
    """Evidence rows of the e-mail check: columns tagged as personal data are hidden by their metadata."""
    customers = contracts.with_classification(star(spark, sf_dir)["dim_customer"], CUSTOMER)
    check = next(c for c in SUITES["dim_customer"].checks if c.kind == "matches" and c.column_name == "email")
    return sample_unexpected(customers, check, order_by=["customer_key"])


QUERIES = {
    "T1c_contract_suite": run(SUITES),
    "T1c_contract_suite_mirror": lambda spark, sf_dir: validate_all(
        inject(star(spark, sf_dir), AS_OF), SUITES, as_of=AS_OF).select(*BRIEF, "severity"),
    "T2c_field_types": types,
    "T3c_not_null": constraint("not_null"),
    "T4c_unique": constraint("unique"),
    "T5c_range": constraint("between"),
    "T6c_pattern": constraint("matches"),
    "T7c_length": constraint("length_between"),
    "T8c_enum": constraint("in_set"),
    **{name: run(rules(*columns)) for name, columns in RULE_COLUMNS.items()},
    "T12c_referential_integrity": constraint("references"),
    "T13c_compound_unique": constraint("compound_unique"),
    "T14c_service_levels": service_levels,
    "T15c_rule_catalogue": lambda spark, sf_dir: contracts.rule_report(star(spark, sf_dir), AS_OF),
    "T15c_rule_catalogue_mirror": lambda spark, sf_dir: contracts.rule_report(
        inject(star(spark, sf_dir), AS_OF), AS_OF),
    "T16c_integrity_policy": lambda spark, sf_dir: contracts.integrity_checks(star(spark, sf_dir), [INTEGRITY]),
    "T17c_anomaly_rules": anomaly_rules,
    "T18c_pii_columns": pii,
    "T18c_sample_without_pii": sample_without_pii,
}
