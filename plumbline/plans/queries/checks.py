"""E, C and N: checks by kind, whole suites, and the runner."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plumbline.operators import checks as C
from plumbline.operators.checks import Suite
from plumbline.operators.defects import inject
from plumbline.operators.evidence import evidence
from plumbline.operators.key_history import history_of
from plumbline.operators.scores import summary
from plumbline.operators.validate import sample_unexpected, validate, validate_all
from plumbline.plans.queries import AS_OF
from plumbline.plans.suites import consolidated, modular
from plumbline.plans.contracts import TABLES
from plumbline.session import durable, new_table_path
from plumbline.sources.events import daily_load
from plumbline.sources.registry import Warehouse, from_parquet
from plumbline.sources.sinks import write_run
from plumbline.sources.star import read, star, stored_star

BRIEF = ["table_name", "check_no", "check_type", "column_name", "dimension", "issue_id", "evaluated_count",
         "unexpected_count", "unexpected_pct", "status"]


def by_kind(suites: dict[str, Suite], *kinds: str) -> dict[str, Suite]:
    """The checks of some kinds, table by table; tables without any are left out."""
    chosen = {t: s.subset(kinds=kinds) for t, s in suites.items()}
    return {t: s for t, s in chosen.items() if s.checks}


def run(suites: dict[str, Suite]):
    return lambda spark, sf_dir: validate_all(star(spark, sf_dir), suites, as_of=AS_OF).select(*BRIEF)


def _numbers(suites: dict[str, Suite], table: str, *keep: str) -> dict[str, Suite]:
    """Checks of one table that look at one of the given columns."""
    suite = suites[table]
    return {table: suite.subset(numbers=[c.no for c in suite.checks if c.column_name in keep])}


FULL, SPLIT = consolidated(), modular()
KEY_OF = {c.table: next(f.name for f in c.fields if f.primary) for c in TABLES}


def _date_bounds(suites: dict[str, Suite]) -> dict[str, Suite]:
    dated = {t: s.subset(numbers=[c.no for c in s.checks if c.kind == "between" and isinstance(c.args["min"], str)])
             for t, s in suites.items()}
    return {t: s for t, s in dated.items() if s.checks}


def _tolerant(suites: dict[str, Suite]) -> dict[str, Suite]:
    soft = {t: s.subset(numbers=[c.no for c in s.checks if c.mostly < 1]) for t, s in suites.items()}
    return {t: s for t, s in soft.items() if s.checks}


# Custom SQL checks (E13), written by a user against {batch} and other tables.
CUSTOM = {
    "fact_sales": Suite("custom", "fact_sales", (
        C.unexpected_rows("SELECT order_id, order_line_num, COUNT(*) AS n FROM {batch} "
                          "GROUP BY order_id, order_line_num HAVING COUNT(*) > 1"),
        C.unexpected_rows("SELECT sales_key FROM {batch} f LEFT ANTI JOIN {dim_customer} c "
                          "ON f.customer_key = c.customer_key"),
        C.unexpected_rows("SELECT sales_key FROM {batch} WHERE quantity < 1"))),
    "dim_store": Suite("custom", "dim_store", (
        C.unexpected_rows("SELECT store_key FROM {batch} WHERE opening_date > {as_of}"),)),
}


def custom_sql(spark, sf_dir) -> DataFrame:
    return validate_all(star(spark, sf_dir), CUSTOM, as_of=AS_OF).select(
        "table_name", "check_no", "unexpected_count", "status")


# A persisted document of the expectation layout, as another tool stores it.
PERSISTED = """{"name": "dim_product_suite", "expectations": [
 {"type": "expect_column_values_to_not_be_null", "kwargs": {"column": "product_id"}, "meta": {}},
 {"type": "expect_column_values_to_be_between", "kwargs": {"column": "list_price", "min_value": 0.01,
  "max_value": 100000}, "meta": {"dimension": "Validity", "issue_id": "DQ-005", "predicted": "FAIL"}},
 {"type": "expect_column_value_lengths_to_be_between", "kwargs": {"column": "brand", "min_value": 2, "max_value": 50,
  "mostly": 0.99}},
 {"type": "unexpected_rows_expectation", "kwargs": {"unexpected_rows_query":
  "SELECT product_key FROM {batch} WHERE product_id !~ '^PROD[0-9]+$'"}},
 {"type": "unexpected_rows_expectation", "kwargs": {"unexpected_rows_query":
  "SELECT product_key FROM {batch} WHERE cost_price > list_price"}, "meta": {"issue_id": "DQ-006"}}]}"""


def suite_store(spark, sf_dir) -> DataFrame:
    """A stored suite, loaded, written out, loaded again and run."""
    suite = Suite.from_json(Suite.from_json(PERSISTED).to_json())
    return validate(star(spark, sf_dir)["dim_product"], suite, as_of=AS_OF).select(
        "table_name", "check_no", "check_type", "column_name", "issue_id", "unexpected_count", "status")


def stored_warehouse(spark, sf_dir):
    """The star written to files and read back, so that the files' own schemas are known."""
    path = new_table_path(spark, "warehouse")
    star(spark, sf_dir).snapshot(spark, path)
    return from_parquet(spark, path)


def stored_order(spark, sf_dir) -> DataFrame:
    """Column order of the stored tables, beside their row counts."""
    suites = by_kind(FULL, "column_order", "row_count")
    return validate_all(stored_warehouse(spark, sf_dir), suites, as_of=AS_OF).select(*BRIEF)


def nulls_unexpected(spark, sf_dir) -> DataFrame:
    suite = FULL["dim_customer"].subset(kinds=["matches"])
    return validate(star(spark, sf_dir)["dim_customer"], suite, nulls="unexpected").select(*BRIEF)


def samples(spark, sf_dir) -> DataFrame:
    """Evidence rows of three checks, without personal data."""
    w = star(spark, sf_dir)
    chosen = {c.kind: c for t in ("dim_customer", "fact_sales", "dim_product") for c in FULL[t].checks}
    picked = [("dim_customer", chosen["matches"], "customer_key"), ("fact_sales", chosen["revenue_identity"], "sales_key"),
              ("dim_product", chosen["margin"], "product_key")]
    parts = [sample_unexpected(w[t], c, w, order_by=[key], as_of=AS_OF, hide=["email", "customer_name"])
             .select(F.lit(t).alias("table_name"), F.lit(c.kind).alias("check_type"), F.col(key).alias("row_key"))
             for t, c, key in picked]
    return reduce(DataFrame.unionAll, parts)


def all_evidence(spark, sf_dir) -> DataFrame:
    """Twenty rows, or all there are, for every failing check of both suites on the star with defects."""
    w = inject(stored_star(spark, sf_dir), AS_OF)  # scanned four times by each suite
    parts = []
    for name, suites in (("full", FULL), ("modular", SPLIT)):
        results = durable(validate_all(w, suites, as_of=AS_OF).select("table_name", "check_no", "unexpected_count", "status"))
        for t, suite in suites.items():
            found = evidence(w[t], suite, results, w, key=[KEY_OF[t]], as_of=AS_OF)
            parts.append(found.select(F.lit(name).alias("suite"), F.lit(t).alias("table_name"), "check_no", "check_type",
                                      "column_name", "evidence_no", "copies", "row_key"))
    return reduce(DataFrame.unionAll, parts)


LOADS = ("2024-01-01", "2024-01-11", "2024-01-21")  # first days; the last load has all later days
KEPT = (C.unique("event_id"), C.compound_unique("event_type", "user_id"), C.duplicate_key("event_type", "user_id"))


def unique_by_load(spark, sf_dir) -> DataFrame:
    """Uniqueness of each ten-day load of events against all loads before it, from the kept keys."""
    events = daily_load(spark, sf_dir).join(read(spark, sf_dir, "events").select("event_id", "user_id"), "event_id")
    parts = []
    for check in KEPT:
        history = history_of(spark, new_table_path(spark, "keys"), check, events, parts=8)
        for first, after in zip(LOADS, [*LOADS[1:], "9999-12-31"]):
            load = events.where(F.col("load_date") < F.lit(after).cast("date"))
            history.add(load.where(F.col("load_date") >= F.lit(first).cast("date")) if first != LOADS[0] else load, first)
        parts.append(history.totals().select(F.lit(check.kind).alias("check_type"), "*"))
    return reduce(DataFrame.unionAll, parts)


def mirror(spark, sf_dir) -> Warehouse:
    return inject(star(spark, sf_dir), AS_OF)


def validate_mirror(spark, sf_dir) -> DataFrame:
    return validate_all(mirror(spark, sf_dir), FULL, as_of=AS_OF)


def rerun(spark, sf_dir) -> DataFrame:
    """The same run stored twice: the second write replaces the first."""
    import datetime as dt

    results = validate(star(spark, sf_dir)["dim_store"], FULL["dim_store"], as_of=AS_OF)
    path = new_table_path(spark, "validation_runs")
    for _ in range(2):
        write_run(results, path, "run-1", dt.datetime(2026, 4, 29, 6, 30), dt.date(2026, 4, 29))
    stored = spark.read.parquet(path)
    return stored.groupBy("run_id", "load_date", "table_name").agg(
        F.count(F.lit(1)).alias("checks"), F.count_if(F.col("status") == "FAIL").alias("failed"))


def ad_hoc(spark, sf_dir) -> DataFrame:
    """One check on one table, without a stored suite."""
    suite = Suite("smoke", "fact_sales", (C.row_count(1, 1_000_000),))
    return validate(star(spark, sf_dir)["fact_sales"], suite).select(*BRIEF, "observed_value")


QUERIES = {
    "E1_row_count": run(by_kind(FULL, "row_count")),
    "E2_column_order": stored_order,
    "E3_not_null": run(by_kind(FULL, "not_null")),
    "E4_unique": run(by_kind(FULL, "unique")),
    "E5_compound_unique": run(by_kind(FULL, "compound_unique")),
    "E5_unique_by_load": unique_by_load,
    "E6_distinct_ratio": run(by_kind(FULL, "distinct_ratio")),
    "E7_between": run(by_kind(FULL, "between")),
    "E8_between_dates": run(_date_bounds(FULL)),
    "E9_length_between": run(by_kind(FULL, "length_between")),
    "E10_in_set": run(by_kind(FULL, "in_set")),
    "E11_matches": run(by_kind(FULL, "matches")),
    "E12_distinct_in_set": run(by_kind(FULL, "distinct_in_set")),
    "E13_unexpected_rows": custom_sql,
    "E14_mostly": run(_tolerant(SPLIT)),
    "E14_mostly_nulls_unexpected": nulls_unexpected,
    "E15_check_metadata": lambda spark, sf_dir: validate_mirror(spark, sf_dir).where("issue_id is not null").select(
        "table_name", "check_no", "check_type", "dimension", "issue_id", "predicted", "mostly", "status"),
    "E16_unexpected_sample": samples,
    "E16_evidence": all_evidence,
    "C1_one_current_row": lambda spark, sf_dir: validate_all(
        mirror(spark, sf_dir), by_kind(FULL, "one_current_row"), as_of=AS_OF).select(*BRIEF),
    "C2_duplicate_key": run(by_kind({"dim_customer": FULL["dim_customer"]}, "duplicate_key")),
    "C3_duplicate_compound_key": run(by_kind({"fact_sales": FULL["fact_sales"]}, "duplicate_key")),
    "C4_id_format": run(by_kind(FULL, "id_format")),
    "C4_id_format_modular": run(by_kind(SPLIT, "id_format")),
    "C5_date_order": run(by_kind(FULL, "date_order")),
    "C6_open_row_sentinel": run(by_kind(FULL, "open_row_sentinel")),
    "C7_margin_guarded": run(by_kind(FULL, "margin")),
    "C8_margin_unguarded": run(by_kind(SPLIT, "margin")),
    "C9_not_future": run(by_kind(FULL, "not_future")),
    "C10_month_matches": run(by_kind(FULL, "month_matches")),
    "C11_year_matches": run(by_kind(SPLIT, "year_matches")),
    "C12_boolean_share": run(by_kind(SPLIT, "boolean_share")),
    "C13_dominance": run(by_kind(SPLIT, "dominance")),
    **{f"C{n}_orphan_{t}": run({"fact_sales": FULL["fact_sales"].subset(
        numbers=[c.no for c in FULL["fact_sales"].checks if c.kind == "references" and c.columns == (f"{t}_key",)])})
       for n, t in ((14, "customer"), (15, "product"), (16, "store"), (17, "date"))},
    "C18_revenue_identity": run(by_kind(FULL, "revenue_identity")),
    "C19_profit_identity": run(by_kind(FULL, "profit_identity")),
    "A5_suite_store": suite_store,
    "N1_validate_fact_sales": run({"fact_sales": FULL["fact_sales"]}),
    "N1_validate_dim_customer": run({"dim_customer": FULL["dim_customer"]}),
    "N2_validate_all_consolidated": run(FULL),
    "N2_validate_all_modular": run(SPLIT),
    "N2_validate_mirror": lambda spark, sf_dir: validate_mirror(spark, sf_dir).select(*BRIEF),
    "N3_summary": lambda spark, sf_dir: summary(validate_mirror(spark, sf_dir)),
    "N4_rerun_replaces": rerun,
    "N5_ad_hoc_check": ad_hoc,
}
