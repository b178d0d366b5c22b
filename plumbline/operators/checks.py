"""Checks and suites as plain data.

A check names a kind, the columns it looks at and its bounds; nothing here touches Spark. ``validate`` turns a whole
suite into a handful of jobs, so adding a check to a suite does not add a scan.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass, field, replace

DIMENSIONS = ("Completeness", "Accuracy", "Consistency", "Uniqueness", "Validity", "Timeliness")


@dataclass(frozen=True)
class Check:
    kind: str
    columns: tuple[str, ...] = ()
    args: dict = field(default_factory=dict)
    mostly: float = 1.0
    dimension: str = "Validity"
    issue_id: str | None = None
    predicted: str | None = None
    rule_id: str | None = None
    severity: str | None = None
    description: str | None = None
    rationale: str | None = None
    no: int = 0

    @property
    def column_name(self) -> str:
        return ",".join(self.columns)


@dataclass(frozen=True)
class Suite:
    name: str
    table: str
    checks: tuple[Check, ...]

    def __post_init__(self):
        numbered = tuple(c if c.no else replace(c, no=i) for i, c in enumerate(self.checks, 1))
        object.__setattr__(self, "checks", numbered)

    def subset(self, *, kinds: Iterable[str] | None = None, issues: Iterable[str] | None = None,
               numbers: Iterable[int] | None = None, rules: Iterable[str] | None = None) -> "Suite":
        """The checks that meet every given filter, under their old numbers."""
        keep = self.checks
        for wanted, get in ((kinds, lambda c: c.kind), (issues, lambda c: c.issue_id),
                            (numbers, lambda c: c.no), (rules, lambda c: c.rule_id)):
            if wanted is not None:
                allowed = set(wanted)
                keep = tuple(c for c in keep if get(c) in allowed)
        return replace(self, checks=keep)

    def to_json(self) -> str:
        return json.dumps(asdict(self), indent=1, default=str)

    @staticmethod
    def from_json(text: str) -> "Suite":
        raw = json.loads(text)
        if "expectations" in raw:
            return from_expectations(raw)
        return Suite(raw["name"], raw["table"],
                     tuple(Check(**{**c, "columns": tuple(c["columns"])}) for c in raw["checks"]))


# --- constructors, one per kind ------------------------------------------------------------------------------------

def row_count(low: int | None = None, high: int | None = None, **meta) -> Check:
    return Check("row_count", (), {"min": low, "max": high}, **meta)


def column_order(*names: str, **meta) -> Check:
    return Check("column_order", (), {"names": list(names)}, **meta)


def not_null(column: str, mostly: float = 1.0, dimension: str = "Completeness", **meta) -> Check:
    return Check("not_null", (column,), {}, mostly, dimension, **meta)


def unique(column: str, **meta) -> Check:
    return Check("unique", (column,), {}, dimension="Uniqueness", **meta)


def compound_unique(*columns: str, **meta) -> Check:
    return Check("compound_unique", columns, {}, dimension="Uniqueness", **meta)


def distinct_ratio(column: str, low: float | None = None, high: float | None = None, **meta) -> Check:
    return Check("distinct_ratio", (column,), {"min": low, "max": high}, dimension="Uniqueness", **meta)


def between(column: str, low=None, high=None, mostly: float = 1.0, **meta) -> Check:
    return Check("between", (column,), {"min": low, "max": high}, mostly, **meta)


def length_between(column: str, low: int | None = None, high: int | None = None, mostly: float = 1.0, **meta) -> Check:
    return Check("length_between", (column,), {"min": low, "max": high}, mostly, **meta)


def in_set(column: str, values, mostly: float = 1.0, **meta) -> Check:
    return Check("in_set", (column,), {"values": list(values)}, mostly, **meta)


def distinct_in_set(column: str, values, **meta) -> Check:
    return Check("distinct_in_set", (column,), {"values": list(values)}, **meta)


def matches(column: str, regex: str, mostly: float = 1.0, **meta) -> Check:
    return Check("matches", (column,), {"regex": regex}, mostly, **meta)


def id_format(column: str, prefix: str, **meta) -> Check:
    return Check("id_format", (column,), {"prefix": prefix}, **meta)


def one_current_row(business_key: str, flag: str = "is_current", **meta) -> Check:
    return Check("one_current_row", (business_key,), {"flag": flag}, dimension="Uniqueness", **meta)


def has_current_row(business_key: str, flag: str = "is_current", **meta) -> Check:
    return Check("has_current_row", (business_key,), {"flag": flag}, dimension="Uniqueness", **meta)


def duplicate_key(*columns: str, **meta) -> Check:
    return Check("duplicate_key", columns, {}, dimension="Uniqueness", **meta)


def date_order(start: str, end: str, **meta) -> Check:
    return Check("date_order", (start, end), {}, dimension="Consistency", **meta)


def open_row_sentinel(flag: str, end: str, sentinel: str = "9999-12-31", **meta) -> Check:
    return Check("open_row_sentinel", (flag, end), {"sentinel": sentinel}, dimension="Consistency", **meta)


def margin(cost: str, price: str, guarded: bool = True, **meta) -> Check:
    return Check("margin", (cost, price), {"guarded": guarded}, dimension="Accuracy", **meta)


def not_future(column: str, **meta) -> Check:
    return Check("not_future", (column,), {}, **meta)


def month_matches(date: str, month: str, **meta) -> Check:
    return Check("month_matches", (date, month), {}, dimension="Consistency", **meta)


def year_matches(date: str, year: str, **meta) -> Check:
    return Check("year_matches", (date, year), {}, dimension="Consistency", **meta)


def boolean_share(column: str, low: float, high: float, **meta) -> Check:
    return Check("boolean_share", (column,), {"min": low, "max": high}, **meta)


def dominance(column: str, share: float, **meta) -> Check:
    return Check("dominance", (column,), {"share": share}, **meta)


def references(column: str, table: str, key: str, **meta) -> Check:
    return Check("references", (column,), {"table": table, "key": key}, dimension="Consistency", **meta)


def revenue_identity(**meta) -> Check:
    return Check("revenue_identity", ("net_revenue",), {}, dimension="Accuracy", **meta)


def profit_identity(**meta) -> Check:
    return Check("profit_identity", ("gross_profit",), {}, dimension="Accuracy", **meta)


def row_rule(column: str, rule: str, dimension: str = "Accuracy", **meta) -> Check:
    """A boolean SQL expression over one row: violated where it is false, satisfied where it is NULL."""
    return Check("row_rule", (column,), {"rule": rule}, dimension=dimension, **meta)


def unexpected_rows(query: str, **meta) -> Check:
    """Any Spark SQL over ``{batch}`` and ``{other_table}``; passes when it returns no row."""
    return Check("unexpected_rows", (), {"query": query}, **meta)


# --- persisted expectation documents (type + kwargs + meta) --------------------------------------------------------

# Public expectation type names and the constructor each one maps to.
EXPECTATION_TYPES = {
    "expect_table_row_count_to_be_between": lambda k: row_count(k.get("min_value"), k.get("max_value")),
    "expect_table_columns_to_match_ordered_list": lambda k: column_order(*k["column_list"]),
    "expect_column_values_to_not_be_null": lambda k: not_null(k["column"]),
    "expect_column_values_to_be_unique": lambda k: unique(k["column"]),
    "expect_compound_columns_to_be_unique": lambda k: compound_unique(*k["column_list"]),
    "expect_column_proportion_of_unique_values_to_be_between":
        lambda k: distinct_ratio(k["column"], k.get("min_value"), k.get("max_value")),
    "expect_column_values_to_be_between": lambda k: between(k["column"], k.get("min_value"), k.get("max_value")),
    "expect_column_value_lengths_to_be_between":
        lambda k: length_between(k["column"], k.get("min_value"), k.get("max_value")),
    "expect_column_values_to_be_in_set": lambda k: in_set(k["column"], k["value_set"]),
    "expect_column_values_to_match_regex": lambda k: matches(k["column"], k["regex"]),
    "expect_column_distinct_values_to_be_in_set": lambda k: distinct_in_set(k["column"], k["value_set"]),
    "unexpected_rows_expectation": lambda k: unexpected_rows(spark_sql_text(k["unexpected_rows_query"])),
}


def spark_sql_text(query: str, schema: str = "warehouse") -> str:
    """A PostgreSQL row check as Spark SQL text: other tables become placeholders, ``~`` becomes RLIKE.

    ``FLOAT`` has eight bytes there and four in Spark. ``CURRENT_DATE`` becomes ``{as_of}`` so that a run can be
    repeated for a past day.
    """
    query = re.sub(rf"\b{schema}\.(\w+)", r"{\1}", query)
    query = re.sub(r"\$'", r"\\\\z'", query)
    query = query.replace(" !~ ", " NOT RLIKE ").replace(" ~ ", " RLIKE ")
    query = re.sub(r"\bAS FLOAT\b", "AS DOUBLE", query)
    return re.sub(r"\bCURRENT_DATE\b", "{as_of}", query)


def from_expectations(raw: dict, table: str | None = None) -> Suite:
    """Load a suite persisted as a list of expectation documents."""
    checks = []
    for doc in raw["expectations"]:
        check, meta = EXPECTATION_TYPES[doc["type"]](doc["kwargs"]), doc.get("meta") or {}
        predicted = meta.get("predicted")
        checks.append(replace(
            check, mostly=doc["kwargs"].get("mostly", 1.0), dimension=meta.get("dimension", check.dimension),
            issue_id=meta.get("issue_id"), predicted="FAIL" if str(predicted).startswith("FAIL") else predicted,
            description=doc.get("description") or doc["kwargs"].get("description"), rationale=meta.get("rationale")))
    return Suite(raw["name"], table or raw["name"].removesuffix("_suite"), tuple(checks))
